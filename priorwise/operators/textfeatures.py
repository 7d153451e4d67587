"""Features from earlier descriptions of the same entity."""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, BooleanType, StringType, StructField, StructType

from priorwise.functions.exprs import tokens

from .bridges import ANCHOR

SEPARATOR = " [SEP] "
TEXT_WINDOWS: dict[str, int | None] = {"6m": 6, "12m": 12, "24m": 24, "all": None}


@F.pandas_udf(StringType())
def normalize_description(text: pd.Series) -> pd.Series:
    """NFKC, white space collapsed and trimmed, case folded; blank and null become null."""

    def one(t: str | None) -> str | None:
        return " ".join(unicodedata.normalize("NFKC", t).split()).casefold() or None if t is not None else None

    return text.map(one, na_action="ignore").astype(object).where(text.notna(), None)


@F.pandas_udf(StringType())
def fold_space(text: pd.Series) -> pd.Series:
    """White space trimmed and collapsed, case folded, in any script; null becomes empty."""
    return text.map(lambda t: " ".join(t.split()).casefold(), na_action="ignore").astype(object).where(text.notna(), "")


def folded_marks(df: DataFrame, keys: Sequence[str], text: str, words: Sequence[str]) -> DataFrame:
    """As :func:`priorwise.operators.profile.text_marks` of texts folded by :func:`fold_space`.

    A text is folded, searched and digested before the next one is looked at,
    and only its digest leaves Python: a task holds an Arrow batch and one text,
    not the batch again as objects, folded, and as the batch that is sent back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, digests, found = [], [], []
            for i, value in enumerate(batch.column(len(keys))):
                t = " ".join((value.as_py() or "").split()).casefold()
                if t:
                    kept.append(i)
                    digests.append(hashlib.sha256(t.encode()).digest())
                    found.append(any(w in t for w in words))
            out = [c.take(pa.array(kept, pa.int64())) for c in batch.columns[: len(keys)]]
            yield pa.RecordBatch.from_arrays([*out, pa.array(digests, pa.binary()), pa.array(found, pa.bool_())], names=[*keys, "t", "w"])

    schema = StructType([*[df.schema[k] for k in keys], StructField("t", BinaryType()), StructField("w", BooleanType())])
    return df.select(*keys, text).mapInArrow(run, schema)


def historical_documents(bridge: DataFrame, key: str, text: str, windows: Mapping[str, int | None] = TEXT_WINDOWS) -> DataFrame:
    """Per anchor and window the earlier texts by (date, key), joined; repeats stay, none is null.

    The bridge has event_date and anchor_date; an event that is not earlier
    fails the query.
    """
    safe = F.when(F.col("event_date") < F.col("anchor_date"), F.struct("event_date", F.col(key).alias("k"), F.col(text).alias("t"))).otherwise(F.raise_error(F.lit("a description is not earlier than its claim")))
    item = F.when(F.col(text).isNotNull(), safe)
    aggs = []
    for w, months in windows.items():
        inside = item if months is None else F.when(F.col("event_date") >= F.add_months("anchor_date", -months), item)
        joined = F.transform(F.array_sort(F.collect_list(inside)), lambda x: x["t"])
        aggs.append(F.when(F.size(joined) > 0, joined).alias(f"texts_{w}"))
    grouped = bridge.groupBy(ANCHOR).agg(*aggs)
    return grouped.withColumns({f"document_{w}": F.array_join(f"texts_{w}", SEPARATOR) for w in windows})


def lexical_counts(documents: DataFrame, windows: Mapping[str, int | None] = TEXT_WINDOWS) -> DataFrame:
    """Counts over each window's document; averages are null without descriptions."""
    cols = [F.col(ANCHOR)]
    for w in windows:
        texts, doc = F.col(f"texts_{w}"), F.col(f"document_{w}")
        n = F.coalesce(F.size(F.when(texts.isNotNull(), texts)), F.lit(0))
        n = F.when(texts.isNull(), 0).otherwise(n)
        words = F.flatten(F.transform(F.coalesce(texts, F.array().cast("array<string>")), tokens))
        cols += [
            n.alias(f"description_count_{w}"), F.when(texts.isNull(), 0).otherwise(F.size(F.array_distinct(texts))).alias(f"unique_description_count_{w}"),
            F.coalesce(F.length(doc), F.lit(0)).alias(f"character_count_{w}"), F.size(words).alias(f"token_count_{w}"), F.size(F.array_distinct(words)).alias(f"unique_token_count_{w}"),
            F.when(n > 0, F.coalesce(F.length(doc), F.lit(0)) / n).alias(f"characters_per_description_{w}"), F.when(n > 0, F.size(words) / n).alias(f"tokens_per_description_{w}"),
        ]
    return documents.select(*cols, *[F.col(f"texts_{w}").isNotNull().alias(f"has_description_{w}") for w in windows])


def text_quality(texts: DataFrame, text: str, low_coverage: float = 0.05, repetition: float = 0.10) -> DataFrame:
    """One row: coverage, cardinality, duplicates, top share, length and token means, and two warnings."""
    g = texts.groupBy(F.col(text).alias("t")).agg(F.count(F.lit(1)).alias("n"))
    has = F.col("t").isNotNull()
    filled = F.when(has, F.col("n"))
    out = g.agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(filled), F.lit(0)).alias("filled"), F.count_if(has).alias("unique_texts"), F.coalesce(F.sum(F.when(has & (F.col("n") > 1), F.col("n"))), F.lit(0)).alias("duplicated_rows"), F.coalesce(F.max(filled), F.lit(0)).alias("top_count"),
        (F.sum(F.length("t") * F.col("n")) / F.sum(filled)).alias("mean_length"), (F.sum(F.size(tokens(F.col("t"))) * filled) / F.sum(filled)).alias("mean_tokens"),
    )
    share = F.col("filled") / F.col("rows")
    out = out.withColumns({"coverage": share, "duplicate_rate": F.when(F.col("filled") > 0, F.col("duplicated_rows") / F.col("filled")), "top_share": F.when(F.col("filled") > 0, F.col("top_count") / F.col("filled"))})
    return out.withColumns({"low_text_coverage": share < low_coverage, "high_text_repetition": (F.col("filled") > 0) & (F.col("unique_texts") <= repetition * F.col("filled"))})
