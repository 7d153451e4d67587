"""Token counts as an exact histogram of encoded lengths.

Documents are counted by encoded length; suffix sums over the histogram answer
totals, quantiles and truncated totals for every context limit without touching
the documents again.  Suffix sums run in two levels, within blocks of lengths
and over the blocks, so no window holds the whole histogram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .scratch import materialize, ship
from .tokens import encoder, stretches

BLOCK = 64


def encoded_lengths(docs: DataFrame, vocabulary: str | None = None, text_col: str = "text") -> DataFrame:
    """(length, n_docs) per task: lengths counted where they are encoded.

    A null or empty text has length 0.
    """
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            sizes = [len(ids) // 4 for texts in stretches(batch.column(0)) for ids in enc.ids(texts.to_pylist())]
            lengths, n = np.unique(np.array(sizes, np.int64), return_counts=True)
            yield pa.record_batch([pa.array(lengths), pa.array(n.astype(np.int64))], names=["length", "n_docs"])

    return docs.selectExpr(f"`{text_col}` as text").mapInArrow(count, "length long, n_docs long")


def length_histogram(docs: DataFrame, vocabulary: str | None = None, text_col: str = "text") -> DataFrame:
    """One row for each encoded length that occurs.

    length; n_docs, n_tokens: documents of that length and their tokens;
    docs_at_least, tokens_at_least: of that length or more; docs_at_most: of
    that length or less; share_at_most: docs_at_most over all documents;
    truncated_tokens: tokens left when every document is cut to that length.
    Texts are whole; repeated rows count each time; other columns are ignored;
    an empty table gives an empty result.
    """
    counted = encoded_lengths(docs, vocabulary, text_col).groupBy("length").agg(F.sum("n_docs").alias("n_docs"))
    counted = materialize(counted, "lengths").withColumns({"n_tokens": F.col("length") * F.col("n_docs"), "block": F.floor(F.col("length") / BLOCK)})
    blocks = counted.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"))
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    above = blocks.select("block", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("d_above"), F.coalesce(F.sum("t").over(later), F.lit(0)).alias("t_above"), F.sum("d").over(Window.partitionBy()).alias("all_docs"), F.sum("t").over(Window.partitionBy()).alias("all_tokens"))
    within = Window.partitionBy("block").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, 0)
    out = counted.withColumns({"d_in": F.sum("n_docs").over(within), "t_in": F.sum("n_tokens").over(within)}).join(above, "block")
    at_least, tokens_at_least = F.col("d_in") + F.col("d_above"), F.col("t_in") + F.col("t_above")
    return out.select(
        "length",
        "n_docs",
        "n_tokens",
        at_least.alias("docs_at_least"),
        tokens_at_least.alias("tokens_at_least"),
        (F.col("all_docs") - at_least + F.col("n_docs")).alias("docs_at_most"),
        ((F.col("all_docs") - at_least + F.col("n_docs")) / F.col("all_docs")).alias("share_at_most"),
        (F.col("all_tokens") - tokens_at_least + F.col("length") * at_least).alias("truncated_tokens"),
    )


def total_tokens(histogram: DataFrame) -> DataFrame:
    """One row: n_docs and n_tokens of all documents (0 when there are none)."""
    return histogram.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n_tokens"))


def length_quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """share, length: the least length that at least that share of documents does not exceed.

    The length is null when there are no documents.
    """
    found = [F.struct(F.lit(float(s)).alias("share"), F.min(F.when(F.col("share_at_most") >= s - 1e-12, F.col("length"))).alias("length")) for s in shares]
    return histogram.agg(F.array(*found).alias("found")).select(F.inline("found"))


def truncated_totals(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """context_limit, n_tokens: tokens left when every document is cut to each limit.

    The suffix sums at the least length above the limit give it: the tokens of
    all documents but those of that length or more, and the limit for each of
    these.  It is 0 when there are no documents.
    """
    total = F.coalesce(F.max("tokens_at_least"), F.lit(0))

    def left(limit: int):
        above = F.col("length") > limit
        sums = F.min_by(F.struct("docs_at_least", "tokens_at_least"), F.when(above, F.col("length")))
        return F.struct(F.lit(limit).cast("long").alias("context_limit"), (total - F.coalesce(sums["tokens_at_least"] - limit * sums["docs_at_least"], F.lit(0))).alias("n_tokens"))

    return histogram.agg(F.array(*[left(int(x)) for x in limits]).alias("found")).select(F.inline("found"))
