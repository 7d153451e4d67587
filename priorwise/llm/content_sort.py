"""Exact dedup by content sort.

Sampled splitters range-partition the normalised texts, each partition is
sorted externally, and neighbouring rows are compared in full, so equal texts
become one run whose first row, the one with the smallest identifier, stays.
A run may cross partitions (a huge group of copies is spread over many of
them); its parts meet only at partition ends, so at most two parts a partition
are merged afterwards.

The range key is (32 leading characters, 64-bit hash, identifier), so a
splitter stays short however long texts are; the sort goes on with the whole
text, and inside a partition only whole texts are compared.  Runs at partition
ends are matched by the SHA-256 of their texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .scratch import materialize, scratch_root, ship, shuffle_partitions

SPACES = r"[\x20\x09-\x0D]+"
_SCHEMA = "doc_id long, text_sha256 string, keep_id long, group_size long, first boolean, part int, edge boolean"
_ARROW = pa.schema([("doc_id", pa.int64()), ("text_sha256", pa.string()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("first", pa.bool_()), ("part", pa.int32()), ("edge", pa.bool_())])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal neighbours of one sorted partition; holds the ids of one run at a time."""
    part = TaskContext.get().partitionId()
    held: list[pa.Array] = []
    text = sha = None
    head = True

    def run(edge: bool) -> pa.RecordBatch:
        ids = pa.concat_arrays(held)
        n = len(ids)
        keep = pc.min(ids).as_py()
        first = np.zeros(n, bool)
        first[0] = True
        return pa.record_batch([ids, pa.array([sha] * n, pa.string()), pa.array([keep] * n, pa.int64()), pa.array(np.full(n, n)), pa.array(first), pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, edge))], schema=_ARROW)

    for batch in batches:
        if not batch.num_rows:
            continue
        ids, texts, shas = batch.column(0), batch.column(1), batch.column(2)
        new = np.ones(batch.num_rows, bool)
        new[1:] = pc.not_equal(texts[1:], texts[:-1]).to_numpy(zero_copy_only=False)
        new[0] = text is None or texts[0].as_py() != text
        cuts = [*np.flatnonzero(new), batch.num_rows]
        if cuts[0] > 0:
            held.append(ids[: cuts[0]])
        if len(cuts) == 1:
            continue
        if held:
            yield run(head)
            head, held = False, []
        inner = cuts[:-1]
        if len(inner) > 1 and head:
            held, sha = [ids[inner[0] : inner[1]]], shas[int(inner[0])].as_py()
            yield run(True)
            head, held, inner = False, [], inner[1:]
        if len(inner) > 1:
            a, b = inner[0], inner[-1]
            sizes = np.diff(inner)
            begins = np.asarray(inner[:-1]) - a
            group = np.repeat(np.arange(len(sizes)), sizes)
            own = ids[a:b]
            low = np.minimum.reduceat(pc.fill_null(own, np.iinfo(np.int64).max).to_numpy(), begins)
            keep = pa.array(low[group], mask=(low == np.iinfo(np.int64).max)[group])
            yield pa.record_batch([own, shas[a:b].cast(pa.string()), keep, pa.array(sizes[group]), pa.array(np.isin(np.arange(b - a), begins)), pa.array(np.full(b - a, part, np.int32)), pa.array(np.zeros(b - a, bool))], schema=_ARROW)
        last = int(inner[-1])
        held, text, sha = [ids[last:]], texts[last].as_py(), shas[last].as_py()
    if held:
        yield run(True)


def content_sort_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of ASCII white space becomes
    one space.  A null text counts as empty.  Of equal texts the smallest
    non-null identifier stays (null only if all are null); of several rows with
    that identifier one stays.  Other columns are ignored; an empty table gives
    an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch_root(spark)
    norm = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACES, " ")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), norm.alias("norm"))
    rows = rows.withColumns({"head": F.substring("norm", 1, 32), "hash": F.xxhash64("norm")})
    order = [F.col("head"), F.col("hash"), F.col("doc_id").asc_nulls_last()]
    dealt = rows.repartitionByRange(shuffle_partitions(spark), *order)
    within = dealt.sortWithinPartitions("head", "hash", "norm", F.col("doc_id").asc_nulls_last())
    runs = within.select("doc_id", "norm", F.sha2("norm", 256).alias("sha")).mapInArrow(_runs, _SCHEMA)
    runs = materialize(runs, "content-sort")
    ends = runs.filter("edge").groupBy("text_sha256").agg(
        F.min("keep_id").alias("all_keep"),
        F.sum(F.when(F.col("first"), F.col("group_size"))).alias("all_size"),
        F.min("part").alias("first_part"),
    )
    # At most two rows for each partition of the sort: a proven bound.
    whole = runs.join(F.broadcast(ends), ["text_sha256"], "left")
    inner = ~F.col("edge")
    return whole.select(
        "doc_id",
        F.when(inner, F.col("keep_id")).otherwise(F.col("all_keep")).alias("keep_id"),
        F.when(inner, F.col("group_size")).otherwise(F.col("all_size")).alias("group_size"),
        (F.col("first") & (inner | (F.col("part") == F.col("first_part")))).alias("kept"),
        "text_sha256",
    )


def content_sort_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    As :func:`content_sort_groups`, but whole rows are sorted and only the
    first row of each run goes on, so nothing is joined back.  The first run of
    a partition may continue the last run of one before; it is dropped then.
    """
    spark = docs.sparkSession
    ship(spark)
    n = len(docs.columns)
    at = {c: i for i, c in enumerate(docs.columns)}
    rows = docs.toDF(*[f"c{i}" for i in range(n)])
    key, text = F.col(f"c{at[id_col]}").asc_nulls_last(), F.col(f"c{at[text_col]}")
    rows = rows.withColumn("norm", F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " "))
    rows = rows.withColumns({"head": F.substring("norm", 1, 32), "hash": F.xxhash64("norm")})
    dealt = rows.repartitionByRange(shuffle_partitions(spark), F.col("head"), F.col("hash"), key)
    within = dealt.sortWithinPartitions("head", "hash", "norm", key).withColumn("sha", F.sha2("norm", 256)).drop("head", "hash")

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        before = None
        held: pa.RecordBatch | None = None
        start = True

        def out(batch: pa.RecordBatch, edge: bool) -> pa.RecordBatch:
            columns = [batch.column(i) for i in range(n)] + [batch.column("sha"), pa.array([part] * batch.num_rows, pa.int32()), pa.array([edge] * batch.num_rows, pa.bool_())]
            return pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(n)] + ["sha", "part", "edge"])

        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column("norm")
            new = np.ones(batch.num_rows, bool)
            new[1:] = pc.not_equal(texts[1:], texts[:-1]).to_numpy(zero_copy_only=False)
            new[0] = before is None or texts[0].as_py() != before
            before = texts[-1].as_py()
            firsts = batch.filter(pa.array(new))
            if not firsts.num_rows:
                continue
            if held is not None:
                yield out(held, start)
                start = False
            if firsts.num_rows > 1 and start:
                yield out(firsts.slice(0, 1), True)
                firsts, start = firsts.slice(1), False
            if firsts.num_rows > 1:
                yield out(firsts.slice(0, firsts.num_rows - 1), False)
            held = firsts.slice(firsts.num_rows - 1)
        if held is not None:
            yield out(held, True)

    ddl = ", ".join([f"`c{i}` {kind}" for i, (_, kind) in enumerate(docs.dtypes)] + ["sha string", "part int", "edge boolean"])
    found = materialize(within.mapInArrow(heads, ddl), "content-sort")
    ends = found.filter("edge").groupBy("sha").agg(F.min("part").alias("first_part"))
    # at most two rows for each partition of the sort: a proven bound
    kept = found.join(F.broadcast(ends), ["sha"], "left").filter(~F.col("edge") | (F.col("part") == F.col("first_part")))
    return kept.select(*[F.col(f"c{i}") for i in range(n)]).toDF(*docs.columns)
