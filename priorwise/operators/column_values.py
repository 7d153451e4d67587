"""What the distinct values of very many numeric columns tell, exactly and in bounded memory.

A stretch of rows gives each column's distinct values and their counts, sorted
and as bytes, dealt in parts by value; a part of a column's values is merged in
one group.  Nothing is brought into long form, so a column of few values costs
a few bytes a stretch, and one of many its values.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Rows of a stretch, and rows of the whole for each part of a column's values.
ROWS_A_STRETCH, ROWS_A_PART = 32_768, 1_000_000
_PART = "feature string, part int, values binary, counts binary, nulls long"
_TOLD = "feature string, filled long, nulls long, distinct_values long, zeros long, min double, max double, total double, squares double"


def _stretches(names: Sequence[str], parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def counted(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        out = []
        for name in names:
            column = table.column(name)
            # one zero and one value that is no number, as in Spark's groups
            v, n = np.unique(column.drop_null().to_numpy() + 0.0, return_counts=True)
            v[np.isnan(v)] = np.nan
            of = ((v.view("uint64") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype("int64") % parts
            order = np.argsort(of, kind="stable")
            v, n, of = v[order], n[order], of[order]
            ends = np.flatnonzero(np.diff(of, append=-1)) + 1
            for start, end in zip([0, *ends[:-1]], ends):
                out.append((name, int(of[start]), v[start:end].tobytes(), n[start:end].astype("<u4").tobytes(), 0))
            if column.null_count:
                out.append((name, 0, b"", b"", column.null_count))
        columns = list(zip(*out)) or [[]] * 5
        types = (pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["feature", "part", "values", "counts", "nulls"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= ROWS_A_STRETCH:
                yield counted(held)
                held, rows = [], 0
        if rows:
            yield counted(held)

    return run


def _told(part: pa.Table) -> pa.Table:
    """One row of a column's part: its distinct values are merged, and summed up."""
    v = np.frombuffer(b"".join(part.column("values").to_pylist()), "f8")
    n = np.frombuffer(b"".join(part.column("counts").to_pylist()), "<u4").astype("int64")
    v, at = np.unique(v, return_inverse=True)
    counts = np.zeros(len(v), "int64")
    np.add.at(counts, at, n)
    has = len(v) > 0
    row = {
        "feature": part.column("feature")[0].as_py(), "filled": int(counts.sum()), "nulls": sum(part.column("nulls").to_pylist()), "distinct_values": len(v), "zeros": int(counts[v == 0].sum()),
        "min": float(v[0]) if has else None, "max": float(v[-1]) if has else None, "total": float((v * counts).sum()) if has else None, "squares": float((v * v * counts).sum()) if has else None,
    }
    types = {"feature": pa.string()} | dict.fromkeys(("filled", "nulls", "distinct_values", "zeros"), pa.int64()) | dict.fromkeys(("min", "max", "total", "squares"), pa.float64())
    return pa.table({k: pa.array([x], types[k]) for k, x in row.items()})


def column_values(frames: Sequence[tuple[DataFrame, Sequence[str]]], rows: int, whole: bool = True, zeros: Collection[str] = ()) -> DataFrame:
    """feature, rows, nulls, distinct_values, min, max, mean and std (ddof 0) of the numeric columns of each frame.

    ``rows``: about as many as a frame has; exactly all there are if not
    ``whole``, where a row that a frame lacks is null in its columns, or 0 in
    those of ``zeros``, as are their nulls.
    """
    parts = max(1, -(-rows // ROWS_A_PART))

    def told(frame: DataFrame, names: Sequence[str]) -> DataFrame:
        value = lambda c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) if c in zeros else F.col(f"`{c}`").cast("double")
        return frame.select(*[value(c).alias(c) for c in names]).mapInArrow(_stretches(names, parts), _PART)

    each = reduce(DataFrame.unionAll, [told(frame, names) for frame, names in frames]).groupBy("feature", "part").applyInArrow(_told, _TOLD)
    total = lambda c: F.sum(c).alias(c)
    x = each.groupBy("feature").agg(total("filled"), total("nulls"), total("distinct_values"), total("zeros"), F.min("min").alias("min"), F.max("max").alias("max"), total("total"), total("squares"))
    if not whole:
        lacks = F.lit(rows) - F.col("filled") - F.col("nulls")
        zero = F.col("feature").isin(*zeros) & (lacks > 0) if zeros else F.lit(False)
        with_zero = lambda f, c: F.when(zero, f(F.coalesce(c, F.lit(0.0)), F.lit(0.0))).otherwise(F.col(c)).alias(c)
        x = x.select(
            "feature", F.when(zero, F.col("filled") + lacks).otherwise(F.col("filled")).alias("filled"), F.when(zero, F.col("nulls")).otherwise(F.col("nulls") + lacks).alias("nulls"),
            (F.col("distinct_values") + F.when(zero & (F.col("zeros") == 0), 1).otherwise(0)).alias("distinct_values"), with_zero(F.least, "min"), with_zero(F.greatest, "max"), "total", "squares")
    mean = F.when(F.col("filled") > 0, F.col("total") / F.col("filled"))
    std = F.when(F.col("filled") > 0, F.sqrt(F.greatest(F.col("squares") / F.col("filled") - mean * mean, F.lit(0.0))))
    return x.select("feature", (F.col("filled") + F.col("nulls")).alias("rows"), "nulls", "distinct_values", "min", "max", mean.alias("mean"), std.alias("std"))
