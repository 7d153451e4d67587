"""Logistic models of all folds, fitted together.

The rows are written once with the folds that they train and validate.  Every
step of Newton's method is one pass: tasks add up gradient and Hessian of each
fold over their rows, Spark adds up the tasks' sums by fold and matrix row, and
only the finished sums, whose size is that of the models, reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from priorwise.sources.tables import written

#: Columns of a design up to which a Hessian a fold is summed.
MOST_WIDTH = 2000
#: Rows of a design in memory at a time.
_ROWS = 4096


@dataclass
class FoldFits:
    """Models on columns as they are: numbers filled with ``fill``, then a column for each known category."""

    fold_ids: list
    numeric: list[str]
    levels: dict[str, list[str]]
    fill: np.ndarray
    coefficients: np.ndarray
    intercepts: np.ndarray
    passes: int


def _designer(numeric: Sequence[str], levels: dict[str, list[str]]) -> Callable[[pa.RecordBatch], np.ndarray]:
    def design(batch: pa.RecordBatch) -> np.ndarray:
        """Numbers (missing: nan) and a 0/1 column for each category; an unknown or missing one has none."""
        x = np.zeros((batch.num_rows, len(numeric) + sum(map(len, levels.values()))))
        for j, c in enumerate(numeric):
            x[:, j] = batch.column(c).to_numpy(zero_copy_only=False)
        j = len(numeric)
        for c, values in levels.items():
            code = pc.fill_null(pc.index_in(batch.column(c), value_set=pa.array(values, pa.string())), -1).to_numpy(zero_copy_only=False)
            at = np.flatnonzero(code >= 0)
            x[at, j + code[at]] = 1.0
            j += len(values)
        return x

    return design


def _sums(rows: DataFrame, design: Callable, work: Callable[[int, np.ndarray, np.ndarray], np.ndarray], n_folds: int) -> list[np.ndarray | None]:
    """Per fold the sum, over its train rows, of the matrices that ``work`` makes of (fold, x, y)."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list = [None] * n_folds
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                x, y = design(batch), batch.column("__y").to_numpy(zero_copy_only=False)
                fold, parent = (a.to_numpy(zero_copy_only=False) for a in (batch.column("__train").flatten(), pc.list_parent_indices(batch.column("__train"))))
                for f in range(n_folds):
                    mine = parent[fold == f]
                    if len(mine):
                        got = work(f, x[mine], y[mine])
                        total[f] = got if total[f] is None else total[f] + got
        for f, m in enumerate(total):
            if m is not None:
                yield pa.record_batch([pa.array([f] * len(m), pa.int32()), pa.array(range(len(m)), pa.int32()), pa.array([r.tobytes() for r in m], pa.binary())], names=["fold", "i", "part"])

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(b.as_py()) for b in table.column("part")], axis=0)
        return pa.table({"fold": table.column("fold").slice(0, 1), "i": table.column("i").slice(0, 1), "part": pa.array([total.tobytes()], pa.binary())})

    schema = "fold int, i int, part binary"
    out: list = [{} for _ in range(n_folds)]
    for r in rows.mapInArrow(partial, schema).groupBy("fold", "i").applyInArrow(add, schema).collect():  # as many numbers as the Hessians have
        out[r["fold"]][r["i"]] = np.frombuffer(r["part"])
    return [np.stack([m[i] for i in range(len(m))]) if m else None for m in out]


def fold_rows(df: DataFrame, folds: DataFrame, key: str, numeric: Sequence[str], categorical: Sequence[str], y: str = "y") -> tuple[DataFrame, list]:
    """A written table of rows with the folds they train and validate, and the fold identifiers; rows of no fold are left out."""
    folds = written(folds.select(key, "fold_id", "role"), "fold-roles")
    ids = [r[0] for r in folds.select("fold_id").distinct().orderBy("fold_id").collect()]  # a handful of folds
    number = F.array_position(F.array(*[F.lit(i) for i in ids]), F.col("fold_id")).cast("int") - 1
    of = lambda role: F.collect_list(F.when(F.col("role") == role, number)).alias(f"__{role.lower()}")
    roles = folds.groupBy(key).agg(of("TRAIN"), of("VALIDATION"))
    value = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c)
    rows = df.join(roles, key).select(F.col(key), F.col(y), F.col(y).cast("double").alias("__y"), "__train", "__validation", *[value(c) for c in numeric], *[F.col(c).cast("string").alias(c) for c in categorical])
    return written(rows, "fold-rows"), ids


def fit_folds(rows: DataFrame, ids: Sequence, numeric: Sequence[str], categorical: Sequence[str], penalty: float = 0.01, tol: float = 1e-10, max_passes: int = 100) -> FoldFits | None:
    """One logistic model a fold, from the table of :func:`fold_rows`.

    Missing numbers take the median of the fold's train rows (0 where it has
    none); a category that they lack has no effect.  ``penalty`` is on squared
    coefficients of columns scaled to unit deviation, the mean loss being 1 a
    row; constant columns have coefficient 0.  Rows without a label train
    nothing.  A fold whose train rows have one label gives that label; one
    without train rows has no model.  None where the design has more than
    ``MOST_WIDTH`` columns.
    """
    train = rows.filter("__y is not null and size(__train) > 0")
    levels = {c: [r[0] for r in train.select(c).filter(F.col(c).isNotNull()).distinct().orderBy(c).limit(MOST_WIDTH + 1).collect()] for c in categorical}
    k, width, n_folds = len(numeric), len(numeric) + sum(map(len, levels.values())), len(ids)
    if width > MOST_WIDTH:
        return None
    fill = np.zeros((n_folds, k))
    if k:
        medians = train.select(F.explode("__train").alias("fold"), *numeric).groupBy("fold").agg(*[F.percentile_approx(c, 0.5, 100_000).alias(c) for c in numeric])
        for r in medians.collect():  # a row a fold
            fill[r["fold"]] = [0.0 if r[c] is None else r[c] for c in numeric]
    design = _designer(list(numeric), levels)

    def filled(f: int, x: np.ndarray) -> np.ndarray:
        x[:, :k] = np.where(np.isnan(x[:, :k]), fill[f], x[:, :k])
        return x

    def moments(f: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        x = filled(f, x)
        x[:, :k] -= fill[f]  # about the median, so that little is lost in the squares
        return np.vstack([np.append(x.sum(0), len(x)), np.append((x * x).sum(0), y.sum())])

    known = _sums(train, design, moments, n_folds)
    mean, scale, beta = np.zeros((n_folds, width)), np.zeros((n_folds, width)), np.zeros((n_folds, width + 1))
    n = np.array([0.0 if m is None else m[0, -1] for m in known])
    positives = np.array([0.0 if m is None else m[1, -1] for m in known])
    for f in np.flatnonzero(n > 0):
        first, second = known[f][0, :-1], known[f][1, :-1]
        mean[f] = first / n[f] + np.append(fill[f], np.zeros(width - k))
        variance = (second - first * first / n[f]) / max(n[f] - 1, 1)
        least = 1e-12 * second / n[f]  # below it is what rounding leaves of a constant
        scale[f] = np.where(variance > least, np.sqrt(np.maximum(variance, 0)), 0)
    inverse = np.divide(1.0, scale, out=np.zeros_like(scale), where=scale > 0)
    open_ = (positives > 0) & (positives < n)
    for f in np.flatnonzero(open_):
        beta[f, -1] = np.log(positives[f] / (n[f] - positives[f]))
    step, loss, passes, ridge = np.zeros_like(beta), np.full(n_folds, np.inf), 0, np.append(np.full(width, penalty), 0.0)
    while open_.any() and passes < max_passes:
        tried, running = beta + step, open_.copy()

        def derivatives(f: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
            if not running[f]:
                return np.zeros((1, 1))
            z = np.column_stack([(filled(f, x) - mean[f]) * inverse[f], np.ones(len(x))])
            m = z @ tried[f]
            p = 0.5 * (1 + np.tanh(m / 2))
            own = np.append(np.zeros(z.shape[1] - 1), (np.logaddexp(0, m) - y * m).sum())
            return np.vstack([z.T @ (z * (p * (1 - p))[:, None]), z.T @ (p - y), own])

        passes += 1
        for f, got in enumerate(_sums(train, design, derivatives, n_folds)):
            if not running[f]:
                continue
            now = got[-1, -1] / n[f] + 0.5 * (ridge * tried[f] ** 2).sum()
            if now > loss[f] + 1e-12 * abs(now):
                step[f] /= 2
                open_[f] = np.abs(step[f]).max() > tol
                continue
            beta[f], loss[f] = tried[f], now
            step[f] = -np.linalg.solve(got[:-2] / n[f] + np.diag(ridge), got[-2] / n[f] + ridge * beta[f])
            open_[f] = np.abs(step[f]).max() > tol
    coefficients = beta[:, :-1] * inverse
    intercepts = beta[:, -1] - (coefficients * mean).sum(1)
    one = (positives == 0) | (positives == n)
    intercepts[one] = np.where(positives[one] > 0, np.inf, -np.inf)
    intercepts[n == 0] = np.nan
    return FoldFits(list(ids), list(numeric), levels, fill, coefficients, intercepts, passes)


def score_folds(rows: DataFrame, fits: FoldFits, key: str, y: str = "y") -> DataFrame:
    """key, y, fold_id, p: the validation rows of every fold by its model, in one pass; p is null without a model."""
    design, ids = _designer(fits.numeric, fits.levels), fits.fold_ids
    k, fill, coefficients, intercepts = len(fits.numeric), fits.fill, fits.coefficients, fits.intercepts

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                x = design(batch)
                fold, parent = (a.to_numpy(zero_copy_only=False) for a in (batch.column("__validation").flatten(), pc.list_parent_indices(batch.column("__validation"))))
                for f in np.unique(fold):
                    mine = parent[fold == f]
                    z = x[mine]
                    z[:, :k] = np.where(np.isnan(z[:, :k]), fill[f], z[:, :k])
                    p = 0.5 * (1 + np.tanh((z @ coefficients[f] + intercepts[f]) / 2))
                    own = batch.take(pa.array(mine))
                    yield pa.record_batch([own.column(key), own.column(y), pa.array([int(f)] * len(mine), pa.int32()), pa.array(p, mask=np.isnan(p))], names=[key, y, "__fold", "p"])

    fields = rows.select(key, y).schema.add("__fold", T.IntegerType()).add("p", T.DoubleType())
    numbers = F.array(*[F.lit(i) for i in ids]) if ids else F.array(F.lit(None).cast("int"))
    return rows.mapInArrow(scores, fields).select(key, y, F.get(numbers, F.col("__fold")).alias("fold_id"), "p")
