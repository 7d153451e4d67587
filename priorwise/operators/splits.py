"""Chronological splits and folds.

Boundaries are found on distinct dates, of which there are few whatever the
number of claims, so the running sums stay small.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F


def date_counts(claims: DataFrame, date: str) -> DataFrame:
    """claim_date, n, cum, total per distinct date."""
    daily = claims.groupBy(F.col(date).alias("claim_date")).agg(F.count(F.lit(1)).alias("n"))
    return daily.withColumns({"cum": F.sum("n").over(Window.orderBy("claim_date")), "total": F.sum("n").over(Window.partitionBy())})


def _closest(daily: DataFrame, fraction: float, after: DataFrame | None, name: str) -> DataFrame:
    """One row: the date whose running count is closest to the fraction, the earlier of ties, after a given date."""
    if after is not None:
        daily = daily.crossJoin(after).filter(F.col("claim_date") > F.col("__after"))
    gap = F.abs(F.col("cum") - F.lit(float(fraction)) * F.col("total"))
    return daily.agg(F.min_by("claim_date", F.struct(gap, "claim_date")).alias(name))


def split_boundaries(claims: DataFrame, date: str, train: float = 0.70, validation: float = 0.15) -> DataFrame:
    """One row: train_end, validation_end, counts of claims and dates per part.

    Both are dates, so a date is never split.  status is OK, or says that there
    are fewer than three claims or dates, or that a part is empty.
    """
    daily = date_counts(claims, date)
    first = _closest(daily, train, None, "train_end")
    second = _closest(daily, train + validation, first.select(F.col("train_end").alias("__after")), "validation_end")
    ends = first.crossJoin(second)
    d, t, v = F.col("claim_date"), F.col("train_end"), F.col("validation_end")
    zero = F.lit(0)

    def part(cond, name):
        return [F.coalesce(F.sum(F.when(cond, F.col("n"))), zero).alias(f"{name}_count"), F.count_if(cond).alias(f"{name}_dates")]

    out = daily.crossJoin(ends).groupBy("train_end", "validation_end").agg(F.sum("n").alias("total_claims"), F.count(F.lit(1)).alias("unique_dates"), *part(d <= t, "train"), *part((d > t) & (d <= v), "validation"), *part(d > v, "test"))
    status = F.when((F.col("total_claims") < 3) | (F.col("unique_dates") < 3), "TOO_FEW").when((F.col("train_count") == 0) | (F.col("validation_count") == 0) | (F.col("test_count") == 0), "EMPTY_PART").otherwise("OK")
    return out.withColumn("status", status)


def assign_split(claims: DataFrame, boundaries: DataFrame, date: str) -> DataFrame:
    """The claims with their split; the one-row boundaries are joined in."""
    b = F.broadcast(boundaries.select(F.col("train_end").alias("__t"), F.col("validation_end").alias("__v")))
    split = F.when(F.col(date) <= F.col("__t"), "TRAIN").when(F.col(date) <= F.col("__v"), "VALIDATION").otherwise("TEST")
    return claims.crossJoin(b).withColumn("split", split).drop("__t", "__v")


def assignment_problems(assignments: DataFrame, claims: DataFrame, key: str) -> DataFrame:
    """One row of counts that must be zero: null and repeated keys, unknown labels, missing claims."""
    a = assignments.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.max((~F.coalesce(F.col("split").isin("TRAIN", "VALIDATION", "TEST"), F.lit(False))).cast("int")).alias("bad"))
    j = claims.select(F.col(key), F.lit(True).alias("known")).join(a, key, "full_outer")
    return j.agg(F.count_if(F.col(key).isNull()).alias("null_keys"), F.count_if(F.col("n") > 1).alias("repeated_keys"), F.count_if(F.col("bad") == 1).alias("unknown_labels"), F.count_if(F.col("n").isNull()).alias("missing_claims"), F.count_if(F.col("known").isNull()).alias("extra_claims"))


def split_ranges(assignments: DataFrame, date: str) -> DataFrame:
    """Per split: rows, earliest, latest."""
    return assignments.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.min(date).alias("earliest"), F.max(date).alias("latest"))


def date_order_errors(assignments: DataFrame, date: str) -> DataFrame:
    """One row: dates in several splits, and whether the ranges overlap."""
    per = assignments.groupBy(date).agg(F.count_distinct("split").alias("k"), *[F.max((F.col("split") == s).cast("int")).alias(s) for s in ("TRAIN", "VALIDATION", "TEST")])
    d = F.col(date)
    ends = per.agg(
        F.count_if(F.col("k") > 1).alias("dates_in_several_splits"), F.max(F.when(F.col("TRAIN") == 1, d)).alias("a"), F.min(F.when(F.col("VALIDATION") == 1, d)).alias("b"),
        F.max(F.when(F.col("VALIDATION") == 1, d)).alias("c"), F.min(F.when(F.col("TEST") == 1, d)).alias("e"),
    )
    late = lambda x, y: F.coalesce((F.col(x) >= F.col(y)).cast("int"), F.lit(0))
    return ends.select("dates_in_several_splits", late("a", "b").alias("train_overlaps_validation"), late("c", "e").alias("validation_overlaps_test"))


def split_distribution(assignments: DataFrame, target: str) -> DataFrame:
    """Per split: rows, share in percent, positives, negatives, positive percent."""
    g = assignments.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(target) == 1).alias("positives"), F.count_if(F.col(target) == 0).alias("negatives"))
    total = F.sum("rows").over(Window.partitionBy())
    return g.withColumns({"row_pct": 100.0 * F.col("rows") / total, "positive_pct": 100.0 * F.col("positives") / F.col("rows")})


def split_sufficiency(distribution: DataFrame, requested: dict[str, float], minimum: float = 0.05, tolerance: float = 0.03, block: int = 20, warn: int = 50) -> DataFrame:
    """split, severity, code: what blocks or limits an evaluation."""
    want = F.create_map(*[x for s, f in requested.items() for x in (F.lit(s), F.lit(f))])
    share, p = F.col("row_pct") / 100.0, F.col("positives")
    held_out = F.col("split") != "TRAIN"
    rules = [
        (share < minimum, "BLOCK", "FRACTION_BELOW_MINIMUM"),
        (F.abs(share - want[F.col("split")]) > tolerance, "WARN", "FRACTION_OFF_REQUEST"),
        ((p == 0) | (F.col("negatives") == 0), "BLOCK", "ONE_CLASS"),
        (held_out & (p < block), "BLOCK", "FEW_POSITIVES"),
        (held_out & (p >= block) & (p < warn), "WARN", "LIMITED_POSITIVES"),
        (~held_out & (p < warn), "WARN", "LIMITED_TRAIN_POSITIVES"),
    ]
    hits = F.filter(F.array(*[F.when(c, F.struct(F.lit(sev).alias("severity"), F.lit(code).alias("code"))) for c, sev, code in rules]), lambda x: x.isNotNull())
    return distribution.select("split", F.explode(hits).alias("x")).select("split", "x.*")


def fold_boundaries(claims: DataFrame, date: str, fractions: Sequence[float] = (0.55, 0.70, 0.85, 1.0)) -> DataFrame:
    """One row b1..bn: each date closest to its fraction and after the one before; 1.0 is the last date."""
    daily = date_counts(claims, date)
    out: DataFrame | None = None
    for i, f in enumerate(fractions, 1):
        after = out.select(F.col(f"b{i - 1}").alias("__after")) if out is not None else None
        one = daily.agg(F.max("claim_date").alias(f"b{i}")) if f >= 1.0 else _closest(daily, f, after, f"b{i}")
        out = one if out is None else out.crossJoin(one)
    return out


def expanding_folds(train: DataFrame, boundaries: DataFrame, key: str, date: str, folds: int = 3) -> DataFrame:
    """key, fold_id, role: each fold trains on all dates up to its boundary and validates up to the next."""
    j = train.crossJoin(F.broadcast(boundaries))
    d = F.col(date)
    rows = [F.when(d <= F.col(f"b{i}"), F.struct(F.lit(i).alias("fold_id"), F.lit("TRAIN").alias("role"))).when(d <= F.col(f"b{i + 1}"), F.struct(F.lit(i).alias("fold_id"), F.lit("VALIDATION").alias("role"))) for i in range(1, folds + 1)]
    return j.select(key, F.explode(F.filter(F.array(*rows), lambda x: x.isNotNull())).alias("x")).select(key, "x.*")


def fold_sufficiency(folds: DataFrame, targets: DataFrame, key: str, target: str, train_positives: int = 40, validation_positives: int = 10) -> DataFrame:
    """Per fold and role: rows, positives, whether both classes and enough positives are there."""
    least = F.when(F.col("role") == "TRAIN", train_positives).otherwise(validation_positives)
    g = folds.join(targets.select(key, target), key).groupBy("fold_id", "role").agg(F.count(F.lit(1)).alias("rows"), F.sum(target).cast("long").alias("positives"))
    return g.withColumn("sufficient", (F.col("positives") >= least) & (F.col("positives") < F.col("rows")))


#: calibration fold -> (folds it is fitted on, fold it is judged on)
CALIBRATION_FOLDS = {"C1": ((1,), 2), "C2": ((1, 2), 3)}


def calibration_folds(scored: DataFrame) -> DataFrame:
    """Rows of out-of-fold scores (with fold_id) with calibration_fold_id and role."""
    parts = []
    for name, (fit, judge) in CALIBRATION_FOLDS.items():
        role = F.when(F.col("fold_id").isin(*fit), "CALIBRATION_TRAIN").when(F.col("fold_id") == judge, "CALIBRATION_VALIDATION")
        parts.append(scored.withColumns({"calibration_fold_id": F.lit(name), "role": role}).filter("role is not null"))
    return reduce(DataFrame.unionByName, parts)
