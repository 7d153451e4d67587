"""Exact quantiles and their ranges of values, in bounded memory.

Values are collapsed to distinct ones with counts, and a group's values are cut
into ranges of about equally many distinct ones.  Only the ranges that hold a
wanted rank are put in order, so no task and no buffer holds all distinct
values of a group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

#: ranges that a group's values are cut into: 8 coarse ones, 16 in each
COARSE, FINE = 8, 16
VALUE_RANGES = COARSE * FINE


def _same(groups: Sequence[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"{prefix}{g}")) for g in groups], F.lit(True))


def in_ranges(counts: DataFrame, groups: Sequence[str], value: str = "v") -> DataFrame:
    """Adds range, which rises with the value; counts: one row a distinct value of a group, not null."""
    edges = counts.groupBy(*[F.col(g).alias(f"__e_{g}") for g in groups]).agg(F.percentile_approx(value, [k / VALUE_RANGES for k in range(1, VALUE_RANGES)]).alias("__edges"))
    joined = counts.join(edges, _same(groups, "__e_"))
    passed = lambda edges: F.size(F.filter(edges, lambda e: e <= F.col(value)))
    coarse = passed(F.array(*[F.get("__edges", F.lit(k * FINE - 1)) for k in range(1, COARSE)]))
    x = joined.withColumn("__coarse", coarse)
    return x.select(*counts.columns, (F.col("__coarse") * FINE + passed(F.slice("__edges", F.col("__coarse") * FINE + 1, F.lit(FINE - 1)))).alias("range"))


def value_counts(df: DataFrame, value: str, groups: Sequence[str] = ()) -> DataFrame:
    """groups, v, n: distinct values that are not null."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*groups, F.col(value).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    # the filter keeps the count in every use of this frame, so that its exchange is made once
    return counts.filter("n > 0")


def exact_quantiles(df: DataFrame, value: str, parts: Sequence[float], groups: Sequence[str] = ()) -> DataFrame:
    """Per group q: the quantiles of the values that are not null, linear between neighbours.

    A group without a value has no row; without groups and values there is no
    row either.  parts: shares from 0 to 1.
    """
    return quantiles_of(in_ranges(value_counts(df, value, groups), groups), parts, groups)


def quantiles_of(x: DataFrame, parts: Sequence[float], groups: Sequence[str] = ()) -> DataFrame:
    """As :func:`exact_quantiles`, of counts: groups, v, n and range, which rises with v."""
    order = Window.partitionBy(*groups).orderBy("range")
    sums = x.groupBy(*groups, "range").agg(F.sum("n").alias("rn"))
    sums = sums.withColumns({"before": F.coalesce(F.sum("rn").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "total": F.sum("rn").over(Window.partitionBy(*groups))})
    place = lambda q: (F.col("total") - 1) * F.lit(float(q))
    ranks = F.array_distinct(F.array(*[f(place(q)).cast("long") for q in parts for f in (F.floor, F.ceil)]))
    here = F.filter(ranks, lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("rn")))
    wanted = sums.select(*[F.col(g).alias(f"__w_{g}") for g in groups], F.col("range").alias("__range"), "before", "total", here.alias("ranks")).filter(F.size("ranks") > 0)
    # wanted has at most two rows a part and group
    y = x.join(wanted, _same(groups, "__w_") & (F.col("range") == F.col("__range")))
    upto = F.col("before") + F.sum("n").over(Window.partitionBy(*groups, "range").orderBy("v"))
    y = y.withColumn("upto", upto).select(*groups, "total", "v", F.explode(F.filter("ranks", lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("n")))).alias("rank"))
    found = y.groupBy(*groups, "total").agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"))

    def quantile(q: float) -> Column:
        p = place(q)
        a, b = F.try_element_at("at", F.floor(p).cast("long")), F.try_element_at("at", F.ceil(p).cast("long"))
        return F.when(a == b, a).otherwise((F.ceil(p) - p) * a + (p - F.floor(p)) * b)

    return found.select(*groups, F.array(*[quantile(q) for q in parts]).alias("q"))
