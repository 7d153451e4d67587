"""Profiles, quality and audit aggregates.

Columns are brought into long form where several are profiled, so one grouping
serves them all.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from priorwise.functions.exprs import fingerprint, normalize_space, profile_std

from .column_values import column_values
from .quantiles import exact_quantiles

QUANTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
RARE = (1, 5, 10, 20)


def _pct(part: Column, of: Column) -> Column:
    return F.coalesce(F.when(of > 0, 100.0 * part / of), F.lit(0.0))


def digest(text: Column) -> Column:
    """SHA-256 in 32 bytes: texts with one digest count as equal."""
    return F.unhex(F.sha2(text, 256))


def whole_row(df: DataFrame) -> list[Column]:
    """What rows are grouped by when all their columns must agree: the columns if all are of fixed size, else one digest.

    The digest is of the row as JSON, in which values of different columns do
    not run together, nulls are told from texts and -0.0 is 0.0.
    """
    kinds = dict(df.dtypes)
    if not any(k in ("string", "binary") or k.startswith(("array", "struct", "map")) for k in kinds.values()):
        return [F.col(f"`{c}`") for c in df.columns]
    value = lambda c: (F.col(f"`{c}`") + F.lit(0.0).cast(kinds[c])).alias(c) if kinds[c] in ("double", "float") else F.col(f"`{c}`")
    return [digest(F.to_json(F.struct(*[value(c) for c in df.columns]), {"ignoreNullFields": "false"})).alias("row_digest")]


def unpivot(df: DataFrame, columns: Sequence[str], kind: str = "double", keep: Sequence[str] = ()) -> DataFrame:
    """field, value (cast to ``kind``) and the kept columns."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast(kind).alias("value")) for c in columns])).alias("x")
    return df.select(*keep, cells).select(*keep, "x.*")


def profile_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per field: rows, nulls, null_pct, min, max, mean, median, std, zeros, negatives and quantiles (linear)."""
    v = F.col("value")
    long = unpivot(df, columns)
    out = long.groupBy("field").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(v.isNull()).alias("nulls"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), profile_std(v).alias("std"),
        F.count_if(v == 0).alias("zeros"), F.count_if(v < 0).alias("negatives"),
    ).join(exact_quantiles(long, "value", QUANTILES, ["field"]), "field", "left")
    names = {f"p{int(x * 100):02d}": F.get("q", F.lit(i)) for i, x in enumerate(QUANTILES)}
    return out.withColumns({"null_pct": _pct(F.col("nulls"), F.col("rows")), "median": F.get("q", F.lit(3))} | names).drop("q")


def profile_date(df: DataFrame, columns: Sequence[str], reference: Column) -> DataFrame:
    """Per field: rows, nulls, earliest, latest, and how many lie after the reference date."""
    v = F.col("value")
    return unpivot(df, columns, "date").groupBy("field").agg(F.count(F.lit(1)).alias("rows"), F.count_if(v.isNull()).alias("nulls"), F.min(v).alias("earliest"), F.max(v).alias("latest"), F.count_if(v > reference).alias("future_rows"))


def looks_like_date(name: str, kind: str) -> bool:
    """By type, or by a name that ends in date."""
    return kind in ("date", "timestamp") or name.lower().endswith(("_date", "date"))


def profile_text(df: DataFrame, columns: Sequence[str], top: int = 20) -> DataFrame:
    """Per field: distinct and normalised distinct values, top count, rare and single values, lengths, duplicates."""
    long = unpivot(df, columns, "string")
    g = long.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))
    has, n = F.col("value").isNotNull(), F.col("n")
    filled = F.when(has, n)
    length = F.length("value")
    out = g.groupBy("field").agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(~has, n)), F.lit(0)).alias("nulls"), F.count_if(has).alias("distinct_values"), F.count_distinct(F.when(has, normalize_space(F.col("value")))).alias("normalized_distinct"),
        F.coalesce(F.max(filled), F.lit(0)).alias("top_count"), *[F.count_if(has & (n < k)).alias(f"rare_below_{k}") for k in RARE], F.count_if(has & (n == 1)).alias("singletons"),
        F.coalesce(F.sum(F.when(has & (F.trim("value") == ""), n)), F.lit(0)).alias("empty_rows"), F.coalesce(F.sum(F.when(has & (n > 1), n)), F.lit(0)).alias("repeated_rows"),
        (F.sum(length * n) / F.sum(filled)).alias("mean_length"), F.max(F.when(has, length)).alias("max_length"), F.percentile(F.when(has, length), F.lit(0.5), F.when(has, n).otherwise(1)).alias("median_length"),
    )
    return out.withColumns({"repeated_pct": _pct(F.col("repeated_rows"), F.col("rows") - F.col("nulls")), "categorical": F.col("distinct_values") <= max(50, 2 * top)})


def profile_other(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per field the number of distinct values."""
    return unpivot(df, columns, "string").groupBy("field").agg(F.count_distinct("value").alias("distinct_values"))


def top_values(df: DataFrame, column: str, k: int = 10, sensitive: bool = False) -> DataFrame:
    """The k most frequent values, ties by value; sensitive ones as a tag of their hash."""
    v = F.col(column).cast("string")
    g = df.filter(F.col(column).isNotNull()).groupBy(v.alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(k)
    return g.withColumn("value", F.concat(F.lit("<redacted:"), F.substring(F.sha2("value", 256), 1, 12), F.lit(">"))) if sensitive else g


def profile_table(df: DataFrame, name: str, keys: Sequence[str], estimate: int | None = None) -> DataFrame:
    """One row: rows, columns, key and whole-row duplicates, columns with nulls, difference from an estimate."""
    whole = df.groupBy(*whole_row(df)).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))
    by_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").agg(F.count(F.lit(1)).alias("duplicate_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_key_rows"))
    nulls = df.agg(reduce(lambda a, b: a + b, [F.max(F.col(c).isNull().cast("int")) for c in df.columns]).alias("columns_with_nulls"))
    out = whole.crossJoin(by_key).crossJoin(nulls).withColumns({"table_name": F.lit(name), "columns": F.lit(len(df.columns))})
    return out.withColumn("off_estimate", F.col("rows") - F.lit(estimate)) if estimate is not None else out


def missingness_summary(df: DataFrame, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """table_name, field, rows, nulls, null_pct."""
    g = unpivot(df, columns or df.columns, "string").groupBy("field").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("value").isNull()).alias("nulls"))
    return g.withColumns({"table_name": F.lit(name), "null_pct": _pct(F.col("nulls"), F.col("rows"))})


def missingness_by_target(df: DataFrame, target: str, columns: Sequence[str], flag_at: float = 90.0) -> DataFrame:
    """Per field the null share in each class, their difference in points, and whether it leaks."""
    y = F.col(target)
    g = unpivot(df, columns, "string", [target]).groupBy("field").agg(
        *[_pct(F.count_if(F.col("value").isNull() & (y == k)), F.count_if(y == k)).alias(f"null_pct_{k}") for k in (0, 1)])
    diff = F.abs(F.col("null_pct_1") - F.col("null_pct_0"))
    return g.withColumns({"difference": diff, "leaks": diff >= flag_at})


def category_sparsity(df: DataFrame, column: str, target: str, below: int = 20, top: int = 100) -> DataFrame:
    """One row: distinct values, coverage of the top values, rare and single ones, class rate among the top."""
    g = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"), F.sum(target).alias("p"))
    ranked = g.orderBy(F.desc("n"), "v").limit(top).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("top_rows"), F.coalesce(F.sum("p"), F.lit(0)).alias("top_positives"))
    whole = g.agg(F.count(F.lit(1)).alias("distinct_values"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(F.col("n") == 1).alias("singletons"), F.count_if(F.col("n") < below).alias("below_threshold"), F.max("n").alias("largest"))
    out = whole.crossJoin(ranked)
    return out.select(F.lit(column).alias("field"), "distinct_values", "rows", "singletons", "below_threshold", "largest", _pct(F.col("top_rows"), F.col("rows")).alias("top_coverage_pct"), (F.col("top_positives") / F.col("top_rows")).alias("top_positive_rate"))


def point_biserial(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """field, association: (mean1 - mean0) / s * sqrt(n1 n0 / n^2), s with ddof 1; null without both classes or spread."""
    y, v = F.col(target), F.col("value")
    g = unpivot(df, columns, "double", [target]).filter("value is not null").groupBy("field").agg(
        F.avg(F.when(y == 1, v)).alias("a"), F.avg(F.when(y == 0, v)).alias("b"), F.stddev_samp(v).alias("s"), F.count_if(y == 1).alias("n1"), F.count_if(y == 0).alias("n0"))
    n = F.col("n1") + F.col("n0")
    return g.select("field", F.when((F.col("s") > 0) & (F.col("n1") > 0) & (F.col("n0") > 0), (F.col("a") - F.col("b")) / F.col("s") * F.sqrt(F.col("n1") * F.col("n0") / (n * n))).alias("association"))


def cramers_v(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """field, association: uncorrected Cramér's V of value and target, nulls left out."""
    c = unpivot(df, columns, "string", [target]).filter(F.col("value").isNotNull() & F.col(target).isNotNull()).groupBy("field", "value", target).agg(F.count(F.lit(1)).alias("n"))
    # the sums over classes are few and joined back: a window over a class would hold all values of a field
    per_class = c.groupBy("field", target).agg(F.sum("n").alias("k"))
    m = c.withColumn("r", F.sum("n").over(Window.partitionBy("field", "value"))).join(per_class, ["field", target])
    # sum over cells of n^2 / (r k) is chi^2 / N + 1, empty cells included
    g = m.groupBy("field").agg(F.sum(F.col("n") * F.col("n") / (F.col("r") * F.col("k"))).alias("q"), F.count_distinct("value").alias("rows"), F.count_distinct(target).alias("cols"))
    least = F.least(F.col("rows"), F.col("cols")) - 1
    return g.select("field", F.when(least > 0, F.sqrt(F.greatest(F.col("q") - 1, F.lit(0.0)) / least)).alias("association"))


def association_table(df: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str], sensitive: Sequence[str] = ()) -> DataFrame:
    """field, method, association: strongest first, sensitive fields left out."""
    a = point_biserial(df, target, [c for c in numeric if c not in sensitive]).withColumn("method", F.lit("point_biserial"))
    b = cramers_v(df, target, [c for c in categorical if c not in sensitive]).withColumn("method", F.lit("cramers_v"))
    return a.unionByName(b).orderBy(F.desc_nulls_last(F.abs("association")), "field")


def target_rate_range(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Per field the least and greatest class rate of its values, in percent."""
    g = unpivot(df, columns, "string", [target]).groupBy("field", "value").agg((100.0 * F.avg(target)).alias("rate"))
    return g.groupBy("field").agg(F.min("rate").alias("min_rate_pct"), F.max("rate").alias("max_rate_pct"))


def target_profile(df: DataFrame, target: str) -> DataFrame:
    """One row: usable, positive, negative, null and invalid rows, positive percent, balanced at 40 to 60."""
    y = F.col(target)
    out = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(y == 1).alias("positives"), F.count_if(y == 0).alias("negatives"), F.count_if(y.isNull()).alias("nulls"), F.count_if(y.isNotNull() & ~y.isin(0, 1)).alias("invalid"))
    pct = _pct(F.col("positives"), F.col("positives") + F.col("negatives"))
    return out.withColumns({"usable": F.col("positives") + F.col("negatives"), "positive_pct": pct, "balanced": (pct >= 40) & (pct <= 60)})


def group_target_rates(df: DataFrame, target: str, groups: Mapping[str, Column], k: int = 200) -> DataFrame:
    """group_field, group_value (null kept), n, positives, negatives, rate; the k largest per field."""
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("group_field"), c.cast("string").alias("group_value")) for n, c in groups.items()])).alias("x")
    g = df.select(target, cells).groupBy("x.group_field", "x.group_value").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(target) == 1).alias("positives"), F.count_if(F.col(target) == 0).alias("negatives"))
    place = F.row_number().over(Window.partitionBy("group_field").orderBy(F.desc("n"), F.col("group_value").asc_nulls_first()))
    return g.withColumn("place", place).filter(F.col("place") <= k).drop("place").withColumn("rate", F.when(F.col("positives") + F.col("negatives") > 0, F.col("positives") / (F.col("positives") + F.col("negatives"))))


def threshold_separability(df: DataFrame, target: str, columns: Sequence[str], group: str | None = None) -> DataFrame:
    """Per field (and group): least positive, greatest negative value, overlap, midpoint, and rows on the wrong side of it."""
    keys = ["field", *([group] if group else [])]
    long = unpivot(df, columns, "double", [target, *([group] if group else [])]).filter("value is not null")
    y, v = F.col(target), F.col("value")
    ends = long.groupBy(*keys).agg(F.min(F.when(y == 1, v)).alias("min_positive"), F.max(F.when(y == 0, v)).alias("max_negative"))
    ends = ends.withColumns({"overlap": F.col("min_positive") <= F.col("max_negative"), "midpoint": (F.col("min_positive") + F.col("max_negative")) / 2.0})
    e = ends.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    wrong = ((y == 1) & (v < F.col("midpoint"))) | ((y == 0) & (v >= F.col("midpoint")))
    return long.join(e, on).groupBy(*keys, "min_positive", "max_negative", "overlap", "midpoint").agg(F.count_if(wrong).alias("exceptions"), F.count(F.lit(1)).alias("rows"))


def cost_arithmetic(df: DataFrame, total: Column, parts: Column, exact: float = 0.01, near: float = 1.0) -> DataFrame:
    """One row: rows checked, exact, near and off, and the greatest difference."""
    diff = F.abs(total - parts)
    return df.select(diff.alias("d")).filter("d is not null").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("d") <= exact).alias("exact_rows"), F.count_if((F.col("d") > exact) & (F.col("d") <= near)).alias("near_rows"), F.count_if(F.col("d") > near).alias("off_rows"), F.max("d").alias("max_difference"))


def temporal_rules(df: DataFrame, rules: Mapping[str, tuple[Column, Column, str]], key: str) -> DataFrame:
    """rule, severity, rows, violations, percent, first and last key: earlier must not come after later; rules: (earlier, later, severity)."""
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(sev).alias("severity"), (a.isNotNull() & b.isNotNull()).alias("checked"), F.coalesce(a > b, F.lit(False)).alias("bad")) for n, (a, b, sev) in rules.items()])).alias("x")
    g = df.select(F.col(key).alias("k"), cells).groupBy("x.rule", "x.severity").agg(F.count_if("x.checked").alias("rows"), F.count_if("x.bad").alias("violations"), F.min(F.when(F.col("x.bad"), F.col("k"))).alias("first_key"), F.max(F.when(F.col("x.bad"), F.col("k"))).alias("last_key"))
    return g.withColumn("violation_pct", _pct(F.col("violations"), F.col("rows")))


def sequence_quality(df: DataFrame, entity: str, date: str, cumulative: str, order: str, gap_days: int = 31) -> DataFrame:
    """One row: repeated dates per entity, gaps over distinct dates, decreases of a cumulative reading."""
    dates = df.groupBy(entity, date).agg(F.count(F.lit(1)).alias("n"))
    gap = F.date_diff(F.col(date), F.lag(date).over(Window.partitionBy(entity).orderBy(date)))
    a = dates.withColumn("gap", gap).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated_dates"), F.count_if(F.col("gap") > gap_days).alias("gaps"), F.max("gap").alias("longest_gap"))
    step = F.col(cumulative) - F.lag(cumulative).over(Window.partitionBy(entity).orderBy(date, order))
    return a.crossJoin(df.select(step.alias("step")).agg(F.count_if(F.col("step") < 0).alias("decreases")))


def iqr_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per field rows outside the fences of 1.5 interquartile ranges; 0 for under four values or no range."""
    long = unpivot(df, columns).filter("value is not null")
    counts = long.groupBy("field").agg(F.count(F.lit(1)).alias("rows"))
    ends = exact_quantiles(long, "value", (0.25, 0.75), ["field"]).select("field", F.get("q", F.lit(0)).alias("p25"), F.get("q", F.lit(1)).alias("p75"))
    return _outliers(long, counts.join(ends, "field"), F.col("rows"))


def _outliers(long: DataFrame, ends: DataFrame, n: Column) -> DataFrame:
    """Per field of (field, value) the rows outside the fences of its p25 and p75; n: its values."""
    ends = ends.select(F.col("field").alias("__f"), F.col("p25").alias("q1"), F.col("p75").alias("q3"), n.alias("n"))
    iqr = F.col("q3") - F.col("q1")
    out = (F.col("n") >= 4) & (iqr > 0) & ((F.col("value") < F.col("q1") - 1.5 * iqr) | (F.col("value") > F.col("q3") + 1.5 * iqr))
    return long.join(ends, F.col("field") == F.col("__f")).groupBy("field").agg(F.count_if(out).alias("outliers"))


def measurement_quality(df: DataFrame, columns: Sequence[str], at_most: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """Numeric profile with outliers per field; at_most adds a row per rule that one column must not exceed another."""
    base = profile_numeric(df, columns)
    outliers = _outliers(unpivot(df, columns).filter("value is not null"), base, F.col("rows") - F.col("nulls"))
    base = base.select("field", "rows", "nulls", "zeros", "negatives", "min", "max", "p01", "p99").join(outliers, "field", "left")
    base = base.withColumn("exceeding", F.lit(None).cast("long"))
    for name, (small, large) in (at_most or {}).items():
        bad = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(small) > F.col(large)).alias("exceeding")).withColumn("field", F.lit(name))
        base = base.unionByName(bad, allowMissingColumns=True)
    return base


def flag_rate(flag: str) -> Column:
    return F.avg(F.col(flag).cast("double"))


def text_coverage(text: str) -> Column:
    return F.avg((F.col(text).isNotNull() & (F.trim(F.col(text).cast("string")) != "")).cast("double"))


def value_counts(df: DataFrame, column: str, k: int = 20) -> DataFrame:
    """field, value (null kept), n: the k most frequent."""
    return df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.col("value").asc_nulls_first()).limit(k).select(F.lit(column).alias("field"), "value", "n")


def maintenance_quality(df: DataFrame, key: str, date: str, scheduled: str, on_time: str, overdue: str, cost: str) -> DataFrame:
    """One row: rates, dates, repeated keys, on-time rows that are overdue, and a cost summary."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), (F.count(key) - F.count_distinct(key)).alias("repeated_keys"), F.min(date).alias("earliest"), F.max(date).alias("latest"), flag_rate(scheduled).alias("scheduled_rate"), flag_rate(on_time).alias("on_time_rate"),
        F.count_if(F.col(on_time) & (F.col(overdue) > 0)).alias("on_time_but_overdue"), F.avg(cost).alias("mean_cost"), F.percentile(cost, F.lit(0.5)).alias("median_cost"), F.max(cost).alias("max_cost"),
    )


def service_repair_quality(claims: DataFrame, lines: DataFrame, key: str, line_claim: str) -> DataFrame:
    """One row: claims with and without lines, lines without a claim, lines a claim (mean, max)."""
    n = lines.groupBy(F.col(line_claim).alias("__k")).agg(F.count(F.lit(1)).alias("n"))
    j = claims.select(key).join(n, F.col(key) == F.col("__k"), "full_outer")
    return j.agg(F.count_if(F.col(key).isNotNull() & F.col("n").isNotNull()).alias("claims_with_lines"), F.count_if(F.col("n").isNull()).alias("claims_without_lines"), F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("lines_without_claim"), F.avg("n").alias("mean_lines"), F.max("n").alias("max_lines"))


def component_supplier_quality(installs: DataFrame, key: str, component: str, supplier: str, flags: Sequence[str], categories: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """One row of genealogy counts and rates, and the category distributions."""
    counts = installs.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("keys"), F.count_distinct(component).alias("components"), F.count_distinct(supplier).alias("suppliers"), F.count_if(F.col(supplier).isNull()).alias("without_supplier"), *[flag_rate(f).alias(f"{f}_rate") for f in flags])
    return counts, reduce(DataFrame.unionByName, [value_counts(installs, c) for c in categories])


def duplicate_rows(df: DataFrame, name: str) -> DataFrame:
    """One row: rows in groups of equal rows, such groups, largest group."""
    g = df.groupBy(*whole_row(df)).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return g.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_records"), F.count(F.lit(1)).alias("distinct_duplicates"), F.coalesce(F.max("n"), F.lit(0)).alias("max_repeats")).withColumn("table_name", F.lit(name))


def scenario_families(df: DataFrame, scenarios: Mapping[str, Sequence[str]], target: str) -> DataFrame:
    """Per scenario (its columns): families of equal values, repeated ones, largest, and those spanning both classes."""
    parts = []
    for name, columns in scenarios.items():
        g = df.groupBy(fingerprint([F.col(c) for c in columns], 16).alias("family")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(target).alias("classes"))
        parts.append(g.agg(F.lit(name).alias("scenario"), F.count(F.lit(1)).alias("families"), F.count_if(F.col("n") > 1).alias("repeated_families"), F.max("n").alias("max_repeats"), F.count_if(F.col("classes") > 1).alias("spanning_families")))
    return reduce(DataFrame.unionByName, parts)


def identifier_affixes(df: DataFrame, column: str, target: str, size: int = 3, support: int = 5) -> DataFrame:
    """affix, value, n, rate, pure: prefixes and suffixes of an identifier with enough rows."""
    c = F.col(column).cast("string")
    cells = F.explode(F.array(F.struct(F.lit("prefix").alias("affix"), F.substring(c, 1, size).alias("value")), F.struct(F.lit("suffix").alias("affix"), F.substring(c, -size, size).alias("value")))).alias("x")
    g = df.filter(c.isNotNull()).select(target, cells).groupBy("x.affix", "x.value").agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("rate")).filter(F.col("n") >= support)
    return g.withColumn("pure", F.col("rate").isin(0.0, 1.0))


def identifier_numbers(df: DataFrame, column: str, target: str) -> DataFrame:
    """Per quartile of the trailing number (equal edges merged): range, rows, class rate; also rows with a date in them."""
    c = F.col(column).cast("string")
    x = df.select(target, F.regexp_extract(c, r"(\d+)$", 1).try_cast("long").alias("number"), c.rlike(r"20\d{2}(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])").alias("dated")).filter("number is not null")
    edges = x.agg(F.array_distinct(F.percentile("number", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75), F.lit(1.0)))).alias("edges"))
    bucket = F.size(F.filter("edges", lambda e: e < F.col("number"))) + 1
    return x.crossJoin(F.broadcast(edges)).groupBy(bucket.alias("quartile")).agg(F.min("number").alias("low"), F.max("number").alias("high"), F.count(F.lit(1)).alias("n"), F.avg(target).alias("rate"), F.count_if("dated").alias("with_date"))


def group_purity(df: DataFrame, target: str, fields: Sequence[str], support: int = 20, k: int = 100) -> DataFrame:
    """field, hashed value, n, positives, rate, pure, nearly_pure, supported; the k largest per field."""
    g = unpivot(df, fields, "string", [target]).filter("value is not null").groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(target) == 1).alias("positives"))
    place = F.row_number().over(Window.partitionBy("field").orderBy(F.desc("n"), "value"))
    rate = F.col("positives") / F.col("n")
    out = g.withColumn("place", place).filter(F.col("place") <= k)
    return out.select("field", F.substring(F.sha2("value", 256), 1, 12).alias("value_hash"), "n", "positives", rate.alias("rate"), rate.isin(0.0, 1.0).alias("pure"), ((rate <= 0.05) | (rate >= 0.95)).alias("nearly_pure"), (F.col("n") >= support).alias("supported"))


def leakage_diagnostics(df: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Association and missingness by class of columns that are known only after the outcome."""
    return association_table(df, target, numeric, categorical).join(missingness_by_target(df, target, [*numeric, *categorical]), "field")


def text_marks(df: DataFrame, keys: Sequence[str], text: str, words: Sequence[str], normalize: Callable[[Column], Column] = normalize_space) -> DataFrame:
    """keys, t (digest of the normalised text) and w (it holds one of the words), for texts that are not blank."""
    norm = df.select(*keys, normalize(F.col(text)).alias("t")).filter("t <> ''")
    return norm.select(*keys, digest(F.col("t")).alias("t"), reduce(lambda a, b: a | b, [F.contains(F.col("t"), F.lit(w)) for w in words]).alias("w"))


def text_audit(df: DataFrame, text: str, target: str, words: Sequence[str], leak_at: float = 0.8, normalize: Callable[[Column], Column] = normalize_space) -> DataFrame:
    """One row: normalised distinct texts, repeats, outcome-word rate per class, pure and mixed groups, and a leak flag.

    Where the target stands in another table, joining it to :func:`text_marks`
    and going on with :func:`audit_marks` moves no text at all.
    """
    return audit_marks(text_marks(df, [target], text, words, normalize), target, leak_at)


def audit_marks(marks: DataFrame, target: str, leak_at: float = 0.8) -> DataFrame:
    """As :func:`text_audit`, of marks with their target."""
    g = marks.withColumnRenamed(target, "y").groupBy("t").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("y") == 1).alias("p"), F.count_if(F.col("y") == 0).alias("q"), F.max("w").alias("w"))
    n, p, q, w = (F.col(c) for c in "npqw")
    dup = n > 1
    out = g.agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct_texts"), F.coalesce(F.sum(F.when(dup, n)), F.lit(0)).alias("duplicated_rows"), F.max("n").alias("max_repeats"),
        (F.sum(F.when(w, p).otherwise(0)) / F.sum(p)).alias("word_rate_1"), (F.sum(F.when(w, q).otherwise(0)) / F.sum(q)).alias("word_rate_0"),
        F.count_if(dup & ((p == 0) | (q == 0))).alias("pure_groups"), F.count_if(dup & (p > 0) & (q > 0)).alias("mixed_groups"), (F.sum(F.when(dup, F.greatest(p, q))) / F.sum(F.when(dup, p + q))).alias("template_purity"),
    )
    return out.withColumn("leaks", F.coalesce(F.abs(F.col("word_rate_1") - F.col("word_rate_0")) >= leak_at, F.lit(False)))


SEVERITIES = ("INFO", "WARNING", "BLOCKER")


def findings_rollup(metrics: Sequence[tuple[DataFrame, Column, str, str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Findings (code, severity, affected) from metric rows, and one row of status.

    metrics: (frame, condition, code, severity, affected).
    """
    found = reduce(DataFrame.unionByName, [df.filter(cond).select(F.lit(code).alias("code"), F.lit(sev).alias("severity"), n.cast("long").alias("affected")) for df, cond, code, sev, n in metrics])
    status = F.when(F.max(F.col("severity") == "BLOCKER"), "BLOCKED").when(F.max(F.col("severity") == "WARNING"), "READY WITH WARNINGS").otherwise("READY")
    return found, found.agg(status.alias("status"), F.count(F.lit(1)).alias("findings"))


def contract_conformance(df: DataFrame, name: str, contract: Mapping[str, Mapping], keys: Sequence[str]) -> DataFrame:
    """table_name, field, problem, rows: how data depart from a contract.

    contract: column to {type, nullable, length, precision, scale}.
    """
    spark = df.sparkSession
    static = [(name, c, "MISSING_COLUMN", None) for c in contract if c not in df.columns] + [(name, c, "EXTRA_COLUMN", None) for c in df.columns if c not in contract]
    static += [(name, c, "WRONG_TYPE", None) for c, k in df.dtypes if c in contract and "type" in contract[c] and contract[c]["type"] != k]
    checks: list[tuple[str, str, Column]] = []
    for c, rule in contract.items():
        if c not in df.columns:
            continue
        if rule.get("nullable") is False:
            checks.append((c, "NULL", F.count_if(F.col(c).isNull())))
        if "length" in rule:
            checks.append((c, "TOO_LONG", F.count_if(F.length(c) > rule["length"])))
        if "precision" in rule:
            checks.append((c, "OVERFLOW", F.count_if(F.abs(c) >= 10 ** (rule["precision"] - rule.get("scale", 0)))))
    row = df.agg(F.lit(0).alias("x"), *[x.alias(f"c{i}") for i, (_, _, x) in enumerate(checks)])
    cells = [F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("field"), F.lit(p).alias("problem"), F.col(f"c{i}").alias("rows")) for i, (c, p, _) in enumerate(checks)]
    parts = [row.select(F.explode(F.array(*cells)).alias("x")).select("x.*").filter("rows > 0")] if cells else []
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).filter("rows > 0")
    parts.append(dup.select(F.lit(name).alias("table_name"), F.lit(",".join(keys)).alias("field"), F.lit("DUPLICATE_KEY").alias("problem"), "rows"))
    if static:
        parts.append(spark.createDataFrame(static, "table_name string, field string, problem string, rows long"))
    return reduce(DataFrame.unionByName, parts)


def feature_quality(df: DataFrame, columns: Sequence[str], high: int = 1000, unit_ratios: Sequence[str] = (), rows: int | None = None) -> DataFrame:
    """Per feature: nulls, distinct values, range, mean, deviation (ddof 0), and flags.  rows: about as many as there are, counted if not known."""
    return quality_flags(column_values([(df, columns)], df.count() if rows is None else rows), high, unit_ratios)


def quality_flags(told: DataFrame, high: int = 1000, unit_ratios: Sequence[str] = ()) -> DataFrame:
    """Adds the flags of :func:`feature_quality` to what :func:`column_values` gives."""
    bad = F.col("feature").isin(*unit_ratios) & ((F.col("min") < 0) | (F.col("max") > 1)) if unit_ratios else F.lit(False)
    return told.withColumns({"all_null": F.col("distinct_values") == 0, "constant": F.col("distinct_values") == 1, "high_cardinality": F.col("distinct_values") > high, "ratio_out_of_range": F.coalesce(bad, F.lit(False))})


def policy_coverage(columns: DataFrame, policy: DataFrame) -> DataFrame:
    """table_name, column_name, problem or policy: UNCLASSIFIED, UNKNOWN, DUPLICATE, else the policy."""
    p = policy.groupBy("table_name", "column_name").agg(F.count(F.lit(1)).alias("n"), F.min("policy").alias("policy"))
    j = columns.withColumn("present", F.lit(True)).join(p, ["table_name", "column_name"], "full_outer")
    status = F.when(F.col("n").isNull(), "UNCLASSIFIED").when(F.col("present").isNull(), "UNKNOWN").when(F.col("n") > 1, "DUPLICATE").otherwise(F.col("policy"))
    return j.select("table_name", "column_name", status.alias("status"))


def leakage_name_scan(features: DataFrame, blacklist: DataFrame) -> DataFrame:
    """feature, source, pattern: sources that equal a blacklisted name or lie under a ``table.*`` pattern."""
    b = blacklist.select("pattern", F.regexp_replace("pattern", r"\*$", "").alias("stem"), F.endswith("pattern", F.lit("*")).alias("open"))
    exact = features.join(b.filter("not open"), F.col("source") == F.col("stem"))
    # a pattern covers a table, so its part before the dot is an equi-join key
    under = features.withColumn("t", F.substring_index("source", ".", 1)).join(b.filter("open").withColumn("u", F.substring_index("stem", ".", 1)), (F.col("t") == F.col("u")) & F.startswith(F.col("source"), F.col("stem")))
    return exact.select("feature", "source", "pattern").unionByName(under.select("feature", "source", "pattern"))


def source_drift(df: DataFrame, target: str, expected: Mapping[str, int]) -> DataFrame:
    """field, actual, expected, delta for total, positives and negatives."""
    y = F.col(target)
    row = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(y == 1).alias("positives"), F.count_if(y == 0).alias("negatives"))
    cells = [F.struct(F.lit(k).alias("field"), F.col(k).alias("actual"), F.lit(v).cast("long").alias("expected"), (F.col(k) - v).alias("delta")) for k, v in expected.items()]
    return row.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


def table_columns(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, column_name of some frames."""
    return spark.createDataFrame([(t, c) for t, df in tables.items() for c in df.columns], "table_name string, column_name string")
