"""Queries for profiles, quality and audits (C)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from priorwise.functions.exprs import normalize_space
from priorwise.operators import keys as K, profile as P, textfeatures as T

from .bindings import ANCHORS, INSTALLS, LINES, MONTHS, anchors, ctes, installs, lines, months, table
from .feature_queries import rounded
from .registry import query

_NUM = ["qty", "cents", "discount_pct"]


def _long(rel: str, cols, kind: str, more: str = "") -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS field, CAST({c} AS {kind}) AS value{more} FROM {rel}" for c in cols)


@query("c01_profile_numeric", f"""{ctes(LINES)}, l AS ({_long('lines', _NUM, 'DOUBLE')}) SELECT field, count(*) AS rows, count(*) - count(value) AS nulls, min(value) AS min, max(value) AS max, round(avg(value), 6) AS mean,
  round(CASE WHEN count(value) = 1 THEN 0.0 ELSE stddev_samp(value) END, 6) AS std, count(*) FILTER (value = 0) AS zeros, count(*) FILTER (value < 0) AS negatives, round(100.0 * (count(*) - count(value)) / count(*), 6) AS null_pct, round(quantile_cont(value, 0.5), 6) AS median,
  {', '.join(f"round(quantile_cont(value, {q}), 6) AS p{int(q * 100):02d}" for q in P.QUANTILES)} FROM l GROUP BY field""")
def c01(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.profile_numeric(lines(spark, d), _NUM))


@query("c02_profile_date", f"""{ctes(ANCHORS)} SELECT 'claim_date' AS field, count(*) AS rows, count(*) - count(claim_date) AS nulls, min(claim_date) AS earliest, max(claim_date) AS latest, count(*) FILTER (claim_date > DATE '2000-01-01') AS future_rows FROM anchors""", dates=["earliest", "latest"])
def c02(spark: SparkSession, d: str) -> DataFrame:
    return P.profile_date(anchors(spark, d), ["claim_date"], F.to_date(F.lit("2000-01-01")))


_TXT = ["p_name", "p_brand", "p_type"]


@query("c03_profile_text", f"""WITH l AS ({_long('part', _TXT, 'VARCHAR')}), g AS (SELECT field, value, count(*) AS n FROM l GROUP BY 1, 2)
SELECT field, CAST(sum(n) AS BIGINT) AS rows, CAST(coalesce(sum(n) FILTER (value IS NULL), 0) AS BIGINT) AS nulls, count(value) AS distinct_values, count(DISTINCT lower(trim(regexp_replace(value, '\\s+', ' ', 'g')))) AS normalized_distinct, max(n) FILTER (value IS NOT NULL) AS top_count,
  {', '.join(f"count(*) FILTER (value IS NOT NULL AND n < {k}) AS rare_below_{k}" for k in P.RARE)}, count(*) FILTER (value IS NOT NULL AND n = 1) AS singletons, CAST(coalesce(sum(n) FILTER (trim(value) = ''), 0) AS BIGINT) AS empty_rows, CAST(coalesce(sum(n) FILTER (value IS NOT NULL AND n > 1), 0) AS BIGINT) AS repeated_rows,
  round(sum(length(value) * n) / CAST(sum(n) FILTER (value IS NOT NULL) AS DOUBLE), 6) AS mean_length, max(length(value)) AS max_length, (SELECT round(quantile_cont(length(value), 0.5), 6) FROM l WHERE l.field = g.field) AS median_length,
  round(100.0 * coalesce(sum(n) FILTER (value IS NOT NULL AND n > 1), 0) / sum(n) FILTER (value IS NOT NULL), 6) AS repeated_pct, count(value) <= 50 AS categorical FROM g GROUP BY field""")
def c03(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.profile_text(table(spark, d, "part"), _TXT))


@query("c04_top_values_redacted", "SELECT '<redacted:' || substr(sha256(CAST(value AS VARCHAR)), 1, 12) || '>' AS value, n FROM (SELECT o_custkey AS value, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, CAST(value AS VARCHAR) LIMIT 10)")
def c04(spark: SparkSession, d: str) -> DataFrame:
    return P.top_values(table(spark, d, "orders"), "o_custkey", 10, sensitive=True)


def _folded(text: str) -> str:
    """Case folding of Latin letters in SQL; tests compare with full case folding."""
    return rf"trim(regexp_replace(replace(lower(coalesce({text}, '')), 'ß', 'ss'), '\s+', ' ', 'g'))"


@query("c05_normalize_ws", f"SELECT item_id, {_folded('text')} AS t FROM benchmark")
def c05(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "benchmark").select("item_id", T.fold_space("text").alias("t"))


@query("c06_profile_other", f"{ctes(LINES)} SELECT 'returned' AS field, count(DISTINCT returned) AS distinct_values FROM lines UNION ALL SELECT 'line_status', count(DISTINCT line_status) FROM lines")
def c06(spark: SparkSession, d: str) -> DataFrame:
    return P.profile_other(lines(spark, d), ["returned", "line_status"])


def _table_sql(t: str, cols: list[str], keys: list[str], estimate: int) -> str:
    nulls = " + ".join(f"max(CAST({c} IS NULL AS INTEGER))" for c in cols)
    return f"""SELECT '{t}' AS table_name, {len(cols)} AS columns, (SELECT count(*) FROM {t}) AS rows, (SELECT count(*) FROM {t}) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(cols)} FROM {t})) AS duplicate_rows,
      (SELECT count(*) FROM (SELECT 1 FROM {t} GROUP BY {', '.join(keys)} HAVING count(*) > 1)) AS duplicate_keys, (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM {t} GROUP BY {', '.join(keys)} HAVING count(*) > 1)) AS duplicate_key_rows,
      (SELECT {nulls} FROM {t}) AS columns_with_nulls, (SELECT count(*) FROM {t}) - {estimate} AS off_estimate"""


_TABLES = {"supplier": (["s_suppkey", "s_name", "s_nationkey", "s_acctbal"], ["s_suppkey"], 100), "lineitem": (["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], ["l_orderkey", "l_linenumber"], 60000)}


@query("c07_profile_table", " UNION ALL ".join(_table_sql(t, *x) for t, x in _TABLES.items()))
def c07(spark: SparkSession, d: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [P.profile_table(table(spark, d, t).select(*c), t, k, n) for t, (c, k, n) in _TABLES.items()])


_ODD = "odd AS (SELECT claim_key, target, CASE WHEN total_cents % 3 > 0 THEN total_cents END AS cents, CASE WHEN target = 1 OR total_cents % 20 = 0 THEN priority END AS priority FROM anchors)"


def _odd(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("total_cents")
    return anchors(spark, d).select("claim_key", "target", F.when(t % 3 > 0, t).alias("cents"), F.when((F.col("target") == 1) | (t % 20 == 0), F.col("priority")).alias("priority"))


@query("c08_missingness_summary", f"""{ctes(ANCHORS, _ODD)} SELECT 'claims' AS table_name, f.field, count(*) AS rows, count(*) - count(value) AS nulls, round(100.0 * (count(*) - count(value)) / count(*), 6) AS null_pct
FROM ({_long('odd', ['claim_key', 'cents', 'priority'], 'VARCHAR')}) f GROUP BY f.field""")
def c08(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.missingness_summary(_odd(spark, d), "claims", ["claim_key", "cents", "priority"]))


_NULLS = f"""g AS (SELECT field, round(100.0 * count(*) FILTER (value IS NULL AND target = 0) / count(*) FILTER (target = 0), 6) AS null_pct_0, round(100.0 * count(*) FILTER (value IS NULL AND target = 1) / count(*) FILTER (target = 1), 6) AS null_pct_1
FROM ({_long('odd', ['cents', 'priority'], 'VARCHAR', ', target')}) GROUP BY field), nulls AS (SELECT *, round(abs(null_pct_1 - null_pct_0), 5) AS difference, abs(null_pct_1 - null_pct_0) >= 90 AS leaks FROM g)"""


@query("c09_missingness_by_target", f"{ctes(ANCHORS, _ODD, _NULLS)} SELECT * FROM nulls")
def c09(spark: SparkSession, d: str) -> DataFrame:
    out = rounded(P.missingness_by_target(_odd(spark, d), "target", ["cents", "priority"]))
    return out.withColumn("difference", F.round(F.abs(F.col("null_pct_1") - F.col("null_pct_0")), 5))


@query("c10_category_sparsity", f"""{ctes(ANCHORS)}, g AS (SELECT entity_key AS v, count(*) AS n, sum(target) AS p FROM anchors GROUP BY 1), t AS (SELECT sum(n) AS n, sum(p) AS p FROM (SELECT * FROM g ORDER BY n DESC, v LIMIT 100))
SELECT 'entity_key' AS field, count(*) AS distinct_values, CAST(sum(g.n) AS BIGINT) AS rows, count(*) FILTER (g.n = 1) AS singletons, count(*) FILTER (g.n < 20) AS below_threshold, max(g.n) AS largest, round(100.0 * any_value(t.n) / sum(g.n), 6) AS top_coverage_pct, round(any_value(t.p) / CAST(any_value(t.n) AS DOUBLE), 6) AS top_positive_rate FROM g, t""")
def c10(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.category_sparsity(anchors(spark, d), "entity_key", "target"))


def _associations(rel: str, numeric: list[str], categorical: list[str]) -> str:
    """pb and cv, the two kinds of association with the target."""
    return f"""pb AS (SELECT field, round((avg(value) FILTER (target = 1) - avg(value) FILTER (target = 0)) / stddev_samp(value) * sqrt(count(*) FILTER (target = 1) * count(*) FILTER (target = 0) / (CAST(count(*) AS DOUBLE) * count(*))), 6) AS association FROM ({_long(rel, numeric, 'DOUBLE', ', target')}) WHERE value IS NOT NULL GROUP BY field),
cells AS (SELECT field, value, target, count(*) AS n FROM ({_long(rel, categorical, 'VARCHAR', ', target')}) WHERE value IS NOT NULL GROUP BY 1, 2, 3),
cv AS (SELECT field, round(sqrt(greatest(sum(n * n / CAST(r * k AS DOUBLE)) - 1, 0) / (least(count(DISTINCT value), count(DISTINCT target)) - 1)), 6) AS association FROM (SELECT *, sum(n) OVER (PARTITION BY field, value) AS r, sum(n) OVER (PARTITION BY field, target) AS k FROM cells) GROUP BY field)"""


@query("c11_c12_c14_association", f"{ctes(ANCHORS, _associations('anchors', ['total_cents', 'entity_key'], ['priority', 'entity_key']))} SELECT field, 'point_biserial' AS method, association + 0.0 AS association FROM pb UNION ALL SELECT field, 'cramers_v', association + 0.0 FROM cv")
def c14(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.association_table(anchors(spark, d), "target", ["total_cents", "entity_key"], ["priority", "entity_key", "claim_key"], ["claim_key"]))


@query("c13_target_rate_range", f"{ctes(ANCHORS)} SELECT 'priority' AS field, round(min(r), 6) AS min_rate_pct, round(max(r), 6) AS max_rate_pct FROM (SELECT priority, 100.0 * avg(target) AS r FROM anchors GROUP BY 1)")
def c13(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.target_rate_range(anchors(spark, d), "target", ["priority"]))


@query("c15_target_profile", f"{ctes(ANCHORS)} SELECT count(*) AS rows, count(*) FILTER (target = 1) AS positives, count(*) FILTER (target = 0) AS negatives, count(*) FILTER (target IS NULL) AS nulls, 0 AS invalid, count(target) AS usable, round(100.0 * sum(target) / count(target), 6) AS positive_pct, 100.0 * sum(target) / count(target) BETWEEN 40 AND 60 AS balanced FROM anchors")
def c15(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.target_profile(anchors(spark, d), "target"))


_GROUPS = "SELECT 'priority' AS f, priority AS v, target FROM anchors UNION ALL SELECT 'month', strftime(claim_date, '%Y-%m'), target FROM anchors UNION ALL SELECT 'year', CAST(year(claim_date) AS VARCHAR), target FROM anchors"


@query("c16_group_target_rates", f"""{ctes(ANCHORS)}, g AS (SELECT f AS group_field, v AS group_value, count(*) AS n, count(*) FILTER (target = 1) AS positives, count(*) FILTER (target = 0) AS negatives FROM ({_GROUPS}) GROUP BY 1, 2)
SELECT *, round(positives / CAST(positives + negatives AS DOUBLE), 6) AS rate FROM g QUALIFY row_number() OVER (PARTITION BY group_field ORDER BY n DESC, group_value) <= 50""")
def c16(spark: SparkSession, d: str) -> DataFrame:
    groups = {"priority": F.col("priority"), "month": F.date_format("claim_date", "yyyy-MM"), "year": F.year("claim_date")}
    return rounded(P.group_target_rates(anchors(spark, d), "target", groups, 50))


def _sep(group: str) -> str:
    g = f", {group}" if group else ""
    j = f" AND l.{group} IS NOT DISTINCT FROM e.{group}" if group else ""
    sel = f"l.{group}, " if group else ""
    return f"""l AS ({_long('anchors', ['total_cents'], 'DOUBLE', ', target' + g)}), e AS (SELECT field{g}, min(value) FILTER (target = 1) AS min_positive, max(value) FILTER (target = 0) AS max_negative FROM l GROUP BY field{g})
      SELECT l.field, {sel}min_positive, max_negative, min_positive <= max_negative AS overlap, (min_positive + max_negative) / 2 AS midpoint, count(*) FILTER ((target = 1 AND value < (min_positive + max_negative) / 2) OR (target = 0 AND value >= (min_positive + max_negative) / 2)) AS exceptions, count(*) AS rows
      FROM l JOIN e ON l.field = e.field{j} GROUP BY ALL"""


@query("c17_threshold_separability", f"{ctes(ANCHORS)}, {_sep('')}")
def c17(spark: SparkSession, d: str) -> DataFrame:
    return P.threshold_separability(anchors(spark, d), "target", ["total_cents"])


@query("c18_grouped_separability", f"{ctes(ANCHORS)}, {_sep('priority')}")
def c18(spark: SparkSession, d: str) -> DataFrame:
    return P.threshold_separability(anchors(spark, d), "target", ["total_cents"], "priority")


@query("c19_cost_arithmetic", """SELECT count(*) AS rows, count(*) FILTER (d <= 1) AS exact_rows, count(*) FILTER (d > 1 AND d <= 500) AS near_rows, count(*) FILTER (d > 500) AS off_rows, max(d) AS max_difference FROM
(SELECT abs(CAST(round(l_extendedprice * 100) AS BIGINT) - CAST(l_quantity AS BIGINT) * CAST(round(p_retailprice * 100) AS BIGINT)) AS d FROM lineitem JOIN part ON l_partkey = p_partkey)""")
def c19(spark: SparkSession, d: str) -> DataFrame:
    cents = lambda c: F.round(F.col(c) * 100).cast("long")
    j = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return P.cost_arithmetic(j, cents("l_extendedprice"), F.col("l_quantity").cast("long") * cents("p_retailprice"), 1, 500)


@query("c20_temporal_rules", f"""{ctes(ANCHORS, LINES)}, j AS (SELECT event_key, claim_date, event_date FROM lines JOIN anchors ON order_key = claim_key)
SELECT 'shipped_after_order' AS rule, 'WARNING' AS severity, count(*) AS rows, count(*) FILTER (claim_date > event_date) AS violations, min(event_key) FILTER (claim_date > event_date) AS first_key, max(event_key) FILTER (claim_date > event_date) AS last_key, round(100.0 * count(*) FILTER (claim_date > event_date) / count(*), 6) AS violation_pct FROM j
UNION ALL SELECT 'shipped_within_five_years', 'INFO', count(*), count(*) FILTER (event_date > claim_date + 1826), min(event_key) FILTER (event_date > claim_date + 1826), max(event_key) FILTER (event_date > claim_date + 1826), round(100.0 * count(*) FILTER (event_date > claim_date + 1826) / count(*), 6) FROM j""")
def c20(spark: SparkSession, d: str) -> DataFrame:
    j = lines(spark, d).join(anchors(spark, d).select("claim_key", "claim_date"), F.col("order_key") == F.col("claim_key"))
    rules = {"shipped_after_order": (F.col("claim_date"), F.col("event_date"), "WARNING"), "shipped_within_five_years": (F.col("event_date"), F.date_add("claim_date", 1826), "INFO")}
    return rounded(P.temporal_rules(j, rules, "event_key"))


@query("c21_sequence_quality", f"""{ctes(LINES, MONTHS)}, g AS (SELECT n - 1 AS extra, month_start - lag(month_start) OVER (PARTITION BY entity_key ORDER BY month_start) AS gap FROM (SELECT entity_key, month_start, count(*) AS n FROM months GROUP BY 1, 2)),
s AS (SELECT qty - lag(qty) OVER (PARTITION BY entity_key ORDER BY month_start, month_key) AS step FROM months)
SELECT (SELECT CAST(sum(extra) AS BIGINT) FROM g) AS repeated_dates, (SELECT count(*) FROM g WHERE gap > 31) AS gaps, (SELECT max(gap) FROM g) AS longest_gap, (SELECT count(*) FROM s WHERE step < 0) AS decreases""")
def c21(spark: SparkSession, d: str) -> DataFrame:
    return P.sequence_quality(months(spark, d), "entity_key", "month_start", "qty", "month_key")


@query("c22_c23_measurement_quality", f"""{ctes(LINES)}, l AS ({_long('lines', ['qty', 'cents'], 'DOUBLE')}), e AS (SELECT field, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM l GROUP BY 1)
SELECT field, count(*) AS rows, count(*) - count(value) AS nulls, count(*) FILTER (value = 0) AS zeros, count(*) FILTER (value < 0) AS negatives, min(value) AS min, max(value) AS max, round(quantile_cont(value, 0.01), 6) AS p01, round(quantile_cont(value, 0.99), 6) AS p99,
  count(*) FILTER (value < q1 - 1.5::DOUBLE * (q3 - q1) OR value > q3 + 1.5::DOUBLE * (q3 - q1)) AS outliers, CAST(NULL AS BIGINT) AS exceeding FROM l JOIN e USING (field) GROUP BY field
UNION ALL SELECT 'discount_over_qty', count(*), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(*) FILTER (discount_pct > qty) FROM lines""")
def c22(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.measurement_quality(lines(spark, d), ["qty", "cents"], {"discount_over_qty": ("discount_pct", "qty")}))


@query("c24_c27_maintenance_quality", f"""{ctes(LINES)} SELECT count(*) AS rows, count(event_key) - count(DISTINCT event_key) AS repeated_keys, min(event_date) AS earliest, max(event_date) AS latest, round(avg(CAST(part_key % 2 = 0 AS INTEGER)), 6) AS scheduled_rate, round(avg(CAST(returned AS INTEGER)), 6) AS on_time_rate,
count(*) FILTER (returned AND discount_pct > 0) AS on_time_but_overdue, round(avg(cents), 6) AS mean_cost, round(quantile_cont(cents, 0.5), 6) AS median_cost, max(cents) AS max_cost FROM lines""", dates=["earliest", "latest"])
def c24(spark: SparkSession, d: str) -> DataFrame:
    x = lines(spark, d).withColumn("scheduled", F.col("part_key") % 2 == 0)
    return rounded(P.maintenance_quality(x, "event_key", "event_date", "scheduled", "returned", "discount_pct", "cents"))


@query("c25_service_repair_quality", f"""{ctes(ANCHORS, LINES)}, n AS (SELECT order_key, count(*) AS n FROM lines GROUP BY 1) SELECT count(*) FILTER (claim_key IS NOT NULL AND n IS NOT NULL) AS claims_with_lines, count(*) FILTER (n IS NULL) AS claims_without_lines, CAST(coalesce(sum(n) FILTER (claim_key IS NULL), 0) AS BIGINT) AS lines_without_claim, round(avg(n), 6) AS mean_lines, max(n) AS max_lines FROM anchors FULL JOIN n ON claim_key = order_key""")
def c25(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.service_repair_quality(anchors(spark, d), lines(spark, d), "claim_key", "order_key"))


@query("c26_component_supplier", f"{ctes(LINES, INSTALLS)} SELECT count(*) AS rows, count(DISTINCT event_key) AS keys, count(DISTINCT part_key) AS components, count(DISTINCT supp_key) AS suppliers, count(*) - count(supp_key) AS without_supplier, round(avg(CAST(returned AS INTEGER)), 6) AS returned_rate FROM installs")
def c26(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.component_supplier_quality(installs(spark, d), "event_key", "part_key", "supp_key", ["returned"], ["category"])[0])


@query("c26_component_categories", f"{ctes(LINES, INSTALLS)} SELECT * FROM (SELECT 'category' AS field, category AS value, count(*) AS n FROM installs GROUP BY 2 ORDER BY n DESC, value LIMIT 20) UNION ALL SELECT * FROM (SELECT 'system', system, count(*) AS n FROM installs GROUP BY 2 ORDER BY n DESC, system LIMIT 20)")
def c26_categories(spark: SparkSession, d: str) -> DataFrame:
    return P.component_supplier_quality(installs(spark, d), "event_key", "part_key", "supp_key", ["returned"], ["category", "system"])[1]


@query("c28_duplicate_rows", "SELECT 'lineitem' AS table_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_records, count(*) AS distinct_duplicates, coalesce(max(n), 0) AS max_repeats FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")
def c28(spark: SparkSession, d: str) -> DataFrame:
    return P.duplicate_rows(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), "lineitem")


def _fam(name: str, cols: list[str]) -> str:
    return f"SELECT '{name}' AS scenario, count(*) AS families, count(*) FILTER (n > 1) AS repeated_families, max(n) AS max_repeats, count(*) FILTER (c > 1) AS spanning_families FROM (SELECT count(*) AS n, count(DISTINCT target) AS c FROM anchors GROUP BY {', '.join(cols)})"


_SCENARIOS = {"entity_day": ["entity_key", "claim_date"], "priority_day": ["priority", "claim_date"], "entity": ["entity_key"]}


@query("c29_scenario_families", f"{ctes(ANCHORS)} {' UNION ALL '.join(_fam(n, c) for n, c in _SCENARIOS.items())}")
def c29(spark: SparkSession, d: str) -> DataFrame:
    return P.scenario_families(anchors(spark, d), _SCENARIOS, "target")


@query("c30_identifier_affixes", f"{ctes(ANCHORS)}, i AS (SELECT 'C' || (claim_key + 100000) AS id, target FROM anchors) SELECT affix, value, n, round(rate, 6) AS rate, rate IN (0.0, 1.0) AS pure FROM (SELECT affix, value, count(*) AS n, avg(target) AS rate FROM (SELECT 'prefix' AS affix, substr(id, 1, 3) AS value, target FROM i UNION ALL SELECT 'suffix', right(id, 3), target FROM i) GROUP BY 1, 2) WHERE n >= 5")
def c30(spark: SparkSession, d: str) -> DataFrame:
    ids = anchors(spark, d).select("target", F.concat(F.lit("C"), F.col("claim_key") + 100000).alias("id"))
    return rounded(P.identifier_affixes(ids, "id", "target"))


@query("c30_identifier_numbers", f"""{ctes(ANCHORS)}, i AS (SELECT claim_key + 20000000 AS number, 'C' || (claim_key + 20000000) AS id, target FROM anchors), e AS (SELECT quantile_cont(number, 0.25) AS a, quantile_cont(number, 0.5) AS b, quantile_cont(number, 0.75) AS c FROM i)
SELECT 1 + CAST(a < number AS INTEGER) + CAST(b < number AS INTEGER) + CAST(c < number AS INTEGER) AS quartile, min(number) AS low, max(number) AS high, count(*) AS n, round(avg(target), 6) AS rate, count(*) FILTER (regexp_matches(id, '20[0-9]{{2}}(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])')) AS with_date FROM i, e GROUP BY 1""")
def c30_numbers(spark: SparkSession, d: str) -> DataFrame:
    ids = anchors(spark, d).select("target", F.concat(F.lit("C"), F.col("claim_key") + 20000000).alias("id"))
    return rounded(P.identifier_numbers(ids, "id", "target"))


@query("c31_group_purity", f"""{ctes(ANCHORS)}, g AS (SELECT field, value, count(*) AS n, count(*) FILTER (target = 1) AS positives FROM ({_long('anchors', ['priority', 'entity_key'], 'VARCHAR', ', target')}) WHERE value IS NOT NULL GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY field ORDER BY count(*) DESC, value) <= 100)
SELECT field, substr(sha256(value), 1, 12) AS value_hash, n, positives, round(positives / CAST(n AS DOUBLE), 6) AS rate, positives IN (0, n) AS pure, positives / CAST(n AS DOUBLE) <= 0.05 OR positives / CAST(n AS DOUBLE) >= 0.95 AS nearly_pure, n >= 20 AS supported FROM g""")
def c31(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.group_purity(anchors(spark, d), "target", ["priority", "entity_key"]))


@query("c32_leakage_diagnostics", f"""{ctes(ANCHORS, _ODD, _NULLS, _associations('odd', ['cents'], ['priority']))} SELECT a.*, nulls.* EXCLUDE (field)
FROM (SELECT field, association + 0.0 AS association, 'point_biserial' AS method FROM pb UNION ALL SELECT field, association + 0.0, 'cramers_v' FROM cv) a JOIN nulls USING (field)""")
def c32(spark: SparkSession, d: str) -> DataFrame:
    out = rounded(P.leakage_diagnostics(_odd(spark, d), "target", ["cents"], ["priority"]))
    return out.withColumn("difference", F.round(F.abs(F.col("null_pct_1") - F.col("null_pct_0")), 5))


@query("c33_text_audit", r"""WITH m AS (SELECT quality AS y, """ + _folded("text") + r""" AS t FROM documents JOIN labels USING (doc_id)),
g AS (SELECT t, count(*) AS n, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS q, contains(t, 'the') OR contains(t, '$$$') AS w FROM m WHERE t <> '' GROUP BY t)
SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_texts, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS duplicated_rows, max(n) AS max_repeats, round(sum(CASE WHEN w THEN p ELSE 0 END) / CAST(sum(p) AS DOUBLE), 6) AS word_rate_1, round(sum(CASE WHEN w THEN q ELSE 0 END) / CAST(sum(q) AS DOUBLE), 6) AS word_rate_0,
count(*) FILTER (n > 1 AND (p = 0 OR q = 0)) AS pure_groups, count(*) FILTER (n > 1 AND p > 0 AND q > 0) AS mixed_groups, round(sum(greatest(p, q)) FILTER (n > 1) / CAST(sum(p + q) FILTER (n > 1) AS DOUBLE), 6) AS template_purity,
coalesce(abs(sum(CASE WHEN w THEN p ELSE 0 END) / CAST(sum(p) AS DOUBLE) - sum(CASE WHEN w THEN q ELSE 0 END) / CAST(sum(q) AS DOUBLE)) >= 0.8, FALSE) AS leaks FROM g""")
def c33(spark: SparkSession, d: str) -> DataFrame:
    """Every labelled document; what is joined and grouped of a text is its digest."""
    marks = T.folded_marks(table(spark, d, "documents"), ["doc_id"], "text", ["the", "$$$"])
    return rounded(P.audit_marks(marks.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id"), "quality"))


@query("c34_findings_rollup", f"""{ctes(ANCHORS, LINES)} SELECT CASE WHEN dup > 0 THEN 'BLOCKED' WHEN late > 0 THEN 'READY WITH WARNINGS' ELSE 'READY' END AS status, CAST(dup > 0 AS INTEGER) + CAST(late > 0 AS INTEGER) AS findings FROM
(SELECT (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)) AS dup, (SELECT count(*) FROM lines JOIN anchors ON order_key = claim_key WHERE claim_date > event_date) AS late)""")
def c34(spark: SparkSession, d: str) -> DataFrame:
    dup = K.key_violations(table(spark, d, "orders"), ["o_orderkey"])
    rules = c20(spark, d).filter("rule = 'shipped_after_order'")
    metrics = [(dup, F.col("duplicate_values") > 0, "DUPLICATE_KEY", "BLOCKER", F.col("duplicate_values")), (rules, F.col("violations") > 0, "DATE_ORDER", "WARNING", F.col("violations"))]
    return P.findings_rollup(metrics)[1]


@query("c35_contract_conformance", """SELECT 'part' AS table_name, 'p_name' AS field, 'TOO_LONG' AS problem, count(*) AS rows FROM part WHERE length(p_name) > 12 HAVING count(*) > 0
UNION ALL SELECT 'part', 'p_retailprice', 'OVERFLOW', count(*) FROM part WHERE abs(p_retailprice) >= 1000 HAVING count(*) > 0
UNION ALL SELECT 'part', 'p_brand', 'DUPLICATE_KEY', CAST(sum(n) AS BIGINT) FROM (SELECT count(*) AS n FROM part GROUP BY p_brand HAVING count(*) > 1)
UNION ALL SELECT 'part', 'p_container', 'MISSING_COLUMN', NULL UNION ALL SELECT 'part', 'p_type', 'EXTRA_COLUMN', NULL UNION ALL SELECT 'part', 'p_size', 'WRONG_TYPE', NULL""")
def c35(spark: SparkSession, d: str) -> DataFrame:
    contract = {"p_partkey": {"type": "bigint", "nullable": False}, "p_name": {"type": "string", "nullable": False, "length": 12}, "p_brand": {"type": "string"}, "p_size": {"type": "bigint"}, "p_retailprice": {"precision": 5, "scale": 2}, "p_container": {}}
    return P.contract_conformance(table(spark, d, "part"), "part", contract, ["p_brand"])


@query("c37_policy_coverage", "SELECT column_name, status FROM (VALUES ('o_orderkey', 'CONTROL'), ('o_custkey', 'DUPLICATE'), ('o_orderstatus', 'TARGET'), ('o_totalprice', 'PROHIBITED'), ('o_orderdate', 'UNCLASSIFIED'), ('o_orderpriority', 'BASELINE'), ('o_clerk', 'UNKNOWN')) v(column_name, status)")
def c37(spark: SparkSession, d: str) -> DataFrame:
    policy = [("o_orderkey", "CONTROL"), ("o_custkey", "BASELINE"), ("o_custkey", "RESTRICTED"), ("o_orderstatus", "TARGET"), ("o_totalprice", "PROHIBITED"), ("o_orderpriority", "BASELINE"), ("o_clerk", "BASELINE")]
    frame = spark.createDataFrame([("orders", c, p) for c, p in policy], "table_name string, column_name string, policy string")
    return P.policy_coverage(P.table_columns(spark, {"orders": table(spark, d, "orders")}), frame).select("column_name", "status")


_NAMES = "SELECT p_partkey AS feature, p_brand || '.' || p_type AS source FROM part"


@query("c38_leakage_name_scan", f"""SELECT feature, source, source AS pattern FROM ({_NAMES}) WHERE source = 'Brand#11.STANDARD'
UNION ALL SELECT feature, source, 'Brand#12.*' FROM ({_NAMES}) WHERE starts_with(source, 'Brand#12.') UNION ALL SELECT feature, source, 'Brand#1.*' FROM ({_NAMES}) WHERE starts_with(source, 'Brand#1.')""")
def c38(spark: SparkSession, d: str) -> DataFrame:
    """Every part's brand and type as a dotted name."""
    features = table(spark, d, "part").select(F.col("p_partkey").alias("feature"), F.concat_ws(".", "p_brand", "p_type").alias("source"))
    black = spark.createDataFrame([("Brand#11.STANDARD",), ("Brand#12.*",), ("Brand#1.*",)], "pattern string")
    return P.leakage_name_scan(features, black)


@query("c39_source_drift", f"{ctes(ANCHORS)} SELECT * FROM (SELECT 'total' AS field, count(*) AS actual, 15000 AS expected, count(*) - 15000 AS delta FROM anchors UNION ALL SELECT 'positives', sum(target)::BIGINT, 5000, sum(target)::BIGINT - 5000 FROM anchors UNION ALL SELECT 'negatives', count(*) - sum(target)::BIGINT, 10000, count(*) - sum(target)::BIGINT - 10000 FROM anchors)")
def c39(spark: SparkSession, d: str) -> DataFrame:
    return P.source_drift(anchors(spark, d), "target", {"total": 15000, "positives": 5000, "negatives": 10000})
