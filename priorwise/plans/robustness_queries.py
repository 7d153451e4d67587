"""Queries for robustness (I) and the model pipeline (G)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from priorwise.operators import calibration as C, metrics as M, modeling as G, robustness as R
from priorwise.sources.tables import written

from .bindings import ANCHORS, anchors, ctes
from .feature_queries import PRIOR_SPEC, TELE_SPEC, rounded
from .metric_queries import SCORED, _rank, scored
from .registry import query
from .splits_and_cohorts import SPLIT, assigned, folds

_TR, _OT = "claim_date < DATE '1999-01-01'", "claim_date >= DATE '1999-01-01'"


def parts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    s = scored(spark, d).join(anchors(spark, d).select("claim_key", "total_cents"), "claim_key").withColumns({
        "cents": F.when(F.col("claim_key") % 7 > 0, F.col("total_cents")), "level": F.when(F.col("claim_key") % 11 > 0, F.col("priority"))})
    return s.filter(_TR), s.filter(_OT)


PARTS = f"""part_rows AS (SELECT s.*, total_cents, CASE WHEN claim_key % 7 > 0 THEN total_cents END AS cents, CASE WHEN claim_key % 11 > 0 THEN s.priority END AS level FROM scored s JOIN anchors USING (claim_key)),
train AS (SELECT * FROM part_rows WHERE {_TR}), other AS (SELECT * FROM part_rows WHERE {_OT})"""
_P = ctes(ANCHORS, SCORED, PARTS)


def _bucket(x: str, edges: str) -> str:
    return f"1 + len(list_filter({edges}, lambda e: e < {x}))"


_DEC = f"""q AS (SELECT list_distinct(list(v)) AS u FROM (SELECT unnest(quantile_cont(p, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1])) AS v FROM train)), ed AS (SELECT list_sort(u)[2:len(u) - 1] AS edges FROM q),
dg AS (SELECT {_bucket('p', 'edges')} AS k, count(*) AS rows, CAST(sum(y) AS BIGINT) AS positives, avg(p) AS mean_p FROM other, ed GROUP BY 1),
dec AS (SELECT 'D' || k AS decile, k, rows, positives, positives / CAST(rows AS DOUBLE) AS precision, positives / CAST(sum(positives) OVER () AS DOUBLE) AS recall_contribution, sum(positives) OVER (ORDER BY k DESC) / CAST(sum(positives) OVER () AS DOUBLE) AS cumulative_recall, positives / CAST(rows AS DOUBLE) * sum(rows) OVER () / sum(positives) OVER () AS lift, mean_p FROM dg)"""


@query("i01_risk_deciles", f"{_P}, {_DEC} SELECT decile, rows, positives, {', '.join(f'round({c}, 6) AS {c}' for c in ('precision', 'recall_contribution', 'cumulative_recall', 'lift', 'mean_p'))} FROM dec")
def i01(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.risk_deciles(*parts(spark, d)))


@query("i02_topk_lift", f"""{_P}, r AS (SELECT y, row_number() OVER (ORDER BY p DESC, claim_key) AS rn, count(*) OVER () AS n, avg(y) OVER () AS prevalence, sum(y) OVER () AS pos FROM other),
x AS (SELECT f AS fraction, count(*) AS selected, CAST(sum(y) AS BIGINT) AS captured, any_value(prevalence) AS prevalence, any_value(pos) AS pos FROM r, (VALUES (0.05::DOUBLE), (0.1::DOUBLE), (0.2::DOUBLE), (0.3::DOUBLE)) v(f) WHERE rn <= ceil(f * n) GROUP BY f)
SELECT fraction, selected, captured, round(captured / CAST(pos AS DOUBLE), 6) AS recall, round(captured / CAST(selected AS DOUBLE), 6) AS precision, round(prevalence, 6) AS prevalence, round(captured / CAST(selected AS DOUBLE) / prevalence, 6) AS lift FROM x""")
def i02(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.topk_lift(parts(spark, d)[1], "claim_key"))


@query("i03_concentration", f"{_P}, {_DEC} SELECT round(sum(recall_contribution) FILTER (k = 10), 6) AS top_1_share, round(sum(recall_contribution) FILTER (k >= 9), 6) AS top_2_share, round(sum(recall_contribution) FILTER (k >= 8), 6) AS top_3_share, round(max(precision) FILTER (k = 10) / nullif(max(precision) FILTER (k = 1), 0), 6) AS top_to_bottom FROM dec")
def i03(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.concentration(R.risk_deciles(*parts(spark, d))))


_DEFS = """sd AS (SELECT (SELECT list_sort(list(v)) FROM (SELECT level AS v FROM train WHERE level IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, v LIMIT 3)) AS top_level,
  (SELECT quantile_cont(CAST(cents AS DOUBLE), [.25, .5, .75]) FROM train) AS edges_cents)"""
_MEM = f"""thirds AS (SELECT *, row_number() OVER (ORDER BY claim_date, claim_key) - 1 AS pl, count(*) OVER () AS n FROM other),
mem AS (SELECT claim_key, 'level' AS slice_id, CASE WHEN level IS NULL THEN '__MISSING__' WHEN list_contains(top_level, level) THEN level ELSE '__OTHER__' END AS label FROM thirds, sd
  UNION ALL SELECT claim_key, 'cents', CASE WHEN cents IS NULL THEN '__MISSING__' ELSE 'Q' || ({_bucket('cents', 'edges_cents')}) END FROM thirds, sd UNION ALL SELECT claim_key, 'month', strftime(claim_date, '%Y-%m') FROM thirds
  UNION ALL SELECT claim_key, 'quarter', year(claim_date) || 'Q' || quarter(claim_date) FROM thirds UNION ALL SELECT claim_key, 'third', CASE WHEN pl < n // 3 THEN 'EARLY' WHEN pl < 2 * n // 3 THEN 'MIDDLE' ELSE 'LATE' END FROM thirds)"""


def definitions(spark: SparkSession, d: str) -> DataFrame:
    return R.slice_definitions(parts(spark, d)[0], ["level"], ["cents"], 3)


def slices(spark: SparkSession, d: str) -> DataFrame:
    return R.slice_membership(parts(spark, d)[1], definitions(spark, d), "claim_key", "claim_date", ["level"], ["cents"])


@query("i04_slice_definitions", f"{_P}, {_DEFS} SELECT array_to_string(top_level, '|') AS top_level, round(edges_cents[1], 4) AS q1, round(edges_cents[2], 4) AS q2, round(edges_cents[3], 4) AS q3 FROM sd")
def i04(spark: SparkSession, d: str) -> DataFrame:
    return definitions(spark, d).select(F.array_join("top_level", "|").alias("top_level"), *[F.round(F.get("edges_cents", F.lit(i)), 4).alias(f"q{i + 1}") for i in range(3)])


@query("i05_slice_membership", f"{_P}, {_DEFS}, {_MEM} SELECT * FROM mem")
def i05(spark: SparkSession, d: str) -> DataFrame:
    return slices(spark, d)


@query("i06_slice_metrics", f"""{_P}, {_DEFS}, {_MEM}, joined AS (SELECT mem.*, y, p FROM mem JOIN other USING (claim_key)), {_rank('slice_id, label').replace('FROM scored', 'FROM joined')}, {_rank().replace('h AS', 'h2 AS').replace('FROM h)', 'FROM h2)').replace('c AS', 'c2 AS').replace('FROM c ', 'FROM c2 ').replace('r AS', 'r2 AS').replace('FROM scored', 'FROM other')}
SELECT r.slice_id, r.label, r.rows, r.positives, r.average_precision, r.roc_auc, CASE WHEN r.rows < 75 OR r.positives < 5 OR r.rows - r.positives < 20 THEN 'LOW_SUPPORT' WHEN r2.roc_auc - r.roc_auc >= 0.1 THEN 'SEVERE' WHEN r2.roc_auc - r.roc_auc >= 0.05 THEN 'MODERATE' ELSE 'STABLE' END AS status FROM r, r2""")
def i06(spark: SparkSession, d: str) -> DataFrame:
    out = rounded(R.slice_metrics(parts(spark, d)[1].select("claim_key", "y", "p"), slices(spark, d), "claim_key", 0.4))
    return out.select("slice_id", "label", "rows", "positives", "average_precision", "roc_auc", "status")


@query("i07_temporal_metrics", f"""{_P}, {_DEFS}, {_MEM}, joined AS (SELECT slice_id AS period, label, y, p FROM mem JOIN other USING (claim_key) WHERE slice_id IN ('month', 'quarter', 'third')), {_rank('period, label').replace('FROM scored', 'FROM joined')} SELECT * FROM r""")
def i07(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.temporal_metrics(parts(spark, d)[1], "claim_date", "claim_key"))


def _side(c: str) -> str:
    return f"SELECT 0 AS side, CAST({c} AS DOUBLE) AS v FROM train UNION ALL SELECT 1, CAST({c} AS DOUBLE) FROM other"


def _dist(c: str) -> str:
    return f"""(SELECT a.*, lead(v) OVER (ORDER BY v) - v AS w FROM (SELECT v, sum(count(*) FILTER (side = 0)) OVER (ORDER BY v) / CAST(sum(count(*) FILTER (side = 0)) OVER () AS DOUBLE) AS f, sum(count(*) FILTER (side = 1)) OVER (ORDER BY v) / CAST(sum(count(*) FILTER (side = 1)) OVER () AS DOUBLE) AS g FROM ({_side(c)}) WHERE v IS NOT NULL GROUP BY v) a)"""


def _psi_sql(c: str, source: str) -> str:
    return f"""(SELECT sum((b - a) * ln(b / a)) AS psi FROM (SELECT bin, greatest(count(*) FILTER (side = 0) / CAST(sum(count(*) FILTER (side = 0)) OVER () AS DOUBLE), 1e-6) AS a, greatest(count(*) FILTER (side = 1) / CAST(sum(count(*) FILTER (side = 1)) OVER () AS DOUBLE), 1e-6) AS b
      FROM (SELECT side, len(list_filter(edges, lambda e: e <= v)) AS bin FROM ({_side(c)}), (SELECT list_sort(u)[2:len(u) - 1] AS edges FROM (SELECT list_distinct(list(x)) AS u FROM (SELECT unnest(quantile_cont(v, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1])) AS x FROM ({_side(c)}) WHERE {source}))) WHERE v IS NOT NULL) GROUP BY bin))"""


@query("i08_numeric_drift", f"""{_P} SELECT 'cents' AS field, round((SELECT avg(CAST(cents IS NULL AS INTEGER)) FROM train), 6) AS missing_0, round((SELECT avg(CAST(cents IS NULL AS INTEGER)) FROM other), 6) AS missing_1, (SELECT quantile_cont(cents, .5) FROM train) AS median_0, (SELECT quantile_cont(cents, .5) FROM other) AS median_1,
round((SELECT quantile_cont(cents, .75) - quantile_cont(cents, .25) FROM train), 2) AS iqr_0, round((SELECT quantile_cont(cents, .75) - quantile_cont(cents, .25) FROM other), 2) AS iqr_1, round((SELECT psi FROM {_psi_sql('cents', 'side = 0')}), 6) AS psi, round((SELECT sum(abs(f - g) * w) FROM {_dist('cents')}), 2) AS wasserstein""")
def i08(spark: SparkSession, d: str) -> DataFrame:
    out = rounded(R.numeric_drift(*parts(spark, d), ["cents"]))
    return out.withColumns({c: F.round(c, 2) for c in ("iqr_0", "iqr_1", "wasserstein")})


_SHARES = """h AS (SELECT coalesce(level, '__MISSING__') AS v, count(*) FILTER (s = 0) AS a, count(*) FILTER (s = 1) AS b FROM (SELECT level, 0 AS s FROM train UNION ALL SELECT level, 1 FROM other) GROUP BY 1),
p AS (SELECT *, a / CAST(sum(a) OVER () AS DOUBLE) AS pa, b / CAST(sum(b) OVER () AS DOUBLE) AS pb, count(*) OVER () AS k FROM h), e AS (SELECT *, (pa + 1e-6) / (1 + 1e-6 * k) AS x, (pb + 1e-6) / (1 + 1e-6 * k) AS y, (pa + pb) / 2 AS m FROM p)"""


@query("i09_categorical_drift", f"""{_P}, {_SHARES}
SELECT 'level' AS field, round((SELECT avg(CAST(level IS NULL AS INTEGER)) FROM train), 6) AS missing_0, round((SELECT avg(CAST(level IS NULL AS INTEGER)) FROM other), 6) AS missing_1, round(sum((y - x) * ln(y / x)), 6) AS psi,
round(sqrt(greatest((sum(CASE WHEN pa > 0 THEN pa * log2(pa / m) ELSE 0 END) + sum(CASE WHEN pb > 0 THEN pb * log2(pb / m) ELSE 0 END)) / 2, 0)), 6) AS js_distance, round(sum(CASE WHEN a = 0 THEN pb ELSE 0 END), 6) AS unseen_rate FROM e""")
def i09(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.categorical_drift(*parts(spark, d), ["level"]))


def _missing_sql(c: str) -> str:
    return ", ".join(f"(SELECT avg(CAST({c} IS NULL AS INTEGER)) FROM {t}) AS missing_{s}" for s, t in ((0, "train"), (1, "other")))


def _grade_sql(x: str, a: float, b: float) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'UNAVAILABLE' WHEN {x} >= {b} THEN 'SEVERE' WHEN {x} >= {a} THEN 'MODERATE' ELSE 'STABLE' END"


_NUMERIC_PSI = " UNION ALL ".join(f"SELECT '{c}' AS field, 'numeric' AS kind, {_missing_sql(c)}, (SELECT psi FROM {_psi_sql(c, 'side = 0')}) AS psi" for c in ("cents", "p"))


@query("i10_drift_table", f"""{_P}, {_SHARES}, both_kinds AS ({_NUMERIC_PSI} UNION ALL SELECT 'level', 'categorical', {_missing_sql('level')}, (SELECT sum((y - x) * ln(y / x)) FROM e))
SELECT field, kind, round(missing_0, 6) AS missing_0, round(missing_1, 6) AS missing_1, round(psi, 6) AS psi, {_grade_sql('psi', 0.1, 0.25)} AS psi_class, {_grade_sql('abs(missing_1 - missing_0)', 0.05, 0.1)} AS missing_class FROM both_kinds""")
def i10(spark: SparkSession, d: str) -> DataFrame:
    a, b = parts(spark, d)
    return rounded(R.drift_table(R.numeric_drift(a, b, ["cents", "p"]), R.categorical_drift(a, b, ["level"])))


@query("i11_score_drift", f"""{_P} SELECT {', '.join(f"round((SELECT {f}(p) FROM {t}), 6) AS {n}_{s}" for s, t in ((0, 'train'), (1, 'other')) for n, f in (('mean', 'avg'), ('std', 'stddev_pop')))}, {', '.join(f"round((SELECT quantile_cont(p, {q}) FROM {t}), 6) AS p{int(q * 100):02d}_{s}" for s, t in ((0, 'train'), (1, 'other')) for q in (0.05, 0.5, 0.95))},
round((SELECT psi FROM {_psi_sql('p', 'TRUE')}), 6) AS psi, round((SELECT sum(abs(f - g) * w) FROM {_dist('p')}), 6) AS wasserstein, round((SELECT max(abs(f - g)) FROM {_dist('p')}), 6) AS ks""")
def i11(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.score_drift(*parts(spark, d)))


_BOOT = """strat AS (SELECT claim_key, y, row_number() OVER (PARTITION BY y ORDER BY claim_key) - 1 AS i, count(*) OVER (PARTITION BY y) AS n FROM other),
drawn AS (SELECT y, replicate, ('0x' || substr(md5('17:' || replicate || ':' || y || ':' || i), 1, 12))::BIGINT % n AS at FROM strat, range(1, 21) r(replicate)),
w AS (SELECT replicate, claim_key, count(*) AS weight FROM drawn JOIN strat ON drawn.y = strat.y AND drawn.at = strat.i GROUP BY 1, 2)"""


@query("i12_bootstrap_weights", f"{_P}, {_BOOT} SELECT replicate, claim_key, weight FROM w")
def i12(spark: SparkSession, d: str) -> DataFrame:
    """The weights of all rows in 20 replicates."""
    return R.bootstrap_weights(parts(spark, d)[1], "claim_key", 20)


@query("i12_bootstrap_weights_all")
def i12_all(spark: SparkSession, d: str) -> DataFrame:
    """The weights of all rows in as many replicates as the intervals take."""
    return R.bootstrap_weights(parts(spark, d)[1], "claim_key", 2000)


@query("i12_bootstrap_ci")
def i12_ci(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.bootstrap_ci(R.bootstrap_metrics(parts(spark, d)[1], 2000, 0.4), 2000))


@query("i13_slice_bootstrap")
def i13(spark: SparkSession, d: str) -> DataFrame:
    x = R.bootstrap_slices(written(slices(spark, d), "slices"), parts(spark, d)[1].select("claim_key", "y", "p"), "claim_key")
    return rounded(R.bootstrap_ci(R.bootstrap_metrics(x, 1000, 0.4, ["slice"]), 1000, ["slice"]))


_ERR = "err AS (SELECT *, CASE WHEN p >= 0.4 AND y = 1 THEN 'TP' WHEN p >= 0.4 THEN 'FP' WHEN y = 1 THEN 'FN' ELSE 'TN' END AS outcome, abs(p - 0.4) AS margin FROM other)"


def errors(spark: SparkSession, d: str) -> DataFrame:
    return R.error_cohorts(parts(spark, d)[1], 0.4)


@query("i14_error_cohorts", f"{_P}, {_ERR} SELECT claim_key, outcome, round(margin, 6) AS margin FROM err")
def i14(spark: SparkSession, d: str) -> DataFrame:
    return rounded(errors(spark, d).select("claim_key", "outcome", "margin"))


@query("i15_high_confidence_errors", f"{_P}, {_ERR} SELECT outcome, claim_key, row_number() OVER w AS place FROM err WHERE outcome IN ('FP', 'FN') WINDOW w AS (PARTITION BY outcome ORDER BY margin DESC, claim_key) QUALIFY row_number() OVER w <= 25")
def i15(spark: SparkSession, d: str) -> DataFrame:
    return R.high_confidence_errors(errors(spark, d), "claim_key").select("outcome", "claim_key", "place")


@query("i16_error_context", f"""{_P}, {_DEFS}, {_MEM}, {_ERR}, e AS (SELECT claim_key, outcome FROM err WHERE outcome IN ('FP', 'FN') QUALIFY row_number() OVER (PARTITION BY outcome ORDER BY margin DESC, claim_key) <= 25), l AS (SELECT claim_key, string_agg(slice_id || '=' || label, ';' ORDER BY slice_id || '=' || label) AS slices FROM mem GROUP BY 1)
SELECT claim_key, outcome, slices, cents, CAST(cents IS NULL AS INTEGER) + CAST(level IS NULL AS INTEGER) AS missing_features FROM e JOIN l USING (claim_key) JOIN other USING (claim_key)""")
def i16(spark: SparkSession, d: str) -> DataFrame:
    top = R.high_confidence_errors(errors(spark, d), "claim_key").select("claim_key", "outcome")
    return R.error_context(top, slices(spark, d), parts(spark, d)[1], "claim_key", ["cents", "level"]).select("claim_key", "outcome", "slices", "cents", "missing_features")


@query("i17_error_profile", f"""{_P}, {_ERR}, t AS (SELECT outcome, count(*) AS n FROM err GROUP BY 1), v AS (SELECT coalesce(level, '__MISSING__') AS value, count(*) AS n FROM err GROUP BY 1), c AS (SELECT outcome, coalesce(level, '__MISSING__') AS value, count(*) AS n FROM err GROUP BY 1, 2)
SELECT t.outcome, 'level' AS field, v.value, coalesce(c.n, 0) AS n, round(coalesce(c.n, 0) / CAST(t.n AS DOUBLE), 6) AS share, round(v.n / CAST((SELECT count(*) FROM err) AS DOUBLE), 6) AS population_share, round(coalesce(c.n, 0) / CAST(t.n AS DOUBLE) / (v.n / CAST((SELECT count(*) FROM err) AS DOUBLE)), 6) AS lift
FROM t CROSS JOIN v LEFT JOIN c ON t.outcome = c.outcome AND v.value = c.value""")
def i17(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.error_profile(errors(spark, d), ["cents"], ["level"])[1])


@query("i17_error_means", f"{_P}, {_ERR} SELECT outcome, 'cents' AS field, count(*) AS rows, round(avg(cents), 3) AS mean, round((SELECT avg(cents) FROM err), 3) AS population_mean, round(avg(cents) - (SELECT avg(cents) FROM err), 3) AS shift FROM err GROUP BY 1")
def i17_means(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.error_profile(errors(spark, d), ["cents"], ["level"])[0], 3)


@query("i18_threshold_sensitivity", f"{_P} SELECT round(t, 6) AS threshold, count(*) FILTER (p >= t AND y = 1) AS tp, count(*) FILTER (p >= t AND y = 0) AS fp, count(*) FILTER (p < t AND y = 0) AS tn, count(*) FILTER (p < t AND y = 1) AS fn FROM other, (VALUES (0.4::DOUBLE * 0.8::DOUBLE), (0.4::DOUBLE * 0.9::DOUBLE), (0.4::DOUBLE), (0.4::DOUBLE * 1.1::DOUBLE), (0.4::DOUBLE * 1.2::DOUBLE)) v(t) GROUP BY t")
def i18(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.threshold_sensitivity(parts(spark, d)[1], 0.4)).select("threshold", "tp", "fp", "tn", "fn")


@query("i19_score_invariance", f"{_P} SELECT v AS variant, count(*) AS rows, 0.0::DOUBLE AS max_difference FROM other, (VALUES ('repartitioned'), ('sorted')) x(v) GROUP BY v")
def i19(spark: SparkSession, d: str) -> DataFrame:
    s = parts(spark, d)[1].select("claim_key", "p")
    return R.score_invariance({"repartitioned": s.repartition(7), "sorted": s.orderBy(F.desc("claim_key"))}, s, "claim_key")


@query("i20_score_reproduction", f"{_P} SELECT count(*) FILTER (claim_key % 3 <> 0 AND claim_key % 4 <> 0) AS matched, count(*) FILTER (claim_key % 3 <> 0 AND claim_key % 4 = 0) AS saved_only, count(*) FILTER (claim_key % 3 = 0 AND claim_key % 4 <> 0) AS fresh_only, round(max(abs(p - p2)) FILTER (claim_key % 3 <> 0 AND claim_key % 4 <> 0), 6) AS max_difference, round(avg(abs(p - p2)) FILTER (claim_key % 3 <> 0 AND claim_key % 4 <> 0), 6) AS mean_difference, count(*) FILTER (claim_key % 3 <> 0 AND claim_key % 4 <> 0 AND abs(p - p2) > 1e-10) AS mismatches FROM other")
def i20(spark: SparkSession, d: str) -> DataFrame:
    s = parts(spark, d)[1]
    return rounded(R.score_reproduction(s.filter("claim_key % 3 <> 0").select("claim_key", "p"), s.filter("claim_key % 4 <> 0").select("claim_key", F.col("p2").alias("p")), "claim_key"))


@query("i21_warning_inventory", f"""{_P}, {_DEFS}, {_MEM}, w AS (SELECT 'SEVERE_DRIFT' AS code, count(*) AS rows, TRUE AS blocking FROM ({_NUMERIC_PSI}) WHERE psi >= 0.25
UNION ALL SELECT 'LOW_SUPPORT_SLICES', count(*), FALSE FROM (SELECT count(*) AS n, sum(y) AS pos FROM mem JOIN other USING (claim_key) GROUP BY slice_id, label) WHERE n < 75 OR pos < 5 OR n - pos < 20)
SELECT *, CASE WHEN bool_or(blocking) OVER () THEN 'BLOCKED' ELSE 'READY' END AS status, count(*) OVER () AS warnings FROM w WHERE rows > 0""")
def i21(spark: SparkSession, d: str) -> DataFrame:
    a, b = parts(spark, d)
    rules = [(R.numeric_drift(a, b, ["cents", "p"]), F.col("psi") >= 0.25, "SEVERE_DRIFT"), (R.slice_metrics(b.select("claim_key", "y", "p"), slices(spark, d), "claim_key", 0.4), F.col("status") == "LOW_SUPPORT", "LOW_SUPPORT_SLICES")]
    w = R.warning_inventory(rules, ["SEVERE_DRIFT"])
    return w.crossJoin(R.readiness(w))


@query("i22_false_negative_summary", f"{_P}, {_ERR} SELECT count(*) AS rows, round(min(p), 6) AS min_p, round(max(p), 6) AS max_p, round(avg(p), 6) AS mean_p, round(avg(margin), 6) AS mean_margin FROM err WHERE outcome = 'FN'")
def i22(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.false_negative_summary(errors(spark, d)))


# --- G
@query("g01_adapt_matrix", f"{_P} SELECT claim_key, CAST(cents AS DOUBLE) AS cents, y AS flag, coalesce(level, '__MISSING__') AS level, CASE WHEN claim_key % 4 > 0 THEN priority ELSE '__NO_HISTORY__' END AS note FROM other")
def g01(spark: SparkSession, d: str) -> DataFrame:
    x = parts(spark, d)[1].withColumns({"flag": F.col("y") == 1, "note": F.when(F.col("claim_key") % 4 > 0, F.col("priority"))})
    return G.adapt_matrix(x, ["cents"], ["flag"], ["level"], ["note"], ["claim_key"])


@query("g02_development_frame", f"{ctes(ANCHORS, SPLIT)} SELECT claim_key, total_cents, priority, split FROM assigned WHERE split <> 'TEST'")
def g02(spark: SparkSession, d: str) -> DataFrame:
    a = assigned(spark, d)
    return G.development_frame(a.select("claim_key", "total_cents"), a.select("claim_key", "priority"), a, "claim_key")


@query("g03_feature_sets")
def g03(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of the nested sets, with the rows of the matrix they are for."""
    from priorwise.operators.features import feature_catalog

    sets = G.feature_sets(feature_catalog(spark, [*TELE_SPEC, *PRIOR_SPEC]), ["token_count_all", "has_description_all"], ["document_all"])
    return sets.groupBy("set_name").agg(F.count(F.lit(1)).alias("features")).crossJoin(anchors(spark, d).agg(F.count(F.lit(1)).alias("rows")))


@query("g04_prevalence_baseline", f"{_P} SELECT claim_key, y, round((SELECT avg(y) FROM train), 6) AS p FROM other")
def g04(spark: SparkSession, d: str) -> DataFrame:
    a, b = parts(spark, d)
    return rounded(G.prevalence_baseline(a, b.select("claim_key", "y")))


@query("g06_class_weights", f"""{_P}, n AS (SELECT count(*) FILTER (y = 0) AS n0, count(*) FILTER (y = 1) AS n1 FROM train) SELECT s AS strategy, w AS positive_weight FROM (VALUES ('none', 1.0::DOUBLE), ('positive_2', 2.0), ('positive_4', 4.0), ('positive_8', 8.0), ('positive_16', 16.0), ('positive_32', 32.0)) v(s, w)
UNION ALL SELECT 'auto_sqrt', round(sqrt(n0 / CAST(n1 AS DOUBLE)), 6) FROM n UNION ALL SELECT 'auto_balanced', round(n0 / CAST(n1 AS DOUBLE), 6) FROM n""")
def g06(spark: SparkSession, d: str) -> DataFrame:
    return rounded(G.class_weights(parts(spark, d)[0]))


@query("g05_g07_oof_metrics")
def g07(spark: SparkSession, d: str) -> DataFrame:
    """Out-of-fold scores of a fitted pipeline, and their metrics per fold."""
    a = assigned(spark, d).filter("split = 'TRAIN'").withColumns({"y": F.col("target"), "x": F.col("total_cents").cast("double"), "z": F.datediff("claim_date", F.lit("1992-01-01")).cast("double")})
    oof = G.oof_scores(a.select("claim_key", "y", "x", "z", "priority"), folds(spark, d), "claim_key", ["x", "z"], ["priority"])
    return rounded(M.ranking_metrics(oof, ["fold_id"]), 4)


@query("g08_g10_sigmoid")
def g10(spark: SparkSession, d: str) -> DataFrame:
    """Sigmoid calibration fitted on train, and its metrics on the rest."""
    a, b = parts(spark, d)
    slope, intercept = G.fit_sigmoid(a)
    return rounded(M.ranking_metrics(b.withColumn("p", G.apply_sigmoid(F.col("p"), slope, intercept))), 4)


@query("g09_isotonic_eligible", f"{_P} SELECT count(*) FILTER (y = 1) AS positives, count(*) FILTER (y = 0) AS negatives, count(DISTINCT p) AS distinct_scores, TRUE AS eligible FROM train")
def g09(spark: SparkSession, d: str) -> DataFrame:
    return G.isotonic_eligible(parts(spark, d)[0])


@query("g09_g11_isotonic")
def g11(spark: SparkSession, d: str) -> DataFrame:
    """Isotonic calibration fitted on train, and its metrics on the rest."""
    a, b = parts(spark, d)
    return rounded(M.ranking_metrics(C.apply_pieces(b, C.isotonic_pieces(a))), 4)


@query("g10_apply_sigmoid", f"{_P} SELECT claim_key, round(1 / (1 + exp(-(1.5 * ln(p / (1 - p)) - 0.25))), 6) AS p FROM other")
def g10_apply(spark: SparkSession, d: str) -> DataFrame:
    return rounded(parts(spark, d)[1].select("claim_key", G.apply_sigmoid(F.col("p"), 1.5, -0.25).alias("p")))


@query("g11_apply_isotonic", f"{_P} SELECT claim_key, round(CASE WHEN p < 0.2 THEN 0.1 WHEN p < 0.5 THEN 0.1 + 0.3 * (p - 0.2) / 0.3 WHEN p < 0.8 THEN 0.4 + 0.5 * (p - 0.5) / 0.3 ELSE 0.9 END, 6) AS p FROM other")
def g11_apply(spark: SparkSession, d: str) -> DataFrame:
    return rounded(parts(spark, d)[1].select("claim_key", G.apply_isotonic(F.col("p"), [(0.2, 0.1), (0.5, 0.4), (0.8, 0.9)]).alias("p")))


@query("g12_blend_grid", f"""{_P}, mixed AS (SELECT k / 10.0::DOUBLE AS weight, y, k / 10.0::DOUBLE * p + (1 - k / 10.0::DOUBLE) * p2 AS p FROM other, range(11) x(k)), {_rank('weight').replace('FROM scored', 'FROM mixed')}
SELECT weight, rows, positives, log_loss, brier, mean_p FROM r""")
def g12(spark: SparkSession, d: str) -> DataFrame:
    out = rounded(G.blend_grid(parts(spark, d)[1], "p", "p2"))
    return out.select("weight", "rows", "positives", "log_loss", "brier", "mean_p")


@query("g13_score_frozen", f"""{_P}, e AS (SELECT claim_key, 1 / (1 + exp(-(1.2 * ln(p / (1 - p)) + 0.1))) AS e, p2 FROM other) SELECT claim_key, round(e, 6) AS effective_p, round(0.7 * e + 0.3 * p2, 6) AS final_p, CAST(0.7 * e + 0.3 * p2 >= 0.45 AS INTEGER) AS predicted FROM e""")
def g13(spark: SparkSession, d: str) -> DataFrame:
    return rounded(G.score_frozen(parts(spark, d)[1], "p", "p2", 1.2, 0.1, 0.7, 0.45).select("claim_key", "effective_p", "final_p", "predicted"))


@query("g14_select_oof", f"{_P} SELECT claim_key, 'a' AS track, round(p2, 6) AS p FROM other UNION ALL SELECT claim_key, 'b', round(p, 6) FROM other")
def g14(spark: SparkSession, d: str) -> DataFrame:
    s = parts(spark, d)[1]
    rows = s.select("claim_key", F.explode(F.array(*[F.struct(F.lit(t).alias("track"), F.lit(st).alias("strategy")) for t in "ab" for st in ("none", "positive_2")])).alias("x"), F.col("p").alias("raw_p"), F.col("p2").alias("calibrated_p")).select("claim_key", "x.*", "raw_p", "calibrated_p")
    champions = spark.createDataFrame([("a", "positive_2", True), ("b", "none", False)], "track string, strategy string, calibrated boolean")
    return rounded(G.select_oof(rows, champions).select("claim_key", "track", "p"))


@query("g15_importance_stability", f"""{ctes(ANCHORS)}, i AS (SELECT priority AS feature, year(claim_date) AS fold, sum(total_cents) AS loss, sum(target) AS con FROM anchors GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY loss DESC, feature) AS lr, row_number() OVER (PARTITION BY fold ORDER BY con DESC, feature) AS cr, greatest(count(*) OVER (PARTITION BY fold) - 1, 1) AS n FROM i), p AS (SELECT *, 1 - (lr - 1) / CAST(n AS DOUBLE) AS lp, 1 - (cr - 1) / CAST(n AS DOUBLE) AS cp FROM r)
SELECT feature, round(median(lp), 6) AS median_loss_percentile, round(median(cp), 6) AS median_contribution_percentile, count(*) FILTER (lp >= 0.75) AS top_25_folds, count(*) FILTER (lp >= 0.5) AS top_50_folds, round(stddev_pop(lr), 6) AS loss_rank_std, round(stddev_pop(cr), 6) AS contribution_rank_std, round(0.6 * median(lp) + 0.4 * median(cp), 6) AS stable_score FROM p GROUP BY feature""")
def g15(spark: SparkSession, d: str) -> DataFrame:
    i = anchors(spark, d).groupBy(F.col("priority").alias("feature"), F.year("claim_date").alias("fold")).agg(F.sum("total_cents").alias("loss"), F.sum("target").alias("con"))
    return rounded(G.importance_stability(i, "feature", "fold", "loss", "con"))


@query("g16_feature_families", "SELECT p_type AS feature, CAST(starts_with(p_type, 'ECONOMY') AS INTEGER) + CAST(starts_with(p_type, 'S') AS INTEGER) AS families, CASE WHEN starts_with(p_type, 'ECONOMY') THEN 'economy' WHEN starts_with(p_type, 'S') THEN 's' END AS family FROM (SELECT DISTINCT p_type FROM part)")
def g16(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.createDataFrame([("ECONOMY", "economy"), ("S", "s")], "prefix string, family string")
    features = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_type").alias("feature")).distinct()
    return G.feature_families(features, rules)


