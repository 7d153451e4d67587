"""Queries for evaluation metrics (H).

Scores are made from the claim keys by integer arithmetic, alike in both
engines; ``fold`` is the claim year's remainder, ``track`` one of two scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from priorwise.operators import metrics as M

from .bindings import ANCHORS, anchors, ctes
from .feature_queries import rounded
from .registry import query

SCORED = """scored AS (SELECT claim_key, target AS y, claim_date, priority, year(claim_date) % 3 AS fold,
  ((claim_key * 7919 + total_cents) % 997 + target * 300 + 1) / 1300.0::DOUBLE AS p, ((claim_key * 104729) % 991 + target * 150 + 1) / 1200.0::DOUBLE AS p2 FROM anchors)"""


def scored(spark: SparkSession, d: str) -> DataFrame:
    c, t = F.col("claim_key"), F.col("target")
    return anchors(spark, d).select(
        "claim_key", t.alias("y"), "claim_date", "priority", (F.year("claim_date") % 3).alias("fold"),
        (((c * 7919 + F.col("total_cents")) % 997 + t * 300 + 1) / F.lit(1300.0)).alias("p"), (((c * 104729) % 991 + t * 150 + 1) / F.lit(1200.0)).alias("p2"))


def _rank(by: str = "") -> str:
    """Independent formulation: one global window over distinct scores of each group."""
    g = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return f"""h AS (SELECT {g}p, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM scored GROUP BY {g}p),
c AS (SELECT *, sum(pos) OVER ({part}ORDER BY p DESC) AS tp, sum(neg) OVER ({part}ORDER BY p DESC) AS fp, sum(pos) OVER ({part}) AS n_pos, sum(neg) OVER ({part}) AS n_neg FROM h),
r AS (SELECT {g}round(coalesce(sum(pos / CAST(nullif(n_pos, 0) AS DOUBLE) * tp / (tp + fp)), 0), 6) AS average_precision, round(coalesce(sum(neg * (tp - pos + pos / 2.0::DOUBLE)) / nullif(any_value(CAST(n_pos AS DOUBLE) * n_neg), 0), 0), 6) AS roc_auc,
  round(coalesce(sum(pos / CAST(nullif(n_pos, 0) AS DOUBLE) * (tp / CAST(tp + fp AS DOUBLE) + CASE WHEN tp + fp - pos - neg > 0 THEN (tp - pos) / CAST(tp + fp - pos - neg AS DOUBLE) ELSE 1 END) / 2), 0), 6) AS pr_auc,
  round(-sum(pos * ln(p) + neg * ln(1 - p)) / sum(pos + neg), 6) AS log_loss, round(sum(pos * (p - 1) * (p - 1) + neg * p * p) / sum(pos + neg), 6) AS brier, CAST(sum(pos + neg) AS BIGINT) AS rows, CAST(sum(pos) AS BIGINT) AS positives, round(sum(pos) / CAST(sum(pos + neg) AS DOUBLE), 6) AS prevalence, round(sum(p * (pos + neg)) / sum(pos + neg), 6) AS mean_p
  FROM c {f"GROUP BY {by}" if by else ""})"""


_CONF = """tp, fp, tn, fn, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(tn / nullif(tn + fp, 0), 0) AS specificity, coalesce(tn / nullif(tn + fn, 0), 0) AS npv, coalesce(fp / nullif(fp + tn, 0), 0) AS fpr, coalesce(fn / nullif(fn + tp, 0), 0) AS fnr,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, coalesce(5 * tp / nullif(5 * tp + fp + 4 * fn, 0), 0) AS f2, (coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0)) / 2 AS balanced_accuracy,
  coalesce((tp * tn - fp * fn) / nullif(sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0) AS mcc, (tp + tn) / (tp + fp + tn + fn) AS accuracy, CAST(tp + fp AS BIGINT) AS predicted_positives"""
_NAMES = ("precision", "recall", "specificity", "npv", "fpr", "fnr", "f1", "f2", "balanced_accuracy", "mcc", "accuracy")
_ROUND = "CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(tn AS BIGINT) AS tn, CAST(fn AS BIGINT) AS fn, predicted_positives, " + ", ".join(f"round({n}, 6) + 0.0 AS {n}" for n in _NAMES)
_COUNTS = "count(*) FILTER (p >= t AND y = 1)::DOUBLE AS tp, count(*) FILTER (p >= t AND y = 0)::DOUBLE AS fp, count(*) FILTER (p < t AND y = 0)::DOUBLE AS tn, count(*) FILTER (p < t AND y = 1)::DOUBLE AS fn"
CURVE = f"""grid AS (SELECT k / 1000.0::DOUBLE AS t FROM range(1, 1000) x(k)), k AS (SELECT t, {_COUNTS} FROM scored, grid GROUP BY t), curve AS (SELECT t AS threshold, {_CONF} FROM k)"""


@query("h01_validate_scores", f"{ctes(ANCHORS, SCORED)} SELECT count(*) AS rows, 0 AS invalid_labels, count(*) FILTER (claim_key % 100 = 0) AS invalid_scores FROM scored")
def h01(spark: SparkSession, d: str) -> DataFrame:
    return M.validate_scores(scored(spark, d).withColumn("p", F.when(F.col("claim_key") % 100 == 0, 1.5).otherwise(F.col("p"))))


@query("h02_h06_ranking_metrics", f"{ctes(ANCHORS, SCORED)}, {_rank()} SELECT * FROM r")
def h02(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.ranking_metrics(scored(spark, d)))


@query("h07_confusion_metrics", f"{ctes(ANCHORS, SCORED)}, k AS (SELECT priority, {_COUNTS.replace('t AND', '0.4 AND')} FROM scored GROUP BY priority) SELECT priority, {_ROUND} FROM (SELECT priority, {_CONF} FROM k)")
def h07(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.confusion_metrics(scored(spark, d), 0.4, ["priority"]))


@query("h08_threshold_curve", f"{ctes(ANCHORS, SCORED)}, {CURVE} SELECT threshold, {_ROUND} FROM curve")
def h08(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.threshold_curve(scored(spark, d)))


@query("h09_select_threshold", f"{ctes(ANCHORS, SCORED)}, {CURVE} SELECT threshold, 'MCC_MAX' AS method, {_ROUND} FROM (SELECT * FROM curve WHERE mcc >= (SELECT max(mcc) FROM curve) - 1e-12 ORDER BY round(f2, 12) DESC, round(recall, 12) DESC, round(precision, 12) DESC, threshold LIMIT 1)")
def h09(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.select_threshold(M.threshold_curve(scored(spark, d))))


@query("h09_alternatives", f"{ctes(ANCHORS, SCORED)}, {CURVE} " + " UNION ALL ".join(f"SELECT min(threshold) AS threshold, '{m.upper()}_MAX' AS method FROM curve WHERE {m} >= (SELECT max({m}) FROM curve) - 1e-12" for m in ("f1", "f2", "balanced_accuracy")))
def h09_alternatives(spark: SparkSession, d: str) -> DataFrame:
    return M.select_alternatives(M.threshold_curve(scored(spark, d)))


@query("h10_precision_at_recall", f"""{ctes(ANCHORS, SCORED)}, {CURVE} SELECT min_recall, threshold, round(precision, 6) AS precision, round(recall, 6) AS recall FROM curve, (VALUES (0.5::DOUBLE), (0.7::DOUBLE), (0.8::DOUBLE), (0.9::DOUBLE)) v(min_recall) WHERE recall >= min_recall
QUALIFY row_number() OVER (PARTITION BY min_recall ORDER BY round(precision, 12) DESC, round(recall, 12) DESC, threshold) = 1""")
def h10(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.precision_at_recall(M.threshold_curve(scored(spark, d))))


@query("h11_pareto_frontier", f"""{ctes(ANCHORS, SCORED)}, {CURVE}, pts AS (SELECT round(recall, 12) AS recall, round(precision, 12) AS precision, min(threshold) AS threshold FROM curve GROUP BY 1, 2)
SELECT round(recall, 6) AS recall, round(precision, 6) AS precision, threshold FROM pts a WHERE NOT EXISTS (SELECT 1 FROM pts b WHERE b.recall >= a.recall AND b.precision >= a.precision AND (b.recall > a.recall OR b.precision > a.precision))""")
def h11(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.pareto_frontier(M.threshold_curve(scored(spark, d))))


_FREQ = "b AS (SELECT ntile(10) OVER (ORDER BY p, claim_key) AS bin, p, y FROM scored), f AS (SELECT bin, count(*) AS rows, avg(p) AS mean_p, avg(y) AS observed, abs(avg(p) - avg(y)) AS gap FROM b GROUP BY bin)"


@query("h12_reliability_equal_freq", f"{ctes(ANCHORS, SCORED)}, {_FREQ} SELECT bin, rows, round(mean_p, 6) AS mean_p, round(observed, 6) AS observed, round(gap, 6) AS gap FROM f")
def h12(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.reliability_equal_freq(scored(spark, d), "claim_key"))


@query("h13_ece_mce", f"{ctes(ANCHORS, SCORED)}, {_FREQ} SELECT round(sum(gap * rows) / sum(rows), 6) AS ece, round(max(gap), 6) AS mce FROM f")
def h13(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.ece_mce(M.reliability_equal_freq(scored(spark, d), "claim_key")))


@query("h14_reliability_equal_width", f"""{ctes(ANCHORS, SCORED)}, e AS (SELECT k, k / 10.0::DOUBLE AS lower, (k + 1) / 10.0::DOUBLE AS upper FROM range(10) x(k))
SELECT k + 1 AS bin, lower, upper, count(p) AS rows, round(coalesce(avg(p), 0), 6) AS mean_p, round(coalesce(avg(y), 0), 6) AS observed, round(abs(coalesce(avg(p), 0) - coalesce(avg(y), 0)), 6) AS gap FROM e LEFT JOIN scored ON p >= lower AND (p < upper OR k = 9) GROUP BY 1, 2, 3""")
def h14(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.reliability_equal_width(scored(spark, d)))


@query("h15_probability_metrics", f"{ctes(ANCHORS, SCORED)}, {_rank()}, {_FREQ} SELECT r.*, ece, mce FROM r, (SELECT round(sum(gap * rows) / sum(rows), 6) AS ece, round(max(gap), 6) AS mce FROM f)")
def h15(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.probability_metrics(scored(spark, d), "claim_key"))


@query("h16_overall_metrics", f"""{ctes(ANCHORS, SCORED)}, {_rank()}, {_FREQ}, k AS (SELECT {_COUNTS.replace('t AND', '0.4 AND')} FROM scored), x AS (SELECT {_CONF} FROM k)
SELECT r.*, ece, mce, {_ROUND}, round(average_precision / prevalence, 4) AS average_precision_lift, average_precision > prevalence AND roc_auc > 0.5 AS signal_pass FROM r, x, (SELECT round(sum(gap * rows) / sum(rows), 6) AS ece, round(max(gap), 6) AS mce FROM f)""")
def h16(spark: SparkSession, d: str) -> DataFrame:
    out = rounded(M.overall_metrics(scored(spark, d), "claim_key", 0.4))
    return out.withColumn("average_precision_lift", F.round("average_precision_lift", 4))


_GRAINS = "s2 AS (SELECT y, p, 'month' AS grain, strftime(claim_date, '%Y-%m') AS period FROM scored UNION ALL SELECT y, p, 'day', strftime(claim_date, '%Y-%m-%d') FROM scored)"


@query("h17_support_status", f"""{ctes(ANCHORS, SCORED)}, {_GRAINS}, {_rank('grain, period').replace('FROM scored', 'FROM s2')}
SELECT * REPLACE (CASE WHEN positives > 0 AND positives < rows THEN average_precision END AS average_precision, CASE WHEN positives > 0 AND positives < rows THEN roc_auc END AS roc_auc, CASE WHEN positives > 0 AND positives < rows THEN pr_auc END AS pr_auc), CASE WHEN rows < 75 OR positives < 5 OR rows - positives < 20 THEN 'LOW_SUPPORT' ELSE 'SUPPORTED' END AS support FROM r""")
def h17(spark: SparkSession, d: str) -> DataFrame:
    """All scored rows by month and by day, with the default gates."""
    grains = F.explode(F.array(*[F.struct(F.lit(n).alias("grain"), F.date_format("claim_date", f).alias("period")) for n, f in (("month", "yyyy-MM"), ("day", "yyyy-MM-dd"))])).alias("g")
    s = scored(spark, d).select("y", "p", grains).select("y", "p", "g.*")
    return rounded(M.support_status(M.ranking_metrics(s, ["grain", "period"])))


@query("h18_fold_metrics", f"""{ctes(ANCHORS, SCORED)}, {_rank('fold')} SELECT count(*) AS folds, {', '.join(f"round({f}({c}), 5) AS {c}_{n}" for c in ("average_precision", "roc_auc") for n, f in (("mean", "avg"), ("min", "min"), ("max", "max"), ("std", "stddev_pop")))} FROM r""")
def h18(spark: SparkSession, d: str) -> DataFrame:
    per = rounded(M.ranking_metrics(scored(spark, d), ["fold"]))
    return rounded(M.fold_summary(per, [], ["average_precision", "roc_auc"]), 5)


@query("h19_metric_comparison", f"""{ctes(ANCHORS, SCORED)}, {_rank()}, {_rank().replace('h AS', 'h2 AS').replace('FROM h)', 'FROM h2)').replace('c AS', 'c2 AS').replace('FROM c ', 'FROM c2 ').replace('r AS', 'r2 AS').replace('FROM scored', 'FROM (SELECT * REPLACE (p2 AS p) FROM scored)')},
m AS (SELECT 'average_precision' AS metric, r.average_precision AS baseline, r2.average_precision AS candidate FROM r, r2 UNION ALL SELECT 'roc_auc', r.roc_auc, r2.roc_auc FROM r, r2) SELECT *, round(candidate - baseline, 5) AS delta, round((candidate - baseline) / baseline, 5) AS relative_lift FROM m""")
def h19(spark: SparkSession, d: str) -> DataFrame:
    s = scored(spark, d)
    out = M.metric_comparison(rounded(M.ranking_metrics(s)), rounded(M.ranking_metrics(s, p="p2")), ["average_precision", "roc_auc"])
    return out.withColumns({c: F.round(c, 5) for c in ("delta", "relative_lift")})


def _exact(fold: int, at: str) -> str:
    """The ranking metrics of one fold, not rounded."""
    return f"(WITH {_rank().replace(', 6)', ', 15)').replace('FROM scored', f'FROM (SELECT * FROM scored WHERE fold = {fold})')} SELECT * FROM r) {at}"


_COMPARED = ("average_precision", "roc_auc", "log_loss", "brier", "prevalence")


@query("h20_generalization_status", f"""{ctes(ANCHORS, SCORED)}, x AS (SELECT v.*, {', '.join(f't.{n} AS t_{n}' for n in _COMPARED)}, CASE WHEN v.average_precision <> 0 THEN t.average_precision / v.average_precision ELSE 0.0 END AS ratio FROM {_exact(1, 'v')}, {_exact(2, 't')})
SELECT {', '.join(f'round({n}, 6) AS validation_{n}, round(t_{n}, 6) AS test_{n}, round(t_{n} - {n}, 6) AS {n}_difference' for n in _COMPARED)}, round(ratio, 6) AS ap_ratio,
CASE WHEN t_average_precision <= t_prevalence OR t_roc_auc <= 0.5 THEN 'SEVERE_DEGRADATION' WHEN ratio < 0.8 OR t_roc_auc < roc_auc - 0.05 THEN 'MODERATE_DEGRADATION' ELSE 'STABLE_GENERALIZATION' END AS generalization_status FROM x""")
def h20(spark: SparkSession, d: str) -> DataFrame:
    s = scored(spark, d)
    return rounded(M.generalization_status(M.ranking_metrics(s.filter("fold = 1")), M.ranking_metrics(s.filter("fold = 2"))))


@query("h21_prediction_membership", f"""{ctes(ANCHORS, SCORED)} SELECT 'a' AS candidate, 0 AS repeated_keys, 0 AS unexpected_keys, 0 AS out_of_bounds, count(*) FILTER (claim_key % 11 = 0) AS missing_keys FROM scored
UNION ALL SELECT 'b', count(*) FILTER (claim_key % 13 = 0), 0, count(*) FILTER (claim_key % 17 = 0) + count(*) FILTER (claim_key % 13 = 0 AND claim_key % 17 = 0), 0 FROM scored""")
def h21(spark: SparkSession, d: str) -> DataFrame:
    s = scored(spark, d)
    a = s.filter("claim_key % 11 <> 0").select(F.lit("a").alias("candidate"), "claim_key", "p")
    b = s.unionByName(s.filter("claim_key % 13 = 0")).select(F.lit("b").alias("candidate"), "claim_key", F.when(F.col("claim_key") % 17 == 0, 2.0).otherwise(F.col("p")).alias("p"))
    return M.prediction_membership(a.unionByName(b), s, "candidate", "claim_key")
