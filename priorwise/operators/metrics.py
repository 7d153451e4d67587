"""Evaluation of scores: key, y in {0, 1}, p in [0, 1], by any grouping.

Rows are first collapsed to distinct scores.  Running sums are taken in two
levels, over cells of the score range and within a cell, so no window holds all
distinct scores of a group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from priorwise.functions.exprs import clip, grid_cell
from priorwise.sources.tables import written

CELLS = 1000
EPS = 2.220446049250313e-16


def validate_scores(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """One row: rows, and counts that must be zero: invalid labels, invalid scores."""
    ok = F.col(p).isNotNull() & ~F.isnan(p) & F.col(p).between(0, 1)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.coalesce(F.col(y).isin(0, 1), F.lit(False))).alias("invalid_labels"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("invalid_scores"))


def score_histogram(df: DataFrame, groups: Sequence[str] = (), y: str = "y", p: str = "p", weight: str | None = None) -> DataFrame:
    """groups, p, pos, neg, cell: weights of positives and negatives per distinct score."""
    w = F.col(weight) if weight else F.lit(1)
    g = df.groupBy(*groups, F.col(p).alias("p")).agg(F.sum(F.when(F.col(y) == 1, w).otherwise(0)).alias("pos"), F.sum(F.when(F.col(y) == 0, w).otherwise(0)).alias("neg"))
    return g.withColumn("cell", grid_cell(F.col("p"), CELLS))


def cumulative(hist: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Adds tp, fp (scores of p or more), n_pos, n_neg."""
    cells = hist.groupBy(*groups, "cell").agg(F.sum("pos").alias("cp"), F.sum("neg").alias("cn"))
    above = Window.partitionBy(*groups).orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    cells = cells.withColumns({"ap": F.coalesce(F.sum("cp").over(above), F.lit(0)), "an": F.coalesce(F.sum("cn").over(above), F.lit(0)), "n_pos": F.sum("cp").over(whole), "n_neg": F.sum("cn").over(whole)})
    renamed = cells.select(*[F.col(g).alias(f"__{g}") for g in groups], F.col("cell").alias("__cell"), "ap", "an", "n_pos", "n_neg")
    on = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in groups], F.col("cell") == F.col("__cell"))
    within = Window.partitionBy(*groups, "cell").orderBy(F.desc("p"))
    j = hist.withColumns({"ip": F.sum("pos").over(within), "in": F.sum("neg").over(within)}).join(renamed, on)
    return j.select(*groups, "p", "pos", "neg", (F.col("ap") + F.col("ip")).alias("tp"), (F.col("an") + F.col("in")).alias("fp"), "n_pos", "n_neg")


def ranking_metrics(df: DataFrame, groups: Sequence[str] = (), y: str = "y", p: str = "p", weight: str | None = None) -> DataFrame:
    """Per group: average_precision, roc_auc, pr_auc, log_loss, brier, rows, positives, prevalence, mean_p.

    Ties are one threshold.  roc_auc is 0 with one class, average_precision 0
    without positives.
    """
    c = cumulative(score_histogram(df, groups, y, p, weight), groups)
    tp, fp, pos, neg, P, N = (F.col(x) for x in ("tp", "fp", "pos", "neg", "n_pos", "n_neg"))
    precision = tp / (tp + fp)
    before = F.when(tp + fp - pos - neg > 0, (tp - pos) / (tp + fp - pos - neg)).otherwise(1.0)
    step = F.when(P > 0, pos / P).otherwise(0.0)
    q = clip(F.col("p"), EPS, 1 - EPS)
    n = pos + neg
    out = c.groupBy(*groups).agg(
        F.sum(step * precision).alias("average_precision"), F.coalesce(F.sum(F.when((P > 0) & (N > 0), neg * (tp - pos + pos / 2.0) / (P * N))), F.lit(0.0)).alias("roc_auc"), F.sum(step * (precision + before) / 2.0).alias("pr_auc"),
        (-F.sum(pos * F.log(q) + neg * F.log(1 - q)) / F.sum(n)).alias("log_loss"), (F.sum(pos * (F.col("p") - 1) * (F.col("p") - 1) + neg * F.col("p") * F.col("p")) / F.sum(n)).alias("brier"),
        F.sum(n).alias("rows"), F.sum(pos).alias("positives"), (F.sum(pos) / F.sum(n)).alias("prevalence"), (F.sum(F.col("p") * n) / F.sum(n)).alias("mean_p"),
    )
    return out


def confusion_columns(tp: Column, fp: Column, tn: Column, fn: Column) -> dict[str, Column]:
    """All threshold metrics; a ratio over nothing is 0."""
    tp, fp, tn, fn = (x.cast("double") for x in (tp, fp, tn, fn))
    d = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    pr, rc, sp = d(tp, tp + fp), d(tp, tp + fn), d(tn, tn + fp)
    f = lambda b2: d((1 + b2) * pr * rc, b2 * pr + rc)
    return {
        "precision": pr, "recall": rc, "specificity": sp, "npv": d(tn, tn + fn), "fpr": d(fp, fp + tn), "fnr": d(fn, fn + tp), "f1": f(1.0), "f2": f(4.0), "balanced_accuracy": (rc + sp) / 2.0,
        "mcc": d(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))), "accuracy": d(tp + tn, tp + fp + tn + fn), "predicted_positives": (tp + fp).cast("long"),
    }


def confusion_metrics(df: DataFrame, threshold: float | Column, groups: Sequence[str] = (), y: str = "y", p: str = "p") -> DataFrame:
    """Per group tp, fp, tn, fn and their metrics at p >= threshold."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    hit, pos = F.col(p) >= t, F.col(y) == 1
    g = df.groupBy(*groups).agg(F.count_if(hit & pos).alias("tp"), F.count_if(hit & ~pos).alias("fp"), F.count_if(~hit & ~pos).alias("tn"), F.count_if(~hit & pos).alias("fn"))
    return g.withColumns(confusion_columns(*[F.col(c) for c in ("tp", "fp", "tn", "fn")]))


def threshold_curve(df: DataFrame, groups: Sequence[str] = (), y: str = "y", p: str = "p") -> DataFrame:
    """confusion_metrics at 0.001 to 0.999, from one histogram of 1001 cells a group."""
    h = df.groupBy(*groups, grid_cell(F.col(p), CELLS).alias("cell")).agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))
    grid = h.select(*groups).distinct() if groups else h.select(F.lit(1).alias("__one")).distinct()
    grid = grid.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(CELLS))))
    h = h.withColumnsRenamed({g: f"__{g}" for g in groups}).withColumnRenamed("cell", "__cell")
    on = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in groups], F.col("cell") == F.col("__cell"))
    j = grid.join(h, on, "left").select(*groups, "cell", F.coalesce("pos", F.lit(0)).alias("pos"), F.coalesce("neg", F.lit(0)).alias("neg"))
    up, whole = Window.partitionBy(*groups).orderBy(F.desc("cell")), Window.partitionBy(*groups)
    c = j.withColumns({"tp": F.sum("pos").over(up), "fp": F.sum("neg").over(up), "P": F.sum("pos").over(whole), "N": F.sum("neg").over(whole)}).filter((F.col("cell") >= 1) & (F.col("cell") < CELLS))
    c = c.select(*groups, (F.col("cell") / float(CELLS)).alias("threshold"), "tp", "fp", (F.col("N") - F.col("fp")).alias("tn"), (F.col("P") - F.col("tp")).alias("fn"))
    return c.withColumns(confusion_columns(*[F.col(x) for x in ("tp", "fp", "tn", "fn")]))


_TIE = 12


def select_threshold(curve: DataFrame, groups: Sequence[str] = (), tolerance: float = 1e-12) -> DataFrame:
    """Per group the row of greatest MCC; within the tolerance higher F2, recall, precision, then the lower threshold."""
    best = F.max("mcc").over(Window.partitionBy(*groups))
    order = [F.desc(F.round(c, _TIE)) for c in ("f2", "recall", "precision")] + [F.asc("threshold")]
    near = curve.withColumn("__best", best).filter(F.col("mcc") >= F.col("__best") - tolerance)
    return near.withColumn("__r", F.row_number().over(Window.partitionBy(*groups).orderBy(*order))).filter("__r = 1").drop("__best", "__r").withColumn("method", F.lit("MCC_MAX"))


def select_alternatives(curve: DataFrame, groups: Sequence[str] = (), metrics: Sequence[str] = ("f1", "f2", "balanced_accuracy"), tolerance: float = 1e-12) -> DataFrame:
    """Per group and metric the lowest threshold whose value is within the tolerance of the greatest."""
    parts = []
    for m in metrics:
        near = curve.withColumn("__best", F.max(m).over(Window.partitionBy(*groups))).filter(F.col(m) >= F.col("__best") - tolerance)
        parts.append(near.groupBy(*groups).agg(F.min("threshold").alias("threshold")).withColumn("method", F.lit(f"{m.upper()}_MAX")))
    return reduce(DataFrame.unionByName, parts)


def precision_at_recall(curve: DataFrame, groups: Sequence[str] = (), levels: Sequence[float] = (0.5, 0.7, 0.8, 0.9)) -> DataFrame:
    """Per group and level the best precision with at least that recall: higher recall, then lower threshold, on ties."""
    levels_col = F.explode(F.array(*[F.lit(float(x)) for x in levels])).alias("min_recall")
    x = curve.select("*", levels_col).filter(F.col("recall") >= F.col("min_recall"))
    order = Window.partitionBy(*groups, "min_recall").orderBy(F.desc(F.round("precision", _TIE)), F.desc(F.round("recall", _TIE)), "threshold")
    return x.withColumn("__r", F.row_number().over(order)).filter("__r = 1").select(*groups, "min_recall", "threshold", "precision", "recall")


def pareto_frontier(curve: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Distinct (recall, precision) points that no other point dominates."""
    pts = curve.groupBy(*groups, F.round("recall", _TIE).alias("recall"), F.round("precision", _TIE).alias("precision")).agg(F.min("threshold").alias("threshold"))
    order = Window.partitionBy(*groups).orderBy(F.desc("recall"), F.desc("precision")).rowsBetween(Window.unboundedPreceding, -1)
    best = F.max("precision").over(order)
    return pts.withColumn("__b", best).filter(F.col("__b").isNull() | (F.col("precision") > F.col("__b"))).drop("__b")


def global_place(df: DataFrame, order: Sequence[Column], cell: Column, groups: Sequence[str] = ()) -> DataFrame:
    """Adds place (from 0) and total in the order of (cell, order) within each group.

    Rows are range-partitioned by sampled splitters over group, cell and the
    whole order, so neither a hot group nor a cell that holds most rows (a
    constant score, one date) comes to one task; ``order`` should end in a key.
    The sorted rows are written, numbered within their partition, and a count
    for each group and partition gives what lies before.
    """
    x = df.withColumn("__c", cell)
    keys = [*[F.col(g) for g in groups], F.col("__c"), *order]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = x.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("__id", F.monotonically_increasing_id()).withColumn("__part", F.shiftright("__id", 33)).drop("__c")
    rows = written(rows, "places")
    counts = rows.groupBy(*groups, "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__id").alias("__first"))
    before = Window.partitionBy(*groups).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns({"__off": F.coalesce(F.sum("__n").over(before), F.lit(0)), "total": F.sum("__n").over(Window.partitionBy(*groups))}).drop("__n")
    counts = counts.withColumnsRenamed({g: f"__g_{g}" for g in groups} | {"__part": "__of"})
    on = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__g_{g}")) for g in groups], F.col("__part") == F.col("__of"))
    return rows.join(counts, on).withColumn("place", F.col("__off") + F.col("__id") - F.col("__first")).drop("__id", "__part", "__of", "__first", "__off", *[f"__g_{g}" for g in groups])


def near_equal_bin(place: Column, total: Column, bins: int) -> Column:
    """0-based bin when the first total % bins bins have one row more."""
    base, extra = F.floor(total / bins), total % bins
    cut = extra * (base + 1)
    return F.when(place < cut, F.floor(place / (base + 1))).otherwise(extra + F.floor((place - cut) / F.greatest(base, F.lit(1)))).cast("int")


def reliability_equal_freq(df: DataFrame, key: str, bins: int = 10, groups: Sequence[str] = (), y: str = "y", p: str = "p") -> DataFrame:
    """Per bin of near-equal size by (p, key): rows, mean p, observed rate, gap."""
    x = global_place(df, [F.col(p), F.col(key)], grid_cell(F.col(p), CELLS), groups)
    g = x.groupBy(*groups, (near_equal_bin(F.col("place"), F.col("total"), bins) + 1).alias("bin")).agg(F.count(F.lit(1)).alias("rows"), F.avg(p).alias("mean_p"), F.avg(y).alias("observed"))
    return g.withColumn("gap", F.abs(F.col("mean_p") - F.col("observed")))


def reliability_equal_width(df: DataFrame, bins: int = 10, y: str = "y", p: str = "p") -> DataFrame:
    """Per fixed bin, empty ones included: bounds, rows, mean p, observed rate, gap."""
    b = F.least(grid_cell(F.col(p), bins), F.lit(bins - 1))
    g = df.groupBy(b.alias("b")).agg(F.count(F.lit(1)).alias("rows"), F.avg(p).alias("mean_p"), F.avg(y).alias("observed"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("k"))
    j = grid.join(g, F.col("k") == F.col("b"), "left")
    zero = F.lit(0.0)
    out = j.select((F.col("k") + 1).alias("bin"), (F.col("k") / float(bins)).alias("lower"), ((F.col("k") + 1) / float(bins)).alias("upper"), F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("mean_p", zero).alias("mean_p"), F.coalesce("observed", zero).alias("observed"))
    return out.withColumn("gap", F.abs(F.col("mean_p") - F.col("observed")))


def ece_mce(table: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Weighted mean and greatest gap of a reliability table."""
    return table.groupBy(*groups).agg((F.sum(F.col("gap") * F.col("rows")) / F.sum("rows")).alias("ece"), F.max("gap").alias("mce"))


def _join(a: DataFrame, b: DataFrame, groups: Sequence[str]) -> DataFrame:
    return a.join(b, list(groups)) if groups else a.crossJoin(b)


def probability_metrics(df: DataFrame, key: str, groups: Sequence[str] = (), y: str = "y", p: str = "p") -> DataFrame:
    """ranking_metrics with the equal-frequency ECE and MCE."""
    return _join(ranking_metrics(df, groups, y, p), ece_mce(reliability_equal_freq(df, key, 10, groups, y, p), groups), groups)


def overall_metrics(df: DataFrame, key: str, threshold: float, groups: Sequence[str] = (), y: str = "y", p: str = "p") -> DataFrame:
    """probability_metrics and confusion_metrics, the lift of average precision, and whether there is signal."""
    out = _join(probability_metrics(df, key, groups, y, p), confusion_metrics(df, threshold, groups, y, p), groups)
    lift = F.when(F.col("prevalence") > 0, F.col("average_precision") / F.col("prevalence"))
    return out.withColumns({"average_precision_lift": lift, "signal_pass": (F.col("average_precision") > F.col("prevalence")) & (F.col("roc_auc") > 0.5)})


def support_status(metrics: DataFrame, rows: int = 75, positives: int = 5, negatives: int = 20) -> DataFrame:
    """Adds support; ranking metrics of one class become null."""
    neg = F.col("rows") - F.col("positives")
    one = (F.col("positives") == 0) | (neg == 0)
    low = (F.col("rows") < rows) | (F.col("positives") < positives) | (neg < negatives)
    cols = {c: F.when(~one, F.col(c)) for c in ("average_precision", "roc_auc", "pr_auc") if c in metrics.columns}
    return metrics.withColumns(cols | {"support": F.when(low, "LOW_SUPPORT").otherwise("SUPPORTED")})


def fold_summary(metrics: DataFrame, groups: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Over folds: mean, min, max and deviation (ddof 0) of each metric."""
    return metrics.groupBy(*groups).agg(F.count(F.lit(1)).alias("folds"), *[f(c).alias(f"{c}_{n}") for c in columns for n, f in (("mean", F.avg), ("min", F.min), ("max", F.max), ("std", F.stddev_pop))])


def metric_comparison(base: DataFrame, candidate: DataFrame, columns: Sequence[str]) -> DataFrame:
    """metric, baseline, candidate, delta, relative lift (null over 0) of two one-row frames."""
    cells = lambda df, n: df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias(n)) for c in columns])).alias("x")).select("x.*")
    j = cells(base, "baseline").join(cells(candidate, "candidate"), "metric")
    delta = F.col("candidate") - F.col("baseline")
    return j.withColumns({"delta": delta, "relative_lift": F.when(F.col("baseline") != 0, delta / F.col("baseline"))})


def generalization_status(validation: DataFrame, test: DataFrame, ap_ratio: float = 0.8, roc_drop: float = 0.05) -> DataFrame:
    """One row of differences between two one-row metric frames, and STABLE, MODERATE or SEVERE."""
    names = ("average_precision", "roc_auc", "log_loss", "brier", "prevalence")
    v = validation.select(*[F.col(c).alias(f"validation_{c}") for c in names])
    t = test.select(*[F.col(c).alias(f"test_{c}") for c in names])
    c = F.col
    ratio = F.when(c("validation_average_precision") != 0, c("test_average_precision") / c("validation_average_precision")).otherwise(0.0)
    status = F.when((c("test_average_precision") <= c("test_prevalence")) | (c("test_roc_auc") <= 0.5), "SEVERE_DEGRADATION").when((c("ap_ratio") < ap_ratio) | (c("test_roc_auc") < c("validation_roc_auc") - roc_drop), "MODERATE_DEGRADATION").otherwise("STABLE_GENERALIZATION")
    return v.crossJoin(t).withColumns({"ap_ratio": ratio} | {f"{n}_difference": c(f"test_{n}") - c(f"validation_{n}") for n in names}).withColumn("generalization_status", status)


def prediction_membership(scored: DataFrame, expected: DataFrame, candidate: str, key: str, p: str = "p") -> DataFrame:
    """Per candidate counts that must be zero: repeated, missing and unexpected keys, scores out of bounds."""
    n_expected = expected.select(key).distinct().agg(F.count(F.lit(1)).alias("__e"))
    known = expected.select(F.col(key).alias("__k")).distinct()
    per = scored.groupBy(candidate, key).agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.coalesce(F.col(p).between(0, 1), F.lit(False))).alias("bad"))
    j = per.join(known, F.col(key) == F.col("__k"), "left")
    g = j.groupBy(candidate).agg(F.count_if(F.col("n") > 1).alias("repeated_keys"), F.count_if(F.col("__k").isNotNull()).alias("__hit"), F.count_if(F.col("__k").isNull()).alias("unexpected_keys"), F.sum("bad").alias("out_of_bounds"))
    return g.crossJoin(n_expected).withColumn("missing_keys", F.col("__e") - F.col("__hit")).drop("__e", "__hit")
