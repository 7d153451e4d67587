"""Model matrix, weights, calibration, blending and importance, on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, Window, functions as F

from priorwise.functions.exprs import logit
from priorwise.sources.tables import written

from .fold_fits import fit_folds, fold_rows, score_folds
from .metrics import ranking_metrics

MISSING, NO_HISTORY = "__MISSING__", "__NO_HISTORY__"
BLEND_WEIGHTS = tuple(k / 10 for k in range(11))
#: Weight of the positive class by strategy; the last two come from class counts.
FIXED_WEIGHTS = {"none": 1.0, "positive_2": 2.0, "positive_4": 4.0, "positive_8": 8.0, "positive_16": 16.0, "positive_32": 32.0}


def adapt_matrix(df: DataFrame, numeric: Sequence[str] = (), boolean: Sequence[str] = (), categorical: Sequence[str] = (), text: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Numbers as double or null, booleans 0/1 (others fail), missing categories and texts as tokens, in this order."""
    flag = lambda c: F.when(F.col(c).isNull(), None).when(F.col(c).cast("int").isin(0, 1), F.col(c).cast("int")).otherwise(F.raise_error(F.lit(f"{c} is not boolean")))
    return df.select(
        *keep, *[F.col(c).try_cast("double").alias(c) for c in numeric], *[flag(c).cast("int").alias(c) for c in boolean],
        *[F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias(c) for c in categorical], *[F.coalesce(F.col(c).cast("string"), F.lit(NO_HISTORY)).alias(c) for c in text])


def development_frame(structured: DataFrame, text: DataFrame, assignments: DataFrame, key: str) -> DataFrame:
    """Structured and text features with the split, TEST left out."""
    return structured.join(text, key).join(assignments.select(key, "split"), key).filter("split <> 'TEST'")


def feature_sets(catalog: DataFrame, text_features: Sequence[str], text_columns: Sequence[str]) -> DataFrame:
    """set_name, feature: nested sets E1 (CORE), E2 (with EXTENDED), E3 (with lexical), E4 (with texts)."""
    spark = catalog.sparkSession
    tiers = catalog.select("feature", F.when(F.col("tier") == "CORE", 1).otherwise(2).alias("level"))
    more = spark.createDataFrame([(f, 3) for f in text_features] + [(f, 4) for f in text_columns], "feature string, level int")
    sets = spark.range(1, 5).select(F.col("id").cast("int").alias("k"))
    return tiers.unionByName(more).join(F.broadcast(sets), F.col("level") <= F.col("k")).select(F.concat(F.lit("E"), "k").alias("set_name"), "feature")


def prevalence_baseline(train: DataFrame, other: DataFrame, y: str = "y") -> DataFrame:
    """``other`` with p, the constant share of positives in train."""
    return other.crossJoin(F.broadcast(train.agg(F.avg(y).alias("p"))))


def class_weights(train: DataFrame, y: str = "y") -> DataFrame:
    """strategy, positive_weight for the eight strategies."""
    n = train.agg(F.count_if(F.col(y) == 0).alias("n0"), F.count_if(F.col(y) == 1).alias("n1"))
    auto = {"auto_sqrt": F.sqrt(F.col("n0") / F.col("n1")), "auto_balanced": F.col("n0") / F.col("n1")}
    cells = [F.struct(F.lit(k).alias("strategy"), F.lit(v).alias("positive_weight")) for k, v in FIXED_WEIGHTS.items()] + [F.struct(F.lit(k).alias("strategy"), v.alias("positive_weight")) for k, v in auto.items()]
    return n.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


def fit_classifier(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], y: str = "y", weight: str | None = None, kind: str = "logistic", seed: int = 17, tol: float = 1e-6) -> PipelineModel:
    """A pipeline fitted on train rows only: impute, index and encode, then a logistic or boosted-tree model."""
    steps = [Imputer(inputCols=list(numeric), outputCols=[f"{c}__i" for c in numeric], strategy="median")]
    if categorical:
        steps += [StringIndexer(inputCols=list(categorical), outputCols=[f"{c}__x" for c in categorical], handleInvalid="keep"), OneHotEncoder(inputCols=[f"{c}__x" for c in categorical], outputCols=[f"{c}__h" for c in categorical])]
    steps.append(VectorAssembler(inputCols=[*[f"{c}__i" for c in numeric], *[f"{c}__h" for c in categorical]], outputCol="features"))
    options = {"featuresCol": "features", "labelCol": y} | ({"weightCol": weight} if weight else {})
    model = LogisticRegression(**options, regParam=0.01, tol=tol) if kind == "logistic" else GBTClassifier(**options, maxIter=20, maxDepth=4, seed=seed)
    return Pipeline(stages=[*steps, model]).fit(train)


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """keep columns and p of a fitted pipeline."""
    return model.transform(df).select(*keep, vector_to_array("probability")[1].alias("p"))


def oof_scores(df: DataFrame, folds: DataFrame, key: str, numeric: Sequence[str], categorical: Sequence[str], y: str = "y", kind: str = "logistic") -> DataFrame:
    """key, y, fold_id, p: each fold's validation rows scored by a fit on its train rows.

    Logistic models of all folds are fitted together, one pass a step
    (:mod:`fold_fits`); trees, and designs too wide for that, one fold at a time.
    Every step of every fold reads df and folds again then, so both are written
    first; nothing stays in the executors' memory.
    """
    if kind == "logistic":
        rows, ids = fold_rows(df, folds, key, numeric, categorical, y)
        fits = fit_folds(rows, ids, numeric, categorical)
        if fits:
            return score_folds(rows, fits, key, y)
    df, folds = written(df, "oof-rows"), written(folds, "oof-folds")
    parts = []
    for (fold,) in folds.select("fold_id").distinct().orderBy("fold_id").collect():  # a handful of folds
        of = folds.filter(F.col("fold_id") == fold)
        rows = df.join(of, key)
        model = fit_classifier(rows.filter("role = 'TRAIN'"), numeric, categorical, y, kind=kind)
        parts.append(score(model, rows.filter("role = 'VALIDATION'"), [key, y, "fold_id"]))
    return reduce(DataFrame.unionByName, parts)


def fit_sigmoid(df: DataFrame, y: str = "y", p: str = "p") -> tuple[float, float]:
    """Slope and intercept of an unpenalised logistic fit on the logit of p."""
    x = VectorAssembler(inputCols=["__l"], outputCol="__f").transform(df.withColumn("__l", logit(F.col(p))))
    m = LogisticRegression(featuresCol="__f", labelCol=y, regParam=0.0, maxIter=200, tol=1e-10, standardization=False).fit(x)
    return float(m.coefficients[0]), float(m.intercept)


def apply_sigmoid(p: Column, slope: float, intercept: float) -> Column:
    return 1.0 / (1.0 + F.exp(-(slope * logit(p) + intercept)))


def isotonic_eligible(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """One row: whether there are 20 positives, 100 negatives and 50 distinct scores."""
    return df.agg(F.count_if(F.col(y) == 1).alias("positives"), F.count_if(F.col(y) == 0).alias("negatives"), F.count_distinct(p).alias("distinct_scores")).withColumn("eligible", (F.col("positives") >= 20) & (F.col("negatives") >= 100) & (F.col("distinct_scores") >= 50))


def fit_isotonic(df: DataFrame, y: str = "y", p: str = "p") -> IsotonicRegressionModel:
    """Isotonic fit of the exact scores; equal scores are one point of their weight."""
    x = df.groupBy(F.col(p).cast("double").alias("features")).agg(F.avg(F.col(y).cast("double")).alias("label"), F.count(F.lit(1)).cast("double").alias("weight"))
    return IsotonicRegression(isotonic=True, weightCol="weight").fit(x)


def calibrate_isotonic(df: DataFrame, model: IsotonicRegressionModel, p: str = "p") -> DataFrame:
    """p calibrated by the model itself: interpolated between breakpoints, flat outside, kept within 0 and 1; null stays null."""
    some = model.transform(df.filter(F.col(p).isNotNull()).withColumn("features", F.col(p).cast("double")))
    some = some.withColumn(p, F.least(F.greatest("prediction", F.lit(0.0)), F.lit(1.0))).select(*df.columns)
    return some.unionByName(df.filter(F.col(p).isNull()))


def apply_isotonic(p: Column, points: Sequence[tuple[float, float]]) -> Column:
    """Linear interpolation between breakpoints, flat outside, kept within 0 and 1."""
    xs = F.array(*[F.lit(float(a)) for a, _ in points])
    ys = F.array(*[F.lit(float(b)) for _, b in points])
    k = F.size(F.filter(xs, lambda x: x <= p))
    x0, x1, y0, y1 = F.get(xs, k - 1), F.get(xs, k), F.get(ys, k - 1), F.get(ys, k)
    mid = F.when(x1 > x0, y0 + (y1 - y0) * (p - x0) / (x1 - x0)).otherwise(y0)
    out = F.when(p.isNull(), None).when(k == 0, F.get(ys, F.lit(0))).when(k == len(points), F.get(ys, F.lit(len(points) - 1))).otherwise(mid)
    return F.least(F.greatest(out, F.lit(0.0)), F.lit(1.0))


def blend(p1: Column, p2: Column, weight: Column | float) -> Column:
    """w * p1 + (1 - w) * p2; a weight or result outside 0 to 1 fails the query."""
    w = weight if isinstance(weight, Column) else F.lit(float(weight))
    out = w * p1 + (1 - w) * p2
    return F.when(w.between(0, 1) & out.between(0, 1), out).otherwise(F.raise_error(F.lit("a blend is out of bounds")))


def blend_grid(df: DataFrame, p1: str, p2: str, groups: Sequence[str] = (), weights: Sequence[float] = BLEND_WEIGHTS) -> DataFrame:
    """Ranking metrics of each weight (and group)."""
    w = F.explode(F.array(*[F.lit(float(x)) for x in weights])).alias("weight")
    x = df.select(*groups, "y", p1, p2, w).withColumn("p", blend(F.col(p1), F.col(p2), F.col("weight")))
    return ranking_metrics(x, [*groups, "weight"])


def score_frozen(df: DataFrame, p1: str, p2: str, slope: float, intercept: float, weight: float, threshold: float) -> DataFrame:
    """Raw and calibrated scores, their blend, and the class at the threshold."""
    out = df.withColumn("effective_p", apply_sigmoid(F.col(p1), slope, intercept))
    out = out.withColumn("final_p", blend(F.col("effective_p"), F.col(p2), weight))
    return out.withColumn("predicted", (F.col("final_p") >= threshold).cast("int"))


def select_oof(scores: DataFrame, champions: DataFrame) -> DataFrame:
    """Rows of each track's champion strategy, with the calibrated score where the champion is calibrated."""
    j = scores.join(champions.select("track", "strategy", "calibrated"), ["track", "strategy"])
    return j.withColumn("p", F.when(F.col("calibrated"), F.col("calibrated_p")).otherwise(F.col("raw_p")))


def importance_stability(df: DataFrame, feature: str, fold: str, loss: str, contribution: str) -> DataFrame:
    """Per feature over folds: median percentile ranks, top-quarter and top-half counts, rank deviations, score of .6 and .4."""
    n = F.greatest(F.count(F.lit(1)).over(Window.partitionBy(fold)) - 1, F.lit(1))
    place = lambda c: F.row_number().over(Window.partitionBy(fold).orderBy(F.desc(c), feature))
    x = df.withColumns({"lr": place(loss), "cr": place(contribution), "n": n})
    x = x.withColumns({"lp": 1.0 - (F.col("lr") - 1) / F.col("n"), "cp": 1.0 - (F.col("cr") - 1) / F.col("n")})
    half = F.lit(0.5)
    g = x.groupBy(feature).agg(F.percentile("lp", half).alias("median_loss_percentile"), F.percentile("cp", half).alias("median_contribution_percentile"), F.count_if(F.col("lp") >= 0.75).alias("top_25_folds"), F.count_if(F.col("lp") >= 0.5).alias("top_50_folds"), F.stddev_pop("lr").alias("loss_rank_std"), F.stddev_pop("cr").alias("contribution_rank_std"))
    return g.withColumn("stable_score", 0.6 * F.col("median_loss_percentile") + 0.4 * F.col("median_contribution_percentile"))


def feature_families(features: DataFrame, rules: DataFrame) -> DataFrame:
    """feature, families, family: by name prefix; not exactly one family makes family null."""
    j = features.join(rules, F.startswith(F.col("feature"), F.col("prefix")))
    g = j.groupBy("feature").agg(F.count_distinct("family").alias("families"), F.min("family").alias("family"))
    return features.join(g, "feature", "left").select("feature", F.coalesce("families", F.lit(0)).alias("families"), F.when(F.col("families") == 1, F.col("family")).alias("family"))
