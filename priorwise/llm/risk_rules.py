"""Quality rules with risk-controlled cutoffs.

A rule rejects a text whose ratio exceeds a cutoff of a grid fixed beforehand.
A third of the labels (by identifier) orders the cutoffs of all rules into one
ladder, those first that reject the most bad texts for each good one; a cutoff
that does not pay is left out.  The other labels are the holdout, which the
ladder has not seen.

For each stratum (by default the language) the rungs are tried in order.  After
each, an exact binomial test on the stratum's good holdout texts must show that
all rules so far together reject at most ``RISK`` of them; the first rung that
fails ends the stratum's ladder.  As the order is fixed, a stratum costs one
error level, however many rules and cutoffs it tries; the levels of the strata
and of the pool share ``ERROR`` by Bonferroni.  A stratum with too few good
labels to prove even a ladder that rejects none of them uses the cutoffs of the
pool of all strata, whose promise holds for all of them together.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .scratch import materialize
from .text_stats import text_counts

#: All rules together may reject this share of a stratum's good texts.
RISK = 0.03
#: Chance that the promise breaks in any stratum or in the pool.
ERROR = 0.05
#: Cutoffs from lenient to strict.
GRID = tuple(float(f"{x:.4g}") for x in np.geomspace(4.0, 0.005, 60))
#: Bad texts that a rung must reject for each good one, half a good one added.
WORTH = 5.0
MIN_WORDS = 50


def _ratios() -> dict[str, Column]:
    def ratio(part: Column, of: Column) -> Column:
        return F.when(of > 0, part / of).otherwise(0.0)

    c = F.col
    return {
        "symbols": ratio(c("n_symbols"), c("word_chars")),
        "dup_lines": ratio(c("n_dup_lines"), c("n_lines")),
        "repeat_words": ratio(c("n_repeat_words"), c("n_words")),
        "upper": ratio(c("n_upper"), c("word_chars")),
        "marks": ratio(c("n_marks"), c("n_words")),
        "digits": ratio(c("n_digits"), c("word_chars")),
        "dense_stops": ratio(c("n_stops"), c("n_words")),
        "long_words": ratio(c("n_long_words"), c("n_words")),
    }


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p), summed from k down until terms vanish."""
    if k >= n:
        return 1.0
    term = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    value, total, j = math.exp(term), 0.0, k
    while j >= 0 and (value > total * 1e-15 or value > 1e-300):
        total += value
        if j == 0:
            break
        value *= j * (1 - p) / ((n - j + 1) * p)
        j -= 1
    return min(1.0, total)


def admissible(rejected: np.ndarray, n: int, level: float, risk: float = RISK) -> int:
    """Index of the strictest admissible cutoff, or -1; ``rejected`` from lenient to strict."""
    best = -1
    for i, k in enumerate(rejected):
        # the exact upper bound is at most ``risk`` just when this tail is at most ``level``
        if k >= risk * n or binomial_tail(int(k), n, risk) > level:
            break
        best = i
    return best


def build_ladder(bad: dict[str, np.ndarray], good: dict[str, np.ndarray], worth: float = WORTH) -> list[tuple[str, int]]:
    """(rule, place in the grid) in the order in which they are tried.

    ``bad`` and ``good`` count, per rule, the tuning texts that each cutoff is
    the first to reject.  Of a rule the steepest stretch of cutoffs comes first,
    then the steepest of the rest; ties go to the stretch that rejects more,
    then to the rule named first.
    """
    rungs = []
    for rule in bad:
        b, g, at, steepest = np.cumsum(bad[rule]), np.cumsum(good[rule]), -1, np.inf
        while at + 1 < len(b):
            more_b = b[at + 1 :] - (b[at] if at >= 0 else 0)
            more_g = g[at + 1 :] - (g[at] if at >= 0 else 0)
            value = more_b / (more_g + 0.5)
            best = int(np.lexsort((np.arange(len(value)), -more_b, -value))[0])
            steepest = min(steepest, float(value[best]))
            if steepest < worth:
                break
            at += 1 + best
            rungs.append((-steepest, -int(more_b[best]), len(rungs), rule, at))
    # a rule's own rungs keep their order, as their steepness never rises
    return [(rule, at) for *_, rule, at in sorted(rungs, key=lambda r: (r[0], r[2]))]


def tuning(id_col: Column) -> Column:
    """True for the third of the identifiers whose labels order the ladder."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 0, F.lit(False))


def cutoffs_of(rules: list[str], ladder: list[tuple[str, int]], last: int) -> dict[str, float | None]:
    """Each rule's strictest cutoff among the rungs up to ``last``; None where it has none."""
    at = dict.fromkeys(rules, -1)
    for rule, place in ladder[: last + 1]:
        at[rule] = max(at[rule], place)
    return {rule: GRID[place] if place >= 0 else None for rule, place in at.items()}


def learn_cutoffs(counts: DataFrame, labels: DataFrame, stratum: str = "lang", id_col: str = "doc_id", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """stratum, a cutoff per rule (null: the rule is off) and pooled.

    ``counts`` holds id, stratum and the counts of every text; ``labels`` id and
    quality (of contradicting ones the lower holds).  Good texts are those of
    quality 1; only texts that pass the base rule count.  Every stratum of
    ``counts`` has a row.
    """
    rules = _ratios()
    known = labels.filter(F.col("quality").isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__label")).agg(F.min("quality").alias("__quality"))
    rows = counts.filter(~base_failed()).join(known, F.col(id_col) == F.col("__label"))
    # the most lenient cutoff that rejects a text: its place in the grid, per rule
    cells = {r: F.lit(len(GRID)) - F.size(F.filter(F.array(*[F.lit(g) for g in GRID]), lambda g: g < x)) for r, x in rules.items()}  # noqa: B023
    celled = materialize(rows.select(F.col(stratum).alias("stratum"), tuning(F.col(id_col)).alias("tuning"), F.col("__quality").alias("quality"), *[x.alias(f"cell_{r}") for r, x in cells.items()]), "rule-cells")
    pairs = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"cell_{r}").alias("cell")) for r in rules])).alias("p")
    # at most two rows for each rule and cutoff
    tallies = celled.filter("tuning").select("quality", pairs).groupBy("quality", "p.rule", "p.cell").agg(F.count(F.lit(1)).alias("n")).collect()
    seen = {q: {r: np.zeros(len(GRID)) for r in rules} for q in (0, 1)}
    for row in tallies:
        if row["cell"] < len(GRID):
            seen[row["quality"]][row["rule"]][row["cell"]] = row["n"]
    ladder = build_ladder(seen[0], seen[1])
    never = len(ladder)
    # the rung that first rejects a text of each cell
    first = {r: [min((k for k, (rule, at) in enumerate(ladder) if rule == r and at >= c), default=never) for c in range(len(GRID) + 1)] for r in rules}
    rung = F.least(*[F.get(F.array(*[F.lit(k) for k in first[r]]), F.col(f"cell_{r}")) for r in rules])
    tried = celled.filter("not tuning and quality = 1").groupBy("stratum", rung.alias("rung")).agg(F.count(F.lit(1)).alias("n"))
    tried = materialize(tried, "rule-tallies")
    strata = materialize(counts.select(F.col(stratum).alias("stratum")).distinct(), "rule-strata")
    level = error / (strata.count() + 1)
    names = list(rules)

    def last_rung(rungs: np.ndarray, n: np.ndarray) -> int:
        hist = np.bincount(rungs.astype(int), weights=n.astype(float), minlength=never + 1)
        return admissible(np.cumsum(hist)[:never], int(hist.sum()), level, risk)

    # at most one row a rung
    pool = tried.groupBy("rung").agg(F.sum("n").alias("n")).toPandas()
    pooled = last_rung(pool["rung"].to_numpy(), pool["n"].to_numpy())

    def choose(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        some = pdf[pdf["n"].notna()]
        alone = binomial_tail(0, int(some["n"].sum()), risk) <= level
        last = last_rung(some["rung"].to_numpy(), some["n"].to_numpy()) if alone else pooled
        cuts = cutoffs_of(names, ladder, last)
        return pd.DataFrame([{"stratum": key[0], **{f"cut_{r}": cuts[r] for r in cuts}, "pooled": not alone}])

    ddl = "stratum string, " + ", ".join(f"cut_{r} double" for r in rules) + ", pooled boolean"
    every = strata.join(tried.withColumnRenamed("stratum", "of"), F.col("stratum").eqNullSafe(F.col("of")), "left").select("stratum", "rung", "n")
    return every.groupBy("stratum").applyInPandas(choose, ddl)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def apply_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, the counts, base_failed, kept, rejected_by.

    A null text counts as empty and fails the base rule.  A null stratum is one
    of its own; a stratum with too few good labels uses the cutoffs of the pool,
    and where the pool has too few as well, the base rule alone decides.  Rows
    that repeat count as rows; repeated labels count once.  Other columns are
    ignored; an empty table gives an empty result.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(stratum).cast("string").alias("stratum"), F.col(text_col).alias("text"))
    counts = materialize(text_counts(slim, ["doc_id", "stratum"]), "rule-counts")
    cuts = learn_cutoffs(counts, labels, "stratum", "doc_id")
    # written, so that its true size decides how it is joined
    cuts = materialize(cuts, "rule-cutoffs").withColumnRenamed("stratum", "of")
    joined = counts.join(cuts, F.col("stratum").eqNullSafe(F.col("of")), "left")
    hits = F.filter(F.array(*[F.when(x > F.col(f"cut_{r}"), F.lit(r)) for r, x in _ratios().items()]), lambda r: r.isNotNull())
    out = joined.withColumns({"base_failed": base_failed(), "rejected_by": hits})
    kept = ~F.col("base_failed") & (F.size("rejected_by") == 0)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "rejected_by")
