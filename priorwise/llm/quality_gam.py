"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees on one feature at a time are boosted in cycles over the features;
each adds its leaf values to that feature's lookup table of bins.  Then pairs
are ranked by the loss that a tree on both features removes, and the best get
tables of their own by further cycles.  A score is the logistic of the
intercept plus one entry from each table, added for whole batches at once.

The fit takes at most ``max_rows`` labelled rows (a documented bound), those
with the least hash of their identifier, on ratios of counts over whole texts.
Neither labels nor identifier, language or source is a feature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .scratch import materialize, ship
from .text_stats import COUNTS, text_counts

MAX_ROWS = 40_000
#: feature -> (count, count it is divided by)
RATIOS = {
    "symbols_per_char": ("n_symbols", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "upper_per_char": ("n_upper", "word_chars"),
    "digits_per_char": ("n_digits", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
    "stops_per_word": ("n_stops", "n_words"),
    "punctuation_per_char": ("n_punctuation", "word_chars"),
    "wide_per_char": ("n_wide", "word_chars"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "long_share": ("n_long_words", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
    "words_per_stop": ("n_words", "n_stops"),
}
FEATURES = ("log_words", "log_lines", *RATIOS)


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """One row of FEATURES per text; a ratio over nothing is 0."""
    columns = [np.log1p(counts["n_words"].astype(float)), np.log1p(counts["n_lines"].astype(float))]
    for part, of in RATIOS.values():
        d = counts[of].astype(float)
        columns.append(np.divide(counts[part].astype(float), d, out=np.zeros(len(d)), where=d > 0))
    return np.stack(columns, 1)


@dataclass
class PairwiseGam:
    """Lookup tables per feature and per pair of features."""

    bins: int = 32
    pair_bins: int = 8
    cycles: int = 120
    pair_cycles: int = 40
    pairs: int = 6
    rate: float = 0.15
    ridge: float = 1.0
    least: float = 2.0
    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_tables: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    @staticmethod
    def _edges(x: np.ndarray, bins: int) -> np.ndarray:
        return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="nearest")) if len(x) else np.zeros(0)

    def _leaf(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return g / (h + self.ridge)

    def _cut(self, g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
        """Best place to cut a run of bins, and the gain; 0 for none."""
        gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gr, hr = g.sum() - gl, h.sum() - hl
        gain = gl**2 / (hl + self.ridge) + gr**2 / (hr + self.ridge) - g.sum() ** 2 / (h.sum() + self.ridge)
        gain[(hl * 4 < self.least) | (hr * 4 < self.least)] = 0
        best = int(np.argmax(gain)) if len(gain) else 0
        return (best + 1, float(gain[best])) if len(gain) and gain[best] > 1e-9 else (0, 0.0)

    def _tree(self, g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
        """Leaf values over the bins of a tree of ``depth`` levels on one feature."""
        cut = self._cut(g, h)[0] if depth else 0
        if not cut:
            return np.full(len(g), self._leaf(g.sum(), h.sum()))
        return np.concatenate([self._tree(g[:cut], h[:cut], depth - 1), self._tree(g[cut:], h[cut:], depth - 1)])

    def _pair_tree(self, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
        """Leaf values over a grid of a tree that cuts one feature, then the other in each half."""
        best, value = 0.0, np.full(g.shape, self._leaf(g.sum(), h.sum()))
        for turned in (False, True):
            a, b = (g.T, h.T) if turned else (g, h)
            whole = a.sum() ** 2 / (b.sum() + self.ridge)
            for cut in range(1, a.shape[0]):
                out, gain = np.zeros(a.shape), -whole
                for part in (slice(0, cut), slice(cut, None)):
                    ga, hb = a[part].sum(0), b[part].sum(0)
                    k, more = self._cut(ga, hb)
                    gain += ga.sum() ** 2 / (hb.sum() + self.ridge) + more
                    out[part] = np.concatenate([np.full(k, self._leaf(ga[:k].sum(), hb[:k].sum())), np.full(len(ga) - k, self._leaf(ga[k:].sum(), hb[k:].sum()))])
                if gain > best:
                    best, value = gain, (out.T if turned else out)
        return value, best

    def fit(self, x: np.ndarray, y: np.ndarray) -> "PairwiseGam":
        """Fit on rows ``x`` and 0/1 labels; without both labels the model is their smoothed share."""
        n, m = x.shape
        share = (y.sum() + 1.0) / (n + 2.0)
        self.intercept = float(np.log(share / (1 - share)))
        self.edges = [self._edges(x[:, j], self.bins) for j in range(m)]
        self.pair_edges = [self._edges(x[:, j], self.pair_bins) for j in range(m)]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        if not n or y.min() == y.max():
            return self
        binned = [np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)]
        coarse = [np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.pair_edges)]
        score = np.full(n, self.intercept)

        def slopes() -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-score))
            return y - p, p * (1 - p)

        for _ in range(self.cycles):
            for j in range(m):
                g, h = slopes()
                size = len(self.tables[j])
                step = self.rate * self._tree(np.bincount(binned[j], g, size), np.bincount(binned[j], h, size))
                self.tables[j] += step
                score += step[binned[j]]
        g, h = slopes()

        def grid(i: int, j: int, w: np.ndarray) -> np.ndarray:
            shape = len(self.pair_edges[i]) + 1, len(self.pair_edges[j]) + 1
            return np.bincount(coarse[i] * shape[1] + coarse[j], w, shape[0] * shape[1]).reshape(shape)

        gains = sorted(((self._pair_tree(grid(i, j, g), grid(i, j, h))[1], i, j) for i in range(m) for j in range(i + 1, m)), reverse=True)
        chosen = [(i, j) for gain, i, j in gains[: self.pairs] if gain > 0]
        self.pair_tables = {(i, j): np.zeros((len(self.pair_edges[i]) + 1, len(self.pair_edges[j]) + 1)) for i, j in chosen}
        for _ in range(self.pair_cycles):
            for i, j in chosen:
                g, h = slopes()
                step = self.rate * self._pair_tree(grid(i, j, g), grid(i, j, h))[0]
                self.pair_tables[i, j] += step
                score += step[coarse[i], coarse[j]]
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Scores from 0 to 1."""
        score = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            score += table[np.searchsorted(edges, x[:, j], "left")]
        for (i, j), table in self.pair_tables.items():
            score += table[np.searchsorted(self.pair_edges[i], x[:, i], "left"), np.searchsorted(self.pair_edges[j], x[:, j], "left")]
        return 1 / (1 + np.exp(-score))


def held_out(id_col) -> "F.Column":
    """True for the third of the identifiers that no fit may see."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def training_labels(labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """label_id, quality of at most ``max_rows`` labels outside the held-out third, by least hash.

    Of contradicting labels the lower holds.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("label_id")).agg(F.min("quality").alias("quality"))
    return known.orderBy(F.xxhash64("label_id"), "label_id").limit(max_rows)


def fit_quality(counts: DataFrame, known: DataFrame, max_rows: int = MAX_ROWS) -> PairwiseGam:
    """Fit on the counts of the texts that ``known`` labels, which come to the driver."""
    # bounded by max_rows, so it is sent to every task however large the corpus is
    rows = counts.join(F.broadcast(known), F.col("doc_id") == F.col("label_id"))
    # rows may repeat an identifier, so the bound holds for them as well
    sample = rows.select("doc_id", *COUNTS, "quality").orderBy(F.xxhash64("doc_id"), "doc_id", *COUNTS).limit(max_rows).toPandas()
    y = sample["quality"].to_numpy(float)
    return PairwiseGam().fit(features({c: sample[c].to_numpy() for c in COUNTS}), y)


def score_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted.

    A null text counts as empty; empty texts are scored too.  A null identifier
    is not held out and never trains.  Of contradicting labels the lower holds.
    With no labels every score is one half.  Other columns are ignored; an
    empty table gives an empty result.
    """
    ship(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counts = materialize(text_counts(slim, ["doc_id"]), "quality-counts")
    model = fit_quality(counts, materialize(training_labels(labels, max_rows), "labels"), max_rows)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.predict(features({c: batch.column(c).to_numpy() for c in COUNTS}))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(p), "predicted": pa.array((p >= 0.5).astype(np.int32))})

    scored = counts.mapInArrow(score, "doc_id long, score double, predicted int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is at least ``threshold``, all columns kept.

    Texts are counted where they are read, so rows are filtered without a join.
    A null text counts as empty and is scored like any; a null identifier never
    trains.  Repeated rows stay or go alike.  Without labels every score is one
    half, so all rows stay.  Column names do not matter but for the identifier's
    and the text's; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    known = materialize(training_labels(labels, max_rows), "labels")
    # the labels are bounded by max_rows, so no text is shuffled to find theirs
    labelled = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(known.select("label_id")), F.col("doc_id") == F.col("label_id"), "left_semi")
    model = fit_quality(materialize(text_counts(labelled, ["doc_id"]), "quality-counts"), known, max_rows)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .kernels import calls
        from .text_stats import count_texts

        for batch in calls(batches, text_col):
            p = model.predict(features(count_texts(batch.column(text_col))))
            yield batch.filter(pa.array(p >= threshold))

    return docs.mapInArrow(keep, docs.schema)
