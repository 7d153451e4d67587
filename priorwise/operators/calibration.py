"""Isotonic calibration over ranges of scores; no task and no driver holds all of them.

The isotonic fit of labels on scores is the slope of the greatest convex
minorant of the points (rows up to a score, positives up to it).  A point that
is not on the lower hull of some consecutive points is not on the hull of all,
so blocks of consecutive points drop what is inside, and blocks shifted by half
their size meet what stood at the borders before.  When neither drops anything,
every three neighbours are convex, and so is the whole.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from priorwise.functions.exprs import grid_cell
from priorwise.sources.tables import written

from .metrics import CELLS, cumulative, global_place, score_histogram

#: Points of a block.
BLOCK_POINTS = 50_000


def _lower_hull(points: pd.DataFrame) -> pd.DataFrame:
    """The points on the lower hull, by rows; the first and the last are always kept."""
    rows = points.sort_values("w")
    kept: list[tuple[int, int, int]] = []
    for i, (w, s) in enumerate(zip(rows["w"].tolist(), rows["s"].tolist(), strict=True)):
        # whole numbers of any size: no rounding decides
        while len(kept) > 1 and (kept[-1][1] - kept[-2][1]) * (s - kept[-2][2]) <= (kept[-1][2] - kept[-2][2]) * (w - kept[-2][1]):
            kept.pop()
        kept.append((i, w, s))
    return rows.iloc[[i for i, _, _ in kept]]


def _placed(points: DataFrame) -> DataFrame:
    return written(global_place(points, [F.col("w")], F.lit(0)).drop("total"), "hull-points")


def isotonic_pieces(df: DataFrame, y: str = "y", p: str = "p", block: int = BLOCK_POINTS) -> DataFrame:
    """The fit as a table of pieces: from low to below high the value goes from first to last, in a line.

    Equal scores are one point of their weight; rows without a score are left
    out.  low and high are null at the open ends; a table without rows has no
    pieces.
    """
    some = df.filter(F.col(p).isNotNull()).select(F.col(y).alias("y"), F.col(p).cast("double").alias("p"))
    c = cumulative(score_histogram(some))
    up = c.select("p", (F.col("n_pos") + F.col("n_neg") - F.col("tp") - F.col("fp") + F.col("pos") + F.col("neg")).alias("w"), (F.col("n_pos") - F.col("tp") + F.col("pos")).alias("s"))
    steps = _placed(up)
    after = steps.select((F.col("place") - 1).alias("place"), F.col("p").alias("next_p"))
    begin = steps.filter("place = 0").select(F.lit(None).cast("double").alias("p"), F.lit(0).cast("long").alias("w"), F.lit(0).cast("long").alias("s"), F.col("p").alias("next_p"))
    points = _placed(steps.join(after, "place", "left").select("p", "w", "s", "next_p").unionByName(begin))
    still, before, shift = 0, points.count(), 0
    while still < 2 and before:
        of = F.floor((F.col("place") + shift) / block).alias("block")
        points = _placed(points.select("p", "w", "s", "next_p", of).groupBy("block").applyInPandas(_lower_hull, "p double, w long, s long, next_p double, block long").drop("block"))
        n = points.count()
        if before <= block and not shift:
            break  # all points were in one block
        still, before, shift = (still + 1 if n == before else 0), n, block // 2 - shift
    # a block of equal fitted values ends at each vertex but the first
    ends = points.select((F.col("place") - 1).alias("place"), F.col("p").alias("high"), F.col("w").alias("w1"), F.col("s").alias("s1"))
    blocks = points.join(ends, "place").select("place", F.col("next_p").alias("low"), "high", ((F.col("s1") - F.col("s")) / (F.col("w1") - F.col("w"))).alias("value"))
    blocks = written(blocks, "isotonic-blocks")
    following = blocks.select((F.col("place") - 1).alias("place"), F.col("low").alias("next_low"), F.col("value").alias("next_value"))
    j = blocks.join(following, "place", "left")
    piece = lambda low, high, first, last: F.struct(low.alias("low"), high.alias("high"), first.alias("first"), last.alias("last"))
    none, value = F.lit(None).cast("double"), F.col("value")
    pieces = F.array(F.when(F.col("place") == 0, piece(none, F.col("low"), value, value)), F.when(F.col("low") < F.col("high"), piece(F.col("low"), F.col("high"), value, value)), piece(F.col("high"), F.col("next_low"), value, F.coalesce("next_value", "value")))
    return written(j.select(F.explode(F.filter(pieces, lambda x: x.isNotNull())).alias("x")).select("x.*"), "isotonic-pieces")


def apply_pieces(df: DataFrame, pieces: DataFrame, p: str = "p") -> DataFrame:
    """``df`` with its scores, from 0 to 1, calibrated by :func:`isotonic_pieces`; null stays null.

    A range join: a piece stands in every cell of the score range that it
    touches, so scores meet only the pieces of their own cell.
    """
    cell = lambda x: grid_cell(x, CELLS)
    spread = pieces.withColumn("__cell", F.explode(F.sequence(F.coalesce(cell(F.col("low")), F.lit(0)), F.coalesce(cell(F.col("high")), F.lit(CELLS)))))
    x, low, high = F.col(p).cast("double"), F.col("low"), F.col("high")
    inside = (low.isNull() | (low <= x)) & (high.isNull() | (x < high))
    j = df.withColumn("__own", cell(x)).join(spread, (F.col("__own") == F.col("__cell")) & inside, "left")
    value = F.when(low.isNull() | high.isNull(), F.col("first")).otherwise(F.col("first") + (F.col("last") - F.col("first")) * (x - low) / (high - low))
    kept = F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))
    return j.select(*[F.when(F.col(p).isNotNull(), kept).alias(p) if c == p else F.col(c) for c in df.columns])
