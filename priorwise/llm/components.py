"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .scratch import materialize, release


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(F.xxhash64("u", "v"), 16))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """node, label: the least node that each node of (u, v) edges reaches; a written table.

    Only nodes with an edge to another node are listed.  Every round joins each
    node's neighbours to the least of them, once upwards and once downwards;
    rounds stop when the edges are stars around least nodes.  The minima are
    written before they are joined, so a hub's many edges can be split.  The
    tables of a round are deleted when the next one stands.
    """
    now = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = materialize(now, "edges")
    before = None
    while before != (digest := _digest(now)):
        before = digest
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        up = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        up = materialize(up, "edges")
        below = materialize(up.groupBy("u").agg(F.min("v").alias("m")), "least")
        down = up.join(below, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        after = materialize(down.unionByName(below.select("u", F.col("m").alias("v"))).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        release(now, least, up, below)
        now = after
    ends = now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")))
    labels = materialize(ends.groupBy("node").agg(F.min("label").alias("label")), "labels")
    release(now)
    return labels
