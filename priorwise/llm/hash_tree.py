"""Hierarchical weighted hash tree for sharding, in DataFrame functions only.

Shards are the leaves of a tree of regions and racks.  A node draws
``-ln(u) / weight`` from a hash of the key, the level and its number, where the
weight is that of its whole subtree.  Keys descend from the top: regions are
compared by their draws, and only inside the region that has the least are
racks drawn, and inside that rack shards.

One more shard takes keys only into itself.  Beneath a node with draw ``e``,
the child with the least draw of its own keeps ``e`` and any other has ``e``
plus what its own draw exceeds the least one by.  So every leaf has a draw, a
node's is the least below it, and none depends on how many shards there are:
leaves still to come have weight 1 from the start.  Only the last, unfilled
region and rack are opened for all keys, to take the least over their leaves
that exist.

A changed weight changes the draws of the nodes above that leaf alone: keys
move between regions only into (or, when lighter, out of) its region, between
the racks of that region only into or out of its rack, and between the shards
of that rack only into or out of its shard.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from .scratch import materialize, shuffle_partitions

RACK_SHARDS = 4
REGION_RACKS = 5
_REGION, _RACK, _SHARD = 0, 1, 2


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _first_least(values: Column) -> Column:
    return (F.array_position(values, F.array_min(values)) - 1).cast("int")


class HashTree:
    """Draws of the nodes of a tree over ``weights``, one positive weight a shard.

    Regions hold ``racks`` racks of ``rack`` shards, filled in order.
    """

    def __init__(self, weights: Sequence[float], rack: int = RACK_SHARDS, racks: int = REGION_RACKS) -> None:
        if not len(weights) or min(weights) <= 0:
            raise ValueError("each shard needs a positive weight")
        self.shards, self.rack, self.racks = len(weights), rack, racks
        self.region = rack * racks
        self.full, self.over = divmod(self.shards, self.region)
        n_regions = self.full + (self.over > 0)
        leaf = [float(w) for w in weights] + [1.0] * (n_regions * self.region - self.shards)
        by_rack = [sum(leaf[i : i + rack]) for i in range(0, len(leaf), rack)]
        by_region = [sum(by_rack[i : i + racks]) for i in range(0, len(by_rack), racks)]
        self.weights = {_REGION: by_region, _RACK: by_rack, _SHARD: leaf}

    def _draws(self, key: Column, level: int, first: Column, count: int) -> Column:
        """The own draws of ``count`` nodes of a level from number ``first`` on."""
        weights = self.weights[level]
        alike = len(set(weights)) == 1
        table = F.lit(weights[0]) if alike else F.array(*[F.lit(w) for w in weights])

        def draw(node: Column) -> Column:
            # 53 bits of a hash, moved off zero
            u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(level), node), 11).cast("double") + 0.5) / float(2**53)
            return -F.log(u) / (table if alike else F.get(table, node))

        return F.transform(F.sequence(first, first + (count - 1)), draw)

    def _below(self, draws: Column, parent: Column) -> Column:
        """Children's draws given their own draws and the parent's draw."""
        return _let(F.array_min(draws), lambda least: F.transform(draws, lambda d: parent + (d - least)))

    def _inside(self, key: Column, region: Column) -> Column:
        """The shard of a full region that a key ends in."""
        rack = region * self.racks + _first_least(self._draws(key, _RACK, region * self.racks, self.racks))
        return _let(rack, lambda r: r * self.rack + _first_least(self._draws(key, _SHARD, r * self.rack, self.rack)))

    def _open_region(self, key: Column, parent: Column) -> Column:
        """(draw, shard) of the least leaf that exists in the unfilled last region."""
        full, over = divmod(self.over, self.rack)
        first = self.full * self.racks

        def among(by_rack: Column) -> Column:
            best = []
            if full:
                whole = F.slice(by_rack, 1, full)
                chosen = _let(F.lit(first) + _first_least(whole), lambda r: r * self.rack + _first_least(self._draws(key, _SHARD, r * self.rack, self.rack)))
                best.append(F.struct(F.array_min(whole).alias("draw"), chosen.alias("shard")))
            if over:
                at = (first + full) * self.rack
                leaves = F.slice(self._below(self._draws(key, _SHARD, F.lit(at), self.rack), F.get(by_rack, F.lit(full))), 1, over)
                best.append(_let(leaves, lambda x: F.struct(F.array_min(x).alias("draw"), (_first_least(x) + at).alias("shard"))))
            return F.array_min(F.array(*best))

        return _let(self._below(self._draws(key, _RACK, F.lit(first), self.racks), parent), among)

    def shard(self, key: Column) -> Column:
        """The shard, 0 to the number of shards less one; a null key counts as one value."""
        text = F.coalesce(key.cast("string"), F.lit("null"))
        regions = self._draws(text, _REGION, F.lit(0), self.full + (self.over > 0))

        def descend(own: Column) -> Column:
            if not self.over:
                return self._inside(text, _first_least(own))
            last = self._open_region(text, F.get(own, F.lit(self.full)))
            if not self.full:
                return last["shard"]
            whole = F.slice(own, 1, self.full)
            return _let(last, lambda x: F.when(x["draw"] < F.array_min(whole), x["shard"]).otherwise(self._inside(text, _first_least(whole))))

        return _let(regions, descend).cast("int")


def tree_shard(key: Column, shards: int, weights: Sequence[float] | None = None) -> Column:
    """The shard, 0 to ``shards - 1``, of ``key``."""
    weights = list(weights) if weights is not None else [1.0] * shards
    if len(weights) != shards:
        raise ValueError("each shard needs a weight")
    return HashTree(weights).shard(key)


def shard_documents(docs: DataFrame, shards: int = 40, weights: Sequence[float] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's shard, its shard with one more, and a gapless slot in its shard.

    Returns doc_id, size (UTF-8 bytes, none for a null text, plus 16),
    text_crc32, law, shard, slot, grown_shard.  Only the identifier and the
    shard count decide the shard.  Slots follow a hash of the identifier, size
    and checksum; rows equal in all of these take consecutive slots.  A null
    identifier is a key of its own, so its rows share a shard; their slots
    follow the place at which they are read.  Other columns are ignored; an
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    weights = list(weights) if weights is not None else [1.0] * shards
    base = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    # Slots: cells of a shard by hash, numbered within, offset by the cells before.
    # A cell holds about 1/64 of a partition's rows however large a shard is.
    cells = shuffle_partitions(spark) * 64
    spread = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    placed = base.withColumns({
        "shard": tree_shard(F.col("doc_id"), shards, weights),
        "grown_shard": tree_shard(F.col("doc_id"), shards + 1, [*weights, 1.0]),
        "cell": F.pmod(F.xxhash64("doc_id", "size", "text_crc32", spread), F.lit(cells)).cast("int"),
    })
    # written, so that both reads see the same cells
    rows = materialize(placed, "hash-tree")
    counts = rows.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(_window("shard", order=["cell"]).rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("shard", "cell", F.coalesce(before, F.lit(0)).alias("offset"))
    place = F.row_number().over(_window("shard", "cell", order=["doc_id", "size", "text_crc32"]))
    return (
        rows.withColumn("place", place)
        .join(offsets, ["shard", "cell"])
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("offset") + F.col("place") - 1).cast("long").alias("slot"), "grown_shard")
    )


def _window(*by: str, order: list[str]) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(*order)
