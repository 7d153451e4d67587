"""N-gram Jaccard join by T-occurrence search with DivideSkip.

Two texts whose sets of word shingles have Jaccard similarity of at least 4/5
share at least T = ceil(4/9 * (n + m)) shingles, n and m being their sizes.  Of
a text's inverted lists the L = T - k longest are set aside; whatever reaches T
occurrences then occurs at least k times in the other, short lists.

1.  Lists are measured: every shingle is counted over all texts, and a bounded
    table holds, per slot of the hash, how long its longest list is, in sixteen
    levels, each three times the one before.
2.  Each text orders its lists by (level, hash), the same order for all, and
    enters its shortest ones, but for those that no other text has.  k grows
    with the text (one in sixteen of its T), and equal sets are one node.
3.  In each bucket of hashes, entries are merged into lists, and occurrences
    are counted for each pair of members; Spark adds up the counts of all
    buckets.  A merge in sorted order stands in for the heap.  Pairs below k
    are dropped without looking at a text again.
4.  For a pair that is left, the L long lists of one text are probed by binary
    search in the other's set, on top of the occurrences counted, until T is
    reached or out of reach.  The pairs of a node that stands in very many are
    dealt out by their other node, its set copied once a share.
5.  A list of more than 17 members is not turned into all its pairs: members
    meet the most central one and their neighbour by size.  Lists of thousands
    are dealt out in blocks, which share some members, so that all meet the
    same centre.  In lists whose members are not in one component afterwards,
    occurrences are counted across components, in cells of bounded size and
    with k = 1, and those pairs are probed as well, so no link is lost.

Everything but the bounded tables stays distributed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .bitmaps import value_filter
from .components import components
from .kernels import PLACES, U64, bucket_bits, calls, mix, pack_keys, pack_small, sequence_hashes, slices, span_hashes, text_bytes, unpack_keys, unpack_small, window_hashes, word_spans
from .scratch import materialize, release, ship, shuffle_partitions

WIDTH = 5
#: The similarity, 4/5, as integers.
PART, WHOLE = 4, 5
#: Shingles that a task holds before it sends them on.
FLUSH = 2_000_000
#: The table of list lengths has at most 2^27 slots of four bits: 64 MB.
MOST_SLOT_BITS = 27
_KEY_BITS = 40
#: The least lengths of levels 1 to 15; level 0 is a list of one text.
_LEVELS = 2 * 3 ** np.arange(15)
#: Lists below this level have at most 17 texts, whose pairs are all counted.
_LONG = 3
_SHORT_LIST = int(_LEVELS[_LONG - 1]) - 1
#: Lists from this level on are dealt out in blocks of some thousand members.
_BLOCKED = 9
#: Members that all blocks of a list share, about.
_ENVOYS = 16
#: Members on either side of a cell of pairs.
_CELL = 512
#: Pairs of one node that a task verifies, at least, and the most nodes whose pairs are dealt out.
_SHARE, _SHARES = 256, 1024


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Of each text: its distinct shingles' hashes, ascending.

    A-Z count as a-z.  With fewer than five words the whole sequence is one
    shingle; without words the set is empty.
    """
    raw, off = text_bytes(column)
    starts, ends, first = word_spans(raw, off)
    words = span_hashes(raw, starts, ends, lower=True)
    windows = window_hashes(words, WIDTH)
    short = mix(sequence_hashes(words, first) ^ PLACES[60])
    for i in range(len(off) - 1):
        n = first[i + 1] - first[i]
        if n >= WIDTH:
            got = np.sort(windows[first[i] : first[i + 1] - WIDTH + 1])
            yield got[np.append(True, got[1:] != got[:-1])]
        else:
            yield short[i : i + 1] if n else short[:0]


def node_of(shingles: np.ndarray) -> int:
    """A hash of the set as a whole, signed; 0 for the empty set."""
    if not len(shingles):
        return 0
    total = mix(np.sum(mix(shingles ^ PLACES[59]), keepdims=True) + np.array([len(shingles)], U64) * PLACES[58])
    return int(total.view(np.int64)[0]) or 1


def wanted_occurrences(n):
    """k: how often a partner of a text of ``n`` shingles must occur in its short lists."""
    return 1 + -(-PART * n // WHOLE) // 16


class ListLevels:
    """The bounded table of list lengths, as every task sees it."""

    def __init__(self, sent, slot_bits: int) -> None:
        self.sent, self.slot_bits = sent, slot_bits

    def of(self, shingles: np.ndarray) -> np.ndarray:
        slot = (shingles >> U64(64 - self.slot_bits)).astype(np.int64)
        return (self.sent.value[slot >> 1] >> (4 * (slot & 1)).astype(np.uint8)) & 15

    def ranked(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The shingles from the shortest list to the longest, and their levels."""
        level = self.of(shingles)
        order = np.lexsort((shingles, level))
        return shingles[order], level[order]


def measure_lists(docs: DataFrame, entries: float, text_col: str) -> ListLevels:
    """Four bits per slot: the level of the longest list of the slot's shingles."""
    spark = docs.sparkSession
    bits = bucket_bits(entries)
    slot_bits = int(min(MOST_SLOT_BITS, max(bits + 4, np.ceil(np.log2(entries / 2 + 1)))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def send() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held) >> U64(64 - _KEY_BITS), return_counts=True)
            buckets, at = slices(keys << U64(64 - _KEY_BITS), bits)
            keys_out = [pack_keys(keys[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            counts_out = [pack_small(counts[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            return pa.record_batch([pa.array(buckets.astype(np.int32)), pa.array(keys_out, pa.binary()), pa.array(counts_out, pa.binary())], names=["bucket", "keys", "counts"])

        for batch in calls(batches):
            for got in shingle_sets(batch.column("text")):
                held.append(got)
                size += len(got)
                if size >= FLUSH:
                    yield send()
                    held, size = [], 0
        if size:
            yield send()

    def measure(table: pa.Table) -> pa.Table:
        parts = [unpack_keys(b.as_py()) for b in table.column("keys")]
        counts = np.concatenate([unpack_small(b.as_py(), len(k)) for b, k in zip(table.column("counts"), parts, strict=True)])
        keys = np.concatenate(parts)
        order = np.argsort(keys)
        keys = keys[order]
        begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        level = np.searchsorted(_LEVELS, np.add.reduceat(counts[order], begins), "right").astype(np.uint8)
        out = np.zeros(1 << (slot_bits - bits), np.uint8)
        np.maximum.at(out, ((keys[begins] >> U64(_KEY_BITS - slot_bits)) & U64(len(out) - 1)).astype(np.int64), level)
        return pa.table({"bucket": table.column("bucket").slice(0, 1), "levels": pa.array([(out[::2] | out[1::2] << 4).tobytes()], pa.binary())})

    sent = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "bucket int, keys binary, counts binary")
    # at most 2^27 slots of four bits in all
    parts = sent.groupBy("bucket").applyInArrow(measure, "bucket int, levels binary").collect()
    size = (1 << (slot_bits - bits)) // 2
    table = np.zeros((1 << slot_bits) // 2, np.uint8)
    for row in parts:
        table[row["bucket"] * size : (row["bucket"] + 1) * size] = np.frombuffer(row["levels"], np.uint8)
    return ListLevels(spark.sparkContext.broadcast(table), slot_bits)


#: A text in a list: its place there, how many of its entered lists are long, and whether all blocks have it.
_ENTRY = np.dtype([("key", "<u8"), ("node", "<i8"), ("size", "<i4"), ("at", "<i4"), ("long", "<i4"), ("envoy", "u1")])
_COUNTED = "a long, b long, size_a int, size_b int, n int, unknown int"


def _may_link(a: np.ndarray, b: np.ndarray, k: int | None = None) -> np.ndarray:
    """Whether an occurrence counts: both places are among the pair's short lists.

    These are all but the T - k longest, of either text.
    """
    a_size, b_size = a["size"].astype(np.int64), b["size"].astype(np.int64)
    if k is None:
        k = np.minimum(wanted_occurrences(a_size), wanted_occurrences(b_size))
    need = PART * (a_size + b_size)
    both = PART + WHOLE
    return (both * (a_size - a["at"] + k - 1) >= need) & (both * (b_size - b["at"] + k - 1) >= need)


def _count(pairs: list[tuple[np.ndarray, np.ndarray, bool]]) -> pa.Table:
    """Occurrences of each pair of members; ``unknown`` bounds those in lists not counted.

    Of (members, members, whether the occurrences count or the two only met).
    """
    pairs = [p for p in pairs if len(p[0])]
    if not pairs:
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), **{c: pa.array([], pa.int32()) for c in ("size_a", "size_b", "n", "unknown")}})
    x, y = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
    n = np.concatenate([np.full(len(p[0]), p[2], np.int32) for p in pairs])
    turned = x["node"] > y["node"]
    a, b = np.where(turned, y, x), np.where(turned, x, y)
    order = np.lexsort((b["node"], a["node"]))
    a, b, n = a[order], b[order], n[order]
    begins = np.flatnonzero(np.append(True, (a["node"][1:] != a["node"][:-1]) | (b["node"][1:] != b["node"][:-1])))
    a, b = a[begins], b[begins]
    return pa.table({"a": a["node"].copy(), "b": b["node"].copy(), "size_a": a["size"].copy(), "size_b": b["size"].copy(), "n": np.add.reduceat(n, begins).astype(np.int32), "unknown": np.minimum(a["long"], b["long"])})


def _all_pairs(members: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    i, j = np.triu_indices(len(members), 1)
    ok = _may_link(members[i], members[j])
    return members[i[ok]], members[j[ok]], True


def _meetings(members: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, bool]]:
    """Pairs of a long list that meet: with the most central member, and neighbours by size."""
    members = np.sort(members, order=["size", "node"])
    # all blocks have the same envoys, so they take the same centre
    pool = members[members["envoy"] > 0] if members["envoy"].any() else members
    hub = pool[np.lexsort((pool["node"], pool["at"] / pool["size"]))[0]]
    rest = members[members["node"] != hub["node"]]
    with_hub = rest[_may_link(rest, np.broadcast_to(hub, rest.shape))]
    a, b = members[:-1], members[1:]
    near = _may_link(a, b)
    return [(with_hub, np.full(len(with_hub), hub), False), (a[near], b[near], False)]


def _merger(bits: int):
    """Merge a bucket's entries into lists: counted pairs, and the lists that are too long to count."""

    def merge(table: pa.Table) -> pa.Table:
        blocked = table.column("bucket")[0].as_py() >> bits > 0
        entries = np.concatenate([np.frombuffer(b.as_py(), _ENTRY) for b in table.column("entries")])
        entries = entries[np.lexsort((entries["node"], entries["key"]))]
        entries = entries[np.append(True, (entries["key"][1:] != entries["key"][:-1]) | (entries["node"][1:] != entries["node"][:-1]))]
        begins = np.flatnonzero(np.append(True, entries["key"][1:] != entries["key"][:-1]))
        lengths = np.diff(np.append(begins, len(entries)))
        lists: list[bytes] = []
        if blocked:
            pairs = [m for at, n in zip(begins, lengths, strict=True) for m in _meetings(entries[at : at + n])]
            lists = [entries[at : at + n].tobytes() for at, n in zip(begins, lengths, strict=True)]
        else:
            twos = begins[lengths == 2]
            good = twos[_may_link(entries[twos], entries[twos + 1])]
            pairs = [(entries[good], entries[good + 1], True)]
            for at, n in zip(begins[lengths > 2], lengths[lengths > 2], strict=True):
                members = entries[at : at + n]
                if n <= _SHORT_LIST:
                    pairs.append(_all_pairs(members))
                    continue
                # whose place is not among its short lists, even with the least partner, leaves the list
                size = members["size"].astype(np.int64)
                members = members[(PART + WHOLE) * (size - members["at"] + wanted_occurrences(size) - 1) >= PART * (size + size.min())]
                if len(members) > 1:
                    pairs += _meetings(members)
                    lists.append(members.tobytes())
        counted = _count(pairs)
        none = pa.table({c: pa.nulls(len(lists), t) for c, t in zip(counted.column_names, counted.schema.types, strict=True)}).append_column("members", pa.array(lists, pa.binary()))
        return pa.concat_tables([counted.append_column("members", pa.nulls(counted.num_rows, pa.binary())), none])

    return merge


def _summed(counted: DataFrame) -> DataFrame:
    return counted.groupBy("a", "b").agg(F.min("size_a").alias("size_a"), F.min("size_b").alias("size_b"), F.sum("n").alias("n"), F.min("unknown").alias("unknown"))


def _wanted() -> Column:
    """k of a pair."""
    return 1 + F.floor(F.ceil(PART * F.least("size_a", "size_b") / WHOLE) / 16)


def heavy_nodes(ends: DataFrame) -> DataFrame:
    """node, shares: the nodes of very many pairs, and over how many tasks their pairs are dealt.

    ``ends`` has node and n, its pairs.  A share is ``_SHARE`` pairs, or one in
    ``_SHARES`` of all ends where that is more; so at most ``_SHARES`` nodes are
    heavy, few enough to broadcast whatever the input.
    """
    share = max(_SHARE, -(-(ends.agg(F.sum("n")).first()[0] or 0) // _SHARES))
    return ends.filter(F.col("n") > share).select("node", F.ceil(F.col("n") / share).cast("int").alias("shares"))


def _verify(docs: DataFrame, slim: DataFrame, pairs: DataFrame, levels: ListLevels, text_col: str, id_col: str) -> DataFrame:
    """u, v: the node pairs whose sets are similar enough; a written table.

    ``pairs`` has a, b, n, unknown and k; where nothing is unknown, n counts all
    occurrences in the pair's short lists, and only the T - k long ones are probed.
    """
    wanted = materialize(pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n")), "candidates")
    heavy = materialize(heavy_nodes(wanted), "heavy-nodes")
    ids = materialize(slim.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id")), "candidate-ids")
    holds = value_filter(ids, "doc_id")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in calls(batches):
            ids = batch.column("doc_id")
            pick = holds(ids.fill_null(0).to_numpy()) | ids.is_null().to_numpy(zero_copy_only=False)
            some = batch.filter(pa.array(pick))
            if some.num_rows:
                found = list(shingle_sets(some.column("text")))
                yield pa.record_batch([pa.array([node_of(s) for s in found], pa.int64()), pa.array([levels.ranked(s)[0].tobytes() for s in found], pa.binary())], names=["node", "shingles"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                reaches(np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64), None if unknown.as_py() else n.as_py(), k.as_py(), levels)
                for x, y, n, unknown, k in zip(*(batch.column(c) for c in ("x", "y", "n", "unknown", "k")), strict=True)
            ]
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    def copies(nodes: DataFrame) -> DataFrame:
        share = F.explode(F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1)).alias("share")
        return nodes.join(F.broadcast(heavy), "node", "left").select(*nodes.columns, share)

    have = copies(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(sets, "node long, shingles binary"))
    # the joins below find the sets partitioned as they need them
    have = have.join(copies(wanted.select("node")), ["node", "share"], "left_semi").dropDuplicates(["node", "share"])
    left = have.select(F.col("node").alias("a"), F.col("share").alias("share_a"), F.col("shingles").alias("x"))
    right = have.select(F.col("node").alias("b"), F.col("share").alias("share_b"), F.col("shingles").alias("y"))
    dealt = pairs
    for end, other in (("a", "b"), ("b", "a")):
        of = F.broadcast(heavy.select(F.col("node").alias(end), F.col("shares")))
        dealt = dealt.join(of, end, "left").withColumn(f"share_{end}", F.pmod(F.xxhash64(other), F.coalesce("shares", F.lit(1))).cast("int")).drop("shares")
    links = dealt.join(left, ["a", "share_a"]).join(right, ["b", "share_b"]).select(F.col("a").alias("u"), F.col("b").alias("v"), "x", "y", "n", "unknown", "k").mapInArrow(probe, "u long, v long")
    links = materialize(links, "links")
    release(wanted, ids, heavy)
    return links


def reaches(x: np.ndarray, y: np.ndarray, counted: int | None, k: int, levels: ListLevels, step: int = 128) -> bool:
    """Whether two ranked sets share T shingles.

    ``counted``: occurrences in the pair's short lists, all but the T - k
    longest, or None when it is not known.  The long lists of the text whose
    short ones end first are probed.
    """
    need = -(-PART * (len(x) + len(y)) // (PART + WHOLE))
    if counted is None:
        counted = 0
        probes, other = (x, y) if len(x) <= len(y) else (y, x)
    else:
        aside = need - k
        ends = np.array([x[len(x) - aside - 1], y[len(y) - aside - 1]])
        last = levels.of(ends)
        probes, other = (x, y) if (last[0], ends[0]) <= (last[1], ends[1]) else (y, x)
        probes = probes[len(probes) - aside :]
    other = np.sort(other)
    for at in range(0, len(probes), step):
        if counted >= need or counted + len(probes) - at < need:
            break
        part = probes[at : at + step]
        counted += int(np.count_nonzero(other[np.minimum(np.searchsorted(other, part), len(other) - 1)] == part))
    return counted >= need


def _across(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Occurrences, in the long lists, of pairs of members in different components.

    Here k is 1, so that a list yields only pairs that have their first common
    place in it and can still share T shingles from there on.
    A list's largest component and the others are cut into blocks of about
    ``_CELL`` members; each block of the others meets every block.
    """
    spark = lists.sparkSession

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                e = np.frombuffer(blob.as_py(), _ENTRY)
                yield pa.record_batch([pa.array(e["key"].view("<i8").copy()), *(pa.array(e[c].copy()) for c in ("node", "size", "at", "long"))], names=["key", "node", "size", "at", "long"])

    rows = lists.select("members").mapInArrow(members, "key long, node long, size int, at int, long int").distinct()
    written = rows = materialize(rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "list-members")
    of_label = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    sizes = of_label.groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.max("n").alias("mains"), (F.sum("n") - F.max("n")).alias("others")).filter("others > 0")
    sizes = materialize(sizes.select("key", "main", F.ceil(F.col("mains") / _CELL).alias("main_blocks"), F.ceil(F.col("others") / _CELL).alias("other_blocks"), "mains", "others"), "open-lists")
    copies = sizes.agg(F.sum(F.col("mains") * F.col("other_blocks") + F.col("others") * (F.col("main_blocks") + F.col("other_blocks")))).first()[0] or 0
    cells = int(max(shuffle_partitions(spark) * 4, copies // (8 * _CELL)))
    rows = rows.join(sizes, "key").withColumn("is_main", F.col("label") == F.col("main"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("is_main"), F.col("main_blocks")).otherwise(F.col("other_blocks"))).cast("int")
    rows = rows.withColumn("own", own)

    def blocks(count: str) -> Column:
        return F.sequence(F.lit(0), F.col(count).cast("int") - 1)

    place = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    with_main = F.when(F.col("is_main"), F.transform(blocks("other_blocks"), lambda i: place(0, i, F.col("own")))).otherwise(F.transform(blocks("main_blocks"), lambda j: place(0, F.col("own"), j)))
    with_others = F.when(F.col("is_main"), F.array()).otherwise(F.transform(blocks("other_blocks"), lambda i: place(1, F.least(i, F.col("own")), F.greatest(i, F.col("own")))))
    dealt = rows.select("key", "node", "size", "at", "long", "label", "is_main", "own", F.explode(F.concat(with_main, with_others)).alias("place")).select("*", "place.*").drop("place")

    def cross(table: pa.Table) -> pa.Table:
        e = np.zeros(table.num_rows, _ENTRY)
        for name in ("node", "size", "at", "long"):
            e[name] = table.column(name).to_numpy()
        label, main, own = (table.column(c).to_numpy() for c in ("label", "is_main", "own"))
        place = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("key", "kind", "i", "j")])
        order = np.lexsort(place)
        place = place[:, order]
        cuts = np.flatnonzero(np.append(True, (place[:, 1:] != place[:, :-1]).any(0)))
        pairs = []
        for at, to in zip(cuts, np.append(cuts[1:], table.num_rows), strict=True):
            rows, (_, kind, i, j) = order[at:to], place[:, at]
            left = main[rows] if kind == 0 else own[rows] == i
            one, two = rows[left], rows[~left] if kind == 0 or i != j else rows
            x, y = (m.ravel() for m in np.meshgrid(one, two, indexing="ij"))
            fit = (label[x] != label[y]) & ((e["node"][x] < e["node"][y]) | (kind == 0) | (i != j))
            x, y = x[fit], y[fit]
            fit = _may_link(e[x], e[y], 1)
            pairs.append((e[x[fit]], e[y[fit]], True))
        return _count(pairs)

    cell = F.pmod(F.xxhash64("key", "kind", "i", "j"), F.lit(cells)).alias("cell")
    counted = materialize(_summed(dealt.groupBy(cell).applyInArrow(cross, _COUNTED)), "counts-across")
    release(written, sizes)
    return counted


def _components_of(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, list[DataFrame]]:
    """As :func:`ngram_components`, and the written tables that the result reads."""
    spark = docs.sparkSession
    ship(spark)
    chars = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    entries = max(1.0, chars / 6)
    levels = measure_lists(docs, entries, text_col)
    bits = bucket_bits(entries / 8, each=1e6)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        block: list[np.ndarray] = []
        seen: set[int] = set()
        size = 0

        def rows(ids, texts, n, nodes, buckets, blobs) -> pa.RecordBatch:
            return pa.record_batch([pa.array(ids, pa.int64()), pa.array(texts, pa.int64()), pa.array(n, pa.int64()), pa.array(nodes, pa.int64()), pa.array(buckets, pa.int64()), pa.array(blobs, pa.binary())], names=["doc_id", "text_hash", "n_shingles", "node", "bucket", "entries"])

        def send() -> pa.RecordBatch:
            e, b = np.concatenate(held), np.concatenate(block)
            bucket = (b << bits) | (e["key"] >> U64(64 - bits)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            e, bucket = e[order], bucket[order]
            at = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(e))
            none = [None] * (len(at) - 1)
            return rows(none, none, none, none, bucket[at[:-1]], [e[a:z].tobytes() for a, z in zip(at[:-1], at[1:], strict=True)])

        for batch in calls(batches):
            nodes, counts = [], []
            for got in shingle_sets(batch.column("text")):
                n = len(got)
                nodes.append(node := node_of(got))
                counts.append(n)
                if not n or node in seen:
                    continue
                seen.add(node)
                need = -(-PART * n // WHOLE)
                level = levels.of(got)
                entered = n - need + wanted_occurrences(n)
                if np.count_nonzero(level == 0) >= entered:
                    continue
                order = np.lexsort((got, level))[:entered]
                at = np.flatnonzero(level[order] > 0)
                e = np.zeros(len(at), _ENTRY)
                own = level[order[at]].astype(np.int64)
                e["key"], e["node"], e["size"], e["at"], e["long"] = got[order[at]], node, n, at, np.count_nonzero(own >= _LONG)
                # a list of many thousands: a block by the text, and a few texts in every block
                n_blocks = np.where(own >= _BLOCKED, 3 ** np.maximum(own - _BLOCKED + 1, 0), 0)
                draw = mix(e["key"] ^ mix(np.full(len(at), node, np.int64).view(U64)))
                b = np.where(n_blocks > 0, 1 + (draw % np.maximum(n_blocks, 1).astype(U64)).astype(np.int64), 0)
                e["envoy"] = (own >= _BLOCKED) & ((mix(draw) >> U64(11)).astype(float) / 2**53 < _ENVOYS / 3.0**own)
                for i in np.flatnonzero(e["envoy"]):
                    more = np.setdiff1d(np.arange(1, n_blocks[i] + 1), b[i : i + 1])
                    held.append(np.full(len(more), e[i]))
                    block.append(more)
                    size += len(more)
                held.append(e)
                block.append(b)
                size += len(at)
            yield rows(batch.column("doc_id"), batch.column("text_hash"), counts, nodes, [None] * len(nodes), [None] * len(nodes))
            # an entry takes as much memory as four shingles, and twice when sorted
            if size >= FLUSH // 4:
                yield send()
                held, block, size = [], [], 0
                seen.clear()
        if size:
            yield send()

    slim_docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    entered = materialize(slim_docs.mapInArrow(enter, "doc_id long, text_hash long, n_shingles long, node long, bucket long, entries binary"), "entries")
    slim = entered.filter("bucket is null").select("doc_id", "text_hash", "n_shingles", "node")
    merged = entered.filter("bucket is not null").select("bucket", "entries").groupBy("bucket").applyInArrow(_merger(bits), f"{_COUNTED}, members binary")
    merged = materialize(merged, "merged")
    counted = materialize(_summed(merged.filter("members is null").drop("members")), "counts")
    able = materialize(counted.filter(F.col("n") + F.col("unknown") >= _wanted()).select("a", "b", "n", "unknown", _wanted().alias("k")), "pairs")
    links = _verify(docs, slim, able, levels, text_col, id_col)
    labels = components(links)
    release(links, able)
    lists = merged.filter("members is not null")
    if lists.limit(1).count():
        # whoever met before is decided; others have all their occurrences in open long lists
        across = _across(lists, labels)
        more = materialize(across.join(counted, ["a", "b"], "left_anti").select("a", "b", "n", F.lit(0).alias("unknown"), F.lit(1).alias("k")), "pairs-across")
        release(across)
        if more.limit(1).count():
            extra = _verify(docs, slim, more, levels, text_col, id_col)
            stars = labels.select(F.col("node").alias("u"), F.col("label").alias("v"))
            joined = components(stars.unionByName(extra))
            release(labels, extra)
            labels = joined
        release(more)
    release(merged, counted)
    least = slim.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("low")).join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = materialize(least, "node-least")
    of_label = materialize(least.groupBy("label").agg(F.min("low").alias("component_id")), "component-least")
    of_node = materialize(least.join(of_label, "label").select("node", "component_id"), "node-components")
    release(labels, least, of_label)
    out = slim.join(of_node, "node", "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "text_hash")
    return out, [entered, of_node]


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, text_hash (xxhash64 of the text).

    Texts are linked when 100 * intersection >= 80 * union of their shingle
    sets; component_id is the smallest identifier that links reach, itself
    included.  A null or empty text has no shingles and is linked with nothing.
    Rows with equal sets are linked.  A null identifier is never the smallest
    while its component has another.  Other columns are ignored; an empty table
    gives an empty result.
    """
    return _components_of(docs, id_col, text_col)[0]


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps its smallest identifier.

    All columns are kept.  Texts without words and rows with a null identifier
    stay.  Rows that cannot be among the dropped ones, by a bounded filter,
    stay without a join.
    """
    found, tables = _components_of(docs, id_col, text_col)
    gone = materialize(found.filter("n_shingles > 0 and doc_id <> component_id").select(F.col("doc_id").alias("g_id"), F.col("text_hash").alias("g_text")).distinct(), "near-copies")
    release(*tables)
    holds = value_filter(gone, "g_id")
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(id_col)

    def part(maybe: bool):
        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(at).cast(pa.int64())
                hit = holds(ids.fill_null(0).to_numpy()) & ids.is_valid().to_numpy(zero_copy_only=False)
                yield batch.filter(pa.array(hit == maybe))

        return pick

    rows = docs.toDF(*names)
    sure, maybe = rows.mapInArrow(part(False), rows.schema), rows.mapInArrow(part(True), rows.schema)
    text = F.col(names[docs.columns.index(text_col)])
    left = maybe.withColumn("x_text", F.xxhash64(text)).join(gone, (F.col(names[at]).cast("long") == F.col("g_id")) & (F.col("x_text") == F.col("g_text")), "left_anti").drop("x_text")
    return sure.unionByName(left).toDF(*docs.columns)
