"""Substring dedup by recompression.

A text's words are symbols.  First each run of equal symbols becomes one
symbol, then rounds replace pairs: a hash of its name puts every symbol on the
left or right side, and a left symbol followed by a right one becomes one.
Names are hashes of what they stand for, so all tasks name equal substrings
alike without asking each other, and what happens inside a substring depends on
its own symbols: equal windows of words have the same symbols but for some at
either end, and how many may differ there is known from the sides alone.

1.  Pairs of neighbouring symbols of the last round are counted over all texts.
    A window of ``width`` words can occur twice only if all the pairs that are
    sure to lie in it occur twice; a window without such a pair stays open.
2.  Of the open windows, hashes of all their words are brought together; each
    that occurs at two places is told one other place.
3.  Windows in a row that are told places in a row make a stretch.  The words of
    the other place are sent to the stretch and compared with its own.  Should a
    window's words differ (two windows with one hash), all windows with that
    hash are compared by their words.
4.  Words covered by a window that is proven to occur twice are removed.

Texts with equal words are one node; a node with two rows repeats as a whole.
A name that occurs often in a task is sent on twice only, so no common passage
gathers in one place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bitmaps import value_filter
from .kernels import PLACES, U64, bucket_bits, calls, mix, pack_keys, pack_small, sequence_hashes, slices, span_hashes, text_bytes, unpack_keys, unpack_small, window_hashes, word_spans
from .scratch import materialize, release, ship

WIDTH = 35
ROUNDS = 5
FLUSH = 1_500_000
_KEY_BITS = 48
_EMPTY = hashlib.sha256(b"").hexdigest()


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw, off = text_bytes(column)
    starts, ends, first = word_spans(raw, off)
    return span_hashes(raw, starts, ends), first


def nodes_of(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A signed hash of each text's words."""
    return mix(sequence_hashes(words, first) ^ PLACES[57]).view(np.int64)


class Parse:
    """The symbols of some texts after all rounds, and what is sure in each window.

    ``names``: of the last round's symbols; ``text``: their texts.  For the
    window that starts at word p, symbols ``low[p]`` to ``high[p] - 1`` are in
    every equal window too.  ``at``: the windows' first words, of all texts.
    """

    def __init__(self, words: np.ndarray, first: np.ndarray, width: int = WIDTH, rounds: int = ROUNDS) -> None:
        n = len(words)
        counts = np.diff(first)
        text = np.repeat(np.arange(len(counts)), counts)
        full = counts >= width
        self.at = np.concatenate([np.arange(f, f + c - width + 1) for f, c in zip(first[:-1][full], counts[full], strict=True)] or [np.zeros(0, np.int64)])
        begin = np.append(True, (words[1:] != words[:-1]) | (text[1:] != text[:-1])) if n else np.zeros(0, bool)
        starts = np.flatnonzero(begin)
        lengths = np.diff(np.append(starts, n))
        names = np.where(lengths > 1, mix(words[starts] * PLACES[50] + lengths.astype(U64)), words[starts])
        text = text[starts]
        symbol = np.cumsum(begin) - 1
        # the run at either end of a window may be longer in another text
        low = symbol[self.at] + 1
        high = symbol[self.at + width - 1]
        for r in range(rounds):
            left = np.append((mix(names ^ PLACES[r]) & U64(1)) == 1, [False, False])
            joined = left[: len(names)] & ~left[1 : len(names) + 1]
            joined[:-1] &= text[1:] == text[:-1]
            joined[-1:] = False
            begin = np.append(True, ~joined[:-1]) if len(names) else np.zeros(0, bool)
            number = np.append(np.cumsum(begin) - 1, [begin.sum(), begin.sum()])
            # a right symbol at the low end, or a left one at the high end, may pair with what lies outside
            low = number[np.minimum(low + ~left[low], len(names))]
            high = number[np.maximum(high - left[high - 1], 0)]
            starts = np.flatnonzero(begin)
            double = joined[starts]
            second = np.minimum(starts + 1, max(len(names) - 1, 0))
            names = np.where(double, mix(names[starts] * PLACES[20 + r] + names[second] * PLACES[30 + r]), names[starts])
            text = text[starts]
        # what leads out of a window's own text holds nothing
        own = np.repeat(np.flatnonzero(full), counts[full] - width + 1)
        self.low = np.minimum(low, np.searchsorted(text, own, "right"))
        self.high = np.maximum(high, np.searchsorted(text, own, "left"))
        self.names, self.text, self.own = names, text, own


#: A place: node, three numbers whose meaning the step knows, and the node of another place.
_PLACE = np.dtype([("node", "<i8"), ("j", "<i8"), ("a", "<i8"), ("z", "<i8"), ("other", "<i8")])
_SENT = "kind int, bucket int, keys binary, node binary, j binary, a binary, z binary, other binary"
_SCHEMA = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), *((c, pa.binary()) for c in ("keys", "node", "j", "a", "z", "other"))])
#: Windows from ``j`` on that are told windows of ``other`` from ``a`` on.
_STRETCH = np.dtype([("node", "<i8"), ("other", "<i8"), ("j", "<i4"), ("a", "<i4"), ("n", "<i4")])
_ASK, _TOLD = 0, 1
#: z may be less than a by this much.
_BACK = 64


def _rows(kind: int, buckets, groups: list[tuple[bytes | None, np.ndarray]]) -> pa.RecordBatch:
    cols = [[k for k, _ in groups], [p["node"].tobytes() for _, p in groups], [pack_small(p["j"]) for _, p in groups], [pack_small(p["a"]) for _, p in groups], [pack_small(p["z"] - p["a"] + _BACK) for _, p in groups], [p["other"].tobytes() if p["other"].any() else b"" for _, p in groups]]
    return pa.record_batch([pa.array([kind] * len(groups), pa.int32()), pa.array(np.asarray(buckets, np.int32)), *(pa.array(c, pa.binary()) for c in cols)], schema=_SCHEMA)


def _places(table: pa.Table) -> np.ndarray:
    out = []
    for node, j, a, z, other in zip(*(table.column(c) for c in ("node", "j", "a", "z", "other")), strict=True):
        node, other = np.frombuffer(node.as_py(), "<i8"), np.frombuffer(other.as_py(), "<i8")
        p = np.zeros(len(node), _PLACE)
        p["node"], p["j"], p["a"] = node, unpack_small(j.as_py(), len(node)), unpack_small(a.as_py(), len(node))
        p["z"] = p["a"] + unpack_small(z.as_py(), len(node)) - _BACK
        if len(other):
            p["other"] = other
        out.append(p)
    return np.concatenate(out) if out else np.zeros(0, _PLACE)


def _told(places: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Places dealt out by node."""
    if len(places):
        key = mix(places["node"].view(U64))
        order = np.lexsort((places["j"], key))
        buckets, at = slices(key[order], bits)
        places = places[order]
        yield _rows(_TOLD, buckets, [(None, places[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)])


def _sorted(keys: np.ndarray, places: np.ndarray, full: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By key (with ``full``, by a as well), then place; and where one equals the one before."""
    order = np.lexsort((places["j"], places["node"], places["a"], keys) if full else (places["j"], places["node"], keys))
    keys, places = keys[order], places[order]
    same = keys[1:] == keys[:-1]
    if full:
        same &= places["a"][1:] == places["a"][:-1]
    return keys, places, same


def _first_places(places: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """(start, start, node) of the first place of each place's group; of the group's second for the first."""
    sizes = np.diff(np.append(begins, len(places)))
    to = np.repeat(begins, sizes)
    to[begins[sizes > 1]] += 1
    return np.stack([places["j"][to], places["j"][to], places["node"][to]], 1)


def _asked(keys: np.ndarray, places: np.ndarray, bits: int, full: bool) -> Iterator[pa.RecordBatch]:
    """Keys with their places dealt out by key; of a key with more than two, the rest is told.

    ``full``: keys are sent whole, and ``a`` holds more bits of the same hash;
    who is told is told the first place of the key.
    """
    if not len(keys):
        return
    shift = U64(0 if full else 64 - _KEY_BITS)
    keys, places, same = _sorted(keys >> shift, places, full)
    begins = np.flatnonzero(np.append(True, ~same))
    nth = np.arange(len(keys)) - np.repeat(begins, np.diff(np.append(begins, len(keys))))
    rest = places[nth >= 2]
    if full:
        rest["a"], rest["z"], rest["other"] = _first_places(places, begins)[nth >= 2].T
    yield from _told(rest, bits)
    keys, places = keys[nth < 2], places[nth < 2]
    buckets, at = slices(keys << shift, bits)
    yield _rows(_ASK, buckets, [(pack_keys(keys[a:b]), places[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)])


def _answer(bits: int, full: bool):
    """Of a bucket's keys, the places of those that occur at two or more; told places pass."""

    def answer(table: pa.Table) -> pa.Table:
        kind = table.column("kind")[0].as_py()
        places = _places(table)
        if kind == _ASK:
            keys = np.concatenate([unpack_keys(b.as_py()) for b in table.column("keys")])
            keys, places, same = _sorted(keys, places, full)
            fresh = np.append(True, ~(same & (places["node"][1:] == places["node"][:-1]) & (places["j"][1:] == places["j"][:-1])))
            keys, places, again = _sorted(keys[fresh], places[fresh], full)
            twice = np.append(again, False) | np.append(False, again)
            if full and len(places):
                places["a"], places["z"], places["other"] = _first_places(places, np.flatnonzero(np.append(True, ~again))).T
            places = places[twice]
        return pa.Table.from_batches(list(_told(places, bits)), _SCHEMA)

    return answer


def _gather(asked: DataFrame, bits: int, full: bool, finish, ddl: str, name: str) -> DataFrame:
    """Ask by key, then hand each node's repeated places to ``finish``."""
    told = materialize(asked.groupBy("kind", "bucket").applyInArrow(_answer(bits, full), _SENT), name)
    out = materialize(told.groupBy("bucket").applyInArrow(finish, ddl), f"{name}-by-node")
    release(told)
    return out


def _by_node(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of each node's places, which stand together."""
    node = places["node"]
    cuts = np.flatnonzero(node[1:] != node[:-1]) + 1
    some = [len(places)] if len(places) else []
    return np.concatenate([[0][: len(some)], cuts]).astype(int), np.concatenate([cuts, some]).astype(int)


def _open_ranges(table: pa.Table) -> pa.Table:
    """Per node: the ranges of window starts at which all sure pairs repeat."""
    places = _places(table)
    places = places[np.lexsort((places["z"], places["j"], places["node"]))]
    # a range told as it is has j = 0 and stands alone
    whole = places[places["j"] == 0]
    pairs = places[places["j"] > 0]
    if len(pairs):
        pairs = pairs[np.append(True, (pairs["node"][1:] != pairs["node"][:-1]) | (pairs["j"][1:] != pairs["j"][:-1]))]
        head = np.append(True, (pairs["node"][1:] != pairs["node"][:-1]) | (pairs["j"][1:] != pairs["j"][:-1] + 1))
        starts = np.flatnonzero(head)
        runs = pairs[starts]
        runs["z"] = pairs["z"][np.append(starts[1:], len(pairs)) - 1]
        whole = np.concatenate([whole, runs])
    whole = whole[whole["z"] > whole["a"]]
    whole = whole[np.lexsort((whole["a"], whole["node"]))]
    begins, ends = _by_node(whole)
    spans = np.stack([whole["a"], whole["z"]], 1).astype("<i4")
    return pa.table({"node": pa.array(whole["node"][begins]), "ranges": pa.array([spans[a:b].tobytes() for a, b in zip(begins, ends, strict=True)], pa.binary())})


def _stretches(table: pa.Table) -> pa.Table:
    """The stretches of a bucket's nodes, gathered by the node that holds the other place."""
    places = _places(table)
    places = places[np.lexsort((places["j"], places["node"]))]
    head = np.append(True, (places["node"][1:] != places["node"][:-1]) | (places["j"][1:] != places["j"][:-1] + 1) | (places["other"][1:] != places["other"][:-1]) | (places["a"][1:] != places["a"][:-1] + 1))
    starts = np.flatnonzero(head)
    out = np.zeros(len(starts), _STRETCH)
    for name in ("node", "other", "j", "a"):
        out[name] = places[name][starts]
    out["n"] = np.diff(np.append(starts, len(places)))
    out = out[np.argsort(out["other"], kind="stable")]
    cuts = np.flatnonzero(np.append(True, out["other"][1:] != out["other"][:-1]))
    return pa.table({"node": pa.array(out["other"][cuts].copy()), "stretches": pa.array([out[i:k].tobytes() for i, k in zip(cuts, np.append(cuts[1:], len(out)), strict=True)], pa.binary())})


def _slices(width: int):
    """Of texts with the stretches that are told their places: the words that each stretch must equal."""

    def slices_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, blob in zip(batch.column("text").cast(pa.large_binary()), batch.column("stretches"), strict=True):
                words = text.as_py().split()
                asked = np.frombuffer(blob.as_py(), _STRETCH)
                told = [b" ".join(words[a : a + n + width - 1]) for a, n in zip(asked["a"].tolist(), asked["n"].tolist(), strict=True)]
                yield pa.record_batch([pa.array(asked["node"].copy()), pa.array(asked["j"].copy()), pa.array(asked["n"].copy()), pa.array(told, pa.binary())], names=["node", "j", "n", "words"])

    return slices_of


def _prove(width: int):
    """Of texts with their stretches: the window starts that are proven, and those whose words differ."""

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, bad = [], []
            for text, told in zip(batch.column("text").cast(pa.large_binary()), batch.column("told").to_pylist(), strict=True):
                words = text.as_py().split()
                proven: list[int] = []
                unproven: list[int] = []
                for s in told:
                    j, n = s["j"], s["n"]
                    own = words[j : j + n + width - 1]
                    if b" ".join(own) == s["words"]:
                        proven += range(j, j + n)
                        continue
                    other = s["words"].split()
                    for i in range(n):
                        (proven if own[i : i + width] == other[i : i + width] else unproven).append(j + i)
                good.append(np.array(sorted(proven), "<i4").tobytes())
                bad.append(np.array(sorted(unproven), "<i4").tobytes())
            yield pa.record_batch([batch.column("node"), pa.array(good, pa.binary()), pa.array(bad, pa.binary())], names=["node", "starts", "unproven"])

    return prove


def _by_words(opened: DataFrame, proven: DataFrame, width: int) -> DataFrame:
    """node, start: windows whose told place had other words, and that do occur twice.

    All open windows with one of their hashes are compared by their words.
    """

    def windows(wanted: str | None):
        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words, first = word_hashes(batch.column("text"))
                hashes = window_hashes(words, width).view(np.int64)
                for i, node in enumerate(batch.column("node").to_pylist()):
                    if wanted:
                        starts = np.frombuffer(batch.column(wanted)[i].as_py(), "<i4")
                    else:
                        starts = np.unique(np.concatenate([np.arange(a, z) for a, z in np.frombuffer(batch.column("ranges")[i].as_py(), "<i4").reshape(-1, 2)]))
                    if not len(starts):
                        continue
                    split = batch.column("text")[i].cast(pa.large_binary()).as_py().split()
                    yield pa.record_batch([pa.array(hashes[first[i] + starts]), pa.array(np.full(len(starts), node)), pa.array(starts.astype(np.int32)), pa.array([b" ".join(split[s : s + width]) for s in starts.tolist()], pa.binary())], names=["key", "node", "start", "words"])

        return emit

    ddl = "key long, node long, start int, words binary"
    failed = materialize(opened.join(proven.filter("octet_length(unproven) > 0"), "node").select("node", "text", "unproven").mapInArrow(windows("unproven"), ddl), "unproven")
    if not failed.limit(1).count():
        return failed.select("node", "start")
    alike = opened.mapInArrow(windows(None), ddl).join(failed.select("key").distinct(), "key", "left_semi")
    twice = alike.groupBy("words").agg(F.count(F.lit(1)).alias("places")).filter("places > 1")
    return failed.join(twice, "words", "left_semi").select("node", "start")


def _ask_pairs(width: int, bits: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        places: list[np.ndarray] = []
        seen: set[int] = set()
        size = 0
        for batch in calls(batches):
            words, first = word_hashes(batch.column("text"))
            nodes = nodes_of(words, first)
            fresh = np.zeros(len(nodes), bool)
            for i in np.flatnonzero(np.diff(first) >= width):
                if nodes[i] not in seen:
                    seen.add(nodes[i])
                    fresh[i] = True
            parse = Parse(words, first, width)
            use = fresh[parse.own]
            at, low, high, owner = parse.at[use], parse.low[use], parse.high[use], parse.own[use]
            # windows without a sure pair stay open: told as ranges of their own
            bare = np.flatnonzero(high - low < 2)
            if len(bare):
                head = np.append(True, (at[bare][1:] != at[bare][:-1] + 1) | (owner[bare][1:] != owner[bare][:-1]))
                starts = np.flatnonzero(head)
                p = np.zeros(len(starts), _PLACE)
                p["node"] = nodes[owner[bare[starts]]]
                p["a"] = at[bare[starts]] - first[owner[bare[starts]]]
                lasts = bare[np.append(starts[1:], len(bare)) - 1]
                p["z"] = at[lasts] - first[owner[lasts]] + 1
                yield from _told(p, bits)
            # pairs sure to lie in some window, with the windows that a run from or to them allows
            for_symbol = np.flatnonzero((parse.text[1:] == parse.text[:-1]) & fresh[parse.text[:-1]]) if len(parse.names) > 1 else np.zeros(0, int)
            text_of = parse.text[for_symbol]
            bounds = np.searchsorted(owner, np.arange(len(nodes) + 1))
            lo, hi = bounds[text_of], bounds[text_of + 1]
            # low and high rise with the window over all texts
            a = np.clip(np.searchsorted(low, for_symbol, "left"), lo, hi)
            z = np.clip(np.searchsorted(high, for_symbol + 2, "right"), lo, hi)
            sure = np.zeros(len(parse.names) + 1, np.int64)
            some = high - low >= 2
            np.add.at(sure, low[some], 1)
            np.add.at(sure, high[some] - 1, -1)
            inside = np.cumsum(sure)[for_symbol] > 0
            for_symbol, text_of, a, z, lo = for_symbol[inside], text_of[inside], a[inside], z[inside], lo[inside]
            p = np.zeros(len(for_symbol), _PLACE)
            p["node"] = nodes[text_of]
            p["j"] = for_symbol - np.searchsorted(parse.text, text_of) + 1
            p["a"] = a - lo
            p["z"] = z - lo
            # a later end only opens more windows
            p["z"] = np.maximum(p["z"], p["a"] - _BACK)
            keys.append(mix(parse.names[for_symbol] * PLACES[40] + parse.names[for_symbol + 1] * PLACES[41]))
            places.append(p)
            size += len(p)
            if size >= FLUSH:
                yield from _asked(np.concatenate(keys), np.concatenate(places), bits, False)
                keys, places, size = [], [], 0
                seen.clear()
        if size:
            yield from _asked(np.concatenate(keys), np.concatenate(places), bits, False)

    return ask


def _ask_windows(width: int, bits: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        places: list[np.ndarray] = []
        size = 0
        for batch in calls(batches):
            words, first = word_hashes(batch.column("text"))
            hashes = window_hashes(words, width)
            # 24 bits of another hash of the same words
            others = window_hashes(mix(words ^ PLACES[56]), width) >> U64(40)
            for i, (node, blob) in enumerate(zip(batch.column("node").to_pylist(), batch.column("ranges").to_pylist(), strict=True)):
                spans = np.frombuffer(blob, "<i4").reshape(-1, 2)
                starts = np.unique(np.concatenate([np.arange(a, z) for a, z in spans]))
                p = np.zeros(len(starts), _PLACE)
                p["node"], p["j"] = node, starts
                p["a"] = p["z"] = others[first[i] + starts]
                keys.append(hashes[first[i] + starts])
                places.append(p)
                size += len(p)
            if size >= FLUSH:
                yield from _asked(np.concatenate(keys), np.concatenate(places), bits, True)
                keys, places, size = [], [], 0
        if size:
            yield from _asked(np.concatenate(keys), np.concatenate(places), bits, True)

    return ask


def remove_repeats(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 (and kept_text).

    Every word covered by a window of ``width`` words that also starts anywhere
    else, in this text or another, is removed; windows are judged on the input.
    A null text has no words.  A text shorter than ``width`` loses none.  Of
    repeated rows each counts as a place of its own.  Other columns are
    ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in calls(batches):
            words, first = word_hashes(batch.column("text"))
            shas, kept = [], []
            for t in batch.column("text").cast(pa.large_binary()):
                joined = b" ".join((t.as_py() or b"").split())
                shas.append(hashlib.sha256(joined).hexdigest())
                kept.append(joined.decode() if with_text else None)
            yield pa.record_batch([batch.column("doc_id"), pa.array(np.diff(first).astype(np.int64)), pa.array(nodes_of(words, first)), pa.array(shas), pa.array(kept, pa.string())], names=["doc_id", "n_words", "node", "all_sha256", "all_text"])

    slim = materialize(source.mapInArrow(measure, "doc_id long, n_words long, node long, all_sha256 string, all_text string"), "words")
    total = slim.agg(F.sum("n_words")).first()[0] or 0
    bits = bucket_bits(total / 4, each=5e5)
    asked = source.mapInArrow(_ask_pairs(width, bits), _SENT)
    ranges = _gather(asked, bits, False, _open_ranges, "node long, ranges binary", "pairs-told")
    ids = slim.join(ranges.select("node"), "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    ids = materialize(ids, "open-ids")
    holds = value_filter(ids, "doc_id")
    release(ids)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in calls(batches):
            ids = batch.column("doc_id")
            some = batch.filter(pa.array(holds(ids.fill_null(0).to_numpy()) | ids.is_null().to_numpy(zero_copy_only=False)))
            if some.num_rows:
                yield pa.record_batch([pa.array(nodes_of(*word_hashes(some.column("text")))), some.column("text")], names=["node", "text"])

    opened = source.mapInArrow(texts, "node long, text string").dropDuplicates(["node"]).join(ranges, "node")
    opened = materialize(opened, "open-texts")
    asked = _gather(opened.mapInArrow(_ask_windows(width, bits), _SENT), bits, True, _stretches, "node long, stretches binary", "windows-told")
    told = materialize(opened.select("node", "text").join(asked, "node").mapInArrow(_slices(width), "node long, j int, n int, words binary"), "other-words")
    release(asked)
    # of a node, at most one stretch a window
    told_by_node = told.groupBy("node").agg(F.collect_list(F.struct("j", "n", "words")).alias("told"))
    proven = opened.select("node", "text").join(told_by_node, "node").mapInArrow(_prove(width), "node long, starts binary, unproven binary")
    proven = materialize(proven, "proven")
    release(told)
    late = materialize(_by_words(opened, proven, width).groupBy("node").agg(F.collect_set("start").alias("late")), "proven-by-words")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, shas, kept = [], [], []
            for t, s, more in zip(batch.column("text").cast(pa.large_binary()), batch.column("starts"), batch.column("late").to_pylist(), strict=True):
                words = t.as_py().split()
                cover = np.zeros(len(words) + width + 1, np.int64)
                at = np.concatenate([np.frombuffer(s.as_py(), "<i4"), np.array(more or [], "<i4")])
                cover[at] += 1
                cover[at + width] -= 1
                gone = np.cumsum(cover)[: len(words)] > 0
                left = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                removed.append(int(gone.sum()))
                shas.append(hashlib.sha256(left).hexdigest())
                kept.append(left.decode() if with_text else None)
            yield pa.record_batch([batch.column("node"), pa.array(removed, pa.int64()), pa.array(shas, pa.string()), pa.array(kept, pa.string())], names=["node", "removed", "sha", "left_text"])

    repeated = opened.select("node", "text").join(proven, "node").join(late, "node", "left").select("node", "text", "starts", "late").mapInArrow(cut, "node long, removed long, sha string, left_text string")
    # a node with two rows repeats as a whole
    many = materialize(slim.filter(F.col("n_words") >= width).groupBy("node").agg(F.count(F.lit(1)).alias("rows"), F.max("n_words").alias("n")).filter("rows > 1"), "whole-repeats")
    whole = many.select("node", F.col("n").alias("removed"), F.lit(_EMPTY).alias("sha"), F.lit("").alias("left_text"))
    verdicts = materialize(repeated.join(many.select("node"), "node", "left_anti").unionByName(whole), "verdicts")
    release(ranges, opened, proven, late, many)
    out = slim.join(verdicts, "node", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("sha", "all_sha256").alias("kept_sha256"),
        F.when(F.col("removed").isNull(), F.col("all_text")).otherwise(F.col("left_text")).alias("kept_text"),
    )
    return out if with_text else out.drop("kept_text")
