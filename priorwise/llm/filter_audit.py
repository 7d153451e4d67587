"""How text filters interact: what each removes in every order of application.

One finite-state pass reads the UTF-8 bytes of a batch of texts.  A byte's
class and the state before it (outside or inside a word) give, by table, the
next state and the marks to emit: word begins, word ends, capital, symbol,
continuation byte.  The automaton has a table of its own for each byte, and as
every byte leads to one state whatever the state before, the states of all
bytes come from one look-up and need no loop.  Word spans go into an
open-addressing hash table keyed by text and bytes; a span that meets an
occupied slot is compared byte by byte before it counts as the same word.

What a corpus needs afterwards is small: how many documents of a part fail just
which filters.  Every order's counts follow from those at most 32 numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .kernels import IS_SPACE, PLACES, U64, calls, mix, span_hashes, text_bytes
from .scratch import materialize, ship

#: The filters; a document's failures are the sum of their bits.
FILTERS = "ABCDE"
BIT = {f: 1 << k for k, f in enumerate(FILTERS)}
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITALS_PERCENT = 3
SYMBOLS = "#$%&*|"

OUTSIDE, INSIDE = 0, 1
BEGINS, ENDS, CAPITAL, SYMBOL, CONTINUES = 1, 2, 4, 8, 16
#: Words longer than this many bytes are compared as byte strings.
_LONG = 64


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The state that a byte leads to, and the marks of (state before, byte)."""
    byte = np.arange(256)
    after = np.where(IS_SPACE, OUTSIDE, INSIDE).astype(np.uint8)
    own = np.zeros(256, np.uint8)
    own[(byte >= ord("A")) & (byte <= ord("Z"))] |= CAPITAL
    own[list(SYMBOLS.encode())] |= SYMBOL
    own[(byte & 0xC0) == 0x80] |= CONTINUES
    marks = np.zeros((2, 256), np.uint8)
    marks[OUTSIDE] = own | np.where(after == INSIDE, BEGINS, 0)
    marks[INSIDE] = own | np.where(after == OUTSIDE, ENDS, 0)
    return after, marks.ravel()


_AFTER, _MARKS = _tables()


def transduce(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The marks of every byte, and the start and end byte of every word."""
    before = np.zeros(len(raw), np.uint16)
    before[1:] = _AFTER[raw[:-1]]
    cuts = off[:-1][off[:-1] < len(raw)]
    open_ends = np.unique(cuts[(before[cuts] == INSIDE) & (cuts > 0)])  # a text that ends inside a word
    before[cuts] = OUTSIDE
    marks = _MARKS[(before << 8) | raw]
    ends = np.flatnonzero(marks & ENDS)
    # a word may also end where its text does
    last = np.array([len(raw)] if len(raw) and _AFTER[raw[-1]] == INSIDE else [], np.int64)
    return marks, np.flatnonzero(marks & BEGINS), np.sort(np.concatenate([ends, open_ends, last]))


def _lanes(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each byte on, as one integer; zeros follow the last."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    return np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(raw) + 1,), (1,))


_LOW = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)


class SpanTable:
    """Distinct byte spans of each text: open addressing, every meeting verified."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray) -> None:
        self.raw, self.starts, self.sizes, self.text = raw, starts, ends - starts, text
        self.lanes = _lanes(raw)
        self.head = self._lane(starts, self.sizes)

    def _lane(self, at: np.ndarray, left: np.ndarray) -> np.ndarray:
        return self.lanes[at] & _LOW[np.minimum(left, 8)]

    def hashes(self) -> np.ndarray:
        out = mix(self.head * PLACES[0] + self.sizes.astype(U64) * PLACES[1] + self.text.astype(U64) * PLACES[2])
        for k in range(8, _LONG, 8):
            more = np.flatnonzero((self.sizes > k) & (self.sizes <= _LONG))
            if not len(more):
                break
            out[more] = mix(out[more] + self._lane(self.starts[more] + k, self.sizes[more] - k) * PLACES[3])
        long = np.flatnonzero(self.sizes > _LONG)
        if len(long):
            out[long] += span_hashes(self.raw, self.starts[long], self.starts[long] + self.sizes[long])
        return out

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether spans a and b have the same text and the same bytes."""
        same = (self.text[a] == self.text[b]) & (self.sizes[a] == self.sizes[b]) & (self.head[a] == self.head[b])
        for k in range(8, _LONG, 8):
            at = np.flatnonzero(same & (self.sizes[a] > k) & (self.sizes[a] <= _LONG))
            if not len(at):
                break
            left = self.sizes[a[at]] - k
            same[at] = self._lane(self.starts[a[at]] + k, left) == self._lane(self.starts[b[at]] + k, left)
        for i in np.flatnonzero(same & (self.sizes[a] > _LONG)):
            x, y, n = self.starts[a[i]], self.starts[b[i]], self.sizes[a[i]]
            same[i] = np.array_equal(self.raw[x : x + n], self.raw[y : y + n])
        return same

    def distinct(self, texts: int) -> np.ndarray:
        """Number of different spans of each text."""
        n = len(self.starts)
        mask = (1 << max(4, (2 * n).bit_length())) - 1
        table = np.full(mask + 1, -1, np.int64)
        new = np.zeros(n, bool)
        waiting, slot = np.arange(n), (self.hashes() & U64(mask)).astype(np.int64)
        while len(waiting):
            free = table[slot] < 0
            table[slot[free]] = waiting[free]
            holder = table[slot]
            new[waiting[holder == waiting]] = True
            on = np.flatnonzero(~(holder == waiting))
            on = on[~self.equal(waiting[on], holder[on])]
            waiting, slot = waiting[on], (slot[on] + 1) & mask
        return np.bincount(self.text[new], minlength=texts)


def text_failures(column: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """Bits of the filters A to D that each text fails, and the SHA-256 of each text."""
    raw, off = text_bytes(column)
    n = len(off) - 1
    marks, starts, ends = transduce(raw, off)

    def per_text(at: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(at, off))

    words = per_text(starts)
    distinct = SpanTable(raw, starts, ends, np.repeat(np.arange(n), words)).distinct(n)
    points = np.diff(off) - per_text(np.flatnonzero(marks & CONTINUES))
    capitals = per_text(np.flatnonzero(marks & CAPITAL))
    symbols = per_text(np.flatnonzero(marks & SYMBOL))
    fails = np.where(words < LEAST_WORDS, BIT["A"], 0)
    fails |= np.where(100 * distinct < LEAST_DISTINCT_PERCENT * words, BIT["B"], 0)
    fails |= np.where(100 * capitals > MOST_CAPITALS_PERCENT * points, BIT["C"], 0)
    fails |= np.where(symbols > 0, BIT["D"], 0)
    whole = memoryview(raw.tobytes())
    return fails, [hashlib.sha256(whole[a:b]).digest() for a, b in zip(off[:-1], off[1:], strict=True)]


def failures(docs: DataFrame, part: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, part, fails (bits of A to E) per row; a written table lies beneath.

    E is worked out from digests: of each text that occurs twice or more, its
    smallest identifier is looked up.  Texts count as identical when their
    SHA-256 is the same.
    """
    ship(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in calls(batches):
            fails, digests = text_failures(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array(fails.astype(np.int32)), pa.array(digests, pa.binary())], names=["doc_id", "part", "alone", "digest"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text_col).alias("text"))
    rows = materialize(slim.mapInArrow(work, "doc_id long, part string, alone int, digest binary"), "filter-rows")
    # written before it is joined, so that the rows of a text with very many copies can be split
    twice = rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1 and least is not null")
    twice = materialize(twice.select(F.col("digest").alias("of"), "least"), "filter-copies")
    later = F.col("least").isNotNull() & F.coalesce(F.col("doc_id") > F.col("least"), F.lit(True))
    joined = rows.join(twice, F.col("digest") == F.col("of"), "left")
    return joined.select("doc_id", "part", (F.col("alone") + F.when(later, BIT["E"]).otherwise(0)).alias("fails"))


def failure_cells(docs: DataFrame, labels: DataFrame, part: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """part and cells: an array of at most 32 structs (fails, n, good, toxic)."""
    known = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("labelled")).agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    rows = failures(docs, part, id_col, text_col).join(materialize(known, "filter-labels"), F.col("doc_id") == F.col("labelled"), "left")
    cells = rows.groupBy("part", "fails").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("quality") == 1, 1)).alias("good"),
        F.count(F.when(F.col("toxic") == 1, 1)).alias("toxic"),
    )
    # a part has at most 32 sets of failures
    return cells.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("cells"))


ORDERS = ["".join(p) for p in permutations(FILTERS)]


def audit_orders(cells: DataFrame) -> DataFrame:
    """The counts of every part, order and step from the part's cells."""
    own, earlier = F.col("own"), F.col("earlier")

    def total(where, value="n") -> Column:
        chosen = F.filter("cells", where)
        return F.aggregate(chosen, F.lit(0).cast("long"), lambda acc, c: acc + c[value])

    def here(c: Column) -> Column:
        return (c["fails"].bitwiseAND(own) != 0) & (c["fails"].bitwiseAND(earlier) == 0)

    # of the orders, those in which the filter comes before the others that the document fails
    shares = F.array(F.lit(0), *[F.lit(len(ORDERS) // k) for k in range(1, len(FILTERS) + 1)])
    shapley = F.aggregate(F.filter("cells", lambda c: c["fails"].bitwiseAND(own) != 0), F.lit(0).cast("long"), lambda acc, c: acc + c["n"] * F.get(shares, F.bit_count(c["fails"])))
    orders = cells.select("part", "cells", F.explode(F.array(*[F.lit(o) for o in ORDERS])).alias("filter_order"))
    steps = orders.select("*", F.explode(F.array(*[F.lit(k + 1) for k in range(len(FILTERS))])).alias("step"))

    def bits(when) -> Column:
        return sum((F.when(when(F.instr("filter_order", f)), BIT[f]).otherwise(0) for f in FILTERS), F.lit(0))

    steps = steps.withColumns({"own": bits(lambda at: at == F.col("step")), "earlier": bits(lambda at: at < F.col("step"))})
    return steps.select(
        "part", "filter_order", "step",
        total(lambda c: c["fails"].bitwiseAND(own.bitwiseOR(earlier)) == 0).alias("kept"),
        total(here).alias("removed"),
        total(lambda c: (c["fails"].bitwiseAND(own) != 0) & (c["fails"].bitwiseAND(earlier) != 0)).alias("redundant"),
        total(lambda c: c["fails"] == own).alias("unique_fails"),
        total(here, "good").alias("good_lost"),
        total(here, "toxic").alias("toxic_lost"),
        shapley.alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    One row for each part, each of the 120 orders and each of its five steps.
    A null text counts as empty (it fails A alone, and E where a smaller
    identifier is empty too), a null part as the empty string.  A row without
    identifier comes after all others: it fails E if its text occurs at a row
    with one.  Rows that repeat with their identifier count as rows, and none
    of them is a copy of the other.  Of repeated labels the lowest quality and
    the highest toxic value hold.  Other columns are ignored; an empty table
    gives an empty result.  Texts of any length are read whole; a batch holds
    about 1 MB of text, or one text that is longer.
    """
    return audit_orders(failure_cells(docs, labels, part, id_col, text_col))
