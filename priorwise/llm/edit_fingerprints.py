"""Document fingerprints that keep edit distance: random walks, bit samples, bands.

A text is read by a walk whose randomness all texts share: at step j the walk
stands on a character, and a bit fixed by (j, character) tells whether it goes
on to the next one.  Where two texts differ by an edit, their walks stand on
different places for a while and then, by chance, fall into step again; so a
few edits become a few differing steps, and an edit distance becomes a Hamming
distance between the sequences of places visited.  A text is walked in segments
of 1,024 characters with three steps a character, all segments of a batch in
step with one another; a short last segment takes the fewer steps it needs.

Every twelfth step is a slot.  A fingerprint keeps a sample of the slots that
all texts share: slot t is in the sample of level c when the hash of t ends in
c zero bits, and a text takes the lowest level that leaves it about 128 slots.
Samples of two levels are nested, so texts of any two lengths are compared on
the higher level.  A sampled slot is one hexadecimal digit: 0 where the walk has
come to the segment's end, else 1 to 15 by the hash of the six characters from
the walk's place on.

Near documents are found by bands (runs of sampled digits of one level and
place in the text); a candidate is verified on whole fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .kernels import CALL_BYTES, PLACES, U64, mix
from .scratch import materialize, ship, shuffle_partitions

SEGMENT = 1024
STEPS = 3 * SEGMENT
STRIDE = 12
SLOTS = STEPS // STRIDE
SAMPLED = 128
GRAM = 6
DIGITS = 15
#: Sampled digits that make a band.
BAND = 8
_CLASSES = 64
_WALK_SEED = 7
_MOVES = np.random.Generator(np.random.PCG64(_WALK_SEED)).integers(0, 2, (STEPS, _CLASSES), dtype=np.int64)
_MOVES[:, 0] = 0  # class 0 ends a segment


class _Sample:
    """The slots of each level, in order, as far as any text so far needed them."""

    def __init__(self) -> None:
        self.upto = 0
        self.zeros = np.zeros(0, np.int64)
        self.levels: list[np.ndarray] = []

    def grow(self, slots: int) -> None:
        if slots > self.upto:
            self.upto = max(slots, 2 * self.upto, 4096)
            h = mix(np.arange(self.upto, dtype=U64) * PLACES[40] + PLACES[41])
            low = h & (~h + U64(1))
            self.zeros = np.where(h > 0, np.frexp(low.astype(np.float64))[1] - 1, 64)
            self.levels = []

    def of(self, slots: int, level: int) -> np.ndarray:
        """The sampled slots below ``slots``."""
        self.grow(slots)
        while len(self.levels) <= level:
            self.levels.append(np.flatnonzero(self.zeros >= len(self.levels)))
        at = self.levels[level]
        return at[: np.searchsorted(at, slots)]


_SAMPLE = _Sample()


def n_slots(size: int) -> int:
    full, rest = divmod(size, SEGMENT)
    return full * SLOTS + -(-rest * 3 // STRIDE)


def level_of(slots: int) -> int:
    return max(0, -(-slots // SAMPLED) - 1).bit_length()


def _walks(points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At every slot of every text the place in ``points`` where its walk stands.

    -1 where the segment has ended; and each text's first slot (n + 1).
    """
    first = np.cumsum(sizes) - sizes
    count = -(-sizes // SEGMENT)
    text = np.repeat(np.arange(len(sizes)), count)
    k = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    begin = first[text] + k * SEGMENT
    length = np.minimum(SEGMENT, sizes[text] - k * SEGMENT)
    slots = -(-length * 3 // STRIDE)
    out_at = np.cumsum(slots) - slots
    out = np.empty(int(slots.sum()), np.int64)
    # a character's class, and class 0 after each segment: place p of segment s lies at p + s
    classes = np.zeros(len(points) + len(text), np.uint8)
    classes[np.arange(len(points)) + np.repeat(np.arange(len(text)), length)] = mix(points.astype(U64) * PLACES[42]) % U64(_CLASSES - 1) + U64(1)
    order = np.argsort(-length, kind="stable")
    at = (begin + np.arange(len(text)))[order]
    own, most = slots[order], int(slots.max(initial=0))
    # longest first: those that still have slots stand in front
    live = np.searchsorted(-own, -np.arange(most), "left")
    for t in range(most):
        n = int(live[t])
        here = at[:n]
        ended = classes.take(here)
        out[out_at[order[:n]] + t] = np.where(ended > 0, here - order[:n], -1)
        for j in range(t * STRIDE, (t + 1) * STRIDE):
            here += _MOVES[j].take(classes.take(here))
    bounds = np.concatenate([[0], np.cumsum(np.bincount(text, weights=slots, minlength=len(sizes)).astype(np.int64))])
    return out, bounds


def fingerprints(texts: list[np.ndarray]) -> list[bytes]:
    """Of each text (its code points): level, slots (4 bytes), then a byte a sampled slot."""
    sizes = np.array([len(t) for t in texts], np.int64)
    points = np.concatenate([*texts, np.zeros(0, np.uint32)]).astype(np.uint32)
    places, bounds = _walks(points, sizes)
    wanted, level, chosen = [], [], []
    for k in range(len(texts)):
        slots = int(bounds[k + 1] - bounds[k])
        level.append(level_of(slots))
        at = _SAMPLE.of(slots, level[-1])
        chosen.append(at)
        wanted.append(places[bounds[k] + at])
    counts = [len(w) for w in wanted]
    place = np.concatenate([*wanted, np.zeros(0, np.int64)])
    slot = np.concatenate([*chosen, np.zeros(0, np.int64)])
    end = np.repeat(np.cumsum(sizes), counts)
    gram = np.zeros(len(place), U64)
    padded = np.append(points.astype(U64), U64(0))
    for g in range(GRAM):
        inside = (place >= 0) & (place + g < end)
        gram += np.where(inside, padded[np.where(inside, place + g, 0)] + U64(1), U64(0)) * PLACES[43 + g]
    digit = np.where(place < 0, 0, mix(gram + slot.astype(U64) * PLACES[50]) % U64(DIGITS) + U64(1)).astype(np.uint8).tobytes()
    out, at = [], 0
    for k, n in enumerate(counts):
        out.append(bytes([level[k]]) + int(bounds[k + 1] - bounds[k]).to_bytes(4, "big") + digit[at : at + n])
        at += n
    return out


def likeness(a: bytes, b: bytes) -> float:
    """Share of slots with equal digits, less what chance gives: 1 for equal texts, about 0 for unrelated ones."""
    if a == b:
        return 1.0
    level = max(a[0], b[0])

    def digits(x: bytes) -> np.ndarray:
        own = np.frombuffer(x, np.uint8, offset=5)
        slots = _SAMPLE.of(int.from_bytes(x[1:5], "big"), x[0])
        return own if x[0] == level else own[_SAMPLE.zeros[slots] >= level]

    x, y = digits(a), digits(b)
    if len(x) < len(y):
        x, y = y, x
    n = len(y)
    both = x[:n] == y
    met = np.count_nonzero(both & (y > 0))
    counted = len(x) - np.count_nonzero(both & (y == 0)) - np.count_nonzero(x[n:] == 0)
    return max(0.0, (met / counted - 1 / DIGITS) / (1 - 1 / DIGITS)) if counted else 0.0


def shown(x: bytes) -> str:
    """The fingerprint as text: ten digits of level and slots, then a digit a slot."""
    return x[:5].hex() + x[5:].hex()[1::2]


def packed(text: str) -> bytes:
    """The fingerprint that :func:`shown` wrote."""
    return bytes.fromhex(text[:10]) + bytes(int(d, 16) for d in text[10:])


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def edited(text: str, after: str) -> str:
    """The text with its last half replaced by the beginning of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


_ROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha", pa.binary()), ("own", pa.binary()), ("edit", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("part", pa.int32()), ("side", pa.string()), ("text", pa.large_string())])
_DDL = "doc_id long, n_chars long, edited_sha binary, own binary, edit binary, near_edited double, near_next double, part int, side string, text string"


def _report(ids: list[int | None], texts: list[str], nexts: list[str], next_prints: list[bytes] | None = None) -> pa.RecordBatch:
    """Rows of texts whose next text is known; unless given, it is the one that follows."""
    edits = [edited(t, u) for t, u in zip(texts, nexts, strict=True)]
    own = fingerprints([points(t) for t in texts])
    if next_prints is None:
        next_prints = own[1:] + fingerprints([points(nexts[-1])])
    edit = fingerprints([points(t) for t in edits])
    n = len(ids)
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": ids,
            "n_chars": [len(t) for t in texts],
            "edited_sha": [hashlib.sha256(t.encode()).digest() for t in edits],
            "own": own,
            "edit": edit,
            "near_edited": [likeness(a, b) for a, b in zip(own, edit, strict=True)],
            "near_next": [likeness(a, b) for a, b in zip(own, next_prints, strict=True)],
            "part": [None] * n,
            "side": [None] * n,
            "text": [None] * n,
        },
        schema=_ROW,
    )


def _ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one sorted partition; its first and last text also go on, marked, to meet those of its neighbours."""
    part = TaskContext.get().partitionId()

    def side(which: str, doc_id: int | None, text: str) -> pa.RecordBatch:
        row = {"doc_id": [doc_id], "part": [part], "side": [which], "text": [text]}
        return pa.RecordBatch.from_pydict({c: row.get(c, [None]) for c in _ROW.names}, schema=_ROW)

    ids: list[int | None] = []
    texts: list[str] = []
    held, begun = 0, False
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not begun:
                yield side("first", doc_id, text)
                begun = True
            ids.append(doc_id)
            texts.append(text)
            held += len(text)
            if held > CALL_BYTES and len(texts) > 1:
                yield _report(ids[:-1], texts[:-1], texts[1:])
                ids, texts, held = ids[-1:], texts[-1:], len(text)
    if len(texts) > 1:
        yield _report(ids[:-1], texts[:-1], texts[1:])
    if texts:
        yield side("last", ids[-1], texts[-1])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc_id, text, after in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            yield _report([doc_id], [text], [after])


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, both fingerprints, near_edited, near_next.

    The next document is the one before it by identifier, and the greatest
    after the smallest; rows without identifier come last, and ties are ordered
    by a hash of their texts, then by the texts.  A table of one row is its own
    next.  One range-partitioned sort puts neighbours together; only a
    partition's first and last text (two a partition) meet in a second step.

    A null text counts as empty; an empty text has a fingerprint without slots,
    like itself by 1 and like any other by 0.  Rows that repeat are reported
    each.  Other columns are ignored; an empty table gives an empty result.
    Texts are walked whole, about 1 MB or one longer text at a time.
    """
    spark = docs.sparkSession
    ship(spark)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("hash")]
    dealt = slim.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order, "text").select("doc_id", "text")
    rows = materialize(dealt.mapInArrow(_ordered, _DDL), "fingerprints")
    sides = rows.filter("side is not null")
    # one row for each partition that has rows: which partition follows it, the first after the last
    parts = sides.filter("side = 'first'").select("part")
    follows = parts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())).alias("after"))
    first = sides.filter("side = 'first'").select(F.col("part").alias("after"), F.col("text").alias("next_text"))
    last = sides.filter("side = 'last'").select("part", "doc_id", "text").join(follows, "part").join(first, "after")
    out = rows.filter("side is null").unionByName(last.select("doc_id", "text", "next_text").mapInArrow(_met, _DDL))
    return out.select("doc_id", "n_chars", F.lower(F.hex("edited_sha")).alias("edited_sha256"), _spell("own").alias("fingerprint"), _spell("edit").alias("edited_fingerprint"), "near_edited", "near_next")


def _spell(column: str):
    """As :func:`shown`, in the JVM: of a sampled byte only the low digit."""
    head = F.lower(F.hex(F.substring(column, 1, 5)))
    rest = F.regexp_replace(F.lower(F.hex(F.substring(column, 6, 1 << 30))), "0(.)", "$1")
    return F.concat(head, rest)


def fingerprint_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint (binary) of every row; nothing is shuffled."""
    ship(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            held = np.cumsum([len(t) for t in texts]) // CALL_BYTES
            for k in np.unique(held):
                some = np.flatnonzero(held == k)
                prints = fingerprints([points(texts[i]) for i in some])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some)), pa.array(prints, pa.binary())], names=["doc_id", "fingerprint"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(work, "doc_id long, fingerprint binary")


def bands(x: bytes) -> list[bytes]:
    """The bands of a fingerprint on its own level and on the next, which texts twice as long may share.

    A band is ``BAND`` sampled digits that begin at a multiple of ``BAND`` in
    the level's sample; a text with fewer digits is one band.
    """
    own = np.frombuffer(x, np.uint8, offset=5)
    slots = _SAMPLE.of(int.from_bytes(x[1:5], "big"), x[0])
    out = []
    for level, digits in ((x[0], own), (x[0] + 1, own[_SAMPLE.zeros[slots] >= x[0] + 1])):
        if len(digits) < BAND:
            out.append(bytes([level, 255]) + digits.tobytes())
        out += [bytes([level]) + k.to_bytes(2, "big") + digits[k : k + BAND].tobytes() for k in range(0, len(digits) - BAND + 1, BAND)]
    return out


def near_documents(docs: DataFrame, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, near_id, likeness: documents held against the smallest identifier that shares a band with them.

    A band brings its members to one of them, not to each other, so the pairs
    stay as many as the bands; those whose whole fingerprints are less alike
    than ``least`` are left out.  Rows without identifier are left out; of rows
    with one identifier each is compared.
    """
    prints = materialize(fingerprint_texts(docs, id_col, text_col).filter("doc_id is not null"), "prints")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, b) for i, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for b in bands(x)]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int64()), pa.array([b for _, b in found], pa.binary())], names=["doc_id", "band"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            like = [likeness(a, b) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(like, pa.float64())], names=["doc_id", "near_id", "likeness"])

    members = prints.mapInArrow(cut, "doc_id long, band binary")
    # both written before they are joined, so that a band or a document with very many partners can be split
    centres = materialize(members.groupBy("band").agg(F.min("doc_id").alias("near_id"), F.max("doc_id").alias("last")).filter("last > near_id").select("band", "near_id"), "centres")
    pairs = materialize(members.join(centres, "band").filter("doc_id > near_id").select("doc_id", "near_id").distinct(), "near-pairs")
    with_own = pairs.join(prints, "doc_id")
    other = prints.select(F.col("doc_id").alias("near_id"), F.col("fingerprint").alias("near_print"))
    both = with_own.join(other, "near_id").select("doc_id", "near_id", "fingerprint", "near_print")
    return both.mapInArrow(verify, "doc_id long, near_id long, likeness double").filter(F.col("likeness") >= least).distinct()
