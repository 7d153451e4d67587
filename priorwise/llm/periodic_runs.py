"""Periodic runs of words: stretches that repeat a block four times or more.

Words become integers (equal words, equal integers), and the texts of a batch
one sequence in which a separator of its own ends each text.  A run of period q
and length 4q or more keeps words q apart identical over a stretch of 3q places
or more, so that stretch holds a multiple of 3q.  For each period the multiples
of 3q of a text are asked how far the sequence agrees with itself q places on,
backwards and forwards (their number is harmonic: n/3 * (1 + 1/2 + 1/3 ...)).

How far two places agree is the length of a longest common extension (LCE).
Most places differ within a few words, which are compared.  Two places that
agree for longer reach, within fewer than 21 words, a pair of places that both
lie on a difference cover modulo 21; only suffixes that begin on the cover are
sorted (by doubling: a cover place and the place 21 on are of one residue), and
the minimum of the lengths between neighbours, by a sparse table, is the LCE.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .kernels import calls, text_bytes
from .scratch import ship

#: A perfect difference cover: every difference modulo 21 is one of two members.
MODULUS, COVER = 21, (0, 1, 4, 14, 16)
#: A run repeats its block so many times at least, and has so many words.
LEAST_EXPONENT, LEAST_LENGTH = 4, 6
#: Places asked at a time.
ASKED = 1 << 21


def _shifts() -> np.ndarray:
    """For residues a, b the least shift that puts both on the cover."""
    out = np.zeros((MODULUS, MODULUS), np.int64)
    for a in range(MODULUS):
        for b in range(MODULUS):
            out[a, b] = min(d for d in range(MODULUS) if (a + d) % MODULUS in COVER and (b + d) % MODULUS in COVER)
    return out


_SHIFTS = _shifts()


def _agree(seq: np.ndarray, i: np.ndarray, j: np.ndarray, most: int, step: int = 1) -> np.ndarray:
    """How many words agree from i and j on (or before them), up to ``most``."""
    out = np.zeros(len(i), np.int64)
    live = np.arange(len(i))
    for k in range(most):
        at = k if step > 0 else -k - 1
        live = live[seq[i[live] + at] == seq[j[live] + at]]
        if not len(live):
            break
        out[live] += 1
    return out


class CoverLce:
    """Longest common extensions of places before the same separator."""

    def __init__(self, seq: np.ndarray) -> None:
        n = len(seq)
        self.seq = np.concatenate([seq, np.full(2 * MODULUS, seq.max(initial=0) + 1, seq.dtype)])
        places = np.concatenate([np.arange(r, n, MODULUS) for r in COVER]) if n else np.zeros(0, np.int64)
        places.sort()
        self.at = np.full(n + 1, -1, np.int64)
        self.at[places] = np.arange(len(places))
        # blocks of 21 words, ranked in the order of their words
        blocks = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(self.seq, MODULUS)[places].astype(">u4"))
        _, rank = np.unique(blocks.view(np.dtype((np.void, 4 * MODULUS))).ravel(), return_inverse=True)
        levels, width = [rank.ravel()], MODULUS
        while len(places) and levels[-1].max() + 1 < len(places):
            _, rank = np.unique(levels[-1] * (len(places) + 1) + self._of(levels[-1], places + width) + 1, return_inverse=True)
            levels.append(rank.ravel())
            width *= 2
        self.rank = levels[-1]
        order = np.argsort(self.rank)
        self.table = self._minima(self._neighbours(levels, places[order]))

    def _of(self, rank: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The ranks of cover places, -1 beyond the end."""
        at = self.at[np.minimum(places, len(self.at) - 1)]
        return np.where(at < 0, -1, rank[at])

    def _neighbours(self, levels: list[np.ndarray], places: np.ndarray) -> np.ndarray:
        """How many words each sorted suffix shares with the next."""
        a, b = places[:-1].copy(), places[1:].copy()
        for k in range(len(levels) - 1, -1, -1):
            same = self._of(levels[k], a)
            same = (same >= 0) & (same == self._of(levels[k], b))
            a[same] += MODULUS << k
            b[same] += MODULUS << k
        return a - places[:-1] + _agree(self.seq, a, b, MODULUS)

    @staticmethod
    def _minima(row: np.ndarray) -> list[np.ndarray]:
        out = [row]
        while len(out[-1]) > 1 << (len(out) - 1):
            half = 1 << (len(out) - 1)
            out.append(np.minimum(out[-1][:-half], out[-1][half:]))
        return out

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """LCE of places i <> j that agree in their first 21 words."""
        shift = _SHIFTS[i % MODULUS, j % MODULUS]
        x, y = self.rank[self.at[i + shift]], self.rank[self.at[j + shift]]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp(high - low)[1] - 1
        out = np.zeros(len(i), np.int64)
        for k in np.unique(level):
            some = level == k
            row = self.table[k]
            out[some] = np.minimum(row[low[some]], row[high[some] - (1 << k)])
        return out + shift


def _grid(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """text, place in it and period of what is to be asked, some at a time."""
    most = np.where(sizes >= LEAST_LENGTH, sizes // LEAST_EXPONENT, 0)
    text = np.repeat(np.arange(len(sizes)), most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    step = (LEAST_EXPONENT - 1) * period
    count = (sizes[text] - period + step - 1) // step
    upto = np.cumsum(count)
    at = 0
    while at < len(text):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + ASKED, "right")))
        some = count[at:to]
        k = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
        yield np.repeat(text[at:to], some), k * np.repeat(step[at:to], some), np.repeat(period[at:to], some)
        at = to


def find_runs(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """text, start, length and period of every run, by text, start and period.

    ``words`` are the integers of all texts' words, ``first`` (n + 1) where each
    text begins.
    """
    sizes = np.diff(first)
    n = len(sizes)
    base = first[:-1] + np.arange(n) + 1  # a separator stands before and after each text
    seq = np.empty(len(words) + n + 1, np.int64)
    seq[np.append(base - 1, len(seq) - 1)] = np.arange(n + 1)
    seq[np.arange(len(words)) + np.repeat(np.arange(n), sizes) + 1] = words + n + 1
    found = []
    for text, place, period in _grid(sizes):
        i = base[text] + place
        same = seq[i] == seq[i + period]
        text, i, period = text[same], i[same], period[same]
        found.append(np.stack([text, i, period, _agree(seq, i, i + period, MODULUS), _agree(seq, i, i + period, MODULUS, -1)]))
    text, i, period, after, before = np.concatenate(found, axis=1) if found else np.zeros((5, 0), np.int64)
    # longer ones go by the samples, sorted for the texts that have any
    for back in (False, True):
        length = before if back else after
        deep = np.flatnonzero(length == MODULUS)
        if not len(deep):
            continue
        asked, which = np.unique(text[deep], return_inverse=True)
        own, start = _cut(seq, base[asked] - 1, base[asked] + sizes[asked] + 1)
        here = i[deep] - base[text[deep]] + 1 + start[which]
        if back:
            length[deep] = CoverLce(own[::-1].copy())(len(own) - here, len(own) - here - period[deep])
        else:
            length[deep] = CoverLce(own)(here, here + period[deep])
    start, size = i - before - base[text], before + after + period
    runs = (size >= LEAST_LENGTH) & (size >= LEAST_EXPONENT * period)
    text, start, size, period = text[runs], start[runs], size[runs], period[runs]
    # of one stretch the smallest period; others are its multiples
    order = np.lexsort((period, size, start, text))
    text, start, size, period = text[order], start[order], size[order], period[order]
    new = np.ones(len(text), bool)
    new[1:] = (np.diff(text) != 0) | (np.diff(start) != 0) | (np.diff(size) != 0)
    text, start, size, period = text[new], start[new], size[new], period[new]
    order = np.lexsort((period, start, text))
    return text[order], start[order], size[order], period[order]


def _cut(seq: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces [low, high) one after another, and where each begins."""
    sizes = high - low
    start = np.cumsum(sizes) - sizes
    at = np.arange(sizes.sum()) - np.repeat(start - low, sizes)
    return np.unique(seq[at], return_inverse=True)[1].ravel(), start


def planted(doc_id: int | None, n: int) -> list[int] | None:
    """Which original word stands at each place of a text of n words; None: its own.

    With h the CRC-32 of the identifier in decimal, texts of h % 10 = 0 repeat a
    block from a place on, both drawn by h.
    """
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or n == 0 or h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [*range(a), *(a + k % p for k in range(n - a))]


def run_report(ids: list[int | None], texts: list[bytes], plant: bool) -> dict[str, list]:
    """The columns of :func:`collapse_runs` for a batch of texts."""
    split = []
    for doc_id, text in zip(ids, texts, strict=True):
        own = text.split()  # of bytes: at 0x20 and 0x09-0x0D
        at = planted(doc_id, len(own)) if plant else None
        split.append(own if at is None else [own[k] for k in at])
    first = np.concatenate([[0], np.cumsum([len(w) for w in split], dtype=np.int64)])
    flat = [w for own in split for w in own]
    words = pa.array(flat, pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    text, start, size, period = find_runs(words, first)
    bounds = np.searchsorted(text, np.arange(len(split) + 1))
    # a run's first block stays
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, first[text] + start + period, 1)
    np.add.at(cover, first[text] + start + size, -1)
    dropped = np.cumsum(cover) > 0
    # the greatest exponent of each text, then the smallest start, then period
    order = np.lexsort((period, start, -(size / period), text))
    best = order[np.minimum(np.searchsorted(text[order], np.arange(len(split))), len(order) - 1)] if len(text) else np.zeros(len(split), np.int64)
    out: dict[str, list] = {k: [] for k in ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")}
    for k, own in enumerate(split):
        a, b = int(bounds[k]), int(bounds[k + 1])
        r = int(best[k]) if b > a else None
        out["n_runs"].append(b - a)
        out["start"].append(None if r is None else int(start[r]))
        out["length"].append(None if r is None else int(size[r]))
        out["period"].append(None if r is None else int(period[r]))
        out["exponent_milli"].append(None if r is None else 1000 * int(size[r]) // int(period[r]))
        listed = "".join(f"{s},{z},{q}\n" for s, z, q in zip(start[a:b], size[a:b], period[a:b], strict=True))
        out["runs_sha256"].append(hashlib.sha256(listed.encode()).hexdigest())
        kept = [own[i] for i in np.flatnonzero(~dropped[first[k] : first[k + 1]])] if b > a else own
        out["collapsed_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


_SCHEMA = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_runs", "start", "length", "period", "exponent_milli")], ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])


def collapse_runs(docs: DataFrame, plant: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_runs, the run with the greatest exponent, digests.

    A run is a stretch of words with smallest period q and a length of at least
    6 and 4q that neither neighbour extends.  start, length, period and
    exponent_milli are those of the run with the greatest length / period (then
    smallest start, then period) and null without one.  runs_sha256 is of every
    run, collapsed_sha256 of the words left when each run keeps its first q.
    ``plant`` repeats a block in texts chosen by the identifier first.

    A null text counts as empty and has no run; a row without identifier is
    never chosen for planting.  Rows that repeat are reported each; other
    columns are ignored; an empty table gives an empty result.  A text is
    worked on whole: about 200 bytes a word of the longest text are held.
    """
    ship(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in calls(batches):
            raw, off = text_bytes(batch.column("text"))
            whole = raw.tobytes()
            ids = batch.column("doc_id").to_pylist()
            got = run_report(ids, [whole[a:b] for a, b in zip(off[:-1], off[1:], strict=True)], plant)
            yield pa.RecordBatch.from_pydict({"doc_id": ids, **got}, schema=_SCHEMA)

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(work, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")
