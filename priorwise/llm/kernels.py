"""Vectorised text kernels: words, hashes, shingles and packed exchanges.

All work on UTF-8 bytes of an Arrow string column.  A word is a maximal run of
bytes outside 0x20 and 0x09-0x0D; as these are ASCII, splitting bytes splits
code points too.  Hashes are 64 bits wide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_LOWER = _BYTE.copy()
_LOWER[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_BYTE_KEYS = {False: np.where(IS_SPACE, U64(0), _BYTE), True: np.where(IS_SPACE, U64(0), _LOWER)}
_STEP = U64(0x9E3779B97F4A7C15) | U64(1)
#: Multipliers of the words of a shingle, by place.
PLACES = _rng.integers(1, 2**63, 64, dtype=np.uint64) * U64(2) + U64(1)
#: Bytes that one kernel call takes at most, unless a single text is longer.
CALL_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, nulls as empty, and ``len + 1`` offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return raw, off - off[0] if len(off) else np.zeros(1, np.int64)


def calls(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``CALL_BYTES`` of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = text_bytes(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + CALL_BYTES, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and each text's first word (n + 1)."""
    n = len(raw)
    inside = np.zeros(n + 1, dtype=bool)
    np.logical_not(IS_SPACE[raw], out=inside[:n])
    first = inside[:n].copy()
    first[1:] &= ~inside[: n - 1]
    cuts = off[1:-1]
    cuts = cuts[cuts < n]
    first[cuts] |= inside[cuts]
    last = inside[:n] & ~inside[1:]
    before = cuts[cuts > 0] - 1
    last[before] |= inside[before]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False, skip_space: bool = True) -> np.ndarray:
    """A hash of each of the disjoint, ordered, non-empty byte spans."""
    if not len(starts):
        return np.zeros(0, U64)
    base = int(starts[0])
    part = raw[base : int(ends[-1])]
    keys = (_BYTE_KEYS[lower] if skip_space else _BYTE)[part]
    sizes = ends - starts
    powers = np.cumprod(np.full(int(np.diff(np.append(starts, ends[-1])).max()), _STEP, dtype=U64))
    place = np.arange(len(part)) - np.repeat(starts - base, np.diff(np.append(starts, ends[-1])))
    keys *= powers[place]
    if not skip_space:
        keys[place >= np.repeat(sizes, np.diff(np.append(starts, ends[-1])))] = 0
    return mix(np.add.reduceat(keys, starts - base) + sizes.astype(U64) * PLACES[63])


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` consecutive words, texts not minded."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, U64)
    for k in range(width):
        out += words[k : k + n] * PLACES[k]
    return mix(out)


def sequence_hashes(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each text's whole word sequence; ``first`` as of word_spans."""
    counts = np.diff(first)
    out = np.zeros(len(counts), U64)
    full = np.flatnonzero(counts)
    if len(full):
        powers = np.cumprod(np.full(int(counts.max()), _STEP, dtype=U64))
        place = np.arange(len(words)) - np.repeat(first[:-1], counts)
        out[full] = np.add.reduceat(words * powers[place], first[:-1][full])
    return mix(out + counts.astype(U64) * PLACES[62])


def code_points(raw: np.ndarray) -> np.ndarray:
    """True at each byte that begins a code point."""
    return (raw & 0xC0) != 0x80


def pack_keys(values: np.ndarray) -> bytes:
    """Sorted unsigned integers as byte planes of their differences.

    Planes that are all zero at the high end are left out; what zeros remain
    the exchange's compression removes.  The first difference counts from 0.
    """
    steps = np.diff(values, prepend=U64(0)).astype("<u8")
    planes = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    return bytes([planes]) + steps.view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()


def unpack_keys(blob: bytes) -> np.ndarray:
    planes = blob[0]
    steps = np.zeros((((len(blob) - 1) // planes), 8), np.uint8)
    steps[:, :planes] = np.frombuffer(blob, np.uint8, offset=1).reshape(planes, -1).T
    return np.cumsum(steps.view("<u8").ravel(), dtype=U64)


def pack_small(values: np.ndarray) -> bytes:
    """Unsigned integers below 2^32 as byte planes, zero planes left out."""
    values = values.astype("<u4")
    planes = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return values.view(np.uint8).reshape(-1, 4)[:, :planes].T.tobytes()


def unpack_small(blob: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 4), np.uint8)
    if n:
        planes = len(blob) // n
        out[:, :planes] = np.frombuffer(blob, np.uint8).reshape(planes, n).T
    return out.view("<u4").ravel().astype(np.int64)


def slices(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted keys: the non-empty buckets by the top ``bits`` and their bounds."""
    top = (keys >> U64(64 - bits)).astype(np.int64)
    at = np.flatnonzero(np.diff(top, prepend=-1))
    return top[at], np.append(at, len(keys))


def bucket_bits(total: float, each: float = 2e6, least: int = 8, most: int = 24) -> int:
    """Bits so that 2^bits buckets hold about ``each`` of ``total`` entries."""
    return int(min(most, max(least, np.ceil(np.log2(max(1.0, total / each))))))
