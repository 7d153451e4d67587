"""MD5 of very many short texts at once."""

from __future__ import annotations

import hashlib
import math

import numpy as np

_ADD = [int(abs(math.sin(k + 1)) * 2**32) for k in range(64)]
_TURN = [s for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in four * 4]
_WORD = [*range(16), *((5 * k + 1) % 16 for k in range(16)), *((3 * k + 5) % 16 for k in range(16)), *(7 * k % 16 for k in range(16))]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
#: Bytes of a text that is one block of the digest.
ONE_BLOCK = 55


def numbered(head: bytes, start: int, stop: int) -> np.ndarray:
    """The first six bytes, as a number, of the MD5 of ``head`` and i in decimals, for i from ``start`` up to ``stop``."""
    if len(head) + len(str(stop)) > ONE_BLOCK:
        begun = hashlib.md5(head)
        out = np.empty(stop - start, "uint64")
        for k in range(len(out)):
            one = begun.copy()
            one.update(b"%d" % (start + k))
            out[k] = int.from_bytes(one.digest()[:6], "big")
        return out
    parts = [np.empty(0, "uint64")]
    while start < stop:
        # numbers that agree but for their last four digits, or have as many digits
        top = start // 10_000
        end = min(stop, (top + 1) * 10_000 if top else 10 ** len(str(start)))
        parts.append(_run(head + (b"%d" % top if top else b""), min(4, len(str(start))), start % 10_000, end - start))
        start = end
    return np.concatenate(parts)


def _run(fixed: bytes, digits: int, first: int, n: int) -> np.ndarray:
    size = len(fixed) + digits
    block = (fixed + bytes(digits) + b"\x80").ljust(56, b"\0") + (8 * size).to_bytes(8, "little")
    words = [int(w) for w in np.frombuffer(block, "<u4")]
    values = np.arange(first, first + n, dtype="uint32")
    for k in range(digits):
        at = len(fixed) + k
        digit = values // np.uint32(10 ** (digits - 1 - k)) % np.uint32(10) + np.uint32(48)
        words[at // 4] = (digit << np.uint32(8 * (at % 4))) + np.uint32(words[at // 4]) if isinstance(words[at // 4], int) else words[at // 4] + (digit << np.uint32(8 * (at % 4)))
    a, b, c, d = (np.full(n, x, "uint32") for x in _START)
    f, turned = np.empty(n, "uint32"), np.empty(n, "uint32")
    for k in range(64):
        if k < 16:  # (b & c) | (~b & d)
            np.bitwise_xor(c, d, out=f)
            np.bitwise_and(f, b, out=f)
            np.bitwise_xor(f, d, out=f)
        elif k < 32:  # (b & d) | (c & ~d)
            np.bitwise_xor(b, c, out=f)
            np.bitwise_and(f, d, out=f)
            np.bitwise_xor(f, c, out=f)
        elif k < 48:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
        else:  # c ^ (b | ~d)
            np.invert(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
        np.add(f, a, out=f)
        word, more = words[_WORD[k]], _ADD[k]
        if isinstance(word, int):
            more = (more + word) % 2**32
        else:
            np.add(f, word, out=f)
        np.add(f, np.uint32(more), out=f)
        np.left_shift(f, np.uint32(_TURN[k]), out=turned)
        np.right_shift(f, np.uint32(32 - _TURN[k]), out=f)
        np.bitwise_or(f, turned, out=f)
        np.add(f, b, out=f)
        a, d, c, b, f = d, c, b, f, a
    high = (a + np.uint32(_START[0])).byteswap().astype("uint64")
    return (high << np.uint64(16)) | ((b + np.uint32(_START[1])).byteswap() >> np.uint32(16))
