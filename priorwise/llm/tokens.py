"""Encoding whole texts with a public tokenizer, each distinct word of a stretch of texts once.

The vocabulary drops white space and encodes what stands between it piece by
piece, so a text's ids are those of its words in order.  Texts are taken in
stretches of about ``CALL_BYTES``: their distinct words are cut into pieces and
the pieces merged all together, and every text takes its words' ids from there.
Nothing is kept from one stretch to the next but words that need the
tokenizer's own rules.  Ids are little-endian unsigned 32-bit.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

#: How the vocabulary cuts words into pieces, and prepares text before.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = {"type": "Split", "pattern": {"Regex": _CUT}, "behavior": "Removed", "invert": True}
_ENCODERS: dict[str, "WordEncoder"] = {}
#: Bytes of text that are encoded together, unless a single text is longer.
CALL_BYTES = 1 << 21
#: Code points below have tables here: they compose with nothing below, so NFC leaves them.
_TABLED = 0x250
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
#: Bytes of the longest piece that is merged in arrays; longer ones go to the tokenizer's model.
_LONGEST = 48
_NONE = np.int32(1 << 30)
#: Pieces that are merged together, so that their arrays stay in a core's cache.
_TOGETHER = 1 << 14


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write a byte as itself where it prints, else as a letter from 256 on."""
    plain = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
    others = [b for b in range(256) if b not in plain]
    return {b: 256 + k for k, b in enumerate(others)} | {b: b for b in plain}


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each tabled code point: lower case, class in lower case, whether its lower case is as long in UTF-8."""
    lower, kind, simple = np.zeros(_TABLED, np.uint32), np.zeros(_TABLED, np.int8), np.zeros(_TABLED, bool)
    for c in range(_TABLED):
        low = chr(c).lower()
        lower[c], simple[c] = ord(low[0]), len(low) == 1 and len(low.encode()) == len(chr(c).encode())
        kind[c] = _LETTER if regex.match(r"\p{L}", low) else _NUMBER if regex.match(r"\p{N}", low) else _SPACE if regex.match(r"\s", low) else _OTHER
    return lower, kind, simple


class _Merges:
    """The vocabulary's merges as a table of pairs, for many pieces at once.

    Of a piece's adjacent pairs the one of the least rank is merged, the first
    of equal ones, until no pair has a rank.
    """

    def __init__(self, vocab: dict[str, int], merges: list, end: str) -> None:
        letters = _byte_letters()
        self.inner = np.array([vocab[chr(letters[b])] for b in range(256)], np.int32)
        self.last = np.array([vocab[chr(letters[b]) + end] for b in range(256)], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        keys = self._keys(np.array([vocab[a] for a, _ in pairs]), np.array([vocab[b] for _, b in pairs]))
        # open addressing; a slot holds the pair above and its rank below
        self.bits = 20
        self.slots = np.full((1 << self.bits) + 4096, np.uint64(2**64 - 1))
        wait, at = np.arange(len(keys)), self._at(keys)
        while len(wait):
            free = wait[self.slots[at[wait]] == np.uint64(2**64 - 1)]
            free = free[np.unique(at[free], return_index=True)[1]]
            self.slots[at[free]] = keys[free] << np.uint64(32) | free.astype(np.uint64)
            wait = np.setdiff1d(wait, free)
            at[wait] += 1

    @staticmethod
    def _keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.uint64) << np.uint64(16) | right.astype(np.uint64)

    def _at(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or ``_NONE``."""
        keys = self._keys(left, right)
        at = self._at(keys)
        found = self.slots[at]
        same = found >> np.uint64(32) == keys
        out = np.where(same, (found & np.uint64(0xFFFFFFFF)).astype(np.int32), _NONE)
        wait = np.flatnonzero(~same & (found != np.uint64(2**64 - 1)))
        while len(wait):
            at[wait] += 1
            found = self.slots[at[wait]]
            same = found >> np.uint64(32) == keys[wait]
            out[wait[same]] = (found[same] & np.uint64(0xFFFFFFFF)).astype(np.int32)
            wait = wait[~same & (found != np.uint64(2**64 - 1))]
        return out

    def run(self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """How many ids each piece has, and for pieces with as many ids, in turn, the pieces and a row for each place."""
        counts, out = np.zeros(len(sizes), np.int64), []
        order = np.argsort(sizes, kind="stable")
        for k in range(0, len(order), _TOGETHER):
            for pieces, rows in self._block(symbols, starts, sizes, order[k : k + _TOGETHER]):
                counts[pieces] = len(rows)
                out.append((pieces, rows))
        return counts, out

    def _block(self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        most = int(sizes[order[-1]])
        bounds = np.searchsorted(sizes[order], np.arange(most + 2))
        own = np.zeros(0, np.int64)
        # a column is a piece; a pair's key is its rank, then its place, so the least key is the pair to merge
        held, keys = np.zeros((most, 0), np.int32), np.zeros((most - 1, 0), np.int32)
        for n in range(most, 0, -1):
            more = order[bounds[n] : bounds[n + 1]]
            if len(more):
                fresh = symbols[starts[more] + np.arange(n)[:, None]]
                place = np.broadcast_to(np.arange(n - 1, dtype=np.int32)[:, None], (n - 1, len(more)))
                own, held, keys = np.append(own, more), np.concatenate([held, fresh], 1), np.concatenate([keys, self._key(fresh[:-1].ravel(), fresh[1:].ravel(), place.ravel()).reshape(place.shape)], 1)
            least = keys.min(0) if n > 1 else np.full(len(own), _NONE)
            ended = least >= _NONE >> 1
            if ended.any():
                yield own[ended], held[:, ended]
                going = ~ended
                own, held, keys, least = own[going], held[:, going], keys[:, going], least[going]
            if n == 1:
                break
            at, rank = least & 63, least >> 6
            column, place = np.arange(len(own)), np.arange(n - 1, dtype=np.int32)[:, None]
            held = np.where(place <= at, held[:-1], held[1:])
            held[at, column] = self.made[rank]
            keys = np.where(place[:-1] < at, keys[:-1], keys[1:] - 1)
            for first in (at - 1, at):
                has = np.flatnonzero((first >= 0) & (first < n - 2))
                f = first[has]
                keys[f, has] = self._key(held[f, has], held[f + 1, has], f)

    def _key(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        rank = self.ranks(left, right)
        return np.where(rank == _NONE, _NONE, (rank << 6) + place)


def stretches(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in slices of about ``CALL_BYTES``."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CALL_BYTES, "right")))
        yield texts.slice(at, to - at)
        at = to


class WordEncoder:
    """ids(texts) for byte-level vocabularies of the kind "BPE with word ends".

    ``most`` bounds the words that need the tokenizer's own rules and are
    remembered; a full memo starts anew.  A vocabulary that prepares or cuts
    text in another way is refused, as its ids would be wrong.
    """

    def __init__(self, path: str, most: int = 300_000) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        cuts = (rules["pre_tokenizer"] or {}).get("pretokenizers", [])
        if (rules["normalizer"] or {}).get("normalizers") != _NORMALIZERS or cuts[:1] != [_SPLIT] or [c["type"] for c in cuts[1:]] != ["ByteLevel"] or cuts[1]["use_regex"] or cuts[1]["add_prefix_space"]:
            raise ValueError(f"{path} prepares or cuts text in a way that this encoder does not know")
        model = rules["model"]
        if model["type"] != "BPE" or model["dropout"] or model["continuing_subword_prefix"] or model["ignore_merges"] or max(len(model["merges"]), *model["vocab"].values()) >= 1 << 16:
            raise ValueError(f"{path} merges in a way that this encoder does not know")
        self.merges = _Merges(model["vocab"], model["merges"], model["end_of_word_suffix"] or "")
        self.lower, self.kind, self.simple = _tables()
        self.most = most
        self.words: dict[str, bytes] = {}

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, 4 bytes each; a null text has none."""
        return [ids for part in stretches(pa.array(texts, pa.large_string())) for ids in self._stretch(part)]

    def _stretch(self, texts: pa.Array) -> list[bytes]:
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = lists.flatten().dictionary_encode()
        each = self._each(coded.dictionary).take(coded.indices)
        ends = np.frombuffer(each.buffers()[1], np.int64)[each.offset : each.offset + len(each) + 1]
        data = memoryview(each.buffers()[2] or b"")
        cuts = ends[np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy()))].tolist()
        return [bytes(data[a:b]) for a, b in zip(cuts, cuts[1:])]

    def _each(self, words: pa.Array) -> pa.Array:
        """The ids of each of the words, which hold no ASCII white space."""
        if not len(words):
            return pa.array([], pa.large_binary())
        offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
        raw = bytes(words.buffers()[2] or b"")[offsets[0] : offsets[-1]]
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        before = np.append(0, np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))
        first = before[offsets - offsets[0]]
        sizes = np.diff(first)
        word = np.repeat(np.arange(len(words)), sizes)

        # letters whose case or form needs the tokenizer's own rules, and special strings
        own = np.zeros(len(words), bool)
        own[word[points >= _TABLED]] = True
        points = np.minimum(points, _TABLED - 1)
        own[word[~self.simple[points]]] = True
        own[word[:-1][(points[:-1] == ord("<")) & (points[1:] == ord("|")) & (word[:-1] == word[1:])]] = True
        low, kind = self.lower[points], self.kind[points]
        inside = (kind != _SPACE) & ~own[word]

        starts = np.ones(len(points), bool)
        starts[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER) | (word[1:] != word[:-1])
        # 's 't 'm 'd 're 've 'll, where an apostrophe begins a piece
        mark = np.flatnonzero(starts & (low == ord("'")))
        ahead = np.append(low, [0, 0])
        same = np.append(word, [-1, -1])
        one, two = np.where(same[mark + 1] == same[mark], ahead[mark + 1], 0), np.where(same[mark + 2] == same[mark], ahead[mark + 2], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        starts[mark[short | long] + 1] = False
        for behind in (mark[short] + 2, mark[long] + 3):
            starts[behind[behind < len(starts)]] = True
        starts &= inside

        begins = np.flatnonzero(starts)
        width = np.where(inside, 1 + (low >= 0x80), 0)
        done = np.append(0, np.cumsum(width))
        at = done[begins]
        length = np.diff(np.append(at, done[-1]))
        octets = np.frombuffer(low[inside].tobytes().decode("utf-32-le").encode(), np.uint8)
        symbols = self.merges.inner[octets]
        last = at + length - 1
        symbols[last] = self.merges.last[octets[last]]

        far = np.flatnonzero(length > _LONGEST)
        near = np.flatnonzero(length <= _LONGEST)
        counts = np.zeros(len(begins), np.int64)
        counts[near], found = self.merges.run(symbols, at[near], length[near])
        letters = _byte_letters() if len(far) else {}
        spelt = [self._model("".join([chr(letters[b]) for b in octets[at[k] : at[k] + length[k]].tolist()])) for k in far]
        counts[far] = [len(s) for s in spelt]
        to = np.cumsum(counts) - counts
        flat = np.empty(int(counts.sum()), "<u4")
        for pieces, rows in found:
            flat[to[near[pieces]] + np.arange(len(rows))[:, None]] = rows
        for k, s in zip(far, spelt, strict=True):
            flat[to[k] : to[k] + len(s)] = s

        total = np.bincount(word[begins], counts, len(words)).astype(np.int64)
        hard = np.flatnonzero(own)
        if not len(hard):
            ends, data = np.append(0, np.cumsum(total)) * 4, flat.tobytes()
        else:
            # words in order, those of the tokenizer's own rules between the stretches of others
            ids = [self._own(w) for w in words.take(pa.array(hard)).to_pylist()]
            into = (np.append(0, np.cumsum(total)) * 4)[hard].tolist()
            plain, parts, was = flat.tobytes(), [], 0
            for k, i in zip(into, ids, strict=True):
                parts += (plain[was:k], i)
                was = k
            data = b"".join([*parts, plain[was:]])
            total[hard] = [len(i) // 4 for i in ids]
            ends = np.append(0, np.cumsum(total)) * 4
        return pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data)])

    def _model(self, spelt: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(spelt)]

    def _own(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            if len(self.words) >= self.most:
                self.words.clear()
            ids = self.words[word] = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        return ids


def encoder(path: str | None = None) -> WordEncoder:
    """This worker's encoder for the vocabulary at ``path``."""
    path = path or default_path()
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
