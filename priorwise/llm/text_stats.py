"""Counts over whole texts, worked out for a batch of texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .kernels import IS_SPACE, PLACES, U64, calls, code_points, mix, span_hashes, text_bytes, word_spans
from .scratch import ship

NEWLINE = 0x0A


def _mask(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_SYMBOLS = _mask("#*$%&|<>")
_UPPER = _mask("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _mask("0123456789")
_STOPS = _mask(".!?")
_MARKS = _mask("!?")
_PUNCTUATION = _mask("!\"'(),-./:;?@[\\]_`{}~")

#: The columns, all long.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_chars", "n_upper", "n_digits", "n_stops", "n_marks", "n_punctuation", "n_wide", "n_distinct_words", "n_long_words")


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur twice or more, and which repeat an earlier one."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(keys), bool)
    again[order[1:]] = same
    twice = again.copy()
    twice[order[:-1]] |= same
    return twice, again


def count_texts(column: pa.Array) -> dict[str, np.ndarray]:
    """Each of ``COUNTS`` for every text; nulls count as empty.

    word_chars: code points in words.  n_symbols: characters of #*$%&|<>.
    n_dup_lines: lines with a word that equal an earlier line.  n_repeat_words:
    words in 3-word windows found twice or more in the text, the first included.
    """
    raw, off = text_bytes(column)
    n = len(off) - 1
    starts, ends, first = word_spans(raw, off)

    def per_text(marks: np.ndarray, bounds: np.ndarray = off) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        return total[bounds[1:]] - total[bounds[:-1]]

    whole = code_points(raw)
    word_text = np.repeat(np.arange(n), np.diff(first))
    hashes = span_hashes(raw, starts, ends)
    salt = mix(np.arange(n, dtype=U64) * PLACES[61])
    out = {
        "n_words": np.diff(first),
        "word_chars": per_text(whole & ~IS_SPACE[raw]),
        "n_symbols": per_text(_SYMBOLS[raw]),
        "n_chars": per_text(whole),
        "n_upper": per_text(_UPPER[raw]),
        "n_digits": per_text(_DIGIT[raw]),
        "n_stops": per_text(_STOPS[raw]),
        "n_marks": per_text(_MARKS[raw]),
        "n_punctuation": per_text(_PUNCTUATION[raw]),
        "n_wide": per_text(whole & (raw >= 0x80)),
        "n_long_words": per_text(ends - starts > 12, first),
    }
    # three-word windows inside one text
    m = max(0, len(hashes) - 2)
    inside = word_text[:m] == word_text[2:] if m else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    windows = mix(hashes[at] * PLACES[0] + hashes[at + 1] * PLACES[1] + hashes[at + 2] * PLACES[2] + salt[word_text[at]])
    twice, _ = _repeated(windows)
    cover = np.zeros(len(hashes) + 3, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + 3, -1)
    out["n_repeat_words"] = per_text(np.cumsum(cover)[: len(hashes)] > 0, first)
    _, again = _repeated(hashes + salt[word_text])
    out["n_distinct_words"] = out["n_words"] - per_text(again, first)
    # lines with a word
    breaks = np.flatnonzero(raw == NEWLINE)
    line_starts = np.unique(np.concatenate([off[:-1][np.diff(off) > 0], breaks + 1]))
    line_starts = line_starts[line_starts < len(raw)]
    line_ends = np.append(line_starts[1:], len(raw)) if len(line_starts) else line_starts
    # a line ends before its line break
    line_ends = line_ends - ((line_ends > line_starts) & (raw[line_ends - 1] == NEWLINE)) if len(line_ends) else line_ends
    with_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends = line_starts[with_word], line_ends[with_word]
    line_text = np.searchsorted(off, line_starts, "right") - 1
    _, again = _repeated(span_hashes(raw, line_starts, line_ends, skip_space=False) + salt[line_text])
    out["n_dup_lines"] = np.bincount(line_text[again], minlength=n)
    out["n_lines"] = np.bincount(line_text, minlength=n)
    return {name: out[name].astype(np.int64) for name in COUNTS}


def text_counts(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` (other columns of ``docs``) and ``COUNTS`` of every whole text."""
    ship(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in calls(batches, "__text"):
            counted = count_texts(batch.column("__text"))
            columns = {c: batch.column(c) for c in keep} | {k: pa.array(v) for k, v in counted.items()}
            yield pa.RecordBatch.from_pydict(columns)

    kinds = dict(docs.dtypes)
    ddl = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [f"{c} long" for c in COUNTS])
    from pyspark.sql import functions as F

    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("__text")).mapInArrow(work, ddl)
