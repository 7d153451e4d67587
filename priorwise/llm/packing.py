"""Vector bin packing of token sequences.

Examples have three sizes: tokens, segments (always one) and loss-bearing
tokens.  A sequence has a limit on each.  Within a block of examples one
sequence at a time is filled: of the examples that still fit, the one with the
greatest dot product of its sizes and the room left, both as shares of the
limits, goes next.  Examples of equal sizes are alike, so the choice runs over
distinct sizes only.

A document's first line is its prompt when words follow it; otherwise its first
token is.  Prompt tokens bear no loss.  By default a sequence takes loss on at
most 127/128 of its length, so a sequence needs some prompt tokens to be full,
and texts without a prompt go with others that have one.

A block is a bounded stretch of one task's rows, so nothing is shuffled and no
group meets in one place.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .scratch import ship
from .tokens import encoder, stretches

END_ID = 1
#: More loss than any room, for sizes of which no example is left.
_NEVER = 1 << 62


def dot_product_fill(tokens: np.ndarray, loss: np.ndarray, limits: tuple[int, int, int]) -> list[np.ndarray]:
    """Positions of the examples of each sequence, in the order placed.

    Every example must fit an empty sequence.  Ties go to more tokens, then
    more loss-bearing tokens, then the earlier example.
    """
    if not len(tokens):
        return []
    if tokens.max() > limits[0] or loss.max() > limits[2] or limits[1] < 1:
        raise ValueError("an example does not fit an empty sequence")
    sizes = np.stack([tokens, loss], 1)
    kinds, kind_of = np.unique(sizes, axis=0, return_inverse=True)
    order = np.argsort(kind_of.ravel(), kind="stable")
    nexts = np.searchsorted(kind_of.ravel()[order], np.arange(len(kinds) + 1))
    at, ends = nexts[:-1].copy(), nexts[1:]
    # kinds stand in ascending order of tokens; live ones are kept compact
    live, size, bears = np.arange(len(kinds)), kinds[:, 0].copy(), kinds[:, 1].copy()
    most_loss = np.maximum.accumulate(bears)
    gone = 0
    out: list[np.ndarray] = []
    left = len(tokens)
    while left:
        room = list(map(float, limits))
        placed: list[int] = []
        while room[1] >= 1:
            by_size, by_loss = room[0] / limits[0] ** 2, room[2] / limits[2] ** 2
            to, step, best, top = int(size.searchsorted(room[0], "right")), 32, -1, -1.0
            # from the largest down, until what is left cannot exceed the best
            while to and size[to - 1] * by_size + most_loss[to - 1] * by_loss > top:
                at_least = max(0, to - step)
                score = size[at_least:to] * by_size + bears[at_least:to] * by_loss
                score[bears[at_least:to] > room[2]] = -1.0
                k = len(score) - 1 - int(score[::-1].argmax())
                if score[k] > top:
                    best, top = at_least + k, score[k]
                to, step = at_least, step * 2
            if best < 0:
                break
            k = live[best]
            placed.append(int(order[at[k]]))
            at[k] += 1
            room[0], room[1], room[2] = room[0] - size[best], room[1] - 1, room[2] - kinds[k, 1]
            if at[k] == ends[k]:
                bears[best], gone = _NEVER, gone + 1
                if gone == 64:
                    keep = bears < _NEVER
                    live, size, bears, gone = live[keep], size[keep], bears[keep], 0
                    most_loss = np.maximum.accumulate(bears)
        out.append(np.array(placed))
        left -= len(placed)
    return out


def pack_documents(
    docs: DataFrame,
    length: int = 2048,
    max_segments: int = 256,
    max_loss: int | None = None,
    vocabulary: str | None = None,
    block_tokens: int = 8_000_000,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The pieces of all documents, packed into sequences of at most ``length`` tokens.

    A document is its ids and the closing id 1; a null text is empty, so it is
    the closing id alone.  A document that exceeds ``length`` tokens or
    ``max_loss`` loss-bearing ones fills sequences of its own, each as long as
    both limits allow, and its rest is placed as an example.  ``max_loss`` is
    127/128 of ``length`` unless given; a limit below 1 is refused.

    Returns one row a piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and ids (little-endian unsigned 32-bit) when
    ``with_ids``.  Rows that share an identifier are packed as documents of
    their own.  Sequence identifiers are unique, not gapless.  At the end of a
    block the last, unfilled sequence is cut into sequences whose lengths are
    powers of two, which need no padding.  Other columns are ignored; an empty
    table gives an empty result.  A task holds the tokens of one block and the
    longest document.
    """
    ship(docs.sparkSession)
    limits = (length, max_segments, length - length // 128 if max_loss is None else max_loss)
    if min(limits) < 1:
        raise ValueError("every limit must be at least 1")
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
    if with_ids:
        fields.append(("ids", pa.binary()))
    schema = pa.schema(fields)
    close = np.array([END_ID], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        sequence = TaskContext.get().partitionId() << 36
        rows: list[tuple] = []  # of the open block
        rest: list[tuple] = []  # id, start, ids, tokens of the document, tokens of its prompt
        held = 0

        def emit(doc: int | None, start: int, ids: bytes, total: int, seq: int, offset: int) -> None:
            rows.append((doc, start, len(ids) // 4, crc32(ids), total, seq, offset, *((ids,) if with_ids else ())))

        def close_block() -> Iterator[pa.RecordBatch]:
            nonlocal sequence, held
            tokens = np.array([len(r[2]) // 4 for r in rest], np.int64)
            prompt = np.array([r[4] - r[1] for r in rest], np.int64)
            loss = tokens - np.clip(prompt, 0, tokens)
            filled = dot_product_fill(tokens, loss, limits)
            for k, members in enumerate(filled):
                offset = 0
                total = int(tokens[members].sum())
                if k == len(filled) - 1 and total < length:
                    # the powers of two of the total, largest first
                    parts = [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]
                else:
                    parts = [length]
                for m in members:
                    doc, start, ids, n, _ = rest[m]
                    while ids:
                        take = ids[: 4 * (parts[0] - offset)]
                        emit(doc, start, take, n, sequence, offset)
                        start, offset, ids = start + len(take) // 4, offset + len(take) // 4, ids[len(take) :]
                        if offset == parts[0] and len(parts) > 1:
                            parts.pop(0)
                            sequence, offset = sequence + 1, 0
                sequence += 1
            if rows:
                columns = list(zip(*rows, strict=True))
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            rows.clear()
            rest.clear()
            held = 0

        for batch in batches:
            at = 0
            for texts in stretches(batch.column(1)):
                doc_ids = batch.column(0).slice(at, len(texts)).to_pylist()
                at += len(texts)
                # a line break is white space, so the ids of both parts are those of the whole
                parts = [(t or "").partition("\n") for t in texts.to_pylist()]
                ids_of = enc.ids([p[k] for k in (0, 2) for p in parts])
                for doc, line, other in zip(doc_ids, ids_of[: len(parts)], ids_of[len(parts) :], strict=True):
                    ids = line + other + close
                    total, start = len(ids) // 4, 0
                    prompt = max(1, len(line) // 4) if other else 1
                    while total - start >= (most := min(length, limits[2] + max(0, prompt - start))):
                        emit(doc, start, ids[4 * start : 4 * (start + most)], total, sequence, 0)
                        start, sequence = start + most, sequence + 1
                    if start < total:
                        rest.append((doc, start, ids[4 * start :], total, prompt))
                    held += total
                    if held >= block_tokens:
                        yield from close_block()
        yield from close_block()

    kinds = {pa.int64(): "long", pa.binary(): "binary"}
    ddl = ", ".join(f"`{name}` {kinds[kind]}" for name, kind in fields)
    slim = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text")
    return slim.mapInArrow(pieces, ddl)
