"""Cost-balanced packing of documents into token sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from opsreports.llm.bpe import Encoder


def attention_cost(length, quadratic: float):
    """Estimated cost of a piece: linear in its tokens, plus attention over all pairs of them."""
    return length + quadratic * np.square(np.asarray(length, float))


def balance(lengths: np.ndarray, capacity: int, quadratic: float = 1 / 1024) -> list[tuple[int, int, int, int, int]]:
    """Places documents of the given token counts in sequences: rows (document, start, length, sequence, offset).

    The sequences' room adds up to the tokens exactly: as many of ``capacity`` as fill up, and powers
    of two for the rest. A document first fills whole sequences of its own. What remains of each
    goes, in descending length (ties: in the order given), to the sequence of the lowest cost so
    far that has room for all of it. Where none has, it is cut: the cheapest sequences with any
    room left are filled with it.
    """
    placed, total = [], int(np.sum(lengths))
    rooms = [capacity] * (total // capacity) + [1 << b for b in range(capacity.bit_length() - 1, -1, -1) if total % capacity >> b & 1]
    room, cost = np.array(rooms, np.int64), np.zeros(len(rooms))
    size = room.copy()
    whole, rest = np.divmod(np.asarray(lengths, np.int64), capacity)
    used = 0
    for doc in np.flatnonzero(whole):
        for k in range(int(whole[doc])):
            placed.append((int(doc), k * capacity, capacity, used, 0))
            room[used] = 0
            used += 1
    for doc in np.argsort(-rest, kind="stable"):
        start, left = int(whole[doc]) * capacity, int(rest[doc])
        while left:
            fits = room >= left
            if not fits.any():
                fits = room > 0
            at = int(np.argmin(np.where(fits, cost, np.inf)))
            length = min(left, int(room[at]))
            placed.append((int(doc), start, length, at, int(size[at] - room[at])))
            room[at] -= length
            cost[at] += float(attention_cost(length, quadratic))
            start, left = start + length, left - length
    return placed


def pack(
    df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048,
    end_id: int = 1, quadratic: float = 1 / 1024, group_tokens: int = 1 << 20,
) -> DataFrame:
    """Packs the tokens of each text, then ``end_id``, into sequences of at most ``capacity`` tokens.

    Returns a row per piece: id, start (tokens of its document before it), length, ids (the tokens as
    little-endian unsigned 32-bit numbers), doc_tokens, sequence_id and offset in the sequence. A
    task packs its own documents, by ``balance``, whenever it has gathered ``group_tokens`` tokens
    of them, so nothing is shuffled and memory is bounded by that and by one batch. All sequences
    are full but the few last ones of a group, whose sizes are powers of two, so none needs padding.

    Null and empty text: the end token alone. Repeated rows are packed each for itself. A null id
    stays null. An empty table gives no rows. Other columns are ignored. ``capacity`` must be a
    power of two.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, keys, docs, held, sequence = Encoder(tokenizer_path), [], [], 0, TaskContext.get().partitionId() << 33

        def flush():
            nonlocal sequence
            placed = balance(np.array([len(d) for d in docs], np.int64), capacity, quadratic)
            order = sorted(placed, key=lambda p: p[3:])
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([keys[p[0]] for p in order], key_type),
                    *[pa.array([p[i] for p in order], pa.int64()) for i in (1, 2)],
                    pa.array([docs[d][s : s + n].tobytes() for d, s, n, _, _ in order], pa.binary()),
                    pa.array([len(docs[p[0]]) for p in order], pa.int64()),
                    pa.array([sequence + p[3] for p in order], pa.int64()),
                    pa.array([p[4] for p in order], pa.int64()),
                ],
                names=[id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )
            sequence += 1 + max(p[3] for p in placed)
            keys.clear()
            docs.clear()
            return out

        for batch in batches:
            key_type = batch.schema.field(0).type
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                ids, at = encoder.batch(part.column(1))
                for key, a, b in zip(part.column(0).to_pylist(), at[:-1], at[1:], strict=True):
                    keys.append(key)
                    docs.append(np.append(ids[a:b], end_id).astype("<u4"))
                    held += len(docs[-1])
                    if held >= group_tokens:
                        yield flush()
                        held = 0
        if docs:
            yield flush()

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
