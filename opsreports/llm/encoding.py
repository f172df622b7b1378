"""Byte-pair encoding and decoding, with tree concatenation for long unsplit text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsreports.llm.bpe import Encoder, cut, load, text_bytes


def _plain(path: str, text: str) -> list[int]:
    return load(path).encode(text, add_special_tokens=False).ids


def _agrees(path: str, left: int, right: int, text: str) -> bool:
    """Whether two tokens side by side are what their joined text encodes to."""
    return _plain(path, text) == [left, right]


def join_halves(path: str, left: tuple[str, list[int]], right: tuple[str, list[int]], window: int = 8) -> tuple[str, list[int]]:
    """Tokens of two texts put together, from the tokens of each.

    Re-encodes ``window`` tokens on either side of the join, then twice as many and so on, until the new tokens
    meet the kept ones at both ends exactly: the token pair at each end is what its own text encodes
    to. A sequence in which every neighbouring pair is so is the encoding of the whole, since the merges
    of byte-pair encoding act on neighbours in a fixed order of rank. The window moves to whole characters.
    """
    (a, x), (b, y) = left, right
    if not x or not y:
        return a + b, x + y
    tokenizer = load(path)

    def width(ids: list[int], text: str, tail: bool) -> int | None:
        """Characters of the text that the ids cover, None if they cut a character."""
        shown = tokenizer.decode(ids, skip_special_tokens=False)
        whole = text.endswith(shown) if tail else text.startswith(shown)
        return len(shown) if whole else None

    while True:
        k, m = min(window, len(x)), min(window, len(y))
        while k < len(x) and width(x[-k:], a, True) is None:
            k += 1
        while m < len(y) and width(y[:m], b, False) is None:
            m += 1
        u = len(a) if k == len(x) else width(x[-k:], a, True)
        v = len(b) if m == len(y) else width(y[:m], b, False)
        inner = _plain(path, a[len(a) - u :] + b[:v])
        ids = x[: len(x) - k] + inner + y[m:]

        def meets(i: int) -> bool:
            pair = ids[i : i + 2]
            return _agrees(path, *pair, tokenizer.decode(pair, skip_special_tokens=False))

        first, last = len(x) - k - 1, len(ids) - (len(y) - m) - 1
        if (k == len(x) or meets(first)) and (m == len(y) or meets(last)):
            return a + b, ids
        window *= 2


def _leaves(text: str, leaf: int) -> list[str]:
    """A run cut in halves until each has at most ``leaf`` characters; never at a place where a half would split by itself."""
    if len(text) <= leaf:
        return [text]
    return _leaves(text[: len(text) // 2], leaf) + _leaves(text[len(text) // 2 :], leaf)


def encode(
    df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", leaf: int = 32_768,
) -> DataFrame:
    """Rows (id, ids array<int>, decoded string): each text's tokens as the library gives them, and those decoded again.

    Texts of at most ``leaf`` characters are encoded where they are read. Longer ones are cut at word
    boundaries into segments of about that length, and unsplit runs beyond it into halves of halves; segments and
    halves are dealt out and encoded in parallel, then a document's are put together again:
    halves pairwise, up the tree, by ``join_halves``. A run is one pre-token of letters,
    digits, signs or white space, or a contraction ('s, 'll); runs of mixed kinds are first cut between the kinds.

    Null text counts as empty: no tokens, decoded to the empty text. Repeated rows come out each for itself,
    a null id stays null, an empty table gives no rows, other columns are ignored.
    """
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(id_col, text_col)
    long = F.length(text_col) > leaf

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                ids, at = encoder.batch(part.column(1))
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))
                texts = encoder.tokenizer.decode_batch([ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)], skip_special_tokens=False)
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(texts, pa.string())], names=[id_col, "ids", "decoded"])

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        import regex

        # The kinds of run that the pre-tokenizer of a byte-level model keeps together, in its order; contractions come first.
        kinds = regex.compile(r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data, at = text_bytes(pa.array([text]))
                bounds, _ = cut(data, at)
                raw, parts, start = data.tobytes(), [], 0
                for end, after in zip(bounds[1:], [*bounds[2:], len(raw) + leaf], strict=True):
                    if after - start > leaf:  # whole pieces as far as they go, or one piece that is longer
                        parts.append(raw[start:end].decode())
                        start = int(end)
                out, n = [], 0
                for part in parts:
                    runs = [part] if len(part) <= leaf else [m[0] for m in kinds.finditer(part)] if "<|" not in part else [part]
                    for run in runs:
                        for piece in _leaves(run, leaf) if len(runs) > 1 or kinds.fullmatch(run) else [run]:
                            out.append((n, piece))
                        n += 1
                yield pa.RecordBatch.from_pydict(
                    {"row": [row] * len(out), "key": pa.array([key] * len(out), batch.schema.field(0).type), "run": [o[0] for o in out],
                     "leaf": list(range(len(out))), "text": [o[1] for o in out]},
                )
                row += 1

    def encode_leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        for batch in batches:
            ids, at = encoder.batch(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "ids"])

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        ids: list[int] = []
        for _, run in group.sort_values("leaf").groupby("run", sort=True):
            level = [(t, list(i)) for t, i in zip(run["text"], run["ids"], strict=True)]
            while len(level) > 1:
                level = [join_halves(tokenizer_path, *level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
            ids += level[0][1]
        decoded = load(tokenizer_path).decode(ids, skip_special_tokens=False)
        return pd.DataFrame({id_col: group["key"].iloc[:1], "ids": [ids], "decoded": [decoded]})

    schema = f"`{id_col}` {kind}, ids array<int>, decoded string"
    leaves = rows.where(long).mapInArrow(segment, f"row long, key {kind}, run long, leaf long, text string")
    encoded = leaves.repartition("row", "leaf").mapInArrow(encode_leaf, f"row long, key {kind}, run long, leaf long, text string, ids array<int>")
    joined = encoded.groupBy("row").applyInPandas(gather, schema)
    return rows.where(~F.coalesce(long, F.lit(False))).mapInArrow(short, schema).union(joined)
