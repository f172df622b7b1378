"""Byte-pair encoding of text columns in tasks: one library call for each distinct piece of a batch."""

from __future__ import annotations

import itertools
import json
import os
import re
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


#: Signs before which a piece may end: none of an apostrophe's contractions, none inside a special token.
CUT_SIGNS = b'.,!?;:)$#%&*"'
BLANK, SHOWN, LETTER, SIGN = 1, 2, 4, 8
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x0A]] |= BLANK
KIND[0x21:0x7F] |= SHOWN
KIND[0x41:0x5B] |= LETTER
KIND[0x61:0x7B] |= LETTER
KIND[list(CUT_SIGNS)] |= SIGN


def _byte_letters() -> dict[int, str]:
    """The public byte-level alphabet: visible Latin-1 characters stand for themselves, the other bytes for U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


BYTE_LETTERS = _byte_letters()


@cache
def load(path: str):
    """The tokenizer of a file, one for each Python worker; without truncation and padding."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of an Arrow string column, and where each text begins (one more than texts). Null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), at - (at[0] if len(at) else 0)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def cut(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece boundaries in the bytes, and how many pieces each text has.

    A piece ends before a space or line feed that follows a visible ASCII character or a letter of
    the block U+00C0 to U+00FF, and before a sign of ``CUT_SIGNS`` that follows a letter. No
    pre-tokenizer of a word kind joins across such a place, nor looks back over it, so the tokens
    of a text are those of its pieces, end to end.
    """
    edge = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        kind = KIND[data]
        latin = np.zeros(len(data), bool)
        latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80)
        letter = ((kind & LETTER) > 0) | latin
        edge[1:-1] = ((kind[1:] & BLANK) > 0) & (((kind & SHOWN) > 0) | latin)[:-1] | ((kind[1:] & SIGN) > 0) & letter[:-1]
    edge[at] = True
    bounds = np.flatnonzero(edge)
    return bounds, np.diff(np.searchsorted(bounds, at))


def lower(data: np.ndarray) -> np.ndarray:
    """The bytes with capital letters of ASCII and of U+00C0 to U+00DE made small."""
    out = data + (((data >= 0x41) & (data <= 0x5A)) << 5).astype(np.uint8)
    big = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    out[big] += 0x20
    return out


class Encoder:
    """Tokens of text columns, remembering the tokens of pieces seen. ``room``: pieces kept at most.

    A piece that is one plain word goes straight to the model; its pre-tokens are known. Others go
    through the whole tokenizer.
    """

    def __init__(self, path: str, room: int = 800_000):
        self.tokenizer, self.room, self.known, self.older = load(path), room, {}, {}
        stated = json.loads(self.tokenizer.to_str())
        before, splits = stated["normalizer"], stated["pre_tokenizer"]
        steps = [n["type"] for n in (before or {}).get("normalizers", [])]
        self.small = steps == ["NFC", "Replace", "Lowercase"]
        latin = rb"|\xc3[\x9f-\xb6\xb8-\xbf]" if self.small else rb"|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]"
        plain = splits["type"] == "ByteLevel" and splits["use_regex"] and not splits["add_prefix_space"]
        self.word = None
        if self.small:
            self.word = re.compile(rb"[ \n]?((?:[a-z]" + latin + rb")+)")
        elif before is None and plain:
            self.word = re.compile(rb"( ?(?:[A-Za-z]" + latin + rb")+)")

    def _learn(self, new: list[bytes]) -> None:
        known, rest, tokens = self.known, [], self.tokenizer.model.tokenize
        for p in new:
            if p in self.older:
                known[p] = self.older[p]
            elif self.word and (m := self.word.fullmatch(p)):
                known[p] = [t.id for t in tokens(m[1].decode("latin-1").translate(BYTE_LETTERS))]
            else:
                rest.append(p)
        for i in range(0, len(rest), 10_000):
            part = rest[i : i + 10_000]
            got = self.tokenizer.encode_batch_fast([p.decode() for p in part], add_special_tokens=False)
            known.update(zip(part, (g.ids for g in got), strict=True))

    def batch(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text's begin."""
        data, at = text_bytes(column)
        if self.small and len(data) > 1 and not ((data[:-1] == 0x3C) & (data[1:] == 0x7C)).any():
            data = lower(data)  # as the tokenizer does; not where a special token may stand
        bounds, pieces = cut(data, at)
        if len(bounds) < 2:
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        array = pa.Array.from_buffers(
            pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
        )
        coded = array.dictionary_encode()
        which, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        if len(self.known) > self.room // 2:
            self.known, self.older = {}, self.known
        known = self.known
        self._learn([p for p in distinct if p not in known])
        ids = [known[p] for p in distinct]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        each = sizes[which]
        ends = np.cumsum(each)
        total = int(ends[-1]) if len(ends) else 0
        pick = np.arange(total) + np.repeat(starts[which] - (ends - each), each)
        ends = np.concatenate(([0], ends))
        return flat[pick], ends[np.concatenate(([0], np.cumsum(pieces)))]
