"""Encoding, decoding and packing against the tokenizer library."""

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from opsreports.llm import encoding, packing  # noqa: E402
from opsreports.llm.bpe import Encoder, load  # noqa: E402

BYTE, WORD = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))
ODD = [
    "ab.́c d,̈ x", "İstanbul ΑΣ. ΑΣ Σας", "don't!!?? 'S 12345 1.5e10", "日本語 テキスト。a日b", "<|ENDOFTEXT|> <|startoftext|>a <|endoftext|>",
    "  lead\n\n\n  mid \t end  ", "ÀÉ×÷ ÿŸ ß", "a" * 300 + "!" * 50 + " " * 40, "﻿x​é",
]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_encode_as_the_whole(path, corpus):
    texts = [t for _, t, _ in corpus] + ODD
    ids, at = Encoder(path).batch(pa.array(texts, pa.string()))
    for text, a, b in zip(texts, at[:-1], at[1:], strict=True):
        assert ids[a:b].tolist() == load(path).encode(text or "", add_special_tokens=False).ids, text


def test_known_pieces_may_be_forgotten(corpus):
    encoder = Encoder(WORD, room=10)
    for _, text, _ in corpus[:20]:
        ids, _ = encoder.batch(pa.array([text], pa.string()))
        assert ids.tolist() == load(WORD).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("leaf", [64, 32_768])
def test_encode_and_decode(docs, leaf):
    out = encoding.encode(docs, BYTE, leaf=leaf).collect()
    assert len(out) == docs.count()
    texts = sorted((r["doc_id"] or -1, r["text"] or "") for r in docs.select("doc_id", "text").collect())
    got = sorted(((r["doc_id"] or -1, r["decoded"], r["ids"]) for r in out), key=lambda r: r[:2])
    for (i, text), (j, decoded, ids) in zip(texts, got, strict=True):
        assert i == j and decoded == text and ids == load(BYTE).encode(text, add_special_tokens=False).ids


def test_long_runs_are_joined_exactly(spark):
    rng = np.random.default_rng(2)
    runs = ["".join(rng.choice(list(letters), 700)) for letters in ("abcdeth", "éèabth", "0123456789", "!?.-", "日本語のテ", " \n")]
    runs += [a + b for a, b in zip(runs, runs[1:], strict=False)] + ["\n" * 300 + "x" * 300, "<|endoftext|>" * 40]
    rows = list(enumerate(runs))
    out = {r["doc_id"]: r["ids"] for r in encoding.encode(spark.createDataFrame(rows, "doc_id long, text string"), BYTE, leaf=50).collect()}
    for i, text in rows:
        assert out[i] == load(BYTE).encode(text, add_special_tokens=False).ids, text[:20]


def test_long_runs_with_contractions(spark):
    rng = np.random.default_rng(7)
    parts = ["'dead9", "'table", "'ten", "'s", "'ll", "'re", "'ve", "'m", "'x", "''", "ab", "日本", "12", "!?", "'S"]
    texts = ["".join(rng.choice(parts, 200)) for _ in range(20)] + ["x'dead9" * 40, "ab'table" * 40, "1'ten" * 40, "it's" * 60, "日本it's" * 40]
    rows = list(enumerate(texts))
    out = {r["doc_id"]: r["ids"] for r in encoding.encode(spark.createDataFrame(rows, "doc_id long, text string"), BYTE, leaf=50).collect()}
    for i, text in rows:
        assert out[i] == load(BYTE).encode(text, add_special_tokens=False).ids, text[:20]


def test_packing(docs, corpus):
    out = packing.pack(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), WORD, group_tokens=5000).collect()
    pieces, sequences = {}, {}
    for r in out:
        assert r["length"] * 4 == len(r["ids"]) and r["length"] > 0
        pieces.setdefault(r["doc_id"], []).append((r["start"], bytes(r["ids"]), r["doc_tokens"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, text, _ in corpus:
        want = np.array(load(WORD).encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        got = sorted(pieces[i])
        assert b"".join(p[1] for p in got) == want.tobytes() and {p[2] for p in got} == {len(want)}
        assert [p[0] for p in got] == np.cumsum([0, *[len(p[1]) // 4 for p in got]])[:-1].tolist()
    for placed in sequences.values():
        ends = 0
        for offset, length in sorted(placed):
            assert offset == ends
            ends += length
        assert ends <= 2048 and ends & (ends - 1) == 0  # full, or a power of two: no padding


def test_balance_evens_cost():
    lengths = np.array([1000] * 8 + [24] * 4 + [5000, 1])
    placed = packing.balance(lengths, 2048)
    cover = {}
    for doc, start, length, *_ in placed:
        cover.setdefault(doc, []).append((start, length))
    assert {d: sum(x for _, x in v) for d, v in cover.items()} == dict(enumerate(lengths.tolist()))
    assert max(p[3] for p in placed) + 1 <= -(-int(lengths.sum()) // 2048) + 11


def test_empty_tables(nothing):
    assert encoding.encode(nothing, BYTE).collect() == [] and packing.pack(nothing, WORD).collect() == []
