"""Repeat removal against brute force; interval trees against all substrings."""

import hashlib

import numpy as np
import pytest
from pyspark import cloudpickle

from opsreports.llm import repeats


def brute(rows, length=100):
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            w = data[s : s + length]
            if w in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(w)
        edges = np.flatnonzero(np.diff(np.pad(np.frombuffer(bytes(gone), np.int8), 1))).tolist()
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out[i] = (len(data), list(zip(edges[::2], edges[1::2], strict=True)), hashlib.sha256(kept).hexdigest())
    return out


def result(df, **options):
    out = {}
    for r in repeats.find_repeats(df, **options).collect():
        spans = [(s["start"], s["end"]) for s in r["spans"]]
        kept = r["address"] if r["kept"] is None else hashlib.sha256(bytes(r["kept"])).hexdigest()
        out.setdefault(r["doc_id"], set()).add((r["n_bytes"], tuple(spans), kept))
    assert all(len(v) == 1 for v in out.values())
    return {k: (n, list(s), h) for k, v in out.items() for n, s, h in v}


@pytest.mark.parametrize("chunk", [50, 20_000])
def test_against_brute_force(docs, corpus, chunk):
    found = result(docs, chunk=chunk)
    assert found.pop(None)[1] == []
    assert found == brute([(i, t) for i, t, _ in corpus])


def test_random_texts_of_few_letters(spark):
    rng = np.random.default_rng(5)
    parts = ["".join(rng.choice(list("abé"), int(rng.integers(60, 260)))) for _ in range(12)]
    rows = [(i, "".join(parts[k] for k in rng.integers(0, 12, int(rng.integers(0, 6))))) for i in range(80)]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_periodic_text(spark):
    rows = [(1, "ab" * 400), (2, "ba" * 120 + "c" + "ab" * 60), (3, "z" * 99), (4, "z" * 99)]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_no_task_holds_a_crowded_anchor(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(3)
    own = lambda: "".join(rng.choice(list("abcdefgh"), 90))
    passage = "".join(rng.choice(list("ijklmnop"), 300))
    rows = [(i, own() + passage + own()) for i in range(600)]
    usual, made = repeats.repeated, tmp_path / "sizes"

    def watched(group, *rest):
        with open(made, "a") as f:
            f.write(f"{len(group)}\n")
        return usual(group, *rest)

    monkeypatch.setattr(repeats, "repeated", watched)
    cloudpickle.register_pickle_by_value(repeats)
    try:
        got = result(spark.createDataFrame(rows, "doc_id long, text string"), chunk=100)
    finally:
        cloudpickle.unregister_pickle_by_value(repeats)
    assert got == brute(rows)
    assert not made.exists() or max(map(int, made.read_text().split())) <= 200


def test_kept_text_drops_halved_characters(spark):
    rows = [(1, "é" * 100), (2, "xé" + "é" * 80)]
    got = {r["doc_id"]: r for r in repeats.find_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[2]["kept_text"] == bytes(got[2]["kept"]).decode(errors="ignore")


def test_maximal_repeats_are_those_of_all_substrings():
    texts = [b"abcabcab", b"xabcaby", b"cabx"]
    found = {(n, tuple(o)) for n, o in repeats.maximal_repeats(texts, 2)}
    want = set()
    for n in range(2, 9):
        for w in {t[i : i + n] for t in texts for i in range(len(t) - n + 1)}:
            at = [(k, i) for k, t in enumerate(texts) for i in range(len(t) - n + 1) if t[i : i + n] == w]
            before = {texts[k][i - 1] if i else (k, i) for k, i in at}
            after = {texts[k][i + n] if i + n < len(texts[k]) else (k, i) for k, i in at}
            if len(at) > 1 and len(before) > 1 and len(after) > 1:
                want.add((n, tuple(at)))
    assert found == want


def test_empty_table(nothing):
    assert repeats.find_repeats(nothing).collect() == []
