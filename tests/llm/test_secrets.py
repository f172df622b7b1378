"""Secrets against plain regular expressions; the ledger scans each blob once."""

import re

import pytest

from opsreports.llm import secrets
from opsreports.session import fresh_dir

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    text, found = text or "", []
    found += [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


TEXTS = [
    "é token = 'abcdef' and API_KEY:\"0123456789abcdef0123456789abcdef\" AKIA" + "A1" * 9, "secret=token: abcdefgh", "secret=abc password = xyz12345 PassWD='q'",
    "AKIA" + "B" * 15 + " AKIAAKIA" + "C" * 12, "deadbeef" * 3 + "g" + "deadbeef" * 2, "日本token=日本", "token==abcdef", "apikey   :   secret_token=aaaaaaa", None, "", "toKen=ſecret",
    "secret=token=abcdefg " * 50,
]


@pytest.fixture
def ledger(spark):
    return secrets.BlobLedger(spark, fresh_dir(spark, "ledger"))


def test_against_plain_expressions(spark, docs, corpus, ledger):
    rows = docs.select("doc_id", "text", "n_shingles").union(spark.createDataFrame([(-1 - i, t, 0) for i, t in enumerate(TEXTS)], "doc_id long, text string, n int"))
    ledger.update(rows)
    got = ledger.spans(rows).collect()
    assert len(got) == rows.count()
    texts = {i: t for i, t, _ in corpus} | {-1 - i: t for i, t in enumerate(TEXTS)}
    for r in got:
        if r["doc_id"] is not None:
            base = [(s["start"], s["rank"], s["kind"], s["end"]) for s in r["spans"] if s["rank"] < 3]
            assert base == brute(texts[r["doc_id"]]), texts[r["doc_id"]]


def test_only_unseen_blobs_are_scanned(spark, ledger):
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    first = frame([(1, "token=abcdef"), (2, "token=abcdef"), (3, None), (4, "")])
    assert ledger.update(first) == 2 and ledger.update(first) == 0
    more = frame([(1, "token=ghijkl"), (5, "token=abcdef")])
    assert ledger.spans(more).where("spans IS NULL").count() == 1
    assert ledger.update(more) == 1
    assert ledger.update(more, version="2") == 2
    assert sorted(r["doc_id"] for r in ledger.spans(first.union(more)).where("size(spans) = 1").collect()) == [1, 1, 2, 5]


def test_repeated_rows_lend_one_text(spark, ledger):
    rows = [(5, "token=abcdef"), (5, "token=abcdef"), (None, "x secret=ghijkl"), (None, "x secret=ghijkl"), (None, "x secret=ghijkl")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert ledger.update(df) == 2
    assert sorted((r["doc_id"] or 0, secrets_of(r)) for r in ledger.spans(df).collect()) == [(0, [(2, 15)])] * 3 + [(5, [(0, 12)])] * 2
    assert ledger._read("findings", secrets.FINDING).count() == 2


def secrets_of(row):
    return [(s["start"], s["end"]) for s in row["spans"]]


def test_empty_table(nothing, ledger):
    assert ledger.update(nothing) == 0 and ledger.spans(nothing).collect() == []
