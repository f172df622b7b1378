"""Sketches and their peeling against plain sets."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from opsreports.llm import sketches

END = re.compile(r"\n|(?<=[aeiou][.!?]) ")


def parts(text):
    return {p for p in END.split(text) if p}


def test_versions_against_sets(docs, corpus):
    got = {r["doc_id"]: r for r in sketches.compare_versions(docs).select(
        "*", sketches.likeness(F.col("own"), F.col("changed"), F.col("to_edited")).alias("near"),
        sketches.likeness(F.col("own"), F.col("following"), F.col("to_next")).alias("next"),
        sketches.written(F.col("own_cells")).alias("print"),
    ).collect()}
    rows = sorted((i, t or "") for i, t, _ in corpus)
    assert len(got) == len(rows)
    alike = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    prints = {}
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        r = got[i]
        assert r["n_chars"] == len(text) and hashlib.sha256(r["edited"].encode()).digest() == hashlib.sha256(edited.encode()).digest()
        assert r["near"] == pytest.approx(alike(parts(text), parts(edited))) and r["next"] == pytest.approx(alike(parts(text), parts(after)))
        assert prints.setdefault(text, r["print"]) == r["print"]


@pytest.mark.parametrize("apart", [0, 1, 8, 40, 600])
def test_peeling_recovers_the_digests(spark, apart):
    a, b = list(range(50)) + list(range(1000, 1000 + apart)), list(range(50)) + list(range(5000, 5000 + apart // 2))
    rows = spark.createDataFrame([(7, a, b), (8, b, a), (9, a, a)], "id long, a array<bigint>, b array<bigint>")
    got = {r["id"]: (sorted(r["plus"]), sorted(r["minus"])) for r in sketches.differences(rows, {"d": ("a", "b")}).select("id", "d.plus", "d.minus").collect()}
    assert got == ({7: (a[50:], b[50:]), 8: (b[50:], a[50:])} if apart else {})


def test_sketches_that_fail_are_tried_again(spark, monkeypatch):
    a, b = list(range(50)), list(range(40, 90))
    rows = spark.createDataFrame([(7, a, b)], "id long, a array<bigint>, b array<bigint>")
    tries = {}
    # A first estimate far too low leaves cells; with no sweep at all only the lists are left to tell.
    monkeypatch.setattr(sketches, "estimate", lambda x, y: F.lit(0))
    for sweeps in (1, 0):
        monkeypatch.setattr(sketches, "SWEEPS", sweeps)
        r = sketches.differences(rows, {"d": ("a", "b")}).first()
        assert sorted(r["d"]["plus"]) == a[:40] and sorted(r["d"]["minus"]) == b[10:]
        tries[sweeps] = r["d_try"]
    assert tries == {1: 1, 0: 2}


def test_entries_grow_with_any_text(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    words = lambda letters, n, space=" ": space.join("".join(rng.choice(list(letters), int(rng.integers(2, 9)))) for _ in range(n))
    rows = []
    for letters, space in (("bcdfghklmnprst", " "), ("абвгдежзиклмнопрст", " "), ("αβγδεζηθικλμν", " "), ("ابتثجحخدذرز", " "), ("日本語文字漢学校生先今何時分", ""), ("0123456789abcdef", "")):
        rows += [(len(rows) + i, words(letters, 300, space)) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sketches.compare_versions(df, digests=sketches.even_digests).select("doc_id", F.size("own").alias("n"), sketches.likeness(F.col("own"), F.col("changed"), F.col("to_edited")).alias("near")).collect()
    assert len(got) == 24
    for r in got:  # the last of each script is followed by another script, with more or fewer entries for its length
        assert r["near"] >= 0.4 or r["doc_id"] % 4 == 3, r
    assert all(r["n"] >= 4 for r in got)


def test_one_document_follows_itself(spark):
    one = sketches.compare_versions(spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")).first()
    assert one["edited"] == "abcdefab"


def test_empty_table(nothing):
    assert sketches.compare_versions(nothing).collect() == []



def even_parts(text):
    """``even_digests`` in plain Python: lines cut after units of chosen hash, then at multiples of the longest length."""
    import regex
    import xxhash

    space, apart = r" \t\n\x0b\f\r", r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"
    unit = regex.compile(rf"(?s)[^{space}{apart}]{{1,8}}+[{space}]*|.")
    hash_ = lambda s, seed=42: xxhash.xxh64_intdigest(s.encode(), seed)
    out = set()
    for line in text.split("\n"):
        made = "".join(u + "\n" if hash_("end", hash_(u.rstrip(" "))) % sketches.EVERY == 0 else u for u in unit.findall(line))
        for p in made.split("\n"):
            out |= {p[i : i + sketches.LONGEST].rstrip(" ") for i in range(0, len(p), sketches.LONGEST)} - {""}
    return {h - (1 << 64) if h >> 63 else h for h in map(hash_, out)}


def test_the_registered_query_against_sets(spark, docs, corpus, tmp_path):
    from opsreports.llm.queries import QUERIES

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in QUERIES["op6_fingerprints"](spark, str(tmp_path)).collect()}
    rows = sorted((i, t or "") for i, t, _ in corpus)
    assert len(got) == len(rows)
    alike = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        r = got[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(alike(even_parts(text), even_parts(edited)))
        assert r["near_next"] == pytest.approx(alike(even_parts(text), even_parts(after)))
    tries = sketches.compare_versions(docs, digests=sketches.even_digests).groupBy("to_edited_try").count().collect()
    counts = {r["to_edited_try"]: r["count"] for r in tries}
    assert counts.get(0, 0) >= 0.9 * sum(counts.values())
