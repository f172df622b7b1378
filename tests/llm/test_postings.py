"""The positional index against its SQL twin, and its phrase and nearness searches against plain loops."""

import random

import pytest

from compare import connect, differences
from opsreports.llm import postings, twins
from opsreports.llm.queries import QUERIES
from tables import SF, written

DOCS = "doc_id long, text string, lang string, n_hit int, phrase string, at int"
ITEMS = "item_id long, text string, term int"
PASSED = (None, "unusual types {'contaminated': 'boolean'}")


def test_tables(spark):
    assert differences(QUERIES["op12_decontamination"](spark, SF), connect(SF), twins.OP12) in PASSED


def test_odd_rows(spark, tmp_path):
    rng = random.Random(7)
    word = lambda: rng.choice("a b c d e é ß x1 zz".split())
    items = [" ".join(word() for _ in range(n)) for n in (1, 2, 3, 9, 10, 11, 14, 30)] + [None, "", " .,! ", "a a a a a a a a a a a a", "A-a\tB\nÉ", "a"]
    texts = [" ".join(word() for _ in range(rng.randrange(60))) for _ in range(60)]
    texts += [items[7], f"z, {items[7].upper()} z", items[5] + " q " + items[5], None, "", "..", "a", "a " * 1_500, "É B", "\x00a\x7fb", items[6] + " " + items[6]]
    rows = [(i, t, "en", 1, "x", 2) for i, t in enumerate(texts)]
    rows += [rows[61], rows[61], (None, items[7], None, None, None, None), (None, None, "", 0, "", 0), (61, "another text of that id " + items[4], "", 0, "", 0)]
    kept = [(i, t, 1) for i, t in enumerate(items)] + [(2, items[6], 1), (2, items[2], 1), (None, items[4], 1), (10, items[5], 1)]
    con = written(spark, tmp_path, documents=spark.createDataFrame(rows, DOCS).repartition(4), benchmark=spark.createDataFrame(kept, ITEMS))
    assert differences(QUERIES["op12_decontamination"](spark, str(tmp_path)), con, twins.OP12) in PASSED


@pytest.mark.parametrize("docs,items", [([], [(1, "a b", 1)]), ([(1, "a b", "", 1, "", 1)], []), ([], [])])
def test_empty_tables(spark, tmp_path, docs, items):
    con = written(spark, tmp_path, documents=spark.createDataFrame(docs, DOCS), benchmark=spark.createDataFrame(items, ITEMS))
    assert differences(QUERIES["op12_decontamination"](spark, str(tmp_path)), con, twins.OP12) in PASSED


def test_searches_over_a_whole_index(spark):
    rng = random.Random(3)
    texts = {i: [rng.choice("abcdefgh") for _ in range(rng.randrange(80))] for i in range(40)}
    index = postings.store(spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string"))
    ids = {(r["d1"], r["d2"]): r["id"] for r in index.select("id", "d1", "d2").distinct().collect()}
    phrases = ["a b", "c", "d a c", "h h", "a b c d", "a zz"]
    got = {(ids[r["d1"], r["d2"]], r["phrase"], r["start"]) for r in postings.phrase_places(index, spark.createDataFrame([(p,) for p in phrases], "phrase string")).collect()}
    want = {(i, p, s) for i, t in texts.items() for p in phrases for s in range(len(t)) if t[s : s + len(p.split())] == p.split()}
    assert got == want and len(want) > 50
    groups = {"one": "abc", "two": "hg", "three": "aaf", "four": "az"}
    rows = [(g, t) for g, ts in groups.items() for t in ts]
    got = {(ids[r["d1"], r["d2"]], r["group"], r["start"]) for r in postings.near_places(index, spark.createDataFrame(rows, "group string, term string"), 4).collect()}
    assert got == {(i, g, s) for i, t in texts.items() for g, ts in groups.items() for s in range(len(t)) if t[s] in ts and set(ts) <= set(t[s : s + 4])}
