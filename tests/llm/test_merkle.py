"""The manifest against its SQL twin and a plain fold, on the small tables and on odd rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from opsreports.llm import merkle, twins
from opsreports.llm.queries import QUERIES
from tables import SF, written

KIND = "doc_id long, text string, lang string, source string, n_chars long, root string, tree int"


def test_manifest_of_the_tables(spark):
    assert differences(QUERIES["op13_manifest"](spark, SF), connect(SF), twins.OP13) in (None, "unusual types {'verified': 'boolean'}")


def test_odd_rows(spark, tmp_path):
    rows = [(i, f"text {i % 7}", [None, "", "en", "en", "en", "é", "z"][i % 7], None if i % 3 else "s", i, "x", 1) for i in range(60)]
    rows += [rows[5], rows[5], (None, None, None, None, None, None, None), (None, "", "en", "", 0, "", 0), (7, None, "only", "s", None, "x", 1), (28, "x" * 200_000, "en", "s", 2**63 - 2, "x", 1)]
    con = written(spark, tmp_path, documents=spark.createDataFrame(rows, KIND).repartition(5))
    assert differences(QUERIES["op13_manifest"](spark, str(tmp_path)), con, twins.OP13) in (None, "unusual types {'verified': 'boolean'}")


def test_empty_table(spark, tmp_path):
    written(spark, tmp_path, documents=spark.createDataFrame([], KIND))
    assert QUERIES["op13_manifest"](spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("fan,span", [(2, 1), (2, 3), (3, 2), (5, 1)])
def test_epochs_do_not_change_the_root(spark, fan, span):
    rows = [(i, "a" if i % 3 else "b") for i in range(101)]
    got = merkle.manifest(spark.createDataFrame(rows, "doc_id long, lang string").repartition(3), merkle.leaf(F.col("doc_id")), keep=[F.col("doc_id")], fan=fan, span=span).collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()

    def top(nodes):
        while len(nodes) > 1:
            nodes = [sha("".join(nodes[i : i + fan])) for i in range(0, len(nodes), fan)]
        return nodes[0]

    leaf = lambda i: sha(f"{len(str(i))}:{i}")
    root = top([top([leaf(i) for i, l in rows if l == lang]) for lang in "ab"])
    assert len(got) == 101
    for r in got:
        assert r["root"] == root and r["leaf"] == leaf(r["doc_id"])
        digest = r["leaf"]
        for level in r["proof"].split(";")[:-1]:
            left, right = level.split(".")
            digest = sha(left + digest + right)
        assert digest == root
