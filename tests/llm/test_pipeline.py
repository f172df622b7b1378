"""The pipeline on the small tables: each stage's decision, by plain Python on what the stage before kept."""

import os

import pytest

import corpus_pipeline as pipeline
from opsreports.llm.common import settle, table
from test_jaccard import brute as similar
from test_repeats import brute as repeated

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not here")


def test_stages_in_turn(spark):
    docs = table(spark, SF, "documents")
    kept = {}
    for name, stage in pipeline.STAGES[:-1]:
        docs = settle(stage(spark, docs, SF), name)
        assert docs.columns == pipeline.COLUMNS
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    assert len(kept["language"]) >= 0.97 * table(spark, SF, "documents").count()
    assert set(kept["similar"]) == {i for i, (_, c) in similar(kept["language"].items()).items() if c == i}
    want = repeated(kept["similar"].items())
    for i, text in kept["similar"].items():
        data, out, at = text.encode(), b"", 0
        for a, b in want[i][1]:
            out, at = out + data[at:a], b
        assert kept["repeats"][i] == (out + data[at:]).decode(errors="ignore")
    packed = pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in packed} == set(kept["personal"])
    for i in kept["personal"]:
        own = [r for r in packed if r["doc_id"] == i]
        assert sum(r["length"] for r in own) == own[0]["doc_tokens"]
