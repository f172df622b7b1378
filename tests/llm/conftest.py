import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))]

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def corpus():
    """Rows (doc_id, text, lang): the small documents, and odd ones: null, empty, blank, copies, near copies, odd characters."""
    import pyarrow.parquet as pq

    rows = []
    if os.path.isdir(SF):
        table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text", "lang"]).to_pylist()
        rows = [(r["doc_id"], r["text"], r["lang"]) for r in table]
    long = " ".join(f"word{i % 97} and{i % 31} so{i}" for i in range(3000))
    near = " ".join(f"w{i}" for i in range(200))
    odd = [
        None, "", " \n\t ", "one", "one two three", "A a A a A a A a", long, long, long + " more", "x" * 500, "x" * 500 + "y", "é" * 120 + "日本" * 60,
        near, near.replace("w7 ", "q "), near.replace("w190 ", "r "), near.replace("w50 w51 ", "") + " tail", "\x00\x85 a b <|endoftext|> it's I'LL",
        "a b c d e f g h", "a b c d e f g h i", "b c d e f g h", "a b c d e f g h",
    ]
    return rows + [(10_000_000 + i, t, None) for i, t in enumerate(odd)]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with columns that clash with names of results; one row twice, and one row without id."""
    rows = [(i, t, lang, 1, "z", 2) for i, t, lang in corpus]
    rows += [rows[5], (None, "a row without an id, long enough to be of note " * 5, "en", 1, "z", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_shingles int, component_id string, id int").repartition(5)


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
