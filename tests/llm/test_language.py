"""Language identification: held-out accuracy and odd texts."""

import zlib

from pyspark.sql import functions as F

from opsreports.llm import language


def test_held_out_accuracy(spark, docs, corpus):
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = language.learn(docs.where(~held))
    assert set(model.dictionaries) == {"en", "fr", "de", "es"}
    got = {r["doc_id"]: r for r in language.identify(docs, model).collect()}
    known = {i: lang for i, _, lang in corpus if lang and zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(got[i]["lang_pred"] == lang for i, lang in known.items()) >= 0.95 * len(known)
    for i, text, _ in corpus:
        if not any(map(str.isalpha, text or "")):
            assert (got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) == ("und", 0.0, True)
        else:
            assert got[i]["lang_pred"] in model.dictionaries and 0 <= got[i]["score"] <= 1


def test_labels_that_are_no_use(spark, nothing):
    none = language.learn(nothing)
    assert none.dictionaries == {} and language.identify(nothing, none).collect() == []
    one = spark.createDataFrame([(1, "hello you", "en"), (2, None, "en"), (3, "ja ja", None)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(one, language.learn(one)).collect()}
    assert got == {1: ("en", 1.0), 2: ("und", 0.0), 3: ("en", 1.0)}


def test_other_columns_come_along(spark, docs):
    out = language.identify(docs, language.LanguageModel({}), keep=["lang", "doc_id"])
    assert out.columns == ["lang", "doc_id", "lang_pred", "score", "rejected"] and out.count() == docs.count()
