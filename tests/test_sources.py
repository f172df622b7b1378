import json

import pytest
from pyspark.sql import functions as F, types as T

from opsreports import session
from opsreports.sources import readers, stores, writers


def test_records_and_raw_sheets(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text("caseid,How likely?\n7,\"very, yes\"\n8,\n")
    schema = T.StructType([T.StructField("caseid", T.LongType()), T.StructField("answer", T.StringType())])
    assert [tuple(r) for r in readers.read_records(spark, str(path), schema).collect()] == [(7, "very, yes"), (8, None)]
    raw = readers.read_raw(spark, str(path), {"How likely?": "answer"})
    assert raw.dtypes == [("caseid", "string"), ("answer", "string")]
    assert [r["caseid"] for r in raw.collect()] == ["7", "8"]


def test_cells_come_back_as_they_were(spark, tmp_path):
    cells = ['line one\nline two, "quoted"', "", None, "  edge  ", "\\N", "\\\\N", "N", '"', "a\r\nb\rc", "\\", 'x\\"y']
    df = spark.createDataFrame(list(enumerate(cells)), "id bigint, cell string")
    path = writers.write_csv(df, str(tmp_path / "cells"))
    assert [tuple(r) for r in readers.read_records(spark, path, df.schema).orderBy("id").collect()] == list(enumerate(cells))
    raw = {r["id"]: r["answer"] for r in readers.read_raw(spark, path, {"cell": "answer"}).collect()}
    assert raw == {str(i): c for i, c in enumerate(cells)}


def test_key_list_leaves_the_instruction_out(spark):
    sheet = spark.createDataFrame([("do not edit",), ("5",), ("6",)], "id string")
    keys = readers.key_list(sheet, "id", F.col("id").contains("edit"))
    assert sorted(r["id"] for r in keys.collect()) == [5, 6]


def test_json_lists(spark):
    item = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    rows = spark.createDataFrame([("x", '[{"a": 1, "b": "p"}, {"a": 2}]'), ("y", "[]"), ("z", None)], "who string, body string")
    assert sorted(tuple(r) for r in readers.explode_json(rows, "body", item, ["who"]).collect()) == [("x", 1, "p"), ("x", 2, None)]


def test_template_file_order(spark, tmp_path):
    path = tmp_path / "templates.json"
    path.write_text(json.dumps({"zeta": {"text": "Hello"}, "alpha": {"text": "Hi\nyou"}}, indent=1))
    rows = readers.read_templates(spark, str(path)).orderBy("ordinal").collect()
    assert [(r["name"], r["text"]) for r in rows] == [("zeta", "Hello"), ("alpha", "Hi\nyou")]


def test_truncate_casts_to_the_declared_columns(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("amount", T.DoubleType())])
    rows = spark.createDataFrame([(1, 2, "extra")], "amount int, id int, other string")
    writers.write_truncate(rows, str(tmp_path / "t"), schema)
    back = stores.Published(spark, str(tmp_path / "t")).read(schema)
    assert back.dtypes == [("id", "string"), ("amount", "double")] and [tuple(r) for r in back.collect()] == [("2", 1.0)]


def test_append_offers_a_row_once(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    writers.append_rows(rows.where("id = 1"), path)
    writers.append_new_rows(rows, "id", path)
    writers.append_new_rows(rows, "id", path)
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 2]


def test_workbook_has_one_folder_per_sheet(spark, tmp_path):
    frame = spark.createDataFrame([(1,)], "a int")
    made = writers.write_workbook({"one": frame, "two": frame}, str(tmp_path / "book"))
    assert sorted(made) == ["one", "two"]
    assert spark.read.option("header", True).csv(str(tmp_path / "book")).groupBy("sheet").count().count() == 2


class Fake:
    """A session seen only through its master and one setting."""

    def __init__(self, master, folder=None):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: folder or default)})


def test_shared_folder_follows_the_setting(spark):
    assert session.shared_dir(Fake("yarn", "hdfs://shared/ckpt/")) == "hdfs://shared/ckpt"
    assert session.fresh_dir(spark, "a") != session.fresh_dir(spark, "a")


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Fake("yarn"))


def test_json_that_cannot_be_read_is_told(spark):
    item = T.StructType([T.StructField("k", T.LongType()), T.StructField("name", T.StringType())])
    bodies = ['[{"k": 1, "name": "a"}, {"k": "x"}]', "[", "", '{"k": 2}', "[]", None, "[1, null]", "null"]
    rows, bad = readers.split_json(spark.createDataFrame(list(enumerate(bodies)), "id int, body string"), "body", item, ["id"])
    assert sorted(map(tuple, rows.collect()), key=str) == sorted([(0, 1, "a"), (0, None, None), (6, None, None), (6, None, None)], key=str)
    assert {(r["id"], r["body"], r["why"]) for r in bad.collect()} == {(1, "[", "malformed"), (2, "", "malformed"), (3, '{"k": 2}', "not a list"), (7, "null", "not a list")}


def test_fields_of_a_document_parsed_once(spark):
    from opsreports.functions.text import json_text, variant_text

    rows = spark.createDataFrame([('{"a": "x", "b": 1.5}',), ("{}",), ("broken",), (None,), ("",)], "d string")
    got = rows.withColumn("v", F.try_parse_json("d")).select(*[f(F.col(c), n).alias(f"{c}{n}") for n in "ab" for f, c in ((json_text, "d"), (variant_text, "v"))]).collect()
    assert all(r["da"] == r["va"] and r["db"] == r["vb"] for r in got) and got[0]["va"] == "x"


def test_sets_are_delivered_by_place_in_one_job(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.createDataFrame([(1, "A"), (2, "A"), (3, None), (4, "B c/d"), (5, "B c/d")], "id long, city string")
    sets = {"even": F.col("id") % 2 == 0, "small": F.col("id") < 4}
    shape = T.StructType.fromDDL("id long, set string, city string")
    read = lambda: sorted(tuple(r) for r in readers.read_delivered(spark, path, shape).collect())
    writers.deliver(rows, sets, path)
    want = sorted([(2, "even", "A"), (4, "even", "B c/d"), (1, "small", "A"), (2, "small", "A"), (3, "small", "NOCITY")])
    assert read() == want
    writers.deliver(rows, sets, path)
    assert read() == want
    # A later run with rows of one place replaces that place alone.
    writers.deliver(spark.createDataFrame([(8, "A")], "id long, city string"), sets, path)
    assert read() == sorted([(8, "even", "A"), *[w for w in want if w[1:] != ("even", "A")]])
