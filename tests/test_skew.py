"""A third of all rows under one key: results stay whole, and no task gets them all."""

import contextlib

import pytest
from pyspark.sql import functions as F

from opsreports.operators import joins, sequences as seq
from opsreports.operators.aggregates import concat_per_key
from opsreports.operators.ledger import ledger_balances, ledger_no_expiry
import datetime as dt

N = 60_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.shuffle.partitions": "16",
}


@contextlib.contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def facts(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("facts") / "rows")
    rows = spark.range(N).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(5000))).alias("k"),
        F.concat(F.lit("text "), F.sha1(F.col("id").cast("string"))).alias("v"),
    )
    rows.repartition(8).write.parquet(path)
    return spark.read.parquet(path)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name,build", [
    ("lookup", lambda f: joins.lookup_first(f, "k", f.where("id % 2 = 1"), "k", {"v": "first"}, ["id"])),
    ("flag", lambda f: joins.flag_known(f, "k", f.where("id % 2 = 1"), "k", "known")),
    ("semi", lambda f: joins.keep_known(f, "k", f.where("id % 2 = 1"), "k")),
    ("anti", lambda f: joins.drop_known(f, "k", f.where("k > 100"), "k")),
])
def test_hot_key_of_a_join_is_split(spark, facts, name, build):
    with settings(spark, SETTINGS):
        rows, plan = final_plan(build(facts))
    assert "skew=true" in plan
    if name in ("lookup", "flag"):
        assert len(rows) == N


def test_hot_key_in_parts_is_whole(spark, facts):
    out = concat_per_key(facts, ["k"], "v", "t", part_size=1000).where("k = 7").select(F.explode(F.split("t", ",")).alias("v"))
    hot = facts.where("k = 7")
    assert out.count() == hot.count() and out.exceptAll(hot.select("v")).count() == 0
    lines = seq.comment_history(facts, "k", "id", F.col("id"), "v", "", part_size=1000).where("k = 7")
    assert lines.count() > 15
    assert lines.select(F.sum(F.length("history"))).first()[0] == hot.select(
        F.sum(F.length(F.col("id").cast("string")) + 5 + F.length("v"))).first()[0]


def test_hot_wallet_matches_the_plain_window(spark, facts):
    entries = facts.select(
        "id", "k", F.when(F.col("id") % 5 < 2, "D").otherwise("C").alias("kind"),
        (F.pmod(F.xxhash64("id", "k"), F.lit(9000)) / 100).cast("decimal(18,2)").alias("amount"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.xxhash64("v"), F.lit(90)).cast("int")).alias("created"),
        F.lit("2030-01-01").cast("date").alias("end"),
    )
    names = {"id": "id", "customer": "k", "kind": "kind", "amount": "amount", "created": "created", "end": "end"}
    entries.createOrReplaceTempView("entries")
    plain = spark.sql("""
        WITH c AS (SELECT id, k, amount, sum(amount) OVER (PARTITION BY k ORDER BY created, id) AS cum FROM entries WHERE kind = 'C'),
             d AS (SELECT k, sum(amount) AS spent FROM entries WHERE kind = 'D' GROUP BY k)
        SELECT id, CAST(greatest(0, least(amount, cum - coalesce(spent, 0))) AS DECIMAL(18,2)) AS balance FROM c LEFT JOIN d USING (k)""")
    for out in (ledger_no_expiry(entries, names, "C", "D"), ledger_balances(entries, dt.date(2024, 6, 1), names, "C", "D")):
        mine = out.select("id", "balance")
        assert mine.count() == plain.count() and mine.exceptAll(plain).count() == 0
    spark.catalog.dropTempView("entries")
