"""Published versions, appended batches, day sums and first rows: repeated, late and interrupted runs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F, types as T

from opsreports.functions.times import Window
from opsreports.sources import stores

PAIR = T.StructType().add("id", T.LongType()).add("v", T.StringType())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_job_killed_before_the_pointer_leaves_the_old_rows(spark, tmp_path):
    table = stores.Published(spark, str(tmp_path / "t"))
    assert table.read(PAIR).collect() == []
    table.publish(spark.createDataFrame([(1, "old")], PAIR))
    broken = spark.createDataFrame([(2, "new"), (3, "x")], PAIR).withColumn("v", F.when(F.col("id") == 3, F.raise_error(F.lit("killed"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="killed"):
        table.publish(broken)
    assert [tuple(r) for r in table.read(PAIR).collect()] == [(1, "old")]
    held = table.read(PAIR)
    table.publish(spark.createDataFrame([(2, "new")], PAIR))
    assert [tuple(r) for r in table.read(PAIR).collect()] == [(2, "new")] and [tuple(r) for r in held.collect()] == [(1, "old")]
    assert table.retire(dt.datetime(2000, 1, 1)) == []
    assert len(table.retire(dt.datetime(2200, 1, 1))) == 1 and table.retire(dt.datetime(2200, 1, 1)) == []
    assert [tuple(r) for r in table.read(PAIR).collect()] == [(2, "new")]


def test_batches_leave_each_key_once_and_read_only_files_that_may_hold_one(spark, tmp_path):
    table = stores.Appended(spark, str(tmp_path / "t"), "id", PAIR)
    rows = lambda ids, v: spark.createDataFrame([(i, v) for i in ids], PAIR)
    assert table.append(rows(range(100), "a"), "a") and table.append(rows(range(1000, 1100), "b"), "b")
    assert table.append(rows([50, 150, 150, None], "c"), "c") and not table.append(rows([7000], "a"), "a")
    assert table.append(rows([], "d"), "d") and not table.append(rows([1], "d"), "d")
    got = {r["id"]: r["v"] for r in table.read().collect()}
    assert got == {**{i: "a" for i in range(100)}, **{i: "b" for i in range(1000, 1100)}, 150: "c"} and table.read().count() == len(got)
    assert len(table.candidates(rows([50], ""))) == 1 and len(table.candidates(rows([50, 1050], ""))) == 2
    # In the range of a batch's keys, but not among its hashes.
    table.append(rows([5000, 9000], "e"), "e")
    assert table.candidates(rows([7003], "")) == [] and table.candidates(rows([], "")) == []


def brute(facts, windows):
    out = {}
    for key, day, cents in facts:
        for w in windows:
            if day is not None and w.start <= day <= w.end:
                n, c = out.get((key, w.name), (0, 0))
                out[key, w.name] = n + 1, c + (cents or 0)
    return out


def test_day_sums_equal_recomputation(spark, tmp_path):
    rng = random.Random(3)
    start = dt.date(2024, 5, 1)
    made = lambda n: [(rng.choice(["x", "y", None]), start + dt.timedelta(days=rng.randrange(40)), rng.randrange(1000)) for _ in range(n)]
    frame = lambda rows: spark.createDataFrame(rows, "key string, day date, cents bigint")
    windows = [Window("d1", dt.date(2024, 5, 20), dt.date(2024, 5, 20)), Window("mtd", dt.date(2024, 5, 1), dt.date(2024, 5, 21)), Window("all", start, start + dt.timedelta(days=60))]
    store = stores.DaySums(spark, str(tmp_path / "t"), {"key": "string"}, ["cents"])
    measures = {"cents": F.col("cents")}

    def same(facts):
        want = brute(facts, windows)
        rows = store.windows(["key"], windows).collect()
        assert {(r["key"], w.name): (r[f"{w.name}_n"], r[f"{w.name}_cents"]) for r in rows for w in windows if r[f"{w.name}_n"]} == want

    same([])
    facts = made(300)
    store.load(frame(facts + [("x", None, 5)]), F.col("day"), measures)
    same(facts)
    late = made(40)
    assert store.merge(frame(late), F.col("day"), measures, "late") and not store.merge(frame(late), F.col("day"), measures, "late")
    facts += late
    same(facts)
    # Facts of one day are corrected, of another all withdrawn.
    one, two = dt.date(2024, 5, 20), dt.date(2024, 5, 3)
    facts = [(k, d, c + 1 if d == one else c) for k, d, c in facts if d != two]
    store.rewrite(frame(facts), F.col("day"), measures, [one, two])
    same(facts)


def test_facts_of_other_days_are_not_read(spark, tmp_path):
    start = dt.date(2024, 5, 1)
    rows = [("x", start + dt.timedelta(days=i // 100), i) for i in range(3000)]
    frame = spark.createDataFrame(rows, "key string, day date, cents bigint").repartitionByRange(10, "day").sortWithinPartitions("day")
    frame.write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    store = stores.DaySums(spark, str(tmp_path / "t"), {"key": "string"}, ["cents"])
    own = facts.where(F.col("day").between(dt.date(2024, 5, 20), dt.date(2024, 5, 20)) & F.col("day").isin(dt.date(2024, 5, 20)))
    part = store.partial(own, F.col("day"), {"cents": F.col("cents")})
    pushed = plan(part).split("PushedFilters: [")[1].split("]")[0]
    assert "EqualTo(day,2024-05-20)" in pushed
    store.load(facts, F.col("day"), {"cents": F.col("cents")})
    store.rewrite(facts, F.col("day"), {"cents": F.col("cents")}, [dt.date(2024, 5, 20)])
    days = store.entries().where("number = 2").select("day").collect()
    assert [r["day"] for r in days] == [dt.date(2024, 5, 20)] and store.rows(start, dt.date(2024, 6, 30)).count() == 30


def test_first_rows_by_slices_in_any_order(spark, tmp_path):
    rng = random.Random(8)
    rows = [(rng.choice([None, *range(30)]), i, f"v{i}") for i in rng.sample(range(1000), 400)]
    shape = T.StructType.fromDDL("k bigint, at bigint, v string")
    want = {}
    for k, at, v in sorted(rows, key=lambda r: r[1]):
        if k is not None:
            want.setdefault(k, (at, v))
    slices = [rows[i::5] for i in range(5)]
    for turn, order in enumerate(([0, 1, 2, 3, 4], [3, 3, 0, 4, 1, 2, 0])):
        state = stores.FirstRows(spark, str(tmp_path / f"s{turn}"), shape, "k", ["at"])
        assert state.read().collect() == []
        for i in order:
            state.update(spark.createDataFrame(slices[i], shape))
        assert {r["k"]: (r["at"], r["v"]) for r in state.read().collect()} == want


def test_a_slice_meets_the_state_without_its_being_shuffled(spark, tmp_path):
    shape = T.StructType.fromDDL("k bigint, at bigint")
    state = stores.FirstRows(spark, str(tmp_path / "s"), shape, "k", ["at"])
    state.update(spark.range(10_000).select(F.col("id").alias("k"), F.col("id").alias("at")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(state.merged(spark.createDataFrame([(5, 1)], shape)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # What is shuffled is the slice, never what stands on the bucketed table.
    above = text[text.index("SortMergeJoin"): text.index("Bucketed: true")]
    assert "first_rows_" in above and "Exchange" not in above
