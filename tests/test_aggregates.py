import datetime as dt
from collections import Counter
from decimal import Decimal

from pyspark.sql import functions as F

from opsreports.functions.times import Window
from opsreports.operators import aggregates as agg


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_total_row_and_shares(spark):
    df = spark.createDataFrame([("x", "a", 1), ("x", "b", 3), ("y", "a", 0)], "city string, label string, n bigint")
    table = agg.share_of_column(agg.total_row(df, ["city"], "label", ["n"]), ["city"], "label", ["n"])
    assert rows(table.select("city", "label", "n", "n_pct")) == [
        ("x", "Total", 4, 0.0), ("x", "a", 1, 25.0), ("x", "b", 3, 75.0), ("y", "Total", 0, 0.0), ("y", "a", 0, 0.0)]


def test_total_row_keeps_a_null_label_apart(spark):
    df = spark.createDataFrame([("x", None, 2), ("x", "b", 3)], "city string, label string, n bigint")
    assert Counter(tuple(r) for r in agg.total_row(df, ["city"], "label", ["n"]).collect()) == Counter(
        [("x", None, 2), ("x", "b", 3), ("x", "Total", 5)])


def test_fixed_labels_are_completed_once(spark):
    df = spark.createDataFrame([("x", "a", 1), ("x", "other", 4), ("y", "b", 2)], "city string, label string, n bigint")
    assert rows(agg.with_all_labels(df, ["city"], {"label": ["a", "b"]})) == [
        ("x", "a", 1), ("x", "b", 0), ("x", "other", 4), ("y", "a", 0), ("y", "b", 2)]
    empty = df.where("n > 100").drop("city")
    assert rows(agg.with_all_labels(empty, [], {"label": ["a", "b"]})) == [("a", 0), ("b", 0)]


def test_crosstab_ignores_unlisted_values_but_keeps_their_row(spark):
    df = spark.createDataFrame([("r", "busy"), ("r", "odd"), ("s", "odd"), (None, "busy")], "a string, b string")
    out = agg.crosstab(df, ["a"], F.col("b"), {"busy": "busy", "failed": "failed"})
    assert Counter(tuple(r) for r in out.collect()) == Counter([("r", 1, 0), ("s", 0, 0), (None, 1, 0)])


def test_crosstab_has_no_row_limit(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("b"))
    assert agg.crosstab(df, ["a"], F.col("b"), {"x": "x"}).count() == 5000


def test_label_in_one_window_only(spark):
    d = dt.date
    df = spark.createDataFrame([("a", d(2024, 6, 1)), ("b", d(2024, 6, 14)), ("c", d(2024, 5, 1)), (None, d(2024, 6, 14))],
                               "label string, day date")
    windows = [Window("yesterday", d(2024, 6, 14), d(2024, 6, 14)), Window("month", d(2024, 6, 1), d(2024, 6, 14))]
    assert rows(agg.count_by_label_windows(df, "label", F.col("day"), windows)) == [("a", 0, 1), ("b", 1, 1)]


def test_concat_gives_all_values_sorted(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, None), (3, "x"), (3, None)], "k int, v string")
    assert rows(agg.concat_per_key(df, ["k"], "v", "t").where("t is not null")) == [(1, 0, "a,b,b"), (3, 0, "x")]
    assert agg.concat_per_key(df, ["k"], "v", "t").where("k = 2").first()["t"] is None
    assert rows(agg.concat_distinct_per_key(df, ["k"], "v", "t").where("k = 1")) == [(1, 0, "a,b")]


def test_a_large_group_comes_in_parts_and_whole(spark):
    items = [(1, f"n{i % 40}") for i in range(300)] + [(1, "same")] * 200 + [(2, "a"), (2, "b")]
    out = agg.concat_per_key(spark.createDataFrame(items, "k int, v string"), ["k"], "v", "t", part_size=50).collect()
    got = Counter((r["k"], v) for r in out for v in r["t"].split(","))
    assert got == Counter(items)
    for k in (1, 2):
        parts = [r["t"].split(",") for r in sorted(out, key=lambda r: r["part"]) if r["k"] == k]
        assert sum(parts, []) == sorted(v for q, v in items if q == k) and all(len(p) == 50 for p in parts[:-1])
    assert sorted(r["part"] for r in out if r["k"] == 1) == list(range(10)) and len([r for r in out if r["k"] == 2]) == 1


def test_incentive_rules(spark):
    items = [("met", "on", 2), ("met", "off", 2), ("short", "off", 3), ("none", "off", None), ("zero", "off", 0)]
    df = spark.createDataFrame(items, "agent string, kind string, target bigint")
    out = {r["agent"]: (r["achieved"], r["gap"], r["pay"]) for r in agg.incentive(df, ["agent"], F.col("kind") == "on", "target").collect()}
    assert out == {"met": (2, 0, 300), "short": (1, -2, 0), "none": (1, None, 0), "zero": (1, 1, 0)}


def test_coverage_counts_blank_names_as_missing(spark):
    df = spark.createDataFrame([("c", "x"), ("c", ""), ("c", None)], "city string, name string")
    assert rows(agg.coverage_pct(df, ["city"], "name")) == [("c", 3, 33.33)]


def test_workload_ignores_null_reason(spark):
    df = spark.createDataFrame([("s", "queue", "Confirmation Pending"), ("s", "a", "Confirmation Pending"), ("s", "a", None)],
                               "slot string, who string, why string")
    assert rows(agg.slot_workload(df, ["slot"], "who", "why", "queue")) == [("s", 1, 1, 2, 0.12)]


def test_balance_of_a_wallet(spark):
    d = dt.date
    items = [(1, "C", Decimal("10.00"), d(2024, 6, 15)), (1, "C", Decimal("5.00"), d(2024, 6, 14)), (1, "D", Decimal("3.00"), None)]
    df = spark.createDataFrame(items, "k int, kind string, amount decimal(18,2), till date")
    out = agg.conditional_balance(df, "k", "kind", "amount", "till", d(2024, 6, 15), "C", "D").collect()
    assert float(out[0]["balance"]) == 7.0


def test_regions_send_unknown_cities_to_the_third(spark, column):
    cities = [("Bangalore",), ("Delhi",), (None,)]
    assert column(cities, "c string", agg.region_of(F.col("c"), {"Bangalore": "BLR"}, "NORTH")) == ["BLR", "NORTH", "NORTH"]


def test_bucket_averages_have_a_zero_guard(spark):
    d = dt.date
    df = spark.createDataFrame([("x", "b", d(2024, 6, 3), 10.0), ("x", "b", d(2024, 6, 4), 5.0), ("x", None, d(2024, 6, 4), 9.0)],
                               "city string, bucket string, day date, fee double")
    windows = [Window("w0", d(2024, 6, 3), d(2024, 6, 9)), Window("w1", d(2024, 5, 27), d(2024, 6, 2))]
    sums = agg.bucket_window_sums(df, ["city"], "bucket", F.col("day"), F.col("fee"), windows)
    out = agg.averages(sums, ["w0", "w1"]).select("bucket", "w0_n", "w0_avg", "w1_n", "w1_avg")
    assert rows(out) == [("b", 2, 7.5, 0, 0.0)]
