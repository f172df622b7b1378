import random

from pyspark.sql import functions as F

from opsreports.operators.running import id_block, ordered_position, running_total
from opsreports.operators.sequences import rank_average, serial_number


def test_running_total_with_one_hot_key_equals_a_plain_sum(spark):
    rng = random.Random(1)
    rows = [(rng.choice([1, 1, 1, 2, 3]), rng.randint(0, 30), i * 7, rng.randint(-5, 9)) for i in range(900)]
    df = spark.createDataFrame(rows, "k bigint, d bigint, id bigint, v bigint").repartition(4)
    out = running_total(df, ["k"], [F.floor(F.col("d") / 10), F.col("d"), id_block("id", 64)], ["d", "id"], F.col("v"), "t")
    seen, expected = {}, {}
    for k, day, i, v in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        seen[k] = seen.get(k, 0) + v
        expected[i] = seen[k]
    assert {r["id"]: r["t"] for r in out.collect()} == expected


def test_serial_numbers_have_no_gaps(spark):
    ids = random.Random(2).sample(range(1 << 62), 500)
    df = spark.createDataFrame([(i,) for i in ids], "id bigint").repartition(4)
    got = {r["id"]: r["serial"] for r in serial_number(df, "id").collect()}
    assert got == {i: n for n, i in enumerate(sorted(ids), 1)}


def test_positions_within_hot_and_sparse_keys(spark):
    rows = [(k, i * 7_919_191_919 % (1 << 62), None if k == 3 else "x") for k in (1, 2, 3) for i in range(2000 if k == 1 else 20)] + [(None, 5, "y")]
    df = spark.createDataFrame(rows, "k bigint, id bigint, v string").repartition(6)
    got = sorted((r["k"] or 0, r["id"], r["position"], r["v"]) for r in ordered_position(df, ["k"], ["id"]).collect())
    want = []
    for k in (0, 1, 2, 3):
        own = sorted((i, v) for q, i, v in rows if (q or 0) == k)
        want += [(k, i, n, v) for n, (i, v) in enumerate(own, 1)]
    assert got == want


def test_ties_share_the_mean_rank(spark):
    values = [(1, 10), (1, 20), (1, 20), (1, 30), (1, 30), (1, 30), (2, 5)]
    df = spark.createDataFrame(values, "k bigint, v bigint")
    out = rank_average(df, "k", "v")
    assert sorted((r["k"], r["v"], float(r["rank"])) for r in out.collect()) == [
        (1, 10, 1.0), (1, 20, 2.5), (1, 20, 2.5), (1, 30, 5.0), (1, 30, 5.0), (1, 30, 5.0), (2, 5, 1.0),
    ]
