from pyspark.sql import functions as F

from opsreports.operators import sequences as seq


def test_first_row_per_key(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 3, "a"), (1, 3, "c"), (2, 9, "d")], "k int, n int, v string")
    out = seq.first_per_key(df, ["k"], ["n", F.col("v").desc()]).collect()
    assert {(r["k"], r["v"]) for r in out} == {(1, "c"), (2, "d")}


VISITS = [
    # patient, visit, trigger, follow
    (1, 10, True, True), (1, 11, False, False), (1, 12, False, True), (1, 13, True, True),
    (2, 20, False, True), (2, 21, True, True),
    (3, 30, True, True), (3, 31, True, True),
    (4, 40, False, True),
]


def test_pairs(spark):
    df = spark.createDataFrame(VISITS, "p int, v int, t boolean, f boolean")
    out = seq.followup_pair(df, "p", "v", F.col("t"), F.col("f"), []).collect()
    assert {(r["p"], r["first_v"], r["second_v"]) for r in out} == {(1, 10, 12), (2, 21, None), (3, 30, 31)}


def test_new_is_decided_before_the_place_is_picked(spark):
    df = spark.createDataFrame([(1, 1, "home"), (1, 2, "clinic"), (2, 3, "clinic"), (2, 4, "home")], "p int, v int, place string")
    out = seq.new_or_existing(df, "p", "v", F.col("place") == "home").collect()
    assert {r["v"]: r["patient_type"] for r in out} == {1: "New Patient", 4: "Existing patient"}


def test_latest_reason(spark):
    rows = [(1, 1, "old, x"), (1, 2, "busy, call later"), (2, 1, "text"), (2, 2, None), (3, 1, "no comma")]
    df = spark.createDataFrame(rows, "k int, i int, c string")
    assert {r["k"]: r["reason"] for r in seq.latest_reason(df, "k", "c", "i").collect()} == {1: "busy", 2: "", 3: "no comma"}


def test_first_user_may_be_null(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, None), (2, 7, "c")], "k int, i int, u string")
    assert {r["k"]: r["first_user"] for r in seq.first_event_user(df, "k", "u", "i").collect()} == {1: None, 2: "c"}


def history(rows, heading):
    return heading + "".join(f"{stamp} : {text} \n" for _, stamp, text in sorted(rows) if text)


def test_history_in_parts_is_the_whole_history(spark):
    heading = seq.HISTORY_HEADING["CASE"]
    large = [(i * 3 + 1000, f"d{i}", f"note {i}" if i % 7 else "") for i in range(200)]
    small = [(1, "d1", "first"), (90_000, None, "second")]
    df = spark.createDataFrame([(1, *r) for r in large] + [(2, *r) for r in small], "lead int, id bigint, d string, t string")
    out = seq.comment_history(df, "lead", "id", F.col("d"), "t", heading, part_size=50).orderBy("lead", "part").collect()
    whole = {}
    for r in out:
        whole[r["lead"]] = whole.get(r["lead"], "") + r["history"]
    assert whole[1] == history(large, heading)
    assert whole[2] == heading + "d1 : first \n : second \n"
    assert [r["part"] for r in out if r["lead"] == 1] == list(range(4)) and len([r for r in out if r["lead"] == 2]) == 1
