from pyspark.sql import functions as F

from opsreports.operators import joins


def test_first_and_last_match_with_repeated_missing_and_null_keys(spark):
    facts = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k bigint")
    dim = spark.createDataFrame(
        [(1, "b", 2), (1, "a", 1), (1, "c", 3), (2, None, 1), (None, "x", 1)], "dk bigint, v string, n int"
    ).repartition(3)
    first = joins.lookup_first(facts, "k", dim, "dk", {"v": "v"}, ["n"])
    assert sorted((r["k"] or 0, r["v"]) for r in first.collect()) == [(0, ""), (1, "a"), (2, ""), (3, "")]
    last = joins.lookup_last(facts, "k", dim, "dk", {"v": "v"}, ["n"], default=None)
    assert sorted((r["k"] or 0, r["v"] or "-") for r in last.collect()) == [(0, "-"), (1, "c"), (2, "-"), (3, "-")]


def test_membership(spark):
    facts = spark.createDataFrame([(1,), (2,), (None,)], "k bigint")
    known = spark.createDataFrame([(1,), (1,), (1,), (None,)], "m bigint")
    assert [r["k"] for r in joins.keep_known(facts, "k", known, "m").collect()] == [1]
    assert {r["k"] for r in joins.drop_known(facts, "k", known, "m").collect()} == {2, None}
    flags = joins.flag_known(facts, "k", known, "m", "f").collect()
    assert {r["k"]: r["f"] for r in flags} == {1: "Yes", 2: "No", None: "No"} and len(flags) == 3


def test_class_priority(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    yes = spark.createDataFrame([("a",), ("a",)], "k string")
    no = spark.createDataFrame([("a",), ("b",)], "k string")
    out = joins.classify_membership(rows, "k", [("Yes", yes, "k"), ("No", no, "k")], "answer")
    assert {r["k"]: r["answer"] for r in out.collect()} == {"a": "Yes", "b": "No", "c": " ", None: " "}


def brute_template(message, templates):
    if message is None:
        return ""
    return next((name for name, text in templates if message.startswith(text[:5])), "")


def test_templates_by_their_opening(spark):
    cases = [
        [("one", "Hello there"), ("two", "Hello again"), ("three", "By")],
        [("short", "H"), ("long", "Hello")],
        [("late", "Helix"), ("empty", ""), ("never", "Hello")],
    ]
    messages = ["Hello you", "Helix", "By", "Bye", "H", "", None, "other"]
    for templates in cases:
        frame = spark.createDataFrame([(n, x, i) for i, (n, x) in enumerate(templates)], "name string, text string, ordinal bigint")
        df = spark.createDataFrame([(i, m) for i, m in enumerate(messages)], "i int, m string")
        out = {r["i"]: r["t"] for r in joins.match_template(df, "m", frame, "t").collect()}
        assert out == {i: brute_template(m, templates) for i, m in enumerate(messages)}


def test_members_at_home_elsewhere(spark):
    teams = spark.createDataFrame([(3, "a,b,c"), (4, "d")], "cityId int, list string")
    staff = spark.createDataFrame([("a", 3), ("b", 4), ("c", None), ("z", 9)], "email string, cityId int")
    out = joins.member_home_counts(teams, "cityId", "list", staff, "email", "cityId").collect()
    assert {r["cityId"]: (r["members"], r["other_city_members"]) for r in out} == {3: (3, 2), 4: (1, 0)}


def test_attach_twice_under_two_names(spark):
    facts = spark.createDataFrame([(1, 2), (2, None)], "a int, b int")
    city = spark.createDataFrame([(1, "x"), (2, "y")], "id int, name string")
    out = joins.attach(joins.attach(facts, city, {"a": "id"}, {"name": "first"}), city, {"b": "id"}, {"name": "second"})
    assert sorted((r["first"], r["second"]) for r in out.collect()) == [("x", "y"), ("y", None)]


def test_merged_counts(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "label string, n bigint")
    b = spark.createDataFrame([("y", 5), ("z", 7)], "label string, n bigint")
    out = joins.merge_counts(a, b, "label", ("day", "month")).collect()
    assert {r["label"]: (r["day"], r["month"]) for r in out} == {"x": (1, 0), "y": (2, 5), "z": (0, 7)}


def test_source_decides_the_lookup(spark):
    df = spark.createDataFrame([("A", "d", "f"), ("B", "d", "f"), ("B", "d", None)], "s string, d string, f string")
    out = joins.lookup_by_source(df, "s", ["A"], "d", "f", "o").select("o").collect()
    assert [r[0] for r in out] == ["d", "f", ""]


def test_slot_counts_default_to_zero(spark):
    slots = spark.createDataFrame([("x", "9AM-10AM"), ("x", "1PM-2PM")], "city string, slot string")
    counts = spark.createDataFrame([("x", "9AM-10AM", 4), ("y", "1PM-2PM", 9)], "city string, slot string, c bigint")
    out = joins.attach_slot_counts(slots, counts, ["city", "slot"], "c").collect()
    assert {r["slot"]: r["c"] for r in out} == {"9AM-10AM": 4, "1PM-2PM": 0}


def test_hot_key_keeps_every_row(spark):
    facts = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    dim = spark.range(30_000).select(F.col("id").alias("dk"), (F.col("id") * 2).alias("v"))
    out = joins.lookup_first(facts, "k", dim, "dk", {"v": "v"}, ["v"], default=None)
    assert out.count() == 30_000 and out.where(F.col("v") != F.col("k") * 2).count() == 0
