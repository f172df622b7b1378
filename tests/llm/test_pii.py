"""Pseudonyms keep their format, are permutations, and leave what doesn't hold."""

import datetime as dt
import re

from pyspark.sql import functions as F

from opsreports.llm import pii

KEY = "test"


def change(spark, values):
    rows = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")
    return [r["text"] for r in pii.pseudonymise(rows, KEY).orderBy("doc_id").collect()]


def luhn(digits):
    d = [int(c) for c in digits][::-1]
    return sum(d[::2] + [x * 2 - 9 * (x > 4) for x in d[1::2]]) % 10 == 0


def mod97(text):
    return int("".join(str(int(c, 36)) for c in text)) % 97


def test_formats(spark):
    values = ["4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1111", "DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "2001-02-28", "31.12.1999",
              "12/31/1999", "10.1.2.3", "219-09-9999", "+1 (017) 555-7713", "(212) 555-0123", "a.b-c@mail7.example.com"]
    new = change(spark, [f"x, {v}; y" for v in values])
    out = [re.fullmatch(r"x, (.*); y", t, re.S)[1] for t in new]
    assert all(a != b for a, b in zip(values, out, strict=True))
    same = lambda a, b: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "9", a))) == re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "9", b)))
    assert all(same(a, b) for a, b in zip(values, out, strict=True) if a != "10.1.2.3")
    digits = [re.sub(r"\D", "", o) for o in out]
    assert digits[0] == digits[1] == digits[2] and luhn(digits[0])
    plain = [o.replace(" ", "") for o in out[3:5]]
    assert plain[0] == plain[1] and mod97(plain[0][4:] + plain[0][:4]) == 1
    assert 1900 <= dt.date.fromisoformat(out[5]).year <= 2099
    assert dt.datetime.strptime(out[6], "%d.%m.%Y").date() == dt.datetime.strptime(out[7], "%m/%d/%Y").date()
    assert all(int(x) <= 255 for x in out[8].split("."))
    assert out[12].endswith(".com")


def test_what_does_not_hold_stays(spark):
    values = ["4111111111111112", "2001-02-30", "99.99.1999", "300.1.2.3", "000-12-3456", "DE00370400440532013000", "1.2.3", "no data at all", "", None, "12345", "v1.2.3.4.5",
              "a" * 200_000 + "@", "1-2-3 " * 1000]
    assert change(spark, values) == values


def test_ibans_end_where_their_country_says(spark):
    ibans = ["ES9121000418450200051332", "BE68539007547034", "AT61 1904 3002 3457 3201", "NO9386011117947", "PL61109010140000071219812874", "FR1420041010050500013M02606", "DE89 3704 0044 0532 0130 00"]
    tails = ["", " EUR 500", " A note", " 2024", " 12", " IT", "."]
    cases = [(v, t) for v in ibans for t in tails]
    for (v, t), new in zip(cases, change(spark, [v + t for v, t in cases]), strict=True):
        plain = new[: len(v)].replace(" ", "")
        assert new[: len(v)] != v and new[len(v) :] == t and mod97(plain[4:] + plain[:4]) == 1, (v, t, new)


def test_addresses_of_single_digits(spark):
    values = ["8.8.8.8", "at 1.2.3.4, x"]
    first, second = change(spark, values)
    assert first != values[0] and second != values[1] and re.fullmatch(r"at [\d.]+, x", second)


def test_permutations_are_one_to_one(spark):
    numbers = spark.range(17 * 43).select(pii.permute_number(F.col("id"), (17, 43), KEY, "t").alias("x"))
    assert sorted(r["x"] for r in numbers.collect()) == list(range(17 * 43))
    texts = spark.range(1000).select(pii.permute_text(F.lpad(F.col("id").cast("string"), 3, "0"), KEY, "t").alias("x"))
    assert len({r["x"] for r in texts.collect()}) == 1000


def test_equal_values_stay_linked_and_keys_matter(spark):
    rows = spark.createDataFrame([(1, "mail 34@mail7.example.com!"), (2, "\n34@mail7.example.com and 34@mail7.example.com")], "doc_id long, text string")
    find = lambda key: {m for r in pii.pseudonymise(rows, key).collect() for m in re.findall(r"\S+@[\w.]+", r["text"])}
    assert len(find("a")) == 1 and find("a") != find("b")


def test_columns_stay(spark, docs, nothing):
    out = pii.pseudonymise(docs, KEY, count_col="n_shingles")
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.where("text IS NULL").count() == docs.where("text IS NULL").count()
    assert pii.pseudonymise(nothing, KEY).collect() == []


def test_very_long_values_of_every_kind(spark):
    """Patterns without unbounded recursion: nothing here ends the session, and what is too long to be valid stays."""
    rows = ["x@" + "a." * 100_000 + "com 12", "q@" + ("a" * 62 + ".") * 3_000 + "com 12", "a@" + "b" * 300_000 + ".com 12", "DE89 " + "3704 " * 50_000,
            "1" * 200_000 + "-2024-01-01", "1.2" * 100_000, "4111 " * 50_000, "123-45-" * 50_000, "+1" + " 22" * 100_000, "(1" * 100_000 + "12"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.pseudonymise(df, "key").select("doc_id", "text").collect()}
    assert all(len(got[i]) == len(t) for i, t in enumerate(rows)) and all(got[i] == rows[i] for i in (0, 1, 2))
