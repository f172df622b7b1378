import datetime as dt

import pytest
from pyspark.sql import functions as F

from opsreports.checks import QUERIES
from opsreports.functions import labels, money, text, times
from opsreports.operators import filters


def values(column, items, kind, expression):
    return column([(x,) for x in items], f"x {kind}", expression(F.col("x")))


def test_phone_lengths(column):
    numbers = ["123456789", "1234567890", "01234567890", "911234567890", "+911234567890", "00911234567890", "000911234567890", None]
    assert values(column, numbers, "string", text.phone_local) == [
        "123456789", "1234567890", "1234567890", "1234567890", "1234567890", "1234567890", "000911234567890", None,
    ]


def test_message_direction(column):
    senders = ["me@desk.example", "AUTO", "", None, "919999999999"]
    made = values(column, senders, "string", lambda c: text.message_direction(c, "@desk.example", ["AUTO", ""]))
    assert made == ["OUTBOUND", "OUTBOUND", "OUTBOUND", "OUTBOUND", "INBOUND"]


def test_name_from_email(column):
    mails = ["jO.Hn@x.example", "NOT_ASSIGNED", "", None, "plain"]
    assert values(column, mails, "string", text.name_from_email) == ["Jo.hn", "NOT_ASSIGNED", "", None, "plain"]


def test_name_from_email_at_its_edges(column):
    mails = ["@x", "@", "a@", "a@b@c", "\u00e4B@x", "\u00dfA@x", "\u00c4\u00d6", "\U0001f600AB@x", "x" * 70_000 + "Y@x", "Y" * 70_000, " A@"]
    made = values(column, mails, "string", text.name_from_email)
    cut = [m.split("@")[0] for m in mails]
    assert made == [m if "@" not in m else c[:1].upper() + c[1:].lower() for m, c in zip(mails, cut)]


def test_name_from_email_cuts_a_mail_once(spark, capsys):
    mail = F.concat(F.repeat(F.col("id").cast("string"), 9), F.lit("@x.example"))
    spark.range(9).select(F.sha2(text.name_from_email(mail), 256)).explain("codegen")
    assert capsys.readouterr().out.count("SubstringIndex.exec") == 1


def test_mails_of_one_file_are_spread(spark, tmp_path):
    rows = 20_000
    spark.range(0, rows, 1, 1).selectExpr(
        "id AS c_custkey", "concat('Customer#', id) AS c_name", "IF(id % 2 = 0, 'MACHINERY', null) AS c_mktsegment"
    ).write.parquet(str(tmp_path / "customer.parquet"))
    dealt = QUERIES["h06_name_from_email"](spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    sizes = [r["count"] for r in dealt]
    assert len(sizes) == 3 and sum(sizes) == rows and max(sizes) < 8_000


def test_comment_flattening(column):
    notes = ["a\nb", "a\\nb", "", "null", "{}", None, "plain"]
    assert values(column, notes, "string", text.flatten_comment) == ["a,b", "a,b", "", "", "", "", "plain"]


def test_day_suffixes(column):
    made = values(column, list(range(1, 32)), "int", text.day_with_suffix)
    assert made[:4] == ["1st", "2nd", "3rd", "4th"] and made[10:13] == ["11th", "12th", "13th"]
    assert made[20:24] == ["21st", "22nd", "23rd", "24th"] and made[29:] == ["30th", "31st"]


def test_json_fields(column):
    docs = ['{"a": "x"}', '{"b": 1}', '{"a": null}', '{"a": [1, 2]}', "{}", "null", "", None]
    assert values(column, docs, "string", lambda c: text.json_text(c, "a")) == ["x", "", "", "[1,2]", "", "", "", ""]


@pytest.mark.parametrize("attempts,answered,stage", [
    (0, "true", "Patient_eligible_for_calling"), (1, "true", "Patient_Responded"), (1, "false", "1st stage"),
    (2, "true", "Patient_Responded"), (2, None, "2nd stage"), (3, "true", "Patient_Responded"),
    (3, "false", "Patient_eligible_for_calling"), (4, "true", "Patient_eligible_for_calling"),
])
def test_response_stages(column, attempts, answered, stage):
    listed = "[" + ",".join(['"10:00"'] * attempts) + "]"
    made = column([(listed, answered)], "t string, r string", text.response_stage(F.col("t"), F.col("r")))
    assert made == [stage]


def test_slot_labels(column):
    typed = ["9:00-10:00", "09:00-10:00", "900-1000", "1300-1400", "0:00-1:00", "12:00-13:00", "23:00-24:00",
             "9AM-10AM", "None", None, "junk"]
    assert values(column, typed, "string", times.slot_label) == [
        "9AM-10AM", "9AM-10AM", "9AM-10AM", "1PM-2PM", "12AM-1AM", "12PM-1PM", "11PM-12AM", "9AM-10AM", "None", None, None,
    ]
    padded = values(column, typed, "string", lambda c: times.slot_label(c, padded=True))
    assert padded[:6] == ["09AM-10AM", "09AM-10AM", "09AM-10AM", "01PM-02PM", "12AM-01AM", "12PM-01PM"]
    assert padded[7] == "09AM-10AM"


def test_slot_order(column):
    slots = ["12AM-1AM", "1AM-2AM", "01AM-02AM", "12PM-1PM", "11PM-12AM", "None", "later", None]
    assert values(column, slots, "string", times.slot_ordinal) == [0, 1, 1, 12, 23, 24, None, None]


FEES = [(0.0, "WALLET", False), (0.0, "CASH", True), (0.0, "CASH", False), (0.0, None, False), (1.0, None, False),
        (100.0, None, False), (100.5, None, False), (101.0, None, False), (400.0, None, False), (401.0, None, False),
        (None, None, False)]


def test_fee_buckets(column):
    made = column(FEES, "f double, m string, c boolean", labels.fee_bucket(F.col("f"), F.col("m"), F.col("c"), "WALLET"))
    assert made == ["WALLET", "Privilege Card", "0", "0", "1-100", "1-100", "101-200", "101-200", "301-400", ">400", None]


def test_city_codes(column):
    rows = [("Chandigarh", None), (None, "Bangalore"), ("Jaipur", "Bangalore"), (None, None)]
    assert column(rows, "a string, b string", labels.city_code(F.col("a"), F.col("b"))) == ["CHD", "BLR", "Jaipur", "No City"]


def test_code_labels(column):
    codes = ["3", "9", "", None]
    assert values(column, codes, "string", lambda c: labels.code_to_label(c, labels.LEAD_STATUS)) == ["CANCELLED", "NA", None, None]
    with pytest.raises(Exception, match="unknown code: 9"):
        values(column, codes, "string", lambda c: labels.code_to_label_strict(c, labels.LEAD_STATUS))


def test_bands_and_ages(column):
    rows = [(0.0, 3), (0.0, 0), (49.99, 5), (50.0, 5), (69.99, 5), (70.0, 5)]
    assert column(rows, "p double, n int", labels.threshold_band(F.col("p"), F.col("n"))) == [
        "red", "none", "red", "pale", "pale", "none"]
    assert values(column, [600.0, 600.5, 3600.0, 36000.0, 36001.0], "double", labels.age_bucket) == [
        "less than 10_Mins", "10 - 30_Mins", "30 - 60_Mins", "2 - 10_hours", "more than 10_hours"]


def test_ratios(column):
    assert column([(1, 3), (1, 0), (1, 8), (3, 8)], "a int, b int", money.pct2(F.col("a"), F.col("b"))) == [33.33, 0.0, 12.5, 37.5]
    rows = [("0.01", 2), ("0.03", 2), ("10.00", 3), ("5.00", 0)]
    made = column(rows, "t string, n int", money.avg2(F.col("t").cast("decimal(18,2)"), F.col("n")))
    assert made == [0.0, 0.02, 3.33, 0.0]


def test_amounts(column):
    assert values(column, [1234567.89, 0.0, None, 999.0], "double", money.format_amount) == ["1,234,567", "0", "0", "999"]
    assert [float(x) for x in values(column, [12345, 100], "bigint", money.minor_to_major)] == [123.45, 1.0]


@pytest.mark.parametrize("as_of,month,last,week", [
    (dt.date(2024, 1, 1), ("2023-12-01", "2023-12-31"), ("2023-11-01", "2023-11-30"), ("2024-01-01", "2023-12-31")),
    (dt.date(2024, 6, 17), ("2024-06-01", "2024-06-16"), ("2024-05-01", "2024-05-31"), ("2024-06-17", "2024-06-16")),
    (dt.date(2024, 6, 16), ("2024-06-01", "2024-06-15"), ("2024-05-01", "2024-05-31"), ("2024-06-10", "2024-06-15")),
    (dt.date(2024, 2, 29), ("2024-02-01", "2024-02-28"), ("2024-01-01", "2024-01-31"), ("2024-02-26", "2024-02-28")),
])
def test_calendar_windows(as_of, month, last, week):
    known = {w.name: (w.start.isoformat(), w.end.isoformat()) for w in times.calendar_windows(as_of)}
    assert (known["month_to_date"], known["last_month"], known["this_week"]) == (month, last, week)


def test_weeks_over_new_year(column):
    days = [dt.date(year, 12, 29) + dt.timedelta(days=n) for year in range(2015, 2026) for n in range(8)]
    assert values(column, days, "date", times.sunday_week) == [int(d.strftime("%U")) for d in days]
    assert values(column, days, "date", F.weekofyear) == [d.isocalendar()[1] for d in days]
    assert values(column, days, "date", times.iso_year) == [d.isocalendar()[0] for d in days]


def test_null_comparison_follows_the_frame_rule(column):
    cells = ["a", "b", None]
    assert values(column, cells, "string", lambda c: filters.differs(c, "a")) == [False, True, True]
    assert values(column, cells, "string", lambda c: filters.not_among(c, "a", "c")) == [False, True, True]
    assert values(column, ["", None, " "], "string", filters.non_blank) == [False, False, True]
    pair = filters.not_pair(F.col("x"), "a", F.col("x"), "a")
    assert values(column, cells, "string", lambda c: pair) == [False, True, True]


def test_time_windows_at_their_edges(column):
    noon = dt.datetime(2024, 6, 1, 12, 30)
    minute = dt.timedelta(minutes=1)
    stamps = [noon - 30 * minute, noon - 20 * minute, noon - 2 * minute, noon]
    trailing = lambda c: filters.trailing_window(c, noon, 30 * minute, 20 * minute)
    assert values(column, stamps, "timestamp_ntz", trailing) == [True, False, False, False]
    assert values(column, stamps, "timestamp_ntz", lambda c: filters.within_last(c, noon, 2 * minute)) == [False, False, False, True]
    hours = [dt.datetime(2024, 6, 1, 11), dt.datetime(2024, 6, 1, 11, 59, 59), dt.datetime(2024, 6, 1, 12)]
    assert values(column, hours, "timestamp_ntz", lambda c: filters.previous_hour(c, noon)) == [True, True, False]
    local = [dt.datetime(2024, 5, 31, 18, 30), dt.datetime(2024, 5, 31, 18, 29, 59), dt.datetime(2024, 6, 1, 18, 29, 59)]
    one = dt.date(2024, 6, 1)
    assert values(column, local, "timestamp_ntz", lambda c: filters.between_local_dates(c, one, one)) == [True, False, True]
    old = [noon - dt.timedelta(days=1), noon - dt.timedelta(hours=23)]
    assert values(column, old, "timestamp_ntz", lambda c: filters.min_age_days(c, noon)) == [True, False]
