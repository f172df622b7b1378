"""H: scalar functions on the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from opsreports.checks.registry import AS_OF, Tables, half_even, query
from opsreports.functions import labels, money, text, times
from opsreports.operators.aggregates import in_window
from opsreports.operators.joins import lookup_first

DAY = "yyyy-MM-dd"
SECOND = "yyyy-MM-dd HH:mm:ss"
# Customers of a task of h06: with the long ones, about 80 MB of mail addresses.
MAILS_A_TASK = 1 << 13


@query(
    "h01_blank_to_null",
    """SELECT doc_id, CASE WHEN source IN ('src0', 'src1') THEN NULL
              ELSE source END AS source_or_null FROM documents""",
)
def blank_to_null(t: Tables) -> DataFrame:
    blank = F.when(F.col("source") == "src0", "").when(F.col("source") == "src1", "null").otherwise(F.col("source"))
    return t.documents.select("doc_id", text.blank_to_null(blank).alias("source_or_null"))


@query(
    "h02_phone_local",
    """WITH n AS (SELECT c_custkey, lpad(c_custkey::VARCHAR, 8 + (c_custkey % 8)::INT, '9') AS number FROM customer)
       SELECT c_custkey, CASE WHEN length(number) BETWEEN 11 AND 14 THEN right(number, 10)
              ELSE number END AS local_number FROM n""",
)
def phone_local(t: Tables) -> DataFrame:
    """Numbers of 8 to 15 digits."""
    number = F.lpad(F.col("c_custkey").cast("string"), (8 + F.col("c_custkey") % 8).cast("int"), F.lit("9"))
    return t.customer.select("c_custkey", text.phone_local(number).alias("local_number"))


@query(
    "h03_message_direction",
    """SELECT conv_id, turn, CASE WHEN role = 'assistant' OR role = 'system' THEN 'OUTBOUND'
              ELSE 'INBOUND' END AS direction FROM conversations""",
)
def message_direction(t: Tables) -> DataFrame:
    sender = F.concat("role", F.when(F.col("role") == "assistant", "@desk.example").otherwise(""))
    made = text.message_direction(sender, "@desk.example", ["system"])
    return t.conversations.select("conv_id", "turn", made.alias("direction"))


@query(
    "h04_message_customer_number",
    """SELECT conv_id, turn, right(CASE WHEN role = 'user' THEN '91' || lpad(conv_id::VARCHAR, 10, '0')
              ELSE '91' || lpad(turn::VARCHAR, 10, '7') END, 10) AS customer_number FROM conversations""",
)
def message_customer_number(t: Tables) -> DataFrame:
    conv = F.concat(F.lit("91"), F.lpad(F.col("conv_id").cast("string"), 10, "0"))
    turn = F.concat(F.lit("91"), F.lpad(F.col("turn").cast("string"), 10, "7"))
    sender = F.when(F.col("role") == "user", conv).otherwise(F.concat("role", F.lit("@desk.example")))
    made = text.message_customer_number(sender, turn, "@desk.example")
    return t.conversations.select("conv_id", "turn", made.alias("customer_number"))


@query(
    "h05_call_numbers",
    """WITH c AS (SELECT event_id, event_type, '0' || lpad(user_id::VARCHAR, 10, '0') AS a,
                         '91' || lpad(event_id::VARCHAR, 10, '0') AS b FROM events)
       SELECT event_id, right(CASE WHEN event_type = 'click' THEN a ELSE b END, 10) AS customer_number,
              right(CASE WHEN event_type = 'click' THEN b ELSE a END, 10) AS agent_number FROM c""",
)
def call_numbers(t: Tables) -> DataFrame:
    caller = F.concat(F.lit("0"), F.lpad(F.col("user_id").cast("string"), 10, "0"))
    callee = F.concat(F.lit("91"), F.lpad(F.col("event_id").cast("string"), 10, "0"))
    direction = F.when(F.col("event_type") == "click", "inbound").otherwise("outbound")
    return t.events.select(
        "event_id",
        text.call_customer_number(direction, caller, callee).alias("customer_number"),
        text.call_agent_number(direction, caller, callee).alias("agent_number"),
    )


@query(
    "h06_name_from_email",
    """WITH e AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment
                  WHEN c_custkey % 101 = 0
                  THEN repeat(lower(c_name), 80000) || 'End@desk.example' ELSE lower(c_name) || '.Team@desk.example' END AS email FROM customer)
       SELECT c_custkey, sha256(CASE WHEN contains(email, '@')
              THEN upper(left(split_part(email, '@', 1), 1)) || lower(substr(split_part(email, '@', 1), 2))
              ELSE email END) AS agent_name FROM e""",
)
def name_from_email(t: Tables) -> DataFrame:
    """Short names become megabytes here, so customers are dealt out by count, not by how their file is cut."""
    people = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    people = people.repartition(max(1, -(-people.count() // MAILS_A_TASK)), "c_custkey")
    mail = F.concat(F.lower("c_name"), F.lit(".Team@desk.example"))
    long = F.concat(F.repeat(F.lower("c_name"), 80_000), F.lit("End@desk.example"))
    email = F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).when(F.col("c_custkey") % 101 == 0, long).otherwise(mail)
    return people.select("c_custkey", F.sha2(text.name_from_email(email), 256).alias("agent_name"))


@query(
    "h07_flatten_comment",
    """SELECT conv_id, turn, replace(replace(text, chr(10), ','), '\\n', ',') AS comment FROM conversations""",
)
def flatten_comment(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", text.flatten_comment(F.col("text")).alias("comment"))


@query(
    "h08_day_with_suffix",
    """SELECT o_orderkey, day(o_orderdate)::VARCHAR || CASE
              WHEN day(o_orderdate) BETWEEN 4 AND 20 OR day(o_orderdate) BETWEEN 24 AND 30 THEN 'th'
              WHEN day(o_orderdate) % 10 = 1 THEN 'st' WHEN day(o_orderdate) % 10 = 2 THEN 'nd'
              ELSE 'rd' END AS day_label FROM orders""",
)
def day_with_suffix(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", text.day_with_suffix(F.dayofmonth("o_orderdate")).alias("day_label"))


@query(
    "h09_month_year_label",
    """SELECT o_orderkey, month(o_orderdate)::VARCHAR || '-' || year(o_orderdate)::VARCHAR AS short_label,
              strftime(o_orderdate, '%B-%Y') AS long_label FROM orders""",
)
def month_year_label(t: Tables) -> DataFrame:
    short = times.month_year_label(F.month("o_orderdate"), F.year("o_orderdate"))
    return t.orders.select(
        "o_orderkey", short.alias("short_label"), times.month_name_label(F.col("o_orderdate")).alias("long_label")
    )


HOURS_SQL = """h AS (SELECT event_id, hour(ts)::INT AS a, (hour(ts)::INT + 1) % 24 AS b FROM events),
       l AS (SELECT event_id, a,
              (CASE WHEN a % 12 = 0 THEN 12 ELSE a % 12 END)::VARCHAR AS fa, CASE WHEN a < 12 THEN 'AM' ELSE 'PM' END AS ma,
              (CASE WHEN b % 12 = 0 THEN 12 ELSE b % 12 END)::VARCHAR AS fb, CASE WHEN b < 12 THEN 'AM' ELSE 'PM' END AS mb
              FROM h)"""


def typed_slot() -> F.Column:
    """The hour of an event written in one of the ways people type a slot."""
    start, end = F.hour("ts"), (F.hour("ts") + 1) % 24
    wide = [F.lpad(x.cast("string"), 2, "0") for x in (start, end)]
    narrow = [start.cast("string"), end.cast("string")]
    form = F.col("event_id") % 5
    return (
        F.when(form == 0, F.concat(narrow[0], F.lit(":00-"), narrow[1], F.lit(":00")))
        .when(form == 1, F.concat(wide[0], F.lit(":00-"), wide[1], F.lit(":00")))
        .when(form == 2, F.concat(wide[0], F.lit("00-"), wide[1], F.lit("00")))
        .when(form == 3, F.concat(narrow[0], F.lit("00-"), narrow[1], F.lit("00")))
        .otherwise(F.lit("None"))
    )


@query(
    "h10_slot_label",
    f"""WITH {HOURS_SQL} SELECT event_id, CASE WHEN event_id % 5 = 4 THEN 'None'
              ELSE fa || ma || '-' || fb || mb END AS slot FROM l""",
)
def slot_label(t: Tables) -> DataFrame:
    return t.events.select("event_id", times.slot_label(typed_slot()).alias("slot"))


@query(
    "h11_slot_label_padded",
    f"""WITH {HOURS_SQL} SELECT event_id, CASE WHEN event_id % 5 = 4 THEN 'None'
              ELSE lpad(fa, 2, '0') || ma || '-' || lpad(fb, 2, '0') || mb END AS slot FROM l""",
)
def slot_label_padded(t: Tables) -> DataFrame:
    return t.events.select("event_id", times.slot_label(typed_slot(), padded=True).alias("slot"))


@query(
    "h12_json_field",
    """SELECT event_id, coalesce(props->>'$.k', '') AS k, coalesce(props->>'$.absent', '') AS absent FROM events""",
)
def json_field(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        text.json_text(F.col("props"), "k").alias("k"),
        text.json_text(F.col("props"), "absent").alias("absent"),
    )


@query(
    "h13_outcome_property",
    """WITH o AS (SELECT user_id, arg_min((event_type, props), event_id) AS v FROM events WHERE value > 100 GROUP BY 1)
       SELECT c_custkey, coalesce(v[1], '') AS outcome, coalesce(v[2]->>'$.k', '') AS reason
       FROM customer LEFT JOIN o ON user_id = c_custkey""",
)
def outcome_property(t: Tables) -> DataFrame:
    """First matching outcome of a customer: one property, and one field of its details."""
    outcomes = t.events.where(F.col("value") > 100)
    found = lookup_first(
        t.customer, "c_custkey", outcomes, "user_id", {"event_type": "outcome", "props": "details"}, ["event_id"]
    )
    return found.select("c_custkey", "outcome", text.json_text(F.col("details"), "k").alias("reason"))


@query(
    "h14_outcome_comment",
    """SELECT event_id, chr(10) || ' Surgery Comments: ' || chr(10) ||
              coalesce((replace(props, '"k"', '"comments"')::JSON->>'$.comments') || ' ' || chr(10), '') AS note
       FROM events""",
)
def outcome_comment(t: Tables) -> DataFrame:
    details = F.replace("props", F.lit('"k"'), F.lit('"comments"'))
    return t.events.select("event_id", text.outcome_comment(details).alias("note"))


@query(
    "h15_response_stage",
    """WITH s AS (SELECT event_id, (props->>'$.k')::INT % 5 AS n, event_type IN ('view', 'click') AS yes FROM events)
       SELECT event_id, CASE WHEN n BETWEEN 1 AND 3 AND yes THEN 'Patient_Responded'
              WHEN n = 1 THEN '1st stage' WHEN n = 2 THEN '2nd stage'
              ELSE 'Patient_eligible_for_calling' END AS stage FROM s""",
)
def response_stage(t: Tables) -> DataFrame:
    n = F.get_json_object("props", "$.k").cast("int") % 5
    listed = F.to_json(F.array_repeat(F.lit("10:00"), n))
    answer = F.when(F.col("event_type").isin("view", "click"), "true").otherwise("false")
    return t.events.select("event_id", text.response_stage(listed, answer).alias("stage"))


FEE_SQL = """CASE WHEN f IS NULL THEN NULL
              WHEN f = 0 AND o_orderpriority = '5-LOW' THEN 'WALLET'
              WHEN f = 0 AND o_orderstatus = 'O' THEN 'Privilege Card' WHEN f = 0 THEN '0'
              WHEN f <= 100000 THEN '1-100000' WHEN f <= 200000 THEN '100001-200000'
              WHEN f <= 300000 THEN '200001-300000' WHEN f <= 400000 THEN '300001-400000' ELSE '>400000' END"""


def proxy_fee() -> F.Column:
    """Order price as a fee: every tenth order is free of charge."""
    return F.when(F.col("o_orderkey") % 10 == 0, F.lit(0.0)).otherwise(F.col("o_totalprice"))


def proxy_bucket() -> F.Column:
    mode = F.when(F.col("o_orderpriority") == "5-LOW", "WALLET").otherwise(F.col("o_orderpriority"))
    return labels.fee_bucket(proxy_fee(), mode, F.col("o_orderstatus") == "O", "WALLET", width=100_000)


@query(
    "h16_fee_bucket",
    f"""WITH o AS (SELECT *, CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE o_totalprice END AS f FROM orders)
        SELECT o_orderkey, {FEE_SQL} AS bucket FROM o""",
)
def fee_bucket(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", proxy_bucket().alias("bucket"))


@query(
    "h17_age_bucket",
    """WITH a AS (SELECT event_id, epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(ts) AS us FROM events)
       SELECT event_id, CASE WHEN us <= 600000000 THEN 'less than 10_Mins' WHEN us <= 1800000000 THEN '10 - 30_Mins'
              WHEN us <= 3600000000 THEN '30 - 60_Mins' WHEN us <= 7200000000 THEN '1 - 2_hours'
              WHEN us <= 36000000000 THEN '2 - 10_hours' ELSE 'more than 10_hours' END AS age FROM a""",
)
def age_bucket(t: Tables) -> DataFrame:
    seconds = times.age_seconds(F.col("ts"), dt.datetime(2024, 1, 31))
    return t.events.select("event_id", labels.age_bucket(seconds).alias("age"))


@query(
    "h18_local_time",
    """SELECT event_id, strftime(ts + INTERVAL '330 minutes', '%Y-%m-%d %H:%M:%S') AS local_ts,
              strftime(ts + INTERVAL '330 minutes', '%Y-%m-%d') AS local_day FROM events""",
)
def local_time(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        F.date_format(times.local_time(F.col("ts")), SECOND).alias("local_ts"),
        F.date_format(times.local_date(F.col("ts")), DAY).alias("local_day"),
    )


@query(
    "h19_date_parts",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d, month(o_orderdate)::BIGINT AS m,
              year(o_orderdate)::BIGINT AS y, strftime(o_orderdate, '%U')::BIGINT AS w FROM orders""",
)
def date_parts(t: Tables) -> DataFrame:
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.date_format(d, DAY).alias("d"),
        F.month(d).cast("bigint").alias("m"),
        F.year(d).cast("bigint").alias("y"),
        times.sunday_week(d).cast("bigint").alias("w"),
    )


@query(
    "h20_iso_week",
    """SELECT o_orderkey, strftime(o_orderdate, '%V')::BIGINT AS iso_week,
              strftime(o_orderdate, '%G')::BIGINT AS iso_year FROM orders""",
)
def iso_week(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        F.weekofyear("o_orderdate").cast("bigint").alias("iso_week"),
        times.iso_year(F.to_date("o_orderdate")).cast("bigint").alias("iso_year"),
    )


@query(
    "h21_calendar_windows",
    """WITH a AS (SELECT DATE '1998-06-17' AS as_of), y AS (SELECT as_of - 1 AS y, as_of FROM a),
       w(name, a, b) AS (
         SELECT 'month_to_date', date_trunc('month', y), y FROM y UNION ALL
         SELECT 'last_month', date_trunc('month', y) - INTERVAL 1 MONTH, date_trunc('month', y) - INTERVAL 1 DAY FROM y UNION ALL
         SELECT 'two_months_ago', date_trunc('month', y) - INTERVAL 2 MONTH,
                date_trunc('month', y) - INTERVAL 1 MONTH - INTERVAL 1 DAY FROM y UNION ALL
         SELECT 'last_week', date_trunc('week', as_of) - INTERVAL 7 DAY, date_trunc('week', as_of) - INTERVAL 1 DAY FROM y UNION ALL
         SELECT 'this_week', date_trunc('week', as_of), y FROM y UNION ALL
         SELECT 'trailing_week', y - 7, y FROM y UNION ALL SELECT 'yesterday', y, y FROM y)
       SELECT name, strftime(a, '%Y-%m-%d') AS first_day, strftime(b, '%Y-%m-%d') AS last_day,
              (SELECT count(*) FROM orders WHERE o_orderdate >= a AND o_orderdate < b + INTERVAL 1 DAY) AS n_orders FROM w""",
)
def calendar_windows(t: Tables) -> DataFrame:
    windows = times.calendar_windows(AS_OF)
    counts = t.orders.agg(
        *[F.count_if(in_window(F.to_date("o_orderdate"), w)).alias(w.name) for w in windows]
    )
    rows = [
        F.struct(
            F.lit(w.name).alias("name"),
            F.lit(w.start.isoformat()).alias("first_day"),
            F.lit(w.end.isoformat()).alias("last_day"),
            F.col(w.name).alias("n_orders"),
        )
        for w in windows
    ]
    return counts.select(F.inline(F.array(*rows)))


@query(
    "h22_parse_timestamp",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL
              ELSE strftime(o_orderdate + INTERVAL 1 HOUR * (o_orderkey % 24)::INT, '%Y-%m-%d %H:%M:%S') END AS submitted
       FROM orders""",
)
def parse_timestamp(t: Tables) -> DataFrame:
    stamp = F.concat(
        F.date_format("o_orderdate", "dd/MM/yyyy "), F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"),
        F.lit(":00:00"),
    )
    typed = F.when(F.col("o_orderkey") % 7 == 0, F.lit("not a time")).otherwise(stamp)
    return t.orders.select("o_orderkey", F.date_format(times.parse_day_first(typed), SECOND).alias("submitted"))


@query(
    "h23_epoch_ms_age",
    """WITH m AS (SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events)
       SELECT event_id, strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S') AS created,
              (epoch_us(TIMESTAMP '2024-01-31 00:00:00') // 1000 - ms) / 1000.0 AS seconds FROM m""",
)
def epoch_ms_age(t: Tables) -> DataFrame:
    since = (F.col("ts") - times.ntz(dt.datetime(1970, 1, 1))).cast("interval second").cast("decimal(18,6)")
    ms = F.floor(since * 1000).cast("bigint")
    created = times.from_epoch_ms(ms)
    return t.events.select(
        "event_id",
        F.date_format(created, SECOND).alias("created"),
        times.age_seconds(created, dt.datetime(2024, 1, 31)).alias("seconds"),
    )


@query(
    "h24_minor_to_major",
    """SELECT o_orderkey, (round(o_totalprice * 100)::BIGINT / 100.0)::DOUBLE AS major,
              round(o_totalprice * 100)::BIGINT // 100 AS whole FROM orders""",
)
def minor_to_major(t: Tables) -> DataFrame:
    minor = F.round(F.col("o_totalprice") * 100).cast("bigint")
    major = money.minor_to_major(minor)
    return t.orders.select("o_orderkey", major.cast("double").alias("major"), money.whole_units(major).alias("whole"))


@query(
    "h25_pct2_avg2",
    f"""WITH g AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f,
                count(*) FILTER (o_orderstatus = 'O') AS o,
                coalesce(sum(round(o_totalprice * 100)::BIGINT) FILTER (o_orderstatus = 'O'), 0) AS cents
              FROM orders GROUP BY 1)
       SELECT o_custkey, round_even(f / n * 100, 2) AS share, {half_even("cents", "o")} AS avg_open FROM g""",
)
def pct2_avg2(t: Tables) -> DataFrame:
    is_open = F.col("o_orderstatus") == "O"
    sums = t.orders.groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("f"),
        F.count("*").alias("n"),
        F.count_if(is_open).alias("o"),
        F.coalesce(F.sum(F.when(is_open, money.money(F.col("o_totalprice")))), F.lit(0)).alias("total"),
    )
    return sums.select(
        "o_custkey",
        money.pct2(F.col("f"), F.col("n")).alias("share"),
        money.avg2(F.col("total"), F.col("o")).alias("avg_open"),
    )


@query(
    "h26_record_url",
    """SELECT o_orderkey, 'https://desk.example/patient/' || o_custkey || '/case/' || o_orderkey AS url FROM orders""",
)
def record_url(t: Tables) -> DataFrame:
    url = text.record_url("https://desk.example", F.col("o_custkey"), F.col("o_orderkey"))
    return t.orders.select("o_orderkey", url.alias("url"))


@query(
    "h27_append_label",
    """SELECT event_id, hour(ts)::VARCHAR || '-' || (hour(ts) + 1)::VARCHAR AS label FROM events""",
)
def append_label(t: Tables) -> DataFrame:
    hour = F.hour("ts")
    return t.events.select("event_id", F.concat_ws("-", hour.cast("string"), (hour + 1).cast("string")).alias("label"))


@query(
    "h28_format_amount",
    """SELECT p_partkey, format('{:,}', trunc(p_retailprice * 1000)::BIGINT) AS amount FROM part""",
)
def format_amount(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", money.format_amount(F.col("p_retailprice") * 1000).alias("amount"))
