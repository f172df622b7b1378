"""A2 and D: windows, counts, shares, crosstabs and workload on the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from opsreports.checks.registry import AS_OF, Tables, half_even, query
from opsreports.checks.scalars import FEE_SQL, proxy_bucket, proxy_fee
from opsreports.functions import labels
from opsreports.functions.labels import fee_bucket_labels
from opsreports.functions.money import MONEY, pct2
from opsreports.functions.times import Window, day_windows, hour_slot, pick_windows, slot_ordinal, week_windows
from opsreports.operators import aggregates as agg, joins

DAY_WINDOWS = day_windows(AS_OF)
BUCKETS = fee_bucket_labels("WALLET", width=100_000)
YESTERDAY = Window("yesterday", dt.date(2024, 1, 16), dt.date(2024, 1, 16))
MONTH = Window("month", dt.date(2024, 1, 1), dt.date(2024, 1, 16))

BUCKETED_SQL = f"""b AS (SELECT n_name AS city, {FEE_SQL} AS bucket, o_orderdate::DATE AS d,
                  round(f * 100)::BIGINT AS cents
                FROM (SELECT *, CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE o_totalprice END AS f FROM orders)
                JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
DAYS_SQL = """count(*) FILTER (d = DATE '1998-06-16') AS d1, count(*) FILTER (d = DATE '1998-06-15') AS d2,
              count(*) FILTER (d = DATE '1998-06-14') AS d3, count(*) FILTER (d = DATE '1998-06-13') AS d4,
              count(*) FILTER (d BETWEEN DATE '1998-06-01' AND DATE '1998-06-17') AS mtd"""


def bucketed(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("d"), proxy_fee().alias("fee"),
        proxy_bucket().alias("bucket"),
    )
    rows = joins.attach(rows, t.customer, {"o_custkey": "c_custkey"}, ["c_nationkey"], "inner")
    return joins.attach(rows, t.nation, {"c_nationkey": "n_nationkey"}, {"n_name": "city"}, "inner")


@query("d01_count_by_label", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def count_by_label(t: Tables) -> DataFrame:
    return agg.count_by_label(t.events, "event_type")


@query(
    "d02_status_summary",
    """SELECT count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_orderstatus IN ('O', 'P')) AS follow_up,
              count(*) AS total FROM orders""",
)
def status_summary(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    return agg.status_summary(
        t.orders, {"done": status == "F", "follow_up": status.isin("O", "P"), "total": F.lit(True)}
    )


@query(
    "d03_summary_two_windows",
    """WITH m(measure) AS (VALUES ('errors'), ('sales'), ('total'))
       SELECT measure,
         count(*) FILTER (ts::DATE = DATE '2024-01-16') AS yesterday,
         count(*) FILTER (ts::DATE BETWEEN DATE '2024-01-01' AND DATE '2024-01-16') AS month
       FROM events JOIN m ON measure = 'total' OR (measure = 'errors' AND event_type = 'error')
         OR (measure = 'sales' AND event_type = 'purchase') GROUP BY 1""",
)
def summary_two_windows(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    tests = {"errors": kind == "error", "sales": kind == "purchase", "total": F.lit(True)}
    return agg.summary_by_window(t.events, F.to_date("ts"), tests, [YESTERDAY, MONTH])


@query(
    "d04_bucket_window_counts",
    f"WITH {BUCKETED_SQL} SELECT city, bucket, {DAYS_SQL} FROM b GROUP BY 1, 2",
)
def bucket_window_counts(t: Tables) -> DataFrame:
    return agg.bucket_window_counts(bucketed(t), ["city"], "bucket", F.col("d"), DAY_WINDOWS)


WEEK_CASES = [(w.name, f"d BETWEEN DATE '{w.start}' AND DATE '{w.end}'") for w in week_windows(AS_OF)]


@query(
    "d05_bucket_week_counts_avg",
    f"""WITH {BUCKETED_SQL}, s AS (SELECT city, bucket, """
    + ", ".join(
        f"count(*) FILTER ({c}) AS {n}_n, coalesce(sum(cents) FILTER ({c}), 0) AS {n}_c" for n, c in WEEK_CASES
    )
    + " FROM b GROUP BY 1, 2) SELECT city, bucket, "
    + ", ".join(f"{n}_n, {half_even(f'{n}_c', f'{n}_n')} AS {n}_avg" for n, _ in WEEK_CASES)
    + " FROM s",
)
def bucket_week_counts_avg(t: Tables) -> DataFrame:
    weeks = week_windows(AS_OF)
    sums = agg.bucket_window_sums(bucketed(t), ["city"], "bucket", F.col("d"), F.col("fee"), weeks)
    return agg.averages(sums, [w.name for w in weeks])


@query(
    "d06_total_row",
    f"""WITH {BUCKETED_SQL} SELECT city, coalesce(bucket, 'Total') AS bucket, {DAYS_SQL}
        FROM b GROUP BY GROUPING SETS ((city, bucket), (city))""",
)
def total_row(t: Tables) -> DataFrame:
    counts = agg.bucket_window_counts(bucketed(t), ["city"], "bucket", F.col("d"), DAY_WINDOWS)
    return agg.total_row(counts, ["city"], "bucket", [w.name for w in DAY_WINDOWS])


@query(
    "d07_share_of_column",
    """WITH c AS (SELECT n_name AS city, o_orderpriority AS priority, count(*) AS n FROM orders
         JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
       SELECT city, priority, n, round_even(n / sum(n) OVER (PARTITION BY city) * 100, 2) AS n_pct FROM c""",
)
def share_of_column(t: Tables) -> DataFrame:
    rows = joins.attach(t.orders, t.customer, {"o_custkey": "c_custkey"}, ["c_nationkey"], "inner")
    rows = joins.attach(rows, t.nation, {"c_nationkey": "n_nationkey"}, {"n_name": "city"}, "inner")
    counts = agg.count_group(rows.withColumnRenamed("o_orderpriority", "priority"), "city", "priority")
    return agg.share_of_column(counts, ["city"], "priority", ["n"])


PAYMENT_SQL = """p AS (
         SELECT 'Loyalty' AS service, o_orderpriority AS mode, o_orderdate::DATE AS d FROM orders
         UNION ALL SELECT CASE WHEN l_linestatus = 'F' THEN 'Consultation' ELSE 'Other' END, l_returnflag, l_shipdate::DATE FROM lineitem
         UNION ALL SELECT 'IPD', event_type, ts::DATE FROM events),
       w(name, a, b) AS (VALUES ('month_to_date', DATE '1998-06-01', DATE '1998-06-16'),
         ('last_month', DATE '1998-05-01', DATE '1998-05-31'), ('last_week', DATE '1998-06-08', DATE '1998-06-14'),
         ('this_week', DATE '1998-06-15', DATE '1998-06-16')),
       k AS (SELECT service, name AS "window",
         CASE WHEN mode IN ('1-URGENT', 'A') THEN 'Razorpay' WHEN mode IN ('2-HIGH', 'R') THEN 'UPI'
              WHEN mode = '5-LOW' THEN 'Cash' WHEN mode = 'view' THEN 'Insurance' ELSE 'Other' END AS class
         FROM p JOIN w ON d BETWEEN a AND b)"""
CLASSES_SQL = ", ".join(f"count(*) FILTER (class = '{c}') AS \"{c}\"" for c in labels.PAY_MODE_CLASSES)


def payments(t: Tables) -> DataFrame:
    """Three facts as one list of payments: a service, a mode and a day each."""
    line_service = F.when(F.col("l_linestatus") == "F", "Consultation").otherwise("Other")
    parts = [
        t.orders.select(F.lit("Loyalty").alias("service"), F.col("o_orderpriority").alias("mode"), F.to_date("o_orderdate").alias("d")),
        t.lineitem.select(line_service.alias("service"), F.col("l_returnflag").alias("mode"), F.to_date("l_shipdate").alias("d")),
        t.events.select(F.lit("IPD").alias("service"), F.col("event_type").alias("mode"), F.to_date("ts").alias("d")),
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    modes = {"1-URGENT": "RAZOR_PAY", "A": "RAZOR_PAY_UPI_PAID", "2-HIGH": "UPI", "R": "GOOGLE_PAY", "5-LOW": "CASH", "view": "INSURANCE"}
    mode = labels.map_value(F.col("mode"), modes, "OTHER")
    return rows.select("service", labels.map_value(mode, labels.PAY_MODE_CLASS, "Other").alias("class"), "d")


def service_modes(t: Tables) -> DataFrame:
    windows = pick_windows(AS_OF, "month_to_date", "last_month", "last_week", "this_week")
    rows = payments(t).withColumn("city", F.lit("all"))
    return agg.service_mode_counts(rows, "city", "service", "class", F.col("d"), windows, labels.PAY_MODE_CLASSES).drop("city")


@query(
    "d08_share_of_row",
    f"""WITH {PAYMENT_SQL}, c AS (SELECT service, "window", {CLASSES_SQL}, count(*) AS n FROM k GROUP BY 1, 2)
        SELECT service, "window", """
    + ", ".join(f'"{c}", round_even("{c}" / n * 100, 2) AS "{c}_pct"' for c in labels.PAY_MODE_CLASSES)
    + " FROM c",
)
def share_of_row(t: Tables) -> DataFrame:
    return agg.share_of_row(service_modes(t), labels.PAY_MODE_CLASSES)


@query(
    "d09_service_mode_pivot",
    f"""WITH {PAYMENT_SQL} SELECT service, "window", {CLASSES_SQL} FROM k GROUP BY 1, 2""",
)
def service_mode_pivot(t: Tables) -> DataFrame:
    return service_modes(t)


@query(
    "d10_crosstab_status",
    """SELECT event_type, count(*) FILTER (value < 10) AS low, count(*) FILTER (value >= 10 AND value < 100) AS mid,
              count(*) FILTER (value >= 100) AS high FROM events GROUP BY 1""",
)
def crosstab_status(t: Tables) -> DataFrame:
    level = F.when(F.col("value") < 10, "low").when(F.col("value") < 100, "mid").otherwise("high")
    return agg.crosstab(t.events, ["event_type"], level, {x: x for x in ("low", "mid", "high")})


@query(
    "d11_crosstab_flag",
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS sent,
              count(*) FILTER (o_orderstatus = 'O') AS not_requested, count(*) FILTER (o_orderstatus = 'P') AS not_sent
       FROM orders GROUP BY 1""",
)
def crosstab_flag(t: Tables) -> DataFrame:
    flags = {"sent": "F", "not_requested": "O", "not_sent": "P"}
    return agg.crosstab(t.orders, ["o_orderpriority"], F.col("o_orderstatus"), flags)


@query(
    "d12_unpivot_legs_count",
    """WITH u AS (SELECT l_suppkey AS agent, l_returnflag AS status FROM lineitem
         UNION ALL SELECT l_partkey, l_linestatus FROM lineitem UNION ALL SELECT l_linenumber, l_returnflag FROM lineitem)
       SELECT agent, count(*) FILTER (status = 'A') AS busy, count(*) FILTER (status = 'R') AS completed,
              count(*) FILTER (status = 'F') AS failed, count(*) FILTER (status = 'O') AS no_answer FROM u GROUP BY 1""",
)
def unpivot_legs_count(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumn("l_linenumber", F.col("l_linenumber").cast("bigint"))
    pairs = [("l_suppkey", "l_returnflag"), ("l_partkey", "l_linestatus"), ("l_linenumber", "l_returnflag")]
    legs = agg.unpivot_pairs(lines, pairs, "agent", "status")
    kinds = {"busy": "A", "completed": "R", "failed": "F", "no_answer": "O"}
    return agg.crosstab(legs, ["agent"], F.col("status"), kinds)


@query(
    "d13_max_per_key",
    "SELECT o_custkey, strftime(max(o_orderdate), '%Y-%m-%d') AS latest FROM orders GROUP BY 1",
)
def max_per_key(t: Tables) -> DataFrame:
    latest = agg.max_per_key(t.orders, "o_custkey", "o_orderdate", "latest")
    return latest.withColumn("latest", F.date_format("latest", "yyyy-MM-dd"))


@query(
    "d14_concat_per_key",
    """SELECT l_orderkey, 0::BIGINT AS part, string_agg(p_name, ',' ORDER BY p_name) AS names
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def concat_per_key(t: Tables) -> DataFrame:
    named = joins.attach(t.lineitem.select("l_orderkey", "l_partkey"), t.part, {"l_partkey": "p_partkey"}, ["p_name"], "inner")
    return agg.concat_per_key(named, ["l_orderkey"], "p_name", "names")


@query(
    "d15_concat_distinct_per_key",
    """SELECT l_suppkey, l_returnflag, 0::BIGINT AS part, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS brands
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
)
def concat_distinct_per_key(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_suppkey", "l_returnflag", "l_partkey")
    branded = joins.attach(lines, t.part, {"l_partkey": "p_partkey"}, ["p_brand"], "inner")
    return agg.concat_distinct_per_key(branded, ["l_suppkey", "l_returnflag"], "p_brand", "brands")


@query("d16_distinct_values", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_values(t: Tables) -> DataFrame:
    return agg.distinct_values(t.events, "user_id", "event_type")


@query("d17_count_group", "SELECT user_id, count(*) AS queue_size FROM events WHERE event_type = 'click' GROUP BY 1")
def count_group(t: Tables) -> DataFrame:
    return agg.count_group(t.events.where(F.col("event_type") == "click"), "user_id", out="queue_size")


@query(
    "d18_count_by_hour_label",
    """SELECT event_type, strftime(ts, '%-I%p') || '-' || strftime(ts + INTERVAL 1 HOUR, '%-I%p') AS slot, count(*) AS n
       FROM events GROUP BY 1, 2""",
)
def count_by_hour_label(t: Tables) -> DataFrame:
    return agg.count_by_hour_slot(t.events, ["event_type"], "ts")


WORKLOAD_SQL = """w AS (SELECT user_id % 2 AS city, hour(ts)::INT AS hour,
         count(*) FILTER (event_type = 'view') AS queued,
         count(*) FILTER (event_type <> 'view' AND value > 50) AS pending,
         count(*) FILTER (event_type <> 'view') AS with_agent FROM events GROUP BY 1, 2)"""


def workload(t: Tables) -> DataFrame:
    reason = F.when(F.col("value") > 50, "Confirmation Pending").otherwise("Other")
    rows = t.events.select(
        (F.col("user_id") % 2).alias("city"), hour_slot(F.col("ts")).alias("slot"), "event_type", reason.alias("reason")
    )
    return agg.slot_workload(rows, ["city", "slot"], "event_type", "reason", "view")


@query(
    "d19_slot_workload",
    f"""WITH {WORKLOAD_SQL} SELECT city, hour, queued, pending, with_agent,
              (queued + with_agent) / 25 AS agents_needed FROM w""",
)
def slot_workload(t: Tables) -> DataFrame:
    return workload(t).withColumn("hour", slot_ordinal(F.col("slot"))).drop("slot")


@query(
    "d20_dual_dim_summary",
    """WITH o AS (SELECT o_orderpriority AS agent, c_nationkey::VARCHAR AS hospital, o_orderstatus AS status,
              CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE o_totalprice::DECIMAL(18,2) END AS fee, o_orderkey % 3 = 0 AS taken
            FROM orders JOIN customer ON o_custkey = c_custkey),
       s AS (SELECT *, unnest(['agent', 'hospital']) AS dim FROM o),
       x AS (SELECT dim, CASE dim WHEN 'agent' THEN agent ELSE hospital END AS label, status, fee, taken FROM s),
       g AS (SELECT dim, coalesce(label, 'Total') AS label,
              count(*) FILTER (status = 'O') AS recommended, count(*) FILTER (status <> 'F' AND taken) AS taken,
              count(*) FILTER (status = 'F') AS total_done, count(*) FILTER (status = 'F' AND fee = 0) AS zero_value,
              coalesce(sum(fee) FILTER (status = 'F'), 0)::DOUBLE AS value
            FROM x GROUP BY GROUPING SETS ((dim, label), (dim)))
       SELECT *, CASE WHEN recommended = 0 THEN 0 ELSE round_even(taken * 100 / recommended, 2) END AS taken_pct FROM g""",
)
def dual_dim_summary(t: Tables) -> DataFrame:
    fee = F.when(F.col("o_orderkey") % 10 == 0, F.lit(0).cast(MONEY)).otherwise(F.col("o_totalprice").cast(MONEY))
    rows = joins.attach(t.orders, t.customer, {"o_custkey": "c_custkey"}, ["c_nationkey"], "inner").select(
        F.col("o_orderpriority").alias("agent"), F.col("c_nationkey").cast("string").alias("hospital"),
        "o_orderkey", "o_orderstatus", fee.alias("fee"),
    )
    status = F.col("o_orderstatus")
    table = agg.visit_summary(
        rows, {"agent": "agent", "hospital": "hospital"}, status == "F", status != "F", "fee",
        recommended=status == "O", taken=F.col("o_orderkey") % 3 == 0,
    )
    return table.withColumn("value", F.col("value").cast("double"))


@query(
    "d21_conditional_balance",
    """SELECT o_custkey, sum(CASE WHEN o_orderstatus = 'F' AND o_orderdate + INTERVAL 60 DAY >= DATE '1998-06-17'
                THEN o_totalprice::DECIMAL(18,2) WHEN o_orderstatus = 'O' THEN -o_totalprice::DECIMAL(18,2) ELSE 0 END)::DOUBLE AS balance
       FROM orders GROUP BY 1""",
)
def conditional_balance(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("valid_till", F.date_add(F.to_date("o_orderdate"), 60))
    out = agg.conditional_balance(rows, "o_custkey", "o_orderstatus", "o_totalprice", "valid_till", AS_OF, "F", "O")
    return out.withColumn("balance", F.col("balance").cast("double"))


@query(
    "d22_incentive",
    """WITH g AS (SELECT o_custkey AS agent, count(*) FILTER (o_orderpriority = '5-LOW') AS online,
              count(*) FILTER (o_orderpriority <> '5-LOW') AS offline, count(*) AS achieved,
              min(CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey % 12 END) AS target FROM orders GROUP BY 1)
       SELECT agent, online, offline, target, achieved, achieved - target AS gap,
              CASE WHEN target > 0 AND achieved >= target THEN 200 * offline + 100 * online ELSE 0 END AS pay FROM g""",
)
def incentive(t: Tables) -> DataFrame:
    target = F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey") % 12)
    rows = t.orders.select(F.col("o_custkey").alias("agent"), "o_orderpriority", target.alias("target"))
    return agg.incentive(rows, ["agent"], F.col("o_orderpriority") == "5-LOW", "target")


@query(
    "d23_region_split",
    """SELECT CASE n_name WHEN 'NATION_0' THEN 'BLR' WHEN 'NATION_1' THEN 'HYD' ELSE 'NORTH' END AS region, count(*) AS n
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey < 4 GROUP BY 1""",
)
def region_split(t: Tables) -> DataFrame:
    nations = t.nation.where(F.col("n_regionkey") < 4)
    rows = joins.attach(t.customer, nations, {"c_nationkey": "n_nationkey"}, ["n_name"])
    region = agg.region_of(F.col("n_name"), {"NATION_0": "BLR", "NATION_1": "HYD"}, "NORTH")
    return agg.count_group(rows.select(region.alias("region")), "region")


@query(
    "d24_coverage_pct",
    """SELECT c_nationkey AS city, c_mktsegment AS source, count(*) AS leads,
              round_even(count(*) FILTER (c_acctbal > 0) * 100 / count(*), 2) AS coverage_pct
       FROM customer GROUP BY 1, 2""",
)
def coverage_pct(t: Tables) -> DataFrame:
    channel = F.when(F.col("c_acctbal") > 0, "named").when(F.col("c_acctbal") > -500, "")
    rows = t.customer.select(F.col("c_nationkey").alias("city"), F.col("c_mktsegment").alias("source"), channel.alias("channel"))
    return agg.coverage_pct(rows, ["city", "source"], "channel")


@query(
    "d25_sum_columns",
    """SELECT count(*) FILTER (ts::DATE = DATE '2024-01-16') AS yesterday,
              count(*) FILTER (ts::DATE BETWEEN DATE '2024-01-01' AND DATE '2024-01-16') AS month FROM events""",
)
def sum_columns(t: Tables) -> DataFrame:
    counts = agg.count_by_label_windows(t.events, "event_type", F.to_date("ts"), [YESTERDAY, MONTH])
    return agg.sum_columns(counts, ["yesterday", "month"])


@query(
    "d26_threshold_band",
    """WITH p AS (SELECT c_custkey, coalesce(n, 0) AS n,
              CASE WHEN coalesce(n, 0) = 0 THEN 0 ELSE round_even(f / n * 100, 2) END AS pct FROM customer LEFT JOIN
              (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f FROM orders
               WHERE o_orderpriority = '1-URGENT' GROUP BY 1) ON c_custkey = o_custkey)
       SELECT c_custkey, pct, CASE WHEN pct = 0 AND n > 0 THEN 'red' WHEN pct = 0 THEN 'none' WHEN pct < 50 THEN 'red'
              WHEN pct < 70 THEN 'pale' ELSE 'none' END AS band FROM p""",
)
def threshold_band(t: Tables) -> DataFrame:
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT").groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f")
    )
    rows = joins.attach(t.customer, urgent, {"c_custkey": "o_custkey"}, ["n", "f"]).na.fill(0, ["n", "f"])
    rows = rows.withColumn("pct", pct2(F.col("f"), F.col("n")))
    return rows.select("c_custkey", "pct", labels.threshold_band(F.col("pct"), F.col("n")).alias("band"))
