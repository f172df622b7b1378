"""C: joins and lookups on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from opsreports.checks.registry import Tables, query
from opsreports.functions.labels import CHANNEL_BUCKET, NO_CHANNEL, map_value
from opsreports.functions.times import hour_slot, slot_ordinal
from opsreports.operators import joins
from opsreports.operators.aggregates import concat_distinct_per_key, count_group


@query(
    "c01_inner_equi",
    """SELECT l_orderkey, l_linenumber, c_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey""",
)
def inner_equi(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber")
    lines = joins.attach(lines, t.orders, {"l_orderkey": "o_orderkey"}, ["o_custkey"], "inner")
    return joins.attach(lines, t.customer, {"o_custkey": "c_custkey"}, ["c_name"], "inner").drop("o_custkey")


@query(
    "c02_left_equi_star",
    """SELECT o_orderkey, c_name, n_name, r_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey < 4
       LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def left_equi_star(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey")
    rows = joins.attach(rows, t.customer, {"o_custkey": "c_custkey"}, ["c_name", "c_nationkey"])
    nations = t.nation.where(F.col("n_regionkey") < 4)
    rows = joins.attach(rows, nations, {"c_nationkey": "n_nationkey"}, ["n_name", "n_regionkey"])
    rows = joins.attach(rows, t.region, {"n_regionkey": "r_regionkey"}, ["r_name"])
    return rows.select("o_orderkey", "c_name", "n_name", "r_name")


@query(
    "c03_dim_twice",
    """SELECT l_orderkey, l_linenumber, a.n_name AS supplier_city, b.n_name AS customer_city
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN customer ON o_custkey = c_custkey LEFT JOIN nation a ON s_nationkey = a.n_nationkey
       LEFT JOIN nation b ON c_nationkey = b.n_nationkey""",
)
def dim_twice(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    lines = joins.attach(lines, t.orders, {"l_orderkey": "o_orderkey"}, ["o_custkey"], "inner")
    lines = joins.attach(lines, t.supplier, {"l_suppkey": "s_suppkey"}, ["s_nationkey"], "inner")
    lines = joins.attach(lines, t.customer, {"o_custkey": "c_custkey"}, ["c_nationkey"], "inner")
    lines = joins.attach(lines, t.nation, {"s_nationkey": "n_nationkey"}, {"n_name": "supplier_city"})
    lines = joins.attach(lines, t.nation, {"c_nationkey": "n_nationkey"}, {"n_name": "customer_city"})
    return lines.select("l_orderkey", "l_linenumber", "supplier_city", "customer_city")


@query(
    "c04_join_latest_aggregate",
    """SELECT c_custkey, strftime(d, '%Y-%m-%d') AS latest FROM customer LEFT JOIN
       (SELECT o_custkey, max(o_orderdate) AS d FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
       ON c_custkey = o_custkey""",
)
def join_latest_aggregate(t: Tables) -> DataFrame:
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT")
    rows = joins.attach_latest(t.customer, urgent, {"c_custkey": "o_custkey"}, "o_orderdate", "latest")
    return rows.select("c_custkey", F.date_format("latest", "yyyy-MM-dd").alias("latest"))


@query(
    "c05_join_derived",
    """SELECT o_orderkey, ci.n_name FROM orders JOIN
       (SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2) ci
       ON o_custkey = ci.c_custkey""",
)
def join_derived(t: Tables) -> DataFrame:
    nations = t.nation.where(F.col("n_regionkey") == 2)
    homes = joins.attach(t.customer, nations, {"c_nationkey": "n_nationkey"}, ["n_name"], "inner")
    rows = joins.attach(t.orders, homes, {"o_custkey": "c_custkey"}, ["n_name"], "inner")
    return rows.select("o_orderkey", "n_name")


@query(
    "c06_join_composite_on",
    """SELECT o_orderkey, l_linenumber FROM orders LEFT JOIN lineitem
       ON (l_returnflag = 'R' AND o_orderkey = l_orderkey)""",
)
def join_composite_on(t: Tables) -> DataFrame:
    returned = F.col("l_returnflag") == "R"
    rows = joins.attach_where(t.orders, t.lineitem, {"o_orderkey": "l_orderkey"}, returned, ["l_linenumber"])
    return rows.select("o_orderkey", "l_linenumber")


@query(
    "c07_link_channel",
    """SELECT o_orderkey, p_name FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R')
       ON o_orderkey = l_orderkey LEFT JOIN part ON l_partkey = p_partkey""",
)
def link_channel(t: Tables) -> DataFrame:
    bridge = t.lineitem.where(F.col("l_returnflag") == "R")
    rows = joins.link_through(
        t.orders, bridge, t.part, {"o_orderkey": "l_orderkey"}, {"l_partkey": "p_partkey"}, ["p_name"]
    )
    return rows.select("o_orderkey", "p_name")


@query(
    "c08_semi_join",
    """SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""",
)
def semi_join(t: Tables) -> DataFrame:
    pending = t.orders.where(F.col("o_orderstatus") == "P")
    return joins.keep_known(t.customer, "c_custkey", pending, "o_custkey").select("c_custkey")


@query(
    "c09_semi_join_fed_keys",
    """SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN
       (SELECT o_orderkey FROM orders WHERE o_custkey IN
         (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))""",
)
def semi_join_fed_keys(t: Tables) -> DataFrame:
    building = t.customer.where(F.col("c_mktsegment") == "BUILDING")
    theirs = joins.keep_known(t.orders, "o_custkey", building, "c_custkey")
    return joins.keep_known(t.lineitem, "l_orderkey", theirs, "o_orderkey").select("l_orderkey", "l_linenumber")


@query(
    "c10_anti_join_new_rows",
    """SELECT c_custkey FROM customer WHERE NOT EXISTS
       (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""",
)
def anti_join_new_rows(t: Tables) -> DataFrame:
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT")
    return joins.drop_known(t.customer, "c_custkey", urgent, "o_custkey").select("c_custkey")


@query(
    "c11_exists_flag",
    """SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')
              THEN 'Yes' ELSE 'No' END AS has_open FROM customer""",
)
def exists_flag(t: Tables) -> DataFrame:
    opened = t.orders.where(F.col("o_orderstatus") == "O")
    return joins.flag_known(t.customer, "c_custkey", opened, "o_custkey", "has_open").select("c_custkey", "has_open")


@query(
    "c12_lookup_first",
    """SELECT c_custkey, coalesce(p, '') AS priority FROM customer LEFT JOIN
       (SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS p FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
       ON c_custkey = o_custkey""",
)
def lookup_first(t: Tables) -> DataFrame:
    pending = t.orders.where(F.col("o_orderstatus") == "P")
    rows = joins.lookup_first(
        t.customer, "c_custkey", pending, "o_custkey", {"o_orderpriority": "priority"}, ["o_orderkey"]
    )
    return rows.select("c_custkey", "priority")


@query(
    "c13_lookup_first_filtered",
    """SELECT o_orderkey, coalesce(f, '') AS flag FROM orders LEFT JOIN
       (SELECT l_orderkey, arg_min(l_returnflag, (l_shipdate, l_linenumber, l_partkey)) AS f FROM lineitem
        WHERE l_returnflag <> 'R' GROUP BY 1) ON o_orderkey = l_orderkey""",
)
def lookup_first_filtered(t: Tables) -> DataFrame:
    kept = t.lineitem.where(F.col("l_returnflag") != "R")
    order = ["l_shipdate", "l_linenumber", "l_partkey"]
    rows = joins.lookup_first(t.orders, "o_orderkey", kept, "l_orderkey", {"l_returnflag": "flag"}, order)
    return rows.select("o_orderkey", "flag")


@query(
    "c14_lookup_dict_first",
    """SELECT event_id, coalesce(first_type, 'CS Team') AS first_type FROM events LEFT JOIN
       (SELECT user_id AS u, arg_min(event_type, event_id) AS first_type FROM events WHERE value > 100 GROUP BY 1)
       ON user_id = u""",
)
def lookup_dict_first(t: Tables) -> DataFrame:
    large = t.events.where(F.col("value") > 100).select(
        F.col("user_id").alias("u"), F.col("event_type").alias("e"), F.col("event_id").alias("i")
    )
    rows = joins.lookup_first(t.events, "user_id", large, "u", {"e": "first_type"}, ["i"], "CS Team")
    return rows.select("event_id", "first_type")


@query(
    "c15_lookup_dict_last",
    """WITH last AS (SELECT conv_id AS c, arg_max(role, (turn, text)) AS last_role FROM conversations GROUP BY 1)
       SELECT o_orderkey, coalesce(last_role, '') AS last_role FROM orders LEFT JOIN last ON o_custkey = c""",
)
def lookup_dict_last(t: Tables) -> DataFrame:
    rows = joins.lookup_last(
        t.orders, "o_custkey", t.conversations, "conv_id", {"role": "last_role"}, ["turn", "text"]
    )
    return rows.select("o_orderkey", "last_role")


@query(
    "c16_lookup_by_source",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN c_mktsegment
              ELSE coalesce(f, '') END AS channel
       FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN
       (SELECT l_orderkey, max(l_returnflag) AS f FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1)
       ON o_orderkey = l_orderkey""",
)
def lookup_by_source(t: Tables) -> DataFrame:
    rows = joins.attach(t.orders, t.customer, {"o_custkey": "c_custkey"}, ["c_mktsegment"], "inner")
    flags = t.lineitem.where(F.col("l_linestatus") == "O").groupBy("l_orderkey").agg(F.max("l_returnflag").alias("f"))
    rows = joins.attach(rows, flags, {"o_orderkey": "l_orderkey"}, ["f"])
    rows = joins.lookup_by_source(rows, "o_orderpriority", ["1-URGENT", "2-HIGH"], "c_mktsegment", "f", "channel")
    return rows.select("o_orderkey", "channel")


@query(
    "c17_literal_map_lookup",
    "WITH c(i, bucket) AS (VALUES "
    + ", ".join(f"({i}, '{v}')" for i, v in enumerate(CHANNEL_BUCKET.values()))
    + ") SELECT p_partkey, coalesce(bucket, 'No Channel Info') AS bucket FROM part LEFT JOIN c ON i = p_partkey % 60",
)
def literal_map_lookup(t: Tables) -> DataFrame:
    """Every channel of the table, and some that it doesn't know."""
    names = F.array(*[F.lit(name) for name in CHANNEL_BUCKET])
    campaign = F.coalesce(F.get(names, (F.col("p_partkey") % 60).cast("int")), F.col("p_brand"))
    return t.part.select("p_partkey", map_value(campaign, CHANNEL_BUCKET, NO_CHANNEL).alias("bucket"))


@query(
    "c18_prefix_join",
    """WITH m AS (SELECT doc_id, text AS message FROM documents),
       t AS (SELECT item_id, CASE WHEN item_id % 4 = 0 THEN left(text, 3) ELSE text END AS text FROM benchmark),
       p AS (SELECT left(text, 5) AS prefix, min(item_id) AS item_id FROM t GROUP BY 1)
       SELECT doc_id, coalesce(min(item_id)::VARCHAR, '') AS template FROM m
       LEFT JOIN p ON starts_with(message, prefix) GROUP BY doc_id""",
)
def prefix_join(t: Tables) -> DataFrame:
    cut = F.when(F.col("item_id") % 4 == 0, F.left("text", F.lit(3))).otherwise(F.col("text"))
    templates = t.benchmark.select(
        F.col("item_id").cast("string").alias("name"), cut.alias("text"), F.col("item_id").alias("ordinal")
    )
    return joins.match_template(t.documents.select("doc_id", "text"), "text", templates, "template").drop("text")


@query(
    "c19_full_outer_counts",
    """SELECT props AS label, count(*) FILTER (ts < TIMESTAMP '2024-01-02') AS day_count,
              count(*) FILTER (ts >= TIMESTAMP '2024-01-10') AS later_count FROM events
       WHERE ts < TIMESTAMP '2024-01-02' OR ts >= TIMESTAMP '2024-01-10' GROUP BY 1""",
)
def full_outer_counts(t: Tables) -> DataFrame:
    labelled = t.events.withColumnRenamed("props", "label")
    d = F.to_date("ts")
    first = count_group(labelled.where(d < F.lit("2024-01-02").cast("date")), "label")
    second = count_group(labelled.where(d >= F.lit("2024-01-10").cast("date")), "label")
    return joins.merge_counts(first, second, "label", ("day_count", "later_count"))


@query(
    "c20_classify_by_membership",
    """SELECT conv_id, turn, CASE WHEN conv_id IN (SELECT conv_id FROM conversations WHERE text LIKE '%the%') THEN 'Yes'
              WHEN conv_id IN (SELECT conv_id FROM conversations WHERE text LIKE '%le%') THEN 'No' ELSE ' ' END AS answer
       FROM conversations""",
)
def classify_by_membership(t: Tables) -> DataFrame:
    rows = t.conversations.select("conv_id", "turn", "text")
    yes, no = rows.where(F.col("text").contains("the")), rows.where(F.col("text").contains("le"))
    out = joins.classify_membership(rows, "conv_id", [("Yes", yes, "conv_id"), ("No", no, "conv_id")], "answer")
    return out.drop("text")


@query(
    "c21_merge_replace_column",
    """SELECT o_orderkey, c_nationkey AS city FROM orders LEFT JOIN
       (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') ON o_custkey = c_custkey""",
)
def merge_replace_column(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.col("o_custkey").alias("agent"), F.col("o_orderstatus").alias("city"))
    home = t.customer.where(F.col("c_mktsegment") != "BUILDING").select(
        F.col("c_custkey").alias("agent"), F.col("c_nationkey").alias("city")
    )
    return joins.replace_column(rows, "city", home, "agent").select("o_orderkey", "city")


TEAM_SQL = """team AS (SELECT DISTINCT c_nationkey AS city, l_suppkey AS member FROM lineitem
         JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""


@query(
    "c22_delimited_membership_join",
    f"""WITH {TEAM_SQL} SELECT city, count(*) AS members,
               count(*) FILTER (s_nationkey <> city) AS other_city_members
        FROM team LEFT JOIN supplier ON member = s_suppkey GROUP BY 1""",
)
def delimited_membership_join(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", F.col("l_suppkey").cast("string").alias("m"))
    lines = joins.attach(lines, t.orders, {"l_orderkey": "o_orderkey"}, ["o_custkey"], "inner")
    lines = joins.attach(lines, t.customer, {"o_custkey": "c_custkey"}, {"c_nationkey": "city"}, "inner")
    teams = concat_distinct_per_key(lines, ["city"], "m", "members_text")
    staff = t.supplier.select(F.col("s_suppkey").cast("string").alias("id"), "s_nationkey")
    return joins.member_home_counts(teams, "city", "members_text", staff, "id", "s_nationkey")


@query(
    "c23_slot_left_join",
    """WITH s AS (SELECT event_type, strftime(ts, '%H') AS h, ts, event_id FROM events)
       SELECT a.event_type, h::INT AS hour, n, coalesce(m, 0) AS scheduled FROM
       (SELECT event_type, h, count(*) AS n FROM s WHERE ts < TIMESTAMP '2024-01-02' GROUP BY 1, 2) a LEFT JOIN
       (SELECT event_type, h, count(*) AS m FROM s WHERE ts >= TIMESTAMP '2024-01-29' GROUP BY 1, 2) b USING (event_type, h)""",
)
def slot_left_join(t: Tables) -> DataFrame:
    slotted = t.events.withColumn("slot", hour_slot(F.col("ts")))
    first = F.to_date("ts") < F.lit("2024-01-02").cast("date")
    last = F.to_date("ts") >= F.lit("2024-01-29").cast("date")
    base = count_group(slotted.where(first), "event_type", "slot")
    scheduled = count_group(slotted.where(last), "event_type", "slot", out="scheduled")
    rows = joins.attach_slot_counts(base, scheduled, ["event_type", "slot"], "scheduled")
    return rows.select("event_type", slot_ordinal(F.col("slot")).alias("hour"), "n", "scheduled")
