"""B: projections, filters and predicates on the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from opsreports.checks.registry import EVENTS_AS_OF, Tables, query
from opsreports.functions import labels
from opsreports.operators import filters
from opsreports.operators.joins import attach

# The nation names of the driver's tables take the place of city names.
CODES = {"NATION_0": "CHD", "NATION_1": "BLR"}
CODES_5 = {**CODES, "NATION_2": "JPR", "NATION_3": "NCR", "NATION_4": "HYD"}
CODE_SQL = "CASE {0} WHEN 'NATION_0' THEN 'CHD' WHEN 'NATION_1' THEN 'BLR' ELSE {0} END"
CODE_5_SQL = (
    "CASE {0} WHEN 'NATION_0' THEN 'CHD' WHEN 'NATION_1' THEN 'BLR' WHEN 'NATION_2' THEN 'JPR' "
    "WHEN 'NATION_3' THEN 'NCR' WHEN 'NATION_4' THEN 'HYD' ELSE {0} END"
)


def with_cities(t: Tables) -> DataFrame:
    """Line items with the nation of the supplier (case city) and of the customer (patient city).

    Suppliers in debt count as having no city, customers of one segment too.
    """
    suppliers = t.supplier.where(F.col("s_acctbal") > 0)
    customers = t.customer.where(F.col("c_mktsegment") != "BUILDING")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    lines = attach(lines, t.orders, {"l_orderkey": "o_orderkey"}, ["o_custkey"], "inner")
    lines = attach(lines, suppliers, {"l_suppkey": "s_suppkey"}, ["s_nationkey"])
    lines = attach(lines, customers, {"o_custkey": "c_custkey"}, ["c_nationkey"])
    lines = attach(lines, t.nation, {"s_nationkey": "n_nationkey"}, {"n_name": "case_city"})
    return attach(lines, t.nation, {"c_nationkey": "n_nationkey"}, {"n_name": "patient_city"})


CITIES_SQL = """FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
       LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey AND s.s_acctbal > 0
       LEFT JOIN customer c ON o.o_custkey = c.c_custkey AND c.c_mktsegment <> 'BUILDING'
       LEFT JOIN nation a ON s.s_nationkey = a.n_nationkey
       LEFT JOIN nation b ON c.c_nationkey = b.n_nationkey"""


@query(
    "b01_project_rename",
    """SELECT l_orderkey AS appointment_id, l_linenumber AS line, l_extendedprice AS fee FROM lineitem""",
)
def project_rename(t: Tables) -> DataFrame:
    names = {"l_orderkey": "appointment_id", "l_linenumber": "line", "l_extendedprice": "fee"}
    return t.lineitem.select(*names).withColumnsRenamed(names)


@query("b02_city_code_1", f"SELECT n_nationkey, {CODE_SQL.format('n_name')} AS city FROM nation")
def city_code_1(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey", labels.city_code(F.col("n_name"), codes=CODES).alias("city"))


@query(
    "b03_city_code_2",
    f"""SELECT l_orderkey, l_linenumber, coalesce({CODE_SQL.format('coalesce(a.n_name, b.n_name)')}, 'No City') AS city
        {CITIES_SQL}""",
)
def city_code_2(t: Tables) -> DataFrame:
    city = labels.city_code(F.col("case_city"), F.col("patient_city"), codes=CODES)
    return with_cities(t).select("l_orderkey", "l_linenumber", city.alias("city"))


@query(
    "b04_city_code_5",
    f"""SELECT l_orderkey, l_linenumber, coalesce({CODE_5_SQL.format('coalesce(a.n_name, b.n_name)')}, 'No City') AS city
        {CITIES_SQL}""",
)
def city_code_5(t: Tables) -> DataFrame:
    city = labels.city_code(F.col("case_city"), F.col("patient_city"), codes=CODES_5)
    return with_cities(t).select("l_orderkey", "l_linenumber", city.alias("city"))


@query(
    "b05_filter_eq_in",
    """SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
       AND o_orderstatus NOT IN ('O', 'P') AND o_orderdate IS NOT NULL AND o_orderkey != o_custkey""",
)
def filter_eq_in(t: Tables) -> DataFrame:
    return t.orders.where(
        (F.col("o_orderstatus") == "F")
        & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        & ~F.col("o_orderstatus").isin("O", "P")
        & F.col("o_orderdate").isNotNull()
        & (F.col("o_orderkey") != F.col("o_custkey"))
    ).select("o_orderkey")


@query(
    "b06_filter_frame",
    """SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority FROM orders
       WHERE nullif(o_orderpriority, '5-LOW') IS DISTINCT FROM '1-URGENT'
       AND coalesce(nullif(o_orderpriority, '5-LOW'), '') NOT IN ('2-HIGH', '3-MEDIUM')""",
)
def filter_frame(t: Tables) -> DataFrame:
    priority = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    named = t.orders.select("o_orderkey", priority.alias("priority"))
    column = F.col("priority")
    return named.where(filters.differs(column, "1-URGENT") & filters.not_among(column, "2-HIGH", "3-MEDIUM"))


@query(
    "b07_filter_nonblank",
    """SELECT doc_id FROM documents WHERE source IS NOT NULL AND source NOT IN ('src0', 'src1')""",
)
def filter_nonblank(t: Tables) -> DataFrame:
    source = F.when(F.col("source") == "src0", "").when(F.col("source") != "src1", F.col("source"))
    return t.documents.where(filters.non_blank(source)).select("doc_id")


@query(
    "b08_filter_local_date_range",
    """SELECT event_id FROM events WHERE CAST(ts + INTERVAL '330 minutes' AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'""",
)
def filter_local_date_range(t: Tables) -> DataFrame:
    inside = filters.between_local_dates(F.col("ts"), dt.date(2024, 1, 10), dt.date(2024, 1, 16))
    return t.events.where(inside).select("event_id")


@query(
    "b09_filter_date_range",
    """SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-05-01' AND DATE '1998-06-16'""",
)
def filter_date_range(t: Tables) -> DataFrame:
    inside = filters.between_dates(F.col("o_orderdate"), dt.date(1998, 5, 1), dt.date(1998, 6, 16))
    return t.orders.where(inside).select("o_orderkey")


@query(
    "b10_filter_trailing_window",
    """SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-17 13:55:30' AND ts < TIMESTAMP '2024-01-17 14:05:30'
              THEN 1 ELSE 0 END AS settled
       FROM events WHERE ts > TIMESTAMP '2024-01-17 08:25:30' AND ts <= TIMESTAMP '2024-01-17 14:25:30'""",
)
def filter_trailing_window(t: Tables) -> DataFrame:
    settled = filters.trailing_window(
        F.col("ts"), EVENTS_AS_OF, dt.timedelta(minutes=30), dt.timedelta(minutes=20)
    )
    recent = t.events.where(filters.within_last(F.col("ts"), EVENTS_AS_OF, dt.timedelta(hours=6)))
    return recent.select("event_id", settled.cast("int").alias("settled"))


@query(
    "b11_filter_previous_hour",
    """SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-17 13:00:00' AND ts < TIMESTAMP '2024-01-17 14:00:00'""",
)
def filter_previous_hour(t: Tables) -> DataFrame:
    return t.events.where(filters.previous_hour(F.col("ts"), EVENTS_AS_OF)).select("event_id")


@query("b12_filter_due_before", "SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-17 14:25:30'")
def filter_due_before(t: Tables) -> DataFrame:
    return t.events.where(filters.due_before(F.col("ts"), EVENTS_AS_OF)).select("event_id")


@query(
    "b13_filter_pair_exclusion",
    """SELECT o_orderkey FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')""",
)
def filter_pair_exclusion(t: Tables) -> DataFrame:
    kept = filters.not_pair(F.col("o_orderstatus"), "F", F.col("o_orderpriority"), "1-URGENT")
    return t.orders.where(kept).select("o_orderkey")


@query(
    "b14_filter_min_age_days",
    """SELECT event_id FROM events
       WHERE floor((epoch_us(TIMESTAMP '2024-01-17 14:25:30') - epoch_us(ts)) / 86400000000) >= 1""",
)
def filter_min_age_days(t: Tables) -> DataFrame:
    return t.events.where(filters.min_age_days(F.col("ts"), EVENTS_AS_OF, 1)).select("event_id")


@query(
    "b15_filter_regex",
    """SELECT conv_id, turn FROM conversations WHERE regexp_matches(text, 'the|[0-9]+ ', 's')""",
)
def filter_regex(t: Tables) -> DataFrame:
    return t.conversations.where(filters.matches(F.col("text"), "the|[0-9]+ ")).select("conv_id", "turn")


STATUS_CODES = {"F": "DONE", "O": "OPEN"}


@query(
    "b16_code_to_label",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'DONE' WHEN 'O' THEN 'OPEN' ELSE 'NA' END AS lenient,
              CASE o_orderstatus WHEN 'F' THEN 'DONE' WHEN 'O' THEN 'OPEN' ELSE 'PENDING' END AS strict FROM orders""",
)
def code_to_label(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    return t.orders.select(
        "o_orderkey",
        labels.code_to_label(status, STATUS_CODES).alias("lenient"),
        labels.code_to_label_strict(status, {**STATUS_CODES, "P": "PENDING"}).alias("strict"),
    )


@query(
    "b17_default_if_null",
    """SELECT c_custkey, coalesce(n_name, 'N.A') AS city, coalesce(n_nationkey, -1)::BIGINT AS city_id
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey < 2""",
)
def default_if_null(t: Tables) -> DataFrame:
    known = attach(
        t.customer, t.nation.where(F.col("n_regionkey") < 2), {"c_nationkey": "n_nationkey"}, ["n_name", "n_nationkey"]
    )
    return known.select(
        "c_custkey",
        F.coalesce("n_name", F.lit("N.A")).alias("city"),
        F.coalesce("n_nationkey", F.lit(-1)).cast("bigint").alias("city_id"),
    )


@query(
    "b18_attach_literal",
    """SELECT s_suppkey, 'Hyderabad' AS city, 1 AS batch FROM supplier""",
)
def attach_literal(t: Tables) -> DataFrame:
    return t.supplier.select("s_suppkey").withColumns({"city": F.lit("Hyderabad"), "batch": F.lit(1)})


@query(
    "b19_cast_columns",
    """SELECT o_orderkey::VARCHAR AS id, TRY_CAST(split_part(o_orderpriority, '-', 1) AS BIGINT) AS priority,
              TRY_CAST(split_part(o_orderpriority, '-', 2) AS BIGINT) AS not_a_number, o_totalprice::DOUBLE AS fee FROM orders""",
)
def cast_columns(t: Tables) -> DataFrame:
    part = lambda i: F.split_part("o_orderpriority", F.lit("-"), F.lit(i)).try_cast("bigint")
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("id"),
        part(1).alias("priority"),
        part(2).alias("not_a_number"),
        F.col("o_totalprice").cast("double").alias("fee"),
    )


@query(
    "b20_route_by_city",
    """SELECT CASE WHEN n_name IN ('NATION_0', 'NATION_1', 'NATION_2') THEN n_name ELSE 'NOCITY' END AS city, count(*) AS n
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def route_by_city(t: Tables) -> DataFrame:
    placed = attach(t.orders, t.customer, {"o_custkey": "c_custkey"}, ["c_nationkey"], "inner")
    placed = attach(placed, t.nation, {"c_nationkey": "n_nationkey"}, ["n_name"], "inner")
    city = labels.route(F.col("n_name"), ["NATION_0", "NATION_1", "NATION_2"], "NOCITY")
    return placed.groupBy(city.alias("city")).agg(F.count("*").alias("n"))
