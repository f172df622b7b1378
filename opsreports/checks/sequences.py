"""E, F and G: sequences, sorts and set operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from opsreports.checks.aggregates import WORKLOAD_SQL, workload
from opsreports.checks.registry import AS_OF, Tables, query
from opsreports.functions.times import day, slot_ordinal
from opsreports.operators import aggregates as agg, ledger, sequences as seq


@query(
    "e01_first_per_key",
    """SELECT o_custkey, o_orderkey, o_orderstatus FROM
       (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r = 1""",
)
def first_per_key(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return seq.first_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "e02_rank_average",
    """SELECT o_orderkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate)
              + (count(*) OVER (PARTITION BY o_custkey, o_orderdate) - 1) / 2.0 AS rank FROM orders""",
)
def rank_average(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return seq.rank_average(rows, "o_custkey", "o_orderdate").select("o_orderkey", "rank")


@query(
    "e03_new_or_existing",
    """WITH f AS (SELECT o_custkey, o_orderkey, o_orderpriority, min(o_orderkey) OVER (PARTITION BY o_custkey) AS m FROM orders)
       SELECT o_orderkey, CASE WHEN o_orderkey = m THEN 'New Patient' ELSE 'Existing patient' END AS patient_type
       FROM f WHERE o_orderpriority = '1-URGENT'""",
)
def new_or_existing(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    out = seq.new_or_existing(rows, "o_custkey", "o_orderkey", F.col("o_orderpriority") == "1-URGENT")
    return out.select("o_orderkey", "patient_type")


@query(
    "e04_followup_pair",
    """WITH a AS (SELECT user_id, min(event_id) AS first_event_id FROM events WHERE event_type = 'error' GROUP BY 1),
       b AS (SELECT user_id, min(event_id) AS second_event_id FROM events JOIN a USING (user_id)
             WHERE event_type = 'purchase' AND event_id > first_event_id GROUP BY 1)
       SELECT a.user_id, first_event_id, x.value AS first_value, second_event_id, y.value AS second_value
       FROM a LEFT JOIN b ON a.user_id = b.user_id LEFT JOIN events x ON x.event_id = first_event_id
       LEFT JOIN events y ON y.event_id = second_event_id""",
)
def followup_pair(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    return seq.followup_pair(t.events, "user_id", "event_id", kind == "error", kind == "purchase", ["value"])


LEDGER = {
    "id": "o_orderkey", "customer": "o_custkey", "kind": "o_orderstatus", "amount": "o_totalprice",
    "created": "created", "end": "valid_till",
}


def proxy_ledger(t: Tables, *, days: int | None) -> DataFrame:
    """Orders as a wallet ledger: F is a credit, O a debit. Debits are cut to a third, as
    otherwise few customers would have anything left."""
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    third = F.floor(amount / 3).cast("decimal(18,2)")
    created = F.to_date("o_orderdate")
    valid = F.lit(None).cast("date") if days is None else F.date_add(created, days + (F.col("o_orderkey") % 3).cast("int") * 40)
    return t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.when(F.col("o_orderstatus") == "O", third).otherwise(amount).alias("o_totalprice"),
        created.alias("created"), valid.alias("valid_till"),
    )


@query(
    "e05_ledger_no_expiry",
    """WITH l AS (SELECT *, o_orderdate AS d, CASE WHEN o_orderstatus = 'O' THEN floor(o_totalprice::DECIMAL(18,2) / 3)
                   ELSE o_totalprice END::DECIMAL(18,2) AS amt FROM orders),
       c AS (SELECT o_orderkey, o_custkey, amt, sum(amt) OVER (PARTITION BY o_custkey ORDER BY d, o_orderkey) AS cum FROM l WHERE o_orderstatus = 'F'),
       s AS (SELECT o_custkey, sum(amt) AS spent FROM l WHERE o_orderstatus = 'O' GROUP BY 1)
       SELECT o_orderkey, greatest(0, least(amt, cum - coalesce(spent, 0)))::DOUBLE AS balance
       FROM c LEFT JOIN s USING (o_custkey)""",
)
def ledger_no_expiry(t: Tables) -> DataFrame:
    out = ledger.ledger_no_expiry(proxy_ledger(t, days=None), LEDGER, "F", "O")
    return out.select("o_orderkey", F.col("balance").cast("double").alias("balance"))


@query(
    "e05_ledger_fifo",
    """WITH RECURSIVE l AS (
         SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate::DATE AS d,
                o_orderdate::DATE + 700 + (o_orderkey % 3)::INT * 40 AS v,
                (CASE WHEN o_orderstatus = 'O' THEN floor(o_totalprice::DECIMAL(18,2) / 3) ELSE o_totalprice END)::DECIMAL(28,2) AS amt
         FROM orders WHERE o_orderdate < DATE '1998-06-17'),
       c AS (SELECT x.*, row_number() OVER (PARTITION BY x.o_custkey ORDER BY x.d, x.o_orderkey) AS i,
               (SELECT coalesce(sum(y.amt), 0) FROM l y WHERE y.o_custkey = x.o_custkey AND y.o_orderstatus = 'O' AND y.d < x.v)::DECIMAL(28,2) AS open
             FROM l x WHERE x.o_orderstatus = 'F'),
       p AS (SELECT o_custkey, i, o_orderkey, v, amt, 0::DECIMAL(28,2) AS before,
               greatest(0, least(amt, open))::DECIMAL(28,2) AS taken FROM c WHERE i = 1
             UNION ALL
             SELECT c.o_custkey, c.i, c.o_orderkey, c.v, c.amt, p.taken,
               greatest(p.taken, least(p.taken + c.amt, c.open))::DECIMAL(28,2)
             FROM p JOIN c ON c.o_custkey = p.o_custkey AND c.i = p.i + 1)
       SELECT o_orderkey, (CASE WHEN v >= DATE '1998-06-17' THEN amt - (taken - before) ELSE 0 END)::DOUBLE AS balance FROM p""",
)
def ledger_fifo(t: Tables) -> DataFrame:
    entries = proxy_ledger(t, days=700).where(F.col("created") < day(AS_OF))
    out = ledger.ledger_balances(entries, AS_OF, LEDGER, "F", "O")
    return out.select("o_orderkey", F.col("balance").cast("double").alias("balance"))


@query(
    "e06_latest_reason",
    """SELECT conv_id, coalesce(split_part(arg_max(text, turn), ',', 1), '') AS reason FROM conversations GROUP BY 1""",
)
def latest_reason(t: Tables) -> DataFrame:
    return seq.latest_reason(t.conversations, "conv_id", "text", "turn")


@query("e07_first_event_user", "SELECT conv_id, arg_min(role, turn) AS first_user FROM conversations GROUP BY 1")
def first_event_user(t: Tables) -> DataFrame:
    return seq.first_event_user(t.conversations, "conv_id", "role", "turn")


@query(
    "e08_comment_history",
    """SELECT conv_id, 0::BIGINT AS part, 'User Comments: ' || chr(10) || ' ' ||
              string_agg(turn::VARCHAR || ' : ' || text || ' ' || chr(10), '' ORDER BY turn) AS history
       FROM conversations WHERE text <> '' GROUP BY 1""",
)
def comment_history(t: Tables) -> DataFrame:
    return seq.comment_history(
        t.conversations, "conv_id", "turn", F.col("turn"), "text", seq.HISTORY_HEADING["CASE"]
    )


@query(
    "e09_serial_number",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS serial FROM orders""",
)
def serial_number(t: Tables) -> DataFrame:
    return seq.serial_number(t.orders.select("o_orderkey"), "o_orderkey")


@query("f01_sort_keys", "SELECT o_custkey, o_orderkey FROM orders ORDER BY o_custkey, o_orderkey")
def sort_keys(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey", "o_orderkey").orderBy("o_custkey", "o_orderkey")


@query(
    "f02_sort_by_slot_order",
    f"WITH {WORKLOAD_SQL} SELECT city, hour AS ordinal, queued FROM w ORDER BY 1, 2",
)
def sort_by_slot_order(t: Tables) -> DataFrame:
    rows = workload(t).withColumn("ordinal", slot_ordinal(F.col("slot")))
    shown = rows.where(F.col("ordinal").isNotNull())
    return shown.select("city", "ordinal", "queued").orderBy("city", "ordinal")


@query(
    "f03_sort_by_measure",
    """SELECT user_id, count(*) FILTER (event_type = 'error') AS busy FROM events GROUP BY 1 ORDER BY 2, 1""",
)
def sort_by_measure(t: Tables) -> DataFrame:
    table = agg.crosstab(t.events, ["user_id"], F.col("event_type"), {"busy": "error"})
    return table.orderBy("busy", "user_id")


@query("f04_limit_rows", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 3000")
def limit_rows(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey").orderBy("o_orderkey").limit(3000)


@query(
    "g01_union_distinct_ids",
    """SELECT o_custkey AS id FROM orders WHERE o_orderstatus = 'P' UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0""",
)
def union_distinct_ids(t: Tables) -> DataFrame:
    pending = t.orders.where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("id"))
    owing = t.customer.where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("id"))
    return pending.union(owing).distinct()


@query(
    "g02_concat_batches",
    """SELECT s_suppkey AS id, s_nationkey AS city, NULL AS segment FROM supplier
       UNION ALL SELECT c_custkey, c_nationkey, c_mktsegment FROM customer""",
)
def concat_batches(t: Tables) -> DataFrame:
    first = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("city"))
    second = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("city"), F.col("c_mktsegment").alias("segment")
    )
    return first.unionByName(second, allowMissingColumns=True)


@query("g03_append_literal_member", "SELECT n_name AS city FROM nation UNION ALL SELECT 'NOCITY'")
def append_literal_member(t: Tables) -> DataFrame:
    cities = t.nation.select(F.col("n_name").alias("city"))
    return cities.union(t.spark.range(1).select(F.lit("NOCITY")))
