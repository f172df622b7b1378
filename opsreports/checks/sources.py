"""A: sources and sinks on the driver's tables. A sink is checked by reading it back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F, types as T

from opsreports.checks.registry import AS_OF, Tables, query
from opsreports.functions.times import day as a_day, day_windows, pick_windows
from opsreports.operators.aggregates import count_group
from opsreports.session import fresh_dir
from opsreports.sources import readers, stores, writers

WINDOW_NAMES = ("month_to_date", "last_month", "last_week", "this_week")


@query(
    "a01_read_table",
    """SELECT 'orders' AS table_name, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
       UNION ALL SELECT 'events', count(*) FROM events""",
)
def read_table(t: Tables) -> DataFrame:
    out = None
    for name in ("orders", "lineitem", "events"):
        rows = readers.read_table(t.spark, f"{t.sf_dir}/{name}.parquet", "parquet", getattr(t, name).schema)
        one = rows.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "a02_read_windowed",
    """WITH w(name, a, b) AS (VALUES ('month_to_date', DATE '1998-06-01', DATE '1998-06-16'),
         ('last_month', DATE '1998-05-01', DATE '1998-05-31'), ('last_week', DATE '1998-06-08', DATE '1998-06-14'),
         ('this_week', DATE '1998-06-15', DATE '1998-06-16'))
       SELECT name AS "window", o_orderstatus, count(*) AS n FROM orders
       JOIN w ON o_orderdate::DATE BETWEEN a AND b GROUP BY 1, 2""",
)
def read_windowed(t: Tables) -> DataFrame:
    windows = pick_windows(AS_OF, *WINDOW_NAMES)
    rows = readers.by_window(t.orders, F.col("o_orderdate"), windows)
    return count_group(rows, "window", "o_orderstatus")


@query(
    "a03_read_warehouse",
    "SELECT event_type, count(*) AS n, round(sum(value::DECIMAL(18,2))::DOUBLE, 2) AS value FROM events GROUP BY 1",
)
def read_warehouse(t: Tables) -> DataFrame:
    t.events.createOrReplaceTempView("warehouse_events")
    rows = readers.read_warehouse(t.spark, "warehouse_events")
    total = F.sum(F.col("value").cast("decimal(18,2)")).cast("double")
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), total.alias("value"))


CUSTOMER_SHEET = T.StructType([
    T.StructField("c_custkey", T.LongType()),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_acctbal", T.DoubleType()),
])


TURN_SHEET = T.StructType([
    T.StructField("conv_id", T.LongType()),
    T.StructField("turn", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("note", T.StringType()),
])


@query(
    "a04_read_turns",
    """SELECT conv_id, turn, text, CASE turn % 4 WHEN 1 THEN '' WHEN 2 THEN '"' || text || chr(10) WHEN 3 THEN chr(92) || 'N' END AS note
       FROM conversations""",
)
def read_turns(t: Tables) -> DataFrame:
    """Line breaks, quotes, empty text, NULL and the very mark of NULL."""
    kind = F.col("turn") % 4
    note = F.when(kind == 1, "").when(kind == 2, F.concat(F.lit('"'), "text", F.lit("\n"))).when(kind == 3, F.lit("\\N"))
    rows = t.conversations.select("conv_id", "turn", "text", note.alias("note"))
    return readers.read_records(t.spark, writers.write_csv(rows, fresh_dir(t.spark, "turns")), TURN_SHEET)


@query("a04_read_records", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def read_records(t: Tables) -> DataFrame:
    path = writers.write_csv(t.customer.select("c_custkey", "c_name", "c_acctbal"), fresh_dir(t.spark, "records"))
    return readers.read_records(t.spark, path, CUSTOMER_SHEET)


@query(
    "a05_read_raw_promote_header",
    "SELECT c_custkey::VARCHAR AS id, c_mktsegment AS answer FROM customer",
)
def read_raw_promote_header(t: Tables) -> DataFrame:
    title = "How likely are you to recommend us?"
    sheet = t.customer.select(F.col("c_custkey").alias("caseid"), F.col("c_mktsegment").alias(title))
    path = writers.write_csv(sheet, fresh_dir(t.spark, "raw"))
    return readers.read_raw(t.spark, path, {"caseid": "id", title: "answer"})


@query("a06_read_key_list_skip", "SELECT s_suppkey AS id FROM supplier")
def read_key_list_skip(t: Tables) -> DataFrame:
    note = t.spark.range(1).select(F.lit("do not edit below").alias("id"))
    sheet = t.supplier.select(F.col("s_suppkey").cast("string").alias("id")).union(note)
    raw = readers.read_raw(t.spark, writers.write_csv(sheet, fresh_dir(t.spark, "keys")))
    return readers.key_list(raw, "id", F.col("id").try_cast("bigint").isNull())


ENTITY = T.StructType([T.StructField("k", T.LongType())])


@query(
    "a07_read_json_entities",
    """SELECT event_id, 'city-' || (user_id % 3) AS city, (props->>'$.k')::BIGINT AS k FROM events
       WHERE event_type <> 'click'""",
)
def read_json_entities(t: Tables) -> DataFrame:
    listed = F.when(F.col("event_type") == "click", "[]").otherwise(F.concat(F.lit("["), "props", F.lit("]")))
    city = F.concat(F.lit("city-"), (F.col("user_id") % 3).cast("string"))
    rows = t.events.select("event_id", city.alias("city"), listed.alias("body"))
    return readers.explode_json(rows, "body", ENTITY, ["event_id", "city"])


@query(
    "a07_json_quarantine",
    """SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'malformed' WHEN 1 THEN 'not a list' ELSE 'read' END AS state,
              CASE WHEN event_id % 5 > 1 THEN (props->>'$.k')::BIGINT END AS k FROM events""",
)
def json_quarantine(t: Tables) -> DataFrame:
    """Bodies of which some are cut short and some are no lists: rows that could be read, and beside them those that could not, by reason."""
    kind = F.col("event_id") % 5
    body = F.when(kind == 0, F.concat(F.lit("["), "props")).when(kind == 1, F.col("props")).otherwise(F.concat(F.lit("["), "props", F.lit("]")))
    rows, bad = readers.split_json(t.events.select("event_id", body.alias("body")), "body", ENTITY, ["event_id"])
    read = rows.select("event_id", F.lit("read").alias("state"), "k")
    return read.unionByName(bad.select("event_id", F.col("why").alias("state"), F.lit(None).cast("bigint").alias("k")))


@query("a08_read_template_dict", "SELECT item_id::VARCHAR AS name, text, row_number() OVER (ORDER BY item_id) - 1 AS ordinal FROM benchmark")
def read_template_dict(t: Tables) -> DataFrame:
    """All benchmark items in one object of templates, each with its place."""
    items = F.array_sort(F.collect_list(F.struct("item_id", "text")))
    entries = F.transform(items, lambda i: F.struct(i["item_id"].cast("string"), F.struct(i["text"].alias("text"))))
    path = fresh_dir(t.spark, "templates")
    t.benchmark.agg(F.to_json(F.map_from_entries(entries)).alias("value")).write.text(path)
    return readers.explode_templates(t.spark.read.text(path), "value")


@query("a09_write_csv", "SELECT doc_id, text, CASE WHEN doc_id % 3 > 0 THEN left('  x', doc_id % 3) END AS edge FROM documents")
def write_csv(t: Tables) -> DataFrame:
    """Texts with line breaks and quotes, and cells that are NULL or only spaces."""
    edge = F.when(F.col("doc_id") % 3 > 0, F.substring(F.lit("  x"), F.lit(1), (F.col("doc_id") % 3).cast("int")))
    rows = t.documents.select("doc_id", "text", edge.alias("edge"))
    return readers.read_records(t.spark, writers.write_csv(rows, fresh_dir(t.spark, "csv")), rows.schema)


@query(
    "a10_write_workbook",
    """SELECT 'customers' AS sheet, count(*) AS n FROM customer UNION ALL SELECT 'suppliers', count(*) FROM supplier""",
)
def write_workbook(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "workbook")
    writers.write_workbook(
        {"customers": t.customer.select("c_custkey"), "suppliers": t.supplier.select("s_suppkey")}, path
    )
    rows = readers.read_raw(t.spark, path)
    return count_group(rows, "sheet")


BALANCE_SCHEMA = T.StructType([
    T.StructField("customerId", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("createdOn", T.StringType()),
])


@query(
    "a11_write_truncate",
    """SELECT o_custkey::VARCHAR AS "customerId", o_totalprice AS amount, strftime(o_orderdate, '%Y-%m-%d') AS "createdOn"
       FROM orders WHERE o_orderstatus = 'P'""",
)
def write_truncate(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "truncate")
    rows = t.orders.select(
        F.col("o_custkey").alias("customerId"), F.col("o_totalprice").alias("amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("createdOn"), "o_orderstatus",
    )
    writers.write_truncate(rows, path, BALANCE_SCHEMA)
    writers.write_truncate(rows.where(F.col("o_orderstatus") == "P"), path, BALANCE_SCHEMA)
    return stores.Published(t.spark, path).read(BALANCE_SCHEMA)


@query("a12_append_rows", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('P', 'F')")
def append_rows(t: Tables) -> DataFrame:
    """Two runs of an incremental append: the second offers rows the target already holds."""
    path = fresh_dir(t.spark, "append")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    writers.append_rows(rows.where(F.col("o_orderstatus") == "P"), path)
    writers.append_new_rows(rows.where(F.col("o_orderstatus").isin("P", "F")), "o_orderkey", path)
    return t.spark.read.schema(rows.schema).parquet(path)


@query(
    "a12_append_batches",
    "SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE o_orderdate < DATE '1998-06-17'",
)
def append_batches(t: Tables) -> DataFrame:
    """Orders in four named batches that share keys; one batch is offered twice, as by a run that is repeated."""
    before = t.orders.where(F.col("o_orderdate") < a_day(AS_OF))
    rows = before.select("o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    table = stores.Appended(t.spark, fresh_dir(t.spark, "batches"), "o_orderkey", rows.schema)
    half = F.col("o_orderkey") % 2 == 0
    for name, batch in {"even": rows.where(half), "finished": rows.where("o_orderstatus = 'F'"), "even again": rows.where(half), "rest": rows}.items():
        table.append(batch, name)
    table.append(rows, "finished")
    return table.read()


DAY_DIMS, DAY_SUMS = {"o_orderpriority": "string", "o_orderstatus": "string"}, ["cents"]


@query(
    "d04_day_sums",
    """WITH l AS (SELECT o_orderpriority, o_orderdate::DATE AS d, round(o_totalprice * 100)::BIGINT AS cents FROM orders)
       SELECT o_orderpriority, """
    + ", ".join(
        f"count(*) FILTER (d BETWEEN DATE '{w.start}' AND DATE '{w.end}') AS {w.name}_n, "
        f"coalesce(sum(cents) FILTER (d BETWEEN DATE '{w.start}' AND DATE '{w.end}'), 0)::BIGINT AS {w.name}_cents"
        for w in day_windows(AS_OF)
    )
    + f" FROM l WHERE d BETWEEN DATE '{min(w.start for w in day_windows(AS_OF))}' AND DATE '{AS_OF}' GROUP BY 1",
)
def day_sums(t: Tables) -> DataFrame:
    """Month to date from kept day sums: a first load without some late orders, a day counted anew, then the late ones merged, twice offered."""
    facts = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("d"))
    late = F.col("o_orderkey") % 7 == 0
    day, measures = F.col("d"), {"cents": F.round(F.col("o_totalprice") * 100)}
    store = stores.DaySums(t.spark, fresh_dir(t.spark, "days"), DAY_DIMS, DAY_SUMS)
    store.load(facts.where(~late), day, measures)
    store.rewrite(facts.where(~late), day, measures, [AS_OF, AS_OF - dt.timedelta(days=1)])
    for _ in range(2):
        store.merge(facts.where(late), day, measures, "late")
    return store.windows(["o_orderpriority"], day_windows(AS_OF))


@query(
    "e03_first_rows",
    """SELECT o_custkey, min(o_orderkey) AS o_orderkey, strftime(arg_min(o_orderdate, o_orderkey), '%Y-%m-%d') AS day,
              arg_min(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1""",
)
def first_rows(t: Tables) -> DataFrame:
    """Each customer's first order by slices in no order, one of them taken twice."""
    rows = t.orders.select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderstatus")
    state = stores.FirstRows(t.spark, fresh_dir(t.spark, "first"), rows.schema, "o_custkey", ["o_orderkey"])
    for year in (F.col("day") >= "1996", F.col("day") < "1994", F.col("day") >= "1996", F.col("day").between("1994", "1996")):
        state.update(rows.where(year))
    return state.read()


@query("a13_overwrite_rows", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def overwrite_rows(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "overwrite")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    writers.overwrite_rows(rows.where(F.col("o_orderstatus") == "P").drop("o_orderstatus"), path)
    writers.overwrite_rows(rows.where(F.col("o_orderstatus") == "F").drop("o_orderstatus"), path)
    return t.spark.read.schema("o_orderkey bigint").parquet(path)
