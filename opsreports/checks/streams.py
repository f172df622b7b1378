"""I: the three streams over the driver's events, run to the end of the input."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from opsreports.checks.registry import Tables, query
from opsreports.operators.joins import attach
from opsreports.session import fresh_dir
from opsreports.streaming import views

# The last slices stay open until their watermark has passed, on both sides.
STREAM_END = "(SELECT max(ts) FROM events)"


def event_stream(t: Tables) -> DataFrame:
    # A pattern, since the source takes a folder or a pattern but not the name of one file.
    return views.read_files(t.spark, f"{t.sf_dir}/events.parque[t]", t.events.schema)


def finished(t: Tables, view: DataFrame, label: str) -> DataFrame:
    out = fresh_dir(t.spark, label)
    views.run_to_files(view, f"{out}/rows", f"{out}/state")
    return t.spark.read.schema(view.schema).parquet(f"{out}/rows")


def _stamps(df: DataFrame) -> DataFrame:
    stamp = F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")
    return df.withColumn("window_start", stamp).drop("window_end")


@query(
    "i01_stream_call_status",
    f"""SELECT strftime(time_bucket(INTERVAL 10 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type,
               count(*) FILTER (value < 10) AS low, count(*) FILTER (value >= 10) AS high, count(*) AS n FROM events
        WHERE time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE <= {STREAM_END} - INTERVAL 20 MINUTE GROUP BY 1, 2""",
)
def stream_call_status(t: Tables) -> DataFrame:
    tests = {"low": F.col("value") < 10, "high": F.col("value") >= 10}
    view = views.call_status(event_stream(t), "ts", ["event_type"], tests)
    return _stamps(finished(t, view, "call-status"))


@query(
    "i01_stream_call_versions",
    f"""SELECT strftime(time_bucket(INTERVAL 10 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type,
               count(*) FILTER (event_id % 3 = 0) AS busy, count(*) FILTER (event_id % 3 <> 0) AS completed, count(*) AS n FROM events
        WHERE time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE <= {STREAM_END} - INTERVAL 20 MINUTE GROUP BY 1, 2""",
)
def stream_call_versions(t: Tables) -> DataFrame:
    """Every event as a call that arrives up to three times: busy, and for two calls of three then completed; each counts once."""
    third = F.col("event_id") % 3
    arrivals = F.when(third == 0, F.array(F.lit(1), F.lit(1))).when(third == 1, F.array(F.lit(2), F.lit(1))).otherwise(F.array(F.lit(1), F.lit(2), F.lit(2)))
    calls = event_stream(t).select("event_id", "event_type", "ts", F.explode(arrivals).alias("version"))
    tests = {"busy": F.col("version") == 1, "completed": F.col("version") == 2}
    view = views.call_status(calls, "ts", ["event_type"], tests, call="event_id", version="version")
    return _stamps(finished(t, view, "call-versions"))


@query(
    "i02_stream_feedback_hourly",
    f"""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, coalesce(n_name, 'NOCITY') AS city,
               count(*) AS answers FROM events LEFT JOIN customer ON user_id = c_custkey
               LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey < 4
        WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= {STREAM_END} - INTERVAL 10 MINUTE GROUP BY 1, 2""",
)
def stream_feedback_hourly(t: Tables) -> DataFrame:
    nations = t.nation.where(F.col("n_regionkey") < 4)
    cases = attach(t.customer, nations, {"c_nationkey": "n_nationkey"}, ["n_name"])
    view = views.hourly_feedback(event_stream(t), "ts", cases, "user_id", "c_custkey", "n_name")
    return _stamps(finished(t, view, "feedback"))


@query("i03_stream_payments", "SELECT event_id, user_id, value FROM events")
def stream_payments(t: Tables) -> DataFrame:
    """Every payment arrives twice, as a retried delivery would; one of each pair remains."""
    rows = event_stream(t).select("event_id", "user_id", "value", "ts")
    twice = rows.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2)))).drop("delivery")
    view = views.payment_notices(twice, "ts", "event_id")
    return finished(t, view, "payments").drop("ts")
