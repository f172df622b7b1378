"""Three poll windows as streams.

``withWatermark`` needs an instant, so zone-free UTC times become instants on their way in and
zone-free again on their way out. Windows are cut on UTC hours in any session zone.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from opsreports.functions.times import as_utc, from_utc
from opsreports.operators.aggregates import counts_if


def read_files(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """A folder that parquet files land in, as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def _timed(stream: DataFrame, ts: str, late: str) -> DataFrame:
    return stream.withColumn(ts, as_utc(F.col(ts))).withWatermark(ts, late)


def _window_columns(df: DataFrame) -> DataFrame:
    bounds = {
        "window_start": from_utc(F.col("window.start")),
        "window_end": from_utc(F.col("window.end")),
    }
    return df.withColumns(bounds).drop("window")


def latest_versions(
    stream: DataFrame, ts: str, call: str, version: str, late: str = "20 minutes", slice_length: str = "10 minutes"
) -> DataFrame:
    """One row per call and slice of its time, with the columns of its greatest version, once the slice has settled.

    A call keeps its time in all its versions. Its state is one row, held until the watermark has passed the slice. Equal versions are
    settled by the other columns. ``slice`` is the slice; the time comes back as the moment of the slice that a further window needs.
    """
    others = [c for c in stream.columns if c not in (ts, call)]
    first = [version, *[c for c in others if c != version]]
    last = _timed(stream, ts, late).groupBy(F.window(ts, slice_length).alias("slice"), call).agg(F.max(F.struct(*first)).alias("_last"))
    return last.select(F.window_time("slice").alias(ts), call, *[F.col(f"_last.{c}").alias(c) for c in others])


def call_status(
    stream: DataFrame, ts: str, dims: list[str], tests: Mapping[str, Column], settle: str = "20 minutes",
    slice_length: str = "10 minutes", call: str | None = None, version: str | None = None,
) -> DataFrame:
    """Status counts per slice; a slice comes out once its rows have settled.

    The settling time is the watermark, so a closed slice is final. ``call`` and ``version``: a call that arrives again with a new
    status counts once, under its last one; the versions are settled by one stateful step and counted by the next.
    """
    timed = _timed(stream, ts, settle) if call is None else latest_versions(stream, ts, call, version, settle, slice_length)
    counted = timed.groupBy(F.window(ts, slice_length), *dims).agg(*counts_if(tests), F.count(F.lit(1)).alias("n"))
    return _window_columns(counted)


def hourly_feedback(
    stream: DataFrame, ts: str, cases: DataFrame, key: str, case_key: str, city: str, catch_all: str = "NOCITY",
    late: str = "10 minutes",
) -> DataFrame:
    """Answers per city and whole hour; an answer of an unknown case goes to the catch-all.

    ``cases`` is a static frame with one row per case.
    """
    side = cases.select(F.col(case_key).alias("_case"), F.col(city).alias("city"))
    placed = _timed(stream, ts, late).join(side, F.col(key) == F.col("_case"), "left").drop("_case")
    named = placed.withColumn("city", F.coalesce("city", F.lit(catch_all)))
    counted = named.groupBy(F.window(ts, "1 hour"), "city").agg(F.count(F.lit(1)).alias("answers"))
    return _window_columns(counted)


def payment_notices(stream: DataFrame, ts: str, appointment: str, late: str = "2 minutes") -> DataFrame:
    """One row per appointment among payments that arrive within the time of each other."""
    timed = _timed(stream, ts, late).dropDuplicatesWithinWatermark([appointment])
    return timed.withColumn(ts, from_utc(F.col(ts)))


def run_to_files(view: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there, append it to a parquet folder, and stop."""
    query = (
        view.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
