"""Readers: tables, windows of a table, sheets and landed JSON."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from opsreports.functions.times import Window, local_date
from opsreports.operators.aggregates import in_window
from opsreports.operators.filters import between_local_dates
from opsreports.sources.writers import NULL_MARK


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None, **options
) -> DataFrame:
    """A table by path, in any format Spark knows."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    **options,
) -> DataFrame:
    """An operational table over JDBC, read in parallel ranges of a numeric column.

    Filters and columns are pushed to the database; the bounds only shape the ranges, rows
    outside them are still read.
    """
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=partition_column, lowerBound=lower, upperBound=upper,
                 numPartitions=partitions, **options)
        .load()
    )


def read_warehouse(spark: SparkSession, table: str, fmt: str | None = None, **options) -> DataFrame:
    """A warehouse table: a catalog table, or a connector's table when a format is named."""
    if fmt is None:
        return spark.read.table(table)
    return spark.read.format(fmt).options(table=table, **options).load()


def by_window(
    df: DataFrame, ts: Column, windows: Sequence[Window], offset: dt.timedelta = dt.timedelta(0), out: str = "window"
) -> DataFrame:
    """One copy of each row per window its (shifted) date lies in, from a single scan.

    Rows outside all windows are left out by one range on the bare column, which the scan takes.
    """
    first, last = min(w.start for w in windows), max(w.end for w in windows)
    date = local_date(ts, offset)
    hits = F.array_compact(F.array(*[F.when(in_window(date, w), F.lit(w.name)) for w in windows]))
    return df.where(between_local_dates(ts, first, last, offset)).withColumn(out, F.explode(hits))


# Cells may hold line breaks. An empty unquoted cell, as other programs write it, is NULL too.
SHEET = {"header": True, "escape": '"', "nullValue": NULL_MARK, "multiLine": True}


def _plain(sheet: DataFrame) -> DataFrame:
    """The guard of ``writers.guarded`` taken off."""
    texts = [f.name for f in sheet.schema.fields if isinstance(f.dataType, T.StringType)]
    return sheet.withColumns({c: F.regexp_replace(sheet[c], r"^\\(\\+N)$", "$1") for c in texts})


def read_records(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """A sheet with a header as typed records."""
    return _plain(spark.read.options(**{**SHEET, **options}).schema(schema).csv(path))


def read_raw(spark: SparkSession, path: str, names: Mapping[str, str] | None = None, **options) -> DataFrame:
    """A sheet as text cells under its own header, long titles renamed."""
    raw = _plain(spark.read.options(**{**SHEET, "inferSchema": False, **options}).csv(path))
    return raw.withColumnsRenamed(dict(names or {}))


def key_list(sheet: DataFrame, key: str, instruction: Column) -> DataFrame:
    """The key column of a sheet without its instruction row, as numbers."""
    return sheet.where(~F.coalesce(instruction, F.lit(False))).select(F.col(key).try_cast("bigint").alias(key))


def explode_json(df: DataFrame, column: str, item: T.StructType, keep: Sequence[str]) -> DataFrame:
    """One row per object of a JSON array, with the kept columns; an empty array gives none."""
    parsed = F.from_json(F.col(column), T.ArrayType(item))
    return df.select(*keep, F.inline(parsed))


def split_json(df: DataFrame, column: str, item: T.StructType, keep: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """As ``explode_json``, and beside it what that would drop without a trace.

    The body is parsed once, as a VARIANT, and every field is taken from that. The second frame has the kept columns, the body and why it is there:
    ``malformed`` (no JSON) or ``not a list``. Fields that don't fit their type are NULL; NULL bodies are no bodies.
    """
    parsed = df.where(F.col(column).isNotNull()).select(*keep, column, F.try_parse_json(F.col(column)).alias("_body"))
    items = F.try_variant_get("_body", "$", "array<variant>")
    why = F.when(F.col("_body").isNull(), "malformed").when(items.isNull(), "not a list")
    bad = parsed.withColumn("why", why).where(F.col("why").isNotNull()).select(*keep, column, "why")
    fields = [F.try_variant_get("_item", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in item.fields]
    return parsed.select(*keep, F.explode(items).alias("_item")).select(*keep, *fields), bad


def read_delivered(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What ``writers.deliver`` wrote: the rows with their set and place, whose columns are part of the schema."""
    return spark.read.schema(schema).parquet(path)


TEMPLATES = T.MapType(T.StringType(), T.StructType([T.StructField("text", T.StringType())]))


def explode_templates(df: DataFrame, column: str) -> DataFrame:
    """JSON objects ``{name: {"text": ...}}`` as name, text and place in their object."""
    entries = F.map_entries(F.from_json(F.col(column), TEMPLATES))
    rows = df.select(F.posexplode(entries).alias("ordinal", "entry"))
    return rows.select(
        F.col("entry.key").alias("name"), F.col("entry.value.text").alias("text"), F.col("ordinal").cast("bigint")
    )


def read_templates(spark: SparkSession, path: str) -> DataFrame:
    """The templates of a JSON file that holds one object, in file order."""
    return explode_templates(spark.read.text(path, wholetext=True), "value")
