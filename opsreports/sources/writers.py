"""Writers: CSV dumps, workbooks, tables with a declared schema, appends."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from opsreports.operators.joins import drop_known
from opsreports.sources.stores import Published


# How cells are written and read, so that line breaks, quotes, edge spaces, empty text and NULL come back as they
# were: every cell is quoted, quotes inside are doubled, and NULL is spelled \\N.
NULL_MARK = "\\N"
CSV = {"header": True, "quoteAll": True, "escape": '"', "nullValue": NULL_MARK, "emptyValue": "",
       "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def guarded(df: DataFrame) -> DataFrame:
    """Text cells that would read as NULL, however often guarded before, get one more backslash."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.regexp_replace(df[c], r"^(\\+N)$", r"\\$1") for c in texts})


def _put(df: DataFrame, path: str) -> None:
    guarded(df).write.options(**CSV).csv(path)


def write_csv(df: DataFrame, path: str) -> str:
    """Detail rows as CSV with a header; ``readers.read_records`` gives the same cells back."""
    _put(df, path)
    return path


def write_workbook(sheets: Mapping[str, DataFrame], path: str) -> dict[str, str]:
    """One data set per sheet below one folder: ``path/sheet=<name>``."""
    made = {}
    for name, df in sheets.items():
        made[name] = f"{path}/sheet={name}"
        _put(df, made[name])
    return made


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, cast to the declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_truncate(df: DataFrame, path: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> str:
    """Replace a table by these rows, in its declared schema; the folder of the new version.

    ``stores.Published(spark, path).read(schema)`` gives the version that counts. The old one stays readable until the new one is whole.
    """
    return Published(df.sparkSession, path).publish(conform(df, schema), partition_by)


def deliver(rows: DataFrame, sets: Mapping[str, Column], path: str, place: str = "city", catch_all: str = "NOCITY") -> str:
    """Detail sets to ``path/set=<name>/<place>=<value>``, all in one job over one reading of the rows.

    A row goes to every set whose test it passes, below its place, or the catch-all where it has none. Only folders that get rows are replaced, so a
    run that is repeated leaves the same files' worth of rows, and other days' or places' folders stay. A hot place is spread over several files.
    """
    hits = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in sets.items()]))
    tagged = rows.withColumn("set", F.explode(hits)).withColumn(place, F.coalesce(F.col(place), F.lit(catch_all)))
    tagged.hint("rebalance", "set", place).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("set", place).parquet(path)
    return path


def append_rows(df: DataFrame, path: str) -> str:
    """Add rows below the existing ones."""
    df.write.mode("append").parquet(path)
    return path


def append_new_rows(df: DataFrame, key: str, path: str) -> str:
    """Add only the rows whose key the target does not hold yet."""
    target = df.sparkSession.read.parquet(path)
    return append_rows(drop_known(df, key, target, key), path)


def overwrite_rows(df: DataFrame, path: str) -> str:
    """Clear the target and write the rows."""
    df.write.mode("overwrite").parquet(path)
    return path
