"""Tables that reports keep between their runs: published versions, appended batches, day sums and first rows.

All of them write whole folders that nobody reads yet, and then add a row to a small table of what counts (a pointer, a
manifest). Spark shows such a row only once its job is committed, so a job that dies before leaves everything as it was, and one that
is repeated finds what is done. Folders that no longer count are removed by age, never by the run that replaces them.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from opsreports.functions.times import Window, day as a_day
from opsreports.operators.aggregates import in_window
from opsreports.operators.joins import drop_known, reshuffled


def _located(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    files, found = _located(spark, path)
    return files.exists(found)


class Ledgered:
    """A root folder with a small table of what counts in it."""

    SCHEMA = ""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def entries(self) -> DataFrame:
        """The rows of the small table; none before the first commit."""
        if not exists(self.spark, f"{self.root}/entries"):
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(f"{self.root}/entries")

    def _enter(self, rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("append").parquet(f"{self.root}/entries")

    def _folder(self) -> str:
        return f"{self.root}/data/{uuid.uuid4().hex}"


class Published(Ledgered):
    """A table that is replaced as a whole: each version in a folder of its own, and a pointer to the one that counts."""

    SCHEMA = "number bigint, folder string, at timestamp"

    def current(self) -> tuple[int, str] | None:
        row = self.entries().orderBy(F.desc("number"), "folder").first()
        return None if row is None else (row["number"], row["folder"])

    def publish(self, df: DataFrame, partition_by: Sequence[str] = ()) -> str:
        """Writes a version, then moves the pointer to it. Readers keep the version they have resolved."""
        folder = self._folder()
        df.write.partitionBy(*partition_by).parquet(folder)
        self.point(folder)
        return folder

    def point(self, folder: str) -> None:
        known = self.current()
        number = 1 if known is None else known[0] + 1
        self._enter(self.spark.range(1).select(F.lit(number).cast("bigint").alias("number"), F.lit(folder).alias("folder"), F.current_timestamp().alias("at")))

    def read(self, schema: T.StructType) -> DataFrame:
        """The rows of the version that counts now; none before the first."""
        known = self.current()
        return self.spark.createDataFrame([], schema) if known is None else self.spark.read.schema(schema).parquet(known[1])

    def retire(self, before: dt.datetime) -> list[str]:
        """Removes the folders of versions that were replaced before a moment (UTC), and names them."""
        rows = self.entries().orderBy("number").select("folder", F.col("at").cast("double").alias("at")).collect()
        limit = before.replace(tzinfo=dt.timezone.utc).timestamp()
        gone = [a["folder"] for a, b in zip(rows, rows[1:]) if b["at"] < limit and exists(self.spark, a["folder"])]
        for folder in gone:
            files, found = _located(self.spark, folder)
            files.delete(found, True)
        return gone


class Appended(Ledgered):
    """A table that batches of rows are added to, each key once.

    A batch has a name; one that is entered already is not written again. Beside each batch stand the range of its keys and a bitmap of their hashes, so that
    a new batch is only compared with batches that may hold one of its keys.
    """

    SLOTS = 1 << 15

    def __init__(self, spark: SparkSession, root: str, key: str, schema: T.StructType) -> None:
        super().__init__(spark, root)
        self.key, self.schema = key, schema
        kind = schema[key].dataType.simpleString()
        self.SCHEMA = f"batch string, folder string, low {kind}, high {kind}, bits binary"

    def _counted(self) -> DataFrame:
        """One folder per batch, should two runs of one have been entered at once."""
        own = F.struct("folder", "low", "high", "bits")
        return self.entries().groupBy("batch").agg(F.min(own).alias("e")).select("batch", "e.*")

    def candidates(self, df: DataFrame) -> list[str]:
        """Folders of batches that may hold a key of ``df``."""
        slot = F.pmod(F.xxhash64(self.key), F.lit(self.SLOTS)) + 1
        bits = F.bitmap_construct_agg(F.bitmap_bit_position(slot))
        mine = df.agg(F.min(self.key).alias("low"), F.max(self.key).alias("high"), bits.alias("bits")).first()
        if mine["low"] is None:
            return []
        near = self._counted().where((F.col("low") <= F.lit(mine["high"])) & (F.col("high") >= F.lit(mine["low"])))
        both = near.select("folder", "bits").union(near.select("folder", F.lit(bytes(mine["bits"])).alias("bits")))
        shared = both.groupBy("folder").agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("n")).where("n > 0")
        return sorted(r["folder"] for r in shared.select("folder").collect())

    def append(self, df: DataFrame, batch: str) -> bool:
        """Adds the rows whose key no batch holds yet, one of each key; False if this batch is entered already. Rows without a key are left out."""
        if not self.entries().where(F.col("batch") == batch).isEmpty():
            return False
        rows = df.select(*self.schema.names).where(F.col(self.key).isNotNull()).dropDuplicates([self.key])
        held = self.candidates(rows)
        if held:
            rows = drop_known(rows, self.key, self.spark.read.schema(self.schema).parquet(*held), self.key)
        folder = self._folder()
        rows.write.parquet(folder)
        made = self.spark.read.schema(self.schema).parquet(folder)
        slot = F.pmod(F.xxhash64(self.key), F.lit(self.SLOTS)) + 1
        self._enter(made.agg(
            F.lit(batch).alias("batch"), F.lit(folder).alias("folder"), F.min(self.key).alias("low"), F.max(self.key).alias("high"),
            F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"),
        ))
        return True

    def read(self) -> DataFrame:
        folders = [r["folder"] for r in self._counted().select("folder").collect()]
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)


class DaySums(Ledgered):
    """Counts and sums by day and labels, kept between runs, from which any window of days is added up.

    ``sums`` are whole numbers (minor units), so that adding is exact in any order. Days are replaced one by one: a run writes a folder with the days it
    touched and enters them; for each day the last entry counts.
    """

    SCHEMA = "number bigint, day date, folder string, batch string"

    def __init__(self, spark: SparkSession, root: str, dims: Mapping[str, str], sums: Sequence[str]) -> None:
        super().__init__(spark, root)
        self.dims, self.sums = dict(dims), list(sums)
        kinds = {"day": "date", **self.dims, "n": "bigint", **{s: "bigint" for s in self.sums}, "_folder": "string"}
        self.shape = T.StructType.fromDDL(", ".join(f"`{c}` {k}" for c, k in kinds.items()))

    def _summed(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("day", *self.dims).agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in self.sums])

    def partial(self, facts: DataFrame, day: Column, measures: Mapping[str, Column]) -> DataFrame:
        """Facts brought down to the grain of the store; facts without a day belong to none."""
        rows = facts.select(day.alias("day"), *[F.col(c).cast(k).alias(c) for c, k in self.dims.items()], F.lit(1).cast("bigint").alias("n"),
                            *[measures[s].cast("bigint").alias(s) for s in self.sums])
        return self._summed(rows.where(F.col("day").isNotNull()))

    def _put(self, rows: DataFrame, days: DataFrame | None, batch: str | None) -> None:
        folder = self._folder()
        # One day is a few rows per label; sorted, a read of some days skips the rest.
        rows.withColumn("_folder", F.lit(folder)).select(*self.shape.names).repartitionByRange("day").sortWithinPartitions("day").write.parquet(folder)
        made = self.spark.read.schema(self.shape).parquet(folder).select("day")
        touched = (made if days is None else made.union(days)).distinct()
        last = self.entries().agg(F.max("number")).first()[0] or 0
        self._enter(touched.select(F.lit(last + 1).cast("bigint").alias("number"), "day", F.lit(folder).alias("folder"), F.lit(batch).cast("string").alias("batch")))

    def load(self, facts: DataFrame, day: Column, measures: Mapping[str, Column]) -> None:
        """All days of the facts, counted anew."""
        self._put(self.partial(facts, day, measures), None, None)

    def rewrite(self, facts: DataFrame, day: Column, measures: Mapping[str, Column], days: Sequence[dt.date]) -> None:
        """The named days counted anew from the facts of these days, which is all that is read; a day without facts is empty from now on."""
        first, last = min(days), max(days)
        own = facts.where(day.between(a_day(first), a_day(last)) & day.isin(*days))
        listed = self.spark.createDataFrame([(d,) for d in sorted(set(days))], "day date")
        self._put(self.partial(own, day, measures), listed, None)

    def merge(self, facts: DataFrame, day: Column, measures: Mapping[str, Column], batch: str) -> bool:
        """Adds new facts to the days they belong to, late ones too, and rewrites these days alone; False if the batch is entered already."""
        if not self.entries().where(F.col("batch") == batch).isEmpty():
            return False
        fresh = self.partial(facts, day, measures)
        days = fresh.select("day").distinct()
        kept = self._current().join(reshuffled(days, "day"), "day", "left_semi")
        self._put(self._summed(fresh.unionByName(kept.drop("_folder"))), self.spark.createDataFrame([], "day date"), batch)
        return True

    def _current(self, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        entries = self.entries()
        if first is not None:
            entries = entries.where(F.col("day").between(a_day(first), a_day(last)))
        counting = entries.groupBy("day").agg(F.max_by("folder", F.struct("number", "folder")).alias("_folder"))
        folders = [r["_folder"] for r in counting.select("_folder").distinct().collect()]
        if not folders:
            return self.spark.createDataFrame([], self.shape)
        rows = self.spark.read.schema(self.shape).parquet(*folders)
        if first is not None:
            rows = rows.where(F.col("day").between(a_day(first), a_day(last)))
        return rows.join(counting, ["day", "_folder"], "left_semi").select(*self.shape.names)

    def rows(self, first: dt.date, last: dt.date) -> DataFrame:
        """Day rows of first..last as they count now."""
        return self._current(first, last).drop("_folder")

    def windows(self, dims: Sequence[str], windows: Sequence[Window]) -> DataFrame:
        """Per labels and window the count and the sums, as <window>_n and <window>_<sum>, added up from the days of the windows."""
        rows = self.rows(min(w.start for w in windows), max(w.end for w in windows))
        cells = []
        for w in windows:
            for c in ("n", *self.sums):
                cells.append(F.coalesce(F.sum(F.when(in_window(F.col("day"), w), F.col(c))), F.lit(0)).cast("bigint").alias(f"{w.name}_{c}"))
        return rows.groupBy(*dims).agg(*cells)


class FirstRows(Ledgered):
    """The first row of every key over all slices so far, bucketed by key, so that a new slice meets it without its being shuffled or sorted.

    The state of a key is the least of (order columns, carried columns); the least of two is associative and changes nothing when repeated, so slices may
    come in any order and more than once.
    """

    SCHEMA = Published.SCHEMA

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str, order: Sequence[str], buckets: int = 8) -> None:
        super().__init__(spark, root)
        self.key, self.order, self.buckets = key, list(order), buckets
        carried = [c for c in schema.names if c not in (key, *order)]
        self.columns = [key, *self.order, *carried]
        self.schema = T.StructType([schema[c] for c in self.columns])
        self.versions = Published(spark, root)

    def _table(self, folder: str) -> DataFrame:
        """A version as a bucketed table of this session, entered in its catalog when it is first met."""
        name = "first_rows_" + folder.rsplit("/", 1)[-1]
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{folder}'")
        return self.spark.table(name)

    def read(self) -> DataFrame:
        known = self.versions.current()
        return self.spark.createDataFrame([], self.schema) if known is None else self._table(known[1])

    def merged(self, rows: DataFrame) -> DataFrame:
        """The state with a slice of rows; rows without a key have no place."""
        first = F.struct(*self.columns[1:])
        fresh = rows.select(*self.columns).where(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.min(first).alias("_new"))
        known = self.versions.current()
        if known is None:
            return fresh.select(self.key, "_new.*")
        state = self._table(known[1]).select(self.key, first.alias("_old"))
        both = state.join(fresh, self.key, "full_outer")
        least = F.when(F.col("_old").isNull() | (F.col("_new") < F.col("_old")), F.col("_new")).otherwise(F.col("_old"))
        return both.select(self.key, least.alias("_first")).select(self.key, "_first.*")

    def update(self, rows: DataFrame) -> None:
        """Takes a slice into the state and publishes the new version."""
        folder = self._folder()
        name = "first_rows_" + folder.rsplit("/", 1)[-1]
        made = self.merged(rows).select(*self.columns)
        if self.versions.current() is None:
            made = made.repartition(self.buckets, self.key)
        made.write.format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key).option("path", folder).saveAsTable(name)
        self.versions.point(folder)
