"""Registration of queries beside their SQL, and access to the driver's tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from opsreports.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# The day and moment the checks are run "as of": inside the order and event dates.
AS_OF = dt.date(1998, 6, 17)
EVENTS_AS_OF = dt.datetime(2024, 1, 17, 14, 25, 30)


# Schemas seen so far by path: reading them from the footers again would cost a job each time.
_schemas: dict[str, StructType] = {}


class Tables:
    """The driver's tables by attribute: ``t.orders`` reads orders.parquet."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in _schemas:
            _schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[path]).parquet(path)


_sessions: set[int] = set()


def _configured(spark: SparkSession) -> SparkSession:
    """The session with the library's settings, made once."""
    if id(spark) not in _sessions:
        configure(spark)
        _sessions.add(id(spark))
    return spark


def query(name: str, sql: str | None = None):
    """Register a ``Tables -> DataFrame`` function, with the SQL that gives the same rows."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(_configured(spark), sf_dir))

        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def half_even(cents: str, n: str) -> str:
    """SQL of an average in cents, rounded half-even to two places, 0 where n is 0."""
    q, r = f"({cents} // nullif({n}, 0))", f"(2 * ({cents} % nullif({n}, 0)))"
    return (
        f"(coalesce(CASE WHEN {r} < {n} THEN {q} WHEN {r} > {n} THEN {q} + 1 "
        f"ELSE {q} + {q} % 2 END, 0) / 100.0)::DOUBLE"
    )
