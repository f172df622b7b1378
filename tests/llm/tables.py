"""Tables for tests: the driver's small ones, and hand-made ones written as parquet."""

import os

import duckdb

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def written(spark, folder, **frames) -> duckdb.DuckDBPyConnection:
    """Writes each frame as ``<name>.parquet`` below the folder, as the queries read them; a connection with the same views."""
    con = duckdb.connect()
    for name, df in frames.items():
        df.write.parquet(f"{folder}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    return con
