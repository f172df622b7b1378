"""Running totals that hold up when one key owns a large share of the rows.

A window over a key sorts all its rows in one task. Here a key's order is cut into
levels, each a monotone step of the order (a date, then id blocks): block totals are
small, their running sums give every block its starting value, and only the rows of
one block meet in one task. With a unique integer id, ``id_block`` bounds a block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from opsreports.session import settle

ID_BLOCK = 1 << 16


def id_block(column: str, size: int = ID_BLOCK) -> Column:
    """Block of a unique integer id: at most ``size`` rows share one."""
    return F.floor(F.col(column) / size)


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    levels: Sequence[Column],
    order: Sequence[str],
    value: Column,
    out: str,
) -> DataFrame:
    """Sum of value over the key's rows up to and including this one.

    ``levels`` are coarse to fine and never decrease along ``order``; ``order`` must be
    a total order within a key. The input is read twice, for the block totals and for the
    rows; settle it first if it is costly to make.
    """
    names = [f"_level{i}" for i in range(len(levels))]
    rows = df.withColumns({**dict(zip(names, levels)), "_value": value})
    keys = list(keys)

    totals = [rows.groupBy(*keys, *names).agg(F.sum("_value").alias("_sum"))]
    for depth in range(len(names) - 1, 0, -1):
        totals.insert(0, totals[0].groupBy(*keys, *names[:depth]).agg(F.sum("_sum").alias("_sum")))

    start = None
    for depth, total in enumerate(totals):
        group = keys + names[:depth]
        before = W.partitionBy(*group).orderBy(names[depth]).rowsBetween(W.unboundedPreceding, -1)
        here = total.withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
        if start is not None:
            base = start.withColumnRenamed("_start", "_base")
            here = here.join(base, group).withColumn("_start", F.col("_start") + F.col("_base")).drop("_base")
        start = here

    in_block = W.partitionBy(*keys, *names).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    summed = rows.withColumn("_run", F.sum("_value").over(in_block)).drop("_value")
    joined = summed.join(start, keys + names)
    return joined.withColumn(out, F.col("_run") + F.col("_start")).drop("_run", "_start", *names)


def ordered_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "position", weight: Column | None = None
) -> DataFrame:
    """1, 2, 3 ... along the order within each key, or the running sum of ``weight``; for ids of any density.

    The rows are range-partitioned by key and order and written once, so that a hot key is spread over
    many slices; each slice is summed by itself. Only keys that go on from an earlier slice need that
    slice's total, and there are at most as many such pairs as slices. ``order`` must be a total
    order within a key.
    """
    keys, order = list(keys), list(order)
    value = F.lit(1).cast("bigint") if weight is None else weight
    sliced = settle(df.withColumn("_weight", value).repartitionByRange(*keys, *order).withColumn("_slice", F.spark_partition_id()))
    through = W.partitionBy("_slice", *keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    earlier = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    totals = sliced.groupBy("_slice", *keys).agg(F.sum("_weight").alias("_sum"))
    starts = totals.withColumn("_start", F.sum("_sum").over(earlier)).where(F.col("_start") > 0).select(
        F.col("_slice").alias("_at"), "_start", *[F.col(k).alias(f"_key_{k}") for k in keys]
    )
    same = F.col("_slice") == F.col("_at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    rows = sliced.withColumn("_run", F.sum("_weight").over(through)).join(starts, same, "left")
    return rows.withColumn(out, F.col("_run") + F.coalesce("_start", F.lit(0))).select(*df.columns, out)
