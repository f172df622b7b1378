"""Helpers of the training-data operators: table access, settled frames, neighbours in an order, components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opsreports.session import fresh_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Compute a frame once as parquet in the shared folder; what reads it is pruned and survives lost executors."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, giving back what its task freed: workers outlive their tasks, and the executor's memory is shared with the next stage's."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return whole


#: Bits of the filter by which rows that aren't needed stay out of a shuffle. Fixed, so what is sent to tasks doesn't grow.
FILTER_BITS = 1 << 25


def _slot(column: str):
    """A place in the filter, counted from 1 as Spark's bitmap functions do."""
    return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)) + 1


def passing(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows (id, text) whose id is in ``ids``, and maybe some others: a filter before a join, at no shuffle.

    While the ids are few against the filter's bits few others pass; beyond that more do. The join decides either way.
    """
    slots = ids.select(_slot("id").alias("s")).groupBy(F.bitmap_bucket_number("s").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits"))
    needed = np.zeros(FILTER_BITS >> 3, np.uint8)
    for row in slots.collect():
        bits = np.frombuffer(bytes(row["bits"]), np.uint8)
        needed[(row["b"] - 1) * len(bits) : row["b"] * len(bits)] = bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column(batch.num_columns - 1).to_numpy() - 1
            wanted = needed[slot >> 3] >> (slot & 7).astype(np.uint8) & 1
            yield batch.select(range(batch.num_columns - 1)).filter(pa.array(wanted.astype(bool)))

    return rows.withColumn("_slot", _slot("id")).mapInArrow(lean(run), rows.schema)


def in_order(df: DataFrame, order: Sequence[str], within: Sequence[str] = (), take: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``next_<c>`` for each column ``c`` of ``take``: the value in the next row of the order.

    ``within``: columns that lead the order; the next row counts only if it agrees in them.
    The rows are range-partitioned by the order, so that no task sees more than its slice, even
    if one value of ``within`` owns most rows. A slice's last row gets its successor from the
    first rows of the slices, of which there is one each. Keep the rows slim. Ties in the order
    are settled by all further columns of ``take``.
    """
    by = [*within, *order, *[c for c in take if c not in order]]
    sliced = settle(df.repartitionByRange(*by).withColumn("_slice", F.spark_partition_id()), "order")
    same = Window.partitionBy("_slice").orderBy(*by)
    carried = list(dict.fromkeys([*within, *take]))
    firsts = sliced.groupBy("_slice").agg(F.min(F.struct(*by)).alias("_head"))
    heads = firsts.select(
        F.lag("_slice").over(Window.orderBy("_slice")).alias("_slice"),
        F.struct(*[F.col(f"_head.{c}").alias(c) for c in carried]).alias("_head"),
    ).where(F.col("_slice").isNotNull())
    found = sliced.withColumn("_next", F.lead(F.struct(*carried)).over(same)).join(heads, "_slice", "left")
    following = F.coalesce("_next", "_head")
    agrees = F.lit(True)
    for c in within:
        agrees = agrees & following[c].eqNullSafe(F.col(c))
    return found.select(
        *df.columns, *[F.when(agrees, following[c]).alias(f"next_{c}") for c in take],
    )


def _at_roots(moved: DataFrame, label: str) -> DataFrame:
    """(x, m): every node where its chain of moves ends. Each pass doubles the links that a node has gone, so a chain of n takes log2(n)."""
    while True:
        onward = moved.where("x <> m").select(F.col("x").alias("m"), F.col("m").alias("n"))
        moved = settle(moved.join(onward, "m", "left").select("x", F.coalesce("n", "m").alias("m"), F.col("n").isNotNull().alias("went")), label)
        if moved.where("went").isEmpty():
            return moved.drop("went")
        moved = moved.drop("went")


#: After so many rounds what is found is written, so that no plan joins more frames.
SETTLE_EACH = 4


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component): for every node of an edge (a, b), the smallest node it can reach. Edges with a null end are left out.

    Contracts the graph: each node moves to the smallest of itself and its neighbours, then on to where that one moved, until it is at a
    node that stayed; edges are drawn anew between where their ends are, until none are left. The smallest node of a component never moves,
    so all arrive there. A node that stayed and that nobody moved to has a smaller neighbour after the round, so two rounds at least halve
    the nodes of a component: rounds grow with the logarithm of its nodes, and passes of a round with that of its longest chain, whatever the
    order of ids. Each pass is written to the shared folder.
    """
    known = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    nodes = known.select(F.col("a").alias("node")).union(known.select("b")).distinct()
    links = known.where("a <> b")
    found, rounds = nodes.withColumn("component", F.col("node")), 0
    while True:
        both = links.select("a", "b").union(links.select("b", "a"))
        # The smallest node has its own place as the least; a row for each node with an edge.
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("x"), F.least("a", "m").alias("m"))
        moved = _at_roots(settle(least, label), label)
        ours, theirs = moved.select(F.col("x").alias("a"), F.col("m").alias("p")), moved.select(F.col("x").alias("b"), F.col("m").alias("q"))
        again = links.join(ours, "a").join(theirs, "b").where("p <> q").select(F.greatest("p", "q").alias("a"), F.least("p", "q").alias("b")).distinct()
        links = settle(again, label)
        found = found.join(moved.withColumnRenamed("x", "component"), "component", "left").select("node", F.coalesce("m", "component").alias("component"))
        rounds += 1
        done = links.isEmpty()
        if done or rounds % SETTLE_EACH == 0:
            found = settle(found, label)
        if done:
            return found
