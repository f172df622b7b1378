"""First-in first-out wallet ledger by composed step functions, for customers of any size.

Gives the rows of ``ledger.ledger_balances``, which stays free of Python and holds a customer's lumps in one array.

Credits are used oldest first: by created day, then by id.
Each takes the earliest debits still open. A credit with an end day can only take debits
dated before that day, which for a credit still valid on as_of is every debit.

Because a credit can use a *prefix* of the debits in date order, what the first i credits
have taken is itself a prefix of length P(i) of the customer's debit line:

    P(i) = max(P(i-1), min(P(i-1) + amount(i), D(end(i))))

with D(t) the debits dated before t, and the credit itself has given P(i) - P(i-1).

A step is a function of what was taken before, and steps compose to functions of one form:

    F(P) = max(P, max over j of min(P + gain(j), cap(j)))

with gains ascending and caps descending; a further step touches only the terms whose cap it
reaches (``compose``). So a customer's credits can be cut into blocks anywhere. The rows are
range-partitioned by customer, day and id; a customer who lies in several slices gets one such
function a slice, the starting values run along these (one row a slice and customer), and the
slices are then gone through side by side, each from its starting value. A task streams its
rows and holds none of them, whatever share of all rows one customer has.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from opsreports.functions.money import MONEY, minor_to_major
from opsreports.functions.times import day
from opsreports.operators.joins import reshuffled
from opsreports.session import settle


class Steps:
    """A composed function of steps: terms (gain, cap), gains ascending, caps descending."""

    def __init__(self, gains: Sequence[int] = (), caps: Sequence[int] = ()) -> None:
        self.gains, self.caps = np.array(gains, np.int64), np.array(caps, np.int64)

    def compose(self, amount: int, cap: int) -> None:
        """One more step. Terms above its cap stay; those it lifts to the cap become one; the others are lifted whole."""
        if amount <= 0 or cap <= 0:
            return
        above = int(np.searchsorted(-self.caps, -cap, "left"))
        reached = int(np.searchsorted(-self.caps, -(cap - amount), "right"))
        gain = amount + (int(self.gains[reached - 1]) if reached else 0)
        self.gains = np.concatenate([self.gains[:above], [gain], self.gains[reached:] + amount])
        self.caps = np.concatenate([self.caps[:above], [cap], self.caps[reached:] + amount])

    def at(self, taken: int) -> int:
        return max(taken, int(np.minimum(taken + self.gains, self.caps).max(initial=0)))


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[bool, tuple, pa.RecordBatch, int, int]]:
    """Stretches of rows that agree in the first columns, within their batch: whether a new one begins, its keys, batch, from, to."""
    last: tuple | None = None
    for batch in batches:
        rows = list(zip(*[batch.column(i).to_pylist() for i in range(keys)]))
        start = 0
        for i in range(1, len(rows) + 1):
            if i == len(rows) or rows[i] != rows[start]:
                yield rows[start] != last, rows[start], batch, start, i
                last, start = rows[start], i


def _open_debits(credits: DataFrame, daily: DataFrame) -> DataFrame:
    """(customer, end, open) with open = D(end), for each end day of a customer's credits.

    On one time line per customer, an end comes before that day's debits. The line has a row a day and kind, however many entries there are.
    """
    ends = credits.select("_customer", "_end").distinct().select("_customer", F.col("_end").alias("at"), F.lit(0).alias("side"), F.lit(0).cast("bigint").alias("used"))
    days = daily.select("_customer", F.col("date").alias("at"), F.lit(1).alias("side"), "used")
    before = W.partitionBy("_customer").orderBy("at", "side").rowsBetween(W.unboundedPreceding, 0)
    line = ends.unionByName(days).withColumn("open", F.sum("used").over(before))
    return line.where("side = 0").select(F.col("_customer").alias("_whose"), F.col("at").alias("_until"), F.col("open").alias("_open"))


def _starts(sliced: DataFrame) -> DataFrame:
    """(slice, customer, start) for customers that lie in several slices: what their credits in earlier slices have taken."""
    whose = sliced.schema["_customer"].dataType
    edges = sliced.groupBy("_slice").agg(F.min(F.struct("_customer")).alias("first"), F.max(F.struct("_customer")).alias("last"))
    line = W.orderBy("_slice")
    edges = edges.select("_slice", "first", "last", F.lag("last").over(line).alias("before"), F.lead("first").over(line).alias("after"))
    spanning = edges.where("first <=> before").select("_slice", "first._customer").union(edges.where("last <=> after").select("_slice", "last._customer")).distinct()
    spanning = settle(spanning.select(F.col("_slice").alias("_s"), F.col("_customer").alias("_c")))
    rows = sliced.select("_slice", "_customer", "_day", "_id", "_cents", "_open").join(
        spanning, (F.col("_slice") == F.col("_s")) & F.col("_customer").eqNullSafe(F.col("_c")), "left_semi")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        kind = None
        key, steps = None, Steps()
        for new, found, batch, a, b in _runs(batches, 2):
            kind = batch.schema.field(1).type
            if new:
                if key is not None:
                    done.append((*key, steps.gains, steps.caps))
                key, steps = found, Steps()
            for amount, cap in zip(batch.column(4).slice(a, b - a).to_pylist(), batch.column(5).slice(a, b - a).to_pylist()):
                steps.compose(amount or 0, cap or 0)
        if key is not None:
            done.append((*key, steps.gains, steps.caps))
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in done], pa.int32()), pa.array([x[1] for x in done], kind),
                 *[pa.array([x[i].tolist() for x in done], pa.list_(pa.int64())) for i in (2, 3)]],
                names=["_slice", "_customer", "gains", "caps"],
            )

    shape = T.StructType().add("_slice", T.IntegerType()).add("_customer", whose).add("gains", T.ArrayType(T.LongType())).add("caps", T.ArrayType(T.LongType()))
    folded = rows.repartition("_slice", "_customer").sortWithinPartitions("_slice", "_customer", "_day", "_id").mapInArrow(fold, shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken = 0
        for new, _, batch, a, b in _runs(batches, 1):
            starts = []
            taken = 0 if new else taken
            for gains, caps in zip(batch.column(2).slice(a, b - a).to_pylist(), batch.column(3).slice(a, b - a).to_pylist()):
                starts.append(taken)
                taken = Steps(gains, caps).at(taken)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).slice(a, b - a), batch.column(0).slice(a, b - a), pa.array(starts, pa.int64())], names=["_slice", "_customer", "_open"])

    line = folded.select("_customer", "_slice", "gains", "caps").repartition("_customer").sortWithinPartitions("_customer", "_slice")
    return line.mapInArrow(run, T.StructType().add("_slice", T.IntegerType()).add("_customer", whose).add("_open", T.LongType()))


def stepped_balances(
    entries: DataFrame,
    as_of: dt.date,
    columns: Mapping[str, str],
    credit: str = "CREDITED",
    debit: str = "DEBITED",
) -> DataFrame:
    """The credits made before as_of with what is left of each by then, as ``balance``.

    ``columns`` names id, customer, kind, amount, created (date) and end (date) in
    ``entries``; the id is a unique integer. An expired credit has balance 0, and so has one without an end day. The credits are
    written once, cut into slices; few narrow rows of them are gone through at once, for customers in several slices.
    """
    c = columns
    entries = entries.where(F.col(c["created"]) < day(as_of))
    cents = (F.col(c["amount"]).cast(MONEY) * 100).cast("bigint")
    credits = entries.where(F.col(c["kind"]) == credit)
    keyed = credits.withColumns({"_customer": F.col(c["customer"]), "_day": F.col(c["created"]), "_id": F.col(c["id"]), "_end": F.col(c["end"]), "_cents": cents})
    daily = entries.where(F.col(c["kind"]) == debit).groupBy(
        F.col(c["customer"]).alias("_customer"), F.col(c["created"]).alias("date")
    ).agg(F.sum(cents).alias("used"))
    opened = reshuffled(_open_debits(keyed, daily), "_whose", "_until")
    placed = keyed.join(opened, F.col("_customer").eqNullSafe(F.col("_whose")) & (F.col("_end") == F.col("_until")), "left").drop("_whose", "_until")
    sliced = settle(placed.repartitionByRange("_customer", "_day", "_id").withColumn("_slice", F.spark_partition_id()))

    # The starting value of a slice's customer comes as a row before the credits it is for.
    kept = sliced.select(*credits.columns)
    heads = _starts(sliced).select("_slice", "_customer", F.lit(0).alias("_kind"), F.lit(None).cast("bigint").alias("_cents"), "_open",
                                   F.lit(None).cast(sliced.schema["_day"].dataType).alias("_day"), F.lit(None).cast(sliced.schema["_id"].dataType).alias("_id"),
                                   *[F.lit(None).cast(f.dataType).alias(f.name) for f in kept.schema.fields])
    lines = sliced.select("_slice", "_customer", F.lit(1).alias("_kind"), "_cents", "_open", "_day", "_id", *credits.columns)
    lines = heads.unionByName(lines).repartition("_slice", "_customer").sortWithinPartitions("_slice", "_customer", "_kind", "_day", "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken, left = 0, []
        for new, _, batch, a, b in _runs(batches, 2):
            taken = 0 if new else taken
            for kind, amount, cap in zip(*[batch.column(i).slice(a, b - a).to_pylist() for i in (2, 3, 4)]):
                if kind == 0:
                    taken = cap
                    left.append(None)
                else:
                    after = max(taken, min(taken + (amount or 0), cap or 0))
                    left.append((amount or 0) - (after - taken))
                    taken = after
            if b == batch.num_rows:
                real = pa.array([x is not None for x in left], pa.bool_())
                rows = pa.RecordBatch.from_arrays([*batch.columns[7:], pa.array(left, pa.int64())], names=[*batch.schema.names[7:], "_left"])
                yield rows.filter(real)
                left = []

    out = lines.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("_left", T.LongType())]))
    valid = F.col(c["end"]) >= day(as_of)
    return out.withColumn("balance", F.when(valid, minor_to_major(F.col("_left"))).otherwise(F.lit(0)).cast(MONEY)).drop("_left")
