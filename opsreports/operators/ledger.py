"""First-in first-out wallet ledger.

Credits are used oldest first: by created day, then by id.
Each takes the earliest debits still open. A credit with an end day can only take debits
dated before that day, which for a credit still valid on as_of is every debit.

Because a credit can use a *prefix* of the debits in date order, what the first i credits
have taken is itself a prefix of length P(i) of the customer's debit line:

    P(i) = max(P(i-1), min(P(i-1) + amount(i), D(end(i))))

with D(t) the debits dated before t. Credits of one customer and created day that follow each
other by id and end on the same day act as one lump, their *run*; and debits of one day as one
sum. The fold per customer therefore runs over lumps; both sums are partial aggregates.

A credit still valid on as_of can take any debit. So the first valid lump that is not used
up has taken the last of the debits: the valid lumps before it are empty and those after
it untouched. The fold only has to find this *edge*, and only the rows of the edge lump
need an order among themselves.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window as W, functions as F

from opsreports.functions.money import MONEY
from opsreports.functions.times import day
from opsreports.operators.joins import reshuffled
from opsreports.operators.running import id_block, running_total
from opsreports.session import settle

WIDE = "decimal(28,2)"
LUMP = ("customer", "created", "run", "end")


def _open_debits(lumps: DataFrame, daily: DataFrame) -> DataFrame:
    """Each lump with D(end), the debits it may use.

    On one time line per customer, a lump at its end day comes before that day's debits.
    """
    zero, none = F.lit(0).cast(WIDE), F.lit(None)
    ends = lumps.select(*LUMP, "lump", F.col("end").alias("at"), F.lit(0).alias("side"), zero.alias("used"))
    days = daily.select(
        "customer", none.cast("date").alias("created"), none.cast("bigint").alias("run"), none.cast("date").alias("end"),
        none.cast(WIDE).alias("lump"),
        F.col("date").alias("at"), F.lit(1).alias("side"), "used",
    )
    before = W.partitionBy("customer").orderBy("at", "side", "created", "run").rowsBetween(W.unboundedPreceding, 0)
    line = ends.unionByName(days).withColumn("open", F.sum("used").over(before).cast(WIDE))
    return line.where(F.col("side") == 0).select(*LUMP, "lump", "open")


def _edges(lumps: DataFrame, as_of: dt.date) -> DataFrame:
    """Per customer the edge lump: its key, its size and what is left of it."""
    step = F.struct(
        F.col("created"), F.col("run"), F.col("end"), F.col("lump"), F.col("open"), (F.col("end") >= day(as_of)).alias("valid")
    )
    per_customer = lumps.groupBy("customer").agg(F.sort_array(F.collect_list(step)).alias("steps"))
    edge_type = "struct<created:date,run:bigint,lump:decimal(28,2),left:decimal(28,2)>"
    start = F.struct(F.lit(0).cast(WIDE).alias("taken"), F.lit(None).cast(edge_type).alias("edge"))

    def fold(state, credit):
        wanted = (state["taken"] + credit["lump"]).cast(WIDE)
        taken = F.greatest(state["taken"], F.least(wanted, credit["open"]))
        here = F.struct(
            credit["created"].alias("created"), credit["run"].alias("run"), credit["lump"].alias("lump"),
            (wanted - credit["open"]).cast(WIDE).alias("left"),
        ).cast(edge_type)
        found = credit["valid"] & (wanted > credit["open"])
        edge = F.when(state["edge"].isNotNull(), state["edge"]).when(found, here)
        return F.struct(taken.cast(WIDE).alias("taken"), edge.alias("edge"))

    edge = F.aggregate("steps", start, fold, lambda s: s["edge"])
    return per_customer.select("customer", edge.alias("edge")).where(F.col("edge").isNotNull())


def ledger_balances(
    entries: DataFrame,
    as_of: dt.date,
    columns: Mapping[str, str],
    credit: str = "CREDITED",
    debit: str = "DEBITED",
) -> DataFrame:
    """The credits made before as_of with what is left of each by then, as ``balance``.

    ``columns`` names id, customer, kind, amount, created (date) and end (date) in
    ``entries``; the id is a unique integer. An expired credit has balance 0. The edges, one
    narrow row per customer, are worked out at once and settled, as three branches read them.
    """
    c = columns
    entries = entries.where(F.col(c["created"]) < day(as_of))
    amount = F.col(c["amount"]).cast(MONEY)
    keys = {"customer": c["customer"], "created": c["created"], "run": "_streak", "end": c["end"]}
    by_id = W.partitionBy(c["customer"], c["created"]).orderBy(c["id"])
    turn = F.lag(c["end"]).over(by_id).eqNullSafe(F.col(c["end"]))
    credits = entries.where(F.col(c["kind"]) == credit).withColumn("_turn", F.when(turn, 0).otherwise(1))
    credits = credits.withColumn("_streak", F.sum("_turn").over(by_id)).drop("_turn")
    daily = entries.where(F.col(c["kind"]) == debit).groupBy(
        F.col(c["customer"]).alias("customer"), F.col(c["created"]).alias("date")
    ).agg(F.sum(amount).cast(WIDE).alias("used"))

    lumps = credits.groupBy(*[F.col(v).alias(k) for k, v in keys.items()]).agg(F.sum(amount).cast(WIDE).alias("lump"))
    edges = settle(_edges(_open_debits(lumps, daily), as_of))
    edges = edges.select(F.col("customer").alias("_customer"), F.col("edge").alias("_edge"))
    rows = credits.join(edges, credits[c["customer"]] == edges["_customer"], "left").drop("_customer")

    created, end = F.col(c["created"]), F.col(c["end"])
    same_day = created == F.col("_edge.created")
    at_edge = F.coalesce(same_day & (F.col("_streak") == F.col("_edge.run")), F.lit(False))
    behind = F.coalesce((created > F.col("_edge.created")) | (same_day & (F.col("_streak") > F.col("_edge.run"))), F.lit(False))
    untouched = behind & (end >= day(as_of))
    plain = rows.where(~at_edge).withColumn("balance", F.when(untouched, amount).otherwise(F.lit(0)).cast(MONEY))

    # A lump gives up its oldest credits first. There is one edge lump per customer.
    cut = running_total(
        rows.where(at_edge), [c["customer"]], [id_block(c["id"])], [c["id"]], amount.cast(WIDE), "_through"
    )
    gone = F.col("_edge.lump") - F.col("_edge.left")
    rest = F.least(amount, F.greatest(F.lit(0), F.col("_through") - gone)).cast(MONEY)
    cut = cut.withColumn("balance", rest).drop("_through")
    return plain.unionByName(cut).drop("_edge", "_streak")


def ledger_no_expiry(
    entries: DataFrame, columns: Mapping[str, str], credit: str = "CREDITED", debit: str = "DEBITED"
) -> DataFrame:
    """As ledger_balances for credits that never end: plain overlap of two running sums."""
    c = columns
    value = F.col(c["amount"]).cast(WIDE)
    credits = entries.where(F.col(c["kind"]) == credit)
    spent = entries.where(F.col(c["kind"]) == debit).groupBy(F.col(c["customer"]).alias("_customer")).agg(
        F.sum(value).cast(WIDE).alias("_spent")
    )
    summed = running_total(
        credits, [c["customer"]], [F.col(c["created"]), id_block(c["id"])], [c["created"], c["id"]], value, "_through"
    )
    spent = reshuffled(spent, "_customer")
    rows = summed.join(spent, summed[c["customer"]] == spent["_customer"], "left").drop("_customer")
    rest = F.col("_through") - F.coalesce(F.col("_spent"), F.lit(0))
    return rows.withColumn(
        "balance", F.greatest(F.lit(0), F.least(F.col(c["amount"]).cast(MONEY), rest)).cast(MONEY)
    ).drop("_through", "_spent")
