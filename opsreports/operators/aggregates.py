"""Aggregates: counts, totals, shares, crosstabs and workload.

Every aggregate is a partial one first, so a hot key is shrunk where it lies. Totals,
shares and pivots run on the aggregated rows.
"""

from __future__ import annotations

import datetime as dt
import itertools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from opsreports.functions.money import MONEY, avg2, pct2, rate2
from opsreports.functions.times import Window, day, hour_slot
from opsreports.operators.running import ordered_position

TOTAL = "Total"


def count_rows() -> Column:
    return F.count(F.lit(1))


def count_by_label(df: DataFrame, label: str, out: str = "n") -> DataFrame:
    """Rows per label, rows without a label left out."""
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(count_rows().alias(out))


def counts_if(tests: Mapping[str, Column]) -> list[Column]:
    """One conditional count per name; a NULL test is no match."""
    return [F.count_if(F.coalesce(test, F.lit(False))).alias(name) for name, test in tests.items()]


def status_summary(df: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """Several conditional counts in one row."""
    return df.agg(*counts_if(tests))


def in_window(date: Column, window: Window) -> Column:
    return date.between(day(window.start), day(window.end))


def summary_by_window(
    df: DataFrame, date: Column, tests: Mapping[str, Column], windows: Sequence[Window]
) -> DataFrame:
    """Conditional counts per window from one scan: one row per measure, one column per window."""
    cells = {
        (name, w.name): F.count_if(F.coalesce(test & in_window(date, w), F.lit(False)))
        for name, test in tests.items()
        for w in windows
    }
    rows = [
        F.struct(F.lit(name).alias("measure"), *[cells[name, w.name].alias(w.name) for w in windows])
        for name in tests
    ]
    return df.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows"))


def count_by_label_windows(
    df: DataFrame, label: str, date: Column, windows: Sequence[Window]
) -> DataFrame:
    """Rows per label and window, labels seen in no window left out."""
    named = df.where(F.col(label).isNotNull())
    counted = named.groupBy(label).agg(*counts_if({w.name: in_window(date, w) for w in windows}))
    seen = sum((F.col(w.name) for w in windows), F.lit(0))
    return counted.where(seen > 0)


def with_all_labels(df: DataFrame, dims: Sequence[str], labels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Add a zero row for each combination of fixed labels a group lacks.

    ``labels`` is {column: values}; every column besides these and ``dims`` is a number. Each
    aggregated row brings the zero rows of its group along and a second sum drops the surplus,
    so the frame is computed once. Without ``dims`` the zero rows are there even for no input.
    """
    keys = [*dims, *labels]
    measures = {f.name: f.dataType for f in df.schema.fields if f.name not in keys}
    zero = [F.lit(0).cast(kind).alias(m) for m, kind in measures.items()]
    combos = [
        F.struct(*[F.lit(v).alias(c) for c, v in zip(labels, values)], *zero)
        for values in itertools.product(*labels.values())
    ]
    if dims:
        own = F.struct(*labels, *measures)
        spread = df.select(*dims, F.inline(F.array(own, *combos)))
    else:
        spread = df.select(*labels, *measures).unionByName(
            df.sparkSession.range(1).select(F.inline(F.array(*combos)))
        )
    return spread.groupBy(*keys).agg(*[F.sum(m).cast(kind).alias(m) for m, kind in measures.items()])


def bucket_window_counts(
    df: DataFrame, dims: Sequence[str], bucket: str, date: Column, windows: Sequence[Window]
) -> DataFrame:
    """Rows per bucket and window; rows without a bucket are counted nowhere."""
    kept = df.where(F.col(bucket).isNotNull())
    return kept.groupBy(*dims, bucket).agg(*counts_if({w.name: in_window(date, w) for w in windows}))


def bucket_window_sums(
    df: DataFrame, dims: Sequence[str], bucket: str, date: Column, amount: Column, windows: Sequence[Window]
) -> DataFrame:
    """Count and amount per bucket and window, as <window>_n and <window>_sum."""
    kept = df.where(F.col(bucket).isNotNull())
    cells = []
    for w in windows:
        inside = in_window(date, w)
        cells.append(F.count_if(F.coalesce(inside, F.lit(False))).alias(f"{w.name}_n"))
        cells.append(F.coalesce(F.sum(F.when(inside, amount.cast(MONEY))), F.lit(0)).alias(f"{w.name}_sum"))
    return kept.groupBy(*dims, bucket).agg(*cells)


def averages(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Turn <name>_sum into <name>_avg over <name>_n."""
    made = {f"{n}_avg": avg2(F.col(f"{n}_sum"), F.col(f"{n}_n")) for n in names}
    return df.withColumns(made).drop(*[f"{n}_sum" for n in names])


def total_row(df: DataFrame, dims: Sequence[str], label: str, measures: Sequence[str]) -> DataFrame:
    """Add one Total row per group to an aggregated frame; ratios are computed after this."""
    sums = [F.sum(m).alias(m) for m in measures]
    rolled = df.groupingSets([[*dims, label], [*dims]], *dims, label).agg(
        *sums, F.grouping(label).alias("_is_total")
    )
    named = F.when(F.col("_is_total") == 1, F.lit(TOTAL)).otherwise(F.col(label))
    return rolled.withColumn(label, named).drop("_is_total")


def share_of_column(
    df: DataFrame, dims: Sequence[str], label: str, measures: Sequence[str], suffix: str = "_pct"
) -> DataFrame:
    """Each measure as a percentage of its group total; a Total row is not part of the sum
    and has share 0 itself."""
    group = W.partitionBy(*dims)
    part = F.coalesce(F.col(label) != TOTAL, F.lit(True))
    made = {
        m + suffix: F.when(part, pct2(F.col(m), F.sum(F.when(part, F.col(m))).over(group))).otherwise(F.lit(0.0))
        for m in measures
    }
    return df.withColumns(made)


def share_of_row(df: DataFrame, columns: Sequence[str], suffix: str = "_pct") -> DataFrame:
    """Each column as a percentage of the row's sum over the columns."""
    whole = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    return df.withColumns({c + suffix: pct2(F.col(c), whole) for c in columns})


def crosstab(df: DataFrame, rows: Sequence[str], column: Column, values: Mapping[str, object]) -> DataFrame:
    """Counts per row label and listed value, one column per value in the given order.

    The values are listed, so this is one aggregate and absent values keep their column.
    """
    return df.groupBy(*rows).agg(*counts_if({name: column == F.lit(value) for name, value in values.items()}))


def service_mode_counts(
    payments: DataFrame, city: str, service: str, mode_class: str, date: Column, windows, classes: Sequence[str]
) -> DataFrame:
    """City x service x window counts by payment class; a payment may lie in several windows."""
    hits = F.array_compact(F.array(*[F.when(in_window(date, w), F.lit(w.name)) for w in windows]))
    spread = payments.withColumn("window", F.explode(hits))
    return crosstab(spread, [city, service, "window"], F.col(mode_class), {c: c for c in classes})


def unpivot_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]], first: str, second: str) -> DataFrame:
    """Column pairs of one row to one row per pair."""
    legs = F.array(*[F.struct(F.col(a).alias(first), F.col(b).alias(second)) for a, b in pairs])
    return df.select(F.inline(legs))


def max_per_key(df: DataFrame, key: str, column: str, out: str) -> DataFrame:
    return df.groupBy(key).agg(F.max(column).alias(out))


def concat_per_key(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str,
    distinct: bool = False,
    separator: str = ",",
    part_size: int = 10_000,
) -> DataFrame:
    """Values per key as sorted delimited text; a key without any value gives NULL.

    Every key's sorted list is cut into parts of ``part_size`` values, numbered from 0: no cell has to hold an
    unbounded group, and the parts put end to end are the list. Equal values travel as one row with a
    count. The input is read once.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(value).alias("_value"))
    present = F.col("_value").isNotNull()
    counted = rows.groupBy(*keys, "_value").agg((F.lit(1).cast("bigint") if distinct else count_rows()).alias("_n"))
    counted = counted.withColumn("_n", F.when(present, F.col("_n")).otherwise(0))
    placed = ordered_position(counted, keys, ["_value"], "_through", F.col("_n"))
    step = F.lit(part_size).cast("bigint")
    first = F.when(present, F.floor((F.col("_through") - F.col("_n")) / step)).otherwise(0)
    last = F.when(present, F.floor((F.col("_through") - 1) / step)).otherwise(0)
    spread = placed.withColumn("part", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("_through") - F.col("_n"), F.col("part") * step)
    copies = (F.least(F.col("_through"), (F.col("part") + 1) * step) - begin).cast("int")
    text = F.concat("_value", F.repeat(F.concat(F.lit(separator), "_value"), copies - 1))
    quoted = separator.replace("'", "\\'")
    joined = F.expr(f"listagg(_text, '{quoted}') WITHIN GROUP (ORDER BY _value)")
    return spread.withColumn("_text", text).groupBy(*keys, "part").agg(joined.alias(out)).select(*keys, "part", out)


def concat_distinct_per_key(df, keys, value: str, out: str, **options) -> DataFrame:
    return concat_per_key(df, keys, value, out, distinct=True, **options)


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def count_group(df: DataFrame, *keys: str, out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(count_rows().alias(out))


def count_by_hour_slot(df: DataFrame, dims: Sequence[str], ts: str, slot: str = "slot", out: str = "n") -> DataFrame:
    return df.withColumn(slot, hour_slot(F.col(ts))).groupBy(*dims, slot).agg(count_rows().alias(out))


def slot_workload(
    df: DataFrame,
    dims: Sequence[str],
    assignee: str,
    reason: str,
    queue: str,
    pending: str = "Confirmation Pending",
    per_agent: int = 25,
) -> DataFrame:
    """Per slot: queued, pending with an agent, all with an agent, and the agents needed."""
    queued = F.col(assignee) == queue
    counted = df.groupBy(*dims).agg(
        *counts_if({
            "queued": queued,
            "pending": ~queued & (F.col(reason) == pending),
            "with_agent": ~queued,
        })
    )
    return counted.withColumn("agents_needed", agents_needed(per_agent))


def agents_needed(per_agent: int = 25) -> Column:
    return (F.col("queued") + F.col("with_agent")) / F.lit(per_agent)


def visit_summary(
    df: DataFrame, dims: Mapping[str, str], done: Column, advised: Column, fee: str, recommended: Column, taken: Column
) -> DataFrame:
    """By each dimension: advised, taken, taken %, all done, done at no fee, value; with Total rows.

    Rows that pass ``done`` count as tests, rows that pass ``advised`` as visits, all others
    not at all. ``dims`` is {name in the result: column}; all dimensions come from one pass, as
    rows of (dim, label).
    """
    yes = lambda test: F.coalesce(test, F.lit(False)).cast("bigint")
    measures = {
        "recommended": yes(advised & recommended),
        "taken": yes(advised & taken),
        "total_done": yes(done),
        "zero_value": yes(done & (F.col(fee) == 0)),
        "value": F.coalesce(F.when(done, F.col(fee).cast(MONEY)), F.lit(0).cast(MONEY)),
    }
    labels = F.array(*[F.struct(F.lit(n).alias("dim"), F.col(c).alias("label")) for n, c in dims.items()])
    rows = df.where(done | advised).select(*[c.alias(m) for m, c in measures.items()], F.inline(labels))
    merged = rows.groupBy("dim", "label").agg(*[F.sum(m).alias(m) for m in measures])
    table = total_row(merged, ["dim"], "label", list(measures))
    return table.withColumn("taken_pct", rate2(F.col("taken"), F.col("recommended")))


def conditional_balance(
    df: DataFrame, key: str, kind: str, amount: str, valid_till: str, as_of: dt.date, credit: str, debit: str
) -> DataFrame:
    """Per key: credits still valid on as_of minus all debits."""
    value = F.col(amount).cast(MONEY)
    signed = (
        F.when((F.col(kind) == credit) & (F.col(valid_till) >= day(as_of)), value)
        .when(F.col(kind) == debit, -value)
        .otherwise(F.lit(0).cast(MONEY))
    )
    return df.groupBy(key).agg(F.sum(signed).alias("balance"))


def incentive(
    df: DataFrame,
    dims: Sequence[str],
    online: Column,
    target: str,
    online_pay: int = 100,
    offline_pay: int = 200,
) -> DataFrame:
    """Per agent: online and offline counts, the pay if a target above 0 is met, the gap to it."""
    counted = df.groupBy(*dims).agg(
        F.count_if(F.coalesce(online, F.lit(False))).alias("online"),
        F.count_if(~F.coalesce(online, F.lit(False))).alias("offline"),
        F.min(target).alias("target"),
    )
    achieved = F.col("online") + F.col("offline")
    pay = F.col("offline") * offline_pay + F.col("online") * online_pay
    return counted.withColumns({
        "achieved": achieved,
        "gap": achieved - F.col("target"),
        "pay": F.when((F.col("target") > 0) & (achieved >= F.col("target")), pay).otherwise(F.lit(0).cast("bigint")),
    })


def region_of(city: Column, named: Mapping[str, str], other: str) -> Column:
    """Region of a city: its own where named, the other one for all else, NULL too."""
    out = None
    for name, region in named.items():
        out = F.when(city == name, region) if out is None else out.when(city == name, region)
    return out.otherwise(other)


def coverage_pct(df: DataFrame, dims: Sequence[str], name: str) -> DataFrame:
    """Per group: rows, and the percentage whose name is neither NULL nor empty."""
    filled = F.col(name).isNotNull() & (F.col(name) != "")
    counted = df.groupBy(*dims).agg(count_rows().alias("leads"), F.count_if(filled).alias("_filled"))
    return counted.withColumn("coverage_pct", rate2(F.col("_filled"), F.col("leads"))).drop("_filled")


def sum_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])
