"""Order-dependent operators: first rows, ranks, visit pairs, latest notes and histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from opsreports.functions.text import first_clause
from opsreports.operators.joins import reshuffled
from opsreports.operators.running import ordered_position


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key. Spark keeps one row per key and task before the shuffle."""
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def rank_average(df: DataFrame, key: str, value: str, out: str = "rank") -> DataFrame:
    """Ascending rank of value within key, ties sharing the mean of their places.

    Ranks are worked out on the distinct values.
    """
    counted = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("_ties"))
    through = ordered_position(counted, [key], [value], "_through", F.col("_ties"))
    ranked = through.select(key, value, (F.col("_through") - (F.col("_ties") - 1) / 2).alias(out))
    return df.join(reshuffled(ranked, key, value), [key, value])


def new_or_existing(
    df: DataFrame,
    patient: str,
    visit: str,
    here: Column,
    out: str = "patient_type",
    new: str = "New Patient",
    existing: str = "Existing patient",
) -> DataFrame:
    """Rows at one place, labelled by whether they are their patient's first visit anywhere."""
    first = reshuffled(df.groupBy(F.col(patient).alias("_patient")).agg(F.min(visit).alias("_first")), "_patient")
    at_place = df.where(here)
    joined = at_place.join(first, at_place[patient] == first["_patient"])
    label = F.when(F.col(visit) == F.col("_first"), new).otherwise(existing)
    return joined.withColumn(out, label).drop("_patient", "_first")


def followup_pair(
    df: DataFrame, patient: str, visit: str, trigger: Column, follow: Column, carried: Sequence[str]
) -> DataFrame:
    """Per patient: the first trigger visit, and the first later visit that counts as follow-up.

    Both steps take a minimum per patient. Carried columns come twice, as first_<c> and
    second_<c>; the second ones are NULL where no follow-up was made.
    """
    row = F.struct(visit, *carried)
    first = df.where(trigger).groupBy(F.col(patient).alias("_patient")).agg(F.min_by(row, visit).alias("_first"))
    start = reshuffled(first.select("_patient", F.col(f"_first.{visit}").alias("_from")), "_patient")
    later = df.where(follow).join(start, F.col(patient) == F.col("_patient")).where(F.col(visit) > F.col("_from"))
    second = later.groupBy(F.col(patient).alias("_patient")).agg(F.min_by(row, visit).alias("_second"))
    pairs = first.join(second, "_patient", "left")
    return pairs.select(
        F.col("_patient").alias(patient),
        *[F.col(f"_first.{c}").alias(f"first_{c}") for c in (visit, *carried)],
        *[F.col(f"_second.{c}").alias(f"second_{c}") for c in (visit, *carried)],
    )


def latest_reason(df: DataFrame, key: str, comment: str, comment_id: str, out: str = "reason") -> DataFrame:
    """Per key: the latest comment up to its first comma; an empty latest comment gives ``''``."""
    latest = F.max_by(F.struct(comment), comment_id).getField(comment)
    return df.groupBy(key).agg(latest.alias(out)).withColumn(out, first_clause(F.col(out)))


def first_event_user(df: DataFrame, key: str, user: str, event_id: str, out: str = "first_user") -> DataFrame:
    """Per key: the user of its earliest event."""
    return df.groupBy(key).agg(F.min_by(F.struct(user), event_id).getField(user).alias(out))


# Headings of the comment history by lead type.
HISTORY_HEADING = {"APPOINTMENT": "Appointment Comments: \n ", "CASE": "User Comments: \n "}


def comment_history(
    df: DataFrame, lead: str, comment_id: str, stamp: Column, text: str, heading: str, part_size: int = 10_000
) -> DataFrame:
    """Per lead: heading and one ``stamp : text`` line per comment in id order, blank ones skipped.

    The id is unique within a lead. Every history is cut into parts of ``part_size`` comments, numbered from 0; only
    the first has the heading. Put end to end they are the whole text.
    """
    line = F.concat(F.coalesce(stamp.cast("string"), F.lit("")), F.lit(" : "), F.col(text), F.lit(" \n"))
    kept = df.where(F.col(text).isNotNull() & (F.col(text) != ""))
    placed = ordered_position(kept.select(lead, F.col(comment_id).alias("_id"), line.alias("_line")), [lead], ["_id"])
    parts = placed.withColumn("part", F.floor((F.col("position") - 1) / part_size)).groupBy(lead, "part").agg(
        F.expr("listagg(_line, '') WITHIN GROUP (ORDER BY _id)").alias("_body")
    )
    opening = F.when(F.col("part") == 0, F.lit(heading)).otherwise(F.lit(""))
    return parts.select(lead, "part", F.concat(opening, "_body").alias("history"))


def serial_number(df: DataFrame, order: str, out: str = "serial") -> DataFrame:
    """1, 2, 3 ... over all rows in the order of a unique id of any kind."""
    return ordered_position(df, [], [order], out)
