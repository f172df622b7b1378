"""Follow-up queue reports and the ageing of follow-ups."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F, types as T

from opsreports.functions.labels import age_bucket, city_code
from opsreports.functions.times import age_seconds, day, from_epoch_ms, slot_label, slot_ordinal
from opsreports.operators import aggregates as agg
from opsreports.operators.filters import between_dates, due_before
from opsreports.operators.joins import attach, attach_slot_counts, member_home_counts, members_elsewhere
from opsreports.plans.common import Keep, as_is, with_patient
from opsreports.plans.inputs import Desk
from opsreports.sources.readers import explode_json

# The two cities of the queue reports, by id.
QUEUE_CITIES = {3: "Jaipur", 4: "NCR"}
OPEN_STATUS = ("0", "1", "5")


def followups(
    desk: Desk, on: dt.date, cities: Mapping[int, str], tenant: str, system_user: str, padded: bool
) -> DataFrame:
    """Open leads to follow up on one day, with their slot."""
    leads = desk["patient_case"].where(
        (F.col("followUpdate") == day(on))
        & F.col("patientLeadStatus").isin(*OPEN_STATUS)
        & (F.col("assignedTo") != system_user)
        & (F.col("tenantName") == tenant)
    )
    leads = with_patient(leads, desk)
    leads = attach(leads, desk["city"], {"cityId": "id"}, {"cityName": "city"}, "inner")
    slot = slot_label(F.coalesce("followUpTime", F.lit("None")), padded)
    return leads.where(F.col("city").isin(*cities.values())).withColumn("slot", slot)


def _slot_table(slots: DataFrame, measures: list[str]) -> DataFrame:
    """Slots of each city in clock order with a Total row; an unreadable slot shows only in the total."""
    table = agg.total_row(slots, ["city"], "slot", measures)
    table = table.withColumn("agents_needed", agg.agents_needed()).withColumn("ordinal", slot_ordinal(F.col("slot")))
    is_total = F.coalesce(F.col("slot") == agg.TOTAL, F.lit(False))
    rounded = F.when(is_total, F.bround("agents_needed", 2)).otherwise(F.col("agents_needed"))
    shown = table.where(is_total | F.col("ordinal").isNotNull())
    return shown.withColumn("agents_needed", rounded).orderBy("city", F.col("ordinal").asc_nulls_last())


def followup_queue_next_day(
    desk: Desk, as_of: dt.date, queue: str, system_user: str, tenant: str = "MAIN",
    cities: Mapping[int, str] = QUEUE_CITIES, keep: Keep = as_is,
) -> dict[str, DataFrame]:
    """Workload of tomorrow's follow-up slots per city."""
    leads = keep(followups(desk, as_of + dt.timedelta(days=1), cities, tenant, system_user, padded=True))
    slots = agg.slot_workload(leads, ["city", "slot"], "assignedTo", "reason", queue).drop("agents_needed")
    return {"slots": _slot_table(slots, ["queued", "pending", "with_agent"]), "leads": leads}


def followup_queue_today(
    desk: Desk, as_of: dt.datetime, queue: str, system_user: str, tenant: str = "MAIN",
    team: str = "OUTBOUND", cities: Mapping[int, str] = QUEUE_CITIES, keep: Keep = as_is,
) -> dict[str, DataFrame]:
    """Workload of today's slots with scheduled calls, and the agents and queue behind them.

    ``as_of`` is local time, as is scheduledOn.
    """
    today = as_of.date()
    leads = keep(followups(desk, today, cities, tenant, system_user, padded=False))
    slots = agg.slot_workload(leads, ["city", "slot"], "assignedTo", "reason", queue).drop("agents_needed")

    waiting = desk["outbound_queue"].where((F.col("status") == "ENQUEUED") & F.col("cityId").isin(*cities))
    calls = waiting.where(between_dates(F.col("scheduledOn"), today, today))
    calls = attach(calls, desk["city"], {"cityId": "id"}, {"cityName": "city"})
    scheduled = agg.count_by_hour_slot(calls, ["city"], "scheduledOn", out="scheduled")
    slots = attach_slot_counts(slots, scheduled, ["city", "slot"], "scheduled")

    teams = desk["agent_source"].where((F.col("source") == team) & F.col("cityId").isin(*cities))
    sizes = member_home_counts(teams, "cityId", "emailId", desk["support_staff"], "email", "cityId")
    away = members_elsewhere(teams, "cityId", "emailId", desk["support_staff"], "email", "cityId")
    names = agg.concat_per_key(away, ["cityId"], "member", "other_city_agents")
    due = waiting.where(due_before(F.col("scheduledOn"), as_of))
    queue_size = agg.count_group(due, "cityId", out="queue_size")
    agents = sizes.join(queue_size, "cityId", "left").na.fill(0, ["queue_size"])
    agents = attach(agents, desk["city"], {"cityId": "id"}, {"cityName": "city"})
    return {
        "slots": _slot_table(slots, ["queued", "pending", "with_agent", "scheduled"]),
        "agents": agents, "names": names, "leads": leads, "calls": calls,
    }


# One follow-up as it is landed.
FOLLOWUP_ITEM = T.StructType([
    T.StructField("caseId", T.LongType()),
    T.StructField("patientId", T.LongType()),
    T.StructField("entityId", T.LongType()),
    T.StructField("entityType", T.StringType()),
    T.StructField("followUpReason", T.StringType()),
    T.StructField("followUpDate", T.StringType()),
    T.StructField("followUpTime", T.StringType()),
    T.StructField("createdOn", T.LongType()),
])


def followup_ageing(desk: Desk, as_of: dt.datetime, agent_type: str = "AGENT") -> dict[str, DataFrame]:
    """Open follow-ups of every available agent with their age; ``as_of`` is UTC."""
    agents = desk["staff"].where((F.col("personnelType") == agent_type) & (F.col("isAvailable") == 1))
    agents = attach(agents, desk["city"], {"cityId": "id"}, ["cityName"])
    agents = agents.select("email", city_code(F.col("cityName")).alias("city"))
    landed = attach(agents, desk["followup_landed"], {"email": "email"}, ["body"], "inner")
    items = explode_json(landed, "body", FOLLOWUP_ITEM, ["email", "city"])
    aged = items.withColumn("created", from_epoch_ms(F.col("createdOn")))
    aged = aged.withColumn("seconds", age_seconds(F.col("created"), as_of))
    return {"followups": aged.withColumn("age", age_bucket(F.col("seconds")))}
