"""Reports on leads, channels, agents' incentives and messages."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from opsreports.functions.labels import CITY_CODES_5, LEAD_STATUS, code_to_label_strict
from opsreports.functions.times import LOCAL_OFFSET, local_date, local_time, ntz, pick_windows
from opsreports.operators import aggregates as agg
from opsreports.operators.filters import between_local_dates, matches
from opsreports.operators.joins import (
    attach, classify_membership, keep_known, lookup_by_source, lookup_last, replace_column,
)
from opsreports.plans.common import Keep, as_is, with_case_city, with_patient
from opsreports.plans.inputs import Desk
from opsreports.sources.writers import conform

# Channels of the offline report and its uploaded table.
OFFLINE_SOURCES = ("Offline channel", "VC Model")
OFFLINE_SCHEMA = T.StructType([
    T.StructField("caseId", T.StringType()),
    T.StructField("followUpdate", T.StringType()),
    T.StructField("followUpTime", T.StringType()),
    T.StructField("symptoms", T.StringType()),
    T.StructField("leadSource", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("customerNumber", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("createdBy", T.StringType()),
    T.StructField("leadStatus", T.StringType()),
    T.StructField("caseCreatedOn", T.TimestampNTZType()),
    T.StructField("caseMonth", T.IntegerType()),
])


def offline_followup(desk: Desk, since: dt.date, tenant: str = "MAIN") -> dict[str, DataFrame]:
    """Offline cases that were ever in follow-up, with their creator and status."""
    cases = desk["patient_case"].where(
        F.col("leadSource").isin(*OFFLINE_SOURCES) & (F.col("tenantName") == tenant) & (F.col("createdOn") >= ntz(since))
    )
    moved = desk["patient_case_audit"].where(
        F.col("patientLeadStatus").isin("0", "1", "5") & F.col("followUpdate").isNotNull()
    )
    cases = keep_known(cases, "caseId", moved, "caseId")
    cases = with_case_city(with_patient(cases, desk, customer_columns=["customerNumber"], how="left"), desk)
    created = desk["lead_comment"].where((F.col("leadType") == "CASE") & (F.col("commentType") == "CREATION"))
    cases = lookup_last(cases, "caseId", created, "leadId", {"user": "createdBy"}, ["commentId"])
    shown = local_time(F.col("createdOn"))
    cases = cases.withColumns({
        "leadStatus": code_to_label_strict(F.col("patientLeadStatus"), LEAD_STATUS),
        "caseCreatedOn": shown,
        "caseMonth": F.month(shown),
    })
    return {"cases": conform(cases, OFFLINE_SCHEMA)}


# Lead sources of the channel report; the last one is named by its campaign.
DIRECT_SOURCES = ("Exotel", "Whatsapp")
CAMPAIGN_SOURCE = "Website Submit"


def channel_tracking(desk: Desk, as_of: dt.date, keep: Keep = as_is) -> dict[str, DataFrame]:
    """Leads of the trailing week and the share with a channel name, by city and source."""
    week, = pick_windows(as_of, "trailing_week")
    sources = (*DIRECT_SOURCES, CAMPAIGN_SOURCE)
    patients = desk["patient_profile"].where(between_local_dates(F.col("createdOn"), week.start, week.end))
    customers = desk["customer_profile"].where(F.col("leadSource").isin(*sources))
    cases = attach(
        desk["patient_case"].select("caseId", "patientId", "cityId"), patients, {"patientId": "id"},
        {"customerId": "customerId", "cityId": "patientCityId", "createdOn": "createdOn"}, "inner",
    )
    cases = attach(cases, customers, {"customerId": "customerId"}, ["customerNumber", "leadSource"], "inner")
    cases = with_case_city(cases, desk, CITY_CODES_5)
    cases = attach(cases, desk["patient_channel"], {"patientId": "patientProfileId"}, ["marketingChannelId"])
    cases = attach(cases, desk["marketing_channel"], {"marketingChannelId": "id"}, {"channelName": "linked"})
    tagged = desk["campaign"].where(F.col("eventLabel") != "(not set)")
    tagged = tagged.withColumn("caseId", F.col("eventLabel").try_cast("bigint"))
    cases = lookup_last(cases, "caseId", tagged, "caseId", {"campaign": "campaign"}, ["rowNo"])
    leads = lookup_by_source(cases, "leadSource", DIRECT_SOURCES, "linked", "campaign", "channelName")
    leads = keep(leads.withColumn("date", local_date(F.col("createdOn"))))
    cities = list(CITY_CODES_5.values())
    table = agg.coverage_pct(leads.where(F.col("city").isin(*cities)), ["city", "leadSource"], "channelName")
    return {"coverage": agg.with_all_labels(table, [], {"city": cities, "leadSource": sources}), "leads": leads}


# The incentive tables by city; any other city is in the third.
REGIONS = {"Bangalore": "BLR", "Hyderabad": "HYD"}


def incentive_by_region(
    desk: Desk, regions: Mapping[str, str] = REGIONS, other: str = "NORTH", sequences: Sequence[int] = (1, 2)
) -> dict[str, DataFrame]:
    """Agents' first and second visits of the week against their target, by region.

    The agent's city comes from the staff list, not from the weekly rows.
    """
    visits = desk["weekly_visit"].where(F.col("sequence").isin(*sequences)).withColumnRenamed("agentAction", "email")
    visits = attach(visits, desk["target"], {"email": "email"}, ["reportingTl", "newTarget", "newCovTarget"])
    homes = attach(desk["support_staff"], desk["city"], {"cityId": "id"}, {"cityName": "city"})
    visits = replace_column(visits, "city", homes, "email")
    visits = visits.withColumn("region", agg.region_of(F.col("city"), regions, other))
    paid = agg.incentive(
        visits, ["region", "email", "city", "reportingTl", "newCovTarget"],
        F.col("apptType") == "Online Consultation", "newTarget",
    )
    return {"incentive": paid}


def satisfaction_messages(
    desk: Desk, as_of: dt.date, question: str, yes: str, no: str
) -> dict[str, DataFrame]:
    """Survey questions sent since yesterday, with the answer their recipient got to read.

    The three patterns are searched for anywhere in a message; a yes outranks a no.
    """
    since = dt.datetime.combine(as_of - dt.timedelta(days=1), dt.time()) - LOCAL_OFFSET
    sent = desk["message"].where((F.col("toMessage") != F.col("fromId")) & (F.col("createdOn") >= ntz(since)))
    text = F.col("message")
    classes = [
        ("Yes", sent.where(matches(text, yes)), "toMessage"),
        ("No", sent.where(matches(text, no)), "toMessage"),
    ]
    asked = classify_membership(sent.where(matches(text, question)), "toMessage", classes, "response")
    return {
        "messages": asked.select(
            "uuid", "toMessage", "message", "status", local_time(F.col("createdOn")).alias("createdOn"), "response"
        )
    }
