"""Reports on visits, staff, surgeries, feedback and calls."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from opsreports.functions.labels import CONSULTATION_STATUS_LIVE, city_code, code_to_label_strict
from opsreports.functions.text import phone_local, record_url
from opsreports.functions.times import LOCAL_OFFSET, local_time, parse_day_first
from opsreports.operators import aggregates as agg
from opsreports.operators.filters import min_age_days, not_pair, previous_hour, trailing_window
from opsreports.operators.joins import attach, drop_known, keep_known
from opsreports.operators.sequences import rank_average
from opsreports.plans.common import Keep, as_is, with_case_city, with_patient
from opsreports.plans.inputs import Desk
from opsreports.session import settle


def home_pickup(desk: Desk, hospital_id: int) -> dict[str, DataFrame]:
    """Completed visits at one place, labelled by whether they were the patient's first anywhere."""
    visits = attach(desk["appointment"], desk["patient_case"], {"leadId": "caseId"},
                    ["patientId", "leadSource", "caseType", "reason"], "inner")
    came = visits.where(F.col("hospitalId") == hospital_id)
    theirs = keep_known(visits.where(F.col("doctorConsultationStatus") == "3"), "patientId", came, "patientId")
    ranked = rank_average(settle(theirs), "patientId", "id")
    # The id is unique, so the first visit anywhere is the one of rank 1.
    kind = F.when(F.col("rank") == 1, "New Patient").otherwise("Existing patient")
    rows = ranked.where(F.col("hospitalId") == hospital_id).withColumn("patient_type", kind)
    status = code_to_label_strict(F.col("doctorConsultationStatus"), CONSULTATION_STATUS_LIVE)
    rows = rows.withColumn("status", status)
    rows = with_patient(rows, desk, ["patientName"], ["customerNumber"], how="left")
    return {"visits": rows}


def staff_availability(
    desk: Desk, agent_type: str = "AGENT", tenant: str = "MAIN", mapping: str = "AGENT"
) -> dict[str, DataFrame]:
    """Hospitals of every agent at work, per city."""
    agents = desk["staff"].where(
        (F.col("isAvailable") == 1) & (F.col("hasLeft") == 0) & (F.col("personnelType") == agent_type)
    )
    places = desk["staff_facility"].where(
        (F.col("isValid") == 1) & (F.col("tenantName") == tenant) & (F.col("mappingType") == mapping)
    )
    rows = attach(agents, places, {"personnelId": "personnelId"}, ["facilityId"], "inner")
    rows = attach(rows, desk["facility"], {"facilityId": "facilityId"}, ["aliasName"], "inner")
    rows = attach(rows, desk["city"], {"cityId": "id"}, ["cityName"])
    rows = rows.withColumn("city", city_code(F.col("cityName"), default="NA"))
    return {"staff": agg.concat_distinct_per_key(rows, ["email", "city"], "aliasName", "hospitals")}


def surgery_tracker(
    desk: Desk, tracker: DataFrame, as_of: dt.datetime, tenant: str = "MAIN",
    excluded_hospitals: Sequence[str] = (), excluded_pair: tuple[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Admissions the tracker lacks, at least a day old. ``tracker`` has the ids it holds; as_of is local."""
    rows = desk["surgery"].where(
        (F.col("surgeryStatus") == "ADMISSION_DONE") & min_age_days(F.col("admissionDate"), as_of)
    )
    rows = drop_known(rows, "id", tracker, "id")
    cases = desk["patient_case"].where(
        (F.col("leadSource") != "Hospital Insurance") & (F.col("tenantName") == tenant)
    )
    rows = attach(rows, cases, {"caseId": "caseId"}, ["patientId", "cityId", "specialityId", "leadSource"], "inner")
    rows = attach(rows, desk["facility"], {"hospitalId": "facilityId"}, ["aliasName"], "inner")
    if excluded_hospitals:
        rows = rows.where(~F.col("aliasName").isin(*excluded_hospitals))
    if excluded_pair is not None:
        rows = rows.where(not_pair(F.col("aliasName"), excluded_pair[0], F.col("leadSource"), excluded_pair[1]))
    rows = with_case_city(with_patient(rows, desk, ["patientName"], ["customerNumber"]), desk)
    rows = attach(rows, desk["speciality"], {"specialityId": "id"}, ["specialityName"])
    return {
        "new_rows": rows.select(
            "caseId", "patientName", "aliasName", "specialityName", "id", "admissionDate", "city",
            phone_local(F.col("customerNumber")).alias("customerNumber"), "leadSource",
        )
    }


NO_CITY = "NOCITY"


def feedback(desk: Desk, as_of: dt.datetime, base_url: str) -> dict[str, DataFrame]:
    """Survey answers of the previous whole hour with their case, per city; unmatched ones under NOCITY.

    A consultation answer names its appointment, a procedure answer its case. The few answers
    of the hour are joined outward, so no lookup table of all cases is made.
    """
    visits = desk["appointment"].select(F.col("id").alias("named"), F.col("leadId").alias("caseId"))
    cases = desk["patient_case"].select(F.col("caseId").alias("named"), "caseId")
    answers = _placed(desk, as_of, base_url, "survey_consultation", visits).unionByName(
        _placed(desk, as_of, base_url, "survey_procedure", cases)
    )
    listed = desk["city"].select(city_code(F.col("cityName"), default=NO_CITY).alias("city"))
    cities = listed.union(desk["city"].sparkSession.range(1).select(F.lit(NO_CITY))).distinct()
    return {"answers": answers, "cities": cities}


def _placed(desk: Desk, as_of: dt.datetime, base_url: str, survey: str, index: DataFrame) -> DataFrame:
    """The answers of one survey with the case that ``index`` gives for the id they name."""
    rows = desk[survey].withColumn("submitted", parse_day_first(F.col("submittedAt")))
    rows = rows.where(previous_hour(F.col("submitted"), as_of)).withColumnRenamed("caseid", "answerId")
    asked = rows.select(F.col("answerId").alias("key"), F.col("answerId").try_cast("bigint").alias("named")).distinct()
    known = asked.join(index, "named").where(F.col("key") == F.col("named").cast("string"))
    known = attach(known, desk["patient_case"], {"caseId": "caseId"}, ["patientId", "cityId"], "inner")
    known = with_case_city(with_patient(known, desk, (), ["customerNumber"]), desk, default=NO_CITY)
    placed = attach(rows, known, {"answerId": "key"}, ["city", "customerNumber", "patientId", "caseId"])
    return placed.select(
        F.lit(survey).alias("survey"), F.coalesce("city", F.lit(NO_CITY)).alias("city"),
        F.date_format(local_time(F.col("submitted"), LOCAL_OFFSET), "dd/MM/yyyy HH:mm:ss").alias("submittedAt"),
        "answerId", F.coalesce("customerNumber", F.lit("")).alias("customerNumber"),
        record_url(base_url, F.col("patientId"), F.col("caseId")).alias("url"), "recommend", "suggestions",
    )


# The columns of the three call tables.
LEG_STATUS = {"na": "N/A", "busy": "busy", "completed": "completed", "no_answer": "no-answer", "none": "None", "failed": "failed"}
AGENT_STATUS = {"busy": "busy", "completed": "completed", "failed": "failed", "no_answer": "no-answer"}
SENT = {"sent": "True", "not_requested": "Not Requested", "not_sent": "False"}
LEGS = [(f"leg{i}Agent_email", f"leg{i}Status") for i in (1, 2, 3)]


def call_view(
    desk: Desk, as_of: dt.datetime, city: str, excluded_type: str = "AGENT",
    older: dt.timedelta = dt.timedelta(minutes=30), newer: dt.timedelta = dt.timedelta(minutes=20), keep: Keep = as_is,
) -> dict[str, DataFrame]:
    """Inbound calls of one city, 30 to 20 minutes ago: by status and leg, by status and message, by agent.

    ``as_of`` is in the same local time as the calls.
    """
    calls = desk["call_summary"].where(
        trailing_window(F.col("call_created_on"), as_of, older, newer)
        & (F.col("city") == city)
        & (F.col("personnelType") != excluded_type)
    )
    calls = keep(calls)
    legs = agg.unpivot_pairs(calls, LEGS, "agent", "status")
    by_agent = agg.crosstab(legs, ["agent"], F.col("status"), AGENT_STATUS)
    return {
        "by_leg": agg.crosstab(calls, ["finalDetailedStatus"], F.col("leg_1_status"), LEG_STATUS),
        "by_message": agg.crosstab(calls, ["finalDetailedStatus"], F.col("noSent"), SENT),
        "by_agent": by_agent.orderBy("busy", "agent"),
        "calls": calls,
    }
