"""Reports on diagnostic cases and on tests advised during consultations."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from opsreports.functions.labels import CONSULTATION_STATUS_WEEKLY, code_to_label_strict, threshold_band
from opsreports.functions.text import json_text
from opsreports.functions.times import Window, local_date, pick_windows
from opsreports.operators import aggregates as agg
from opsreports.operators.filters import between_dates, between_local_dates, differs
from opsreports.operators.joins import attach, flag_known, keep_known, lookup_first
from opsreports.operators.sequences import followup_pair
from opsreports.plans.common import Keep, as_is, with_facility_city, with_patient
from opsreports.plans.inputs import Desk

# Channels and visit kinds of the case report.
OUTSIDE_SOURCES = ("Offline channel", "CAMP")
VISIT_KINDS = ("NEW_APPOINTMENT", "RESCHEDULED_APPOINTMENT", "FOLLOWUP_APPOINTMENT")
FOLLOW_UP = "FOLLOWUP_APPOINTMENT"
# Spellings of the consultation type of a test visit.
DIAGNOSTIC_TYPES = ("DIAGNOSTICS", "Diagnostics")


def created_by_agent(desk: Desk, agent_type: str) -> DataFrame:
    """Cases a hospital agent created, by their creation comment."""
    agents = desk["staff"].where(F.col("personnelType") == agent_type)
    made = desk["lead_comment"].where((F.col("commentType") == "CREATION") & (F.col("leadType") == "CASE"))
    return keep_known(made, "user", agents, "email").select("leadId")


def diagnostic_cases(
    desk: Desk, as_of: dt.date, tenant: str = "MAIN", agent_type: str = "AGENT",
    outside_sources: Sequence[str] = OUTSIDE_SOURCES, keep: Keep = as_is,
) -> dict[str, DataFrame]:
    """Diagnostic leads and tests of yesterday and of the month, support team cases only.

    summary: status counts; followup_reasons, cancel_reasons, tests, followup_tests: counts by label.
    """
    yesterday, month = pick_windows(as_of, "yesterday", "month_to_date")
    windows = [yesterday, month]
    theirs = created_by_agent(desk, agent_type)
    wanted = desk["patient_case"].where(
        (F.col("caseType") == "Diagnostics") & ~F.col("leadSource").isin(*outside_sources) & (F.col("tenantName") == tenant)
    )

    cases = wanted.where(between_local_dates(F.col("createdOn"), month.start, month.end)).select(
        "caseId", "patientLeadStatus", "reason", local_date(F.col("createdOn")).alias("date")
    )
    cases = flag_known(cases, "caseId", theirs, "leadId", "isCsUser", yes="no", no="yes")

    done = desk["appointment"].where(
        (F.col("doctorConsultationStatus") == "3")
        & F.col("appointmentCreationType").isin(*VISIT_KINDS)
        & between_dates(F.col("appointmentDate"), month.start, month.end)
    ).select("id", "leadId", "consultationType", "appointmentCreationType", F.to_date("appointmentDate").alias("date"))
    done = keep_known(done, "leadId", wanted, "caseId")
    done = attach(done, desk["appointment_test"], {"id": "appointmentId"}, ["testId"])
    done = attach(done, desk["test"], {"testId": "id"}, {"name": "testName"})
    done = done.withColumn("testName", F.coalesce("testName", F.lit("N.A")))
    done = flag_known(done, "leadId", theirs, "leadId", "isCsUser", yes="no", no="yes")

    cases, done = keep(cases), keep(done)
    own_cases, own_done = cases.where(F.col("isCsUser") == "yes"), done.where(F.col("isCsUser") == "yes")
    fresh = own_done.where(differs(F.col("appointmentCreationType"), FOLLOW_UP))
    again = own_done.where(
        (F.col("appointmentCreationType") == FOLLOW_UP) & differs(F.col("consultationType"), "Diagnostics")
    )
    status = F.col("patientLeadStatus")
    open_again = status.isin("1", "0", "5")
    leads = agg.summary_by_window(
        own_cases, F.col("date"),
        {
            "confirmed": status == "7", "booked": status == "2", "followUp": open_again, "cancelled": status == "3",
            "total_leads_created": F.lit(True),
        },
        windows,
    )
    visits = agg.summary_by_window(
        own_done, F.col("date"),
        {
            "appointments_done": differs(F.col("appointmentCreationType"), FOLLOW_UP),
            "followups_done": (F.col("appointmentCreationType") == FOLLOW_UP)
            & differs(F.col("consultationType"), "Diagnostics"),
        },
        windows,
    )
    count = lambda rows, label: agg.count_by_label_windows(rows, label, F.col("date"), windows)
    return {
        "summary": leads.unionByName(visits),
        "followup_reasons": count(own_cases.where(open_again), "reason"),
        "cancel_reasons": count(own_cases.where(status == "3"), "reason"),
        "tests": count(fresh, "testName"),
        "followup_tests": count(again, "testName"),
        "cases": cases,
        "done": done,
    }


def diagnostic_week(
    desk: Desk, window: Window, city_ids: Sequence[int] = (1, 2, 3, 4), keep: Keep = as_is
) -> dict[str, DataFrame]:
    """Tests advised and done in one window, by agent and by hospital (dim, label), with a colour band.

    The agent is the user of the first note that closed the appointment.
    """
    is_test = F.col("consultationType").isin(*DIAGNOSTIC_TYPES)
    rows = desk["appointment"].where(
        (F.col("doctorConsultationStatus") == "3") & between_dates(F.col("appointmentDate"), window.start, window.end)
    )
    rows = with_facility_city(rows, desk).where(F.col("facilityCityId").isin(*city_ids))
    leads = rows.where(~is_test).select("leadId")
    rows = attach(rows, desk["patient_case"], {"leadId": "caseId"}, ["patientId"])
    rows = with_patient(rows, desk, (), ["customerNumber"], how="left", known="knownCustomer")
    is_visit = ~is_test & F.col("knownCustomer")

    taken = desk["appointment"].where((F.col("doctorConsultationStatus") == "3") & is_test)
    taken = keep_known(taken, "leadId", leads, "leadId").select(
        F.col("originConsultationId").try_cast("bigint").alias("origin")
    )
    closed = desk["lead_comment"].where(
        (F.col("commentType") == "APPOINTMENT_DONE") & (F.col("leadType") == "APPOINTMENT")
    )
    rows = lookup_first(rows, "id", closed, "leadId", {"user": "agent"}, ["commentId"])
    rows = flag_known(rows, "id", taken, "origin", "diagnostics_done")
    rows = rows.withColumns({
        "recommended": json_text(F.col("additionalDetails"), "isDiagnosticsTestRecommended"),
        "status": code_to_label_strict(F.col("doctorConsultationStatus"), CONSULTATION_STATUS_WEEKLY, "None"),
        "date": F.to_date("appointmentDate"),
    })
    rows = keep(rows)
    table = agg.visit_summary(
        rows, {"agent": "agent", "hospital": "aliasName"}, is_test, is_visit, "consultationFee",
        F.col("recommended") == "YES", F.col("diagnostics_done") == "Yes",
    )
    summary = table.withColumn("band", threshold_band(F.col("taken_pct"), F.col("recommended")))
    return {"summary": summary, "tests": rows.where(is_test), "visits": rows.where(is_visit)}


def advised_then_visited(desk: Desk) -> dict[str, DataFrame]:
    """Per patient: the first consultation that advised a test, and the next one done."""
    visits = desk["visit"]
    consulted = F.col("consultationType").isin("Consultation", "Online Consultation") & (F.col("appointmentStatus") == "DONE")
    advised = consulted & (F.col("isDiagnosticsTestRecommended") == "YES")
    pairs = followup_pair(visits, "patientId", "apptId", advised, consulted, ["caseid", "number", "appointmentDate"])
    came = F.col("second_apptId").isNotNull()
    latest = lambda c: F.when(came, F.col(f"second_{c}")).otherwise(F.col(f"first_{c}"))
    rows = pairs.select(
        "patientId", latest("caseid").alias("caseid"), latest("number").alias("number"),
        F.col("first_appointmentDate").alias("appointmentDate"), F.col("first_apptId").alias("apptId"),
        F.col("second_apptId").alias("nextApptId"), F.col("second_appointmentDate").alias("nextAppointmentDate"),
        latest("apptId").alias("_tested"),
    )
    tests = keep_known(desk["appointment_test"], "appointmentId", rows, "_tested")
    tests = attach(tests, desk["test"], {"testId": "id"}, {"name": "testName"})
    names = agg.concat_per_key(tests, ["appointmentId"], "testName", "testNames")
    return {"pairs": rows.drop("_tested").orderBy("apptId"), "tests": names}
