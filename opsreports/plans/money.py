"""Reports on fees, payments, the wallet and payments to hospitals."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from opsreports.functions.labels import (
    CONSULTATION_STATUS_LIVE, PAY_MODE_CLASS, PAY_MODE_CLASSES, SERVICES, code_to_label_strict, fee_bucket,
    fee_bucket_labels, map_value,
)
from opsreports.functions.money import minor_to_major, whole_units
from opsreports.functions.text import json_text
from opsreports.functions.times import LOCAL_OFFSET, day_windows, local_date, local_time, pick_windows, week_windows
from opsreports.operators import aggregates as agg
from opsreports.operators.filters import between_local_dates, within_last
from opsreports.operators.joins import attach, attach_latest, attach_where, flag_known, keep_known, lookup_first
from opsreports.operators.ledger import ledger_balances
from opsreports.operators.sequences import first_per_key, serial_number
from opsreports.plans.common import Keep, as_is, with_case_city, with_facility_city, with_patient
from opsreports.plans.inputs import Desk
from opsreports.session import settle
from opsreports.sources.writers import conform, deliver

# The cities and channels the fee report looks at.
FEE_CITIES = ("CHD", "BLR", "Jaipur", "NCR", "Hyderabad")
OUTSIDE_SOURCES = ("Offline channel", "VC Model")


def first_consultations(desk: Desk, wallet_mode: str, excluded_hospitals: Sequence[int] = ()) -> DataFrame:
    """Each patient's first completed consultation booked by the support team, with its fee bucket."""
    visits = desk["appointment"].where(
        F.col("appointmentCreationType").isin("NEW_APPOINTMENT", "RESCHEDULED_APPOINTMENT")
        & (F.col("doctorConsultationStatus") == "3")
    )
    if excluded_hospitals:
        visits = visits.where(~F.col("hospitalId").isin(*excluded_hospitals))
    visits = keep_known(visits, "user", desk["support_staff"], "email")
    cases = desk["patient_case"].where(
        ~F.col("leadSource").isin(*OUTSIDE_SOURCES) & (F.col("caseType") != "Diagnostics")
    )
    visits = attach(visits, cases, {"leadId": "caseId"}, ["patientId", "leadSource"], "inner")
    first = first_per_key(visits, ["patientId"], ["id"])
    first = attach(first, desk["patient_profile"], {"patientId": "id"}, ["customerId"])
    first = lookup_first(first, "leadId", desk["payment_link"], "entityId", {"paymentMode": "paymentMode"}, ["id"])
    first = attach_latest(with_facility_city(first, desk, ()), desk["card"], {"customerId": "customerId"}, "activationDate", "issued")
    paid = desk["card_transaction"].where(
        (F.col("transactionType") == "DEBIT")
        & (F.col("transactionStatus") == "CONFIRMED")
        & (F.col("entityType") == "APPOINTMENT")
    )
    first = flag_known(first, "id", paid, "entityId", "cardPaid")
    same_day = F.coalesce(F.to_date("createdOn") == F.to_date("issued"), F.lit(False))
    bucket = fee_bucket(
        F.col("consultationFee"), F.col("paymentMode"), (F.col("cardPaid") == "Yes") | same_day, wallet_mode
    )
    return first.select(
        "patientId", F.col("id").alias("apptId"), "consultationFee", "paymentMode", "city",
        F.to_date("appointmentDate").alias("appointmentDate"), bucket.alias("bucket"),
    )


def consultation_fees(
    desk: Desk, as_of: dt.date, wallet_mode: str = "WALLET", cities: Sequence[str] = FEE_CITIES,
    excluded_hospitals: Sequence[int] = (), keep: Keep = as_is,
) -> dict[str, DataFrame]:
    """Fee bands by day (four days and month to date) and by week, with shares and averages, per city."""
    everywhere = keep(first_consultations(desk, wallet_mode, excluded_hospitals))
    detail = everywhere.where(F.col("city").isin(*cities))
    labels = {"bucket": fee_bucket_labels(wallet_mode)}
    days, weeks = day_windows(as_of), week_windows(as_of)
    when = F.col("appointmentDate")

    names = [w.name for w in days]
    daily = agg.bucket_window_counts(detail, ["city"], "bucket", when, days)
    daily = agg.with_all_labels(daily, ["city"], labels)
    daily = agg.share_of_column(agg.total_row(daily, ["city"], "bucket", names), ["city"], "bucket", names)

    names = [w.name for w in weeks]
    counts, sums = [f"{n}_n" for n in names], [f"{n}_sum" for n in names]
    weekly = agg.bucket_window_sums(detail, ["city"], "bucket", when, F.col("consultationFee"), weeks)
    weekly = agg.with_all_labels(weekly, ["city"], labels)
    weekly = agg.total_row(weekly, ["city"], "bucket", [*counts, *sums])
    weekly = agg.averages(agg.share_of_column(weekly, ["city"], "bucket", counts), names)
    return {"daily": daily, "weekly": weekly, "detail": everywhere}


def payments(desk: Desk, first: dt.date, last: dt.date, once_per_card_payment: bool = False) -> DataFrame:
    """Paid card fees, appointments and surgeries of local days first..last, as one list.

    A card fee counts once per family member of the customer unless asked otherwise.
    """
    created = lambda: between_local_dates(F.col("createdOn"), first, last)
    loyalty = desk["card_payment"].where((F.col("paymentStatus") == "PAID") & created())
    loyalty = attach(loyalty, desk["card"], {"cardId": "cardId"}, ["customerId"], "inner")
    members = attach(
        desk["patient_profile"], desk["customer_profile"].select(F.col("customerId").alias("c")), {"customerId": "c"}, how="inner"
    )
    loyalty = attach(loyalty, members, {"customerId": "customerId"}, {"cityId": "cityId", "id": "memberId"}, "inner")
    if once_per_card_payment:
        loyalty = first_per_key(loyalty, ["id"], ["memberId"])
    loyalty = with_case_city(loyalty.withColumn("patientCityId", F.lit(None).cast("int")), desk)

    links = (F.col("entityType") == "APPOINTMENT") & (F.col("status") == "PAID") & (F.col("paymentMode") != "ZERO_FEE")
    visits = attach_where(
        desk["appointment"].where(created()), desk["payment_link"], {"id": "entityId"}, links, ["paymentMode"], "inner"
    )
    visits = attach(visits, desk["patient_case"], {"leadId": "caseId"}, ["patientId", "cityId"], "inner")
    visits = with_case_city(with_patient(visits, desk), desk)

    surgeries = desk["surgery_payment"].where((F.col("paymentStatus") == "PAID") & created())
    surgeries = attach(surgeries, desk["surgery"], {"patientSurgeryId": "id"}, ["caseId"], "inner")
    surgeries = attach(surgeries, desk["patient_case"], {"caseId": "caseId"}, ["patientId", "cityId"], "inner")
    surgeries = with_case_city(with_patient(surgeries, desk), desk)

    def listed(rows: DataFrame, service: Column) -> DataFrame:
        return rows.select(
            "city", service.alias("service"), "paymentMode", local_date(F.col("createdOn")).alias("date"),
            map_value(F.col("paymentMode"), PAY_MODE_CLASS, "Other").alias("modeClass"),
        )

    known = F.when(F.col("consultationType").isin(*SERVICES), F.col("consultationType")).otherwise("Other")
    return (
        listed(visits, known)
        .unionByName(listed(surgeries, F.lit("IPD")))
        .unionByName(listed(loyalty, F.lit("Loyalty")))
    )


def payment_mix(
    desk: Desk, as_of: dt.date, cities: Sequence[str] | None = None, once_per_card_payment: bool = False,
    keep: Keep = as_is,
) -> dict[str, DataFrame]:
    """Share of each payment class within service and window, per city, all windows from one scan."""
    windows = pick_windows(as_of, "month_to_date", "last_month", "last_week", "this_week")
    first, last = min(w.start for w in windows), max(w.end for w in windows)
    detail = payments(desk, first, last, once_per_card_payment)
    if cities is not None:
        detail = detail.where(F.col("city").isin(*cities))
    detail = keep(detail)
    counts = agg.service_mode_counts(detail, "city", "service", "modeClass", F.col("date"), windows, PAY_MODE_CLASSES)
    full = agg.with_all_labels(counts, ["city"], {"service": SERVICES, "window": [w.name for w in windows]})
    return {"mix": agg.share_of_row(full, PAY_MODE_CLASSES), "detail": detail}


# The payment detail sets by service, and the windows each comes in.
DETAIL_SETS = {"loyalty": ("Loyalty",), "IPD": ("IPD",), "appointment": (*[s for s in SERVICES if s not in ("Loyalty", "IPD")], "Other")}
DETAIL_WINDOWS = {"tm": "month_to_date", "lm": "last_month"}
DELIVERED = T.StructType([T.StructField(c, T.DateType() if c == "date" else T.StringType()) for c in ("service", "paymentMode", "date", "modeClass", "set", "city")])


def deliver_payment_details(desk: Desk, as_of: dt.date, path: str, once_per_card_payment: bool = False) -> str:
    """The six detail sets of the payment report, each below its cities, from one reading of the payments; ``readers.read_delivered`` with ``DELIVERED``."""
    windows = {w.name: w for w in pick_windows(as_of, *DETAIL_WINDOWS.values())}
    rows = payments(desk, min(w.start for w in windows.values()), max(w.end for w in windows.values()), once_per_card_payment)
    sets = {
        f"{group}_{short}": F.col("service").isin(*services) & agg.in_window(F.col("date"), windows[name])
        for group, services in DETAIL_SETS.items() for short, name in DETAIL_WINDOWS.items()
    }
    return deliver(rows.select("service", "paymentMode", "date", "modeClass", "city"), sets, path)


# The wallet table as it is uploaded.
WALLET_SCHEMA = T.StructType([
    T.StructField("entryId", T.StringType()),
    T.StructField("customerId", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("validTill", T.DateType()),
    T.StructField("createdOn", T.StringType()),
    T.StructField("transactionType", T.StringType()),
    T.StructField("customerName", T.StringType()),
    T.StructField("customerEmail", T.StringType()),
    T.StructField("customerNumber", T.StringType()),
    T.StructField("balance", T.DoubleType()),
])

LEDGER_COLUMNS = {
    "id": "entryId", "customer": "customerId", "kind": "transactionType", "amount": "amount",
    "created": "createdOn", "end": "validTill",
}


def wallet_balances(desk: Desk, as_of: dt.date) -> dict[str, DataFrame]:
    """Every wallet credit made before as_of with what is left of it."""
    before = between_local_dates(F.col("createdOn"), dt.date(1970, 1, 1), as_of - dt.timedelta(days=1))
    entries = desk["ledger"].where(before).select(
        "entryId", "customerId", minor_to_major(F.col("amount")).alias("amount"), "validTill",
        local_date(F.col("createdOn")).alias("createdOn"), "transactionType",
    )
    balances = ledger_balances(entries, as_of, LEDGER_COLUMNS)
    named = attach(
        balances, desk["customer_profile"], {"customerId": "customerId"},
        ["customerName", "customerEmail", "customerNumber"],
    )
    return {"wallet": conform(named, WALLET_SCHEMA)}


def payment_notice(
    desk: Desk, as_of: dt.datetime, hospital: str, span: dt.timedelta = dt.timedelta(minutes=2)
) -> dict[str, DataFrame]:
    """Payments to one hospital in the last two minutes: one numbered row per appointment.

    ``as_of`` is local time.
    """
    paid = desk["facility_payment"].where(
        (F.col("paymentStatus") == "processed")
        & F.col("entityType").isin("APPOINTMENT", "DIAGNOSTICS_APPOINTMENT")
        & within_last(F.col("createdOn"), as_of - LOCAL_OFFSET, span)
    )
    paid = paid.withColumn("payment_date", local_time(F.col("createdOn"))).drop("createdOn")
    visit_columns = ["leadId", "hospitalId", "doctorId", "consultationType", "doctorConsultationStatus", "additionalDetails"]
    paid = attach(paid, desk["appointment"], {"entityId": "id"}, visit_columns, "inner")
    paid = attach(paid, desk["facility"].where(F.col("aliasName") == hospital), {"hospitalId": "facilityId"}, ["aliasName"], "inner")
    paid = attach(paid, desk["doctor"], {"doctorId": "doctorId"}, {"name": "doctor_name"})
    paid = attach(paid, desk["patient_case"], {"leadId": "caseId"}, ["patientId"])
    paid = with_patient(paid, desk, ["patientName"], ["customerNumber"])
    detail = paid.select(
        "id", F.col("entityId").alias("appId"), "payment_date", minor_to_major(F.col("amount")).alias("amount"),
        "patientName", "customerNumber",
        json_text(F.col("additionalDetails"), "hospitalPriceBills").alias("hospitalPriceBills"), "consultationType",
        code_to_label_strict(F.col("doctorConsultationStatus"), CONSULTATION_STATUS_LIVE).alias("status"),
        "doctor_name", "utr", F.col("aliasName").alias("hospital_name"),
    )
    one = first_per_key(detail, ["appId"], ["payment_date", "id"])
    notice = serial_number(settle(one.withColumn("amount", whole_units(F.col("amount")))), "id")
    return {"notice": notice, "detail": detail}
