"""Joins that several reports share."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from opsreports.functions.labels import CITY_CODES, city_code
from opsreports.operators.joins import attach
from opsreports.plans.inputs import Desk


Keep = Callable[[DataFrame], DataFrame]


def as_is(df: DataFrame) -> DataFrame:
    """Default of a report's ``keep``, which is applied to the frames its results share.

    Pass ``session.settle`` or ``DataFrame.persist`` when several results are taken, so that
    the shared part is computed once.
    """
    return df


def with_patient(
    rows: DataFrame, desk: Desk, patient_columns=(), customer_columns=(), how: str = "inner", known: str | None = None
) -> DataFrame:
    """Case rows with their patient and customer; needs patientId, adds patientCityId and customerId.

    ``known`` names a column that tells, in a left join, whether there is such a customer.
    """
    columns = {"customerId": "customerId", "cityId": "patientCityId", **{c: c for c in patient_columns}}
    rows = attach(rows, desk["patient_profile"], {"patientId": "id"}, columns, how)
    wanted = {c: c for c in customer_columns}
    if known is None:
        return attach(rows, desk["customer_profile"], {"customerId": "customerId"}, wanted, how)
    rows = attach(rows, desk["customer_profile"], {"customerId": "customerId"}, {"customerId": known, **wanted}, how)
    return rows.withColumn(known, F.col(known).isNotNull())


def with_case_city(
    rows: DataFrame, desk: Desk, codes: Mapping[str, str] = CITY_CODES, default: str = "No City"
) -> DataFrame:
    """Adds city from cityId (the case) or else patientCityId, coded."""
    rows = attach(rows, desk["city"], {"cityId": "id"}, {"cityName": "_caseCity"})
    rows = attach(rows, desk["city"], {"patientCityId": "id"}, {"cityName": "_patientCity"})
    city = city_code(F.col("_caseCity"), F.col("_patientCity"), codes=codes, default=default)
    return rows.withColumn("city", city).drop("_caseCity", "_patientCity")


def with_facility_city(rows: DataFrame, desk: Desk, keep: Sequence[str] = ("aliasName",)) -> DataFrame:
    """Adds the hospital's columns, its facilityCityId and its coded city; needs hospitalId."""
    columns = {"cityId": "facilityCityId", **{c: c for c in keep}}
    rows = attach(rows, desk["facility"], {"hospitalId": "facilityId"}, columns)
    rows = attach(rows, desk["city"], {"facilityCityId": "id"}, {"cityName": "_name"})
    return rows.withColumn("city", city_code(F.col("_name"))).drop("_name")
