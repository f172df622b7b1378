"""The reports' input tables as projections of the driver's tables.

Each table is one whole source table with its columns as expressions both SQL dialects share.
``desk`` gives them as DataFrames, ``with_desk`` as the WITH clause of the twin query.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from opsreports.checks.registry import Tables

HOURS = "INTERVAL 1 HOUR * CAST({} AS INT)"
DAYS = "INTERVAL 1 DAY * CAST({} AS INT)"
NUMBER = "'91' || lpad(CAST({} AS STRING), 10, '0')"
AGENT = "'agent' || CAST({} AS STRING) || '@desk.example'"
SOURCE = (
    "CASE {} WHEN 0 THEN 'Exotel' WHEN 1 THEN 'Whatsapp' WHEN 2 THEN 'Website Submit' "
    "WHEN 3 THEN 'Offline channel' ELSE 'Walk in' END"
)
MODE = (
    "CASE {} WHEN 0 THEN 'WALLET' WHEN 1 THEN 'RAZOR_PAY' WHEN 2 THEN 'UPI' WHEN 3 THEN 'CASH' "
    "WHEN 4 THEN 'INSURANCE' WHEN 5 THEN 'ZERO_FEE' WHEN 6 THEN 'CHEQUE' ELSE 'KTKSWIPE' END"
)

DESK: dict[str, tuple[str, dict[str, str]]] = {
    "appointment": ("orders", {
        "id": "o_orderkey",
        "leadId": "o_orderkey - o_orderkey % 2",
        "hospitalId": "o_orderkey % 100",
        "doctorId": "o_orderkey % 70",
        "appointmentDate": f"o_orderdate + {HOURS.format('o_orderkey % 10')}",
        "createdOn": f"o_orderdate - {HOURS.format('o_orderkey % 5')}",
        "consultationFee": "CAST(CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE floor(o_totalprice / 1000) END AS DECIMAL(18,2))",
        "consultationType": "CASE o_orderkey % 4 WHEN 0 THEN 'Online Consultation' WHEN 1 THEN 'Consultation' "
                            "WHEN 2 THEN 'DIAGNOSTICS' ELSE 'Diagnostics' END",
        "doctorConsultationStatus": "CASE o_orderstatus WHEN 'F' THEN '3' WHEN 'O' THEN '1' ELSE '4' END",
        "appointmentCreationType": "CASE o_orderkey % 3 WHEN 0 THEN 'NEW_APPOINTMENT' "
                                   "WHEN 1 THEN 'RESCHEDULED_APPOINTMENT' ELSE 'FOLLOWUP_APPOINTMENT' END",
        "user": AGENT.format("o_orderkey % 120"),
        "originConsultationId": "CASE WHEN o_orderkey % 4 = 2 THEN CAST(o_orderkey - 1 AS STRING) "
                                "WHEN o_orderkey % 4 = 3 THEN CAST(o_orderkey - 2 AS STRING) END",
        "additionalDetails": "CASE WHEN o_orderkey % 3 = 1 THEN "
                             "'{\"isDiagnosticsTestRecommended\": \"YES\", \"hospitalPriceBills\": \"B12\"}' ELSE '{}' END",
    }),
    "patient_case": ("orders", {
        "caseId": "o_orderkey",
        "patientId": "o_custkey",
        "cityId": "CAST(CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 6 END AS INT)",
        "specialityId": "o_orderkey % 7",
        "patientLeadStatus": "CAST(o_orderkey % 8 AS STRING)",
        "followUpdate": "CAST(date_trunc('month', o_orderdate) + INTERVAL 16 DAY AS DATE)",
        "followUpTime": "CASE o_orderkey % 7 WHEN 0 THEN '9:00-10:00' WHEN 1 THEN '13:00-14:00' WHEN 2 THEN '900-1000' "
                        "WHEN 3 THEN '1700-1800' WHEN 4 THEN '9AM-10AM' WHEN 5 THEN 'later' END",
        "symptoms": "o_orderpriority",
        "assignedTo": "CASE o_orderkey % 5 WHEN 0 THEN 'queue@desk.example' WHEN 1 THEN 'system@desk.example' "
                      f"ELSE {AGENT.format('o_orderkey % 10')} END",
        "createdOn": f"o_orderdate + {HOURS.format('o_orderkey % 24')}",
        "caseType": "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Diagnostics' ELSE 'OPD' END",
        "leadSource": SOURCE.format("o_orderkey % 5"),
        "reason": "CASE o_orderkey % 9 WHEN 0 THEN 'Confirmation Pending' WHEN 1 THEN 'No answer' WHEN 2 THEN NULL "
                  "WHEN 3 THEN 'Confirmation Pending' ELSE 'Call later' END",
        "tenantName": "CASE WHEN o_orderkey % 11 = 0 THEN 'OTHER' ELSE 'MAIN' END",
    }),
    "patient_case_audit": ("orders", {
        "caseId": "o_orderkey - o_orderkey % 2",
        "patientLeadStatus": "CAST(o_orderkey % 8 AS STRING)",
        "followUpdate": "CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END",
    }),
    "patient_profile": ("customer", {
        "id": "c_custkey", "customerId": "c_custkey", "patientName": "c_name",
        "cityId": "CAST(CASE WHEN c_custkey % 5 <> 0 THEN c_nationkey END AS INT)",
        "createdOn": f"CAST('1998-06-01' AS TIMESTAMP_NTZ) + {HOURS.format('c_custkey % 720')}",
    }),
    "customer_profile": ("customer", {
        "customerId": "c_custkey", "customerName": "c_name",
        "customerEmail": "lower(c_name) || '@mail.example'", "customerNumber": NUMBER.format("c_custkey"),
        "leadSource": SOURCE.format("c_custkey % 5"),
    }),
    "city": ("nation", {
        "id": "CAST(n_nationkey AS INT)",
        "cityName": "CASE n_nationkey WHEN 0 THEN 'Chandigarh' WHEN 1 THEN 'Bangalore' WHEN 2 THEN 'Hyderabad' "
                    "WHEN 3 THEN 'Jaipur' WHEN 4 THEN 'NCR' ELSE n_name END",
    }),
    "facility": ("supplier", {
        "facilityId": "s_suppkey", "cityId": "CAST(s_nationkey % 6 AS INT)", "aliasName": "s_name",
    }),
    "doctor": ("supplier", {"doctorId": "s_suppkey", "name": "'Dr ' || s_name"}),
    "speciality": ("region", {"id": "CAST(r_regionkey AS BIGINT)", "specialityName": "r_name"}),
    "payment_link": ("orders", {
        "id": "o_orderkey", "entityId": "o_orderkey - o_orderkey % 2",
        "entityType": "CASE WHEN o_orderkey % 5 = 0 THEN 'CASE' ELSE 'APPOINTMENT' END",
        "paymentMode": MODE.format("o_orderkey % 8"),
        "status": "CASE WHEN o_orderkey % 3 = 0 THEN 'CANCELLED' ELSE 'PAID' END",
    }),
    "card": ("customer", {
        "cardId": "c_custkey", "customerId": "c_custkey",
        "activationDate": f"CAST('1998-05-01' AS TIMESTAMP_NTZ) + {DAYS.format('c_custkey % 60')}",
    }),
    "card_transaction": ("orders", {
        "entityId": "o_orderkey", "entityType": "'APPOINTMENT'",
        "transactionType": "CASE WHEN o_orderkey % 20 = 0 THEN 'DEBIT' ELSE 'CREDIT' END",
        "transactionStatus": "'CONFIRMED'",
    }),
    "card_payment": ("orders", {
        "id": "o_orderkey", "cardId": "o_custkey", "paymentMode": MODE.format("o_orderkey % 9"),
        "paymentStatus": "CASE o_orderstatus WHEN 'F' THEN 'PAID' ELSE 'OPEN' END",
        "createdOn": f"o_orderdate + {HOURS.format('o_orderkey % 24')}",
    }),
    "surgery": ("orders", {
        "id": "o_orderkey", "caseId": "o_orderkey", "hospitalId": "o_orderkey % 100",
        "surgeryStatus": "CASE o_orderstatus WHEN 'F' THEN 'ADMISSION_DONE' ELSE 'PLANNED' END",
        "admissionDate": f"o_orderdate + {HOURS.format('o_orderkey % 24')}", "createdOn": "o_orderdate",
    }),
    "surgery_payment": ("orders", {
        "id": "o_orderkey", "patientSurgeryId": "o_orderkey - o_orderkey % 3", "paymentMode": MODE.format("o_orderkey % 8"),
        "paymentStatus": "CASE o_orderstatus WHEN 'F' THEN 'PAID' ELSE 'OPEN' END",
        "createdOn": f"o_orderdate + {HOURS.format('o_orderkey % 22')}",
    }),
    "lead_comment": ("orders", {
        "commentId": "o_orderkey", "leadId": "o_orderkey - o_orderkey % 3",
        "leadType": "CASE WHEN o_custkey % 2 = 0 THEN 'CASE' ELSE 'APPOINTMENT' END",
        "commentType": "CASE o_custkey % 4 WHEN 0 THEN 'CREATION' WHEN 1 THEN 'APPOINTMENT_DONE' ELSE 'NOTE' END",
        "user": AGENT.format("o_orderkey % 120"), "text": "o_orderpriority",
    }),
    "appointment_test": ("lineitem", {"appointmentId": "l_orderkey", "testId": "l_partkey"}),
    "test": ("part", {"id": "p_partkey", "name": "p_name"}),
    "ledger": ("orders", {
        "entryId": "o_orderkey", "customerId": "o_custkey",
        "amount": "CAST(floor(o_totalprice * CASE o_orderstatus WHEN 'O' THEN 33 ELSE 100 END) AS BIGINT)",
        "validTill": f"CAST(o_orderdate + {DAYS.format('700 + (o_orderkey % 3) * 40')} AS DATE)",
        "createdOn": f"o_orderdate + {HOURS.format('o_orderkey % 24')}",
        "transactionType": "CASE o_orderstatus WHEN 'F' THEN 'CREDITED' WHEN 'O' THEN 'DEBITED' ELSE 'OTHER' END",
    }),
    "outbound_queue": ("orders", {
        "queueId": "o_orderkey", "cityId": "CAST(3 + o_orderkey % 3 AS INT)",
        "status": "CASE WHEN o_orderkey % 4 = 0 THEN 'DONE' ELSE 'ENQUEUED' END",
        "scheduledOn": "CAST(date_trunc('month', o_orderdate) AS TIMESTAMP_NTZ) + INTERVAL 16 DAY + " + HOURS.format("o_orderkey % 24"),
    }),
    "agent_source": ("nation", {
        "id": "CAST(n_nationkey AS BIGINT)", "cityId": "CAST(n_nationkey AS INT)", "source": "'OUTBOUND'",
        "emailId": " || ',' || ".join(AGENT.format(f"(n_nationkey + {n})") for n in (0, 20, 50)),
    }),
    "support_staff": ("supplier", {
        "name": "s_name", "email": AGENT.format("s_suppkey"), "cityId": "CAST(s_nationkey AS INT)",
    }),
    "marketing_channel": ("part", {
        "id": "p_partkey", "channelName": "CASE WHEN p_partkey % 5 <> 0 THEN p_brand ELSE '' END",
    }),
    "patient_channel": ("customer", {
        "id": "c_custkey", "patientProfileId": "c_custkey",
        "marketingChannelId": "CASE WHEN c_custkey % 3 <> 0 THEN c_custkey % 1500 END",
    }),
    "campaign": ("orders", {
        "rowNo": "o_orderkey",
        "eventLabel": "CASE WHEN o_orderkey % 10 = 0 THEN '(not set)' ELSE CAST(o_orderkey - o_orderkey % 3 AS STRING) END",
        "campaign": "'campaign ' || CAST(o_orderkey % 17 AS STRING)",
    }),
    "call_summary": ("events", {
        "call_created_on": "ts", "city": "CASE WHEN user_id % 4 = 0 THEN 'Jaipur' ELSE 'Hyderabad' END",
        "personnelType": "CASE WHEN user_id % 9 = 0 THEN 'AGENT' ELSE 'SUPPORT' END",
        "finalDetailedStatus": "event_type",
        "leg_1_status": "CASE event_id % 6 WHEN 0 THEN 'N/A' WHEN 1 THEN 'busy' WHEN 2 THEN 'completed' "
                        "WHEN 3 THEN 'no-answer' WHEN 4 THEN 'None' ELSE 'failed' END",
        "noSent": "CASE event_id % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'Not Requested' ELSE 'False' END",
        "leg1Agent_email": AGENT.format("user_id"),
        "leg1Status": "CASE event_id % 4 WHEN 0 THEN 'busy' WHEN 1 THEN 'completed' WHEN 2 THEN 'failed' ELSE 'no-answer' END",
        "leg2Agent_email": f"CASE WHEN event_id % 3 = 0 THEN {AGENT.format('(user_id + 1)')} END",
        "leg2Status": "CASE WHEN event_id % 3 = 0 THEN 'busy' END",
        "leg3Agent_email": f"CASE WHEN event_id % 5 = 0 THEN {AGENT.format('(user_id + 2)')} END",
        "leg3Status": "CASE WHEN event_id % 5 = 0 THEN 'completed' END",
    }),
    "weekly_visit": ("orders", {
        "caseId": "o_orderkey", "agentAction": AGENT.format("o_orderkey % 120"),
        "apptType": "CASE WHEN o_orderkey % 3 = 0 THEN 'Online Consultation' ELSE 'Consultation' END",
        "city": "o_orderpriority", "sequence": "CAST(o_orderkey % 4 AS INT)",
    }),
    "target": ("supplier", {
        "email": AGENT.format("s_suppkey"), "reportingTl": "'tl' || CAST(s_suppkey % 4 AS STRING)",
        "newTarget": "CASE WHEN s_suppkey % 9 <> 0 THEN s_suppkey % 50 + 40 END", "newCovTarget": "s_suppkey % 10",
    }),
    "facility_payment": ("orders", {
        "id": "o_orderkey", "amount": "CAST(floor(o_totalprice * 100) AS BIGINT)",
        "paymentStatus": "CASE o_orderstatus WHEN 'F' THEN 'processed' ELSE 'open' END",
        "entityId": "o_orderkey - o_orderkey % 3",
        "entityType": "CASE WHEN o_orderkey % 4 = 0 THEN 'SURGERY' ELSE 'APPOINTMENT' END",
        "createdOn": f"o_orderdate + {HOURS.format('o_orderkey % 24')}", "utr": "'U' || CAST(o_orderkey AS STRING)",
    }),
    "message": ("orders", {
        "uuid": "CAST(o_orderkey AS STRING)",
        "fromId": f"CASE WHEN o_orderkey % 13 = 0 THEN {NUMBER.format('o_custkey')} ELSE 'desk' END",
        "toMessage": NUMBER.format("o_custkey"),
        "message": "CASE o_orderkey % 4 WHEN 0 THEN 'Hi, please tell us about your visit' "
                   "WHEN 1 THEN 'Thank you! Rate us 5 stars' WHEN 2 THEN 'Sorry to hear that' ELSE 'hello' END",
        "status": "o_orderstatus", "createdOn": f"o_orderdate + {HOURS.format('o_orderkey % 24')}",
    }),
    "staff": ("supplier", {
        "personnelId": "s_suppkey", "email": AGENT.format("s_suppkey"),
        "personnelType": "CASE WHEN s_suppkey % 2 = 0 THEN 'AGENT' ELSE 'SUPPORT' END",
        "cityId": "CAST(CASE WHEN s_suppkey % 8 <> 0 THEN s_nationkey END AS INT)",
        "isAvailable": "CAST(CASE WHEN s_suppkey % 5 = 0 THEN 0 ELSE 1 END AS INT)",
        "hasLeft": "CAST(CASE WHEN s_suppkey % 7 = 0 THEN 1 ELSE 0 END AS INT)",
    }),
    "staff_facility": ("lineitem", {
        "personnelId": "l_suppkey", "facilityId": "l_partkey % 100",
        "isValid": "CAST(CASE l_linestatus WHEN 'F' THEN 1 ELSE 0 END AS INT)",
        "tenantName": "CASE l_returnflag WHEN 'R' THEN 'OTHER' ELSE 'MAIN' END", "mappingType": "'AGENT'",
    }),
    "followup_landed": ("events", {
        "email": AGENT.format("user_id"),
        "body": "CASE WHEN event_id % 4 = 0 THEN '[]' ELSE '[{\"caseId\": ' || CAST(event_id AS STRING) || "
                "', \"patientId\": 7, \"entityId\": 1, \"entityType\": \"CASE\", \"createdOn\": ' || "
                "CAST(1704067200000 + event_id * 259000 AS STRING) || '}]' END",
    }),
    "survey_consultation": ("events", {
        "submittedAt": "DAY_FIRST(ts)",
        "caseid": "CASE WHEN event_id % 10 = 0 THEN 'none' ELSE CAST(event_id AS STRING) END",
        "recommend": "event_type", "suggestions": "props",
    }),
    "survey_procedure": ("events", {
        "submittedAt": "DAY_FIRST(ts)",
        "caseid": "CASE WHEN event_id % 5 = 0 THEN 'none' ELSE CAST(event_id AS STRING) END",
        "recommend": "event_type", "suggestions": "props",
    }),
    "visit": ("orders", {
        "patientId": "o_custkey", "apptId": "o_orderkey", "caseid": "o_orderkey - o_orderkey % 2",
        "number": NUMBER.format("o_orderkey"), "appointmentDate": "CAST(o_orderdate AS DATE)",
        "consultationType": "CASE o_orderkey % 3 WHEN 0 THEN 'Online Consultation' WHEN 1 THEN 'Consultation' ELSE 'Diagnostics' END",
        "appointmentStatus": "CASE o_orderstatus WHEN 'F' THEN 'DONE' ELSE 'OPEN' END",
        "isDiagnosticsTestRecommended": "CASE WHEN o_custkey % 4 = 0 THEN 'NO' WHEN o_orderkey % 2 = 0 THEN 'YES' ELSE 'NO' END",
    }),
}

DAY_FIRST = re.compile(r"DAY_FIRST\((\w+)\)")


class DeskTables(dict):
    """The input tables, made when asked for."""

    def __init__(self, tables: Tables):
        super().__init__()
        self._tables = tables

    def __missing__(self, name: str) -> DataFrame:
        source, columns = DESK[name]
        rows = getattr(self._tables, source)
        spell = lambda e: DAY_FIRST.sub(r"date_format(\1, 'dd/MM/yyyy HH:mm:ss')", e)
        self[name] = rows.selectExpr(*[f"{spell(e)} AS {c}" for c, e in columns.items()])
        return self[name]


def with_desk(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` for the named tables."""

    def one(name: str) -> str:
        source, columns = DESK[name]
        spell = lambda e: DAY_FIRST.sub(r"strftime(\1, '%d/%m/%Y %H:%M:%S')", e)
        listed = ", ".join(f'{spell(e)} AS "{c}"' for c, e in columns.items()).replace("TIMESTAMP_NTZ", "TIMESTAMP")
        return f"{name} AS (SELECT {listed} FROM {source})"

    return "WITH RECURSIVE " + ", ".join(one(n) for n in names)
