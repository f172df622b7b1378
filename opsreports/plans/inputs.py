"""Declared schemas of the tables the reports read.

Timestamps are UTC without a zone. Codes are text and compared as text. A report needs only
the tables it names.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

Desk = Mapping[str, DataFrame]

SCHEMAS = {
    "appointment": """id bigint, leadId bigint, hospitalId bigint, doctorId bigint, appointmentDate timestamp_ntz,
        createdOn timestamp_ntz, consultationFee decimal(18,2), consultationType string,
        doctorConsultationStatus string, appointmentCreationType string, user string, originConsultationId string,
        additionalDetails string""",
    "patient_case": """caseId bigint, patientId bigint, cityId int, specialityId bigint, patientLeadStatus string,
        followUpdate date, followUpTime string, symptoms string, assignedTo string, createdOn timestamp_ntz,
        caseType string, leadSource string, reason string, tenantName string""",
    "patient_case_audit": "caseId bigint, patientLeadStatus string, followUpdate date",
    "patient_profile": "id bigint, customerId bigint, patientName string, cityId int, createdOn timestamp_ntz",
    "customer_profile": """customerId bigint, customerName string, customerEmail string, customerNumber string,
        leadSource string""",
    "city": "id int, cityName string",
    "facility": "facilityId bigint, cityId int, aliasName string",
    "doctor": "doctorId bigint, name string",
    "speciality": "id bigint, specialityName string",
    "payment_link": "id bigint, entityId bigint, entityType string, paymentMode string, status string",
    "card": "cardId bigint, customerId bigint, activationDate timestamp_ntz",
    "card_transaction": "entityId bigint, entityType string, transactionType string, transactionStatus string",
    "card_payment": """id bigint, cardId bigint, paymentMode string, paymentStatus string,
        createdOn timestamp_ntz""",
    "surgery": """id bigint, caseId bigint, hospitalId bigint, surgeryStatus string, admissionDate timestamp_ntz,
        createdOn timestamp_ntz""",
    "surgery_payment": """id bigint, patientSurgeryId bigint, paymentMode string, paymentStatus string,
        createdOn timestamp_ntz""",
    "lead_comment": """commentId bigint, leadId bigint, leadType string, commentType string, user string,
        text string""",
    "appointment_test": "appointmentId bigint, testId bigint",
    "test": "id bigint, name string",
    "ledger": """entryId bigint, customerId bigint, amount bigint, validTill date, createdOn timestamp_ntz,
        transactionType string""",
    "outbound_queue": "queueId bigint, cityId int, status string, scheduledOn timestamp_ntz",
    "agent_source": "id bigint, cityId int, source string, emailId string",
    "support_staff": "name string, email string, cityId int",
    "marketing_channel": "id bigint, channelName string",
    "patient_channel": "id bigint, patientProfileId bigint, marketingChannelId bigint",
    "campaign": "rowNo bigint, eventLabel string, campaign string",
    "call_summary": """call_created_on timestamp_ntz, city string, personnelType string, finalDetailedStatus string,
        leg_1_status string, noSent string, leg1Agent_email string, leg1Status string, leg2Agent_email string,
        leg2Status string, leg3Agent_email string, leg3Status string""",
    "weekly_visit": "caseId bigint, agentAction string, apptType string, city string, sequence int",
    "target": "email string, reportingTl string, newTarget bigint, newCovTarget bigint",
    "facility_payment": """id bigint, amount bigint, paymentStatus string, entityId bigint, entityType string,
        createdOn timestamp_ntz, utr string""",
    "message": """uuid string, fromId string, toMessage string, message string, status string,
        createdOn timestamp_ntz""",
    "staff": "personnelId bigint, email string, personnelType string, cityId int, isAvailable int, hasLeft int",
    "staff_facility": """personnelId bigint, facilityId bigint, isValid int, tenantName string,
        mappingType string""",
    "followup_landed": "email string, body string",
    "survey_consultation": "submittedAt string, caseid string, recommend string, suggestions string",
    "survey_procedure": "submittedAt string, caseid string, recommend string, suggestions string",
    "visit": """patientId bigint, apptId bigint, caseid bigint, number string, appointmentDate date,
        consultationType string, appointmentStatus string, isDiagnosticsTestRecommended string""",
}


def empty(spark: SparkSession, table: str) -> DataFrame:
    """A table without rows, in its declared schema."""
    return spark.createDataFrame([], SCHEMAS[table])
