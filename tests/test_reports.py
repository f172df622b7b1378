"""Reports on hand-made rows: the decisions the SQL twins can't show, and empty inputs."""

import datetime as dt
from collections import defaultdict

import pytest

from opsreports.functions.times import Window
from opsreports.plans import diagnostics, leads, money, queues, visits
from opsreports.plans.inputs import SCHEMAS, empty
from opsreports.session import settle

DAY = dt.date(2024, 6, 15)
NOON = dt.datetime(2024, 6, 15, 12, 0)
QUEUE = {"queue": "queue@desk.example", "system_user": "system@desk.example"}


class Desk(dict):
    """Input tables from dicts of the columns that matter; tables not given are empty."""

    def __init__(self, spark, **tables):
        super().__init__()
        self.spark, self.rows = spark, tables

    def __missing__(self, name):
        frame = empty(self.spark, name)
        rows = self.rows.get(name, [])
        if rows:
            names = frame.columns
            frame = self.spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], frame.schema)
        self[name] = frame
        return frame


REPORTS = {
    "consultation_fees": lambda d: money.consultation_fees(d, DAY),
    "payment_mix": lambda d: money.payment_mix(d, DAY),
    "diagnostic_cases": lambda d: diagnostics.diagnostic_cases(d, DAY),
    "feedback": lambda d: visits.feedback(d, NOON, "https://desk.example"),
    "diagnostic_week": lambda d: diagnostics.diagnostic_week(d, Window("week", DAY, DAY)),
    "followup_queue_today": lambda d: queues.followup_queue_today(d, NOON, **QUEUE),
    "followup_queue_next_day": lambda d: queues.followup_queue_next_day(d, DAY, **QUEUE),
    "wallet_balances": lambda d: money.wallet_balances(d, DAY),
    "offline_followup": lambda d: leads.offline_followup(d, DAY),
    "channel_tracking": lambda d: leads.channel_tracking(d, DAY),
    "call_view": lambda d: visits.call_view(d, NOON, "Hyderabad"),
    "incentive_by_region": lambda d: leads.incentive_by_region(d),
    "payment_notice": lambda d: money.payment_notice(d, NOON, "Hospital"),
    "surgery_tracker": lambda d: visits.surgery_tracker(d, d["surgery"].select("id"), NOON),
    "advised_then_visited": lambda d: diagnostics.advised_then_visited(d),
    "satisfaction_messages": lambda d: leads.satisfaction_messages(d, DAY, "q", "y", "n"),
    "staff_availability": lambda d: visits.staff_availability(d),
    "home_pickup": lambda d: visits.home_pickup(d, 1),
    "followup_ageing": lambda d: queues.followup_ageing(d, NOON),
}


@pytest.mark.parametrize("name", REPORTS)
def test_empty_inputs_give_typed_frames(spark, name):
    for key, frame in REPORTS[name](Desk(spark)).items():
        rows = frame.collect()
        assert frame.columns
        if (name, key) == ("channel_tracking", "coverage"):
            assert len(rows) == 15 and all(r["leads"] == 0 for r in rows)
        elif (name, key) == ("diagnostic_cases", "summary"):
            assert len(rows) == 7 and all(r["yesterday"] == 0 for r in rows)
        elif (name, key) == ("feedback", "cities"):
            assert [r[0] for r in rows] == ["NOCITY"]
        else:
            assert rows == []


@pytest.mark.parametrize("name,run", [
    ("fees", lambda d, **k: money.consultation_fees(d, DAY, **k)),
    ("cases", lambda d, **k: diagnostics.diagnostic_cases(d, DAY, **k)),
    ("calls", lambda d, **k: visits.call_view(d, NOON, "Hyderabad", **k)),
])
def test_settled_shared_frames_change_nothing(spark, name, run):
    desk = fee_desk(spark, (1, 1, dt.date(2024, 6, 14), "50"), (2, 2, dt.date(2024, 6, 3), "150"))
    desk.rows["call_summary"] = [{"call_created_on": NOON - dt.timedelta(minutes=25), "city": "Hyderabad", "personnelType": "X",
                                  "finalDetailedStatus": "s", "leg1Agent_email": "a", "leg1Status": "busy"}]
    plain, kept = run(desk), run(desk, keep=settle)
    for key in plain:
        assert sorted(map(repr, plain[key].collect())) == sorted(map(repr, kept[key].collect()))


def visit(i, patient, day, fee, **more):
    return [
        {"id": i, "leadId": i, "hospitalId": 1, "appointmentDate": day, "createdOn": day, "consultationFee": fee,
         "doctorConsultationStatus": "3", "appointmentCreationType": "NEW_APPOINTMENT", "user": "a@desk.example", **more},
        {"caseId": i, "patientId": patient, "leadSource": "Exotel", "caseType": "OPD"},
    ]


def fee_desk(spark, *pairs):
    from decimal import Decimal

    made = [visit(i, p, dt.datetime.combine(day, dt.time(9)), None if fee is None else Decimal(fee)) for i, p, day, fee in pairs]
    return Desk(
        spark, appointment=[m[0] for m in made], patient_case=[m[1] for m in made],
        patient_profile=[{"id": p, "customerId": p} for p in {q[1] for q in pairs}],
        support_staff=[{"email": "a@desk.example"}], facility=[{"facilityId": 1, "cityId": 1}],
        city=[{"id": 1, "cityName": "Chandigarh"}],
    )


def test_month_to_date_runs_from_the_first_day_and_weeks_cross_new_year(spark):
    as_of = dt.date(2024, 1, 3)
    desk = fee_desk(
        spark, (1, 1, dt.date(2024, 1, 1), "50"), (2, 2, dt.date(2024, 1, 2), "150"), (3, 3, dt.date(2023, 12, 31), "150"),
        (4, 4, dt.date(2023, 12, 25), "150"), (5, 5, dt.date(2024, 1, 2), None), (6, 1, dt.date(2024, 1, 2), "400"),
    )
    out = money.consultation_fees(desk, as_of)
    daily = {r["bucket"]: (r["d1"], r["d2"], r["d3"], r["mtd"]) for r in out["daily"].collect()}
    assert daily["1-100"] == (0, 1, 0, 1) and daily["101-200"] == (1, 0, 1, 1) and daily["Total"] == (1, 1, 1, 2)
    assert daily["301-400"] == (0, 0, 0, 0)  # a second visit of patient 1
    weekly = {r["bucket"]: (r["w0_n"], r["w1_n"], r["w1_avg"], r["w0_n_pct"]) for r in out["weekly"].collect()}
    assert weekly["101-200"] == (1, 2, 150.0, 50.0) and weekly["Total"][:3] == (2, 2, 150.0)


def test_card_payment_counts_per_family_member_or_once(spark):
    desk = Desk(
        spark, card_payment=[{"id": 1, "cardId": 5, "paymentMode": "UPI", "paymentStatus": "PAID", "createdOn": dt.datetime(2024, 6, 13)}],
        card=[{"cardId": 5, "customerId": 9}], customer_profile=[{"customerId": 9}],
        patient_profile=[{"id": 1, "customerId": 9, "cityId": 1}, {"id": 2, "customerId": 9, "cityId": 1}],
        city=[{"id": 1, "cityName": "Bangalore"}],
    )
    for once, n in ((False, 2), (True, 1)):
        mix = money.payment_mix(desk, DAY, once_per_card_payment=once)["mix"].collect()
        cells = {(r["service"], r["window"]): (r["UPI"], r["UPI_pct"]) for r in mix}
        assert cells["Loyalty", "month_to_date"] == (n, 100.0) and cells["IPD", "this_week"] == (0, 0.0)
        assert cells["Loyalty", "last_week"] == (0, 0.0) and cells["Loyalty", "this_week"] == (n, 100.0)


def test_unreadable_slots_count_in_the_total_only(spark):
    case = {"patientId": 1, "cityId": 3, "patientLeadStatus": "1", "followUpdate": DAY, "tenantName": "MAIN", "reason": None}
    desk = Desk(
        spark, patient_case=[
            {**case, "caseId": 1, "followUpTime": "9:00-10:00", "assignedTo": "queue@desk.example"},
            {**case, "caseId": 2, "followUpTime": "junk", "assignedTo": "x@desk.example"},
            {**case, "caseId": 3, "followUpTime": None, "assignedTo": "x@desk.example"},
            {**case, "caseId": 4, "followUpTime": "9AM-10AM", "assignedTo": "system@desk.example"},
        ],
        patient_profile=[{"id": 1, "customerId": 1}], customer_profile=[{"customerId": 1}], city=[{"id": 3, "cityName": "Jaipur"}],
        outbound_queue=[{"queueId": 1, "cityId": 3, "status": "ENQUEUED", "scheduledOn": dt.datetime(2024, 6, 15, 9, 30)},
                        {"queueId": 2, "cityId": 3, "status": "ENQUEUED", "scheduledOn": dt.datetime(2024, 6, 15, 20, 0)}],
    )
    rows = queues.followup_queue_today(desk, NOON, **QUEUE)["slots"].collect()
    assert [(r["slot"], r["queued"], r["with_agent"], r["scheduled"], r["agents_needed"]) for r in rows] == [
        ("9AM-10AM", 1, 0, 1, 0.04), ("None", 0, 1, 0, 0.04), ("Total", 1, 2, 1, 0.12)]


def test_agents_are_matched_by_their_city_id(spark):
    desk = Desk(
        spark, agent_source=[{"id": 1, "cityId": 4, "source": "OUTBOUND", "emailId": "a,b"}, {"id": 2, "cityId": 3, "source": "OUTBOUND", "emailId": "c"}],
        support_staff=[{"email": "a", "cityId": 4}, {"email": "b", "cityId": 3}, {"email": "c", "cityId": 3}],
        city=[{"id": 3, "cityName": "Jaipur"}, {"id": 4, "cityName": "NCR"}],
        outbound_queue=[{"queueId": 1, "cityId": 4, "status": "ENQUEUED", "scheduledOn": NOON - dt.timedelta(minutes=1)},
                        {"queueId": 2, "cityId": 4, "status": "ENQUEUED", "scheduledOn": NOON}],
    )
    out = queues.followup_queue_today(desk, NOON, **QUEUE)
    agents = {r["city"]: r for r in out["agents"].collect()}
    assert (agents["NCR"]["members"], agents["NCR"]["other_city_members"], agents["NCR"]["queue_size"]) == (2, 1, 1)
    assert [tuple(r) for r in out["names"].collect()] == [(4, 0, "b")]
    assert (agents["Jaipur"]["members"], agents["Jaipur"]["other_city_members"], agents["Jaipur"]["queue_size"]) == (1, 0, 0)


def test_feedback_of_both_surveys(spark):
    desk = Desk(
        spark,
        survey_consultation=[{"submittedAt": "15/06/2024 11:30:00", "caseid": "77", "recommend": "9"},
                             {"submittedAt": "15/06/2024 11:59:59", "caseid": "077"},
                             {"submittedAt": "15/06/2024 12:00:00", "caseid": "77"}, {"submittedAt": "bad", "caseid": "77"}],
        survey_procedure=[{"submittedAt": "15/06/2024 11:00:00", "caseid": "5"}],
        appointment=[{"id": 77, "leadId": 5}], patient_case=[{"caseId": 5, "patientId": 1, "cityId": 1}],
        patient_profile=[{"id": 1, "customerId": 2}], customer_profile=[{"customerId": 2, "customerNumber": "99"}],
        city=[{"id": 1, "cityName": "Bangalore"}],
    )
    out = defaultdict(list)
    for r in visits.feedback(desk, NOON, "https://desk.example")["answers"].collect():
        out[r["survey"]].append((r["city"], r["answerId"], r["submittedAt"], r["customerNumber"], r["url"]))
    url = "https://desk.example/patient/1/case/5"
    assert sorted(out["survey_consultation"]) == [
        ("BLR", "77", "15/06/2024 17:00:00", "99", url), ("NOCITY", "077", "15/06/2024 17:29:59", "", "")]
    assert out["survey_procedure"] == [("BLR", "5", "15/06/2024 16:30:00", "99", url)]


def test_payment_notice_window_and_one_row_per_appointment(spark):
    local = dt.datetime(2024, 6, 15, 12, 0)
    stored = local - dt.timedelta(hours=5, minutes=30)
    pay = {"amount": 12345, "paymentStatus": "processed", "entityType": "APPOINTMENT", "entityId": 1}
    desk = Desk(
        spark, facility_payment=[
            {**pay, "id": 1, "createdOn": stored - dt.timedelta(minutes=2)}, {**pay, "id": 2, "createdOn": stored - dt.timedelta(seconds=90)},
            {**pay, "id": 3, "createdOn": stored}, {**pay, "id": 4, "entityId": 2, "createdOn": stored}],
        appointment=[{"id": i, "leadId": 1, "hospitalId": 1, "doctorConsultationStatus": "3"} for i in (1, 2)],
        facility=[{"facilityId": 1, "aliasName": "H"}], patient_case=[{"caseId": 1, "patientId": 1}],
        patient_profile=[{"id": 1, "customerId": 1}], customer_profile=[{"customerId": 1}],
    )
    rows = money.payment_notice(desk, local, "H")["notice"].orderBy("serial").collect()
    assert [(r["serial"], r["id"], r["appId"], r["amount"]) for r in rows] == [(1, 2, 1, 123), (2, 4, 2, 123)]


def test_agent_cases_are_left_out_of_the_diagnostic_summary(spark):
    case = {"caseType": "Diagnostics", "leadSource": "Exotel", "tenantName": "MAIN", "patientLeadStatus": "1"}
    desk = Desk(
        spark, patient_case=[{**case, "caseId": 1, "createdOn": dt.datetime(2024, 6, 13, 18, 30), "reason": "r"},
                             {**case, "caseId": 2, "createdOn": dt.datetime(2024, 6, 14), "reason": "r"},
                             {**case, "caseId": 3, "createdOn": dt.datetime(2024, 6, 1), "reason": None}],
        lead_comment=[{"commentId": 1, "leadId": 2, "leadType": "CASE", "commentType": "CREATION", "user": "m"}],
        staff=[{"personnelId": 1, "email": "m", "personnelType": "AGENT"}],
    )
    out = diagnostics.diagnostic_cases(desk, DAY)
    summary = {r["measure"]: (r["yesterday"], r["month_to_date"]) for r in out["summary"].collect()}
    assert summary["total_leads_created"] == (1, 2) and summary["followUp"] == (1, 2)
    assert [tuple(r) for r in out["followup_reasons"].collect()] == [("r", 1, 1)]


def test_second_visit_replaces_the_case_and_tests_of_the_first(spark):
    v = {"patientId": 1, "consultationType": "Consultation", "appointmentStatus": "DONE", "isDiagnosticsTestRecommended": "YES"}
    desk = Desk(
        spark, visit=[{**v, "apptId": 1, "caseid": 10, "number": "a", "appointmentDate": DAY},
                      {**v, "apptId": 2, "caseid": 11, "number": None, "appointmentDate": DAY, "isDiagnosticsTestRecommended": "NO"},
                      {**v, "patientId": 2, "apptId": 3, "caseid": 12, "number": "c", "appointmentDate": DAY}],
        appointment_test=[{"appointmentId": 2, "testId": 1}, {"appointmentId": 3, "testId": 2}], test=[{"id": 1, "name": "t1"}, {"id": 2, "name": "t2"}],
    )
    out = diagnostics.advised_then_visited(desk)
    rows = {r["patientId"]: r for r in out["pairs"].collect()}
    assert (rows[1]["caseid"], rows[1]["number"], rows[1]["nextApptId"]) == (11, None, 2)
    assert (rows[2]["caseid"], rows[2]["nextApptId"]) == (12, None)
    assert sorted(tuple(r) for r in out["tests"].collect()) == [(2, 0, "t1"), (3, 0, "t2")]


def test_every_schema_is_usable(spark):
    for name in SCHEMAS:
        assert empty(spark, name).count() == 0
