"""R: the reports on the driver's tables, each with the whole report as one SQL query."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from opsreports.checks.desk import DeskTables, with_desk
from opsreports.checks.registry import AS_OF, EVENTS_AS_OF, Tables, half_even, query
from opsreports.functions.labels import PAY_MODE_CLASSES
from opsreports.functions.times import Window, week_windows
from opsreports.plans import diagnostics, leads, money, queues, visits
from opsreports.session import fresh_dir
from opsreports.sources.readers import read_delivered

LOCAL = "+ INTERVAL '330 minutes'"
CODE = "CASE {0} WHEN 'Chandigarh' THEN 'CHD' WHEN 'Bangalore' THEN 'BLR' ELSE {0} END"
CODE_5 = (
    "CASE {0} WHEN 'Chandigarh' THEN 'CHD' WHEN 'Bangalore' THEN 'BLR' WHEN 'Jaipur' THEN 'JPR' "
    "WHEN 'Hyderabad' THEN 'HYD' ELSE {0} END"
)
CASE_CITY = "coalesce(" + CODE.format("coalesce(k.cityName, q.cityName)") + ", '{}')"
PATIENT_JOINS = """JOIN patient_profile pp ON pp.id = pc.patientId JOIN customer_profile cp ON cp.customerId = pp.customerId
       LEFT JOIN city k ON k.id = pc.cityId LEFT JOIN city q ON q.id = pp.cityId"""


def plain(df: DataFrame) -> DataFrame:
    """Dates and decimals in the types the comparison uses."""
    made = {}
    for field in df.schema.fields:
        kind, c = field.dataType.typeName(), F.col(field.name)
        if kind == "date":
            made[field.name] = F.date_format(c, "yyyy-MM-dd")
        elif kind.startswith("timestamp"):
            made[field.name] = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind == "decimal":
            made[field.name] = c.cast("double")
    return df.withColumns(made)


# R1 ------------------------------------------------------------------------------------

FEE_TABLES = (
    "appointment", "facility", "city", "patient_case", "patient_profile", "customer_profile", "payment_link", "card",
    "card_transaction", "support_staff",
)
FIRST_FEE_SQL = with_desk(*FEE_TABLES) + f""", seen AS (
       SELECT id, leadId, hospitalId, consultationFee AS fee, appointmentDate::DATE AS d, createdOn::DATE AS booked FROM appointment
         SEMI JOIN (SELECT email AS "user" FROM support_staff) USING ("user")
       WHERE doctorConsultationStatus = '3' AND appointmentCreationType IN ('NEW_APPOINTMENT', 'RESCHEDULED_APPOINTMENT')),
     owner AS (SELECT caseId AS leadId, patientId FROM patient_case
       WHERE leadSource NOT IN ('Offline channel', 'VC Model') AND caseType <> 'Diagnostics'),
     earliest AS (SELECT patientId, min(id) AS id FROM seen JOIN owner USING (leadId) GROUP BY ALL),
     link AS (SELECT entityId AS leadId, first(paymentMode ORDER BY id) AS mode FROM payment_link GROUP BY ALL),
     issue AS (SELECT pp.id AS patientId, max(activationDate)::DATE AS issued FROM card JOIN patient_profile pp USING (customerId) GROUP BY ALL),
     place AS (SELECT facilityId AS hospitalId, cityName FROM facility JOIN city ON city.id = cityId),
     debit AS (SELECT DISTINCT entityId AS id, true AS paid FROM card_transaction WHERE transactionType = 'DEBIT'),
     b AS (SELECT coalesce({CODE.format('cityName')}, 'No City') AS city, d, fee, CASE WHEN fee > 400 THEN '>400' WHEN fee > 300 THEN '301-400'
           WHEN fee > 200 THEN '201-300' WHEN fee > 100 THEN '101-200' WHEN fee <> 0 THEN '1-100' WHEN mode = 'WALLET' THEN 'WALLET'
           WHEN paid OR booked = issued THEN 'Privilege Card' WHEN fee = 0 THEN '0' ELSE '>400' END AS bucket
       FROM earliest JOIN seen USING (id) LEFT JOIN place USING (hospitalId) LEFT JOIN link USING (leadId) LEFT JOIN issue USING (patientId)
         LEFT JOIN debit USING (id)
       WHERE city IN ('CHD', 'BLR', 'Jaipur', 'NCR', 'Hyderabad')),
     g AS (SELECT city, unnest(['0', '1-100', '101-200', '201-300', '301-400', '>400', 'WALLET', 'Privilege Card']) AS bucket
           FROM (SELECT DISTINCT city FROM b))"""
FEE_DAYS = {
    "d1": "d = DATE '1998-06-16'", "d2": "d = DATE '1998-06-15'", "d3": "d = DATE '1998-06-14'",
    "d4": "d = DATE '1998-06-13'", "mtd": "d BETWEEN DATE '1998-06-01' AND DATE '1998-06-17'",
}
FEE_WEEKS = {w.name: f"d BETWEEN DATE '{w.start}' AND DATE '{w.end}'" for w in week_windows(AS_OF)}


@query(
    "r01_consultation_fee_daily",
    FIRST_FEE_SQL + ", n AS (SELECT g.city, g.bucket, "
    + ", ".join(f"count(*) FILTER ({test}) AS {name}" for name, test in FEE_DAYS.items())
    + " FROM g LEFT JOIN b ON g.city = b.city AND g.bucket = b.bucket GROUP BY 1, 2), "
    + "t AS (SELECT city, coalesce(bucket, 'Total') AS bucket, "
    + ", ".join(f"sum({n})::BIGINT AS {n}" for n in FEE_DAYS)
    + " FROM n GROUP BY GROUPING SETS ((city, bucket), (city))) SELECT t.*, "
    + ", ".join(
        f"CASE WHEN t.bucket = 'Total' OR z.{n} = 0 THEN 0 ELSE round_even(t.{n} / z.{n} * 100, 2) END AS {n}_pct"
        for n in FEE_DAYS
    )
    + " FROM t JOIN t z ON z.city = t.city AND z.bucket = 'Total'",
)
def consultation_fee_daily(t: Tables) -> DataFrame:
    return money.consultation_fees(DeskTables(t), AS_OF)["daily"]


@query(
    "r01_consultation_fee_weekly",
    FIRST_FEE_SQL + ", n AS (SELECT g.city, g.bucket, "
    + ", ".join(
        f"count(*) FILTER ({test}) AS {name}_n, coalesce(sum((fee * 100)::BIGINT) FILTER ({test}), 0) AS {name}_c"
        for name, test in FEE_WEEKS.items()
    )
    + " FROM g LEFT JOIN b ON g.city = b.city AND g.bucket = b.bucket GROUP BY 1, 2), "
    + "t AS (SELECT city, coalesce(bucket, 'Total') AS bucket, "
    + ", ".join(f"sum({n}_n)::BIGINT AS {n}_n, sum({n}_c)::BIGINT AS {n}_c" for n in FEE_WEEKS)
    + " FROM n GROUP BY GROUPING SETS ((city, bucket), (city))) SELECT t.city, t.bucket, "
    + ", ".join(
        f"t.{n}_n, CASE WHEN t.bucket = 'Total' OR z.{n}_n = 0 THEN 0 ELSE round_even(t.{n}_n / z.{n}_n * 100, 2) END AS {n}_n_pct, "
        + half_even(f"t.{n}_c", f"t.{n}_n") + f" AS {n}_avg"
        for n in FEE_WEEKS
    )
    + " FROM t JOIN t z ON z.city = t.city AND z.bucket = 'Total'",
)
def consultation_fee_weekly(t: Tables) -> DataFrame:
    return money.consultation_fees(DeskTables(t), AS_OF)["weekly"]


# R2 ------------------------------------------------------------------------------------

CLASS_SQL = """CASE WHEN mode IN ('RAZOR_PAY', 'RAZOR_PAY_UPI_PAID') THEN 'Razorpay' WHEN mode IN ('UPI', 'GOOGLE_PAY') THEN 'UPI'
       WHEN mode = 'INSURANCE' THEN 'Insurance' WHEN mode = 'CASH' THEN 'Cash' WHEN mode = 'KTKSWIPE' THEN 'KTKSWIPE' ELSE 'Other' END"""


PAYMENTS_SQL = with_desk(
    "card_payment", "card", "patient_profile", "customer_profile", "city", "appointment", "payment_link", "patient_case",
    "surgery", "surgery_payment",
) + f""", home AS (SELECT pp.id AS patientId, pp.customerId, cityName AS town FROM patient_profile pp
         SEMI JOIN customer_profile USING (customerId) LEFT JOIN city ON city.id = pp.cityId),
     treated AS (SELECT caseId, coalesce({CODE.format('coalesce(cityName, town)')}, 'No City') AS city
       FROM patient_case pc JOIN home USING (patientId) LEFT JOIN city ON city.id = pc.cityId),
     p AS (
       SELECT city, 'IPD' AS service, paymentMode AS mode, (sp.createdOn {LOCAL})::DATE AS d
       FROM surgery_payment sp JOIN surgery ON surgery.id = patientSurgeryId JOIN treated USING (caseId) WHERE paymentStatus = 'PAID'
       UNION ALL
       SELECT city, if(consultationType IN ('Online Consultation', 'Consultation', 'Diagnostics'), consultationType, 'Other'),
         paymentMode, (ap.createdOn {LOCAL})::DATE
       FROM appointment ap JOIN treated ON caseId = leadId JOIN payment_link pl ON entityId = ap.id
       WHERE entityType = 'APPOINTMENT' AND pl.status = 'PAID' AND paymentMode <> 'ZERO_FEE'
       UNION ALL
       SELECT coalesce({CODE.format('town')}, 'No City'), 'Loyalty', paymentMode, (dues.createdOn {LOCAL})::DATE
       FROM home JOIN card USING (customerId) JOIN card_payment dues USING (cardId) WHERE paymentStatus = 'PAID')"""


@query(
    "r02_payment_mix",
    PAYMENTS_SQL + f""", w(name, a, b) AS (VALUES ('month_to_date', DATE '1998-06-01', DATE '1998-06-16'),
       ('last_month', DATE '1998-05-01', DATE '1998-05-31'), ('last_week', DATE '1998-06-08', DATE '1998-06-14'),
       ('this_week', DATE '1998-06-15', DATE '1998-06-16')),
     h AS (SELECT city, service, name, {CLASS_SQL} AS class FROM p JOIN w ON d BETWEEN a AND b),
     g AS (SELECT city, service, name FROM (SELECT DISTINCT city FROM h) CROSS JOIN
             (SELECT unnest(['Online Consultation', 'Consultation', 'Diagnostics', 'Loyalty', 'IPD']) AS service) CROSS JOIN w
           UNION SELECT city, service, name FROM h),
     n AS (SELECT g.city, g.service, g.name AS "window", """
    + ", ".join(f"count(*) FILTER (class = '{c}') AS \"{c}\"" for c in PAY_MODE_CLASSES)
    + """, count(class) AS n FROM g LEFT JOIN h ON g.city = h.city AND g.service = h.service AND g.name = h.name GROUP BY 1, 2, 3)
     SELECT city, service, "window", """
    + ", ".join(f'"{c}", CASE WHEN n = 0 THEN 0 ELSE round_even("{c}" / n * 100, 2) END AS "{c}_pct"' for c in PAY_MODE_CLASSES)
    + " FROM n",
)
def payment_mix(t: Tables) -> DataFrame:
    return money.payment_mix(DeskTables(t), AS_OF)["mix"]


@query(
    "r02_payment_details",
    PAYMENTS_SQL + f""", s(short, a, b) AS (VALUES ('tm', DATE '1998-06-01', DATE '1998-06-16'), ('lm', DATE '1998-05-01', DATE '1998-05-31'))
     SELECT city, (CASE WHEN service IN ('Loyalty', 'IPD') THEN replace(service, 'Loyalty', 'loyalty') ELSE 'appointment' END) || '_' || short AS "set",
       service, mode AS "paymentMode", strftime(d, '%Y-%m-%d') AS date, {CLASS_SQL} AS "modeClass"
     FROM p JOIN s ON d BETWEEN a AND b""",
)
def payment_details(t: Tables) -> DataFrame:
    """The six detail sets as they were delivered, twice, so that a repeated run shows."""
    path = fresh_dir(t.spark, "details")
    for _ in range(2):
        money.deliver_payment_details(DeskTables(t), AS_OF, path)
    return read_delivered(t.spark, path, money.DELIVERED).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


# R3 ------------------------------------------------------------------------------------

CASES_SQL = with_desk(
    "patient_case", "appointment", "appointment_test", "test", "lead_comment", "staff"
) + f""", theirs AS (SELECT leadId FROM lead_comment JOIN staff ON email = "user" AND personnelType = 'AGENT'
       WHERE commentType = 'CREATION' AND leadType = 'CASE'),
     wanted AS (SELECT * FROM patient_case WHERE caseType = 'Diagnostics' AND leadSource NOT IN ('Offline channel', 'CAMP')
       AND tenantName = 'MAIN'),
     c AS (SELECT caseId, patientLeadStatus AS s, reason, (createdOn {LOCAL})::DATE AS d FROM wanted
       WHERE (createdOn {LOCAL})::DATE BETWEEN DATE '1998-06-01' AND DATE '1998-06-16'
       AND caseId NOT IN (SELECT leadId FROM theirs)),
     v AS (SELECT a.id, a.consultationType AS ct, a.appointmentCreationType AS kind, coalesce(x.name, 'N.A') AS testName,
         a.appointmentDate::DATE AS d FROM appointment a JOIN wanted ON wanted.caseId = a.leadId
         LEFT JOIN appointment_test y ON y.appointmentId = a.id LEFT JOIN test x ON x.id = y.testId
       WHERE a.doctorConsultationStatus = '3' AND a.appointmentDate::DATE BETWEEN DATE '1998-06-01' AND DATE '1998-06-16'
         AND a.leadId NOT IN (SELECT leadId FROM theirs)),
     m(measure) AS (VALUES ('confirmed'), ('booked'), ('followUp'), ('cancelled'), ('total_leads_created')),
     o(measure) AS (VALUES ('appointments_done'), ('followups_done'))"""
TWO_WINDOWS = """count(*) FILTER (d = DATE '1998-06-16') AS yesterday, count(*) AS month_to_date"""


@query(
    "r03_diagnostic_cases_summary",
    CASES_SQL + """ SELECT measure, count(*) FILTER (d = DATE '1998-06-16') AS yesterday, count(d) AS month_to_date
       FROM m LEFT JOIN c ON CASE measure WHEN 'confirmed' THEN s = '7' WHEN 'booked' THEN s = '2'
         WHEN 'followUp' THEN s IN ('0', '1', '5') WHEN 'cancelled' THEN s = '3' ELSE true END GROUP BY 1
       UNION ALL SELECT measure, count(*) FILTER (d = DATE '1998-06-16'), count(d)
       FROM o LEFT JOIN v ON CASE measure WHEN 'appointments_done' THEN kind <> 'FOLLOWUP_APPOINTMENT'
         ELSE kind = 'FOLLOWUP_APPOINTMENT' AND ct <> 'Diagnostics' END GROUP BY 1""",
)
def diagnostic_cases_summary(t: Tables) -> DataFrame:
    return diagnostics.diagnostic_cases(DeskTables(t), AS_OF)["summary"]


@query(
    "r03_diagnostic_cases_reasons",
    CASES_SQL + f""" SELECT 'followup' AS kind, reason, {TWO_WINDOWS} FROM c WHERE s IN ('0', '1', '5') AND reason IS NOT NULL GROUP BY 2
       UNION ALL SELECT 'cancelled', reason, {TWO_WINDOWS} FROM c WHERE s = '3' AND reason IS NOT NULL GROUP BY 2""",
)
def diagnostic_cases_reasons(t: Tables) -> DataFrame:
    out = diagnostics.diagnostic_cases(DeskTables(t), AS_OF)
    named = lambda key, kind: out[key].withColumn("kind", F.lit(kind))
    return named("followup_reasons", "followup").unionByName(named("cancel_reasons", "cancelled"))


@query(
    "r03_diagnostic_cases_tests",
    CASES_SQL + f""" SELECT 'first' AS kind, testName, {TWO_WINDOWS} FROM v WHERE kind <> 'FOLLOWUP_APPOINTMENT' GROUP BY 2
       UNION ALL SELECT 'followup', testName, {TWO_WINDOWS} FROM v
       WHERE kind = 'FOLLOWUP_APPOINTMENT' AND ct <> 'Diagnostics' GROUP BY 2""",
)
def diagnostic_cases_tests(t: Tables) -> DataFrame:
    out = diagnostics.diagnostic_cases(DeskTables(t), AS_OF)
    named = lambda key, kind: out[key].withColumn("kind", F.lit(kind))
    return named("tests", "first").unionByName(named("followup_tests", "followup"))


# R4 ------------------------------------------------------------------------------------

@query(
    "r04_feedback",
    with_desk(
        "survey_consultation", "survey_procedure", "patient_case", "patient_profile", "customer_profile", "city", "appointment"
    ) + f""", p AS (SELECT pc.caseId, pc.patientId, cp.customerNumber, coalesce(a.id, 0) AS appId, {CASE_CITY.format('NOCITY')} AS city
       FROM patient_case pc {PATIENT_JOINS} LEFT JOIN appointment a ON a.leadId = pc.caseId),
     x AS (SELECT appId::VARCHAR AS k, arg_min((city, customerNumber, patientId, caseId), (caseId, appId)) AS v FROM p GROUP BY 1),
     y AS (SELECT caseId::VARCHAR AS k, arg_min((city, customerNumber, patientId, caseId), (caseId, appId)) AS v FROM p GROUP BY 1),
     s AS (SELECT 'survey_consultation' AS survey, c.*, v FROM survey_consultation c LEFT JOIN x ON k = caseid
       UNION ALL SELECT 'survey_procedure', c.*, v FROM survey_procedure c LEFT JOIN y ON k = caseid),
     z AS (SELECT *, strptime(submittedAt, '%d/%m/%Y %H:%M:%S') AS ts FROM s)
     SELECT survey, coalesce(v[1], 'NOCITY') AS city, strftime(ts {LOCAL}, '%d/%m/%Y %H:%M:%S') AS "submittedAt", caseid AS "answerId",
       coalesce(v[2], '') AS "customerNumber", coalesce('https://desk.example/patient/' || v[3] || '/case/' || v[4], '') AS url,
       recommend, suggestions FROM z WHERE ts >= TIMESTAMP '2024-01-17 13:00:00' AND ts < TIMESTAMP '2024-01-17 14:00:00'""",
)
def feedback(t: Tables) -> DataFrame:
    return visits.feedback(DeskTables(t), EVENTS_AS_OF, "https://desk.example")["answers"]


# R5 ------------------------------------------------------------------------------------

WEEK = Window("week", dt.date(1998, 4, 1), dt.date(1998, 6, 14))
WEEK_SQL = with_desk(
    "appointment", "facility", "city", "patient_case", "patient_profile", "customer_profile", "lead_comment"
) + """, closed AS (SELECT leadId, arg_min("user", commentId) AS agent FROM lead_comment
       WHERE commentType = 'APPOINTMENT_DONE' AND leadType = 'APPOINTMENT' GROUP BY 1),
     a AS (SELECT x.*, s.aliasName, coalesce(agent, '') AS agent, consultationType IN ('DIAGNOSTICS', 'Diagnostics') AS is_test
       FROM appointment x JOIN facility s ON s.facilityId = x.hospitalId LEFT JOIN closed ON closed.leadId = x.id
       WHERE doctorConsultationStatus = '3' AND s.cityId IN (1, 2, 3, 4)
         AND appointmentDate::DATE BETWEEN DATE '1998-04-01' AND DATE '1998-06-14'),
     v AS (SELECT a.* FROM a JOIN patient_case pc ON pc.caseId = a.leadId JOIN patient_profile pp ON pp.id = pc.patientId
       JOIN customer_profile cp ON cp.customerId = pp.customerId WHERE NOT is_test),
     taken AS (SELECT DISTINCT originConsultationId::BIGINT AS origin FROM appointment WHERE doctorConsultationStatus = '3'
       AND consultationType IN ('DIAGNOSTICS', 'Diagnostics') AND leadId IN (SELECT leadId FROM v) AND originConsultationId IS NOT NULL),
     u AS (SELECT agent, aliasName, 0 AS recommended, 0 AS taken, 1 AS total_done, (consultationFee = 0)::INT AS zero_value, consultationFee AS value
       FROM a WHERE is_test UNION ALL
       SELECT agent, aliasName, (additionalDetails->>'$.isDiagnosticsTestRecommended' = 'YES')::INT, (id IN (SELECT origin FROM taken))::INT, 0, 0, 0 FROM v),
     w AS (SELECT 'agent' AS dim, agent AS label, u.* FROM u UNION ALL SELECT 'hospital', aliasName, u.* FROM u),
     n AS (SELECT dim, coalesce(label, 'Total') AS label, coalesce(sum(recommended), 0)::BIGINT AS recommended, coalesce(sum(taken), 0)::BIGINT AS taken,
         sum(total_done)::BIGINT AS total_done, sum(zero_value)::BIGINT AS zero_value, sum(value)::DOUBLE AS value
       FROM w GROUP BY GROUPING SETS ((dim, label), (dim))),
     r AS (SELECT *, CASE WHEN recommended = 0 THEN 0 ELSE round_even(taken * 100 / recommended, 2) END AS taken_pct FROM n)
     SELECT *, CASE WHEN taken_pct = 0 AND recommended > 0 THEN 'red' WHEN taken_pct = 0 THEN 'none' WHEN taken_pct < 50 THEN 'red'
       WHEN taken_pct < 70 THEN 'pale' ELSE 'none' END AS band FROM r"""


@query("r05_diagnostic_week", WEEK_SQL)
def diagnostic_week(t: Tables) -> DataFrame:
    return plain(diagnostics.diagnostic_week(DeskTables(t), WEEK)["summary"])


# R6, R7 --------------------------------------------------------------------------------

QUEUE_TABLES = ("patient_case", "patient_profile", "customer_profile", "city", "outbound_queue", "agent_source", "support_staff")


def _queue_sql(padded: bool) -> str:
    face = "lpad({}, 2, '0')" if padded else "{}"
    slots = {0: ("9", "AM", "10", "AM"), 1: ("1", "PM", "2", "PM"), 2: ("9", "AM", "10", "AM"), 3: ("5", "PM", "6", "PM"), 4: ("9", "AM", "10", "AM")}
    typed = " ".join(
        f"WHEN {k} THEN " + " || '-' || ".join(face.format(f"'{h}'") + f" || '{m}'" for h, m in ((a, b), (c, d)))
        for k, (a, b, c, d) in slots.items()
    )
    return with_desk(*QUEUE_TABLES) + f""", f AS (
       SELECT k.cityName AS city, CASE pc.caseId % 7 {typed} WHEN 6 THEN 'None' END AS slot,
         CASE pc.caseId % 7 WHEN 1 THEN 13 WHEN 3 THEN 17 WHEN 5 THEN NULL WHEN 6 THEN 24 ELSE 9 END AS ordinal,
         assignedTo = 'queue@desk.example' AS queued, coalesce(reason = 'Confirmation Pending', false) AS pending
       FROM patient_case pc JOIN patient_profile pp ON pp.id = pc.patientId JOIN customer_profile cp ON cp.customerId = pp.customerId
         JOIN city k ON k.id = pc.cityId
       WHERE followUpdate = DATE '1998-06-17' AND patientLeadStatus IN ('0', '1', '5') AND assignedTo <> 'system@desk.example'
         AND tenantName = 'MAIN' AND k.cityName IN ('Jaipur', 'NCR')),
     n AS (SELECT city, slot, ordinal, count(*) FILTER (queued) AS queued, count(*) FILTER (NOT queued AND pending) AS pending,
         count(*) FILTER (NOT queued) AS with_agent FROM f GROUP BY 1, 2, 3)"""


QUEUE = {"queue": "queue@desk.example", "system_user": "system@desk.example"}
NOON = dt.datetime(1998, 6, 17, 12, 0)


@query(
    "r06_followup_queue_today",
    _queue_sql(False) + """, q AS (SELECT cityName AS city, strftime(scheduledOn, '%-I%p') || '-' || strftime(scheduledOn + INTERVAL 1 HOUR, '%-I%p') AS slot,
         count(*) AS scheduled FROM outbound_queue o JOIN city k ON k.id = o.cityId
       WHERE status = 'ENQUEUED' AND cityId IN (3, 4) AND scheduledOn::DATE = DATE '1998-06-17' GROUP BY 1, 2),
     j AS (SELECT n.*, coalesce(scheduled, 0) AS scheduled FROM n LEFT JOIN q ON q.city = n.city AND q.slot = n.slot)
     SELECT city, slot, ordinal, queued, pending, with_agent, scheduled, (queued + with_agent) / 25 AS agents_needed FROM j WHERE ordinal IS NOT NULL
     UNION ALL SELECT city, 'Total', NULL, sum(queued)::BIGINT, sum(pending)::BIGINT, sum(with_agent)::BIGINT, sum(scheduled)::BIGINT,
       round_even(sum(queued + with_agent) / 25, 2) FROM j GROUP BY 1""",
)
def followup_queue_today(t: Tables) -> DataFrame:
    return queues.followup_queue_today(DeskTables(t), NOON, **QUEUE)["slots"]


TEAM_SQL = """, m AS (SELECT DISTINCT cityId, unnest(string_split(emailId, ',')) AS member FROM agent_source WHERE cityId IN (3, 4)),
     e AS (SELECT m.cityId, count(*) AS n, string_agg(member, ',' ORDER BY member) AS names FROM m
       JOIN support_staff s ON s.email = member WHERE s.cityId <> m.cityId GROUP BY 1)"""


@query(
    "r06_followup_queue_names",
    with_desk(*QUEUE_TABLES) + TEAM_SQL + ' SELECT cityId AS "cityId", 0::BIGINT AS part, names AS other_city_agents FROM e',
)
def followup_queue_names(t: Tables) -> DataFrame:
    return queues.followup_queue_today(DeskTables(t), NOON, **QUEUE)["names"]


@query(
    "r06_followup_queue_agents",
    with_desk(*QUEUE_TABLES) + TEAM_SQL + """,
     z AS (SELECT cityId, count(*) AS queue_size FROM outbound_queue WHERE status = 'ENQUEUED' AND scheduledOn < TIMESTAMP '1998-06-17 12:00:00' GROUP BY 1)
     SELECT m.cityId AS "cityId", any_value(k.cityName) AS city, count(*) AS members, coalesce(any_value(n), 0) AS other_city_members, coalesce(any_value(queue_size), 0) AS queue_size
     FROM m LEFT JOIN e ON e.cityId = m.cityId LEFT JOIN z ON z.cityId = m.cityId JOIN city k ON k.id = m.cityId GROUP BY m.cityId""",
)
def followup_queue_agents(t: Tables) -> DataFrame:
    return queues.followup_queue_today(DeskTables(t), NOON, **QUEUE)["agents"]


@query(
    "r07_followup_queue_next_day",
    _queue_sql(True) + """ SELECT city, slot, ordinal, queued, pending, with_agent, (queued + with_agent) / 25 AS agents_needed FROM n WHERE ordinal IS NOT NULL
     UNION ALL SELECT city, 'Total', NULL, sum(queued)::BIGINT, sum(pending)::BIGINT, sum(with_agent)::BIGINT,
       round_even(sum(queued + with_agent) / 25, 2) FROM n GROUP BY 1""",
)
def followup_queue_next_day(t: Tables) -> DataFrame:
    return queues.followup_queue_next_day(DeskTables(t), dt.date(1998, 6, 16), **QUEUE)["slots"]


# R8 ------------------------------------------------------------------------------------

@query(
    "r08_wallet_balances",
    with_desk("ledger", "customer_profile") + f""", l AS (SELECT *, (createdOn {LOCAL})::DATE AS d, (amount / 100.0)::DECIMAL(28,2) AS amt
       FROM ledger WHERE (createdOn {LOCAL})::DATE < DATE '1998-06-17'),
     c AS (SELECT x.*, row_number() OVER (PARTITION BY x.customerId ORDER BY x.d, x.entryId) AS i,
         (SELECT coalesce(sum(y.amt), 0) FROM l y WHERE y.customerId = x.customerId AND y.transactionType = 'DEBITED'
            AND y.d < x.validTill)::DECIMAL(28,2) AS open
       FROM l x WHERE x.transactionType = 'CREDITED'),
     p AS (SELECT customerId, i, entryId, 0::DECIMAL(28,2) AS before, greatest(0, least(amt, open))::DECIMAL(28,2) AS taken FROM c WHERE i = 1
       UNION ALL SELECT c.customerId, c.i, c.entryId, p.taken, greatest(p.taken, least(p.taken + c.amt, c.open))::DECIMAL(28,2)
       FROM p JOIN c ON c.customerId = p.customerId AND c.i = p.i + 1)
     SELECT c.entryId::VARCHAR AS "entryId", c.customerId::VARCHAR AS "customerId", amt::DOUBLE AS amount, strftime(validTill, '%Y-%m-%d') AS "validTill",
       strftime(d, '%Y-%m-%d') AS "createdOn", transactionType AS "transactionType", customerName AS "customerName", customerEmail AS "customerEmail",
       customerNumber AS "customerNumber", (CASE WHEN validTill >= DATE '1998-06-17' THEN amt - (taken - before) ELSE 0 END)::DOUBLE AS balance
     FROM c JOIN p ON p.entryId = c.entryId LEFT JOIN customer_profile f ON f.customerId = c.customerId""",
)
def wallet_balances(t: Tables) -> DataFrame:
    return plain(money.wallet_balances(DeskTables(t), AS_OF)["wallet"])


# R9, R10 -------------------------------------------------------------------------------

@query(
    "r09_offline_followup",
    with_desk("patient_case", "patient_case_audit", "patient_profile", "customer_profile", "city", "lead_comment")
    + f""", u AS (SELECT leadId, arg_max("user", commentId) AS by_user FROM lead_comment WHERE leadType = 'CASE' AND commentType = 'CREATION' GROUP BY 1)
     SELECT caseId::VARCHAR AS "caseId", strftime(followUpdate, '%Y-%m-%d') AS "followUpdate", followUpTime AS "followUpTime", symptoms,
       pc.leadSource AS "leadSource", reason, cp.customerNumber AS "customerNumber", {CASE_CITY.format('No City')} AS city,
       coalesce(by_user, '') AS "createdBy",
       ['OPENED', 'FOLLOWUP', 'APPOINTMENT_BOOKED', 'CANCELLED', 'REJECTED', 'INCOMPLETE', 'CLOSED', 'APPOINTMENT_CONFIRMED'][patientLeadStatus::INT + 1] AS "leadStatus",
       strftime(pc.createdOn {LOCAL}, '%Y-%m-%d %H:%M:%S') AS "caseCreatedOn", month(pc.createdOn {LOCAL})::INT AS "caseMonth"
     FROM patient_case pc LEFT {PATIENT_JOINS.replace('JOIN customer', 'LEFT JOIN customer')} LEFT JOIN u ON u.leadId = pc.caseId
     WHERE pc.leadSource IN ('Offline channel', 'VC Model') AND tenantName = 'MAIN' AND pc.createdOn >= TIMESTAMP '1997-04-01'
       AND caseId IN (SELECT caseId FROM patient_case_audit WHERE patientLeadStatus IN ('0', '1', '5') AND followUpdate IS NOT NULL)""",
)
def offline_followup(t: Tables) -> DataFrame:
    return plain(leads.offline_followup(DeskTables(t), dt.date(1997, 4, 1))["cases"])


@query(
    "r10_channel_tracking",
    with_desk("patient_case", "patient_profile", "customer_profile", "city", "patient_channel", "marketing_channel", "campaign")
    + f""", t AS (SELECT eventLabel::BIGINT AS k, arg_max(campaign, rowNo) AS campaign FROM campaign WHERE eventLabel <> '(not set)' GROUP BY 1),
     l AS (SELECT coalesce({CODE_5.format('coalesce(k.cityName, q.cityName)')}, 'No City') AS city, cp.leadSource AS source,
         CASE WHEN cp.leadSource IN ('Exotel', 'Whatsapp') THEN mc.channelName ELSE coalesce(t.campaign, '') END AS channel
       FROM patient_case pc {PATIENT_JOINS} LEFT JOIN patient_channel pm ON pm.patientProfileId = pp.id
         LEFT JOIN marketing_channel mc ON mc.id = pm.marketingChannelId LEFT JOIN t ON t.k = pc.caseId
       WHERE (pp.createdOn {LOCAL})::DATE BETWEEN DATE '1998-06-09' AND DATE '1998-06-16'
         AND cp.leadSource IN ('Exotel', 'Whatsapp', 'Website Submit')),
     g AS (SELECT city, unnest(['Exotel', 'Whatsapp', 'Website Submit']) AS source FROM (SELECT unnest(['CHD', 'BLR', 'JPR', 'NCR', 'HYD']) AS city))
     SELECT g.city, g.source AS "leadSource", count(l.source) AS leads, CASE WHEN count(l.source) = 0 THEN 0 ELSE
       round_even(count(*) FILTER (channel <> '') * 100 / count(l.source), 2) END AS coverage_pct
     FROM g LEFT JOIN l ON l.city = g.city AND l.source = g.source GROUP BY 1, 2""",
)
def channel_tracking(t: Tables) -> DataFrame:
    return leads.channel_tracking(DeskTables(t), AS_OF)["coverage"]


# R11 -----------------------------------------------------------------------------------

SLICE = {"older": dt.timedelta(days=10), "newer": dt.timedelta(minutes=20)}
CALLS_SQL = with_desk("call_summary") + """, c AS (SELECT * FROM call_summary WHERE call_created_on >= TIMESTAMP '2024-01-07 14:25:30'
       AND call_created_on < TIMESTAMP '2024-01-17 14:05:30' AND city = 'Hyderabad' AND personnelType <> 'AGENT')"""


@query(
    "r11_call_view_by_leg",
    CALLS_SQL + " SELECT finalDetailedStatus AS \"finalDetailedStatus\", " + ", ".join(
        f"count(*) FILTER (leg_1_status = '{v}') AS {k}" for k, v in visits.LEG_STATUS.items()
    ) + " FROM c GROUP BY 1",
)
def call_view_by_leg(t: Tables) -> DataFrame:
    return visits.call_view(DeskTables(t), EVENTS_AS_OF, "Hyderabad", **SLICE)["by_leg"]


@query(
    "r11_call_view_by_message",
    CALLS_SQL + " SELECT finalDetailedStatus AS \"finalDetailedStatus\", " + ", ".join(
        f"count(*) FILTER (noSent = '{v}') AS {k}" for k, v in visits.SENT.items()
    ) + " FROM c GROUP BY 1",
)
def call_view_by_message(t: Tables) -> DataFrame:
    return visits.call_view(DeskTables(t), EVENTS_AS_OF, "Hyderabad", **SLICE)["by_message"]


@query(
    "r11_call_view_by_agent",
    CALLS_SQL + """, u AS (SELECT leg1Agent_email AS agent, leg1Status AS s FROM c UNION ALL SELECT leg2Agent_email, leg2Status FROM c
       UNION ALL SELECT leg3Agent_email, leg3Status FROM c) SELECT agent, """ + ", ".join(
        f"count(*) FILTER (s = '{v}') AS {k}" for k, v in visits.AGENT_STATUS.items()
    ) + " FROM u GROUP BY 1",
)
def call_view_by_agent(t: Tables) -> DataFrame:
    return visits.call_view(DeskTables(t), EVENTS_AS_OF, "Hyderabad", **SLICE)["by_agent"]


# R12 -----------------------------------------------------------------------------------

@query(
    "r12_incentive_by_region",
    with_desk("weekly_visit", "target", "support_staff", "city") + """, w AS (SELECT agentAction AS email, apptType, k.cityName AS city,
         reportingTl, newTarget, newCovTarget, CASE k.cityName WHEN 'Bangalore' THEN 'BLR' WHEN 'Hyderabad' THEN 'HYD' ELSE 'NORTH' END AS region
       FROM weekly_visit v LEFT JOIN target t ON t.email = agentAction LEFT JOIN support_staff s ON s.email = agentAction
         LEFT JOIN city k ON k.id = s.cityId WHERE sequence IN (1, 2)),
     n AS (SELECT region, email, city, reportingTl, newCovTarget, count(*) FILTER (apptType = 'Online Consultation') AS online,
         count(*) FILTER (apptType <> 'Online Consultation') AS offline, count(*) AS achieved, min(newTarget) AS target FROM w GROUP BY 1, 2, 3, 4, 5)
     SELECT region, email, city, reportingTl AS "reportingTl", newCovTarget AS "newCovTarget", online, offline, target, achieved,
       achieved - target AS gap, CASE WHEN target > 0 AND achieved >= target THEN 200 * offline + 100 * online ELSE 0 END AS pay FROM n""",
)
def incentive_by_region(t: Tables) -> DataFrame:
    return leads.incentive_by_region(DeskTables(t))["incentive"]


# R13, R14 ------------------------------------------------------------------------------

HOSPITAL = "Supplier#000000017"


@query(
    "r13_payment_notice",
    with_desk("facility_payment", "appointment", "facility", "doctor", "patient_case", "patient_profile", "customer_profile")
    + f""", due AS (SELECT entityId AS "appId", arg_min(struct_pack(id := id, at := createdOn {LOCAL}, amount := amount, utr := utr), (createdOn, id)) AS pay
       FROM facility_payment WHERE paymentStatus = 'processed' AND entityType IN ('APPOINTMENT', 'DIAGNOSTICS_APPOINTMENT')
         AND createdOn {LOCAL} > TIMESTAMP '1998-06-17 12:00:00' - INTERVAL 500 DAY AND createdOn {LOCAL} <= TIMESTAMP '1998-06-17 12:00:00' GROUP BY ALL),
     here AS (SELECT facilityId AS hospitalId, aliasName AS hospital_name FROM facility WHERE aliasName = '{HOSPITAL}'),
     payer AS (SELECT caseId AS leadId, patientName, customerNumber FROM customer_profile JOIN patient_profile pp USING (customerId)
       JOIN patient_case ON patientId = pp.id),
     medic AS (SELECT doctorId, name AS doctor_name FROM doctor)
     SELECT pay.id AS id, "appId", strftime(pay.at, '%Y-%m-%d %H:%M:%S') AS payment_date, pay.amount // 100 AS amount, patientName AS "patientName",
       customerNumber AS "customerNumber", coalesce(additionalDetails->>'$.hospitalPriceBills', '') AS "hospitalPriceBills",
       consultationType AS "consultationType", CASE doctorConsultationStatus WHEN '1' THEN 'BOOKED' WHEN '3' THEN 'DONE' ELSE 'CANCELLED' END AS status,
       doctor_name, pay.utr AS utr, hospital_name, row_number() OVER (ORDER BY pay.id) AS serial
     FROM due JOIN appointment v ON v.id = "appId" JOIN here USING (hospitalId) JOIN payer USING (leadId) LEFT JOIN medic USING (doctorId)""",
)
def payment_notice(t: Tables) -> DataFrame:
    out = money.payment_notice(DeskTables(t), NOON, HOSPITAL, dt.timedelta(days=500))
    return plain(out["notice"])


@query(
    "r14_surgery_tracker",
    with_desk(
        "surgery", "surgery_payment", "patient_case", "patient_profile", "customer_profile", "city", "facility", "speciality"
    )
    + f""", ward AS (SELECT facilityId AS hospitalId, aliasName FROM facility WHERE aliasName <> 'Supplier#000000003'),
     person AS (SELECT pp.id AS patientId, patientName, right(customerNumber, 10) AS number, cityName AS town
       FROM patient_profile pp JOIN customer_profile USING (customerId) LEFT JOIN city ON city.id = pp.cityId),
     matter AS (SELECT caseId, patientName, number, leadSource, specialityName, coalesce({CODE.format('coalesce(cityName, town)')}, 'No City') AS city
       FROM patient_case pc JOIN person USING (patientId) LEFT JOIN city ON city.id = pc.cityId LEFT JOIN speciality ON speciality.id = specialityId
       WHERE leadSource <> 'Hospital Insurance' AND tenantName = 'MAIN'),
     admitted AS (SELECT id, caseId, hospitalId, admissionDate FROM surgery ANTI JOIN
         (SELECT patientSurgeryId AS id FROM surgery_payment WHERE paymentMode = 'CASH') USING (id)
       WHERE surgeryStatus = 'ADMISSION_DONE' AND admissionDate <= TIMESTAMP '1998-06-17 12:00:00' - INTERVAL 1 DAY)
     SELECT id, caseId AS "caseId", strftime(admissionDate, '%Y-%m-%d %H:%M:%S') AS "admissionDate", aliasName AS "aliasName", patientName AS "patientName",
       number AS "customerNumber", leadSource AS "leadSource", specialityName AS "specialityName", city
     FROM admitted JOIN ward USING (hospitalId) JOIN matter USING (caseId) WHERE (aliasName, leadSource) <> ('{HOSPITAL}', 'Offline channel')""",
)
def surgery_tracker(t: Tables) -> DataFrame:
    desk = DeskTables(t)
    tracker = desk["surgery_payment"].where(F.col("paymentMode") == "CASH").select(F.col("patientSurgeryId").alias("id"))
    out = visits.surgery_tracker(
        desk, tracker, NOON, excluded_hospitals=["Supplier#000000003"], excluded_pair=(HOSPITAL, "Offline channel")
    )
    return plain(out["new_rows"])


# R15, R16, R17 -------------------------------------------------------------------------

@query(
    "r15_advised_then_visited",
    with_desk("visit", "appointment_test", "test") + """, v AS (SELECT *, consultationType IN ('Consultation', 'Online Consultation')
         AND appointmentStatus = 'DONE' AS consulted FROM visit),
     a AS (SELECT patientId, min(apptId) AS x FROM v WHERE consulted AND isDiagnosticsTestRecommended = 'YES' GROUP BY 1),
     b AS (SELECT v.patientId, min(apptId) AS y FROM v JOIN a ON a.patientId = v.patientId WHERE consulted AND apptId > x GROUP BY 1)
     SELECT a.patientId AS "patientId", coalesce(s.caseid, f.caseid) AS caseid, coalesce(s.number, f.number) AS number,
       strftime(f.appointmentDate, '%Y-%m-%d') AS "appointmentDate", x AS "apptId", y AS "nextApptId",
       strftime(s.appointmentDate, '%Y-%m-%d') AS "nextAppointmentDate"
     FROM a LEFT JOIN b ON b.patientId = a.patientId JOIN visit f ON f.apptId = x LEFT JOIN visit s ON s.apptId = y""",
)
def advised_then_visited(t: Tables) -> DataFrame:
    return plain(diagnostics.advised_then_visited(DeskTables(t))["pairs"])


@query(
    "r15_tests_of_pairs",
    with_desk("visit", "appointment_test", "test") + """, done AS (SELECT patientId, apptId, isDiagnosticsTestRecommended = 'YES' AS advised FROM visit
       WHERE appointmentStatus = 'DONE' AND consultationType IN ('Consultation', 'Online Consultation')),
     began AS (SELECT patientId, min(apptId) AS x FROM done WHERE advised GROUP BY ALL),
     last AS (SELECT patientId, x, min(apptId) FILTER (apptId > x) AS y FROM began JOIN done USING (patientId) GROUP BY ALL),
     wanted AS (SELECT DISTINCT coalesce(y, x) AS appointmentId FROM last)
     SELECT appointmentId AS "appointmentId", 0::BIGINT AS part, string_agg(name, ',' ORDER BY name) AS "testNames"
     FROM wanted JOIN appointment_test USING (appointmentId) LEFT JOIN test ON test.id = testId GROUP BY 1""",
)
def tests_of_pairs(t: Tables) -> DataFrame:
    return diagnostics.advised_then_visited(DeskTables(t))["tests"]


@query(
    "r16_satisfaction_messages",
    with_desk("message") + f""", m AS (SELECT * FROM message WHERE toMessage <> fromId AND createdOn {LOCAL} >= TIMESTAMP '1998-03-01')
     SELECT uuid, toMessage AS "toMessage", message, status, strftime(createdOn {LOCAL}, '%Y-%m-%d %H:%M:%S') AS "createdOn",
       CASE WHEN toMessage IN (SELECT toMessage FROM m WHERE message LIKE '%Rate us 5 stars%') THEN 'Yes'
            WHEN toMessage IN (SELECT toMessage FROM m WHERE message LIKE '%Sorry to hear%') THEN 'No' ELSE ' ' END AS response
     FROM m WHERE message LIKE '%tell us about your visit%'""",
)
def satisfaction_messages(t: Tables) -> DataFrame:
    out = leads.satisfaction_messages(
        DeskTables(t), dt.date(1998, 3, 2), "Hi.* tell us about your visit", "Rate us 5 stars", "Sorry to hear that"
    )
    return plain(out["messages"])


@query(
    "r17_staff_availability",
    with_desk("staff", "staff_facility", "facility", "city") + f""", free AS (SELECT personnelId, email, coalesce({CODE.format('cityName')}, 'NA') AS city
       FROM staff LEFT JOIN city ON city.id = cityId WHERE personnelType = 'AGENT' AND isAvailable = 1 AND hasLeft = 0),
     linked AS (SELECT DISTINCT email, city, aliasName FROM free JOIN staff_facility USING (personnelId) JOIN facility USING (facilityId)
       WHERE (mappingType, tenantName) = ('AGENT', 'MAIN') AND isValid = 1)
     SELECT email, city, 0::BIGINT AS part, string_agg(aliasName, ',' ORDER BY aliasName) AS hospitals FROM linked GROUP BY ALL""",
)
def staff_availability(t: Tables) -> DataFrame:
    return visits.staff_availability(DeskTables(t))["staff"]


# R18, R19 ------------------------------------------------------------------------------

@query(
    "r18_home_pickup",
    with_desk("appointment", "patient_case", "patient_profile", "customer_profile") + """, v AS (SELECT a.id, a.hospitalId, pc.patientId, a.doctorConsultationStatus AS s
       FROM appointment a JOIN patient_case pc ON pc.caseId = a.leadId),
     d AS (SELECT *, rank() OVER (PARTITION BY patientId ORDER BY id)::DOUBLE AS rank, min(id) OVER (PARTITION BY patientId) AS first
       FROM v WHERE s = '3' AND patientId IN (SELECT patientId FROM v WHERE hospitalId = 42))
     SELECT d.id, d.patientId AS "patientId", pp.patientName AS "patientName", cp.customerNumber AS "customerNumber", rank, 'DONE' AS status,
       CASE WHEN d.id = first THEN 'New Patient' ELSE 'Existing patient' END AS patient_type
     FROM d LEFT JOIN patient_profile pp ON pp.id = d.patientId LEFT JOIN customer_profile cp ON cp.customerId = pp.customerId WHERE hospitalId = 42""",
)
def home_pickup(t: Tables) -> DataFrame:
    rows = visits.home_pickup(DeskTables(t), 42)["visits"]
    return rows.select("id", "patientId", "patientName", "customerNumber", F.col("rank").cast("double").alias("rank"), "status", "patient_type")


@query(
    "r19_followup_ageing",
    with_desk("staff", "city", "followup_landed") + f""", l AS (SELECT s.email, coalesce({CODE.format('k.cityName')}, 'No City') AS city,
         unnest(from_json(body::JSON, '["JSON"]')) AS item FROM staff s JOIN followup_landed f ON f.email = s.email LEFT JOIN city k ON k.id = s.cityId
       WHERE personnelType = 'AGENT' AND isAvailable = 1),
     e AS (SELECT email, city, (item->>'$.caseId')::BIGINT AS "caseId", (item->>'$.patientId')::BIGINT AS "patientId", (item->>'$.createdOn')::BIGINT AS ms FROM l)
     SELECT email, city, "caseId", "patientId", ms AS "createdOn", strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S') AS created,
       ((epoch_ms(TIMESTAMP '2024-01-17 14:25:30') - ms) / 1000.0)::DOUBLE AS seconds,
       CASE WHEN epoch_ms(TIMESTAMP '2024-01-17 14:25:30') - ms <= 600000 THEN 'less than 10_Mins' WHEN epoch_ms(TIMESTAMP '2024-01-17 14:25:30') - ms <= 1800000 THEN '10 - 30_Mins'
         WHEN epoch_ms(TIMESTAMP '2024-01-17 14:25:30') - ms <= 3600000 THEN '30 - 60_Mins' WHEN epoch_ms(TIMESTAMP '2024-01-17 14:25:30') - ms <= 7200000 THEN '1 - 2_hours'
         WHEN epoch_ms(TIMESTAMP '2024-01-17 14:25:30') - ms <= 36000000 THEN '2 - 10_hours' ELSE 'more than 10_hours' END AS age FROM e""",
)
def followup_ageing(t: Tables) -> DataFrame:
    rows = queues.followup_ageing(DeskTables(t), EVENTS_AS_OF)["followups"]
    return plain(rows.select("email", "city", "caseId", "patientId", "createdOn", "created", "seconds", "age"))
