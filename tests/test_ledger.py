import datetime as dt
import random
from decimal import Decimal

import pytest

from opsreports.operators.ledger import ledger_balances, ledger_no_expiry

COLUMNS = {"id": "id", "customer": "customer", "kind": "kind", "amount": "amount", "created": "created", "end": "end"}
SCHEMA = "id bigint, customer bigint, kind string, amount decimal(18,2), created date, end date"
AS_OF = dt.date(2024, 6, 15)


def d(text):
    month, day = text.split("-")
    return dt.date(2024, int(month), int(day))


def credit(i, amount, end, created, customer=1):
    return (i, customer, "CREDITED", Decimal(amount), d(created), d(end))


def debit(i, amount, on, customer=1):
    return (i, customer, "DEBITED", Decimal(amount), d(on), None)


def balances(spark, rows):
    out = ledger_balances(spark.createDataFrame(rows, SCHEMA), AS_OF, COLUMNS)
    return {r["id"]: float(r["balance"]) for r in out.collect()}


SCENARIOS = {
    "used up": ([credit(1, 100, "07-01", "05-01"), debit(2, 60, "06-01"), debit(3, 40, "06-02")], {1: 0}),
    "expired, used up": ([credit(1, 100, "06-01", "05-01"), debit(2, 100, "05-20")], {1: 0}),
    "expired, half used": ([credit(1, 100, "06-01", "05-01"), debit(2, 50, "05-20")], {1: 0}),
    "half used": ([credit(1, 100, "07-01", "05-01"), debit(2, 40, "06-01")], {1: 60}),
    "untouched": ([credit(1, 100, "07-01", "05-01")], {1: 100}),
    "expired, untouched": ([credit(1, 100, "06-01", "05-01")], {1: 0}),
    "two credits": (
        [credit(1, 100, "07-01", "05-01"), credit(2, 50, "07-01", "05-02"), debit(3, 30, "05-10"), debit(4, 100, "05-11")],
        {1: 0, 2: 20},
    ),
    "debit after expiry": (
        [credit(1, 100, "06-01", "05-01"), credit(2, 50, "07-01", "05-02"), debit(3, 80, "06-05")], {1: 0, 2: 0},
    ),
    "valid on its last day": ([credit(1, 100, "06-15", "05-01"), debit(2, 30, "06-01")], {1: 70}),
    "debit on the end day": (
        [credit(1, 100, "06-01", "05-01"), credit(2, 50, "07-01", "05-02"), debit(3, 30, "06-01")], {1: 0, 2: 20},
    ),
    "one day, one lump": (
        [credit(1, 10, "07-01", "05-01"), credit(70001, 20, "07-01", "05-01"), credit(140002, 30, "07-01", "05-01"),
         debit(4, 15, "05-03")],
        {1: 0, 70001: 15, 140002: 30},
    ),
}


@pytest.mark.parametrize("name", SCENARIOS)
def test_written_scenarios(spark, name):
    rows, expected = SCENARIOS[name]
    assert balances(spark, rows) == expected


def brute_force(rows):
    """Credit by credit, oldest first, each taking the earliest debits dated before its end."""
    out = {}
    for customer in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == customer]
        debits = [[r[4], r[0], r[3]] for r in mine if r[2] == "DEBITED"]
        debits.sort()
        for i, _, _, amount, _, end in sorted((r for r in mine if r[2] == "CREDITED"), key=lambda r: (r[4], r[0])):
            left = amount
            for entry in debits:
                if entry[0] < end:
                    take = min(left, entry[2])
                    entry[2] -= take
                    left -= take
            out[i] = float(left) if end >= AS_OF else 0.0
    return out


@pytest.mark.parametrize("seed", range(4))
def test_any_mix_of_end_days_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(600):
        customer = rng.choice([1, 1, 1, 2, 3, 4])
        created = AS_OF - dt.timedelta(days=rng.randint(1, 60))
        if rng.random() < 0.55:
            end = created + dt.timedelta(days=rng.choice([3, 20, 40, 70]))
            rows.append((i * 50000, customer, "CREDITED", Decimal(rng.randint(100, 9999)) / 100, created, end))
        else:
            rows.append((i * 50000, customer, "DEBITED", Decimal(rng.randint(100, 7999)) / 100, created, None))
    assert balances(spark, rows) == brute_force(rows)


def test_balances_and_used_debits_conserve_the_total(spark):
    rng = random.Random(9)
    far = AS_OF + dt.timedelta(days=90)
    rows = [(i, 1, rng.choice(["CREDITED", "DEBITED"]), Decimal(rng.randint(1, 50)), AS_OF - dt.timedelta(days=i % 40 + 1), far)
            for i in range(300)]
    credits = sum(r[3] for r in rows if r[2] == "CREDITED")
    debits = sum(r[3] for r in rows if r[2] == "DEBITED")
    assert sum(balances(spark, rows).values()) == float(max(credits - debits, 0))


def test_credits_without_end_match_the_expiry_form_with_far_ends(spark):
    rng = random.Random(5)
    far = AS_OF + dt.timedelta(days=900)
    rows = [(i * 40000, i % 3, rng.choice(["CREDITED", "CREDITED", "DEBITED"]), Decimal(rng.randint(1, 90)),
             AS_OF - dt.timedelta(days=i % 25 + 1), far) for i in range(400)]
    plain = ledger_no_expiry(spark.createDataFrame(rows, SCHEMA), COLUMNS)
    assert {r["id"]: float(r["balance"]) for r in plain.collect()} == balances(spark, rows)
