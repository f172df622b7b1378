"""The ledger by composed steps: the written scenarios and brute force of the plain ledger, and a customer who is cut into slices."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from opsreports.operators.ledger_steps import Steps, stepped_balances
from test_ledger import AS_OF, COLUMNS, SCENARIOS, SCHEMA, brute_force, d


def stepped(spark, rows):
    return {r["id"]: float(r["balance"]) for r in stepped_balances(spark.createDataFrame(rows, SCHEMA), AS_OF, COLUMNS).collect()}


def test_written_scenarios_side_by_side(spark):
    """All scenarios as customers of one frame."""
    rows, expected = [], {}
    for n, (own, want) in enumerate(SCENARIOS.values()):
        rows += [(r[0] + n * 10_000_000, n, *r[2:]) for r in own]
        expected |= {i + n * 10_000_000: b for i, b in want.items()}
    assert stepped(spark, rows) == expected


@pytest.mark.parametrize("seed", range(30))
def test_composed_steps_equal_the_steps(seed):
    rng = random.Random(seed)
    steps = [(rng.randint(0, 30), rng.randint(0, 200)) for _ in range(rng.randrange(40))]
    composed = Steps()
    for amount, cap in steps:
        composed.compose(amount, cap)
    assert list(composed.gains) == sorted(set(composed.gains)) and list(composed.caps) == sorted(set(composed.caps), reverse=True)
    for start in range(0, 220, 7):
        taken = start
        for amount, cap in steps:
            taken = max(taken, min(taken + amount, cap))
        assert composed.at(start) == taken


def test_a_hot_customer_is_cut_into_slices(spark):
    """One customer owns a third of the rows, with free end days, and lies in several slices."""
    rng = random.Random(11)
    rows = []
    for i in range(6000):
        customer = 1 if i % 3 == 0 else None if i % 50 == 1 else rng.randrange(2, 400)
        created = AS_OF - dt.timedelta(days=rng.randint(1, 90))
        if rng.random() < 0.6:
            end = None if i % 97 == 5 else created + dt.timedelta(days=rng.choice([1, 3, 20, 40, 70, 95]))
            rows.append((i, customer, "CREDITED", Decimal(rng.randint(0, 9999)) / 100, created, end))
        else:
            rows.append((i, customer, "DEBITED", Decimal(rng.randint(100, 14999)) / 100, created, None))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r["id"]: float(r["balance"]) for r in stepped_balances(frame, AS_OF, COLUMNS).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    endless = {r[0] for r in rows if r[2] == "CREDITED" and r[5] is None}
    assert {i: b for i, b in got.items() if i not in endless} == brute_force([r for r in rows if r[0] not in endless])
    assert all(got[i] == 0 for i in endless)


def test_no_entries(spark):
    assert stepped(spark, [(1, 1, "DEBITED", Decimal(3), d("05-01"), None)]) == {}
    assert stepped_balances(spark.createDataFrame([], SCHEMA), AS_OF, COLUMNS).collect() == []
