"""Components and neighbours against plain Python."""

import random

import pytest

from opsreports.llm import common
from opsreports.llm.common import components, in_order


def test_components(spark):
    random.seed(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(random.randrange(60), random.randrange(60)) for _ in range(40)] + [(900, 900), (None, 3)]
    root = {x: x for e in edges if None not in e for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in (e for e in edges if None not in e):
        x, y = sorted((find(a), find(b)))
        root[y] = x
    want = {x: find(x) for x in root} | {3: find(3) if 3 in root else 3}
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def _shape(name):
    """Edges of one component of 10,000 nodes."""
    n = 10_000
    if name == "path":
        return [(i, i + 1) for i in range(n - 1)]
    if name == "star":  # the centre is the largest
        return [(n - 1, i) for i in range(n - 1)]
    mixed = random.Random(8).sample(range(n), n)
    return list(zip(mixed, mixed[1:]))


@pytest.mark.parametrize("name", ["path", "star", "mixed path"])
def test_components_take_few_passes(spark, monkeypatch, name):
    passes = []
    written = common.settle
    monkeypatch.setattr(common, "settle", lambda df, label: passes.append(label) or written(df, label))
    got = components(spark.createDataFrame(_shape(name), "a long, b long"))
    assert got.count() == 10_000 and [r["component"] for r in got.select("component").distinct().collect()] == [0]
    # Measured: a mixed path has short chains but takes several rounds, 45 written frames in all; one round a link would take thousands.
    assert len(passes) <= (60 if name == "mixed path" else 30)


def test_neighbours_across_slices(spark):
    rows = [(i * 37 % 1000, f"h{i * 37 % 1000 // 400}") for i in range(1000)]
    out = in_order(spark.createDataFrame(rows, "n long, host string").repartition(8), ["n"], within=["host"], take=["n"]).collect()
    assert len(out) == 1000
    for r in out:
        last = r["n"] in (399, 799, 999)
        assert r["next_n"] == (None if last else r["n"] + 1)
