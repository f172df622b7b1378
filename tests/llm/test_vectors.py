"""Cover trees and the vector join against brute force."""

import math

import numpy as np
import pytest

from opsreports.llm import covertree


def vectors(n=300, dims=16, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, dims))
    x = centres[rng.integers(0, 20, n)] + rng.normal(scale=rng.choice([0.02, 0.2, 1.0], n)[:, None], size=(n, dims))
    return x.astype(np.float32)


def brute(rows, threshold):
    good = [(i, np.array(v, float), label) for i, v, label in rows
            if i is not None and v is not None and label is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    links, root = {i: set() for i, *_ in rows if i is not None}, {i: i for i, *_ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, v, a in good:
        for j, w, b in good:
            if i < j and a == b and len(v) == len(w) and v @ w / math.sqrt(v @ v) / math.sqrt(w @ w) >= threshold:
                links[i].add(j)
                links[j].add(i)
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(links[i]), find(i), find(i) == i) for i in links}


@pytest.mark.parametrize("block", [40, 2048])
def test_against_brute_force(spark, block):
    rows = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(vectors())]
    rows += [(1000 + i, rows[7][1], 1) for i in range(5)] + [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, rows[7][1], None), (2003, [float("nan")] * 16, 1),
                                                          (2004, [float("inf")] + [1.0] * 15, 1), (2005, [None] + [1.0] * 15, 1), (2006, [1.0, 2.0], 1), (2007, [2.0, 4.0], 1), (2008, [], 1)]
    df = spark.createDataFrame([*rows, rows[0], (None, rows[7][1], 1)], "vec_id long, embedding array<float>, label int").selectExpr("*", "'x' AS n_links")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in covertree.near_vectors(df, block=block).collect()}
    assert got.pop(None)[:2] == (0, None)
    assert got == brute(rows, 0.93)
    assert covertree.near_vectors(df.limit(0)).collect() == []


def test_tree_covers_and_nests():
    unit = vectors(200).astype(float)
    unit = unit / np.linalg.norm(unit, axis=1)[:, None]
    tree = covertree.CoverTree(np.vstack([unit, unit[:3]]).astype(float))

    def points(node):
        below = tree.children[node]
        return {tree.centre[node]} if not len(below) else set().union(*(points(c) for c in below))

    assert points(0) == set(range(203))
    for node, below in enumerate(tree.children):
        if len(below):
            assert tree.centre[below[0]] == tree.centre[node]
            far = [np.linalg.norm(tree.unit[p] - tree.unit[tree.centre[node]]) for p in points(node)]
            assert max(far) <= tree.reach[node] + 1e-6
