"""The trie against its SQL twin on the small and on odd tables, and over many slices and merges against plain sets."""

import hashlib
import random

import pytest

from compare import connect, differences
from opsreports.llm import trie, twins
from opsreports.llm.queries import QUERIES
from tables import SF, written

KIND = "conv_id long, turn long, role string, text string, depth int, key string, slice int"


def test_tables(spark):
    assert differences(QUERIES["op11_trie"](spark, SF), connect(SF), twins.OP11) is None


def test_odd_rows(spark, tmp_path):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", None, ""]), rng.choice(["a", "é", "", None])) for c in range(80) for t in range(rng.randrange(9))]
    rows += [(c, t, "user", "same") for c in range(100, 180) for t in range(4)] + [(c, t, "u", "same" * (t + 1)) for c in (200, 203, 204) for t in range(300)]
    rows += [(7, None, "user", "a"), (7, None, "user", "b"), (7, 1, "user", "again"), (None, 1, "user", "a"), (301, 0, None, "x" * 100_000), rows[0], rows[0], (303, -5, "r", "t")]
    con = written(spark, tmp_path, conversations=spark.createDataFrame([(*r, 1, "k", 2) for r in rows], KIND).repartition(5))
    assert differences(QUERIES["op11_trie"](spark, str(tmp_path)), con, twins.OP11) is None


def test_empty_table(spark, tmp_path):
    written(spark, tmp_path, conversations=spark.createDataFrame([], KIND))
    assert QUERIES["op11_trie"](spark, str(tmp_path)).collect() == []


def brute(convs):
    prefixes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            prefixes.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for p in prefixes:
        if p:
            kids.setdefault(p[:-1], []).append(p)

    def below(p):
        leaves, saved = (0 if p in kids else 1), (len(prefixes[p]) - 1) * (p[-1][1] if p else 0)
        for k in kids.get(p, ()):
            a, b = below(k)
            leaves, saved = leaves + a, saved + b
        return leaves, saved

    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        (min(m), len(p), min(prefixes[p[:-1]]) if p else -1, len(m), len(kids.get(p, ())), *below(p), sha([c for c in m if len(convs[c]) == len(p)]))
        for p, m in prefixes.items()
    )


@pytest.mark.parametrize("seed,letters,longest,slices,group", [(1, 2, 6, 40, 2), (2, 3, 12, 30, 4), (3, 1, 20, 25, 3), (4, 2, 40, 12, 64), (5, 26, 3, 9, 2)])
def test_slices_and_merges(spark, seed, letters, longest, slices, group):
    rng = random.Random(seed)
    made = lambda: [(rng.randrange(letters), 3) for _ in range(rng.randrange(longest + 1))]
    convs = {i: made() for i in range(150)}
    common = made()
    convs.update({i: common for i in range(500, 650)})
    convs.update({i: common[: rng.randrange(len(common) + 1)] + made() for i in range(700, 760)})
    rows = [(i, [(bytes([x]) * 16, z) for x, z in t]) for i, t in convs.items()]
    df = spark.createDataFrame(rows, "conv_id long, turns array<struct<digest:binary,size:int>>").repartition(4)
    turns = sum(len(t) + 1 for t in convs.values())
    got = trie.prefix_trie(df, slice_turns=max(1, turns // slices), group=group).collect()
    assert sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in got) == brute(convs)
