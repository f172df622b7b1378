"""The shingle join against brute force, small sets against definition."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from opsreports.llm import jaccard

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows, percent=80):
    sets = {i: shingles(t) for i, t in rows}
    lists, root = defaultdict(list), {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sorted(sets):
        counts = Counter(j for s in sets[i] for j in lists[s])
        for j, k in counts.items():
            if 100 * k >= percent * (len(sets[i]) + len(sets[j]) - k):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for s in sets[i]:
            lists[s].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_against_brute_force(docs, corpus):
    out = jaccard.similar_documents(docs)
    got = out.collect()
    assert len(got) == docs.count()
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}
    assert found.pop(None)[1] is None
    assert found == brute([(i, t) for i, t, _ in corpus])


def test_small_sets_of_every_overlap(spark):
    # Sets of one word repeated sequences of 5 to 20 words that share beginnings: all sizes around the boundary.
    base = [f"b{i}" for i in range(24)]
    rows = [(n * 100 + cut, " ".join(base[cut : cut + n])) for n in range(1, 22) for cut in (0, 1, 2, 3)]
    assert result(jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


@pytest.mark.parametrize("stars", [0, 1, 3])
def test_one_group_of_many_near_copies(spark, stars):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(120):
        words = list(base)
        for k in rng.integers(0, 300, int(rng.integers(0, 7))):
            words[k] = f"x{rng.integers(1_000_000)}"
        rows.append((i, " ".join(words)))
    assert result(jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), stars=stars)) == brute(rows)


def test_sizes_that_pairs_must_share():
    for n in range(1, 40):
        for m in jaccard.partners(n, 80):
            o = jaccard.shared_at_least(n, m, 80)
            assert 100 * o >= 80 * (n + m - o) and 100 * (o - 1) < 80 * (n + m - o + 1)
            assert n - o < jaccard.prefix_length(n, 80)


def test_boundary_follows_cost():
    assert jaccard.choose_boundary({}, 80) == 0
    assert 4 < jaccard.choose_boundary(dict.fromkeys(range(1, 25), 10), 80) < 14


def test_hashed_sets_have_the_right_sizes(corpus):
    texts = [t for _, t, _ in corpus]
    assert [len(s) for s in jaccard.shingle_sets(pa.array(texts, pa.string()), 5)] == [len(shingles(t)) for t in texts]


def test_empty_table(nothing):
    assert jaccard.similar_documents(nothing).collect() == []
