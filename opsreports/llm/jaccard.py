"""Similarity join of documents on word shingles: a size-aware heavy-light join.

A small set lists its subsets of the fixed size that a pair of its and its partner's sizes must share; sets that
list the same subset are linked without a look at the sets. Large sets are looked up in inverted lists; the boundary is
where the two cost the same in all, by the sizes at hand. A set enters the lists of its rarest shingles
only, as many as it could miss and one more: sets with none in common can't be similar.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsreports.llm.bpe import text_bytes
from opsreports.llm.common import components, lean, passing, settle
from opsreports.llm.repeats import shared_runs

_RANDOM = np.random.Generator(np.random.PCG64(1)).integers(1, 1 << 63, 256, dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: Counters of the frequency sketch, and how many of them a row carries. Fixed, so what is broadcast doesn't grow.
COUNTERS, SLICE = 1 << 21, 1 << 17
#: Texts hashed at once; hashing takes some 50 bytes for each of theirs.
TEXTS = 100
_SHIFT = np.uint64(64 - 21)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(column, width: int) -> list[np.ndarray]:
    """Each text's set of shingle hashes, ascending: ``width`` words in a row, or all of fewer words; words parted by ASCII white space, A-Z lowered."""
    data, at = text_bytes(column)
    if not len(data):
        return [np.zeros(0, np.uint64)] * (len(at) - 1)
    data = data + (((data >= 0x41) & (data <= 0x5A)) << 5).astype(np.uint8)
    space = _SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    begins = np.flatnonzero(~space & (np.concatenate(([True], space[:-1])) | edge[:-1]))
    if not len(begins):
        return [np.zeros(0, np.uint64)] * (len(at) - 1)
    owner = np.concatenate((np.zeros(begins[0], np.int64), np.repeat(begins, np.diff(np.append(begins, len(data))))))
    place = np.arange(len(data)) - owner
    weight = _mix((place.astype(np.uint64) + np.uint64(1)) * _ODD)
    values = np.where(space, np.uint64(0), _RANDOM[data] * weight)
    words = _mix(np.add.reduceat(values, begins))
    firsts = np.searchsorted(begins, at)
    rolled = words.copy()
    for k in range(1, width):
        rolled[: len(words) - k] = rolled[: len(words) - k] * _ODD + words[k:]
    rolled = _mix(rolled)
    out = []
    for a, b in zip(firsts[:-1], firsts[1:], strict=True):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            h = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for w in words[a:b]:
                    h = h * _ODD + w
            out.append(_mix(np.array([h])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _print(s: np.ndarray) -> bytes | None:
    """Digest of a set, None of the empty one."""
    return hashlib.md5(s.tobytes(), usedforsecurity=False).digest() if len(s) else None


def shared_at_least(n: int, m: int, percent: int) -> int:
    """Least intersection of sets of n and m whose Jaccard similarity is at least percent / 100."""
    return -(-percent * (n + m) // (100 + percent))


def partners(n: int, percent: int) -> range:
    """Sizes that a set of n can be similar to."""
    return range(-(-n * percent // 100), n * 100 // percent + 1)


def prefix_length(n: int, percent: int) -> int:
    return n - (-(-n * percent // 100)) + 1


def light_keys(n: int, percent: int) -> int:
    """How many subsets a small set of n lists."""
    return sum(math.comb(n, shared_at_least(n, m, percent)) for m in partners(n, percent))


def choose_boundary(sizes: dict[int, int], percent: int, most: int = 16) -> int:
    """The largest size of small sets: listing subsets costs one unit each, a list entry one and one per shingle to check a partner."""

    def cost(x: int) -> float:
        return sum(c * (light_keys(n, percent) if n <= x else prefix_length(n, percent) * (1 + n)) for n, c in sizes.items())

    return min(range(most + 1), key=lambda x: (cost(x), x))


def _levels(counts: np.ndarray) -> np.ndarray:
    """How frequent the shingles of a counter may be, in 64ths of the mean count. Each set's rarest shingles then have counters that hold
    little besides; a shingle of many documents is among them only where a set has hardly any other."""
    return np.minimum(counts * 64 // max(1, int(counts.sum()) // len(counts)), 65_535).astype(np.uint16)


def _count_sketch(rows: DataFrame) -> np.ndarray:
    """Sum of the counter slices of all tasks, in two steps, so that no group holds those of all."""

    def total(frame: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(SLICE, np.int64)
        for raw in frame["counts"]:
            out += np.frombuffer(zlib.decompress(raw), np.int64)
        return pd.DataFrame({"slice": frame["slice"].iloc[:1], "task": [0], "counts": [zlib.compress(out.tobytes(), 1)]})

    schema = "slice int, task long, counts binary"
    part = rows.groupBy("slice", F.pmod("task", F.lit(64))).applyInPandas(total, schema)
    whole = part.groupBy("slice").applyInPandas(total, schema)
    out = np.zeros(COUNTERS, np.int64)
    for row in whole.collect():
        out[row["slice"] * SLICE : (row["slice"] + 1) * SLICE] = np.frombuffer(zlib.decompress(row["counts"]), np.int64)
    return out


def similar_documents(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, stars: int = 3,
) -> DataFrame:
    """Rows (id, n_shingles, component_id): each document's set size and the smallest id it reaches over links.

    Two documents link when 100 * shared >= ``percent`` * all of their shingles. Equal sets are brought down to one first. Candidates of
    large sets come from inverted lists over their rarest shingles. Frequent shingles are told by a sketch of fixed size, counted over
    all documents; it orders the shingles and doesn't drop any. A list isn't paired out: its sets are first compared with
    up to ``stars`` centres of it, and what is linked falls into a component. Then only sets of different components are
    paired, those that share as many list entries as similar sets must. Every candidate is checked on whole sets.

    Null and empty texts, and texts without words: size 0, linked with nothing. Null ids: linked with nothing, component null.
    Rows that share an id are one document; if their sets differ, the one of the smallest digest counts. One result row per row; an empty table gives none; other
    columns are ignored.
    """
    kind = df.schema[id_col].dataType.simpleString()
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, task, key_type = np.zeros(COUNTERS, np.int64), TaskContext.get().partitionId(), None
        names = ["id", "n", "print", "slice", "task", "counts"]
        for batch in batches:
            key_type = batch.schema.field(0).type
            for lo in range(0, batch.num_rows, TEXTS):
                part = batch.slice(lo, TEXTS)
                sets = shingle_sets(part.column(1), width)
                flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                np.add.at(counts, (flat >> _SHIFT).astype(np.int64), 1)
                none = pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.int64()), pa.nulls(len(sets), pa.binary())
                prints = [_print(s) for s in sets]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary()), *none], names=names)
        if key_type is not None:
            k = COUNTERS // SLICE
            packed = [zlib.compress(counts[i * SLICE : (i + 1) * SLICE].tobytes(), 1) for i in range(k)]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(k, key_type), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.array(range(k), pa.int32()),
                 pa.array([task] * k, pa.int64()), pa.array(packed, pa.binary())], names=names,
            )

    measured = settle(texts.mapInArrow(lean(measure), f"id {kind}, n long, print binary, slice int, task long, counts binary"), "sizes")
    sizes = measured.where("slice IS NULL").select("id", "n", "print")
    usable = sizes.where("id IS NOT NULL AND n > 0")
    # One set per id: of rows that share an id, the one with the smallest print.
    valid = usable.groupBy("id").agg(F.min(F.struct("print", "n")).alias("own")).select("id", "own.print", "own.n")
    reps = settle(valid.groupBy("print").agg(F.min("id").alias("rep"), F.min("n").alias("n")), "sets")
    few = {r["n"]: r["count"] for r in reps.where("n <= 24").groupBy("n").count().collect()}
    boundary = choose_boundary(few, percent)
    levels = _levels(_count_sketch(measured.where("slice IS NOT NULL").select("slice", "task", "counts")))

    def entries(s: np.ndarray) -> tuple[list[int], list[int]]:
        """Keys of a set's subsets and lists, and each key's kind: 0 list, 1 subset shared by equal sizes, 2 by a larger one, 3 by a smaller one."""
        n, keys, kinds = len(s), [], []
        if n <= boundary:
            for m in partners(n, percent):
                for subset in combinations(s.tolist(), shared_at_least(n, m, percent)):
                    raw = np.array([min(n, m), max(n, m), *subset], np.uint64).tobytes()
                    keys.append(int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True))
                    kinds.append(1 if m == n else 2 if m > n else 3)
        if n > boundary or n * 100 // percent > boundary:
            order = np.lexsort((s, levels[(s >> _SHIFT).astype(np.int64)]))
            own = s[order[: prefix_length(n, percent)]].view(np.int64).tolist()
            keys += own
            kinds += [0] * len(own)
        return keys, kinds

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS):
                part = batch.slice(lo, TEXTS)
                sets = shingle_sets(part.column(1), width)
                made = [entries(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([m[0] for m in made], pa.list_(pa.int64())),
                     pa.array([bytes(m[1]) for m in made], pa.binary()), pa.array([_print(s) for s in sets], pa.binary())],
                    names=["id", "n", "keys", "kinds", "print"],
                )

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes_ = batch.column(2).value_lengths().to_numpy()
            row = pa.array(np.repeat(np.arange(batch.num_rows), sizes_))
            kinds = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).astype(np.int64)
            listed_ = np.concatenate(([0], np.cumsum(kinds == 0)))
            begins = np.cumsum(sizes_) - sizes_
            place = listed_[:-1] - np.repeat(listed_[begins], sizes_) if len(kinds) else kinds
            size = batch.column(1).to_numpy()[row.to_numpy()] << 34 | np.where(kinds == 0, place, 0) << 2 | kinds
            yield pa.RecordBatch.from_arrays([batch.column(2).flatten(), batch.column(0).take(row), pa.array(size)], names=["key", "id", "size"])

    # Entries of sets that another row stands for are dropped while they are still one row per document.
    entered = texts.where("id IS NOT NULL").mapInArrow(lean(enter), f"id {kind}, n long, keys array<long>, kinds binary, print binary").where("n > 0")
    entered = entered.join(reps.select(F.col("rep").alias("id"), "print"), ["id", "print"], "left_semi").select("id", "n", "keys", "kinds")
    listed = entered.mapInArrow(lean(spread), f"key long, id {kind}, size long").repartition("key").sortWithinPartitions("key")
    met = settle(
        listed.mapInArrow(lean(shared_runs), f"key long, id {kind}, size long").select(
            "key", "id", F.shiftright("size", 34).alias("n"), F.shiftright("size", 2).bitwiseAND(F.lit((1 << 32) - 1)).alias("place"), (F.col("size") % 4).alias("kind")
        ).distinct(), "lists"
    )
    lists = met.where("kind = 0").select("key", "id", "n", "place")

    by_key = Window.partitionBy("key")
    side = lambda k: F.min(F.when(F.col("kind") == k, F.col("id"))).over(by_key)
    light = met.where("kind > 0").select(
        F.col("id").alias("a"), F.when(F.col("kind") == 1, side(1)).when(F.col("kind") == 2, side(3)).otherwise(side(2)).alias("b")
    ).where("b IS NOT NULL AND a <> b").distinct()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS):
                part = batch.slice(lo, TEXTS)
                sets = shingle_sets(part.column(1), width)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([_print(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "print", "shingles"]
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                shared = int((y[at] == x).sum())
                good.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good))

    def checked(pairs: DataFrame, label: str) -> DataFrame:
        """Of settled pairs (a, b) those that are similar, settled."""
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        sets = passing(texts.where("id IS NOT NULL"), ids).mapInArrow(lean(gather), f"id {kind}, print binary, shingles binary")
        sets = sets.join(ids.join(reps.select(F.col("rep").alias("id"), "print"), "id"), ["id", "print"], "left_semi").dropDuplicates(["id"])
        ours = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
        theirs = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
        both = pairs.join(ours, "a").join(theirs, "b").select("a", "b", "x", "y")
        return settle(both.mapInArrow(lean(compare), f"a {kind}, b {kind}"), label)

    n, m = F.col("n"), F.col("m")
    fitting = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    need = F.ceil((n + m) * percent / F.lit(100 + percent))
    room = lambda x: F.floor(x * (100 - percent) / F.lit(100)) + 1 - x + need  # noqa: E731  shared entries a similar pair has, seen from one side
    support = F.greatest(F.least(room(n), room(m)), F.lit(1))

    # First each set is compared with a few centres of each of its lists.
    # The first by id, the one that shares most of its entries, then ones by hash.
    mine, degree = F.struct("id", "n"), lists.groupBy("id").agg(F.count("*").alias("degree"))
    ranks = [F.col("id"), -F.col("degree"), *[F.xxhash64(F.lit(turn), "id") for turn in range(stars - 2)]][:stars]
    centres = [F.min(F.struct(rank, mine.alias("own"))).over(by_key)["own"] for rank in ranks]
    starred = lists.join(degree, "id").withColumn("own", F.array(*centres) if stars else F.array(mine).cast(f"array<struct<id:{kind},n:bigint>>"))
    starred = starred.select("id", "n", F.explode(F.array_distinct("own")).alias("c"))
    starred = starred.select(F.col("id").alias("a"), "n", F.col("c.id").alias("b"), F.col("c.n").alias("m")).where("a <> b")
    starred = starred.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(F.col("a") < F.col("b"), n).otherwise(m).alias("n"), F.when(F.col("a") < F.col("b"), m).otherwise(n).alias("m"))
    # A quarter of what a similar pair must share is a guess worth checking; what it leaves out comes below.
    near = starred.where(fitting).groupBy("a", "b", "n", "m").count().where(F.col("count") >= support / 4).select("a", "b")
    edges = checked(settle(near, "pairs"), "links").union(light)
    found = components(edges, "linked")

    # Then sets of different components. A similar pair shares at least k of the entries that come first in each of its sets, as many as
    # the set may lack and k more; which ones these are depends on both sizes. A fourth of the most that k can be keeps pairs and entries few.
    placed = lists.join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    split = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    open_ = settle(placed.join(split, "key"), "open")
    other = open_.select("key", F.col("id").alias("b"), F.col("n").alias("m"), F.col("component").alias("own"), F.col("place").alias("there"))
    least = F.floor(support / 4) + F.when(support >= 4, 0).otherwise(1)
    early = (F.col("component") < F.col("own")) & fitting & (F.col("place") < n - need + least) & (F.col("there") < m - need + least)
    pairs = open_.withColumnRenamed("id", "a").repartition("key").join(other.repartition("key"), "key").where(early)
    pairs = pairs.groupBy("a", "b", "n", "m").count().where(F.col("count") >= least).select("a", "b")
    more = checked(settle(pairs, "pairs"), "links")
    found = components(more.union(found.select(F.col("node").alias("a"), F.col("component").alias("b"))), "linked")

    own = valid.join(reps.select("print", "rep"), "print").join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "id", F.coalesce("component", "rep").alias("component_id")
    )
    return sizes.join(own, "id", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")
    )
