"""Prefix trie of conversations: union-find over the common prefixes of sorted neighbours.

Conversations are sorted by their turns' digests. Two neighbours share a node at every depth up to the length of their
common prefix, so the neighbour edges in descending length build the trie from below: every merge of two components makes a
branching node at that depth, and the chain of nodes between it and the component's former top is settled.

Sorted conversations are cut into slices, and each slice builds its own forest. Only nodes that hold a slice's first or
last conversation can go on in another slice. So a slice is contracted to these two, with what hangs off each node of theirs; groups
of neighbouring slices are merged by the same union-find over their edges and contracted again, until one is left. A task
holds one slice or the contracted ends of ``GROUP`` slices.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsreports.llm.common import settle
from opsreports.operators.joins import reshuffled

#: Bytes of a turn's digest.
WIDTH = 16
#: Turns of a slice, slices merged at once, ids of a text that is hashed later.
SLICE, GROUP, IDS = 250_000, 64, 5_000
NONE = hashlib.sha256(b"").hexdigest()


def conversations(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Rows (conv_id, turns): each conversation's turns in order as structs (digest, size), size the UTF-8 bytes of the text.

    Ordered by turn, null first; turns that share a number by their digest; repeated rows are turns of their own. Null roles and texts are
    empty. Rows without a conversation id belong to none. Other columns don't matter.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    rows = df.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), digest.alias("digest"), F.octet_length(text).alias("size")
    )
    turns = F.array_sort(F.collect_list(F.struct("turn", "digest", "size")), _turn_order)
    return rows.groupBy("conv_id").agg(turns.alias("t")).select("conv_id", F.transform("t", lambda t: F.struct(t["digest"], t["size"])).alias("turns"))


def _turn_order(a, b):
    later = lambda c: F.when(a[c] < b[c], -1).when(a[c] > b[c], 1)
    by_null = F.when(a["turn"].isNull() & b["turn"].isNotNull(), -1).when(a["turn"].isNotNull() & b["turn"].isNull(), 1)
    return F.coalesce(by_null, later("turn"), later("digest"), F.lit(0))


#: What hangs off a node: smallest conversation, conversations, children, leaves and saved bytes below them.
EMPTY = (None, 0, 0, 0, 0)


@dataclass
class Forest:
    """Nodes under construction. ``item`` is one of a node's items; ``above`` its parent, -1 if not known, -2 - a if it is one with a."""

    depth: list[int] = field(default_factory=list)
    least: list[int] = field(default_factory=list)
    convs: list[int] = field(default_factory=list)
    children: list[int] = field(default_factory=list)
    leaves: list[int] = field(default_factory=list)
    saved: list[int] = field(default_factory=list)
    ends: list[tuple[int, int]] = field(default_factory=list)
    item: list[int] = field(default_factory=list)
    above: list[int] = field(default_factory=list)

    def node(self, item: int, depth: int, own: tuple = EMPTY, ends: tuple[int, int] = (0, 0)) -> int:
        for column, value in zip(
            (self.depth, self.least, self.convs, self.children, self.leaves, self.saved, self.ends, self.item, self.above),
            (depth, *own, ends, item, -1), strict=True,
        ):
            column.append(value)
        return len(self.depth) - 1

    def add(self, a: int, least: int | None, convs: int, children: int, leaves: int, saved: int) -> None:
        self.least[a] = least if self.least[a] is None else self.least[a] if least is None else min(self.least[a], least)
        self.convs[a] += convs
        self.children[a] += children
        self.leaves[a] += leaves
        self.saved[a] += saved

    def absorb(self, a: int, b: int) -> None:
        """Two nodes at one place are one; who points to b finds a."""
        self.add(a, self.least[b], self.convs[b], self.children[b], self.leaves[b], self.saved[b])
        if self.ends[b] != (0, 0):
            self.ends[a] = self.ends[b]
        self.above[b] = -2 - a

    def found(self, a: int) -> int:
        while self.above[a] < -1:
            a = -2 - self.above[a]
        return a

    def close(self, a: int, size: int) -> None:
        """The node is whole: a node without children is a leaf, and its own saving counts."""
        if not self.children[a]:
            self.leaves[a] = 1
        self.saved[a] += (self.convs[a] - 1) * size


@dataclass
class Item:
    """A conversation, or the end of a contracted slice: its digests, its turns' sizes, and what hangs off its nodes, by depth."""

    seq: bytes
    sizes: np.ndarray
    own: dict[int, tuple[int | None, int, int, int, int]]
    ends: tuple[int, int] = (0, 0)


def common(a: bytes, b: bytes) -> int:
    """Turns that two sequences share at their start."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    if a[: high * WIDTH] == b[: high * WIDTH]:
        return high
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * WIDTH] == b[: middle * WIDTH]:
            low = middle
        else:
            high = middle - 1
    return low


def merge(items: Sequence[Item], edges: Sequence[int], last: bool) -> tuple[Forest, list[int], tuple[dict, dict], dict[int, tuple[int, int]]]:
    """The forest of sorted items with common prefixes ``edges``; its closed nodes, what hangs off the first and the last item by
    depth, and which nodes are on these two chains: {node: (side, depth)}. With ``last`` all nodes are closed, up to the root."""
    forest, n = Forest(), len(items)
    up = list(range(n))
    low, high = list(range(n)), list(range(n))
    top, rest = [0] * n, [None] * n
    closed: list[int] = []
    hanging: tuple[dict, dict] = ({}, {})
    chain: dict[int, tuple[int, int]] = {}

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for i, item in enumerate(items):
        depth = len(item.seq) // WIDTH
        top[i] = forest.node(i, depth, item.own.get(depth, EMPTY), item.ends)
        rest[i] = {d: v for d, v in item.own.items() if d < depth}

    def side(c: int) -> int | None:
        return None if last else 0 if low[c] == 0 else 1 if high[c] == n - 1 else None

    def raised(c: int, depth: int) -> None:
        """Moves the component's top to a depth; the nodes below it are whole, or go to the chains."""
        own_side, sizes = side(c), items[low[c]].sizes
        while forest.depth[top[c]] > depth:
            a = top[c]
            d = forest.depth[a]
            b = forest.node(low[c], d - 1, rest[c].pop(d - 1, EMPTY))
            if own_side is None:
                forest.close(a, int(sizes[d - 1]))
                closed.append(a)
                forest.above[a] = b
                forest.add(b, forest.least[a], forest.convs[a], 1, forest.leaves[a], forest.saved[a])
            else:
                hang(c, own_side)
            top[c] = b

    def hang(c: int, own_side: int) -> None:
        a = top[c]
        d = forest.depth[a]
        chain[a] = (own_side, d)
        hanging[own_side][d] = (forest.least[a], forest.convs[a], forest.children[a], forest.leaves[a], forest.saved[a])

    for e in np.argsort(-np.asarray(edges, np.int64), kind="stable"):
        depth = int(edges[e])
        a, b = find(int(e)), find(int(e) + 1)
        for c in (a, b):
            raised(c, depth)
        forest.absorb(top[a], top[b])
        if len(rest[a]) < len(rest[b]):
            rest[a], rest[b] = rest[b], rest[a]
        for d, (least, convs, children, leaves, saved) in rest[b].items():
            if d in rest[a]:
                was = rest[a][d]
                known = [x for x in (was[0], least) if x is not None]
                rest[a][d] = (min(known) if known else None, was[1] + convs, was[2] + children, was[3] + leaves, was[4] + saved)
            else:
                rest[a][d] = (least, convs, children, leaves, saved)
        rest[b] = None
        up[b] = a
        high[a] = high[b]
    whole = find(0)
    if last:
        raised(whole, 0)
        forest.close(top[whole], 0)
        closed.append(top[whole])
    else:
        hang(whole, 0)
        hanging[0].update(rest[whole])
    return forest, closed, hanging, chain


def _key(seq: bytes, depth: int) -> bytes:
    return hashlib.md5(seq[: depth * WIDTH]).digest() + depth.to_bytes(4, "little")


SHAPE = (
    "kind string, slice bigint, side int, seq binary, sizes binary, own binary, meet bigint, key binary, parent_key binary, conv_id bigint, depth bigint, "
    "parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, part bigint, text string"
)
_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
_SCHEMA = pa.schema([(c.strip().split()[0], _KINDS[c.strip().split()[1]]) for c in SHAPE.split(",")])


def _batches(rows: Iterator[dict], size: int = 20_000) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema=_SCHEMA)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=_SCHEMA)


def _told(items: Sequence[Item], edges: Sequence[int], number: int, last: bool, ids: Sequence[int] | None) -> Iterator[dict]:
    """Rows of one merge: closed nodes, the two contracted ends, and ids that end at open nodes. ``ids``: of the conversations, in the lowest merge."""
    forest, closed, hanging, chain = merge(items, edges, last)
    first, final = items[0].seq, items[-1].seq
    ends = (first, final)
    at = {forest.found(a): place for a, place in chain.items()}
    for a in closed:
        row = {
            "kind": "node", "slice": number, "conv_id": forest.least[a], "depth": forest.depth[a], "n_convs": forest.convs[a],
            "n_children": forest.children[a], "n_leaves": forest.leaves[a], "saved_tokens": forest.saved[a],
        }
        b = forest.above[a]
        if b >= 0:
            b = forest.found(b)
            if b in at:
                s, d = at[b]
                row["parent_key"] = _key(ends[s], d)
            else:
                row["parent_conv_id"] = forest.least[b]
        if ids is None:
            row["key"] = _key(items[forest.item[a]].seq, forest.depth[a])
        else:
            low, high = forest.ends[a]
            row["ends_sha256"] = hashlib.sha256(",".join(map(str, ids[low:high])).encode()).hexdigest() if high > low else NONE
        yield row
    if last:
        return
    if ids is not None:
        for a, (s, d) in at.items():
            low, high = forest.ends[a]
            for part, i in enumerate(range(low, high, IDS)):
                yield {"kind": "ends", "slice": number, "part": part, "key": _key(ends[s], d), "text": ",".join(map(str, ids[i : min(i + IDS, high)]))}
    meet = min(edges, default=len(first) // WIDTH)
    for s, item in enumerate((items[0], items[-1])):
        flat = [[d, -1 if v[0] is None else 1, v[0] or 0, *v[1:]] for d, v in sorted(hanging[s].items())]
        yield {
            "kind": "item", "slice": number, "side": s, "seq": item.seq, "sizes": np.asarray(item.sizes, np.int64).tobytes(),
            "own": np.asarray(flat, np.int64).tobytes(), "meet": meet,
        }


def _lowest(sorted_rows: DataFrame) -> DataFrame:
    """Each slice of the sorted conversations (conv_id, seq, sizes), by its partition's number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: list[Item] = []
        edges: list[int] = []
        ids: list[int] = []
        for batch in batches:
            for conv, seq, sizes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if items:
                    edges.append(common(items[-1].seq, seq))
                    if edges[-1] * WIDTH == len(seq) == len(items[-1].seq):
                        # One conversation over and over: one item with all its ends.
                        edges.pop()
                        old = items[-1]
                        least, convs, *others = old.own[len(seq) // WIDTH]
                        old.own[len(seq) // WIDTH] = (min(least, conv), convs + 1, *others)
                        old.ends = (old.ends[0], len(ids) + 1)
                        ids.append(conv)
                        continue
                n = len(ids)
                items.append(Item(seq, sizes.values.to_numpy() if sizes.values is not None else np.zeros(0, np.int64), {len(seq) // WIDTH: (conv, 1, 0, 0, 0)}, (n, n + 1)))
                ids.append(conv)
        if items:
            yield from _batches(_told(items, edges, TaskContext.get().partitionId(), False, ids))

    return sorted_rows.mapInArrow(run, SHAPE)


def _merged(ends: DataFrame, group: int, last: bool) -> DataFrame:
    """Contracted slices merged, ``group`` neighbouring numbers at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def told() -> Iterator[dict]:
            """The rows of one group; what it needs is read from ``held`` before the first of them."""
            items: list[Item] = []
            edges: list[int] = []
            for row in held:
                own = np.frombuffer(row["own"], np.int64).reshape(-1, 7).tolist()
                item = Item(row["seq"], np.frombuffer(row["sizes"], np.int64), {d: (least if sign > 0 else None, *others) for d, sign, least, *others in own})
                if items:
                    edges.append(row["meet"] if row["side"] else common(items[-1].seq, item.seq))
                items.append(item)
            return _told(items, edges, held[0]["slice"] // group, last, None)

        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["slice"] // group != row["slice"] // group:
                    yield from _batches(told())
                    held.clear()
                held.append(row)
        if held:
            yield from _batches(told())

    slim = ends.select("slice", "side", "seq", "sizes", "own", "meet").withColumn("_group", F.floor(F.col("slice") / group))
    return slim.repartition("_group").sortWithinPartitions("_group", "slice", "side").drop("_group").mapInArrow(run, SHAPE)


def _hashed(texts: DataFrame) -> DataFrame:
    """(key, ends_sha256): texts of a key put end to end in the order of slice and part, hashed as they stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            keys, ends = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key != last:
                    if state is not None:
                        keys.append(last)
                        ends.append(state.hexdigest())
                    last, state = key, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ends, pa.string())], names=["key", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["key", "ends_sha256"])

    ordered = texts.repartition("key").sortWithinPartitions("key", "slice", "part").select("key", "text")
    return ordered.mapInArrow(run, "key binary, ends_sha256 string")


def prefix_trie(convs: DataFrame, slice_turns: int = SLICE, group: int = GROUP) -> DataFrame:
    """Rows (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one a node.

    ``convs``: rows (conv_id, turns) as of ``conversations``, with unique integer ids. A node is a distinct sequence of first turns, from the
    root of depth 0, which has all conversations, also those without turns. ``conv_id`` is its smallest member and names it together
    with the depth; the root's parent is null. ``saved_tokens``: over the node's subtree, what each text needn't be stored again, in bytes.
    ``ends_sha256`` is of the ids of the conversations that end at the node, ascending, joined by commas. No conversations: no nodes.

    A conversation is one row, 24 bytes a turn; its texts are not carried. Copies of one conversation are spread over slices by their id.
    """
    spark = convs.sparkSession
    seq = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), ""))
    rows = settle(convs.select("conv_id", seq.alias("seq"), F.transform("turns", lambda t: t["size"].cast("bigint")).alias("sizes")), "sequences")
    turns = rows.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
    slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // slice_turns))
    cut = rows.select("conv_id", "seq", "sizes").repartitionByRange(slices, "seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    lowest = settle(_lowest(cut), "slices")
    number = (lowest.agg(F.max("slice")).first()[0] or 0) + 1
    items, upper = lowest.where("kind = 'item'"), None
    while True:
        merged = settle(_merged(items, group, number <= group), "merged")
        nodes = merged.where("kind = 'node'")
        upper = nodes if upper is None else upper.unionByName(nodes)
        if number <= group:
            break
        items, number = merged.where("kind = 'item'"), -(-number // group)
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    names = upper.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    upper = upper.drop("ends_sha256").join(_hashed(lowest.where("kind = 'ends'")), "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NONE)))
    upper = upper.join(names, "parent_key", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    lower = lowest.where("kind = 'node'")
    # A node below an open one is told its parent's name by slice, so that no name is a key of more than one slice's rows.
    below = lower.where("parent_key IS NOT NULL")
    told = reshuffled(below.select("slice", "parent_key").distinct().join(names, "parent_key"), "slice", "parent_key")
    below = below.drop("parent_conv_id").join(told.withColumnRenamed("above", "parent_conv_id"), ["slice", "parent_key"])
    return upper.select(out).unionByName(lower.where("parent_key IS NULL").select(out)).unionByName(below.select(out))
