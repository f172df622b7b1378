"""Merkle manifest of a dataset by time-forward processing.

Nodes are labelled (tree, level, place) and handled in the order of their labels. A node sends its digest to its
parent's label; the queue of such messages is ordered by label, so that all of a node's children are at the front when
its turn comes. Levels are taken in epochs: within an epoch a block of consecutive nodes has its own queue, which holds
one block; from epoch to epoch the messages are Spark's, partitioned and externally sorted by label. When the root is
known, the sweep runs backwards in descending labels: each node sends its children what the rest of their proofs is,
block by block, down to the leaves.

No task holds more than a block, whatever share of the rows one tree has, and no epoch has more than one row a block
for the next: a tree of n leaves takes log(n) / log(block) epochs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsreports.llm.common import settle
from opsreports.operators.running import ordered_position

#: The children of a node, and the levels of an epoch; a block is FAN ** SPAN nodes.
FAN, SPAN = 2, 12


def leaf(*fields: Column) -> Column:
    """SHA-256 of the fields one after another: ``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    told = [F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")) for f in fields]
    return F.sha2(F.concat(*[F.coalesce(t, F.lit("-")) for t in told]), 256)


def siblings(proof: Column) -> Column:
    """All sibling digests of a proof, from the leaf's to the root's, left to right, as one text."""
    return F.translate(proof, ".;", "")


def folded(digest: Column, proof: Column) -> Column:
    """The root that a leaf digest and a proof lead to."""
    levels = F.filter(F.split(proof, ";"), lambda s: s != "")
    return F.aggregate(
        levels, digest, lambda d, s: F.sha2(F.concat(F.substring_index(s, ".", 1), d, F.substring_index(s, ".", -1)), 256)
    )


def _joined(digests: Sequence[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def sweep_up(first: int, digests: Sequence[str], fan: int, span: int) -> list[list[str]]:
    """Digests of a block's nodes, level by level from its own, by a queue ordered by label; ``first`` is a multiple of the block."""
    made: list[list[str]] = [list(digests), *[[] for _ in range(span)]]
    queue = [(1, (first + i) // fan, first + i, d) for i, d in enumerate(digests)] if span else []
    while queue:
        level, place = queue[0][:2]
        given = []
        while queue and queue[0][:2] == (level, place):
            given.append(heappop(queue)[3])
        digest = _joined(given)
        made[level].append(digest)
        if level < span:
            heappush(queue, (level + 1, place // fan, place, digest))
    return made


def whole_at(made: Sequence[Sequence[str]]) -> int:
    """The level at which one node is left."""
    return next(level for level, nodes in enumerate(made) if len(nodes) == 1)


def sweep_down(made: Sequence[Sequence[str]], fan: int, top: int, rest: str) -> list[str]:
    """Proofs of a block's own nodes, from the rest of the proof of its node at level ``top``; descending labels.

    A level of a proof is the digests on the left, a point, those on the right, and a semicolon. Places count from the
    block's start here: a block is aligned, so runs of children begin at the same nodes.
    """
    proofs: list[list[str]] = [[""] * len(nodes) for nodes in made]
    queue = [(-top, 0, rest)]
    while queue:
        level, place, proof = heappop(queue)
        level, place = -level, -place
        proofs[level][place] = proof
        if level:
            run = range(place * fan, min((place + 1) * fan, len(made[level - 1])))
            given = [made[level - 1][i] for i in run]
            for i, child in enumerate(run):
                heappush(queue, (1 - level, -child, f"{''.join(given[:i])}.{''.join(given[i + 1:])};{proof}"))
    return proofs[0]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows that agree in the first two columns (tree, block)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        at = 0
        for i, key in enumerate(keys):
            if key != last:
                if i > at:
                    held.append(batch.slice(at, i - at))
                if held:
                    yield pa.Table.from_batches(held)
                held, at, last = [], i, key
        if len(keys) > at:
            held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def _in_blocks(rows: DataFrame, size: int) -> DataFrame:
    return rows.withColumn("block", F.floor(F.col("at") / size))


def _up(nodes: DataFrame, fan: int, span: int) -> DataFrame:
    """(tree, block, part, whole) of nodes (tree, at, digest): a block's digest after a whole epoch, and at the level where one node is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _blocks(batches):
            made = sweep_up(t.column("at")[0].as_py(), t.column("digest").to_pylist(), fan, span)
            yield pa.RecordBatch.from_arrays(
                [t.column("tree").slice(0, 1).combine_chunks(), t.column("block").slice(0, 1).combine_chunks(),
                 pa.array([made[span][0]], pa.string()), pa.array([made[whole_at(made)][0]], pa.string())],
                names=["tree", "block", "part", "whole"],
            )

    slim = _in_blocks(nodes, fan**span).select("tree", "block", "at", "digest")
    return slim.repartition("tree", "block").sortWithinPartitions("tree", "block", "at").mapInArrow(
        run, "tree string, block bigint, part string, whole string"
    )


def _down(nodes: DataFrame, said: DataFrame, fan: int, span: int) -> DataFrame:
    """``nodes`` (tree, at, digest, kept columns) with ``proof``, ``subroot`` and ``root``.

    ``said``: rows (tree, block, alone, rest, subroot, root), what a block's node is told from above. They travel as messages
    that come before the block's nodes in the order of labels, so nothing is joined to the nodes.
    """
    kept = [c for c in nodes.columns if c not in ("tree", "at", "digest")]
    told = ["alone", "rest", "subroot", "root"]
    rows = _in_blocks(nodes, fan**span)
    none = {c: said.schema[c].dataType for c in told}
    rows = rows.select("tree", "block", "at", "digest", *[F.lit(None).cast(k).alias(c) for c, k in none.items()], *kept)
    heads = said.select("tree", "block", F.lit(-1).cast("bigint").alias("at"), F.lit(None).cast("string").alias("digest"), *told,
                        *[F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in kept])
    out = ["tree", "at", "digest", "proof", "subroot", "root"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _blocks(batches):
            alone, rest, subroot, root = (t.column(c)[0].as_py() for c in told)
            own = t.slice(1).combine_chunks()
            made = sweep_up(own.column("at")[0].as_py(), own.column("digest").to_pylist(), fan, span)
            proofs = sweep_down(made, fan, whole_at(made) if alone else span, rest)
            n = own.num_rows
            proof, subroots, roots = pa.array(proofs, pa.string()), pa.array([subroot] * n, pa.string()), pa.array([root] * n, pa.string())
            made_of = {"proof": proof, "subroot": subroots, "root": roots}
            yield from pa.table([made_of[c] if c in made_of else own.column(c) for c in [*out, *kept]], names=[*out, *kept]).to_batches()

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields} | {"proof": "string"}
    shape = ", ".join(f"`{c}` {kinds[c]}" for c in [*out, *kept])
    return heads.unionByName(rows).repartition("tree", "block").sortWithinPartitions("tree", "block", "at").mapInArrow(run, shape)


def _forest(nodes: DataFrame, fan: int, span: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Per epoch its nodes (tree, at, digest), and the roots (tree, digest) of the trees that end in it."""
    epochs, ended = [nodes], []
    while True:
        blocks = settle(_up(epochs[-1], fan, span), "blocks")
        many = blocks.where("block > 0").select("tree").distinct()
        ended.append(blocks.join(many, "tree", "left_anti").select("tree", F.col("whole").alias("digest")))
        going = settle(blocks.join(many, "tree", "left_semi").select("tree", F.col("block").alias("at"), F.col("part").alias("digest")), "epoch")
        if going.isEmpty():
            return epochs, ended
        epochs.append(going)


def _proofs(epochs: list[DataFrame], ended: list[DataFrame], above: DataFrame, fan: int, span: int) -> DataFrame:
    """The first epoch's nodes with their proofs, given (tree, rest, root) from above the trees."""
    down = None
    for nodes, roots in zip(reversed(epochs), reversed(ended), strict=True):
        said = roots.join(above, "tree").select(
            "tree", F.lit(0).cast("bigint").alias("block"), F.lit(True).alias("alone"), "rest", F.col("digest").alias("subroot"), "root"
        )
        if down is not None:
            said = said.unionByName(down.select(
                "tree", F.col("at").alias("block"), F.lit(False).alias("alone"), F.col("proof").alias("rest"), "subroot", "root"))
        down = _down(nodes, said, fan, span)
    return down


def manifest(
    df: DataFrame, digest: Column, group_col: str = "lang", order_col: str = "doc_id", keep: Sequence[Column] = (),
    fan: int = FAN, span: int = SPAN,
) -> DataFrame:
    """Rows (kept columns, leaf, subroot, root, proof), one for each row of ``df``.

    ``digest`` gives each row's leaf (see ``leaf``). Per value of the group, leaves ascend by the order column (null first, ties by
    leaf); while there are several nodes, every ``fan`` consecutive ones become the digest of their digests as hexadecimal
    text; the last run may have fewer, even one. What remains is the group's subroot. Subroots ordered by group (null first, then
    by bytes of its text) become the root likewise. ``proof`` tells ``siblings`` and leads to the root by ``folded``.

    Nulls in any column are values of their own, null groups one group. Repeated rows are leaves of their own next to
    each other. An empty table has no rows. Other columns don't matter. ``keep`` are columns of the result under their own
    names, which must not be tree, at, digest, block, proof, subroot, root, alone or rest.
    """
    group = F.col(group_col).cast("string")
    tree = F.coalesce(F.concat(F.lit("="), group), F.lit(""))
    rows = df.select(tree.alias("tree"), F.col(order_col).alias("_order"), digest.alias("digest"), *keep)
    names = rows.columns[3:]
    placed = ordered_position(rows, ["tree"], ["_order", "digest"], "_place")
    leaves = settle(placed.select("tree", (F.col("_place") - 1).alias("at"), "digest", *names), "leaves")
    epochs, ended = _forest(leaves.select("tree", "at", "digest"), fan, span)
    subroots = ended[0]
    for more in ended[1:]:
        subroots = subroots.unionByName(more)
    ranked = ordered_position(subroots.withColumn("_all", F.lit("")), ["_all"], ["tree"], "_place")
    tops = settle(ranked.select(F.col("_all").alias("tree"), (F.col("_place") - 1).alias("at"), "digest", F.col("tree").alias("group")), "subroots")
    above, over = _forest(tops.select("tree", "at", "digest"), fan, span)
    root = F.col("digest").alias("root")
    crown = over[-1].select("tree", F.lit("").alias("rest"), root)
    known = _proofs([tops, *above[1:]], over, crown, fan, span)
    known = settle(known.select(F.col("group").alias("tree"), F.col("proof").alias("rest"), "root"), "tops")
    found = _proofs([leaves, *epochs[1:]], ended, known, fan, span)
    return found.select(*names, F.col("digest").alias("leaf"), "subroot", "root", "proof")
