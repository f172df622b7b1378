"""Near-duplicate vectors by dual traversal of cover trees."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsreports.llm.common import components, settle

LEAST_RADIUS = 2.0**-20


class CoverTree:
    """A cover tree over unit vectors, level by level.

    The root covers all. A node's children are chosen among its points so that each point lies within the level's radius, half of
    the level above, of its child, and the children's centres lie farther apart than that; the
    node's own centre is the first child (nested levels). ``reach`` is the true largest distance from a
    centre to a point below it, which prunes more than the level's radius.
    """

    def __init__(self, unit: np.ndarray):
        self.unit = unit
        self.centre, self.reach, self.children = [], [], []
        if len(unit):
            self._grow(np.arange(len(unit)))

    def _node(self, centre: int, members: np.ndarray) -> int:
        self.centre.append(centre)
        self.reach.append(float(self._far(centre, members).max()) if len(members) > 1 else 0.0)
        self.children.append(np.zeros(0, np.int64))
        return len(self.centre) - 1

    def _far(self, centre: int, members: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, 2 - 2 * (self.unit[members] @ self.unit[centre])))

    def _grow(self, everything: np.ndarray) -> None:
        todo = [(self._node(0, everything), everything, 1.0)]
        while todo:
            node, members, radius = todo.pop()
            own, left = [], members
            first = self.centre[node]
            while len(left):
                centre = first if not own else int(left[0])
                near = self._far(centre, left) <= radius if radius > LEAST_RADIUS else left == centre
                near |= left == centre
                inside, left = left[near], left[~near]
                own.append(self._node(centre, inside))
                if len(inside) > 1:
                    todo.append((own[-1], inside, radius / 2))
            self.children[node] = np.array(own)

    def below(self, node: int) -> np.ndarray:
        return self.children[node] if len(self.children[node]) else np.array([node])


def close_pairs(a: CoverTree, b: CoverTree, distance: float, rows: int = 512):
    """Yields index arrays (i, j) that hold every pair of points within ``distance`` and few beyond it, by dual traversal.

    A pair of nodes is left out with all below when their centres lie farther apart than the
    distance and both reaches together. With ``a is b`` each unordered pair comes once.
    """
    same = a is b
    if not a.centre or not b.centre:
        return
    ca, cb, ra, rb = (np.array(x) for x in (a.centre, b.centre, a.reach, b.reach))
    todo = [(0, 0)]
    if len(a.unit) == 1 and len(b.unit) == 1:
        todo = [] if same else todo
    while todo:
        p, q = todo.pop()
        left, right = a.below(p), b.below(q)
        for lo in range(0, len(left), rows):
            part = left[lo : lo + rows]
            apart = np.sqrt(np.maximum(0.0, 2 - 2 * (a.unit[ca[part]] @ b.unit[cb[right]].T)))
            keep = apart <= distance + ra[part][:, None] + rb[right][None, :]
            if same and p == q:
                keep &= part[:, None] <= right[None, :]
            i, j = np.nonzero(keep)
            i, j = part[i], right[j]
            leaf_i = np.array([len(a.children[x]) == 0 for x in i], bool)
            leaf_j = np.array([len(b.children[x]) == 0 for x in j], bool)
            ends = leaf_i & leaf_j
            if same:
                yield ca[i[ends & (i != j)]], cb[j[ends & (i != j)]]
            else:
                yield ca[i[ends]], cb[j[ends]]
            todo.extend(zip(i[~ends].tolist(), j[~ends].tolist(), strict=True))


def _link(group: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links inside one pair of blocks: per vector, how many vectors it is linked to and the smallest one reached here."""
    group = group.sort_values("rep", ignore_index=True)
    raw = np.stack(group["vector"].to_list()).astype(np.float64)
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)
    norm = np.sqrt(np.einsum("ij,ij->i", scaled, scaled))
    unit = scaled / norm[:, None]
    sides = [np.flatnonzero(group["block"].to_numpy() == x) for x in (group["lo"].iloc[0], group["hi"].iloc[0])]
    trees = [CoverTree(unit[sides[0]])]
    trees.append(trees[0] if group["lo"].iloc[0] == group["hi"].iloc[0] else CoverTree(unit[sides[1]]))
    heads, tails = [], []
    for i, j in close_pairs(*trees, np.sqrt(2 - 2 * threshold) + 1e-7):
        i, j = sides[0][i], sides[1][j]
        for lo in range(0, len(i), 50_000):
            x, y = i[lo : lo + 50_000], j[lo : lo + 50_000]
            good = np.einsum("ij,ij->i", scaled[x], scaled[y]) / (norm[x] * norm[y]) >= threshold
            heads.append(x[good])
            tails.append(y[good])
    i = np.concatenate(heads) if heads else np.zeros(0, np.int64)
    j = np.concatenate(tails) if tails else np.zeros(0, np.int64)
    copies = group["copies"].to_numpy()
    links = np.bincount(i, copies[j], len(group)) + np.bincount(j, copies[i], len(group))
    root = np.arange(len(group))
    while True:  # smallest label along links, with shortcuts
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            break
    ids, some = group["rep"].to_numpy(), links > 0
    return pd.DataFrame({"rep": ids[some], "links": links[some].astype(np.int64), "root": ids[root][some]})


def near_vectors(
    df: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", block: int = 2048,
) -> DataFrame:
    """Rows (id, n_links, component_id, kept): vectors of equal label linked where their cosine is at least ``threshold``.

    Equal vectors of a label are brought down to one, with their number. A label's distinct vectors are dealt into
    as many blocks as keep each to about ``block``; every pair of blocks is one group of bounded size, which builds
    a cover tree for each block and walks both at once. A group returns a row per linked vector,
    not per pair; link counts are summed and the rows joined to components.

    Null labels, vectors that are null, zero, or hold nulls or non-finite values, and null ids link with nothing
    (component: the row's own id). Vectors of different lengths aren't compared. Repeated rows are one
    vector. One row per distinct row id of the input; other columns are ignored. An empty table gives none.
    """
    kind = df.schema[id_col].dataType.simpleString()
    vector, finite = F.col("vector"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label"))
    valid = rows.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(
        F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)
    ).distinct()
    # Equal values up to the sign of zero are one vector.
    valid = valid.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    distinct = settle(
        valid.groupBy("label", "vector").agg(F.min("id").alias("rep"), F.count("*").alias("copies")).withColumn("width", F.size("vector")), "vectors"
    )
    sizes = distinct.groupBy("label", "width").count().select("label", "width", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    dealt = distinct.join(sizes, ["label", "width"]).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "label", "width", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "rep", "copies", "vector"
    )
    found = settle(
        paired.groupBy("label", "width", "lo", "hi").applyInPandas(lambda g: _link(g, threshold), f"rep {kind}, links long, root {kind}"), "links"
    )
    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    grouped = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    reps = distinct.join(linked, "rep", "left").join(grouped.withColumnRenamed("node", "rep"), "rep", "left").select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    own = valid.join(reps, ["label", "vector"]).groupBy("id").agg(F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    return rows.select("id").distinct().join(own, "id", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "id") == F.col("id"), F.lit(True)).alias("kept"),
    )
