"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests. DataFrame functions only.

A sketch has cells in three parts. Each distinct paragraph digest goes to one cell of each part: the cell counts
it, and keeps the exclusive or of its digests and of their check hashes. Two sketches subtract cell by cell;
what both texts share cancels out. A cell left with one digest is pure and gives it away; taking it out of its
other cells makes more cells pure. If this peeling stops early, it is tried again with larger sketches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsreports.llm.common import in_order, settle

# A paragraph ends with its line, and after a sentence whose last letter is one of these: long lines are cut by content.
PARAGRAPH_END = r"\n|(?<=[aeiou][.!?]) "
# Words of spaced scripts (8 code points at most, longer ones in parts) with the space after them; each character of scripts without spaces; space at the start.
# The two ranges hold neither space nor scripts without spaces; they spare most characters the seven lookups of their script.
UNIT = r"(?s)[\x21-\x7E\x80-\u0DFF[^\s\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]]{1,8}+\s*|."
# One of so many distinct units ends a paragraph, and no paragraph is longer than so many code points.
EVERY, LONGEST = 16, 256
CELLS = 24
#: How often each part of a sketch gives its pure cells away. Every step keeps pages of memory in the task and goes over all cells, so sketches are
#: roomy, with one sweep: three cells of each part a digest leave about one in 5000 digests, whose ids are tried again.
SWEEPS, ROOM = 1, 3
#: Cells that a task takes on at most, but for those of one id.
ROWS_A_TASK = 1 << 18
#: The place of rows that hold a digest given away.
NO_CELL = -1


def digests(text: Column) -> Column:
    """Digests of the distinct paragraphs of a text, in ascending order; null has none."""
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), PARAGRAPH_END, -1), lambda p: p != "")
    return F.sort_array(F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p))))


def even_digests(text: Column) -> Column:
    """Digests as of ``digests``, of lines cut after units chosen by their hash, in proportion to a text's length in any script.

    What is left over ``LONGEST`` code points (a word of that length, few words over and over) is cut at multiples of it.
    """
    def pieces(line):
        ends = lambda u: F.pmod(F.xxhash64(F.rtrim(u), F.lit("end")), F.lit(EVERY)) == 0
        marked = F.array_join(F.transform(F.regexp_extract_all(line, F.lit(UNIT), F.lit(0)), lambda u: F.when(ends(u), F.concat(u, F.lit("\n"))).otherwise(u)), "")
        short = lambda p: F.length(p) <= LONGEST
        return F.flatten(F.transform(F.split(marked, "\n"), lambda p: F.when(short(p), F.array(p)).otherwise(
            F.regexp_extract_all(p, F.lit(f"(?s).{{1,{LONGEST}}}"), F.lit(0)))))

    parts = F.flatten(F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), pieces))
    return F.sort_array(F.array_distinct(F.transform(F.filter(F.transform(parts, lambda p: F.rtrim(p)), lambda p: p != ""), lambda p: F.xxhash64(p))))


def _check(e: Column) -> Column:
    return F.xxhash64(F.lit("check"), e)


def _place(e: Column, part: int, third: Column, seed: int) -> Column:
    return (part * third + F.pmod(F.xxhash64(e, F.lit(seed * 3 + part)), third)).cast("int")


def _xor(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a.bitwiseXOR(b))


def _let(value: Column, body) -> Column:
    """``body`` of a value computed once; an expression used twice inside a lambda would be computed anew each time."""
    return F.transform(F.array(value), body)[0]


def sketch(elements: Column, cells: int = CELLS, seed: int = 0) -> Column:
    """Cells array<struct<n, k, c>> of the digests: a text's fingerprint."""
    none = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("c"))
    third = cells // 3

    def part(entries, p):
        own = lambda c: F.filter(entries, lambda x: x[f"at{p}"] == c)
        add = lambda a, x: F.struct((a["n"] + 1).alias("n"), a["k"].bitwiseXOR(x["e"]).alias("k"), a["c"].bitwiseXOR(x["c"]).alias("c"))
        return F.transform(F.sequence(F.lit(p * third), F.lit(p * third + third - 1)), lambda c: F.aggregate(own(c), none, add))

    entries = F.transform(
        elements, lambda e: F.struct(e.alias("e"), _check(e).alias("c"), *[_place(e, p, F.lit(third), seed).alias(f"at{p}") for p in range(3)])
    )
    return _let(entries, lambda es: F.concat(*[part(es, p) for p in range(3)]))


def parity(digests: Column) -> Column:
    """A difference estimator of 64 bits: how often, odd or even, a digest's hash names each bit."""
    return _xor(F.transform(digests, lambda e: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(F.lit("bit"), e), F.lit(64)).cast("int"))))


def estimate(a: Column, b: Column) -> Column:
    """About how many digests differ, from two parities: exact for few; all there are when the bits tell no more (an expression of the lists)."""
    apart = F.bit_count(parity(a).bitwiseXOR(parity(b)))
    most = F.size(a) + F.size(b)
    return F.when(apart < 28, F.least(most, F.ceil(F.log(1 / (1 - apart / 32.0)) * 32).cast("int"))).otherwise(most)


def _merged(rows: DataFrame) -> DataFrame:
    """Cells added up: counts by sum, digests and checks by exclusive or. What has cancelled out goes."""
    total = rows.groupBy("id", "pair", "third", "cell", "out").agg(F.expr("sum(n) AS n"), F.expr("bit_xor(k) AS k"), F.expr("bit_xor(c) AS c"))
    return total.where("n <> 0 OR k <> 0 OR c <> 0")


def peel(lists: DataFrame, pairs: int, seed: int) -> DataFrame:
    """(id, ok_0, plus_0, minus_0, ok_1, ...): digests that came out of the subtracted sketches of each pair of lists.

    ``lists``: (id, lists), hash-partitioned by the unique id, ``lists`` an array of structs (pair, third, a, b): the sketch of a pair has three
    parts of ``third`` cells. A cell is a row, and every step an aggregate by id and cell, so nothing is shuffled and no row holds more than
    a cell. A step lets the pure cells of one part give their digest away; a digest has one cell in each part, so none is given twice.
    Ids whose pairs don't differ have no row.
    """
    # The same places and checks as in ``sketch``, as SQL: a plan of so many steps is built faster from it.
    check = "xxhash64('check', k)"
    place = [f"CAST({p} * third + pmod(xxhash64(k, {seed * 3 + p}), third) AS INT)" for p in range(3)]
    row = lambda cell, out, n, k, c: f"named_struct('cell', {cell}, 'out', {out}, 'n', {n}, 'k', {k}, 'c', {c})"
    signed = "concat(transform(l.a, e -> struct(1L AS n, e AS k)), transform(l.b, e -> struct(-1L AS n, e AS k)))"
    each = lists.selectExpr("id", "explode(lists) AS l").selectExpr("id", "l.pair", "l.third", f"explode({signed}) AS e")
    each = each.selectExpr("id", "pair", "third", "e.n", "e.k").selectExpr("*", f"{check} AS c", "0L AS out")
    rows = _merged(each.selectExpr("*", f"explode_outer(array({', '.join(place)})) AS cell"))
    for step in range(3 * SWEEPS):
        part = step % 3
        pure = f"cell >= 0 AND cell DIV third = {part} AND abs(n) = 1 AND c = {check}"
        given = [row(NO_CELL, "k", "n", "0L", "0L"), *[row(place[p], "0L", "-n", "k", "c") for p in range(3) if p != part]]
        kept = f"explode_outer(IF({pure}, array({', '.join(given)}), array({row('cell', 'out', 'n', 'k', 'c')}))) AS r"
        rows = _merged(rows.selectExpr("id", "pair", "third", kept).selectExpr("id", "pair", "third", "r.*"))
    made = []
    for j in range(pairs):
        out = f"pair = {j} AND cell = {NO_CELL} AND n"
        made.append(f"sum(IF(pair = {j} AND (cell <> {NO_CELL} OR abs(n) <> 1), 1, 0)) = 0 AS ok_{j}")
        made += [f"collect_list(IF({out} = {n}, out, NULL)) AS {name}_{j}" for name, n in (("plus", 1), ("minus", -1))]
    return rows.groupBy("id").agg(*[F.expr(m) for m in made])


def differences(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """(id, <name>, <name>_try): for each named pair of digest lists of ``df``, struct<plus, minus> of what only the first and only the second has.

    ``df``: a settled frame with a unique ``id``. The first sketches (try 0) are sized by an estimate of the difference, ``ROOM`` cells of each part a digest
    and at least ``CELLS`` in all; empty cells are no rows. Ids with a sketch that doesn't peel off whole are tried again by other hashes with room for twice all digests (try 1). Should even
    that fail (a colliding hash), the difference of the lists themselves is taken (try 2), so the result is always whole. Each try is written.
    Ids whose pairs don't differ have no row.
    """
    named = list(pairs.items())
    many = sum(F.size(a) + F.size(b) for _, (a, b) in named)

    def tried(rows, room, seed, label):
        sized = lambda j, a, b: F.struct(F.lit(j).alias("pair"), room(F.col(a), F.col(b)).cast("int").alias("third"), F.col(a).alias("a"), F.col(b).alias("b"))
        total = rows.agg(F.sum(many)).first()[0] or 0
        # Cells are dealt by id into tasks of bounded size before they become rows.
        slim = rows.repartition(max(1, -(-3 * total // ROWS_A_TASK)), "id")
        return settle(peel(slim.select("id", F.array(*[sized(j, a, b) for j, (_, (a, b)) in enumerate(named)]).alias("lists")), len(named), seed), label)

    def first_room(a, b):
        return F.greatest(F.lit(CELLS // 3), estimate(a, b) * ROOM)

    def result(j, oks, last=None):
        took = [F.when(F.col(f"{o}ok_{j}"), F.struct(F.col(f"{o}plus_{j}").alias("plus"), F.col(f"{o}minus_{j}").alias("minus"))) for o, _ in oks]
        which = [F.when(F.col(f"{o}ok_{j}"), F.lit(n)) for o, n in oks]
        name, (a, b) = named[j]
        if last is not None:
            took.append(F.struct(F.array_except(a, b).alias("plus"), F.array_except(b, a).alias("minus")))
            which.append(F.lit(last))
        return [F.coalesce(*took).alias(name), F.coalesce(*which).alias(f"{name}_try")]

    first = tried(df, first_room, 0, "peeled")
    whole = F.lit(True)
    for j in range(len(named)):
        whole = whole & F.col(f"ok_{j}")
    failed = first.where(~whole)
    lists = list(dict.fromkeys(c for p in pairs.values() for c in p))
    again = settle(df.select("id", *lists).join(failed.select("id"), "id", "left_semi"), "again")
    good = first.where(whole).select("id", *[x for j in range(len(named)) for x in result(j, [("", 0)])])
    if again.isEmpty():
        return good
    second = tried(again, lambda a, b: (F.size(a) + F.size(b)) * 2 * ROOM + CELLS, 1, "peeled")

    old = failed.select("id", *[F.col(c).alias(f"first_{c}") for c in first.columns if c != "id"])
    retried = again.join(old, "id").join(second, "id", "left")
    return good.unionByName(retried.select("id", *[x for j in range(len(named)) for x in result(j, [("first_", 0), ("", 1)], 2)]))


def likeness(a: Column, b: Column, difference: Column) -> Column:
    """Shared digests by all digests, from the sizes and the difference; 1 for two texts without any."""
    both, apart = F.size(a) + F.size(b), F.size(difference["plus"]) + F.size(difference["minus"])
    return F.when(both == 0, 1.0).otherwise((both - apart) / (both + apart))


def written(cells: Column) -> Column:
    """A sketch as text: each cell's count, digest and check in hexadecimal."""
    return F.array_join(
        F.transform(cells, lambda x: F.when(x["n"] == 0, F.lit("")).otherwise(F.concat_ws("-", F.hex(x["n"]), F.lower(F.hex(x["k"])), F.substring(F.lower(F.hex(x["c"])), 1, 8)))), "."
    )


def versions(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: Callable[[Column], Column] = digests) -> DataFrame:
    """Rows (id, n_chars, text, edited, own, changed, following): each document, its edited version, and digests of both and of the next document.

    Edited: the last quarter of the code points (rounded down) gives way to as many from the start of the next
    document in ascending id, or all it has; after the last comes the first. Rows that repeat an id are one
    document, of their shortest text (ties: the smaller); null ids have no place in the order and are left
    out; null text is empty.
    """
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("id IS NOT NULL")
    slim = rows.groupBy("id").agg(F.min(F.length("text")).alias("n"))
    placed = settle(in_order(slim, ["id"], take=["id"]), "order")
    first = placed.agg(F.min("id").alias("id")).first()["id"]
    feeds = placed.select(F.coalesce("next_id", F.lit(first)).alias("id"), F.col("id").alias("before"), F.floor(F.col("n") / 4).cast("int").alias("share"))
    # Digested before the rows are dealt out, so that a text's digests are made once, for itself and for the document before it.
    own = F.struct(F.length("text").alias("n"), "text", digests(F.col("text")).alias("own"))
    texts = rows.groupBy("id").agg(F.min(own).alias("t")).select("id", "t.n", "t.text", "t.own")
    given = texts.join(feeds, "id").select(F.col("before").alias("id"), F.substring("text", F.lit(1), F.col("share")).alias("head"), F.col("own").alias("following"))
    kept = F.substring("text", F.lit(1), F.col("n") - F.floor(F.col("n") / 4).cast("int"))
    both = texts.join(given, "id").select("id", F.col("n").cast("long").alias("n_chars"), "text", F.concat(kept, "head").alias("edited"), "own", "following")
    return both.withColumn("changed", digests(F.col("edited")))


def compare_versions(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: Callable[[Column], Column] = digests, take: dict[str, Column] | None = None
) -> DataFrame:
    """Documents with the digests of ``versions``, the sketches of text and edited text, the digests in which these differ (``to_edited``), and
    those in which the text and the next document's differ (``to_next``), with the try that told each.

    ``digests``: how texts are cut and digested, also ``even_digests``. ``take``: columns to carry, made of ``text`` and ``edited``, by default these two.
    """
    made = {"text": F.col("text"), "edited": F.col("edited")} if take is None else take
    rows = versions(df, id_col, text_col, digests).select("id", "n_chars", *[c.alias(name) for name, c in made.items()], "own", "changed", "following")
    rows = settle(rows, "versions")
    apart = differences(rows, {"to_edited": ("own", "changed"), "to_next": ("own", "following")})
    same = F.struct(F.array().cast("array<bigint>").alias("plus"), F.array().cast("array<bigint>").alias("minus"))
    told = {name: F.coalesce(name, same) for name in ("to_edited", "to_next")}
    out = rows.join(apart, "id", "left").withColumns({**told, **{f"{name}_try": F.coalesce(f"{name}_try", F.lit(0)) for name in told}})
    return out.withColumns({f"{c}_cells": sketch(F.col(c)) for c in ("own", "changed")}).withColumnRenamed("id", id_col)
