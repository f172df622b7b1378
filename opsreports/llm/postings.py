"""Benchmark decontamination with a positional inverted index of the training tokens. DataFrame functions only.

The index is a written table of postings: a row for each token, with its term, its document and its place. A phrase is
found by lists: the lists of its two rarest terms, each moved back by the term's offset in the phrase, are intersected, which
leaves few places; there the lists of all its other terms are intersected likewise. What is left is where the phrase
stands, exactly. Terms are ranked by their counts in the whole index, so the lists of common words are only looked up
in documents that the rare ones have left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsreports.llm.common import settle
from opsreports.operators.joins import reshuffled

#: Words of a phrase window.
LENGTH = 10
_UPPER, _LOWER = "".join(map(chr, range(0x41, 0x5B))), "".join(map(chr, range(0x61, 0x7B)))
_OTHER = "".join(chr(c) for c in range(0x80) if not (0x30 <= c <= 0x39 or 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A))
#: The term of the posting that each row has behind its last word; its place is the number of words.
END = ""
DOC = ["d1", "d2"]


def words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text with A-Z in lower case; null has none."""
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER + _OTHER, _LOWER + " " * len(_OTHER))
    return F.array_remove(F.split(plain, " "), "")


def store(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", terms: DataFrame | None = None) -> DataFrame:
    """Writes the index: postings (id, d1, d2, term, at), and one with the term ``END`` at the number of words for each row.

    d1 and d2 are hashes that tell documents by id and text, so rows that repeat an id with another text are documents of their own, and
    equal rows are one. ``terms``: a frame of distinct terms, column ``term``; only postings of these are kept, as an index for known
    questions needs no others.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumns(
        {"d1": F.xxhash64("id", "text"), "d2": F.xxhash64(F.lit(1), "text", "id")}
    )
    tokens = rows.select("id", *DOC, F.posexplode(F.array_append(words(F.col("text")), F.lit(END))).alias("at", "term"))
    if terms is not None:
        asked = terms.select("term").union(df.sparkSession.range(1).select(F.lit(END)))
        tokens = tokens.join(settle(asked, "terms"), "term")
    return settle(tokens.select("id", *DOC, "term", F.col("at").cast("bigint").alias("at")), "postings")


def windows(df: DataFrame, id_col: str = "item_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Distinct (item, phrase): every run of ``length`` words of an item, or all its words if it has fewer, joined by spaces."""
    items = df.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    k = F.least(F.size("w"), F.lit(length))
    starts = items.select("item", "w", k.alias("k"), F.explode(F.sequence(F.lit(1), F.size("w") - k + 1)).alias("s"))
    return starts.select("item", F.array_join(F.slice("w", F.col("s"), F.col("k")), " ").alias("phrase")).distinct()


def _ranked(postings: DataFrame, phrases: DataFrame) -> DataFrame:
    """(phrase, k, offset, term, rank) of phrases whose terms all occur; the rarest term has rank 1, ties by offset."""
    counts = postings.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    terms = phrases.select("phrase", F.posexplode(F.split("phrase", " ")).alias("offset", "term"))
    of = Window.partitionBy("phrase")
    known = terms.join(reshuffled(counts, "term"), "term", "left").withColumns(
        {"k": F.count(F.lit(1)).over(of), "known": F.count("n").over(of), "rank": F.row_number().over(of.orderBy("n", "offset"))}
    )
    return settle(known.where("known = k").select("phrase", "k", F.col("offset").cast("bigint").alias("offset"), "term", "rank"), "ranked")


def phrase_places(postings: DataFrame, phrases: DataFrame) -> DataFrame:
    """Settled rows (d1, d2, phrase, k, start): every place at which a phrase (column ``phrase``, words joined by a space) stands."""
    ranked = _ranked(postings, phrases.select("phrase").distinct())
    rare = ranked.where("rank <= 2")
    # Settled, so that their sizes are known before the whole index is dealt out for a join.
    heads = settle(rare.select("term").distinct(), "rare")
    moved = postings.join(heads, "term", "left_semi").join(rare, "term").where(F.col("at") >= F.col("offset")).select(
        *DOC, "phrase", "k", (F.col("at") - F.col("offset")).alias("start"), "rank"
    )
    both = moved.groupBy(*DOC, "phrase", "k", "start").agg(F.bit_or("rank").alias("ranks"))
    left = settle(both.where(F.col("ranks") == F.when(F.col("k") == 1, 1).otherwise(3)).drop("ranks"), "candidates")
    # The other lists, only of documents that are still in question; a place needs each of its terms where the phrase has it.
    asked = left.join(ranked.where("rank > 2").drop("k"), "phrase").withColumn("at", F.col("start") + F.col("offset"))
    docs = settle(left.select(*DOC).distinct(), "left")
    lists = postings.where(F.col("term") != END).join(docs, DOC, "left_semi").select(*DOC, "term", "at")
    there = asked.join(lists, [*DOC, "term", "at"], "left_semi")
    full = there.groupBy(*DOC, "phrase", "k", "start").agg(F.count(F.lit(1)).alias("n")).where("n = k - 2").drop("n")
    return settle(left.where("k <= 2").unionByName(full), "places")


def near_places(postings: DataFrame, groups: DataFrame, span: int) -> DataFrame:
    """Rows (d1, d2, group, start): each place of a term of the group from which all its terms lie within ``span`` words, in any order.

    ``groups``: rows (group, term); a group with a term that doesn't occur is nowhere. The list of the group's rarest term says which
    documents are looked at.
    """
    wanted = groups.select("group", "term").distinct()
    counts = postings.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    of = Window.partitionBy("group")
    ranked = settle(wanted.join(reshuffled(counts, "term"), "term", "left").withColumns(
        {"k": F.count(F.lit(1)).over(of), "known": F.count("n").over(of), "rank": F.row_number().over(of.orderBy("n", "term"))}
    ).where("known = k").select("group", "term", "k", "rank"), "groups")
    rarest = settle(postings.join(ranked.where("rank = 1").select("group", "term"), "term").select(*DOC, "group").distinct(), "rarest")
    lists = postings.join(ranked, "term").join(rarest, [*DOC, "group"], "left_semi")
    lists = lists.select(*DOC, "group", "term", "k", "at").distinct()
    ahead = Window.partitionBy(*DOC, "group").orderBy("at").rangeBetween(0, span - 1)
    return lists.withColumn("seen", F.size(F.collect_set("term").over(ahead))).where("seen = k").select(*DOC, "group", F.col("at").alias("start"))


def decontaminate(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", length: int = LENGTH,
) -> DataFrame:
    """Rows (id, n_words, n_hit, spans, items) for every row of ``docs``.

    A word is hit if it lies in an occurrence of a window of an item: ``length`` consecutive words, or all of an item that
    has fewer, but not none. ``spans`` are the maximal runs of hit words, structs (start, end), counted in words from 0, end
    exclusive; ``items`` the ids of the items with such windows, as text in ascending order. Both are empty where nothing is hit.

    Null texts have no words. Null ids stay; rows that repeat an id are told apart by their text; equal rows give equal rows. An
    item without id marks words but isn't listed. Empty tables: no documents, or nothing hit. Other columns don't matter.
    """
    members = settle(windows(items, item_col, item_text, length), "windows")
    phrases = members.select("phrase").distinct()
    terms = phrases.select(F.explode(F.split("phrase", " ")).alias("term")).distinct()
    postings = store(docs, id_col, text_col, terms)
    places = phrase_places(postings, phrases)
    named = places.select(*DOC, "phrase").distinct().join(members, "phrase").groupBy(*DOC).agg(
        F.array_sort(F.collect_set("item")).alias("items"))
    runs = places.select(*DOC, "start", (F.col("start") + F.col("k")).alias("end")).distinct()
    inner = Window.partitionBy(*DOC).orderBy("start", "end")
    reach = F.max("end").over(inner.rowsBetween(Window.unboundedPreceding, -1))
    fresh = runs.withColumn("fresh", F.when(F.col("start") <= reach, 0).otherwise(1))
    spans = fresh.withColumn("run", F.sum("fresh").over(inner)).groupBy(*DOC, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    spans = spans.groupBy(*DOC).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"), F.sum(F.col("end") - F.col("start")).alias("n_hit"))
    found = reshuffled(spans.join(named, DOC, "left"), *DOC)
    rows = postings.where(F.col("term") == END).select("id", *DOC, F.col("at").alias("n_words")).join(found, DOC, "left")
    none = found.schema["spans"].dataType
    return rows.select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("spans", F.array().cast(none)).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
