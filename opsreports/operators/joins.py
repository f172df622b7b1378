"""Joins and lookups.

Nothing is broadcast by hand: a side is broadcast by Spark when its size, estimated or
measured at run time, is under the session's threshold, and is sort-merged otherwise.
A side used only for membership or for one value per key is first brought down to one
row per key, which combines before its shuffle and can't fan out the other side. That side
is then shuffled for the join like any other (see ``reshuffled``), so that Spark can
split a hot key of the larger side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def reshuffled(side: DataFrame, *keys: str) -> DataFrame:
    """The same rows, shuffled afresh by the next join or aggregate on these keys.

    Adaptive execution splits a skewed partition only if both inputs of a join are plain
    shuffles, and takes the size of a side from its last one. An aggregated side hands its
    partitioning on and so would keep both from happening; rebuilt keys don't, and such a
    side is small. Likewise an aggregate by (key, part) must not settle for partitions
    by key alone, where all parts of a hot key would meet.
    """
    return side.withColumns({k: F.when(F.col(k).isNotNull(), F.col(k)) for k in keys})


def attach(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    columns: Mapping[str, str] | Sequence[str] = (),
    how: str = "left",
) -> DataFrame:
    """Join a dimension by ``{fact column: dim column}`` and keep the named columns of it.

    ``columns`` is a list, or ``{dim column: name in the result}``; renaming happens before
    the join, so one dimension can be attached twice.
    """
    wanted = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    keys = {f"_key{i}": pair for i, pair in enumerate(on.items())}
    side = dim.select(
        *[F.col(d).alias(k) for k, (_, d) in keys.items()], *[F.col(c).alias(n) for c, n in wanted.items()]
    )
    test = F.lit(True)
    for k, (f, _) in keys.items():
        test = test & (fact[f] == side[k])
    return fact.join(side, test, how).drop(*keys)


def attach_where(fact, dim, on, condition: Column, columns=(), how: str = "left") -> DataFrame:
    """Join whose ON clause also tests the dimension against constants."""
    return attach(fact, dim.where(condition), on, columns, how)


def attach_latest(fact: DataFrame, dim: DataFrame, on: Mapping[str, str], column: str, out: str) -> DataFrame:
    """Left join to the greatest value of a column per key."""
    (fact_key, dim_key), = on.items()
    latest = reshuffled(dim.groupBy(dim_key).agg(F.max(column).alias(out)), dim_key)
    return attach(fact, latest, {fact_key: dim_key}, [out])


def link_through(fact, bridge, dim, to_bridge, to_dim, columns) -> DataFrame:
    """Fact to dimension over a bridge table; a fact without a link stays."""
    linked = attach(fact, bridge, to_bridge, list(to_dim))
    return attach(linked, dim, to_dim, columns)


def _keys_of(df: DataFrame, column: str) -> DataFrame:
    members = df.select(F.col(column).alias("_member")).where(F.col("_member").isNotNull()).distinct()
    return reshuffled(members, "_member")


def keep_known(df: DataFrame, key: str, known: DataFrame, known_key: str) -> DataFrame:
    """Rows whose key occurs in the other frame."""
    members = _keys_of(known, known_key)
    return df.join(members, df[key] == members["_member"], "left_semi")


def drop_known(df: DataFrame, key: str, known: DataFrame, known_key: str) -> DataFrame:
    """Rows whose key does not occur in the other frame; a row without a key stays."""
    members = _keys_of(known, known_key)
    return df.join(members, df[key] == members["_member"], "left_anti")


def flag_known(
    df: DataFrame, key: str, known: DataFrame, known_key: str, out: str, yes: str = "Yes", no: str = "No"
) -> DataFrame:
    """Add yes or no by whether the key occurs in the other frame."""
    members = _keys_of(known, known_key)
    flagged = df.join(members, df[key] == members["_member"], "left")
    return flagged.withColumn(out, F.when(F.col("_member").isNotNull(), yes).otherwise(no)).drop("_member")


def _one_per_key(dim: DataFrame, key: str, columns: Mapping[str, str], order: Sequence[str], last: bool) -> DataFrame:
    pick = F.max_by if last else F.min_by
    rank = F.struct(*order)
    chosen = pick(F.struct(*[F.col(c).alias(n) for c, n in columns.items()]), rank)
    one = dim.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_member")).agg(chosen.alias("_chosen"))
    return reshuffled(one.select("_member", "_chosen.*"), "_member")


def lookup_first(
    df: DataFrame,
    key: str,
    dim: DataFrame,
    dim_key: str,
    columns: Mapping[str, str],
    order: Sequence[str],
    default: str | None = "",
    last: bool = False,
) -> DataFrame:
    """Values of the first matching row, in the given order; the default without a match.

    ``columns`` is ``{dim column: name in the result}``. A default of None leaves NULL.
    """
    one = _one_per_key(dim, dim_key, columns, order, last)
    found = df.join(one, df[key] == one["_member"], "left").drop("_member")
    if default is None:
        return found
    return found.withColumns({n: F.coalesce(F.col(n), F.lit(default)) for n in columns.values()})


def lookup_last(df, key, dim, dim_key, columns, order, default: str | None = "") -> DataFrame:
    """Values of the last matching row."""
    return lookup_first(df, key, dim, dim_key, columns, order, default, last=True)


def lookup_by_source(
    df: DataFrame, source: str, direct_sources: Sequence[str], direct: str, fallback: str, out: str
) -> DataFrame:
    """The direct value for some sources, the looked-up one (or ``''``) for the others."""
    other = F.coalesce(F.col(fallback), F.lit(""))
    return df.withColumn(out, F.when(F.col(source).isin(*direct_sources), F.col(direct)).otherwise(other))


def match_template(
    messages: DataFrame, text: str, templates: DataFrame, out: str, prefix: int = 5
) -> DataFrame:
    """Name of the first template whose opening characters begin the message.

    ``templates`` has name, text and ordinal. A template shorter than the prefix is
    compared by its own length, so an empty one matches any message. The distinct
    openings of the messages are matched by equality, once per length, not pair by pair.
    """
    openings = templates.select(F.left("text", F.lit(prefix)).alias("_opening"), "name", "ordinal")
    first = openings.groupBy("_opening").agg(F.min(F.struct("ordinal", "name")).alias("_first"))
    heads = messages.select(F.left(text, F.lit(prefix)).alias("_head")).where(F.col("_head").isNotNull()).distinct()
    tries = heads.select(
        "_head",
        F.explode(
            F.array_distinct(F.array(*[F.left("_head", F.lit(n)) for n in range(prefix + 1)]))
        ).alias("_opening"),
    )
    named = tries.join(first, "_opening").groupBy("_head").agg(F.min("_first").alias("_first"))
    named = reshuffled(named.select("_head", F.col("_first.name").alias(out)), "_head")
    joined = messages.join(named, F.left(messages[text], F.lit(prefix)) == named["_head"], "left").drop("_head")
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit("")))


def merge_counts(
    first: DataFrame, second: DataFrame, label: str, names: tuple[str, str], count: str = "n"
) -> DataFrame:
    """Full outer merge of two (label, count) frames; an absent side is 0."""
    a = first.select(label, F.col(count).alias(names[0]))
    b = second.select(label, F.col(count).alias(names[1]))
    return a.join(b, label, "full").na.fill(0, list(names))


def classify_membership(
    df: DataFrame,
    key: str,
    classes: Sequence[tuple[str, DataFrame, str]],
    out: str,
    default: str = " ",
) -> DataFrame:
    """Label of the first class whose key set holds the row's key.

    ``classes`` is (label, frame, key column) in order of priority. The key sets are
    merged to one row per key first, so the rows are joined once.
    """
    sets = None
    for rank, (label, frame, column) in enumerate(classes):
        part = _keys_of(frame, column).select("_member", F.struct(F.lit(rank), F.lit(label).alias("label")).alias("_c"))
        sets = part if sets is None else sets.unionByName(part)
    best = reshuffled(sets.groupBy("_member").agg(F.min("_c").getField("label").alias(out)), "_member")
    joined = df.join(best, df[key] == best["_member"], "left").drop("_member")
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(default)))


def replace_column(df: DataFrame, column: str, source: DataFrame, on: str) -> DataFrame:
    """Drop a column and take it from another frame by a shared key, left join."""
    return df.drop(column).join(source.select(on, column), on, "left")


def expand_members(df: DataFrame, column: str, out: str) -> DataFrame:
    """One row per member of a comma-joined list."""
    return df.withColumn(out, F.explode(F.split(F.col(column), ","))).drop(column)


def members_elsewhere(
    teams: DataFrame, team_city: str, members: str, staff: DataFrame, staff_id: str, staff_city: str
) -> DataFrame:
    """Listed members whose home is another city (or unknown): one row per city and staff row."""
    home = staff.select(F.col(staff_id).alias("member"), F.col(staff_city).alias("home_city"))
    listed = expand_members(teams, members, "member").select(team_city, "member").distinct()
    return listed.join(home, "member").where(~F.col("home_city").eqNullSafe(F.col(team_city)))


def member_home_counts(
    teams: DataFrame, team_city: str, members: str, staff: DataFrame, staff_id: str, staff_city: str
) -> DataFrame:
    """Per city: how many members are listed, and how many of them are at home elsewhere."""
    sizes = teams.select(team_city, F.size(F.split(F.col(members), ",")).alias("_n"))
    per_city = sizes.groupBy(team_city).agg(F.sum("_n").alias("members"))
    away = members_elsewhere(teams, team_city, members, staff, staff_id, staff_city)
    elsewhere = away.groupBy(team_city).agg(F.count("*").alias("other_city_members"))
    return per_city.join(elsewhere, team_city, "left").na.fill(0, ["other_city_members"])


def attach_slot_counts(slots: DataFrame, counts: DataFrame, on: Sequence[str], count: str) -> DataFrame:
    """Counts by slot on the slots at hand, 0 where there are none."""
    side = counts.select(*on, count)
    return slots.join(side, list(on), "left").na.fill(0, [count])
