"""Cross-source merge: exact key first, then decorated venues of the same event.

Both passes share one primitive, ``merge_groups``: the best-ranked row of a group
is the base and the rest fill its gaps in rank order.  A rank is one number, so which
row gives what is a hash aggregate of numbers, combined on the map side; the values are
fetched afterwards, by the rank of the row that gives them.

The second pass is a walk in rank order: each row joins the first kept row that it agrees with.  Rows
are settled in rounds, each round all that no unsettled row can still change, so there are as many rounds
as rows that wait for each other in a chain, however large a group is.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.text import blank, is_filled, match_key
from marquee.functions.values import MAX_IMAGES, MAX_TAGS, source_rank
from marquee.operators.ranking import top_per_group
from marquee.schema import RAW_COLUMNS
from marquee.session import cut_lineage, stage

# The rules of the second pass.
MIN_VENUE_KEY = 4
LAT_TOLERANCE = 0.004
LON_TOLERANCE = 0.005
VENUE_SUFFIX = r"\s*\([^)]*\)\s*$"
NAME_AT_VENUE = " @ "

# Sides of the cells that candidates are looked up in; a little over the tolerances, so near places are in neighbouring cells.
LAT_CELL, LON_CELL = 1.02 * LAT_TOLERANCE, 1.02 * LON_TOLERANCE
# Cell numbers of rows without a place, and of all rows together.
NO_PLACE, ANY_PLACE = -(1 << 40), 1 << 40

GAP_TEXTS = ["description", "address", "end_time"]
MATCH = ["canonical_city", "event_day", "name_key", "venue_key"]


def add_match_key(df: DataFrame) -> DataFrame:
    """Add city / day / name / venue keys; Songkick names end before the venue."""
    name = F.when((F.col("source") == "songkick") & F.col("name").contains(NAME_AT_VENUE),
                  F.substring_index("name", NAME_AT_VENUE, 1)).otherwise(F.col("name"))
    return df.withColumns({
        "event_day": F.to_date("start_local"),
        "name_key": match_key(name),
        "venue_key": match_key(F.col("location_name")),
    })


def add_fixed_fill(df: DataFrame) -> DataFrame:
    """Filled columns that merging cannot change; the rest is counted when ranking."""
    fixed = reduce(lambda a, b: a + b,
                   [is_filled(F.col(c)).cast("int") for c in RAW_COLUMNS if c not in GAP_TEXTS])
    return df.withColumn("fixed_fill", fixed)


def rank_columns() -> Column:
    """Best row first: most filled, best source, earliest."""
    score = F.col("fixed_fill") + F.when(F.col("lat").isNotNull(), 2).otherwise(0)
    for c in GAP_TEXTS:
        score = score + is_filled(F.col(c)).cast("int")
    return F.struct((-score).alias("score"), source_rank(F.col("source")).alias("prio"), F.col("_ord").alias("at"))


def rank_number() -> Column:
    """``rank_columns`` as one number, different for every row: a fixed-width value that hash aggregates can hold."""
    r = rank_columns()
    place = (r["score"] + 100) * 1000 + r["prio"]
    return (place.cast("decimal(9,0)") * F.lit(Decimal(1 << 64)) + r["at"].cast("decimal(20,0)")).cast("decimal(38,0)")


# What a base row may lack: by name, the condition under which a row has it, and the columns fetched from that row.
_GAPS = {c: (lambda c=c: is_filled(F.col(c)), [c]) for c in GAP_TEXTS} | {
    "point": (lambda: F.col("lat").isNotNull(), ["lat", "lon", "in_city"]),
    "end": (lambda: F.col("end_local").isNotNull(), ["end_local", "end_utc"]),
    "paid": (lambda: F.col("paid").isNotNull(), ["paid"]),
}


def merge_groups(df: DataFrame, key: list[str]) -> DataFrame:
    """One row per key: the base row with its gaps filled from the others.

    Adds ``n_merged`` (rows absorbed).  ``sources`` must be an array column.
    """
    # The rows are read several times below; cleaning them again each time costs more
    # than writing them once.
    ranked = stage(df.withColumn("__r", rank_number()))
    r = F.col("__r")
    groups = stage(ranked.groupBy(*key).agg(
        F.min(r).alias("__base"), F.min("_ord").alias("__first"), F.count(F.lit(1)).alias("__n"),
        *[F.min(F.when(has(), r)).alias(f"__from_{gap}") for gap, (has, _) in _GAPS.items()]))
    several = groups.filter("__n > 1")
    fills = _fetched(ranked, several)
    lists = _merged_lists(ranked, several, key)
    base = (ranked.withColumnRenamed("__r", "__base").join(groups.select("__base", "__first", "__n"), "__base")
            .join(fills, "__base", "left").join(lists, "__base", "left"))

    def gained(have: Column, items: Column, cap: int, low) -> Column:
        known = F.transform(have, low)
        new = F.filter(F.coalesce(items, F.array().cast("array<string>")), lambda x: ~F.array_contains(known, low(x)))
        return F.slice(F.concat(have, new), 1, cap)

    out = {c: F.col(c) for c in df.columns}
    for gap, (has, columns) in _GAPS.items():
        for c in columns:
            own = blank(F.col(c)) if c in GAP_TEXTS else F.col(c)
            out[c] = F.when(has(), F.col(c)).otherwise(F.when(F.col(f"__has_{gap}"), F.col(f"__{c}")).otherwise(own))
    out["images"] = gained(F.col("images"), F.col("__images"), MAX_IMAGES, lambda x: x)
    out["tags"] = gained(F.col("tags"), F.col("__tags"), MAX_TAGS, F.lower)
    out["sources"] = F.coalesce("__sources", F.array_sort(F.array_distinct("sources")))
    out["_ord"] = F.col("__first")
    return base.select(*[c.alias(n) for n, c in out.items()], (F.col("__n") - 1).alias("n_merged"))


def _fetched(ranked: DataFrame, several: DataFrame) -> DataFrame:
    """``__base`` with the values that other rows of its group give: ``__has_<gap>`` and ``__<column>``."""
    wanted = several.select("__base", *[F.nullif(f"__from_{g}", "__base").alias(f"__from_{g}") for g in _GAPS])
    wanted = wanted.filter(F.coalesce(*[f"__from_{g}" for g in _GAPS]).isNotNull())
    givers = wanted.select(F.explode(F.array(*[f"__from_{g}" for g in _GAPS])).alias("__r")).filter("__r is not null").distinct()
    given = stage(ranked.select("__r", *dict.fromkeys(c for _, columns in _GAPS.values() for c in columns)).join(givers, "__r"))
    out = wanted
    for gap, (_, columns) in _GAPS.items():
        values = given.select(F.col("__r").alias(f"__from_{gap}"), F.lit(True).alias(f"__has_{gap}"), *[F.col(c).alias(f"__{c}") for c in columns])
        # A base that lacks nothing here looks for a number of its own that no row has.
        own = F.coalesce(f"__from_{gap}", -F.col("__base") - 1)
        out = out.withColumn(f"__from_{gap}", own).join(values, f"__from_{gap}", "left").drop(f"__from_{gap}")
    return out


def _merged_lists(ranked: DataFrame, several: DataFrame, key: list[str]) -> DataFrame:
    """``__base`` with the first distinct images and tags of its group in rank order, and all its sources.

    The base's own items come first, so twice the cap is always enough to find the items the base lacks.  The items
    of a group are those few, one row each until they are put side by side.
    """
    def tagged(column: str, kind: str, low) -> Column:
        return F.transform(F.col(column), lambda x, i: F.struct(
            F.lit(kind).alias("kind"), low(x).alias("same"), x.alias("value"), i.alias("pos")))

    items = (
        ranked.select(*key, "__r", F.concat(tagged("images", "image", lambda x: x), tagged("tags", "tag", F.lower),
                                            tagged("sources", "source", lambda x: x)).alias("__items"))
        .join(several.select(*key, "__base"), key).select("__base", "__r", F.explode("__items").alias("__i"))
        .select("__base", "__r", "__i.kind", "__i.same", "__i.value", "__i.pos")
    )
    at = [F.col("__r"), F.col("pos")]
    distinct = top_per_group(items, ["__base", "kind", "same"], at)
    lists = F.col("kind") != "source"
    few = top_per_group(distinct.filter(lists), ["__base", "kind"], at, 2 * max(MAX_IMAGES, MAX_TAGS))
    side = Window.partitionBy("__base")
    listed = (few.unionByName(distinct.filter(~lists)).select(
        "__base", F.array_sort(F.collect_list(F.struct("__r", "pos", "kind", "value")).over(side)).alias("__l"),
        F.row_number().over(side.orderBy(*at, "kind")).alias("__no")).filter("__no = 1"))

    def of(kind: str) -> Column:
        return F.transform(F.filter("__l", lambda x: x["kind"] == kind), lambda x: x["value"])

    return listed.select("__base", of("image").alias("__images"), of("tag").alias("__tags"), F.array_sort(of("source")).alias("__sources"))


def merge_exact(df: DataFrame) -> DataFrame:
    """Pass 1: rows of equal city, day, name and venue become one."""
    return merge_groups(df, MATCH)


def add_venue_variants(df: DataFrame) -> DataFrame:
    """Venue key with and without a trailing ``(...)``, four characters at least."""
    return (
        df.withColumn("__bare", match_key(F.regexp_replace("location_name", VENUE_SUFFIX, "")))
        .withColumn("variants", F.filter(F.array_distinct(F.array(F.col("venue_key"), F.col("__bare"))),
                                         lambda x: F.length(x) >= MIN_VENUE_KEY))
        .drop("__bare")
    )


def venues_agree(a: Column, b: Column) -> Column:
    return F.exists(a, lambda x: F.exists(b, lambda y: F.contains(x, y) | F.contains(y, x)))


def far_apart(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Both places known and further apart than the tolerance."""
    return F.coalesce((F.abs(lat1 - lat2) > LAT_TOLERANCE) | (F.abs(lon1 - lon2) > LON_TOLERANCE), F.lit(False))


def same_event(a: Column, b: Column) -> Column:
    """Pair test inside a (city, day, name, start) group; arguments are structs."""
    return venues_agree(a["variants"], b["variants"]) & ~far_apart(a["lat"], a["lon"], b["lat"], b["lon"])


def related_names(posts: DataFrame) -> DataFrame:
    """``gid, name, other`` for the names of a group of which one contains the other, both ways and each with itself.

    A name that is contained in another shares all its four-letter pieces, so it is looked up by the one that fewest have.
    """
    names = stage(posts.select("gid", "name").distinct())
    places = F.sequence(F.lit(1), F.length("name") - MIN_VENUE_KEY + 1)
    pieces = stage(names.select("gid", "name", F.explode(F.array_distinct(F.transform(
        places, lambda i: F.substr(F.col("name"), i, F.lit(MIN_VENUE_KEY))))).alias("piece")))
    common = pieces.groupBy("gid", "piece").agg(F.count(F.lit(1)).alias("names"))
    rarest = top_per_group(pieces.join(common, ["gid", "piece"]), ["gid", "name"], [F.col("names"), F.col("piece")])
    inside = (rarest.select("gid", "piece", F.col("name").alias("other")).join(pieces, ["gid", "piece"])
              .filter(F.contains("name", "other")).select("gid", "name", "other"))
    return inside.union(inside.select("gid", F.col("other").alias("name"), F.col("name").alias("other"))).distinct()


def _cell(lat: Column, lon: Column) -> list[Column]:
    known = lat.isNotNull() & lon.isNotNull()
    return [F.when(known, F.floor(lat / LAT_CELL)).otherwise(NO_PLACE).alias("cx"), F.when(known, F.floor(lon / LON_CELL)).otherwise(0).alias("cy")]


def _cells_around() -> Column:
    """The cells of all rows that a row may agree with by place: those around its own and that of rows without a place."""
    near = F.flatten(F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda i: F.transform(
        F.sequence(F.lit(-1), F.lit(1)), lambda k: F.struct((F.col("cx") + i).alias("cx"), (F.col("cy") + k).alias("cy")))))
    one = [F.array(F.struct(F.lit(c).cast("bigint").alias("cx"), F.lit(0).cast("bigint").alias("cy"))) for c in (NO_PLACE, ANY_PLACE)]
    return F.when(F.col("cx") == NO_PLACE, one[1]).otherwise(F.concat(near, one[0]))


def assign_leaders(df: DataFrame) -> DataFrame:
    """``(_ord, leader)`` for every row that shares city, day, name and start with another.

    A row waits for the earlier rows that it may agree with.  It joins the first settled leader that accepts it as soon as no
    row before that leader is unsettled, and leads if no earlier row is left.  A leader without a place takes that of
    the first row with one that joins it; until then it accepts rows with a place one after the other, others at once.
    Waiting looks at names and cells only, which is never too short, and the first unsettled row of a group never waits.
    """
    group = ["canonical_city", "event_day", "name_key", "start_utc"]
    rows = df.filter(F.size("variants") > 0).select(*group, rank_number().alias("r"), "_ord", "variants", "lat", "lon")
    sizes = rows.groupBy(*group).agg(F.min("r").alias("gid"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = stage(rows.join(sizes, group).select("gid", "r", "_ord", "variants", "lat", "lon", *_cell(F.col("lat"), F.col("lon"))))
    posts = stage(rows.select("gid", "r", "cx", "cy", F.explode("variants").alias("name")))
    # What a row looks for: a name and a cell.
    looks = posts.join(related_names(posts), ["gid", "name"]).select("gid", "r", "cx", "cy", F.col("other").alias("name")).distinct()
    looks = stage(looks.select("gid", "r", "name", F.explode(_cells_around()).alias("c")).select("gid", "r", "name", "c.*"))
    key = ["gid", "name", "cx", "cy"]
    waiting = rows.select("r", "_ord", "lat", "lon")
    leaders = cut_lineage(waiting.withColumn("leader_ord", F.col("_ord")).limit(0))
    done = None

    def posted(of: DataFrame) -> DataFrame:
        """Names of rows in their own cell and in that of all rows."""
        cells = F.array(F.struct("cx", "cy"), F.struct(F.lit(ANY_PLACE).cast("bigint").alias("cx"), F.lit(0).cast("bigint").alias("cy")))
        own = posts.drop("cx", "cy").join(of.select("r", "lat", "lon", *_cell(F.col("lat"), F.col("lon"))), "r")
        return own.withColumn("c", F.explode(cells)).select("gid", "name", "c.*", F.col("r").alias("other"), F.col("lat").alias("lat_l"), F.col("lon").alias("lon_l"))

    while waiting.limit(1).count():
        looking = looks.join(waiting.select("r", "lat", "lon"), "r")
        first = posted(waiting).groupBy(*key).agg(F.min("other").alias("other"))
        before = looking.join(first, key).filter("other < r").groupBy("r").agg(F.min("other").alias("before"))
        # Leaders of one name and cell are few, as they are apart; of all cells together the first is enough.
        led = posted(leaders)
        any_place = F.col("cx") == ANY_PLACE
        led = led.filter(~any_place).unionByName(led.filter(any_place).groupBy(*key).agg(
            F.min("other").alias("other"), F.lit(None).cast("double").alias("lat_l"), F.lit(None).cast("double").alias("lon_l")))
        near = looking.join(led, key).filter((F.col("other") < F.col("r")) & ~far_apart(F.col("lat_l"), F.col("lon_l"), F.col("lat"), F.col("lon")))
        # Rows with a place that a leader without one may take: only the first of them knows what it meets.
        asks = F.col("lat").isNotNull() & F.col("lat_l").isNull()
        chosen = near.groupBy("r").agg(F.min("other").alias("leader"), F.min(F.when(asks, F.col("other"))).alias("asked"))
        next_ = near.filter(asks).groupBy("other").agg(F.min("r").alias("next")).withColumnRenamed("other", "asked")
        state = waiting.join(before, "r", "left").join(chosen, "r", "left").withColumn("asked", F.coalesce("asked", -F.col("r") - 1)).join(
            next_, "asked", "left")
        settled = F.col("before").isNull() | (F.col("leader") < F.col("before"))
        its_turn = F.coalesce((F.col("asked") != F.col("leader")) | (F.col("next") == F.col("r")), F.lit(True))
        leads, joins = F.col("leader").isNull() & F.col("before").isNull(), F.col("leader").isNotNull() & settled & its_turn
        state = cut_lineage(state.select("r", "_ord", "lat", "lon", "leader", F.when(joins, "joins").when(leads, "leads").otherwise("waits").alias("now")))
        joined = state.filter("now = 'joins'")
        gifts = joined.filter("lat is not null").select(F.col("leader").alias("r"), F.col("lat").alias("lat_g"), F.col("lon").alias("lon_g"), F.col("r").alias("from"))
        bare = leaders.filter("lat is null").join(gifts.groupBy("r").agg(F.min("from").alias("from")), "r", "left").join(
            gifts.select("from", "lat_g", "lon_g"), "from", "left").select(
            "r", "_ord", F.col("lat_g").alias("lat"), F.col("lon_g").alias("lon"), "leader_ord")
        settled_now = joined.select("_ord", "leader", "r").join(leaders.select(F.col("r").alias("leader"), "leader_ord"), "leader").select(
            "_ord", F.col("leader_ord").alias("leader"))
        fresh = state.filter("now = 'leads'").select("r", "_ord", "lat", "lon", F.col("_ord").alias("leader_ord"))
        settled_now = settled_now.unionByName(fresh.select("_ord", F.col("leader_ord").alias("leader")))
        done = settled_now if done is None else done.unionByName(settled_now)
        leaders = cut_lineage(leaders.filter("lat is not null").unionByName(bare).unionByName(fresh))
        waiting = state.filter("now = 'waits'").select("r", "_ord", "lat", "lon")
    return done if done is not None else rows.select("_ord", F.col("_ord").alias("leader"))


def merge_decorated(df: DataFrame) -> DataFrame:
    """Pass 2: same event whose venues differ only by decoration."""
    rows = add_venue_variants(df)
    leaders = cut_lineage(assign_leaders(rows))
    plain = rows.drop("variants")
    kept = plain.join(leaders, "_ord", "left")
    several = leaders.groupBy("leader").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("leader")
    alone = kept.join(several, "leader", "left_anti").drop("leader").withColumn("n_merged_2", F.lit(0).cast("bigint"))
    pass_one = F.col("n_merged")
    grouped = kept.join(several, "leader", "left_semi")
    absorbed = grouped.groupBy("leader").agg(F.sum(pass_one).alias("__p1"))
    merged = (merge_groups(grouped.drop("n_merged"), ["leader"])
              .withColumnRenamed("n_merged", "n_merged_2").join(absorbed, "leader")
              .withColumnRenamed("__p1", "n_merged").drop("leader"))
    return alone.unionByName(merged)


def merge_sources(df: DataFrame) -> DataFrame:
    """Both passes.  ``n_merged`` and ``n_merged_2`` account for every absorbed row."""
    rows = df if "sources" in df.columns else df.withColumn("sources", F.array("source"))
    return merge_decorated(stage(merge_exact(add_match_key(add_fixed_fill(rows)))))


def merge_counts(rows_in: DataFrame, merged: DataFrame) -> DataFrame:
    """One row: rows read, events kept, rows merged by each pass."""
    zero = F.lit(0).cast("bigint")
    read = rows_in.select(F.lit(1).alias("read"), F.lit(0).alias("kept"), zero.alias("one"), zero.alias("two"))
    kept = merged.select(F.lit(0).alias("read"), F.lit(1).alias("kept"), F.col("n_merged").alias("one"),
                         F.col("n_merged_2").alias("two"))
    return read.union(kept).agg(F.sum("read").alias("rows_in"), F.sum("kept").alias("events_out"),
                                F.sum("one").alias("merged_exact"), F.sum("two").alias("merged_fuzzy"))
