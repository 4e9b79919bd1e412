"""Counts, shares, top-k, histograms and summaries of the dashboard and the publisher."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.text import blank, strip_wide
from marquee.functions.values import percent_label, share_percent
from marquee.operators.hosts import _most_common
from marquee.operators.ranking import top_rows

# Labels and limits of the dashboard.
OTHER = "Other"
TOP_CATEGORIES = 5
TOP_CITIES = 20
TAG_SHARE = 5.0
HISTOGRAM_MONTHS = 12
MULTIPLE_SOURCES = "Multiple"
SCHEMA_NOTE = ("isPaid null = unknown (not free); endTime null = source does not publish it; "
               "inCityArea false = suburb within search radius")
FILL_FIELDS = ["description", "venue", "address", "latitude", "endTime", "category", "image", "url"]


def kpis(df: DataFrame, **distinct: str) -> DataFrame:
    """One row: ``rows`` and a distinct count per keyword (name=column); nulls do not count.

    Each distinct column is aggregated on its own rows of an expanded plan, so the
    counts combine on the map side.
    """
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_distinct(c).alias(n) for n, c in distinct.items()])


def total_rows(df: DataFrame) -> Column:
    """Row count as a scalar subquery."""
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


def category_shares(df: DataFrame, column: str) -> DataFrame:
    """Value counts with their share of all rows; null rows count only in the total."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("percentage", share_percent(F.col("n"), total_rows(df)))


def with_label(shares: DataFrame) -> DataFrame:
    return shares.withColumn("percentage", percent_label(F.col("percentage")))


def explode_tags(df: DataFrame, column: str = "tags") -> DataFrame:
    return df.filter(F.col(column).isNotNull()).select(
        F.explode(F.split(F.col(column), ",")).alias("tag")).withColumn("tag", strip_wide(F.col("tag")))


def tag_shares(df: DataFrame, column: str = "tags", above: float = TAG_SHARE) -> DataFrame:
    """Tags carried by more than ``above`` percent of all rows."""
    counts = explode_tags(df, column).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
    share = counts.withColumn("__share", F.col("n") * F.lit(100.0) / total_rows(df)).filter(F.col("__share") > above)
    return share.withColumn("percentage", F.bround("__share", 1)).drop("__share")


def distinct_tags(df: DataFrame, column: str = "tags") -> DataFrame:
    return explode_tags(df, column).distinct()


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted option list of a column."""
    return df.filter(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def top_categories(df: DataFrame, column: str, k: int = TOP_CATEGORIES) -> DataFrame:
    """The k most frequent categories with their place; ``Other`` goes last."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    best = top_rows(counts, [F.desc("n"), F.col(column)], k)
    # The list is at most k rows, so sorting its collected form is bounded.
    listed = best.agg(F.array_sort(F.collect_list(F.struct(
        (F.col(column) == OTHER).alias("last"), (-F.col("n")).alias("less"), F.col(column).alias(column)))).alias("l"))
    return listed.select(F.posexplode("l").alias("pos", "x")).select(
        F.col(f"x.{column}").alias(column), (-F.col("x.less")).alias("n"), (F.col("pos") + 1).alias("place"))


def complete(counts: DataFrame, spine: DataFrame, keys: list[str], column: str = "n") -> DataFrame:
    """Every spine row, with 0 where there is no count."""
    return spine.join(counts, keys, "left").withColumn(column, F.coalesce(column, F.lit(0).cast("bigint")))


def category_months(df: DataFrame, column: str, date: str, today, k: int = TOP_CATEGORIES) -> DataFrame:
    """Monthly counts of the top categories on a full twelve-month spine."""
    best = top_categories(df, column, k).select(column, "place")
    spine = best.select("*", F.explode(F.sequence(
        F.add_months(F.trunc(F.lit(today).cast("date"), "month"), 1 - HISTOGRAM_MONTHS),
        F.trunc(F.lit(today).cast("date"), "month"), F.expr("interval 1 month"))).alias("month"))
    counts = df.groupBy(column, F.to_date(F.date_trunc("month", date)).alias("month")).agg(
        F.count(F.lit(1)).alias("n"))
    return complete(counts, spine, [column, "month"])


def months_of_year(df: DataFrame, date: str) -> DataFrame:
    """Twelve rows ``(month_no, month, n)`` in calendar order."""
    counts = df.groupBy(F.month(date).alias("month_no")).agg(F.count(F.lit(1)).alias("n"))
    spine = df.sparkSession.range(1, 13).select(
        F.col("id").cast("int").alias("month_no"),
        F.date_format(F.make_date(F.lit(2000), F.col("id").cast("int"), F.lit(1)), "MMMM").alias("month"))
    return complete(counts, spine, ["month_no"])


def top_cities(df: DataFrame, column: str = "city", k: int = TOP_CITIES) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return top_rows(counts, [F.desc("n"), F.col(column)], k)


def most_common(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Most common value of each column per key; all-null gives null."""
    out = df.filter(F.col(key).isNotNull()).select(key).distinct()
    for c in columns:
        out = out.join(_most_common(df.filter(F.col(key).isNotNull()), [key], c), key, "left")
    return out


def state_summary(df: DataFrame, group: str = "state") -> DataFrame:
    """Per state: events and the number of topic, place and final groups, with its status."""
    def groups(column: str) -> Column:
        return F.count_distinct(F.when(F.col(column) != "noise", F.col(column)))

    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("events"), groups("semantic_cluster_label").alias("semantic_groups"),
        groups("spatial_cluster_label").alias("spatial_groups"), groups("fused_cluster").alias("final_groups"),
        F.max("group_status").alias("status"))


def group_members(df: DataFrame, group: str = "fused_cluster", host: str = "host_name") -> DataFrame:
    """Events and distinct hosts per final group."""
    return df.filter(F.col(group) != "noise").groupBy(group).agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct(host).alias("hosts"))


def source_key(sources: Column) -> Column:
    return F.when(F.size(sources) == 1, sources[0]).otherwise(F.lit(MULTIPLE_SOURCES))


def publish_counts(events: DataFrame) -> DataFrame:
    """Counts by city, date and source plus the flags, as ``(facet, key, n)`` rows.

    One pass: every event is expanded to its facet keys and counted once.
    """
    def facet(name: str, key: Column) -> Column:
        return F.struct(F.lit(name).alias("facet"), key.cast("string").alias("key"))

    paid = F.when(F.col("isPaid").isNull(), "priceUnknown").when(F.col("isPaid"), "paid").otherwise("free")
    keys = F.array(
        facet("cities", F.col("city")), facet("dates", F.col("date")),
        facet("sources", source_key(F.col("sources"))), facet("flag", paid),
        facet("flag", F.when(F.col("latitude").isNotNull(), F.lit("withCoordinates"))),
        facet("flag", F.lit("totalEvents")))
    return (events.select(F.explode(keys).alias("k")).filter("k.key is not null")
            .groupBy("k.facet", "k.key").agg(F.count(F.lit(1)).alias("n")))


def publish_meta(events: DataFrame, generated_at) -> DataFrame:
    """The one-row meta block: totals and the three count maps."""
    counts = publish_counts(events)

    def flag(name: str) -> Column:
        return F.coalesce(F.sum(F.when((F.col("facet") == "flag") & (F.col("key") == name), F.col("n"))),
                          F.lit(0).cast("bigint")).alias(name)

    def as_map(name: str) -> Column:
        # One entry per city, day or source: the size of the published report.
        return F.map_from_entries(F.array_sort(F.collect_list(F.when(
            F.col("facet") == name, F.struct(F.col("key"), F.col("n")))))).alias(name)

    return counts.agg(
        F.date_format(F.lit(generated_at).cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("generatedAt"),
        flag("totalEvents"), as_map("cities"), as_map("dates"), as_map("sources"),
        flag("paid"), flag("free"), flag("priceUnknown"), flag("withCoordinates"), F.lit(SCHEMA_NOTE).alias("schemaNote"))


def fill_rates(events: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """``(field, filled, total, percent)`` with the percent rounded down, in one pass."""
    fields = fields or FILL_FIELDS
    one = events.agg(F.count(F.lit(1)).alias("total"),
                     *[F.count_if(blank(F.col(f).cast("string")) != "").alias(f) for f in fields])
    rows = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("filled")) for f in fields]))
    return one.select("total", rows.alias("r")).select(
        "r.field", "r.filled", "total",
        F.expr("100 * r.filled div greatest(1, total)").alias("percent"))


def ingest_summary(rows: DataFrame, tasks: DataFrame) -> DataFrame:
    """Rows per (site, day) task; tasks without rows stay with 0 and ``written`` false."""
    counts = rows.groupBy("site", "day").agg(F.count(F.lit(1)).alias("n"))
    return complete(counts, tasks, ["site", "day"]).withColumn("written", F.col("n") > 0)


