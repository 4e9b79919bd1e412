"""Host recency, cadence, influence and ranking inside groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.operators.ranking import top_per_group
from marquee.operators.vectors import member_scores

# Cadence limits (days) and labels, weights of recency and cadence.
CADENCE_LIMITS = [(2, "daily"), (10, "weekly"), (20, "biweekly"), (45, "monthly")]
CADENCE_REST = "occasional"
CADENCE_SINGLE = "one-off"
CADENCE_WEIGHTS = {
    "daily": 1.0, "weekly": 0.9, "biweekly": 0.7, "monthly": 0.5, "occasional": 0.3, "one-off": 0.1,
}
CADENCE_UNKNOWN_WEIGHT = 0.2
RECENT_DAYS, RECENT_WEIGHT = 90, 1.0
YEAR_DAYS, YEAR_WEIGHT = 365, 0.5
OLD_WEIGHT = 0.1


def last_past_event(df: DataFrame, host: str, date: str, reference) -> DataFrame:
    """Latest date per host that is not after the reference."""
    at = F.lit(reference).cast("timestamp_ntz")
    return df.filter(F.col(date) <= at).groupBy(host).agg(F.max(date).alias("last_event"))


def host_gaps(df: DataFrame, host: str, date: str) -> DataFrame:
    """Whole-day gaps between a host's consecutive dates as ``(host, gap_days, times)``.

    Rows are combined to one per host and day first: all gaps inside a day are zero
    days, and only the gap from a day's last to the next day's first date is left.
    The window therefore sees days, not events, however busy a host is.
    """
    days = (df.filter(F.col(date).isNotNull())
            .groupBy(host, F.to_date(date).alias("day"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(date).alias("first"), F.max(date).alias("last")))
    w = Window.partitionBy(host).orderBy("day")
    gap = F.col("gap")
    days = days.withColumn("gap", F.timestamp_diff("DAY", F.lag("last").over(w), F.col("first")))
    return days.select(host, F.explode(F.array(
        F.struct(F.lit(0).cast("bigint").alias("gap_days"), (F.col("n") - 1).alias("times")),
        F.struct(gap.alias("gap_days"), F.when(gap.isNotNull(), 1).otherwise(0).cast("bigint").alias("times")),
    )).alias("g")).select(host, "g.gap_days", "g.times").filter("times > 0")


def cadence_label(median_gap: Column) -> Column:
    out = F.when(median_gap.isNull(), CADENCE_SINGLE)
    for limit, label in CADENCE_LIMITS:
        out = out.when(median_gap <= limit, label)
    return out.otherwise(CADENCE_REST)


def cadence(df: DataFrame, host: str, date: str) -> DataFrame:
    """``(host, median_gap, frequency)`` over all dated events, past and future.

    Equal gaps are counted first, so the exact median works on (gap, times).
    """
    counted = host_gaps(df, host, date).groupBy(host, "gap_days").agg(F.sum("times").alias("times"))
    medians = counted.groupBy(host).agg(F.percentile("gap_days", 0.5, F.col("times")).alias("median_gap"))
    hosts = df.filter(F.col(host).isNotNull()).select(host).distinct()
    return hosts.join(medians, host, "left").withColumn("frequency", cadence_label(F.col("median_gap")))


def host_activity(df: DataFrame, host: str, date: str, reference) -> DataFrame:
    """``(host, last_event, frequency)``; a host without past events has no last event."""
    return cadence(df, host, date).drop("median_gap").join(last_past_event(df, host, date, reference), host, "left")


def attach_activity(df: DataFrame, host: str, date: str, reference) -> DataFrame:
    """Every event with its host's ``last_event`` and ``frequency``; null hosts match nothing."""
    known = df.filter(F.col(host).isNotNull()).join(host_activity(df, host, date, reference), host, "left")
    return known.unionByName(df.filter(F.col(host).isNull()), allowMissingColumns=True).select(
        *known.columns)


def influence(count: Column, last_event: Column, frequency: Column, reference) -> Column:
    """Events x recency weight x cadence weight, four decimals."""
    age = F.date_diff(F.lit(reference).cast("date"), F.to_date(last_event))
    recency = (F.when(last_event.isNull(), 0.0).when(age <= RECENT_DAYS, RECENT_WEIGHT)
               .when(age <= YEAR_DAYS, YEAR_WEIGHT).otherwise(OLD_WEIGHT))
    weights = F.create_map(*[F.lit(x) for kv in CADENCE_WEIGHTS.items() for x in kv])
    weight = F.coalesce(F.try_element_at(weights, F.lower(frequency)), F.lit(CADENCE_UNKNOWN_WEIGHT))
    return F.round(count * recency * weight, 4)


def rank_events(df: DataFrame, group: list[str], reference, id_col: str = "id", k: int = 3,
                count_col: str | None = None, vector: str = "embedding") -> DataFrame:
    """Top events of every group by half representativeness, half raw influence."""
    count = F.coalesce(F.col(count_col).cast("int"), F.lit(1)) if count_col else F.lit(1)
    last = F.col("last_event") if "last_event" in df.columns else F.lit(None).cast("timestamp_ntz")
    freq = F.coalesce("frequency", F.lit("occasional")) if "frequency" in df.columns else F.lit("occasional")
    scored = member_scores(df, group, vector).withColumn("influence", influence(count, last, freq, reference))
    scored = scored.withColumn("combined", 0.5 * F.col("representativeness") + 0.5 * F.col("influence"))
    best = top_per_group(scored, group, [F.desc("combined"), F.col(id_col)], k, rank_col="rank")
    return best.select(*group, id_col, *[F.round(c, 4).alias(c)
                                         for c in ("combined", "representativeness", "influence")], "rank")


def _most_common(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Most common value per key, the smallest on a tie, nulls not counted."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("__n"))
    return counts.groupBy(*keys).agg(F.min_by(column, F.struct((-F.col("__n")).alias("n"), column)).alias(column))


def rank_hosts(df: DataFrame, group: str, host: str, reference, k: int | None = 5, order: str = "id",
               event_type: str = "event_type", vector: str = "embedding",
               contacts: tuple[str, ...] = ()) -> DataFrame:
    """Hosts of every group by the mean of match and activity, one row per host.

    match: the host's most central event.  activity: influence on the number of
    events inside the group, scaled to 0..1 inside the group (1 when all are equal).
    """
    keys = [group, host]
    rows = member_scores(df.filter(F.col(group).isNotNull()), [group], vector).filter(F.col(host).isNotNull())
    firsts = [F.min_by(c, order).alias(c) for c in contacts]
    per_host = rows.groupBy(*keys).agg(
        F.max("representativeness").alias("match"), F.count(F.lit(1)).alias("events_in_this_group"),
        F.max("last_event").alias("last_event"), *firsts)
    types = (rows.filter(F.col(event_type).isNotNull()).select(*keys, event_type).distinct().groupBy(*keys)
             .agg(F.array_join(F.array_sort(F.collect_list(event_type)), ", ").alias("event_types")))
    full = per_host.join(_most_common(rows, keys, "frequency"), keys, "left").join(types, keys, "left")
    raw = influence(F.col("events_in_this_group"), F.col("last_event"),
                    F.coalesce("frequency", F.lit("occasional")), reference)
    full = full.withColumn("raw", raw)
    span = full.groupBy(group).agg(F.min("raw").alias("__lo"), F.max("raw").alias("__hi"))
    spread = F.col("__hi") - F.col("__lo")
    scaled = full.join(span, group).withColumn(
        "activity", F.when(spread > 0, (F.col("raw") - F.col("__lo")) / spread).otherwise(1.0))
    out = scaled.select(
        group, host, F.col("events_in_this_group").cast("int").alias("events_in_this_group"),
        F.coalesce("event_types", F.lit("")).alias("event_types"),
        F.round("match", 3).alias("match_score"), F.round("raw", 3).alias("raw_influence_score"),
        F.round("activity", 3).alias("activity_score"),
        F.round(0.5 * F.col("match") + 0.5 * F.col("activity"), 3).alias("priority_score"), *contacts)
    if k is None:
        return out
    return top_per_group(out, [group], [F.desc("priority_score"), F.col(host)], k)
