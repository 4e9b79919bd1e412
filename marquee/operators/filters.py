"""Row filters, each with the count of what it drops where the count is part of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.text import blank, is_filled, strip_wide
from marquee.functions.times import add_moment
from marquee.functions.values import split_list
from marquee.schema import RAW_COLUMNS


def required_ok(df: DataFrame) -> Column:
    """Every listing column exists and the name and start time are filled."""
    if any(c not in df.columns for c in RAW_COLUMNS):
        return F.lit(False)
    return is_filled(F.col("name")) & is_filled(F.col("start_time"))


def keep_valid(df: DataFrame) -> DataFrame:
    return df.filter(required_ok(df))


def check_counts(df: DataFrame) -> DataFrame:
    """One row: rows kept and dropped by the required-column check."""
    ok = required_ok(df)
    return df.agg(F.count_if(ok).alias("kept"), F.count_if(~ok).alias("dropped"))


def keep_parsed(df: DataFrame, prefix: str = "start") -> DataFrame:
    return df.filter(F.col(f"{prefix}_local").isNotNull())


def in_day_window(day: Column, start, end=None) -> Column:
    """Day inside the window; bounds in either order, a missing end equals the start."""
    if start is None and end is None:
        return F.lit(True)
    if start is None:
        return F.coalesce(day <= F.lit(end).cast("date"), F.lit(False))
    lo = F.lit(start).cast("date")
    hi = F.lit(end).cast("date") if end is not None else lo
    return F.coalesce(day.between(F.least(lo, hi), F.greatest(lo, hi)), F.lit(False))


def keep_days(df: DataFrame, tz: Column, start=None, end=None, source: str = "start_time") -> DataFrame:
    """Rows whose local start day is in the window, with that day as ``local_day``."""
    dated = add_moment(df, source, "__w", tz).withColumn("local_day", F.to_date("__w_local"))
    return dated.filter(in_day_window(F.col("local_day"), start, end)).drop("__w_local", "__w_utc", "__w_has_time")


def is_event_type(type_text: Column) -> Column:
    """The ``@type`` (text, or JSON text of a list) names some kind of event."""
    return F.lower(blank(type_text)).contains("event")


def lacks_coordinate_text(lat: Column) -> Column:
    return strip_wide(blank(lat)).isin("", "0")


def keep_members(df: DataFrame, **allowed) -> DataFrame:
    """Rows whose columns hold one of the allowed values, e.g. ``state=["NY"]``."""
    for column, values in allowed.items():
        df = df.filter(F.col(column).isin(*values))
    return df


def has_tag(tags_text: Column, tag: str) -> Column:
    return F.array_contains(split_list(tags_text), tag)


def in_rolling_window(day: Column, today, months: int) -> Column:
    """From ``months`` before today's midnight up to it; a moment later today is out."""
    t = F.lit(today).cast("date")
    return day.between(F.add_months(t, -months), t)


def keep_year(df: DataFrame, year_col: str = "event_year", year: int | None = None,
              current_year: int | None = None) -> DataFrame:
    """Rows of a year; by default the current year when present, else the last one."""
    if year is not None:
        return df.filter(F.col(year_col) == year)
    pick = df.agg(F.coalesce(F.max(F.when(F.col(year_col) == F.lit(current_year), F.col(year_col))),
                             F.max(year_col)).alias("__year"))
    return df.join(F.broadcast(pick), F.col(year_col) == F.col("__year")).drop("__year")


def mark_small_groups(df: DataFrame, group: str, min_rows: int) -> DataFrame:
    """Add ``group_status``: ``ok`` or ``skipped (too few events)``.

    The size comes from a pre-aggregated count joined back, not from a window, so
    no task ever holds a whole group.
    """
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("__n"))
    status = F.when(F.col("__n") >= min_rows, "ok").otherwise("skipped (too few events)")
    return df.join(sizes, group).withColumn("group_status", status).drop("__n")


def mapped_counts(df: DataFrame, columns=("latitude", "longitude", "primary_category")) -> DataFrame:
    """One row: how many rows can be put on a map, and how many there are."""
    ok = F.lit(True)
    for c in columns:
        ok = ok & F.col(c).isNotNull()
    return df.agg(F.count_if(ok).alias("mapped"), F.count(F.lit(1)).alias("total"))


