"""Rows of any alias schema -> display events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.text import display_clean, location_line
from marquee.functions.times import add_lenient, date_range, has_clock, long_date, short_time, time_range

# Fixed value: title of an event without one.
UNTITLED = "Untitled Event"


def display_events(rows: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``pick_aliases`` rows -> title, date, time, location, description, image, url."""
    staged = rows.withColumn("clock_raw", F.when(F.col("time_raw") != "", F.col("time_raw")).otherwise(
        F.col("start_raw")))
    for src, out in (("start_raw", "__s"), ("clock_raw", "__c"), ("end_raw", "__e"), ("end_date_raw", "__d")):
        staged = add_lenient(staged, src, out)
    timed = has_clock(F.col("time_raw")) | has_clock(F.col("start_raw"))
    staged = staged.withColumns({
        "start_clock": F.when(timed, short_time(F.col("clock_raw"), F.col("__c"))).otherwise(""),
        "end_clock": short_time(F.col("end_raw"), F.col("__e")),
        "start_long": long_date(F.col("start_raw"), F.col("__s")),
        "end_long": long_date(F.col("end_date_raw"), F.col("__d")),
        "clean_title": display_clean(F.col("title")),
    })
    return staged.select(
        *carry,
        F.when(F.col("clean_title") != "", F.col("clean_title")).otherwise(UNTITLED).alias("title"),
        date_range(F.col("start_raw"), F.col("start_long"), F.col("end_date_raw"), F.col("end_long")).alias("date"),
        time_range(F.col("start_clock"), F.col("end_clock")).alias("time"),
        location_line(F.col("venue"), F.col("address"), F.col("city")).alias("location"),
        display_clean(F.col("description")).alias("description"), "image", "url")
