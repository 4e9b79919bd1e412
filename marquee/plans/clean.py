"""Raw listings of many sources -> published events, meta block and audit report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from marquee.functions.text import DESCRIPTION_LIMIT, add_clean_text, blank, title_case
from marquee.functions.times import add_moment, display_time, iso_with_offset
from marquee.functions.values import (
    add_coordinates, distinct_tags, event_id, image_list, in_box, price_flag, primary_and_tags, secure_link, source_label,
)
from marquee.operators.aggregates import FILL_FIELDS, publish_meta
from marquee.operators.filters import required_ok
from marquee.operators.joins import attach_city
from marquee.operators.merge import merge_sources
from marquee.session import stage
from marquee.sources.sinks import flat_events


@dataclass
class CleanRun:
    """The tables of one cleaning run.

    The events are merged and written to the run's staged tables when the run is made; what is read here
    comes from there, and the report's counts were taken on the way.
    """

    events: DataFrame
    meta: DataFrame
    report: DataFrame


def type_listings(raw: DataFrame, cities: DataFrame, whole_urls: bool = False) -> DataFrame:
    """Typed columns for every raw row; ``valid`` marks rows that pass the required check.

    Nothing is filtered here, so the same rows feed the events and the audit counts.
    """
    checked = raw.withColumn("valid", required_ok(raw))
    text = add_coordinates(add_clean_text(checked, {
        "name": F.col("name"), "description": F.col("description"), "location_name": F.col("location_name"),
        "address": F.col("address"), "__area": F.col("city"), "__primary": F.col("primary_category"),
    }, {"description": DESCRIPTION_LIMIT}, {"__parts": F.col("secondary_categories")}))
    placed = attach_city(text, cities).withColumn("__tags", distinct_tags(F.col("__parts")))
    timed = add_moment(add_moment(placed, "start_time", "start", F.col("tz")), "end_time", "end", F.col("tz"))
    primary, tags = primary_and_tags(F.col("__primary"), F.col("__tags"))
    return timed.withColumns({
        "end_local": F.when(F.col("end_has_time"), F.col("end_local")),
        "end_utc": F.when(F.col("end_has_time"), F.col("end_utc")),
        "venue_area": title_case(F.col("__area")),
        "category": primary,
        "tags": tags,
        "in_city": in_box(F.col("lat"), F.col("lon"), F.col("lat_lo"), F.col("lat_hi"), F.col("lon_lo"), F.col("lon_hi")),
        "url": secure_link(F.col("external_link")),
        "images": image_list(F.col("thumbnail_image"), F.col("additional_images"), whole_urls),
        "paid": price_flag(F.col("is_paid")),
    }).drop("__area", "__primary", "__tags", "__parts", "end_has_time", "lat_lo", "lat_hi", "lon_lo", "lon_hi", "tz")


def usable(typed: DataFrame) -> DataFrame:
    """Rows of known cities that pass the required check and have a start."""
    return typed.filter(F.col("valid") & F.col("canonical_city").isNotNull() & F.col("start_local").isNotNull()).drop("valid")


def published_record(merged: DataFrame) -> DataFrame:
    """The published record with ``_ord`` and the numbers of merged rows."""
    def given(c: str) -> Column:
        return F.nullif(blank(F.col(c)), F.lit(""))

    return merged.select(
        event_id(F.col("canonical_city"), F.col("event_day"), F.col("name_key"), F.col("venue_key")).alias("id"),
        F.col("name"), given("description").alias("description"), given("location_name").alias("venue"),
        given("address").alias("address"), F.col("canonical_city").alias("city"),
        given("venue_area").alias("venueArea"), F.col("lat").alias("latitude"), F.col("lon").alias("longitude"),
        F.col("in_city").alias("inCityArea"), F.col("event_day").alias("date"),
        F.when(F.col("start_has_time"), iso_with_offset(F.col("start_local"), F.col("start_utc"))).alias("startTime"),
        iso_with_offset(F.col("end_local"), F.col("end_utc")).alias("endTime"),
        F.col("start_has_time").alias("hasTime"),
        display_time(F.col("start_local"), F.col("start_has_time")).alias("displayTime"),
        given("category").alias("category"), F.col("tags"), F.try_element_at("images", F.lit(1)).alias("image"),
        F.col("images"), given("url").alias("url"), F.col("paid").alias("isPaid"),
        F.transform("sources", source_label).alias("sources"), "_ord", "n_merged", "n_merged_2")


def publish_order(record: DataFrame) -> DataFrame:
    return record.orderBy("city", "date", F.coalesce("startTime", F.lit("")), "name", "_ord").drop("_ord")


def _input_counts() -> list[Column]:
    """Counts over all typed rows: what came in, was dropped, and what is left."""
    known = F.col("canonical_city").isNotNull()
    ok = F.col("valid") & known
    alive = ok & F.col("start_local").isNotNull()
    return [
        F.count(F.lit(1)).alias("load.rows"), F.count_if(~known).alias("load.unknown_city"), F.count_if(ok).alias("schema.kept"),
        F.count_if(known & ~F.col("valid")).alias("schema.dropped"), F.count_if(ok & F.col("start_local").isNull()).alias("time.dropped"),
        F.count_if(alive & ~F.col("in_city")).alias("geo.outside"),
        F.count_if(alive & F.col("paid")).alias("price.paid"), F.count_if(alive & ~F.col("paid")).alias("price.free"),
        F.count_if(alive & F.col("paid").isNull()).alias("price.unknown"), F.count_if(alive).alias("dedupe.rows_in")]


def _output_counts() -> list[Column]:
    """Counts over the published events, with what each was merged from."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("bigint"))
    return [F.count(F.lit(1)).alias("dedupe.events_out"), total("n_merged").alias("dedupe.merged_exact"),
            total("n_merged_2").alias("dedupe.merged_fuzzy"),
            *[F.count_if(blank(F.col(f).cast("string")) != "").alias(f"fill.{f}") for f in FILL_FIELDS]]


def step_report(spark, counts: dict[str, int]) -> DataFrame:
    """``(step, metric, value)``: what came in, what was dropped, merged and filled."""
    return spark.createDataFrame([(*name.split(".", 1), int(n)) for name, n in counts.items()], "step string, metric string, value bigint")


def clean_listings(raw: DataFrame, cities: DataFrame, generated_at="1970-01-01T00:00:00",
                   whole_urls: bool = False) -> CleanRun:
    """Check, clean, type, merge and publish listings.

    ``raw`` holds the listing columns with ``source``, ``city_folder`` and a unique ``_ord``.  It is read once: the counts of
    the report are observed while the rows go by.
    """
    came_in, went_out = Observation(), Observation()
    typed = type_listings(raw, cities, whole_urls).observe(came_in, *_input_counts())
    merged = merge_sources(usable(typed))
    record = stage(published_record(merged).observe(went_out, *_output_counts()).drop("n_merged", "n_merged_2"))
    events = publish_order(record)
    report = step_report(raw.sparkSession, came_in.get | went_out.get)
    return CleanRun(events, publish_meta(record.drop("_ord"), generated_at), report)


def daily_export(raw: DataFrame, cities: DataFrame) -> DataFrame:
    """Cleaned events as the flat daily file's rows."""
    return flat_events(clean_listings(raw, cities).events, cities)
