"""Files of one city -> the sixteen-column city file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.text import blank, strip_wide
from marquee.functions.times import add_lenient, city_time_text
from marquee.functions.values import category_text, keyword_category, price_flag_two_state, tags_text
from marquee.keywords import ENGLISH, spanish
from marquee.operators.dedupe import first_listing
from marquee.operators.joins import fill_coordinates
from marquee.schema import CITY_FILE_COLUMNS

# City name, zone and keyword blocks of the two city jobs.
CITY_JOBS = {
    "new_york": ("New York", "America/New_York", ENGLISH),
    "mexico_city": ("Mexico City", "America/Mexico_City", spanish()),
}


def clean_city(raw: DataFrame, city: str, tz: str, blocks, gazetteer: DataFrame | None = None) -> DataFrame:
    """First row per (name, start text, venue), mapped to the city file; ``_ord`` is kept."""
    rows = add_lenient(add_lenient(first_listing(raw), "start_time", "__s"), "end_time", "__e")
    rows = rows.withColumn("__low", F.lower(category_text(
        F.col("name"), F.col("description"), F.col("primary_category"), F.col("secondary_categories"))))
    zone = F.lit(tz)
    plain = ["name", "description", "location_name", "address", "latitude", "longitude", "thumbnail_image",
             "additional_images", "external_link"]
    out = rows.select(
        "_ord", F.lit("").alias("id"), *[strip_wide(blank(F.col(c))).alias(c) for c in plain],
        city_time_text(F.col("__s"), zone).alias("start_time"), city_time_text(F.col("__e"), zone).alias("end_time"),
        F.lit(city).alias("city"),
        keyword_category(F.col("__low"), F.col("primary_category"), blocks).alias("primary_category"),
        tags_text(F.col("primary_category"), F.col("secondary_categories")).alias("tags"),
        price_flag_two_state(F.col("is_paid")).alias("is_paid"))
    if gazetteer is not None:
        out = fill_coordinates(out, gazetteer).drop("geocoded")
    return out.select("_ord", *CITY_FILE_COLUMNS)


def clean_city_job(raw: DataFrame, job: str, gazetteer: DataFrame | None = None) -> DataFrame:
    city, tz, blocks = CITY_JOBS[job]
    return clean_city(raw, city, tz, blocks, gazetteer)


def dedupe_counts(raw: DataFrame, kept: DataFrame) -> DataFrame:
    """One row: rows read and rows kept."""
    flags = raw.select(F.lit(1).alias("r"), F.lit(0).alias("k")).union(
        kept.select(F.lit(0).alias("r"), F.lit(1).alias("k")))
    return flags.agg(F.sum("r").alias("rows_read"), F.sum("k").alias("rows_kept"))
