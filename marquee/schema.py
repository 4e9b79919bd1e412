"""Row shapes and the fixed dimension rows shared by every operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The listing columns, in file order.
RAW_COLUMNS = [
    "name", "description", "location_name", "latitude", "longitude", "address",
    "start_time", "end_time", "city", "primary_category", "secondary_categories",
    "thumbnail_image", "additional_images", "external_link", "is_paid",
]

# The columns of a cleaned per-city file, in file order.
CITY_FILE_COLUMNS = [
    "id", "name", "description", "location_name", "address", "latitude", "longitude",
    "start_time", "end_time", "city", "primary_category", "tags", "thumbnail_image",
    "additional_images", "external_link", "is_paid",
]

# The columns of the flat daily file, in file order.
DAILY_COLUMNS = [
    "id", "name", "description", "venue", "address", "city", "venueArea", "latitude",
    "longitude", "inCityArea", "date", "startTime", "endTime", "hasTime", "displayTime",
    "category", "tags", "image", "url", "isPaid", "sources",
]

# Folder, city, time zone, latitude low/high, longitude low/high.
CITY_ROWS = [
    ("New_York_US", "New York", "America/New_York", 40.2, 41.4, -75.0, -73.0),
    ("Mexico_City_MX", "Mexico City", "America/Mexico_City", 18.8, 20.0, -99.8, -98.5),
    ("Los_Angeles_US", "Los Angeles", "America/Los_Angeles", 33.0, 35.0, -119.5, -116.8),
]

# Country code and its time zone.
COUNTRY_ZONES = {
    "MX": "America/Mexico_City",
    "US": "America/New_York",
    "CA": "America/Toronto",
    "GB": "Europe/London",
    "ES": "Europe/Madrid",
    "AR": "America/Argentina/Buenos_Aires",
}

# Site key and its published label, best source first.
SOURCE_LABELS = {
    "ticketmaster": "Ticketmaster",
    "eventbrite": "Eventbrite",
    "ra": "Resident Advisor",
    "songkick": "Songkick",
    "nyc_events": "NYC Events Calendar",
    "nyc_parks": "NYC Parks",
}
SOURCE_RANK = {site: i for i, site in enumerate(SOURCE_LABELS)}
UNRANKED_SOURCE = 99

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

CITY_SCHEMA = T.StructType([
    T.StructField("city_folder", T.StringType()),
    T.StructField("canonical_city", T.StringType()),
    T.StructField("tz", T.StringType()),
    T.StructField("lat_lo", T.DoubleType()),
    T.StructField("lat_hi", T.DoubleType()),
    T.StructField("lon_lo", T.DoubleType()),
    T.StructField("lon_hi", T.DoubleType()),
])


def city_dimension(spark: SparkSession, rows=None) -> DataFrame:
    """The known cities; pass ``rows`` to add or replace cities."""
    return spark.createDataFrame(rows or CITY_ROWS, CITY_SCHEMA)
