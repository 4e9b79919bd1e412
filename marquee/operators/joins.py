"""Lookups and overlays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.text import blank, strip_wide
from marquee.operators.filters import lacks_coordinate_text
from marquee.schema import COUNTRY_ZONES

DEFAULT_ZONE = "America/New_York"


def attach_city(df: DataFrame, cities: DataFrame) -> DataFrame:
    """Canonical name, zone and box of each row's city folder; an unknown folder leaves them null.

    The dimension has a row per known city and its size is unknown to the planner: without the hint all rows go to
    as many tasks as there are cities.
    """
    return df.join(F.broadcast(cities), "city_folder", "left")


def country_zone(country: Column, default: str = DEFAULT_ZONE) -> Column:
    """Zone of a country code; a handful of entries, so a literal map instead of a join."""
    zones = F.create_map(*[F.lit(x) for kv in COUNTRY_ZONES.items() for x in kv])
    return F.coalesce(F.try_element_at(zones, F.upper(strip_wide(blank(country)))), F.lit(default))


def host_suffixes(host: Column) -> Column:
    """``a.b.com`` -> [a.b.com, b.com, com]."""
    parts = F.split(host, "[.]")
    return F.transform(F.sequence(F.lit(1), F.size(parts)),
                       lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + 1), "."))


def match_site(df: DataFrame, rules: DataFrame, host: str = "host") -> DataFrame:
    """Add ``site``: the first rule whose domain equals the host or ends it.

    The suffix test becomes an equality on the suffixes of each distinct host.  ``rules`` has
    ``ord, site, domain``.
    """
    suffixes = df.select(host).distinct().select(host, F.explode(host_suffixes(F.col(host))).alias("domain"))
    hit = suffixes.join(rules.select("ord", "site", "domain"), "domain").groupBy(host).agg(
        F.min_by("site", "ord").alias("site"))
    return df.join(hit, host, "left")


def overlay(current: DataFrame, found: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Field by field: the found value where it is filled, else the current one."""
    new = found.select(key, *[F.col(f).alias(f"__{f}") for f in fields])
    out = current.join(new, key, "left")
    return out.withColumns({f: F.coalesce(F.nullif(F.col(f"__{f}"), F.lit("")), F.col(f)) for f in fields}).drop(
        *[f"__{f}" for f in fields])


def address_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(strip_wide(blank(c))), r"\s+", " ")


def fill_coordinates(df: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Rows without coordinates take those of their address, adding ``geocoded``.

    ``gazetteer`` has ``address_key, city, g_lat, g_lon``; of several rows of an address the least counts.
    Only rows that ask are joined; the others never meet under a missing key.
    """
    known = gazetteer.groupBy("address_key", F.col("city").alias("__city")).agg(
        F.min(F.struct("g_lat", "g_lon")).alias("__at"))
    asks = F.coalesce(lacks_coordinate_text(F.col("latitude")) & (address_key(F.col("address")) != "") & F.col("city").isNotNull(), F.lit(False))
    asked = df.filter(asks).withColumn("__key", address_key(F.col("address")))
    found = asked.join(known, (F.col("__key") == F.col("address_key")) & (F.col("city") == F.col("__city")), "left")
    hit = F.col("__at.g_lat").isNotNull()
    found = found.withColumns({
        "latitude": F.when(hit, F.col("__at.g_lat").cast("string")).otherwise(F.col("latitude")),
        "longitude": F.when(hit, F.col("__at.g_lon").cast("string")).otherwise(F.col("longitude")),
        "geocoded": hit,
    }).drop("__key", "__city", "address_key", "__at")
    return found.unionByName(df.filter(~asks).withColumn("geocoded", F.lit(False)))


def attach_embeddings(df: DataFrame, embeddings: DataFrame, id_col: str = "id", keep: bool = False) -> DataFrame:
    """Rows with their vector, by id; rows without one are left out, or with ``keep`` have a null vector."""
    return df.join(embeddings.select(id_col, "embedding"), id_col, "left" if keep else "inner")
