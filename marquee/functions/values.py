"""Category, tag, coordinate, link, price and identity expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.text import blank, is_filled, strip_wide
from marquee.keywords import decisive
from marquee.schema import RAW_COLUMNS, SOURCE_LABELS, SOURCE_RANK, UNRANKED_SOURCE

# Limits of a published record and the earth's radius in metres.
MAX_TAGS = 8
MAX_IMAGES = 4
EARTH_RADIUS_M = 6_371_000.0

# Primary categories that mean "none given".
NO_CATEGORY = ["undefined", "unknown", "n/a", "na", "none", ""]
JUNK_LABEL = "undefined"

STRINGS = T.ArrayType(T.StringType())


def split_list(c: Column, sep: str = ",") -> Column:
    """Trimmed non-empty parts of a separated text."""
    return F.filter(F.transform(F.split(blank(c), sep), strip_wide), lambda x: x != "")


def keyword_category(low_text: Column, primary: Column, blocks: list[tuple[str, list[str]]]) -> Column:
    """Category of the first block with a keyword anywhere in the lower-cased text.

    Plain substring tests in one short-circuit CASE stay inside generated code.
    Pass a materialised column as ``low_text`` so the lower-casing runs once.
    """
    # Nothing given counts as the word "other"; white space or a junk word as none.
    own = F.when(blank(primary) == "", "other").otherwise(F.lower(strip_wide(blank(primary))))
    out = None
    for category, keywords in blocks:
        hit = reduce(lambda a, b: a | b, [F.contains(low_text, F.lit(k)) for k in decisive(keywords)])
        out = F.when(hit, category) if out is None else out.when(hit, category)
    return out.when(own.isin(NO_CATEGORY), "Other").otherwise(own)


def category_text(*parts: Column) -> Column:
    return F.array_join(F.filter(F.array(*[blank(p) for p in parts]), lambda x: x != ""), " ")


def tags_text(primary: Column, secondary: Column) -> Column:
    """Primary and secondary parts, order-preserving distinct, one text."""
    first = F.when(blank(primary) != "", F.array(strip_wide(primary))).otherwise(F.array().cast(STRINGS))
    return F.array_join(F.array_distinct(F.concat(first, split_list(secondary))), ", ")


def distinct_ignoring_case(items: Column) -> Column:
    """Keep the first spelling of every item, in order."""
    low = F.transform(items, F.lower)
    return F.filter(items, lambda x, i: F.array_position(low, F.lower(x)) == i + 1)


def distinct_tags(parts: Column) -> Column:
    """Case-insensitively distinct tags of cleaned parts, without blanks and the junk label."""
    return distinct_ignoring_case(F.filter(parts, lambda x: (x != "") & (F.lower(x) != JUNK_LABEL)))


def primary_and_tags(primary_clean: Column, tags: Column) -> tuple[Column, Column]:
    """Back-fill a blank primary from the tags, take it out of the tags, cap them."""
    given = F.when(F.lower(primary_clean) == JUNK_LABEL, F.lit("")).otherwise(primary_clean)
    chosen = F.when(given != "", given).otherwise(blank(F.try_element_at(tags, F.lit(1))))
    left = F.filter(tags, lambda x: F.lower(x) != F.lower(chosen))
    return chosen, F.slice(left, 1, MAX_TAGS)


def add_coordinates(df: DataFrame, lat_text: str = "latitude", lon_text: str = "longitude",
                    lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Add two doubles: both texts must be finite numbers and not both zero, else both are null."""
    a, b = F.col("__lat_n"), F.col("__lon_n")
    # NaN is a readable number but no coordinate.
    good = a.isNotNull() & b.isNotNull() & ~F.isnan(a) & ~F.isnan(b) & ~((a == 0) & (b == 0))
    return (
        df.withColumns({"__lat_n": strip_wide(blank(F.col(lat_text))).try_cast("double"),
                        "__lon_n": strip_wide(blank(F.col(lon_text))).try_cast("double")})
        .withColumn("__both", good)
        .withColumns({lat: F.when(F.col("__both"), a), lon: F.when(F.col("__both"), b)})
        .drop("__lat_n", "__lon_n", "__both")
    )


def in_box(lat: Column, lon: Column, lat_lo: Column, lat_hi: Column, lon_lo: Column, lon_hi: Column) -> Column:
    return F.when(lat.isNotNull(), lat.between(lat_lo, lat_hi) & lon.between(lon_lo, lon_hi))


def secure_link(c: Column) -> Column:
    """http becomes https, anything that is no web link becomes empty."""
    url = F.regexp_replace(strip_wide(blank(c)), "^http://", "https://")
    return F.when(F.startswith(url, F.lit("https://")), url).otherwise(F.lit(""))


def image_list(thumbnail: Column, additional: Column, whole_urls: bool = False) -> Column:
    """Up to four image links.  ``whole_urls`` keeps commas that belong to a link."""
    sep = r",(?=\s*https?://)" if whole_urls else ","
    parts = F.transform(F.concat(F.array(blank(thumbnail)), F.split(blank(additional), sep)), strip_wide)
    return F.slice(F.filter(parts, lambda x: F.startswith(x, F.lit("http"))), 1, MAX_IMAGES)


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres of coordinates in degrees."""
    a = (F.pow(F.sin((F.radians(lat2) - F.radians(lat1)) / 2), F.lit(2.0))
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
         * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), F.lit(2.0)))
    return F.lit(2.0 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def split_coordinates(c: Column) -> Column:
    """``"lat,lon"`` as a struct of two texts, both empty unless both are numbers."""
    s = strip_wide(blank(c))
    lat = strip_wide(F.substring_index(s, ",", 1))
    lon = strip_wide(F.substr(s, F.locate(",", s) + 1))
    good = (F.contains(s, F.lit(",")) & lat.try_cast("double").isNotNull() & lon.try_cast("double").isNotNull())
    return F.struct(F.when(good, lat).otherwise("").alias("latitude"),
                    F.when(good, lon).otherwise("").alias("longitude"))


def price_flag(c: Column) -> Column:
    """true / false / unknown (null)."""
    v = F.lower(strip_wide(blank(c)))
    return F.when(v == "true", True).when(v == "false", False)


def price_flag_two_state(c: Column) -> Column:
    """The per-city rule: unknown counts as not paid."""
    return F.lower(strip_wide(blank(c))).isin("true", "1", "yes")


def paid_label(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("unknown"))


def event_id(city: Column, day: Column, name_key: Column, venue_key: Column) -> Column:
    """First twelve hex digits of the SHA-1 of the match key."""
    return F.substring(F.sha1(F.concat_ws("|", city, day.cast("string"), name_key, venue_key).cast("binary")), 1, 12)


def source_label(c: Column) -> Column:
    """Published label of a site key; an unknown key is its own label."""
    labels = F.create_map(*[F.lit(x) for kv in SOURCE_LABELS.items() for x in kv])
    return F.coalesce(F.try_element_at(labels, c), c)


def source_rank(c: Column) -> Column:
    ranks = F.create_map(*[F.lit(x) for kv in SOURCE_RANK.items() for x in kv])
    return F.coalesce(F.try_element_at(ranks, c), F.lit(UNRANKED_SOURCE))


def fill_score(lat: Column, columns: list[str] = RAW_COLUMNS) -> Column:
    """Number of filled listing columns, two more for coordinates."""
    score = F.when(lat.isNotNull(), 2).otherwise(0)
    for c in columns:
        score = score + is_filled(F.col(c)).cast("int")
    return score


def share_percent(n: Column, total: Column) -> Column:
    """Share in percent, one decimal, half to even."""
    return F.bround(n * F.lit(100.0) / total, 1)


def percent_label(percent: Column) -> Column:
    return F.concat(F.regexp_replace(percent.cast("string"), r"\.0$", ""), F.lit("%"))


