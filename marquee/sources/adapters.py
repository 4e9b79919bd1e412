"""Landed site payloads -> the fifteen listing columns.

An adapter is a function from a DataFrame with a ``VARIANT`` column ``ev`` (one event)
to the listing columns; ``ADAPTERS`` holds them by site and takes further entries.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.markup import (
    fields, first_filled, first_of, get, is_array, is_object, is_string, items, one_or_many, text_at, truthy,
)
from marquee.functions.text import blank, join_filled, strip_html_light, strip_wide
from marquee.functions.times import join_clock
from marquee.functions.values import split_coordinates, split_list
from marquee.operators.dedupe import backfill_city, first_by_key, first_of_day
from marquee.operators.filters import keep_days
from marquee.operators.pages import json_ld_items, page_state
from marquee.schema import RAW_COLUMNS

# Constants the sites' rows carry.
MUSIC = "Music"
NEW_YORK = "new york"
RA_SITE = "https://ra.co"
NY_ZONE = "America/New_York"
MX_ZONE = "America/Mexico_City"
STRINGS = "array<string>"


def listing(df: DataFrame, **columns: Column) -> DataFrame:
    """Project to the listing columns, in order; a column not given is empty."""
    carried = [c for c in df.columns if c not in RAW_COLUMNS and c != "ev"]
    return df.select(*carried, *[blank(columns.get(c, F.lit(""))).alias(c) for c in RAW_COLUMNS])


def rest(parts: Column) -> Column:
    """Second and later entries, comma-joined."""
    return F.array_join(F.filter(parts, lambda _, i: i > 0), ",")


def head(parts: Column) -> Column:
    return blank(F.try_element_at(parts, F.lit(1)))


def texts(values: Column, name: str) -> Column:
    """The filled texts of one field of a list of objects."""
    return F.filter(F.transform(values, lambda x: blank(fields(x, f"{name}: string")[name])), lambda t: t != "")


def ticketmaster(df: DataFrame) -> DataFrame:
    ev = F.col("ev")
    venue, kind = "$._embedded.venues[0]", "$.classifications[0]"
    images = texts(items(ev, "$.images"), "url")
    return listing(
        df, name=text_at(ev, "$.name"), description=text_at(ev, "$.info"),
        location_name=text_at(ev, f"{venue}.name"), latitude=text_at(ev, f"{venue}.location.latitude"),
        longitude=text_at(ev, f"{venue}.location.longitude"), address=text_at(ev, f"{venue}.address.line1"),
        start_time=text_at(ev, "$.dates.start.dateTime"), end_time=text_at(ev, "$.dates.end.dateTime"),
        city=F.lower(text_at(ev, f"{venue}.city.name")),
        primary_category=text_at(ev, f"{kind}.segment.name"), secondary_categories=text_at(ev, f"{kind}.genre.name"),
        thumbnail_image=head(images), additional_images=rest(images), external_link=text_at(ev, "$.url"),
        is_paid=F.when(F.size(items(ev, "$.priceRanges")) > 0, "true").otherwise(""))


def _rich_text(x: Column) -> Column:
    """A text, or an object with a ``text`` or ``html`` part."""
    parts = fields(x, "text: string, html: string")
    return F.when(parts.isNotNull(), first_filled(parts["text"], parts["html"])).otherwise(text_at(x, "$"))


def _day_and_clock(day: Column, clock: Column) -> Column:
    d, t = strip_wide(blank(day)), strip_wide(blank(clock))
    return F.when((d != "") & t.rlike(r"^\d{2}:\d{2}$"), F.concat(d, F.lit("T"), t, F.lit(":00"))).otherwise(d)


def eventbrite(df: DataFrame) -> DataFrame:
    staged = df.withColumn("_read", fields(F.col("ev"), """
        name: variant, summary: variant, full_description: variant, start_date: string, start_time: string, end_date: string,
        end_time: string, tags: variant, image: variant, url: string, is_free: variant, primary_venue: struct<name: string,
          address: struct<latitude: string, longitude: string, localized_address_display: string, address_1: string, city: string>>"""))
    ev, tags = F.col("_read"), F.col("_tags")
    address, image, free = ev["primary_venue"]["address"], ev["image"], ev["is_free"]
    read = F.filter(F.transform(items(ev["tags"]), lambda t: fields(t, "display_name: string, name: string, text: variant")), F.isnotnull)
    staged = staged.withColumn("_tags", F.filter(F.transform(
        read, lambda t: F.coalesce(*[F.nullif(t[n], F.lit("")) for n in ("display_name", "name")], _rich_text(t["text"]))),
        lambda x: x != ""))
    picture = fields(image, "url: string")
    return listing(
        staged, name=_rich_text(ev["name"]),
        description=F.when(truthy(ev["summary"]), _rich_text(ev["summary"])).otherwise(_rich_text(ev["full_description"])),
        location_name=ev["primary_venue"]["name"], latitude=address["latitude"], longitude=address["longitude"],
        address=F.coalesce(F.nullif(address["localized_address_display"], F.lit("")),
                           join_filled(address["address_1"], address["city"])),
        start_time=_day_and_clock(ev["start_date"], ev["start_time"]),
        end_time=_day_and_clock(ev["end_date"], ev["end_time"]), city=F.lower(address["city"]),
        primary_category=head(tags), secondary_categories=rest(tags),
        thumbnail_image=F.when(picture.isNotNull(), picture["url"]).when(is_string(image), text_at(image, "$")).otherwise(""),
        external_link=ev["url"],
        is_paid=F.when(free.try_cast("string").isNull(), "").when(truthy(free), "false").otherwise("true")).drop("_read", "_tags")


def _zulu(c: Column) -> Column:
    return F.regexp_replace(c, r"^(.*T\d{2}:\d{2}:\d{2})\+00:00$", "$1Z")


def eventbrite_json_ld(df: DataFrame) -> DataFrame:
    staged = df.withColumn("_read", fields(F.col("ev"), """
        `@type`: string, name: string, description: string, startDate: string, endDate: string, url: string, image: variant,
        location: variant, offers: variant"""))
    ev = F.col("_read")
    staged = staged.withColumns({
        "_place": fields(first_of(ev["location"], "$"), "name: string, geo: struct<latitude: string, longitude: string>, address: variant"),
        "_offer": first_of(ev["offers"], "$")})
    loc, offer, img, kind = F.col("_place"), F.col("_offer"), ev["image"], blank(ev["@type"])
    address, street = loc["address"], fields(loc["address"], "streetAddress: string, addressLocality: string")
    asked, images, picture = fields(offer, "price: string, lowPrice: string"), get(img, "$", STRINGS), fields(img, "url: string")
    has_price = F.schema_of_variant(offer).rlike(r"[<\s]price:")
    number = strip_wide(F.when(has_price, asked["price"]).otherwise(asked["lowPrice"])).try_cast("double")
    return listing(
        staged, name=ev["name"], description=strip_wide(blank(ev["description"])),
        location_name=loc["name"], latitude=loc["geo"]["latitude"], longitude=loc["geo"]["longitude"],
        address=F.when(is_string(address), text_at(address, "$")).otherwise(street["streetAddress"]),
        start_time=_zulu(blank(ev["startDate"])), end_time=_zulu(blank(ev["endDate"])),
        city=F.lower(street["addressLocality"]),
        primary_category=F.when(kind != "Event", kind).otherwise(""),
        thumbnail_image=F.when(images.isNotNull(), F.try_element_at(images, F.lit(1))).when(
            picture.isNotNull(), picture["url"]).otherwise(text_at(img, "$")),
        external_link=ev["url"],
        is_paid=F.when(number > 0, "true").when(number.isNotNull(), "false").otherwise("")).drop("_read", "_place", "_offer")


def resident_advisor(df: DataFrame) -> DataFrame:
    ev = F.col("ev")
    url = text_at(ev, "$.contentUrl")
    return listing(
        df, name=text_at(ev, "$.title"), location_name=text_at(ev, "$.venue.name"),
        address=text_at(ev, "$.venue.address"), start_time=text_at(ev, "$.startTime"),
        end_time=text_at(ev, "$.endTime"), city=F.lower(text_at(ev, "$.venue.area.name")),
        primary_category=F.lit(MUSIC), secondary_categories=F.array_join(texts(items(ev, "$.artists"), "name"), ","),
        thumbnail_image=text_at(ev, "$.images[0].filename"),
        external_link=F.when(F.startswith(url, F.lit("/")), F.concat(F.lit(RA_SITE), url)).otherwise(url))


def songkick(df: DataFrame) -> DataFrame:
    staged = df.withColumn("_read", fields(F.col("ev"), """
        name: string, description: string, startDate: string, endDate: string, url: string, location: variant, image: variant,
        performer: variant, offers: variant"""))
    ev, loc, images = F.col("_read"), F.col("_place"), F.col("_images")
    staged = staged.withColumns({
        "_place": fields(first_of(ev["location"], "$"), """
            name: string, geo: struct<latitude: string, longitude: string>,
            address: struct<streetAddress: string, addressLocality: string>"""),
        "_images": F.transform(F.filter(one_or_many(ev["image"], "$"), is_string), lambda x: x.cast("string"))})
    locality = loc["address"]["addressLocality"]
    return listing(
        staged, name=ev["name"], description=strip_html_light(ev["description"]),
        location_name=loc["name"], latitude=loc["geo"]["latitude"], longitude=loc["geo"]["longitude"],
        address=join_filled(loc["address"]["streetAddress"], locality),
        start_time=ev["startDate"], end_time=ev["endDate"], city=F.lower(locality),
        primary_category=F.lit(MUSIC),
        secondary_categories=F.array_join(texts(one_or_many(ev["performer"], "$"), "name"), ","),
        thumbnail_image=head(images), additional_images=rest(images), external_link=ev["url"],
        is_paid=F.when(F.size(one_or_many(ev["offers"], "$")) > 0, "true").otherwise("")).drop("_read", "_place", "_images")


def nyc_events(df: DataFrame) -> DataFrame:
    staged = df.withColumn("cats", split_list(text_at(F.col("ev"), "$.categories")))
    ev, cats = F.col("ev"), F.col("cats")
    return listing(
        staged, name=text_at(ev, "$.name"), description=strip_html_light(text_at(ev, "$.desc", "$.shortDesc")),
        location_name=text_at(ev, "$.location"), address=strip_wide(text_at(ev, "$.address")),
        start_time=text_at(ev, "$.startDate"), end_time=text_at(ev, "$.endDate"), city=F.lit(NEW_YORK),
        primary_category=head(cats), secondary_categories=rest(cats), thumbnail_image=text_at(ev, "$.imageUrl"),
        external_link=text_at(ev, "$.permalink", "$.website"),
        is_paid=F.when(F.exists(cats, lambda c: F.lower(c) == "free"), "false").otherwise("")).drop("cats")


def nyc_parks(df: DataFrame) -> DataFrame:
    staged = df.withColumns({
        "cats": split_list(text_at(F.col("ev"), "$.categories"), "[|]"),
        "place": split_coordinates(text_at(F.col("ev"), "$.coordinates"))})
    ev, cats = F.col("ev"), F.col("cats")
    return listing(
        staged, name=text_at(ev, "$.title"), description=strip_html_light(text_at(ev, "$.description")),
        location_name=text_at(ev, "$.location", "$.parknames"), latitude=F.col("place.latitude"),
        longitude=F.col("place.longitude"), address=text_at(ev, "$.parknames"),
        start_time=join_clock(text_at(ev, "$.startdate"), text_at(ev, "$.starttime")),
        end_time=join_clock(text_at(ev, "$.enddate"), text_at(ev, "$.endtime")), city=F.lit(NEW_YORK),
        primary_category=head(cats), secondary_categories=rest(cats), thumbnail_image=text_at(ev, "$.image"),
        external_link=F.replace(text_at(ev, "$.link"), F.lit("http://"), F.lit("https://"))).drop("cats", "place")


@dataclass(frozen=True)
class Site:
    """How one site's landed payloads become listings."""

    explode: Callable[[DataFrame], DataFrame]
    adapt: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    zone: str
    keep_keyless: bool = False


def _json_array(path: str, inner: str | None = None) -> Callable[[DataFrame], DataFrame]:
    """Rows of a JSON array inside the payload; entries that are no objects are left out."""
    def run(df: DataFrame) -> DataFrame:
        rows = df.withColumn("doc", F.try_parse_json("payload")).select(
            *[c for c in df.columns if c != "payload"], F.posexplode(items(F.col("doc"), path)).alias("pos", "ev"))
        if inner:
            rows = rows.withColumn("ev", get(F.col("ev"), inner, "variant"))
        return rows.filter(is_object(F.col("ev")))
    return run


def _page_state(df: DataFrame) -> DataFrame:
    return (df.withColumn("doc", page_state(F.col("payload")))
            .select(*[c for c in df.columns if c != "payload"],
                    F.posexplode(items(F.col("doc"), "$.search_data.events.results")).alias("pos", "ev"))
            .filter(is_object(F.col("ev"))))


def _json_ld(any_case: bool) -> Callable[[DataFrame], DataFrame]:
    def run(df: DataFrame) -> DataFrame:
        found = json_ld_items(df, "payload", any_case=any_case)
        return found.withColumn("pos", F.struct("block_no", "item_no")).select(
            *[c for c in df.columns if c != "payload"], "pos", F.col("item").alias("ev"))
    return run


ADAPTERS: dict[str, Site] = {
    "ticketmaster": Site(_json_array("$._embedded.events"), ticketmaster, (), NY_ZONE),
    "eventbrite": Site(_page_state, eventbrite, ("url", "id", "name"), MX_ZONE, keep_keyless=True),
    "eventbrite_json_ld": Site(_json_ld(False), eventbrite_json_ld, ("url", "name"), MX_ZONE, keep_keyless=True),
    "ra": Site(_json_array("$.data.eventListings.data", "$.event"), resident_advisor, ("id",), NY_ZONE),
    "songkick": Site(_json_ld(True), songkick, ("url", "name+startDate"), MX_ZONE),
    "nyc_events": Site(_json_array("$.items"), nyc_events, ("guid", "id", "permalink"), NY_ZONE),
    "nyc_parks": Site(_json_array("$"), nyc_parks, ("guid", "link", "title"), NY_ZONE),
}


def _event_key(read: Column, name: str) -> Column:
    if "+" in name:
        return F.to_json(F.struct(*[blank(read[p]).alias(p) for p in name.split("+")]))
    return F.nullif(read[name], F.lit(""))


def distinct_events(df: DataFrame, site: Site) -> DataFrame:
    """First row per page key; ``_ord`` is (page order, position)."""
    ordered = df.withColumn("_ord", F.struct(F.col("page_no"), F.col("pos")))
    if not site.keys:
        return ordered
    names = dict.fromkeys(n for k in site.keys for n in k.split("+"))
    read = ordered.withColumn("__read", fields(F.col("ev"), ", ".join(f"{n}: string" for n in names)))
    named = read.withColumn("__key", F.coalesce(*[_event_key(F.col("__read"), k) for k in site.keys])).drop("__read")
    return first_by_key(named, ["__key"], "_ord", site.keep_keyless).drop("__key")


def adapt_source(payloads: DataFrame, site: str, start=None, end=None, city: str = "",
                 tz: str | None = None, registry: dict[str, Site] = ADAPTERS) -> DataFrame:
    """Payload pages ``(page_no, payload)`` of a site -> listings of the asked days.

    Page-level duplicates go first, then rows outside the window, then repeated
    (name, venue, day); a blank city takes the asked city.
    """
    spec = registry[site]
    rows = spec.adapt(distinct_events(spec.explode(payloads), spec))
    dated = backfill_city(keep_days(rows, F.lit(tz or spec.zone), start, end), city)
    return first_of_day(dated).select(F.lit(site).alias("site"), F.col("local_day").alias("day"), "_ord", *RAW_COLUMNS)
