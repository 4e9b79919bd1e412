"""Events out of stored web pages: structured blocks first, then looser evidence.

Pages are plain text columns.  Structure is read with regular expressions and
``VARIANT`` JSON inside the JVM; an element found by class, attribute or microdata goes to the
closing tag that belongs to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.markup import (
    JSON_LD_BLOCK, attribute_pattern, decode_entities, element_content, element_text, extract, fields, get, inner_text, is_array, is_object, is_string,
    items, marked_element_pattern, marked_text, meta_content, strip_script, tag_text_pattern, text_at, truthy,
)
from marquee.functions.text import SCRIPT_SPACE, clean_url, join_filled, url_host
from marquee.functions.times import SHORT_TIME_FORMAT, add_lenient, long_date
from marquee.operators.joins import host_suffixes

# Shapes of dates and times in running text.
MONTHS = (
    "Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|Jun(?:e)?|Jul(?:y)?|Aug(?:ust)?|"
    "Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?"
)
SPACE = f"[{SCRIPT_SPACE}]"
# ASCII word edges: a Java word boundary also looks at accented letters.
EDGE_BEFORE, EDGE_AFTER = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"
DATE_PATTERNS = [
    rf"(?i){EDGE_BEFORE}(?:{MONTHS}){SPACE}+\d{{1,2}},?{SPACE}+\d{{4}}{EDGE_AFTER}",
    rf"{EDGE_BEFORE}\d{{1,2}}[/-]\d{{1,2}}[/-]\d{{2,4}}{EDGE_AFTER}",
]
CLOCK = rf"\d{{1,2}}:\d{{2}}{SPACE}*(?:AM|PM)"
TIME_PATTERNS = [
    rf"(?i){EDGE_BEFORE}{CLOCK}{SPACE}*[-–to]+{SPACE}*{CLOCK}{EDGE_AFTER}",
    rf"(?i){EDGE_BEFORE}{CLOCK}{EDGE_AFTER}",
]
STATE_MARKER = r"window\.__SERVER_DATA__"
NOT_FOUND = "Could not extract event data from this page"
BAD_URL = "Invalid URL provided"
FIELDS = ["title", "date", "time", "location", "description", "image"]

# Sites with their own rules: name, domains, field -> (how, what).
# how: "attr" / "h1 attr" = attribute value of any element or of a heading, "tag" = element
# text, "class" / "testid" = element text by class or data-testid, "meta" = meta content,
# "day" / "clock" = parts of a datetime attribute.
SITE_RULES = [
    ("Eventbrite", ["eventbrite.com", "www.eventbrite.com"], {
        "title": ("h1 attr", "data-event-title"), "date": ("attr", "data-event-date"),
        "time": ("class", "event-details__time"), "location": ("class", "event-details__location"),
        "description": ("class", "event-description"), "image": ("meta", "og:image"),
    }),
    ("Meetup", ["meetup.com", "www.meetup.com"], {
        "title": ("tag", "h1"), "date": ("day", "datetime"), "time": ("clock", "datetime"),
        "location": ("class", "venueDisplay-venue-address"), "description": ("class", "event-description"),
        "image": ("meta", "og:image"),
    }),
    ("Luma", ["lu.ma", "luma.com"], {
        "title": ("tag", "h1"), "date": ("testid", "event-date"), "time": ("testid", "event-time"),
        "location": ("testid", "event-location"), "description": ("testid", "event-description"),
        "image": ("meta", "og:image"),
    }),
    ("Partiful", ["partiful.com", "www.partiful.com"], {
        "title": ("tag", "h1"), "date": ("class", "event-date"), "time": ("class", "event-time"),
        "location": ("class", "event-location"), "description": ("class", "event-description"),
        "image": ("meta", "og:image"),
    }),
]


def names_event(kind: Column, any_case: bool) -> Column:
    """``@type`` (text or JSON text of a list) names an event."""
    t = F.coalesce(kind.cast("string"), F.lit(""))
    return F.lower(t).contains("event") if any_case else t.contains("Event")


def json_ld_items(df: DataFrame, html: str, any_case: bool = True) -> DataFrame:
    """One row per event object of a page's JSON-LD blocks: ``block_no, item_no, item``.

    Objects, lists, ``@graph`` and ``ItemList`` are opened; broken JSON is skipped.  The payload
    adapters read pages this way; the cascade of ``extract_events`` is stricter.
    """
    own = [c for c in df.columns if c != html]
    blocks = df.select(*own, F.posexplode(F.regexp_extract_all(html, F.lit(JSON_LD_BLOCK), 1)).alias("block_no", "t"))
    docs = blocks.withColumn("doc", F.try_parse_json("t")).drop("t").filter(F.col("doc").isNotNull())
    doc = F.col("doc")
    tops = F.when(is_array(doc), items(doc)).otherwise(F.array(doc))

    def opened(x: Column) -> Column:
        top, graph = x["top"], x["read"]["@graph"]
        listed = F.transform(items(x["read"]["itemListElement"]), lambda e: F.coalesce(fields(e, "item: variant")["item"], e))
        return (F.when(is_array(graph), items(graph))
                .when(x["read"]["@type"] == "ItemList", listed).otherwise(F.array(top)))

    read = F.transform(tops, lambda x: F.struct(
        x.alias("top"), fields(x, "`@graph`: variant, `@type`: string, itemListElement: variant").alias("read")))
    return (docs.select(*own, "block_no", F.posexplode(F.flatten(F.transform(read, opened))).alias("item_no", "item"))
            .filter(names_event(fields(F.col("item"), "`@type`: string")["@type"], any_case)))


def page_state(html: Column) -> Column:
    """The state object a page assigns to its window, null when it does not parse."""
    whole = F.try_parse_json(extract(html, rf"(?s){STATE_MARKER}\s*=\s*(\{{.*?\}})\s*;?\s*</script>"))
    first = F.try_parse_json(
        extract(html, rf"(?s){STATE_MARKER}\s*=\s*(\{{.*?\}})\s*;\s*(?:window|var|let|const|\()"))
    return F.coalesce(whole, first)


def page_state_events(df: DataFrame, html: str = "html") -> DataFrame:
    """One row per search result of the page state; unreadable pages stay with ``state_parsed`` false."""
    own = [c for c in df.columns if c != html]
    staged = df.withColumn("doc", page_state(F.col(html)))
    return staged.select(*own, F.col("doc").isNotNull().alias("state_parsed"),
                         F.posexplode_outer(items(F.col("doc"), "$.search_data.events.results")).alias("pos", "ev"))


def meta_fields(page: Column) -> dict[str, Column]:
    """Title, description and image from the meta tags and the title element."""
    title = F.coalesce(F.nullif(meta_content(page, "og:title"), F.lit("")),
                       strip_script(extract(page, tag_text_pattern("title"))))
    return {
        "title": title,
        "description": F.coalesce(F.nullif(meta_content(page, "og:description"), F.lit("")),
                                  meta_content(page, "description")),
        "image": meta_content(page, "og:image"),
    }


def heading(page: Column) -> Column:
    """Text of the first h1, else of the first h2."""
    return F.coalesce(*[F.nullif(inner_text(extract(page, tag_text_pattern(t))), F.lit("")) for t in ("h1", "h2")],
                      F.lit(""))


def body_text(page: Column) -> Column:
    body = extract(page, r"(?is)<body[^>]*>(.*)$")
    return F.regexp_replace(F.regexp_replace(body, "(?s)<!--.*?-->", ""), "<[^>]*>", "")


def first_match(text: Column, patterns: list[str]) -> Column:
    """First match of the first pattern that matches at all."""
    return F.coalesce(*[F.nullif(F.regexp_extract(text, p, 0), F.lit("")) for p in patterns], F.lit(""))


def first_event(page: Column) -> Column:
    """The first event object of a page's JSON-LD blocks, null when there is none.

    Of every block whose root is an object, that object or the entries of its ``@graph``; the type is a
    text that holds ``Event`` or a list with exactly ``Event``.  Broken JSON is skipped.
    """
    empty = F.array().cast("array<variant>")
    blocks = F.transform(F.regexp_extract_all(page, F.lit(JSON_LD_BLOCK), 1), F.try_parse_json)
    docs = F.filter(blocks, lambda d: d.isNotNull() & is_object(d))

    def opened(doc: Column) -> Column:
        graph = get(doc, "$['@graph']", "variant")
        return F.when(is_array(graph), items(doc, "$['@graph']")).when(truthy(graph), empty).otherwise(F.array(doc))

    def is_event(item: Column) -> Column:
        kind = get(item, "$['@type']", "variant")
        listed = F.exists(items(kind), lambda e: is_string(e) & (get(e, "$") == "Event"))
        return is_object(item) & F.when(is_array(kind), listed).otherwise(is_string(kind) & text_at(kind, "$").contains("Event"))

    return F.try_element_at(F.filter(F.flatten(F.transform(docs, opened)), is_event), F.lit(1))


def _json_ld(df: DataFrame) -> DataFrame:
    """Add struct ``jsonld``, the event fields of the page's first JSON-LD event."""
    item = F.col("__event")
    raw = df.withColumn("__event", first_event(F.col("html"))).withColumns({
        "title": text_at(item, "$.name"), "start_text": text_at(item, "$.startDate", "$.date"),
        "time_text": text_at(item, "$.startDate"),
        "location": F.when(is_string(get(item, "$.location", "variant")), text_at(item, "$.location")).otherwise(
            join_filled(text_at(item, "$.location.name"),
                        text_at(item, "$.location.address.streetAddress", "$.location.address.addressLocality",
                                "$.location.address.addressRegion"))),
        "description": text_at(item, "$.description"),
        "image": F.when(is_string(get(item, "$.image", "variant")), text_at(item, "$.image")).otherwise(
            text_at(item, "$.image[0]", "$.image.url"))})
    return _dated(raw).withColumn("jsonld", F.struct(*FIELDS)).drop("__event", *FIELDS)


def _dated(df: DataFrame) -> DataFrame:
    """Long date and short time from the texts ``start_text`` and ``time_text``."""
    both = add_lenient(add_lenient(df, "start_text", "__d"), "time_text", "__t")
    return both.withColumns({
        "date": long_date(F.col("start_text"), F.col("__d")),
        "time": F.coalesce(F.date_format(F.col("__t.written"), SHORT_TIME_FORMAT), F.lit("")),
    }).drop("__d", "__t", "start_text", "time_text")


def _microdata(df: DataFrame) -> DataFrame:
    """Fields of the first element whose itemtype names an event."""
    item = F.col("__item")

    def prop(source: Column, name: str) -> Column:
        tag = extract(source, rf"""(?is)<[a-z][a-z0-9]*[^>]*\bitemprop=["']{name}["'][^>]*>""", 0)
        return F.coalesce(F.nullif(extract(tag, r"""(?is)\bcontent=["']([^"']*)"""), F.lit("")), marked_text(source, "itemprop", name))

    # Fields count inside the item, name and address inside its place.
    place = F.col("__place")
    part = lambda n: marked_text(place, "itemprop", n)
    staged = df.withColumn("__item", element_content(extract(
        F.col("html"), r"""(?is)<[a-z][a-z0-9]*[^>]*\bitemtype=["'][^"']*Event[^"']*["'][^>]*>.*$""", 0))).withColumn(
        "__place", element_content(extract(item, r"""(?is)(<[a-z][a-z0-9]*[^>]*\bitemprop=["']location["'][^>]*>.*)$""")))
    raw = staged.withColumns({
        "title": prop(item, "name"), "start_text": prop(item, "startDate"), "time_text": prop(item, "startDate"),
        "location": join_filled(part("name"), part("address")), "description": prop(item, "description"),
        "image": prop(item, "image")})
    out = _dated(raw)
    return out.withColumn("microdata", F.struct(*FIELDS)).drop("__item", "__place", *FIELDS)


def site_of(host: Column, rules=None) -> Column:
    """Name of the first rule with a domain that equals the host or ends it."""
    suffixes = host_suffixes(host)
    out = F.lit(None).cast("string")
    for name, domains, _ in reversed(rules or SITE_RULES):
        out = F.when(F.arrays_overlap(suffixes, F.array(*map(F.lit, domains))), name).otherwise(out)
    return out


def _pattern(how: str, what: str) -> str:
    return {"attr": lambda: attribute_pattern(what), "h1 attr": lambda: attribute_pattern(what, tag="h1"),
            "tag": lambda: tag_text_pattern(what), "class": lambda: marked_element_pattern("class", what, exact=False),
            "testid": lambda: marked_element_pattern("data-testid", what),
            "day": lambda: attribute_pattern(what, tag="time"), "clock": lambda: attribute_pattern(what, tag="time")}[how]()


def _shown(found: Column, how: str) -> Column:
    if how in ("attr", "h1 attr"):
        return found
    if how in ("day", "clock"):
        written = F.substring(F.replace(found, F.lit("T"), F.lit(" ")), 1, 16).try_cast("timestamp_ntz")
        return F.coalesce(F.date_format(written, "EEEE, MMMM d" if how == "day" else SHORT_TIME_FORMAT), F.lit(""))
    return element_text(found) if how in ("class", "testid") else inner_text(found)


def apply_site_rules(df: DataFrame, rules=None) -> DataFrame:
    """Add struct ``ruled`` with the fields the matched site's rules find.

    The site picks the pattern, so every field is one search of the page.
    """
    out, fields = df, {f: F.lit("") for f in FIELDS}
    for f in FIELDS:
        ways: dict[tuple[str, str], list[str]] = {}
        for name, _, own in rules or SITE_RULES:
            if f in own:
                ways.setdefault(own[f], []).append(name)
        searched = {way: names for way, names in ways.items() if way[0] != "meta"}
        if searched:
            pattern, value = None, F.lit("")
            for (how, what), names in searched.items():
                here = F.col("site").isin(*names)
                pattern = F.when(here, _pattern(how, what)) if pattern is None else pattern.when(here, _pattern(how, what))
                value = F.when(here, _shown(F.col(f"__{f}"), how)).otherwise(value)
            out = out.withColumn(f"__{f}", F.call_function("regexp_extract", F.col("html"), pattern, F.lit(1)))
            fields[f] = value
        for (how, what), names in ways.items():
            if how == "meta":
                found = meta_content(F.col("html"), what, by=("property",))
                fields[f] = F.when(F.col("site").isin(*names), found).otherwise(fields[f])
    ruled = F.struct(*[F.coalesce(c, F.lit("")).alias(f) for f, c in fields.items()])
    return out.withColumn("ruled", ruled).drop(*[f"__{f}" for f in FIELDS])


def _first_filled(*cols: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))


def extract_events(pages: DataFrame, rules=None, key: str = "page_id") -> DataFrame:
    """One row per page: the event of the first strategy that yields a title.

    JSON-LD, microdata, site rules filled up from meta tags, generic evidence filled
    up from meta tags.  Pages without a title stay as rows with ``success`` false.
    """
    # Every strategy works on the page's own row: page texts are never shuffled.
    base = pages.withColumn("clean_link", clean_url(F.col("url"))).withColumn(
        "site", site_of(url_host(F.col("clean_link")), rules))
    full = _microdata(_json_ld(base))
    meta = meta_fields(F.col("html"))
    full = apply_site_rules(full, rules).withColumns({
        "m_title": meta["title"], "m_description": meta["description"], "m_image": meta["image"],
        "g_title": heading(F.col("html")), "g_text": body_text(F.col("html"))}).drop("html")
    plain = decode_entities(F.col("g_text"))
    full = full.withColumn("g_text", plain).withColumns({
        "g_date": first_match(F.col("g_text"), DATE_PATTERNS),
        "g_time": first_match(F.col("g_text"), TIME_PATTERNS)}).drop("g_text")
    site_title = _first_filled(F.col("ruled.title"), F.col("m_title"))
    generic_title = _first_filled(F.col("m_title"), F.col("g_title"))
    use = (F.when(F.col("clean_link").isNull(), "invalid")
           .when(F.col("jsonld.title") != "", "jsonld")
           .when(F.col("microdata.title") != "", "microdata")
           .when(F.col("site").isNotNull() & (site_title != ""), "site-config").otherwise("generic"))
    full = full.withColumn("use", use)

    def pick(f: str) -> Column:
        ruled = _first_filled(F.col(f"ruled.{f}"), F.col(f"m_{f}")) if f in meta else F.col(f"ruled.{f}")
        loose = {"title": generic_title, "date": F.col("g_date"), "time": F.col("g_time"), "location": F.lit(""),
                 "description": F.col("m_description"), "image": F.col("m_image")}[f]
        return (F.when(F.col("use") == "invalid", F.lit(""))
                .when(F.col("use") == "jsonld", F.col(f"jsonld.{f}"))
                .when(F.col("use") == "microdata", F.col(f"microdata.{f}"))
                .when(F.col("use") == "site-config", ruled).otherwise(loose))

    # Text that came from JSON is already plain; the rest holds character references.
    picked = full.select(key, "use", *[pick(f).alias(f) for f in FIELDS])
    shown = picked.withColumns({
        f: F.when(F.col("use") == "jsonld", F.col(f)).otherwise(decode_entities(F.col(f)))
        for f in ("title", "description", "image", "location")})
    ok = F.col("title") != ""
    return shown.select(
        key, ok.alias("success"), F.when(F.col("use") == "invalid", "generic").otherwise(F.col("use")).alias("source"),
        *[F.when(ok, F.col(f)).alias(f) for f in FIELDS],
        F.when(F.col("use") == "invalid", BAD_URL).when(~ok, NOT_FOUND).alias("error"))
