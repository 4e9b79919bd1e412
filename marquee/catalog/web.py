"""Page extraction, landed payloads, alias rows and the workflows over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.catalog.fields import TAGS, TAGS_TEXT, _keyword_sql
from marquee.catalog.inputs import CITIES_SQL, LISTINGS, LISTINGS_SQL, SCRIPT
from marquee.catalog.moments import PARSED
from marquee.catalog.registry import query
from marquee.catalog.rows import BOTH, CLEAN
from marquee.catalog.texts import digest
from marquee.functions.markup import get, text_at
from marquee.keywords import ENGLISH, spanish
from marquee.operators import pages as P
from marquee.operators.display import display_events
from marquee.plans.city import clean_city_job, dedupe_counts
from marquee.operators.ranking import number_rows
from marquee.plans.clean import clean_listings, daily_export
from marquee.schema import DAILY_COLUMNS, RAW_COLUMNS, city_dimension
from marquee.sources.adapters import ADAPTERS, adapt_source, distinct_events
from marquee.sources.listings import pick_aliases



def strip_script_sql(c):
    return f"regexp_replace({c}, '^{SCRIPT}+|{SCRIPT}+$', '', 'g')"


TITLE_SQL = strip_script_sql(r"regexp_extract(html, '(?is)<title(?:[ \t\r\n][^>]*)?>(.*?)</title[ \t\r\n]*>', 1)")
H1_SQL = strip_script_sql(r"regexp_replace(regexp_extract(html, '(?is)<h1(?:[ \t\r\n][^>]*)?>(.*?)</h1[ \t\r\n]*>', 1), '<[^>]*>', '', 'g')")


@query("page_meta", f"select page_id, {TITLE_SQL} as title, '' as description, '' as image from pages")
def _(t):
    return t.pages.select("page_id", *[c.alias(n) for n, c in P.meta_fields(F.col("html")).items()])


@query("page_heading", f"select page_id, {H1_SQL} as heading from pages")
def _(t):
    return t.pages.select("page_id", P.heading(F.col("html")).alias("heading"))


@query("page_body_text", r"""
select page_id, md5(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<body[^>]*>(.*)$', 1), '(?s)<!--.*?-->', '', 'g'),
  '<[^>]*>', '', 'g')) as body from pages""")
def _(t):
    return t.pages.select("page_id", digest(P.body_text(F.col("html"))).alias("body"))


@query("page_first_date_and_time", """
select doc_id, case doc_id % 4 when 0 then 'MAY 3, 2024' when 1 then '12/31/24' when 2 then 'September 14 2025' else '' end as day,
  case doc_id % 4 when 0 then '7:30 pm - 11:00 PM' when 1 then '9:05AM' else '' end as clock from documents""")
def _(t):
    shape = F.col("doc_id") % 4
    tail = (F.when(shape == 0, " on MAY 3, 2024 from 7:30 pm - 11:00 PM.").when(shape == 1, " (12/31/24, 9:05AM)")
            .when(shape == 2, " September 14 2025 or 1/2/2026 99:123 pm").otherwise(" June 5 sharp, 24:7 pm"))
    d = t.documents.select("doc_id", F.concat("text", tail).alias("t"))
    return d.select("doc_id", P.first_match(F.col("t"), P.DATE_PATTERNS).alias("day"),
                    P.first_match(F.col("t"), P.TIME_PATTERNS).alias("clock"))


def dressed(t):
    """Pages with a structured block put in by row number: JSON-LD, microdata, broken JSON, a known site, none."""
    k = F.col("page_id") % 6
    n = F.col("page_id").cast("string")
    ld = F.concat(
        F.lit('<script type="application/ld+json">{"@graph":[{"@type":"Organization","name":"x"},{"@type":["Thing","Event"],"name":"Show '),
        n, F.lit('","startDate":"2024-02-1'), (F.col("page_id") % 10).cast("string"),
        F.lit('T19:30:00","location":{"name":"Hall","address":{"streetAddress":"'), n,
        F.lit(' Main St"}},"description":"a & b","image":["i.jpg","j.jpg"]}]}</script></head>'))
    micro = F.concat(
        F.lit('<body><div itemscope itemtype="https://schema.org/MusicEvent"><h3 itemprop="name"> Gig &amp; '), n,
        F.lit('</h3><meta itemprop="startDate" content="2024-03-05"><p itemprop="location"><b itemprop="name">Club</b>'
              '<i itemprop="address">5th</i></p><img itemprop="image" content="p.png"></div>'))
    broken = F.lit('<script type="application/ld+json">{"@type":"Event","name":</script></head>')
    stamp = F.lit('<body><time datetime="2024-07-21T22:00">x</time><p class="lead event-description wide">All <b>welcome</b></p>')
    og = F.lit('<meta property="og:title" content="Open &amp; free"><meta content="d\'or" name="description"></head>')
    html = (F.when(k == 0, F.replace("html", F.lit("</head>"), ld)).when(k == 1, F.replace("html", F.lit("<body>"), micro))
            .when(k == 2, F.replace("html", F.lit("</head>"), broken)).when(k == 3, F.replace("html", F.lit("<body>"), stamp))
            .when(k == 4, F.replace("html", F.lit("</head>"), og)).otherwise(F.col("html")))
    url = F.when(k == 3, F.lit("www.meetup.com/x")).when(F.col("page_id") % 12 == 5, "https://bad host/").otherwise(F.col("url"))
    return t.pages.select("page_id", url.alias("url"), html.alias("html"))


def decoded(c):
    return (f"replace(replace(replace(replace(replace({c}, '&quot;', chr(34)), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'),"
            " '&amp', '&')")


@query("page_events", f"""
select page_id, case k when 0 then 'jsonld' when 1 then 'microdata' when 3 then 'site-config' else 'generic' end as source, not bad as success,
  case when bad then 'Invalid URL provided' end as error,
  case when bad then null when k = 0 then 'Show ' || page_id when k = 1 then 'Gig & ' || page_id when k = 3 then h1
    when k = 4 then 'Open & free' else title end as title,
  case when bad then null when k = 0 then strftime(date '2024-02-10' + cast(page_id % 10 as integer), '%A, %B %-d, %Y')
    when k = 1 then 'Tuesday, March 5, 2024' when k = 3 then 'Sunday, July 21' else '' end as date,
  case when bad then null when k = 0 then '7:30 PM' when k = 1 then '12:00 AM' when k = 3 then '10:00 PM' else '' end as time,
  case when bad then null when k = 0 then 'Hall, ' || page_id || ' Main St' when k = 1 then 'Club, 5th' else '' end as location,
  case when bad then null when k = 0 then 'a & b' when k = 3 then 'All welcome' when k = 4 then 'd''or' else '' end as description,
  case when bad then null when k = 0 then 'i.jpg' when k = 1 then 'p.png' else '' end as image
from (select page_id, page_id % 6 as k, page_id % 12 = 5 as bad, {decoded(TITLE_SQL)} as title, {decoded(H1_SQL)} as h1 from pages)""")
def _(t):
    return P.extract_events(dressed(t))


@query("page_events_as_stored", f"""
select page_id, 'generic' as source, t <> '' as success, nullif({decoded('t')}, '') as title from (select page_id,
  case when {TITLE_SQL} <> '' then {TITLE_SQL} else {H1_SQL} end as t from pages)""")
def _(t):
    return P.extract_events(t.pages).select("page_id", "source", "success", "title")


@query("json_ld_items", """
select page_id, 'Show ' || page_id as name from pages where page_id % 6 = 0""")
def _(t):
    d = P.json_ld_items(dressed(t).select("page_id", "html"), "html")
    return d.select("page_id", text_at(F.col("item"), "$.name").alias("name"))


@query("page_state_events", """
select page_id, page_id % 3 <> 0 as state_parsed, case when page_id % 3 <> 0 then unnest(generate_series(0, page_id % 3 - 1)) end::integer
  as pos from pages where page_id % 3 <> 0 union all select page_id, false, null from pages where page_id % 3 = 0""")
def _(t):
    one = F.lit('{"name":"{x};</b>"}')
    many = F.array_join(F.array_repeat(one, (F.col("page_id") % 3).cast("int")), ",")
    state = F.concat(F.lit('<script>window.__SERVER_DATA__ = {"search_data":{"events":{"results":['), many,
                     F.when(F.col("page_id") % 3 == 0, "]").otherwise("]}}"),
                     F.when(F.col("page_id") % 2 == 0, "};window.y = 1;").otherwise("};"), F.lit("</script></body>"))
    d = t.pages.select("page_id", F.concat("html", state).alias("html"))
    return P.page_state_events(d).select("page_id", "state_parsed", "pos")


@query("json_field", "select event_id, cast(json_extract_string(props, '$.k') as integer) as k, props from events")
def _(t):
    v = F.try_parse_json("props")
    return t.events.select("event_id", get(v, "$.k", "int").alias("k"), "props")


# Landed payloads: one document per event row, with gaps by row number.
def _payload(t, body):
    return _landed(t, F.to_json(body))


def _landed(t, payload):
    """Few short columns grow into wide payloads, so the rows are dealt to as many tasks as the session shuffles to."""
    rows = t.events.select("event_id", "ts", "event_type").repartition(
        int(t.spark.conf.get("spark.sql.shuffle.partitions")), "event_id")
    return rows.select(F.col("event_id").alias("page_no"), payload.alias("payload"))


N = "cast(event_id as string)"
DAY = "strftime(ts, '%Y-%m-%d')"


def _n():
    return F.col("event_id").cast("string")


def _every(k, c):
    return F.when(F.col("event_id") % k != 0, c)


def _adapted(t, site, payloads):
    spec = ADAPTERS[site]
    rows = spec.adapt(distinct_events(spec.explode(payloads), spec))
    return rows.select(F.col("_ord.page_no").alias("page_no"), *RAW_COLUMNS)


def _expect(**cols):
    rest = {c: "''" for c in RAW_COLUMNS}
    rest.update(cols)
    return f"select event_id as page_no, {', '.join(f'{v} as {k}' for k, v in rest.items())} from events"


def _ticketmaster(t):
    return _payload(t, F.struct(F.struct(F.array(F.struct(
        F.concat(F.lit("Show "), _n()).alias("name"), _every(3, F.lit("info")).alias("info"),
        F.concat(F.lit("https://t/"), _n()).alias("url"),
        F.array(F.struct(F.lit("a.jpg").alias("url")), F.struct(F.lit(None).cast("string").alias("url")),
                F.struct(F.lit("b.jpg").alias("url")), F.struct(F.lit("c.jpg").alias("url"))).alias("images"),
        F.when(F.col("event_id") % 4 == 0, F.array(F.struct(F.lit(5).alias("min")))).alias("priceRanges"),
        F.struct(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("dateTime")).alias("start")).alias("dates"),
        F.array(F.struct(F.struct(F.lit("Music").alias("name")).alias("segment"),
                         F.struct(F.col("event_type").alias("name")).alias("genre"))).alias("classifications"),
        F.struct(F.array(F.struct(
            F.lit("Hall").alias("name"), F.struct(F.lit("40.7").alias("latitude"), F.lit("-74.0").alias("longitude")).alias("location"),
            F.struct(_every(5, F.lit("1 Main")).alias("line1")).alias("address"),
            F.struct(F.lit("New York").alias("name")).alias("city"))).alias("venues")).alias("_embedded"),
    )).alias("events")).alias("_embedded")))


@query("adapt_ticketmaster", _expect(
    name=f"'Show ' || {N}", description="case when event_id % 3 <> 0 then 'info' else '' end", location_name="'Hall'",
    latitude="'40.7'", longitude="'-74.0'", address="case when event_id % 5 <> 0 then '1 Main' else '' end",
    start_time="strftime(ts, '%Y-%m-%dT%H:%M:%SZ')", city="'new york'", primary_category="'Music'",
    secondary_categories="event_type", thumbnail_image="'a.jpg'", additional_images="'b.jpg,c.jpg'",
    external_link=f"'https://t/' || {N}", is_paid="case when event_id % 4 = 0 then 'true' else '' end"))
def _(t):
    return _adapted(t, "ticketmaster", _ticketmaster(t))


@query("adapt_eventbrite", _expect(
    name=f"'Fair ' || {N}", description="case when event_id % 3 = 0 then 'full' else 'short' end", location_name="'Loft'",
    latitude="'19.4'", longitude="'-99.1'", address="case when event_id % 2 = 0 then 'Calle uno' else 'Calle 1, CDMX' end",
    start_time=f"{DAY} || case when event_id % 5 = 0 then '' else strftime(ts, 'T%H:%M:00') end", end_time=DAY, city="'cdmx'",
    primary_category="'Art'", secondary_categories="event_type", thumbnail_image="case when event_id % 7 = 0 then 's.png' else 'o.png' end",
    external_link=f"'https://e/' || {N}", is_paid="case event_id % 3 when 0 then 'true' when 1 then 'false' else '' end"))
def _(t):
    n = _n()
    ev = F.to_json(F.struct(
        F.struct(F.concat(F.lit("Fair "), n).alias("text")).alias("name"), _every(3, F.lit("short")).alias("summary"),
        F.lit("full").alias("full_description"), F.concat(F.lit("https://e/"), n).alias("url"),
        F.when(F.col("event_id") % 3 == 0, False).when(F.col("event_id") % 3 == 1, True).alias("is_free"),
        F.date_format("ts", "yyyy-MM-dd").alias("start_date"), _every(5, F.date_format("ts", "HH:mm")).alias("start_time"),
        F.date_format("ts", "yyyy-MM-dd").alias("end_date"), F.lit("late").alias("end_time"),
        F.array(F.struct(F.lit("Art").alias("display_name"), F.lit(None).cast("string").alias("name")),
                F.struct(F.lit("").alias("display_name"), F.col("event_type").alias("name"))).alias("tags"),
        F.struct(F.lit("Loft").alias("name"), F.struct(
            F.lit("19.4").alias("latitude"), F.lit("-99.1").alias("longitude"), F.lit("Calle 1").alias("address_1"),
            F.when(F.col("event_id") % 2 == 0, "Calle uno").alias("localized_address_display"),
            F.lit("CDMX").alias("city")).alias("address")).alias("primary_venue")))
    image = F.when(F.col("event_id") % 7 == 0, F.lit('"s.png"')).otherwise('{"url":"o.png"}')
    page = F.concat(F.lit('<html><script>window.__SERVER_DATA__ = {"search_data":{"events":{"results":[7,{"image":'), image, F.lit(","),
                    F.substr(ev, F.lit(2)), F.lit(']}},"page_count":1};</script></html>'))
    return _adapted(t, "eventbrite", _landed(t, page))


@query("adapt_eventbrite_json_ld", _expect(
    name=f"'Talk ' || {N}", description="'about'", location_name="'Room'", latitude="'40.5'", longitude="'-73.5'",
    address="case when event_id % 2 = 0 then '9 Elm' else '9 Elm St' end", city="case when event_id % 2 = 0 then '' else 'queens' end",
    start_time="strftime(ts, '%Y-%m-%dT%H:%M:%SZ')", end_time="strftime(ts, '%Y-%m-%dT%H:%M:%S-05:00')",
    primary_category="case when event_id % 3 = 0 then '' else 'MusicEvent' end",
    thumbnail_image="case event_id % 3 when 0 then 'l.png' when 1 then 'o.png' else 't.png' end", external_link=f"'https://j/' || {N}",
    is_paid="case event_id % 4 when 0 then 'true' when 1 then 'false' when 2 then 'true' else '' end"))
def _(t):
    n, k = _n(), F.col("event_id")
    kind = F.when(k % 3 == 0, F.lit("Event")).otherwise("MusicEvent")
    image = F.when(k % 3 == 0, F.lit('["l.png","x"]')).when(k % 3 == 1, '{"url":"o.png"}').otherwise('"t.png"')
    address = F.when(k % 2 == 0, F.lit('"9 Elm"')).otherwise('{"streetAddress":"9 Elm St","addressLocality":"Queens"}')
    offers = (F.when(k % 4 == 0, F.lit('{"price":"12.50"}')).when(k % 4 == 1, '[{"lowPrice":0}]')
              .when(k % 4 == 2, '{"lowPrice":3}').otherwise('{"price":null,"lowPrice":9}'))
    ev = F.concat(
        F.lit('{"@type":"'), kind, F.lit('","name":"Talk '), n, F.lit('","description":" about ","url":"https://j/'), n,
        F.lit('","startDate":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('+00:00","endDate":"'),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('-05:00","image":'), image, F.lit(',"location":[{"name":"Room","geo":'),
        F.lit('{"latitude":40.5,"longitude":-73.5},"address":'), address, F.lit('}],"offers":'), offers, F.lit("}"))
    block = F.concat(F.lit('<script type="application/ld+json">{"@type":"ItemList","itemListElement":[{"item":{"@type":"Place"}},{"item":'),
                     ev, F.lit("}]}</script>"))
    return _adapted(t, "eventbrite_json_ld", _landed(t, block))


@query("adapt_ra", _expect(
    name=f"'Night ' || {N}", location_name="'Basement'", address="case when event_id % 3 <> 0 then '2 Low St' else '' end",
    start_time="strftime(ts, '%Y-%m-%dT%H:%M:%S')", city="'berlin'", primary_category="'Music'",
    secondary_categories="'DJ ' || event_type || ',DJ B'", thumbnail_image="case when event_id % 4 <> 0 then 'f.jpg' else '' end",
    external_link=f"case when event_id % 2 = 0 then 'https://ra.co/e/' || {N} else 'https://x/' || {N} end"))
def _(t):
    n = _n()
    ev = F.struct(
        n.alias("id"), F.concat(F.lit("Night "), n).alias("title"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("startTime"),
        F.concat(F.when(F.col("event_id") % 2 == 0, "/e/").otherwise("https://x/"), n).alias("contentUrl"),
        F.struct(F.lit("Basement").alias("name"), _every(3, F.lit("2 Low St")).alias("address"),
                 F.struct(F.lit("Berlin").alias("name")).alias("area")).alias("venue"),
        F.array(F.struct(F.concat(F.lit("DJ "), "event_type").alias("name")), F.struct(F.lit("").alias("name")),
                F.struct(F.lit("DJ B").alias("name"))).alias("artists"),
        _every(4, F.array(F.struct(F.lit("f.jpg").alias("filename")))).alias("images"))
    return _adapted(t, "ra", _payload(t, F.struct(F.struct(F.struct(F.array(F.struct(ev.alias("event"))).alias("data")).alias(
        "eventListings")).alias("data"))))


@query("adapt_songkick", _expect(
    name=f"'Tour ' || {N}", description="'loud & live'", location_name="'Arena'",
    latitude="case when event_id % 3 <> 0 then '40.25' else '' end", longitude="case when event_id % 3 <> 0 then '-73.25' else '' end",
    address="'7 Oak, Brooklyn'", start_time=DAY, end_time=DAY, city="'brooklyn'", primary_category="'Music'",
    secondary_categories="case when event_id % 2 = 0 then 'Solo' else 'One,Two' end",
    thumbnail_image="'1.png'", additional_images="case when event_id % 2 = 0 then '' else '2.png' end",
    external_link=f"'https://s/' || {N}", is_paid="case when event_id % 5 = 0 then '' else 'true' end"))
def _(t):
    n, k = _n(), F.col("event_id")
    image = F.when(k % 2 == 0, F.lit('"1.png"')).otherwise('["1.png",{"url":"no"},"2.png"]')
    performer = F.when(k % 2 == 0, F.lit('{"name":"Solo"}')).otherwise('[{"name":"One"},"x",{"name":"Two"}]')
    geo = F.when(k % 3 == 0, F.lit("null")).otherwise('{"latitude":40.25,"longitude":"-73.25"}')
    offers = F.when(k % 5 == 0, F.lit("[]")).otherwise('[{"price":1}]')
    ev = F.concat(
        F.lit('[{"@type":"musicevent","name":"Tour '), n, F.lit('","description":"<p>loud &amp; <b>live</b></p>","url":"https://s/'), n,
        F.lit('","startDate":"'), F.date_format("ts", "yyyy-MM-dd"), F.lit('","endDate":"'), F.date_format("ts", "yyyy-MM-dd"),
        F.lit('","location":{"name":"Arena","geo":'), geo, F.lit(',"address":{"streetAddress":"7 Oak","addressLocality":"Brooklyn"}},"image":'),
        image, F.lit(',"performer":'), performer, F.lit(',"offers":'), offers, F.lit("}]"))
    block = F.concat(F.lit("<html><script type='application/ld+json'>"), ev, F.lit("</script></html>"))
    return _adapted(t, "songkick", _landed(t, block))


@query("adapt_nyc_events", _expect(
    name=f"'Walk ' || {N}", description="case when event_id % 2 = 0 then 'long walk' else 'brief' end", location_name="'Pier'",
    address="'Pier 1'", start_time="strftime(ts, '%Y-%m-%dT%H:%M:%S')", city="'new york'", primary_category="'Tours'",
    secondary_categories="case when event_id % 3 = 0 then 'FREE,Walks' else 'Walks' end", thumbnail_image="'w.jpg'",
    external_link=f"case when event_id % 4 = 0 then 'https://w' else 'https://p/' || {N} end",
    is_paid="case when event_id % 3 = 0 then 'false' else '' end"))
def _(t):
    n, k = _n(), F.col("event_id")
    ev = F.struct(
        n.alias("guid"), F.concat(F.lit("Walk "), n).alias("name"), F.when(k % 2 == 0, "<i>long</i>&nbsp;walk").alias("desc"),
        F.lit("brief").alias("shortDesc"), F.lit("Pier").alias("location"), F.lit(" Pier 1 ").alias("address"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("startDate"),
        F.when(k % 3 == 0, "Tours, FREE ,Walks").otherwise("Tours,,Walks").alias("categories"), F.lit("w.jpg").alias("imageUrl"),
        F.when(k % 4 != 0, F.concat(F.lit("https://p/"), n)).alias("permalink"), F.lit("https://w").alias("website"))
    return _adapted(t, "nyc_events", _payload(t, F.struct(F.array(ev).alias("items"))))


@query("adapt_nyc_parks", _expect(
    name=f"'Park ' || {N}", description="'green'", location_name="case when event_id % 3 = 0 then 'Prospect' else 'Lawn' end",
    latitude="case when event_id % 4 = 0 then '' else '40.66' end", longitude="case when event_id % 4 = 0 then '' else '-73.97' end",
    address="'Prospect'", start_time="strftime(ts, '%Y-%m-%dT%H:%M:00')", end_time=DAY, city="'new york'", primary_category="'Nature'",
    secondary_categories="event_type", thumbnail_image="''", external_link=f"'https://k/' || {N}"))
def _(t):
    n, k = _n(), F.col("event_id")
    ev = F.struct(
        n.alias("guid"), F.concat(F.lit("Park "), n).alias("title"), F.lit("<p>green</p>").alias("description"),
        F.when(k % 3 != 0, "Lawn").alias("location"), F.lit("Prospect").alias("parknames"),
        F.date_format("ts", "yyyy-MM-dd").alias("startdate"), F.lower(F.date_format("ts", "h:mm a")).alias("starttime"),
        F.date_format("ts", "yyyy-MM-dd").alias("enddate"), F.lit("dusk").alias("endtime"),
        F.when(k % 4 == 0, "40.66").otherwise("40.66, -73.97").alias("coordinates"),
        F.concat(F.lit("Nature | "), "event_type").alias("categories"), F.concat(F.lit("http://k/"), n).alias("link"))
    return _adapted(t, "nyc_parks", _payload(t, F.array(ev)))


@query("ingest_ticketmaster", f"""
select event_id as page_no, strftime(local, '%Y-%m-%d') as day, 'Show ' || {N} as name from (
  select *, timezone('America/New_York', timezone('UTC', date_trunc('second', ts))) as local from events)
where cast(local as date) between date '2024-01-05' and date '2024-01-20'""")
def _(t):
    d = adapt_source(_ticketmaster(t), "ticketmaster", "2024-01-05", "2024-01-20", city="New York")
    return d.select(F.col("_ord.page_no").alias("page_no"), F.col("day").cast("string").alias("day"), "name")


DISPLAY_IN = """
select o_orderkey, case o_orderkey % 4 when 0 then null else 'Order @ 5% & ' || o_orderpriority end as event_name, o_orderstatus as name,
  substr(cast(o_orderdate as string), 1, 10) as start_date, case when o_orderkey % 3 = 0 then '7:05 PM' else '' end as time,
  case when o_orderkey % 2 = 0 then '' else '1999-12-31' end as end_date, 'Dock "A" ' || o_orderstatus as place,
  case when o_orderkey % 5 = 0 then o_orderstatus else '12 Row' end as street, 'Port' as town, o_orderpriority as notes from {orders}
"""


@query("display_events", """
select o_orderkey, case when name2 <> '' then name2 else 'Untitled Event' end as title,
  strftime(o_orderdate, '%A, %B %-d, %Y') || case when o_orderkey % 2 = 1 and strftime(o_orderdate, '%Y-%m-%d') <> '1999-12-31'
    then ' – Friday, December 31, 1999' else '' end as date,
  case when o_orderkey % 3 = 0 then '7:05 PM' else '' end as time,
  case when o_orderkey % 5 = 0 then 'Dock "A" ' || o_orderstatus || ', Port' else 'Dock "A" ' || o_orderstatus || ', 12 Row, Port' end as location,
  o_orderpriority as description, '' as image, '' as url
from (select *, case when o_orderkey % 4 = 0 then '' else 'Order 5 and ' || o_orderpriority end as name2 from orders)""")
def _(t):
    rows = pick_aliases(t.sql(DISPLAY_IN).drop("name"), carry=("o_orderkey",))
    return display_events(rows, carry=("o_orderkey",))


@query("pick_aliases", """
select o_orderkey, coalesce(nullif(trim(o_orderstatus), ''), '') as title, strftime(o_orderdate, '%Y-%m-%d') as start_raw,
  case when o_orderkey % 2 = 0 then '' else '1999-12-31' end as end_raw, 'Port' as city from orders""")
def _(t):
    return pick_aliases(t.sql(DISPLAY_IN), carry=("o_orderkey",)).select("o_orderkey", "title", "start_raw", "end_raw", "city")


def city_job_sql(city: str, tz: str, blocks) -> str:
    """The city file of one city job, from the first listing of every (name, start text, venue)."""
    shown = "'%-m/%-d/%Y  %I:%M:%S %p'"

    def in_zone(text: str, utc_hours: int) -> str:
        return f"strftime(timezone('{tz}', timezone('UTC', cast({text} as timestamp) + interval {utc_hours} hour)), {shown})"

    plain = ", ".join(f"trim({c}) as {c}" for c in ("name", "description", "location_name", "address", "latitude", "longitude",
                                                    "thumbnail_image", "additional_images", "external_link"))
    return f"""
select f._ord, '' as id, {plain}, '{city}' as city,
  case when start_time in ('tba', '') or f._ord % 5 = 1 then ''
    when f._ord % 5 = 2 then {in_zone("replace(replace(start_time, 'T', ' '), 'Z', '')", 0)}
    else strftime(cast(replace(start_time, 'T', ' ') as timestamp), {shown}) end as start_time,
  case when end_time = '' then '' when length(end_time) = 10 then strftime(cast(end_time as timestamp), {shown})
    else {in_zone("replace(substr(end_time, 1, 19), 'T', ' ')", 5)} end as end_time,
  {_keyword_sql(blocks, 'low', 'primary_category')} as primary_category, g.tags,
  lower(trim(is_paid)) in ('true', '1', 'yes') as is_paid
from (select *, lower(array_to_string(list_filter([name, description, primary_category, secondary_categories], lambda x: x <> ''), ' ')) as low,
    row_number() over (partition by lower(trim(name)), trim(start_time), lower(trim(location_name)) order by _ord) as rn
  from ({LISTINGS_SQL})) f join ({TAGS_TEXT}) g on g._ord = f._ord where rn = 1"""


@query("clean_city_new_york", city_job_sql("New York", "America/New_York", ENGLISH))
def _(t):
    return clean_city_job(t.sql(LISTINGS), "new_york")


@query("clean_city_mexico_city", city_job_sql("Mexico City", "America/Mexico_City", spanish()))
def _(t):
    return clean_city_job(t.sql(LISTINGS), "mexico_city")


@query("clean_city_counts", f"""
select count(*) as rows_read, count(distinct (lower(trim(name)), trim(start_time), lower(trim(location_name)))) as rows_kept
from ({LISTINGS_SQL})""")
def _(t):
    raw = t.sql(LISTINGS)
    return dedupe_counts(raw, clean_city_job(raw, "new_york"))


def _run(t):
    return clean_listings(t.sql(LISTINGS), city_dimension(t.spark))


def _offset(local: str, utc: str) -> str:
    """Wall clock with its distance to UTC, whole hours west."""
    return f"strftime({local}, '%Y-%m-%dT%H:%M:%S') || '-0' || cast(datediff('hour', {local}, {utc}) as varchar) || ':00'"


PUBLISHED = BOTH + f""",
c as (select _ord, start_local, has_time from ({CLEAN})),
p as (select substr(sha1(k.city || '|' || day || '|' || name_key || '|' || venue_key), 1, 12) as id, trim(l.name) as name,
  nullif(k.description, '') as description, nullif(trim(l.location_name), '') as venue, nullif(k.address, '') as address, k.city,
  case l.city when 'staten island' then 'Staten Island' when 'o''neil ST-marie' then 'O''Neil St-Marie' end as "venueArea",
  k.lat as latitude, k.lon as longitude,
  case when k.lat is not null then k.lat between lat_lo and lat_hi and k.lon between lon_lo and lon_hi end as "inCityArea",
  cast(day as date) as date,
  case when has_time then {_offset('start_local', "timezone('UTC', timezone(tz, start_local))")} end as "startTime",
  {_offset('k.end_local', 'k.end_utc')} as "endTime", has_time as "hasTime",
  case when has_time then strftime(start_local, '%-I:%M %p') else 'All day' end as "displayTime",
  nullif(case when g.p <> '' then g.p else coalesce(g.tags[1], '') end, '') as category, array_to_string(k.tags, '|') as tags,
  k.images[1] as image, array_to_string(k.images, '|') as images,
  case when starts_with(external_link, 'http://') then 'https://' || substr(external_link, 8)
    when starts_with(external_link, 'https://') then external_link end as url, k.paid as "isPaid",
  array_to_string(list_transform(k.sources, lambda x: case x when 'ticketmaster' then 'Ticketmaster' when 'eventbrite' then 'Eventbrite'
    when 'ra' then 'Resident Advisor' when 'songkick' then 'Songkick' when 'nyc_events' then 'NYC Events Calendar'
    when 'nyc_parks' then 'NYC Parks' else x end), '|') as sources, k._ord
  from merged_rows k join ({LISTINGS_SQL}) l on l._ord = k.base_ord join c on c._ord = k.base_ord join ({TAGS}) g on g._ord = k.base_ord
  join (select * from {CITIES_SQL}) z on z.canonical_city = k.city)"""


@query("clean_listings", PUBLISHED + """
select * exclude (_ord), row_number() over (order by city, date, coalesce("startTime", ''), name, _ord) - 1 as position from p""")
def _(t):
    # The position is that in which the events come, not one computed from their values.
    d = number_rows(_run(t).events.withColumn("at", F.monotonically_increasing_id()), [F.col("at")], "position").drop("at")
    return d.select(*[F.array_join(c, "|").alias(c) if c in ("tags", "images", "sources") else F.col(c) for c in d.columns])


def _facet(key: str) -> str:
    return f"(select string_agg(k || '=' || n, ';' order by k) from (select {key} as k, count(*) as n from p group by 1))"


@query("clean_report", PUBLISHED + f""",
a as (select l._ord, trim(l.name) <> '' and trim(l.start_time) <> '' as ok, start_local is not null as timed,
  case lower(trim(l.is_paid)) when 'true' then 1 when 'false' then 0 end as price,
  case when l.latitude not in ('', '0') then not (cast(l.latitude as double) between lat_lo and lat_hi
    and cast(l.longitude as double) between lon_lo and lon_hi) else false end as outside
  from ({PARSED}) l join (select * from {CITIES_SQL}) z using (city_folder)),
d as (select count(*) filter (where leader <> _ord) as fuzzy from f)
select 'load' as step, 'rows' as metric, count(*) as value from a union all select 'load', 'unknown_city', 0
union all select 'schema', 'kept', count(*) from a where ok union all select 'schema', 'dropped', count(*) from a where not ok
union all select 'time', 'dropped', count(*) from a where ok and not timed
union all select 'geo', 'outside', count(*) from a where ok and timed and outside
union all select 'price', 'paid', count(*) from a where ok and timed and price = 1
union all select 'price', 'free', count(*) from a where ok and timed and price = 0
union all select 'price', 'unknown', count(*) from a where ok and timed and price is null
union all select 'dedupe', 'rows_in', count(*) from a where ok and timed
union all select 'dedupe', 'events_out', count(*) from p
union all select 'dedupe', 'merged_exact', sum(n_merged)::bigint from v union all select 'dedupe', 'merged_fuzzy', fuzzy from d
union all select 'fill', 'description', count(description) from p union all select 'fill', 'venue', count(venue) from p
union all select 'fill', 'address', count(address) from p union all select 'fill', 'latitude', count(latitude) from p
union all select 'fill', 'endTime', count("endTime") from p union all select 'fill', 'category', count(category) from p
union all select 'fill', 'image', count(image) from p union all select 'fill', 'url', count(url) from p""")
def _(t):
    return _run(t).report


@query("clean_meta", PUBLISHED + f"""
select count(*) as "totalEvents", count(*) filter (where "isPaid") as paid, count(*) filter (where not "isPaid") as free,
  count(*) filter (where "isPaid" is null) as "priceUnknown", count(latitude) as "withCoordinates",
  'isPaid null = unknown (not free); endTime null = source does not publish it; inCityArea false = suburb within search radius'
    as "schemaNote", {_facet('city')} as cities, {_facet("strftime(date, '%Y-%m-%d')")} as dates,
  {_facet("case when contains(sources, '|') then 'Multiple' else sources end")} as sources from p""")
def _(t):
    def listed(c):
        return F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"])), ";").alias(c)

    return _run(t).meta.select("totalEvents", "paid", "free", "priceUnknown", "withCoordinates", "schemaNote",
                               listed("cities"), listed("dates"), listed("sources"))


@query("daily_rows", PUBLISHED + """
select case city when 'New York' then 'New_York_US' when 'Mexico City' then 'Mexico_City_MX' else 'Los_Angeles_US' end as city_folder,
  """ + ", ".join(f"coalesce(replace(cast(\"{c}\" as varchar), '|', ';'), '') as \"{c}\"" for c in DAILY_COLUMNS) + " from p")
def _(t):
    return daily_export(t.sql(LISTINGS), city_dimension(t.spark))


