"""Rules that differ in rare rows: unknown cities, repeated keys, long lists, odd page structures."""

import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from marquee.functions import values as V
from marquee.functions.markup import VOID_TAGS, marked_text
from marquee.operators import hosts, joins
from marquee.operators.pages import extract_events
from marquee.plans.clean import clean_listings
from marquee.plans.dashboard import rolling_trends
from marquee.schema import RAW_COLUMNS, city_dimension
from marquee.sources import listings
from marquee.sources.adapters import rest


def test_blank_primary_is_other_and_white_space_is_none(spark):
    rows = spark.createDataFrame([("",), (None,), ("  ",), ("n/a",), (" Jazz ",)], "p string")
    got = [r.c for r in rows.select(V.keyword_category(F.lit("nothing"), F.col("p"), [("Music", ["rock"])]).alias("c")).collect()]
    assert got == ["other", "other", "Other", "Other", "jazz"]


def test_lists_have_no_entry_limit(spark):
    n = 1_000_003
    parts = F.split(F.repeat(F.lit("x,"), n), ",")
    assert spark.range(1).select(F.length(rest(parts)).alias("n")).head().n == 2 * (n - 1)


def test_unknown_city_is_counted(spark):
    base = {c: "" for c in RAW_COLUMNS} | {"name": "Show", "start_time": "2024-01-05 20:00", "location_name": "Hall"}
    rows = [base | {"source": "ra", "city_folder": f, "_ord": i} for i, f in enumerate(["New_York_US", "Atlantis"])]
    run = clean_listings(spark.createDataFrame(rows), city_dimension(spark))
    report = {(r.step, r.metric): r.value for r in run.report.collect()}
    assert run.events.count() == 1
    assert report[("load", "rows")] == 2 and report[("load", "unknown_city")] == 1 and report[("schema", "kept")] == 1


def test_repeated_addresses_do_not_multiply_events(spark):
    events = spark.createDataFrame([(1, "", "", "1 Main St", "NY"), (2, "40.5", "-74.0", "1 Main St", "NY"), (3, "", "", "", "NY")],
                                   "id int, latitude string, longitude string, address string, city string")
    places = spark.createDataFrame([("1 main st", "NY", 40.1, -74.1), ("1 main st", "NY", 40.2, -74.2)], "address_key string, city string, g_lat double, g_lon double")
    got = {r.id: (r.latitude, r.geocoded) for r in joins.fill_coordinates(events, places).collect()}
    assert got == {1: ("40.1", True), 2: ("40.5", False), 3: ("", False)}


def test_rows_of_one_page_have_the_sites_of_their_own_hosts(spark):
    rows = spark.createDataFrame([(1, "a.lu.ma"), (1, "www.meetup.com"), (1, None), (2, "a.lu.ma")], "page_id int, host string")
    rules = spark.createDataFrame([(0, "Luma", "lu.ma"), (1, "Meetup", "meetup.com"), (2, "late", "a.lu.ma")], "ord int, site string, domain string")
    got = sorted(((r.page_id, r.host, r.site) for r in joins.match_site(rows, rules).collect()), key=str)
    assert got == sorted([(1, "a.lu.ma", "Luma"), (1, "www.meetup.com", "Meetup"), (1, None, None), (2, "a.lu.ma", "Luma")], key=str)


def test_events_without_host_stay(spark):
    events = spark.sql("select id, host, timestamp '2024-01-01 10:00:00' as date from values (1, 'a'), (2, null), (3, null) as t(id, host)")
    got = {r.id: r.last_event for r in hosts.attach_activity(events, "host", "date", "2024-02-01").collect()}
    assert set(got) == {1, 2, 3} and got[2] is None and got[1] is not None


def test_later_today_is_outside_the_rolling_window(spark):
    events = spark.sql("""select timestamp '2024-05-01 00:00:00' as date, 'c' as city, 'p' as primary_category, 1.0 as latitude, 1.0 as longitude
        union all select timestamp '2024-05-01 18:00:00', 'c', 'p', 1.0, 1.0""")
    assert rolling_trends(events, "2024-05-01")["kpis"].head().rows == 1


def _page(key, url, body):
    return (key, url, f"<html><head></head><body>{body}</body></html>")


def test_page_cascade(spark):
    script = '<script type="application/ld+json">{}</script>'
    listed = script.format('{"@type":"ItemList","itemListElement":[{"item":{"@type":"Event","name":"listed"}}]}')
    near = script.format('{"@type":["EventSeries"],"name":"near"}')
    exact = script.format('{"@type":["Thing","Event"],"name":"exact"}')
    broken = script.format('{"@type":"Event",')
    pages = [
        _page(1, "https://a.org/x", listed + "<h1>First</h1>"), _page(2, "https://a.org/x", near + "<h1>Second</h1>"),
        _page(3, "https://a.org/x", broken + exact), _page(3, "https://a.org/x", broken + exact),
        _page(4, "https://www.eventbrite.com/e", '<div data-event-title="no"></div><h1 data-event-title="Yes">x</h1><i data-event-date="May 1">d</i>'),
        _page(5, "https://www.meetup.com/e", '<h1>Meet</h1><time datetime="2024-07-21T22:00">x</time>'),
        _page(6, "https://lu.ma/e", '<h1>Luma</h1><p data-testid="event-date">Soon</p><p data-testid="event-location">Here</p>'),
        _page(7, "https://partiful.com/e", '<h1>Party</h1><p class="event-date big">Friday</p><p class="event-time">9 PM</p>'),
        _page(8, "https://notlu.ma.org/e", '<h1>Plain</h1>'),
    ]
    events = extract_events(spark.createDataFrame(pages, "page_id int, url string, html string"))
    assert "Exchange" not in events._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.page_id, r.source, r.title, r.date, r.time, r.location) for r in events.collect())
    assert got == [
        (1, "generic", "First", "", "", ""), (2, "generic", "Second", "", "", ""),
        (3, "jsonld", "exact", "", "", ""), (3, "jsonld", "exact", "", "", ""),
        (4, "site-config", "Yes", "May 1", "", ""), (5, "site-config", "Meet", "Sunday, July 21", "10:00 PM", ""),
        (6, "site-config", "Luma", "Soon", "", "Here"), (7, "site-config", "Party", "Friday", "9 PM", ""), (8, "generic", "Plain", "", "", "")]


def test_missing_folders_give_no_rows(spark, tmp_path):
    rows = listings.read_listings(spark, str(tmp_path), cities=["Nowhere"], dates=["2024-01-01"])
    assert rows.count() == 0 and {"source", "landed_date", "city_folder", "_ord", "name"} <= set(rows.columns)


def test_many_listed_files_keep_their_order(spark, tmp_path):
    header = ",".join(RAW_COLUMNS)
    paths = []
    for i in range(300):
        path = tmp_path / f"{(i * 7919) % 300:04d} é.csv"
        path.write_text(f"{header}\n" + ",".join([f"n{i}"] + [""] * (len(RAW_COLUMNS) - 1)) + "\n")
        paths.append(str(path))
    first = RAW_COLUMNS[0]
    rows = listings.read_city_files(spark, paths).orderBy("_ord").select(first).collect()
    assert [r[0] for r in rows] == [f"n{i}" for i in range(300)]


def test_publish_order(spark):
    base = {c: "" for c in RAW_COLUMNS} | {"location_name": "Hall"}
    shows = [("Mexico_City_MX", "2024-01-06 20:00", "B"), ("New_York_US", "2024-01-06 09:00", "A"), ("New_York_US", "2024-01-05", "Z"),
             ("New_York_US", "2024-01-05 21:00", "C"), ("New_York_US", "2024-01-05", "Y"), ("Mexico_City_MX", "2024-01-06 20:00", "A")]
    rows = [base | {"source": "ra", "city_folder": f, "start_time": t, "name": n, "_ord": i} for i, (f, t, n) in enumerate(shows)]
    got = [(e.city, str(e.date), e.startTime or "", e.name) for e in clean_listings(spark.createDataFrame(rows), city_dimension(spark)).events.collect()]
    assert got == sorted(got) and [g[3] for g in got] == ["A", "B", "Y", "Z", "C", "A"]


class _Texts(HTMLParser):
    """Text of the first element for which ``wanted`` holds, by a parser of its own."""

    def __init__(self, wanted):
        super().__init__()
        self.wanted, self.open, self.text, self.done = wanted, [], "", False

    def handle_starttag(self, tag, attrs):
        if tag == "p" and self.open == ["p"]:
            self.handle_endtag("p")
        if not self.done and (self.open or self.wanted(dict(attrs))):
            if tag not in VOID_TAGS:
                self.open.append(tag)
            elif not self.open:
                self.done = True

    def handle_endtag(self, tag):
        if tag in self.open:
            while self.open.pop() != tag:
                pass
            self.done = not self.open

    def handle_data(self, data):
        if self.open and not self.done:
            self.text += data


def _text(html, wanted):
    parser = _Texts(wanted)
    parser.feed(html)
    return parser.text.strip()


def _nested(rng, depth):
    tags = ("div", "span", "p", "b", "ul", "section")
    inner = "".join(rng.choice(("words ", "x < y ", "<br>", '<img src="i">', "<!-- </div> -->", _nested(rng, depth - 1) if depth else "end"))
                    for _ in range(rng.randrange(1, 5)))
    tag = rng.choice(tags if "<p" not in inner else tags[:2] + tags[3:])
    return f"<{tag} class='c{depth}'>{inner}</{tag}>"


def test_element_text_goes_to_its_own_closing_tag(spark):
    rng = random.Random(3)
    rows = [(i, f"<main>{_nested(rng, 3)}<div id='a' data-k='v'>{_nested(rng, 3)} tail{_nested(rng, 2)}</div><i>after</i></main>") for i in range(80)]
    rows += [(80, "<p data-k='v'>one <b>two</b><p>three"), (81, "<img data-k='v'>text"), (82, "<div data-k='v'>no end <span>x"), (83, "nothing")]
    got = {r.i: r.text for r in spark.createDataFrame(rows, "i int, html string").select(
        "i", marked_text(F.col("html"), "data-k", "v").alias("text")).collect()}
    assert got == {i: _text(html, lambda a: a.get("data-k") == "v") for i, html in rows}


def test_nested_microdata_and_site_rules(spark):
    micro = ('<div itemscope itemtype="https://schema.org/Event"><h3 itemprop="name"><span>Big</span> <b>Gig</b></h3><div itemprop="description"><div>One</div>'
             '<div>two</div></div><div itemprop="location"><div><span itemprop="name">The <i>Club</i></span></div><p itemprop="address"><b>5th</b> Ave</p></div></div>'
             '<p itemprop="image">outside</p>')
    pages = [
        _page(1, "https://a.org/x", micro),
        _page(2, "https://www.eventbrite.com/e", '<h1 data-event-title="T">x</h1><div class="event-description"><p>All <b>are</b></p><div>welcome</div> here</div>'),
        _page(3, "https://www.meetup.com/e", '<h1>M</h1><div class="venueDisplay-venue-address"><span>1 Main</span>, <div>Town</div></div>'),
        _page(4, "https://lu.ma/e", '<h1>L</h1><div data-testid="event-location"><div><div>Roof</div></div> top</div>'),
        _page(5, "https://partiful.com/e", '<h1>P</h1><div class="event-date big"><span>Fri</span>day</div>'),
    ]
    rows = {r.page_id: r for r in extract_events(spark.createDataFrame(pages, "page_id int, url string, html string")).collect()}
    assert (rows[1].source, rows[1].title, rows[1].description, rows[1].location, rows[1].image) == ("microdata", "Big Gig", "Onetwo", "The Club, 5th Ave", "")
    assert (rows[2].description, rows[3].location, rows[4].location, rows[5].date) == ("All arewelcome here", "1 Main, Town", "Roof top", "Friday")
