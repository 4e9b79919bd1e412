"""Readers, sinks, streaming landing and page cases on small files."""

import csv
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from marquee.operators.display import display_events
from marquee.operators.pages import extract_events, page_state_events
from marquee.plans.clean import clean_listings
from marquee.plans.city import clean_city_job
from marquee.schema import CITY_FILE_COLUMNS, DAILY_COLUMNS, RAW_COLUMNS, city_dimension
from marquee.sources import listings as L
from marquee.sources import sinks
from marquee.sources.adapters import adapt_source
from marquee.streaming.landing import land, land_batch


def put(path, rows, header=RAW_COLUMNS):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.DictWriter(f, fieldnames=header)
        w.writeheader()
        for r in rows:
            w.writerow({c: r.get(c, "") for c in header})


def row(name, **given):
    return {"name": name, "start_time": "2026-08-01T19:00:00", "location_name": "Hall"} | given


def landed(tmp_path):
    root = str(tmp_path / "result")
    put(f"{root}/New_York_US/2026-08-01/ticketmaster.csv", [row("B"), row('q "x"\nnew line', description="a,b")])
    put(f"{root}/New_York_US/2026-08-02/ra.csv", [row("C", start_time="2026-08-02")])
    put(f"{root}/Mexico_City_MX/2026-08-01/eventbrite.csv", [row("A"), row("A")])
    put(f"{root}/New_York_US/notes/ra.csv", [row("D")])
    return root


def test_listing_folders(spark, tmp_path):
    root = landed(tmp_path)
    got = L.read_listings(spark, root, ["New_York_US", "Mexico_City_MX"], ["2026-08-01", "2026-08-02"]).orderBy("_ord").collect()
    assert [(r["name"], r["source"], r["city_folder"], r["landed_date"]) for r in got] == [
        ("B", "ticketmaster", "New_York_US", "2026-08-01"),
        ('q "x"\nnew line', "ticketmaster", "New_York_US", "2026-08-01"),
        ("C", "ra", "New_York_US", "2026-08-02"),
        ("A", "eventbrite", "Mexico_City_MX", "2026-08-01"), ("A", "eventbrite", "Mexico_City_MX", "2026-08-01")]
    assert len({r["_ord"] for r in got}) == 5
    assert [r["date"] for r in L.discover_dates(spark, root).collect()] == ["2026-08-01", "2026-08-02"]


def test_publish_and_daily_files(spark, tmp_path):
    raw = L.read_listings(spark, landed(tmp_path), ["New_York_US", "Mexico_City_MX"], ["2026-08-01", "2026-08-02"])
    cities = city_dimension(spark)
    run = clean_listings(raw, cities)
    out = str(tmp_path / "out")
    sinks.write_events(run.events, run.meta, f"{out}/json")
    back = spark.read.json(f"{out}/json/events")
    assert back.count() == 4 and set(back.columns) >= {"id", "isPaid", "inCityArea", "sources"}
    assert spark.read.json(f"{out}/json/meta").first()["totalEvents"] == 4
    sinks.write_daily(sinks.flat_events(run.events, cities), f"{out}/daily")
    assert sorted(os.listdir(f"{out}/daily/city_folder=New_York_US")) == ["day=2026-08-01", "day=2026-08-02"]
    daily = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{out}/daily")
    assert [c for c in daily.columns if c in DAILY_COLUMNS] == DAILY_COLUMNS and daily.count() == 4
    sinks.write_report(run.report, f"{out}/report")
    report = spark.read.option("header", True).csv(f"{out}/report")
    assert report.count() == 21 and report.filter("metric = 'unknown_city'").head()["value"] == "0"


def test_city_files_first_wins(spark, tmp_path):
    a, b = str(tmp_path / "in/b.csv"), str(tmp_path / "in/sub/a.csv")
    put(a, [row("Jazz", description="from b"), row("Yoga")])
    put(b, [row(" jazz ", description="from a", is_paid="yes")])
    by_path = clean_city_job(L.read_city_files(spark, str(tmp_path / "in")), "new_york").orderBy("_ord").collect()
    assert [(r["name"], r["description"], r["primary_category"]) for r in by_path] == [
        ("Jazz", "from b", "Music"), ("Yoga", "", "Sports & Fitness")]
    listed = clean_city_job(L.read_city_files(spark, [b, a]), "new_york").orderBy("_ord")
    rows = listed.collect()
    assert [(r["name"], r["description"], r["is_paid"]) for r in rows] == [("jazz", "from a", True), ("Yoga", "", False)]
    assert rows[0]["start_time"] == "8/1/2026  07:00:00 PM"
    sinks.write_city(listed, str(tmp_path / "city"))
    assert spark.read.option("header", True).csv(str(tmp_path / "city")).columns == CITY_FILE_COLUMNS


def test_aliased_files(spark, tmp_path):
    folder = str(tmp_path / "mixed")
    put(f"{folder}/one.csv", [{"title": "A & B", "start_date": "2026-08-01", "end_date": "2026-08-03", "venue": "Hall",
                               "city": "Rome"}], ["title", "start_date", "end_date", "venue", "city"])
    put(f"{folder}/two.csv", [{"event_name": "", "date": "soon", "time": "19:00", "place": "Barn", "street": "1 Row",
                               "town": "Ulm"}], ["event_name", "date", "time", "place", "street", "town"])
    got = display_events(L.read_aliased(spark, folder)).orderBy("title").collect()
    assert [tuple(r)[:4] for r in got] == [
        ("A and B", "Saturday, August 1, 2026 – Monday, August 3, 2026", "", "Hall, Rome"),
        ("Untitled Event", "soon", "19:00", "Barn, 1 Row, Ulm")]
    sinks.write_display(display_events(L.read_aliased(spark, folder)), str(tmp_path / "display"))
    assert spark.read.json(str(tmp_path / "display")).count() == 2


def test_many_headers_in_one_scan(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    want = []
    for i in range(400):
        names = [["name", "title", "event_name", "event"][i % 4], f"extra{i % 50}", ["city", "town"][i % 2], " venue "]
        names = names[i % 3:] + names[:i % 3]
        cells = {"extra": "x,y", "city": f"c{i}", "town": f"c{i}", " venue ": "Hall\n2"}
        with open(folder / f"{i:04d}.csv", "w", newline="", encoding="utf-8") as f:
            w = csv.writer(f)
            w.writerow(names)
            for k in range(i % 3):
                title = f"007.{i}.{k}"
                w.writerow([cells.get("extra" if n.startswith("extra") else n, title) for n in names])
                want.append((title, f"c{i}", "Hall\n2"))
    rows = L.read_aliased(spark, str(folder))
    assert sorted((r["title"], r["city"], r["venue"]) for r in rows.collect()) == sorted(want)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    with open(folder / "wide.csv", "w") as f:
        f.write("name\n" + ",".join("x" * (L.MOST_CELLS + 1)) + "\n")
    with pytest.raises(Exception, match="more than"):
        L.read_aliased(spark, str(folder)).collect()


def test_payload_files_to_listing_files(spark, tmp_path):
    root = str(tmp_path / "landed")
    os.makedirs(f"{root}/ticketmaster/2026-08-01")
    event = {"name": "Show", "dates": {"start": {"dateTime": "2026-08-02T02:00:00Z"}}, "_embedded": {"venues": [{"name": "Hall"}]}}
    for i, events in enumerate([[event, event | {"name": "Late", "dates": {}}], [event | {"info": "again"}]]):
        with open(f"{root}/ticketmaster/2026-08-01/{i}.json", "w") as f:
            json.dump({"_embedded": {"events": events}}, f)
    pages = L.read_payloads(spark, root, "ticketmaster").drop("landed_date")
    got = adapt_source(pages, "ticketmaster", "2026-08-01", city="New York").collect()
    assert [(r["name"], str(r["day"]), r["city"], r["description"]) for r in got] == [("Show", "2026-08-01", "new york", "")]
    everything = adapt_source(pages, "ticketmaster")
    assert {r["name"] for r in everything.collect()} == {"Show", "Late"}
    sinks.write_listings(adapt_source(pages, "ticketmaster", "2026-08-01"), str(tmp_path / "sites"))
    assert os.path.isdir(str(tmp_path / "sites/day=2026-08-01/site=ticketmaster"))


def test_landing_stream_takes_only_new_files(spark, tmp_path):
    src, table, ckpt = (str(tmp_path / n) for n in ("src", "table", "ckpt"))
    put(f"{src}/d/one.csv", [row("A", description="first"), row(" a "), row("B")])
    put(f"{src}/d/two.csv", [row("B", description="second"), row("a")])
    land(spark, src, table, ckpt).awaitTermination()
    first = sorted((r["name"], r["description"]) for r in spark.read.parquet(table).collect())
    assert first == [("A", "first"), ("B", None)]
    # A late file whose time lies long before: its known listings do not come back.
    put(f"{src}/c/late.csv", [row("A", description="late"), row("C")])
    os.utime(f"{src}/c/late.csv", (time.time() - 300 * 86_400,) * 2)
    land(spark, src, table, ckpt).awaitTermination()
    land(spark, src, table, ckpt).awaitTermination()
    assert sorted((r["name"], r["description"]) for r in spark.read.parquet(table).collect()) == [*first, ("C", None)]


def test_a_landed_batch_that_runs_again_gives_the_same_rows(spark, tmp_path):
    table = str(tmp_path / "table")
    columns = "listing_key string, file string, name string"

    def batch(*rows):
        return spark.createDataFrame(rows, columns).coalesce(1)

    land_batch(batch(("k1", "b", "later"), ("k1", "a", "first"), ("k2", "a", "x")), 0, table)
    for _ in range(2):
        land_batch(batch(("k2", "c", "again"), ("k3", "c", "new")), 1, table)
    rows = sorted((r["listing_key"], r["name"], r["landed_batch"]) for r in spark.read.parquet(table).collect())
    assert rows == [("k1", "first", 0), ("k2", "x", 0), ("k3", "new", 1)]
    land_batch(batch(("k2", "a", "x")), 0, table)
    assert sorted(r["listing_key"] for r in spark.read.parquet(table).collect()) == ["k2", "k3"]


def test_one_reader_of_each_kind(spark, tmp_path):
    """City, host and page readers, and the clustered result as CSV."""
    put(str(tmp_path / "city.csv"), [{"name": "A", "date": "2026-02-03 10:00:00"}, {"name": "B", "date": "soon"}], ["name", "date"])
    city = L.read_city_events(spark, str(tmp_path / "city.csv")).orderBy("name").collect()
    assert [(r["event_year"], r["date"] is None) for r in city] == [(2026, False), (None, True)]
    put(str(tmp_path / "host.csv"), [{"id": "1", "date": "2026-02-03", "latitude": "40.5", "longitude": "x"}], ["id", "date", "latitude", "longitude"])
    host = L.read_host_events(spark, str(tmp_path / "host.csv")).first()
    assert (host["latitude"], host["longitude"]) == (40.5, None)
    spark.createDataFrame([(1, "u", "<p>", "more")], "page_id int, url string, html string, extra string").write.parquet(str(tmp_path / "pages"))
    assert [tuple(r) for r in L.read_pages(spark, str(tmp_path / "pages")).collect()] == [(1, "u", "<p>")]
    result = spark.createDataFrame([(1, ["a", "b"], [0.5], None)], "id int, tags array<string>, embedding array<double>, gone string")
    sinks.write_result(result, str(tmp_path / "result"))
    back = spark.read.option("header", True).csv(str(tmp_path / "result"))
    assert back.columns == ["id", "tags", "gone"] and tuple(back.first()) == ("1", "a;b", None)


def pages(spark, *html, url="https://x.example.com/e"):
    return spark.createDataFrame([(i, url, h) for i, h in enumerate(html)], "page_id long, url string, html string")


def test_page_strategies(spark):
    ld = '<script type="application/ld+json">%s</script>'
    got = {r["page_id"]: r for r in extract_events(pages(
        spark,
        "<head>" + ld % "{bad" + ld % '{"@type":"Event","name":"L","startDate":"2026-08-01","location":"Here","image":{"url":"u"}}'
        + "</head><body><h1>H</h1></body>",
        '<body><div itemtype="http://schema.org/Event"><span itemprop="name">M</span></div></body>',
        '<head><meta name="og:title" content="T &amp; U"></head><body><h1>H</h1>Join on Jan 5, 2027 at 7:30 PM - 9 or 8:00PM</body>',
        "<body><h2>Second</h2><p>no title</p></body>", "<body><p>nothing</p></body>")).collect()}
    assert (got[0]["source"], got[0]["title"], got[0]["date"], got[0]["location"], got[0]["image"]) == (
        "jsonld", "L", "Saturday, August 1, 2026", "Here", "u")
    assert (got[1]["source"], got[1]["title"]) == ("microdata", "M")
    assert (got[2]["source"], got[2]["title"], got[2]["date"], got[2]["time"]) == ("generic", "T & U", "Jan 5, 2027", "7:30 PM")
    assert got[3]["title"] == "Second" and got[4]["success"] is False and got[4]["error"]


def test_site_rules(spark):
    html = '<body><h1 data-event-title="E">x</h1><div class="event-details__time">7 PM</div></body>'
    got = extract_events(pages(spark, html, url="www.eventbrite.com/e/1")).first()
    assert (got["source"], got["title"], got["time"]) == ("site-config", "E", "7 PM")
    luma = '<body><h1>L</h1><span data-testid="event-date">Soon</span></body>'
    got = extract_events(pages(spark, luma, url="https://sub.lu.ma/x")).first()
    assert (got["source"], got["title"], got["date"]) == ("site-config", "L", "Soon")


def test_page_state_with_braces_in_strings(spark):
    html = '<script>window.__SERVER_DATA__ = {"search_data":{"events":{"results":[{"name":"a } b"}]}}};\nwindow.z={};</script>'
    rows = page_state_events(pages(spark, html, "<p>none</p>").select("page_id", "html")).orderBy("page_id").collect()
    assert [(r["state_parsed"], r["pos"]) for r in rows] == [(True, 0), (False, None)]


def test_flat_text_of_lists_and_flags(spark):
    df = spark.range(1).select(F.array(F.lit("a"), F.lit("b")).alias("l"), F.lit(True).alias("f"),
                               F.lit(None).cast("string").alias("n"))
    assert tuple(df.select(*[sinks.flat_text(df, c) for c in df.columns]).first()) == ("a;b", "true", "")


def test_a_listing_file_may_be_a_folder_of_parts(spark, tmp_path):
    """Rows of one path lie in several files, none with all of them; the reader numbers them in the order they had."""
    from marquee.catalog.files import put_folders
    from marquee.schema import RAW_COLUMNS

    rows = spark.range(4000).selectExpr("id as _ord", "if(id % 2 = 0, 'f0.csv', 'sub/f1.csv') as path", *[
        f"concat('{c}', repeat('x', 20), id) as {c}" for c in RAW_COLUMNS])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        put_folders(rows, str(tmp_path / "in"), "path", "_ord")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list((tmp_path / "in").rglob("part-*.csv"))) >= 4
    name = lambda i: f"name{'x' * 20}{i}"
    whole = [r["name"] for r in L.read_city_files(spark, str(tmp_path / "in")).orderBy("_ord").collect()]
    assert whole == [name(i) for i in [*range(0, 4000, 2), *range(1, 4000, 2)]]
    listed = L.read_city_files(spark, [str(tmp_path / "in/sub/f1.csv"), str(tmp_path / "in/f0.csv")])
    assert [r["name"] for r in listed.orderBy("_ord").collect()] == [name(i) for i in [*range(1, 4000, 2), *range(0, 4000, 2)]]
