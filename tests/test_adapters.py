"""Landed payloads: how often an event is read, and events of odd shapes."""

import json
import re

import pytest
from pyspark.sql import functions as F

from marquee.catalog import load
from marquee.operators.pages import json_ld_items
from marquee.sources.adapters import ADAPTERS, distinct_events

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def adapted(spark, site, events):
    rows = [(i, json.dumps(e)) for i, e in enumerate(events)]
    d = spark.createDataFrame(rows, "page_no long, t string").select("page_no", F.lit(0).alias("pos"), F.try_parse_json("t").alias("ev"))
    return ADAPTERS[site].adapt(distinct_events(d, ADAPTERS[site]))


@pytest.mark.parametrize("site", ["eventbrite", "eventbrite_json_ld", "songkick"])
def test_an_event_is_read_once_for_its_key_and_once_for_its_columns(spark, site):
    assert len(re.findall(r"variant_get\(ev#", plan(adapted(spark, site, [{}])))) == 2


@pytest.mark.parametrize("name", ["adapt_eventbrite", "adapt_eventbrite_json_ld", "adapt_songkick", "adapt_ra"])
def test_payloads_are_dealt_to_as_many_tasks_as_the_session_shuffles_to(spark, name):
    assert re.search(r"RepartitionByExpression \[event_id#\d+L?\], 4\b", plan(load()[0][name](spark, FOLDER)))


def test_odd_eventbrite_events(spark):
    got = {r["_ord"]["page_no"]: r for r in adapted(spark, "eventbrite", [
        {"url": "u", "name": {"text": "", "html": "H"}, "tags": [3, {"name": "B"}, {"text": {"text": "T"}}], "image": "i.png", "is_free": False},
        {"url": "u", "name": "again"}, {"id": 5, "name": "by id", "image": {"url": 7}, "tags": {"name": "x"}}, {"id": "5", "name": "same id"},
        {}, {}, {"name": 9, "primary_venue": "v", "start_date": " 2026-01-02 ", "start_time": "10:30"},
    ]).collect()}
    assert sorted(got) == [0, 2, 4, 5, 6]
    assert (got[0]["name"], got[0]["primary_category"], got[0]["secondary_categories"], got[0]["thumbnail_image"], got[0]["is_paid"]) == (
        "H", "B", "T", "i.png", "true")
    assert (got[2]["thumbnail_image"], got[2]["primary_category"], got[4]["name"]) == ("7", "", "")
    assert (got[6]["name"], got[6]["location_name"], got[6]["start_time"]) == ("9", "", "2026-01-02T10:30:00")


def test_odd_json_ld_events(spark):
    got = {r["_ord"]["page_no"]: r for r in adapted(spark, "eventbrite_json_ld", [
        {"url": "a", "location": [], "image": [], "offers": {"x": {"price": 1}, "lowPrice": 2}},
        {"url": "b", "location": {"name": 3, "address": "plain"}, "image": {"url": "p"}, "offers": [{"price": 0}], "@type": "Event"},
        {"url": "c", "location": [{"address": {"streetAddress": "S", "addressLocality": "L"}}], "image": ["q", "r"], "endDate": "2026-01-02T03:04:05+00:00"},
    ]).collect()}
    assert [(r["location_name"], r["address"], r["city"], r["thumbnail_image"], r["is_paid"]) for _, r in sorted(got.items())] == [
        ("", "", "", "", ""), ("3", "plain", "", "p", "false"), ("", "S", "l", "q", "")]
    assert got[2]["end_time"] == "2026-01-02T03:04:05Z"


def test_json_ld_blocks_of_every_form(spark):
    block = '<script type="application/ld+json">%s</script>'
    docs = [{"@graph": [{"@type": "Event", "n": 1}, 5]}, {"@type": "ItemList", "itemListElement": [{"item": {"@type": "Event", "n": 2}}, {"@type": "Event", "n": 3}]},
            [{"@type": ["Thing", "Event"], "n": 4}, None, "Event"], {"@graph": None, "@type": "Event", "n": 5}, {"@type": "ItemList"}]
    page = spark.createDataFrame([("".join(block % json.dumps(d) for d in docs),)], "html string")
    found = json_ld_items(page, "html")
    assert len(re.findall(r"variant_get\(item#", plan(found))) == 1
    assert sorted(r[0] for r in found.select(F.try_variant_get("item", "$.n", "int")).collect()) == [1, 2, 3, 4, 5]


def test_odd_songkick_events(spark):
    got = [tuple(r[c] for c in ("location_name", "address", "secondary_categories", "thumbnail_image", "additional_images", "is_paid")) for r in adapted(
        spark, "songkick", [
            {"url": "a", "location": "x", "performer": {"name": "P"}, "image": [1, "i", "j"], "offers": {}},
            {"name": "n", "startDate": "d", "location": [{"name": "L", "address": {"addressLocality": "C"}}], "performer": ["s", {"name": ["q"]}], "offers": {"a": 1}},
            {"name": "n", "startDate": "d"}]).orderBy("_ord").collect()]
    assert got == [("", "", "P", "i", "j", ""), ("L", "C", '["q"]', "", "", "true")]
