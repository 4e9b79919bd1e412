"""Both merge passes against a direct walk over small groups, and hand-made cases."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators import merge
from marquee.plans.clean import clean_listings, type_listings, usable
from marquee.schema import RAW_COLUMNS, city_dimension

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in [*RAW_COLUMNS, "source", "city_folder"]]
                      + [T.StructField("_ord", T.LongType())])


def listing(order, **given):
    row = {c: "" for c in RAW_COLUMNS} | {"name": "Show", "start_time": "2026-08-01T19:00:00", "source": "eventbrite",
                                          "city_folder": "New_York_US", "location_name": "Park House"}
    row |= given
    return tuple(row[c] for c in [*RAW_COLUMNS, "source", "city_folder"]) + (order,)


def run(spark, rows, **kw):
    return clean_listings(spark.createDataFrame(rows, SCHEMA), city_dimension(spark), **kw)


def events(spark, rows, **kw):
    return run(spark, rows, **kw).events.collect()


def test_songkick_name_and_gap_filling(spark):
    got = events(spark, [
        listing(0, name="X @ Park House", source="songkick", address="1 Main", is_paid="true"),
        listing(1, name="X", source="ticketmaster", description="d", thumbnail_image="http://i", latitude="40.7",
                longitude="-74.0", secondary_categories="Rock,rock"),
    ])
    assert len(got) == 1
    e = got[0]
    assert e["name"] == "X" and e["address"] == "1 Main" and e["isPaid"] is True and e["latitude"] == 40.7
    assert e["sources"] == ["Songkick", "Ticketmaster"] and e["category"] == "Rock" and e["tags"] == []
    assert e["startTime"] == "2026-08-01T19:00:00-04:00" and e["displayTime"] == "7:00 PM"


def test_decorated_venue_merges_and_two_parks_do_not(spark):
    near = dict(latitude="40.7000", longitude="-74.0000")
    assert len(events(spark, [listing(0, **near), listing(1, location_name="Park House (in Baisley Pond Park)",
                                                          source="nyc_parks", latitude="40.7010", longitude="-74.001")])) == 1
    assert len(events(spark, [listing(0, **near), listing(1, location_name="Park House North", source="nyc_parks",
                                                          latitude="40.7100", longitude="-74.0")])) == 2
    assert len(events(spark, [listing(0), listing(1, location_name="Park House North", start_time="2026-08-01T20:00:00")])) == 2


def test_order_of_the_walk_decides(spark):
    # Ranked A, C, B by filled columns; A~B and B~C agree, A and C do not: B joins A, C stays.
    fill = dict(description="d", address="a")
    rows = [listing(0, location_name="Hall (Main)", latitude="40.700", longitude="-74.0", external_link="u", **fill),
            listing(1, location_name="Hall (Side)", latitude="40.703", longitude="-74.0"),
            listing(2, location_name="Hall (Rear)", latitude="40.706", longitude="-74.0", **fill)]
    got = events(spark, rows)
    assert sorted(e["venue"] for e in got) == ["Hall (Main)", "Hall (Rear)"]


def test_dates_prices_and_drops(spark):
    r = run(spark, [listing(0, start_time="2026-13-40"), listing(1, name=" "), listing(2, start_time="2026-08-02"),
                    listing(3, start_time="2026-08-03 6pm", is_paid="false")], generated_at="2026-08-01T00:00:00")
    got = r.events.collect()
    assert [(str(e["date"]), e["startTime"], e["displayTime"], e["isPaid"]) for e in got] == [
        ("2026-08-02", None, "All day", None), ("2026-08-03", None, "All day", False)]
    report = {(x["step"], x["metric"]): x["value"] for x in r.report.collect()}
    assert report["load", "rows"] == 4 and report["schema", "dropped"] == 1 and report["time", "dropped"] == 1
    assert report["dedupe", "rows_in"] == report["dedupe", "events_out"] + report["dedupe", "merged_exact"] + report[
        "dedupe", "merged_fuzzy"]
    meta = r.meta.first()
    assert meta["totalEvents"] == 2 and meta["free"] == 1 and meta["priceUnknown"] == 1 and meta["paid"] == 0
    assert meta["dates"] == {"2026-08-02": 1, "2026-08-03": 1}


def walk(rows):
    """Leaders by a direct walk: rows are (rank, id, variants, lat, lon) of one group."""
    kept, out = [], {}
    for _, i, names, lat, lon in sorted(rows):
        home = None
        for k in kept:
            close = None in (k["lat"], lat) or (abs(k["lat"] - lat) <= 0.004 and abs(k["lon"] - lon) <= 0.005)
            if close and any(a in b or b in a for a in k["names"] for b in names):
                home = k
                break
        if home is None:
            kept.append({"id": i, "names": names, "lat": lat, "lon": lon})
            out[i] = i
        else:
            if home["lat"] is None:
                home["lat"], home["lon"] = lat, lon
            out[i] = home["id"]
    return out


def random_rows(seed, n, venues):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        place = rnd.choice(venues)
        point = rnd.random() < 0.6
        rows.append(listing(
            i, location_name=place + rnd.choice(["", " (Main)", f" (Room {rnd.randrange(4)})", " Annex"]),
            source=rnd.choice(["ticketmaster", "ra", "songkick", "other"]), address=rnd.choice(["", "a"]),
            description=rnd.choice(["", "d"]), latitude=f"{40.7 + rnd.randrange(6) * 0.003:.3f}" if point else "",
            longitude="-74.0" if point else "", start_time=rnd.choice(["2026-08-01T19:00:00", "2026-08-01T20:00:00"])))
    return rows


def leaders(spark, rows):
    typed = usable(type_listings(spark.createDataFrame(rows, SCHEMA), city_dimension(spark)))
    first = merge.merge_exact(merge.add_match_key(merge.add_fixed_fill(typed.withColumn("sources", F.array("source")))))
    first = merge.cut_lineage(merge.add_venue_variants(first))
    got = {r["_ord"]: r["leader"] for r in merge.assign_leaders(first).collect()}
    groups = {}
    for r in first.withColumn("r", merge.rank_columns()).filter(F.size("variants") > 0).collect():
        groups.setdefault((r["name_key"], r["start_utc"]), []).append(
            (tuple(r["r"]), r["_ord"], list(r["variants"]), r["lat"], r["lon"]))
    want = {}
    for g in groups.values():
        if len(g) > 1:
            want |= walk(g)
    return got, want


@pytest.mark.parametrize("seed,n", [(1, 90), (3, 300)])
def test_leaders_equal_walk(spark, seed, n):
    got, want = leaders(spark, random_rows(seed, n, ["Park House", "Hall", "The Hall of Park House", "Barn"]))
    assert got == want and any(k != v for k, v in got.items())


def rounds(spark, rows, monkeypatch):
    """Leaders, and the number of rounds that they took."""
    cuts = []
    cut = merge.cut_lineage
    monkeypatch.setattr(merge, "cut_lineage", lambda df: cuts.append(1) or cut(df))
    got, want = leaders(spark, rows)
    return got, want, (len(cuts) - 2) / 2


def test_a_thousand_branches_far_apart(spark, monkeypatch):
    rows = [listing(i, location_name=f"Hall (Branch {i})", latitude=f"{40.5 + (i % 40) * 0.02:.3f}", longitude=f"{-74.5 + (i // 40) * 0.02:.3f}")
            for i in range(1000)]
    got, want, n = rounds(spark, rows, monkeypatch)
    assert got == want and all(k == v for k, v in got.items()) and len(got) == 1000
    assert n == 1


def test_a_thousand_rooms_in_one_place(spark, monkeypatch):
    rows = [listing(i, location_name=f"Hall (Room {i})", latitude="40.7" if i % 3 else "", longitude="-74.0" if i % 3 else "") for i in range(1000)]
    got, want, n = rounds(spark, rows, monkeypatch)
    assert got == want and set(got.values()) == {1}
    assert n <= 3


def test_exact_merge_holds_numbers_only(spark):
    typed = usable(type_listings(spark.createDataFrame(random_rows(4, 20, ["Hall", "Barn"]), SCHEMA), city_dimension(spark)))
    rows = merge.add_match_key(merge.add_fixed_fill(typed.withColumn("sources", F.array("source"))))
    merged = merge.merge_exact(rows)
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_rows_do_not_go_to_a_task_per_city(spark):
    """The city dimension is sent to the rows, not the rows to the few cities."""
    from marquee.operators.joins import attach_city
    from marquee.schema import city_dimension

    rows = spark.range(10).selectExpr("id as _ord", "if(id % 2 = 0, 'New_York_US', 'Mexico_City_MX') as city_folder")
    plan = attach_city(rows, city_dimension(spark))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan and "hashpartitioning" not in plan


def test_same_event_reads_the_typed_rows_once(spark):
    from marquee.catalog import load

    plan = load()[0]["same_event_as_best"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in plan and "SortAggregate" not in plan
