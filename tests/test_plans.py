"""Workflows end to end, plan shapes, and a sample of the registered queries against DuckDB."""

import math
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.catalog import load
from marquee.catalog.registry import TABLES
from marquee.operators.dedupe import first_listing
from marquee.operators.hosts import attach_activity, influence, rank_hosts
from marquee.operators.ranking import number_rows
from marquee.plans.dashboard import host_overview, overview, rolling_trends, year_trends
from marquee.plans.grouping import DASHBOARD, group_events
from marquee.sources.sinks import append_run, read_runs
from tests.test_spatial import brute_groups
from tests.test_topics import brute_hdbscan, sample

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_wins_is_limited_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", "t", "v", 1)], "name string, start_time string, location_name string, _ord long")
    text = plan(first_listing(df))
    assert text.count("WindowGroupLimit") == 2


def test_filters_and_columns_reach_the_scan(spark):
    df = spark.read.parquet(f"{FOLDER}/lineitem.parquet").filter("l_quantity > 45").groupBy("l_returnflag").count()
    text = plan(df)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,45.0)]" in text
    assert "l_extendedprice" not in text


def test_number_rows_per_group(spark):
    df = spark.range(0, 1000, 1, 7).select("id", (F.col("id") % 3).alias("g"), F.xxhash64("id").alias("k"))
    got = number_rows(df, [F.col("k")], "n", group="g").collect()
    for g in range(3):
        mine = sorted((r["k"], r["n"]) for r in got if r["g"] == g)
        assert [n for _, n in mine] == list(range(len(mine)))
    # A group spread over every partition still gets one sequence.
    one = number_rows(df.withColumn("g", F.lit(None).cast("int")), [F.col("k")], "n", group="g").collect()
    assert sorted(r["n"] for r in one) == list(range(1000))


def test_activity_of_hosts(spark):
    rows = [("weekly", d) for d in ("2026-01-01", "2026-01-08", "2026-01-15", "2026-02-14")]
    rows += [("future", "2027-01-01"), ("future", "2027-01-02"), ("once", "2025-01-01"), ("never", None), (None, "2026-01-01")]
    df = spark.createDataFrame(rows, "host string, d string").withColumn("date", F.col("d").cast("timestamp_ntz"))
    got = {r["host"]: r for r in attach_activity(df, "host", "date", "2026-03-01").withColumn(
        "score", influence(F.lit(1), F.col("last_event"), F.col("frequency"), "2026-03-01")).collect()}
    assert (got["weekly"]["frequency"], str(got["weekly"]["last_event"])[:10], got["weekly"]["score"]) == (
        "weekly", "2026-02-14", 0.9)
    assert (got["future"]["frequency"], got["future"]["last_event"], got["future"]["score"]) == ("daily", None, 0.0)
    assert (got["once"]["frequency"], got["once"]["score"]) == ("one-off", 0.01)
    assert got["never"]["frequency"] == "one-off" and got[None]["frequency"] is None


def test_equal_influence_scales_to_one(spark):
    x = sample(11, 6, 4, 1)
    df = spark.createDataFrame([("g", f"h{i}", i, [float(t) for t in v], "e") for i, v in enumerate(x)],
                               "grp string, host string, id long, embedding array<double>, event_type string")
    df = df.withColumns({"last_event": F.lit(None).cast("timestamp_ntz"), "frequency": F.lit("daily")})
    got = rank_hosts(df, "grp", "host", "2026-01-01", k=None).collect()
    assert {r["activity_score"] for r in got} == {1.0} and {r["raw_influence_score"] for r in got} == {0.0}
    assert max(r["match_score"] for r in got) > min(r["match_score"] for r in got) == 0.0


def grouping_input(spark):
    x, rnd = sample(12, 150, 8, 4), np.random.default_rng(5)
    spots = rnd.integers(0, 4, 150)
    lat = 40.5 + spots * 0.05 + rnd.random(150) * 0.004
    lon = -74.0 + rnd.random(150) * 0.004
    state = ["NY"] * 141 + ["VT"] * 9
    rows = [(i, state[i], float(lat[i]), float(lon[i]), f"2026-01-{1 + i % 28:02d}", f"h{i % 13}", f"c{i % 3}")
            for i in range(150)] + [(150, None, 1.0, 1.0, "2026-01-01", "h", "c")]
    ev = spark.createDataFrame(rows, "id long, state string, latitude double, longitude double, d string, "
                                     "host_name string, primary_category string").withColumn(
        "date", F.col("d").cast("timestamp_ntz"))
    emb = spark.createDataFrame([(i, [float(t) * 3 for t in v]) for i, v in enumerate(x)],
                                "id long, embedding array<double>")
    return ev, emb, x, list(zip(lat.tolist(), lon.tolist()))


def test_group_events(spark, tmp_path):
    ev, emb, x, pts = grouping_input(spark)
    run = group_events(ev, emb, "2026-01-20", run_id="r1")
    labels = {r["event_id"]: r for r in run.labels.collect()}
    assert set(labels) == set(range(141))  # the small state writes nothing
    want = brute_groups(pts[:141], 500.0, 5)
    assert [labels[i]["spatial_cluster_label"] for i in range(141)] == [
        "noise" if w < 0 else f"NY-spa{w}" for w in want]
    topics = {}
    for i in range(141):
        topics.setdefault(labels[i]["semantic_cluster_label"], set()).add(i)
    base = brute_hdbscan(x[:141], 5, 5)
    assert len(topics.keys() - {"noise"}) == len(base)
    assert all(any(g <= members for members in topics.values()) for g in base)
    for r in labels.values():
        noise = "noise" in (r["semantic_cluster_label"], r["spatial_cluster_label"])
        assert (r["fused_cluster"] == "noise") == noise
    ranks = run.rankings.collect()
    assert ranks and all(0 <= r["priority_score"] <= 1 for r in ranks)
    assert {r["fused_cluster"] for r in ranks} == {r["fused_cluster"] for r in labels.values()} - {"noise"}
    status = {r["state"]: (r["events"], r["status"]) for r in run.summary.collect()}
    assert status == {"NY": (141, "ok"), "VT": (9, "skipped (too few events)")}
    spark.sql(f"create database runs location '{tmp_path}/runs'")
    append_run(run.run, run.labels, run.rankings, "runs")
    append_run(run.run, run.labels, run.rankings, "runs")
    assert spark.table("runs.event_clusters").count() == 141 and spark.table("runs.cluster_runs").count() == 1
    other = [df.withColumn("cluster_run_id", F.lit("it's 2")) for df in (run.run, run.labels.limit(3), run.rankings.limit(0))]
    append_run(*other, "runs")
    assert read_runs(spark, "event_clusters", "runs").count() == 144 and spark.table("runs.cluster_runs").count() == 2
    assert sorted(read_runs(spark, "host_rankings", "runs").drop("cluster_run_id").collect(), key=str) == sorted(
        run.rankings.drop("cluster_run_id").select(*[c for c in read_runs(spark, "host_rankings", "runs").columns if c != "cluster_run_id"]).collect(), key=str)
    # A run that dies half way is not read, and its old rows are not either.
    broken = run.rankings.limit(1).withColumn(run.rankings.columns[0], F.raise_error(F.lit("died")))
    with pytest.raises(Exception, match="died"):
        append_run(run.run, run.labels.limit(5), broken, "runs")
    assert spark.table("runs.event_clusters").filter(F.col("cluster_run_id") == "r1").count() == 5
    assert read_runs(spark, "event_clusters", "runs").select("cluster_run_id").distinct().count() == 1
    append_run(run.run, run.labels, run.rankings, "runs")
    assert read_runs(spark, "event_clusters", "runs").count() == 144


def test_events_without_a_vector_are_kept(spark):
    ev, emb, _, pts = grouping_input(spark)
    bare = {0, 5, 70, 140, 145}
    run = group_events(ev, emb.filter(~F.col("id").isin(*bare)), "2026-01-20")
    labels = {r["event_id"]: r for r in run.labels.collect()}
    assert set(labels) == set(range(141))
    assert [labels[i]["spatial_cluster_label"] for i in range(141)] == [
        "noise" if w < 0 else f"NY-spa{w}" for w in brute_groups(pts[:141], 500.0, 5)]
    assert {labels[i][c] for i in bare - {145} for c in ("semantic_cluster_label", "fused_cluster")} == {"noise"}
    assert {r["semantic_cluster_label"] for r in labels.values()} != {"noise"}
    counts = {r["state"]: (r["events"], r["without_vector"]) for r in run.summary.collect()}
    assert counts == {"NY": (141, 4), "VT": (9, 1)}


def test_grouping_queries_run_over_all_events(spark):
    events = spark.read.parquet(f"{FOLDER}/events.parquet").filter("event_id % 41 <> 0").count()
    summary = QUERIES["grouping_summary"](spark, FOLDER).collect()
    assert sum(r["events"] for r in summary) == events
    assert QUERIES["grouping_labels"](spark, FOLDER).count() == events
    assert any(r["semantic_groups"] for r in summary) and any(r["spatial_groups"] for r in summary)


def test_dashboard_keeps_small_states_as_noise(spark):
    ev, emb, _, _ = grouping_input(spark)
    run = group_events(ev, emb, "2026-01-20", params=DASHBOARD)
    got = run.labels.filter("state = 'VT'").select("fused_cluster").distinct().collect()
    assert [r[0] for r in got] == ["noise"]


def test_dashboard_pages(spark):
    df = spark.createDataFrame(
        [(i, f"c{i % 3}", "Other" if i % 2 else "Music", "a, b" if i % 4 else None, f"2026-0{1 + i % 6}-10", 40.0, -74.0,
          f"h{i % 5}", f"t{i % 2}", None) for i in range(60)],
        "id long, city string, primary_category string, tags string, d string, latitude double, longitude double, "
        "host_name string, inferred_host_type string, inferred_gtm_segment string")
    df = df.withColumn("date", F.col("d").cast("timestamp_ntz")).withColumn("event_year", F.year("date"))
    page = overview(df)
    assert tuple(page["kpis"].first()) == (60, 3, 2)
    assert {r["tag"]: r["percentage"] for r in page["tags"].collect()} == {"a": 75.0, "b": 75.0}
    trend = rolling_trends(df, "2026-06-30", 2)
    assert [r["primary_category"] for r in trend["top"].orderBy("place").collect()][-1] == "Other"
    assert trend["months"].count() == 24
    assert year_trends(df, current_year=2026)["months"].agg(F.sum("n")).first()[0] == 60
    hosts = host_overview(df)
    assert hosts["segments"].count() == 0 and hosts["types"].agg(F.sum("n")).first()[0] == 5


QUERIES, SQL = load()
SAMPLE = [
    "text_clean", "text_match_key", "time_parse_moment", "category_by_keyword", "tags_as_array", "event_identity",
    "dedupe_first_of_day", "merge_exact", "category_months", "publish_counts", "host_cadence", "rank_hosts",
    "vector_mean_distance", "place_groups", "topic_core_distance", "page_events", "adapt_songkick", "display_events",
]
CHOSEN = sorted(SQL) if os.environ.get("MARQUEE_ALL_QUERIES") else SAMPLE


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    return v.isoformat() if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = sorted(repr([cell(r[c]) for c in cols]) for r in df.collect())
    out = con.execute(SQL[name])
    names = [d[0] for d in out.description]
    assert sorted(names) == cols
    want = sorted(repr([cell(r[names.index(c)]) for c in cols]) for r in out.fetchall())
    assert got == want
