"""Readers and sinks as rows: derived rows are written to files in the run's folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.catalog.inputs import CITY_EVENTS, CITY_EVENTS_SQL, HOST_EVENTS, HOST_EVENTS_SQL, LISTINGS, LISTINGS_SQL
from marquee.catalog.registry import query
from marquee.catalog.web import PUBLISHED
from marquee.operators.ranking import number_rows
from marquee.plans.clean import clean_listings
from marquee.schema import RAW_COLUMNS, city_dimension
from marquee.session import run_folder
from marquee.sources import listings as L
from marquee.sources import sinks


# Texts are written as they are, with their blanks.
AS_GIVEN = {"header": "true", "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def home(t, name: str) -> str:
    return f"{run_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


def put_files(rows: DataFrame, root: str, path: str, order: str) -> None:
    """Write ``rows`` as CSV files under ``root``, each at the text in column ``path``, its rows in ``order``.

    The paths are few (cities, days and sites); each file is written by one task and named afterwards.
    """
    spark = rows.sparkSession
    (rows.repartition(path).sortWithinPartitions(path, order).drop(order).write.partitionBy(path)
     .options(**AS_GIVEN).csv(f"{root}-parts"))
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    top = jvm.Path(f"{root}-parts")
    files = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder in files.listStatus(top):
        if folder.isDirectory():
            target = jvm.Path(f"{root}/{jvm.Path(folder.getPath().getName()).getName().split('=', 1)[1].replace('%2F', '/')}")
            files.mkdirs(target.getParent())
            for part in files.globStatus(jvm.Path(folder.getPath(), "part-*")):
                files.rename(part.getPath(), target)


CITIES, DAYS = ["New_York_US", "Mexico_City_MX"], ["2024-02-01", "2024-01-31", "2024-02-03"]
LANDED = f"""
select *, case _ord % 5 when 0 then '2024-01-31' when 1 then '2024-02-01' when 2 then '2024-02-02' when 3 then '2024-02-03' else 'notes' end as day
from ({LISTINGS_SQL})"""
FILLED = ["name", "start_time", "location_name", "additional_images"]
READ = ", ".join(f"nullif({c}, '') as {c}" for c in FILLED)


def _landed(t) -> str:
    root = home(t, "listings")
    rows = t.sql(LISTINGS)
    day = F.element_at(F.array(*map(F.lit, ("2024-01-31", "2024-02-01", "2024-02-02", "2024-02-03", "notes"))), (F.col("_ord") % 5 + 1).cast("int"))
    put_files(rows.select(*RAW_COLUMNS, "_ord", F.concat_ws("/", "city_folder", day, F.concat("source", F.lit(".csv"))).alias("path")), root, "path", "_ord")
    return root


@query("read_listing_folders", f"""
select {READ}, source, city_folder, day as landed_date, row_number() over (order by list_position({CITIES}, city_folder),
  list_position({DAYS}, day), city_folder || '/' || day || '/' || source || '.csv', _ord) - 1 as position
from ({LANDED}) where list_contains({CITIES}, city_folder) and list_contains({DAYS}, day)""")
def _(t):
    rows = number_rows(L.read_listings(t.spark, _landed(t), CITIES, DAYS), [F.col("_ord")], "position")
    return rows.select(*FILLED, "source", "city_folder", "landed_date", "position")


@query("read_date_folders", f"select distinct day as date from ({LANDED}) where day <> 'notes'")
def _(t):
    return L.discover_dates(t.spark, _landed(t))


def put_folders(rows: DataFrame, root: str, path: str, order: str) -> None:
    """Write ``rows`` as CSV under ``root``, a folder of part files at each text in column ``path``.

    The parts follow ``order`` and are no larger than the shuffle's partitions, however many rows a path has.
    """
    spark = rows.sparkSession
    (rows.repartitionByRange(path, order).sortWithinPartitions(path, order).drop(order).write.partitionBy(path)
     .options(**AS_GIVEN).csv(f"{root}-parts"))
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    top = jvm.Path(f"{root}-parts")
    files = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder in files.listStatus(top):
        if folder.isDirectory():
            target = jvm.Path(f"{root}/{folder.getPath().getName().split('=', 1)[1].replace('%2F', '/')}")
            files.mkdirs(target.getParent())
            files.rename(folder.getPath(), target)


def _city_files(t) -> str:
    root = home(t, "cities")
    rows = t.sql(LISTINGS)
    name = F.concat(F.lit("f"), (F.col("_ord") % 4).cast("string"), F.lit(".csv"))
    put_folders(rows.select(*RAW_COLUMNS, "_ord", F.when(F.col("_ord") % 2 == 0, name).otherwise(F.concat(F.lit("sub/"), name)).alias("path")), root, "path", "_ord")
    return root


@query("read_city_folder", f"""
select {READ}, row_number() over (order by case when _ord % 2 = 0 then '' else 'sub/' end || 'f' || _ord % 4, _ord) - 1 as position
from ({LISTINGS_SQL})""")
def _(t):
    return number_rows(L.read_city_files(t.spark, _city_files(t)), [F.col("_ord")], "position").select(*FILLED, "position")


@query("read_city_list", f"""
select {READ}, row_number() over (order by case _ord % 4 when 3 then 0 when 0 then 1 else 2 end, _ord) - 1 as position
from ({LISTINGS_SQL}) where _ord % 4 <> 2""")
def _(t):
    root = _city_files(t)
    rows = L.read_city_files(t.spark, [f"{root}/{f}" for f in ("sub/f3.csv", "f0.csv", "sub/f1.csv")])
    return number_rows(rows, [F.col("_ord")], "position").select(*FILLED, "position")


@query("read_city_events", f"""
select id::varchar as id, strftime(date, '%Y-%m-%d') as day, year(date)::int as event_year, nullif(tags, '') as tags from ({CITY_EVENTS_SQL})""")
def _(t):
    path = home(t, "city-events") + ".csv"
    t.sql(CITY_EVENTS).drop("event_year").write.option("header", "true").csv(path)
    return L.read_city_events(t.spark, path).select("id", F.date_format("date", "yyyy-MM-dd").alias("day"), "event_year", "tags")


@query("read_host_events", f"""
select id, strftime(date, '%Y-%m-%d %H:%M:%S') as date, case when id % 3 = 0 then null else id / 8.0 end as latitude, host_name
from ({HOST_EVENTS_SQL})""")
def _(t):
    path = home(t, "host-events")
    text = F.when(F.col("id") % 3 == 0, "unknown").otherwise((F.col("id") / 8.0).cast("string"))
    t.sql(HOST_EVENTS).withColumns({"latitude": text, "longitude": F.lit("1")}).write.parquet(path)
    return L.read_host_events(t.spark, path).select("id", F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"), "latitude", "host_name")


@query("located_events", """
select event_id, user_id from events where event_id % 3 <> 0 and event_id % 5 <> 0 and event_id % 7 <> 0""")
def _(t):
    given = t.events.select("event_id", "user_id", *[F.when(F.col("event_id") % n != 0, F.lit(v)).alias(c) for c, n, v in (
        ("latitude", 3, 40.0), ("longitude", 5, -74.0), ("state", 7, "NY"))])
    return L.located(given).select("event_id", "user_id")


@query("stored_pages", "select page_id, url, html from pages")
def _(t):
    return L.read_pages(t.spark, f"{t.folder}/pages.parquet")


@query("written_events", PUBLISHED + """
select id, name, venue, "startTime", "isPaid", latitude, sources, (select count(*) from p) as "totalEvents" from p""")
def _(t):
    run = clean_listings(t.sql(LISTINGS), city_dimension(t.spark))
    path = home(t, "events")
    sinks.write_events(run.events, run.meta, path)
    events = t.spark.read.schema(run.events.schema).json(f"{path}/events")
    total = t.spark.read.schema(run.meta.schema).json(f"{path}/meta").head()["totalEvents"]
    return events.select("id", "name", "venue", "startTime", "isPaid", "latitude", F.array_join("sources", "|").alias("sources"),
                         F.lit(total).cast("bigint").alias("totalEvents"))


@query("site_day_files", f"""
select nullif(name, '') as name, nullif(start_time, '') as start_time, source as site, case when _ord % 2 = 0 then '2024-03-01' else '2024-03-02' end as day
from ({LISTINGS_SQL})""")
def _(t):
    path = home(t, "site-days")
    day = F.when(F.col("_ord") % 2 == 0, "2024-03-01").otherwise("2024-03-02")
    sinks.write_listings(t.sql(LISTINGS).select(*RAW_COLUMNS, F.col("source").alias("site"), day.alias("day")), path)
    back = t.spark.read.schema(f"{', '.join(f'{c} string' for c in RAW_COLUMNS)}, day string, site string").options(**L.CSV_OPTIONS).csv(path)
    return back.select("name", "start_time", "site", "day")


@query("clustered_csv", """
select event_id::varchar as id, event_type || ';' || user_id as tags, case when event_id % 2 = 0 then 'true' else 'false' end as flag from events""")
def _(t):
    path = home(t, "clustered")
    sinks.write_result(t.events.select(F.col("event_id").alias("id"), F.array("event_type", F.col("user_id").cast("string")).alias("tags"),
                                       (F.col("event_id") % 2 == 0).alias("flag"), F.array(F.lit(1.0)).alias("embedding")), path)
    return t.spark.read.options(**L.CSV_OPTIONS).csv(path)


@query("run_tables", """
select event_id, 'r' || event_id % 3 as cluster_run_id, 'S' || user_id % 6 as state from events where event_id % 3 <> 2""")
def _(t):
    database = f"marquee_runs_{uuid.uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{home(t, 'runs')}'")
    rows = t.events.select("event_id", F.concat(F.lit("r"), (F.col("event_id") % 3).cast("string")).alias("cluster_run_id"),
                           F.concat(F.lit("S"), (F.col("user_id") % 6).cast("string")).alias("state"))
    for run_id in ("r0", "r1", "r0"):
        run = t.spark.range(1).select(F.lit(run_id).alias("cluster_run_id"), F.lit(5.0).alias("eps"))
        labels = rows.filter(F.col("cluster_run_id") == run_id)
        sinks.append_run(run, labels, labels.groupBy("cluster_run_id", "state").count(), database)
    # Labels of a run whose row was never written are not read.
    rows.filter("cluster_run_id = 'r2'").select("event_id", "state", "cluster_run_id").write.insertInto(f"{database}.event_clusters")
    return sinks.read_runs(t.spark, "event_clusters", database).select("event_id", "cluster_run_id", "state")
