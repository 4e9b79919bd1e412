"""Writers.  Partitioned writers rebalance first, so one busy day is split over tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.schema import CITY_FILE_COLUMNS, DAILY_COLUMNS, RAW_COLUMNS

MAX_FILE_ROWS = 1_000_000


def write_events(events: DataFrame, meta: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Events and their one-row meta block as JSON lines."""
    events.write.mode(mode).json(f"{path}/events", ignoreNullFields=False)
    meta.write.mode(mode).json(f"{path}/meta", ignoreNullFields=False)


def flat_text(df: DataFrame, column: str) -> Column:
    """Lists joined by ``;``, booleans as true/false, null as empty."""
    kind = df.schema[column].dataType.typeName()
    c = F.array_join(column, ";") if kind == "array" else F.col(column).cast("string")
    return F.coalesce(c, F.lit("")).alias(column)


def flat_events(events: DataFrame, cities: DataFrame) -> DataFrame:
    """The daily file's columns as text, with the city folder."""
    folders = cities.select(F.col("canonical_city").alias("city"), "city_folder")
    named = events.join(F.broadcast(folders), "city", "left").withColumn(
        "city_folder", F.coalesce("city_folder", F.replace("city", F.lit(" "), F.lit("_"))))
    return named.select("city_folder", *[flat_text(named, c) for c in DAILY_COLUMNS])


def write_daily(flat: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per city and day; the date stays a column of the files too."""
    (flat.withColumn("day", F.col("date")).hint("rebalance", "city_folder", "day")
     .write.mode(mode).partitionBy("city_folder", "day").option("maxRecordsPerFile", MAX_FILE_ROWS)
     .option("header", "true").option("emptyValue", "").option("escape", '"').csv(path))


def _write_csv(df: DataFrame, path: str, mode: str) -> None:
    df.write.mode(mode).option("header", "true").option("emptyValue", "").option("escape", '"').csv(path)


def write_city(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    _write_csv(df.select(CITY_FILE_COLUMNS), path, mode)


def write_listings(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Adapted listings per day and site; a day without rows leaves no file."""
    (df.select("site", "day", *RAW_COLUMNS).hint("rebalance", "day", "site")
     .write.mode(mode).partitionBy("day", "site").option("maxRecordsPerFile", MAX_FILE_ROWS)
     .option("header", "true").option("emptyValue", "").option("escape", '"')
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))


def write_display(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_result(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A clustered result as CSV; vectors and lists are joined texts."""
    keep = [c for c in df.columns if c != "embedding"]
    _write_csv(df.select(*[flat_text(df, c) for c in keep]), path, mode)


# The tables of grouping runs; a run counts once its row is in the first.
RUN, RUN_TABLES = "cluster_run_id", ("cluster_runs", "event_clusters", "host_rankings")


def append_run(run: DataFrame, labels: DataFrame, rankings: DataFrame, database: str | None = None) -> None:
    """Write one grouping run to the three result tables, each its own partition of them.

    Writing a run again replaces what it wrote before.  Its row in the first table goes before anything else
    is written and comes back last, so ``read_runs`` never sees half a run.
    """
    spark = run.sparkSession
    run_id = run.select(F.col(RUN).cast("string")).head()[0]
    tables = dict(zip(RUN_TABLES, (run, labels, rankings)))
    for name, df in [("cluster_runs", run.limit(0)), *((n, tables[n]) for n in ("event_clusters", "host_rankings", "cluster_runs"))]:
        table = f"{database}.{name}" if database else name
        rest = [c for c in df.columns if c != RUN]
        if not spark.catalog.tableExists(table):
            df.select(*rest, F.col(RUN).cast("string")).limit(0).write.partitionBy(RUN).saveAsTable(table)
        quoted = run_id.replace("\\", "\\\\").replace("'", "\\'")
        columns = ", ".join(f"`{c}`" for c in rest)
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({RUN} = '{quoted}') ({columns}) SELECT {columns} FROM {{rows}}", rows=df)


def read_runs(spark, name: str, database: str | None = None) -> DataFrame:
    """Rows of a result table that belong to whole runs."""
    prefix = f"{database}." if database else ""
    whole = spark.table(f"{prefix}cluster_runs").select(RUN).distinct()
    return spark.table(f"{prefix}{name}").join(whole, RUN, "left_semi")


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    _write_csv(report, path, mode)
