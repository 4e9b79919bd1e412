"""Readers.  Every reader of files adds ``_ord``, the file and row order that decides ties."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.text import strip_wide
from marquee.operators.ranking import number_rows
from marquee.schema import RAW_SCHEMA

DAY_FOLDER = r"^\d{4}-\d{2}-\d{2}$"
# Bits kept for the row position inside a file.
ROW_BITS = 33
CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "encoding": "UTF-8"}


def _place(df: DataFrame) -> DataFrame:
    """Add ``__file`` and ``__row``.  A multi-line file is one split, so positions rise inside it."""
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return df.withColumns({"__file": F.col("_metadata.file_path"), "__row": row})


def _ordered(df: DataFrame, order: list[Column]) -> DataFrame:
    """``_ord`` = number of the file in the given order, then the row position."""
    files = number_rows(df.select("__file").distinct(), [*order, F.col("__file")], "__no").select("__file", "__no")
    return (df.join(files, "__file")
            .withColumn("_ord", F.shiftleft(F.col("__no").cast("bigint"), ROW_BITS) + F.col("__row"))
            .drop("__no", "__row", "__file"))


def any_file(spark: SparkSession, pattern: str) -> bool:
    """Whether a path pattern matches anything, in whatever store it names."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    return bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path))


def _part(depth: int) -> Column:
    """Path part counted from the file name (1 = file)."""
    return F.url_decode(F.element_at(F.split("__file", "/"), -depth))


def _position(value: Column, wanted: list[str] | None) -> Column:
    return F.array_position(F.array(*[F.lit(w) for w in wanted]), value) if wanted else value


def read_listings(spark: SparkSession, root: str, cities: list[str] | None = None,
                  dates: list[str] | None = None) -> DataFrame:
    """``root/<city folder>/<date>/<site>.csv`` with source, folder and date columns.

    Only the asked folders are listed; folders that do not exist give no rows.
    """
    wanted = "{%s}" % ",".join(cities) if cities else "*"
    days = "{%s}" % ",".join(dates) if dates else "*"
    if not any_file(spark, f"{root}/{wanted}/{days}/*.csv"):
        return spark.createDataFrame([], RAW_SCHEMA).select("*", *[F.lit("").alias(c) for c in (
            "source", "landed_date", "city_folder")], F.lit(0).cast("bigint").alias("_ord"))
    raw = _place(spark.read.schema(RAW_SCHEMA).options(**CSV_OPTIONS).csv(f"{root}/{wanted}/{days}/*.csv"))
    tagged = raw.withColumns({
        "source": F.regexp_replace(_part(1), r"\.csv$", ""), "landed_date": _part(2), "city_folder": _part(3)})
    return _ordered(tagged, [_position(_part(3), cities), _position(_part(2), dates)])


def read_city_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All CSV files under a folder (by path), or an explicit list in the given order.

    A listed path may be a folder of part files, which come in the order of their names.
    """
    reader = spark.read.schema(RAW_SCHEMA).options(**CSV_OPTIONS)
    if isinstance(paths, str):
        raw = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").csv(paths)
        return _ordered(_place(raw), [])
    raw = _place(reader.csv(paths))
    # A file's place is looked up by its whole path; the list joins as a small frame.
    places = spark.createDataFrame([(_qualified(spark, p), i) for i, p in enumerate(paths)], "__path string, __at int")
    places = places.groupBy("__path").agg(F.min("__at").alias("__at"))
    # Looked up for every file once, not for every row.
    seen = raw.select("__file").distinct().withColumn("__path", F.regexp_replace(F.url_decode("__file"), "^file:/+", "file:/"))
    seen = seen.join(places, "__path", "left").withColumn("__path", F.regexp_replace("__path", "/[^/]*$", ""))
    files = seen.join(places.withColumnRenamed("__at", "__in"), "__path", "left").select("__file", F.coalesce("__at", "__in").alias("__at"))
    numbered = number_rows(files, [F.col("__at"), F.col("__file")], "__no").select("__file", "__no")
    return (raw.join(numbered, "__file")
            .withColumn("_ord", F.shiftleft(F.col("__no").cast("bigint"), ROW_BITS) + F.col("__row"))
            .drop("__no", "__row", "__file"))


def _qualified(spark: SparkSession, path: str) -> str:
    """A path with its store, one slash behind a store without a host."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    whole = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()
    return re.sub("^([a-z]+):/+(?=[^/])", r"\1:/", whole) if whole.startswith("file:") else whole


def discover_dates(spark: SparkSession, root: str, cities: list[str] | None = None) -> DataFrame:
    """Distinct valid date folders, sorted.  File contents are not read."""
    wanted = "{%s}" % ",".join(cities) if cities else "*"
    files = spark.read.format("binaryFile").load(f"{root}/{wanted}/*/*").select(F.col("path").alias("__file"))
    return files.select(_part(2).alias("date")).filter(F.col("date").rlike(DAY_FOLDER)).distinct().orderBy("date")


# Target field and the headers it may come from, best first.
ALIASES = {
    "title": ["name", "title", "event_name", "event"],
    "start_raw": ["start_time", "start_date", "date"],
    "time_raw": ["start_time", "time"],
    "end_raw": ["end_time", "end_date"],
    "end_date_raw": ["end_date"],
    "venue": ["location_name", "venue", "location", "venue_name", "place"],
    "address": ["address", "address_line", "street"],
    "city": ["city", "town", "locality"],
    "description": ["description", "details", "event_description", "notes"],
    "image": ["image", "thumbnail_image", "image_url", "photo", "img_url"],
    "url": ["external_link", "url", "link", "event_url"],
}


def pick_aliases(df: DataFrame, aliases: dict[str, list[str]] | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Each target field = the first filled of its alias columns, empty when there is none."""
    have = set(df.columns)
    picked = []
    for target, names in (aliases or ALIASES).items():
        found = [F.nullif(strip_wide(F.col(n)), F.lit("")) for n in names if n in have]
        picked.append(F.coalesce(*found, F.lit("")).alias(target))
    return df.select(*carry, *picked)


# Cells that a row of an aliased file may have; a longer row is an error.
MOST_CELLS = 256


def _under_headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of files, each file's in order, to the rows but the first of each file, with that first row as ``header``.

    A multi-line file is one split, so its rows come one after the other in one task.
    """
    file, header = None, []
    for batch in batches:
        files, cells = batch.column("file").to_pylist(), batch.column("cells")
        kept, above = [], []
        for i, f in enumerate(files):
            if f != file:
                file, header = f, [None if c is None else c.strip() for c in cells[i].as_py()]
                while header and header[-1] is None:
                    header.pop()
            else:
                kept.append(i)
                above.append(header)
        rows = batch.take(pa.array(kept, pa.int64()))
        yield pa.RecordBatch.from_arrays([rows.column("file"), pa.array(above, pa.list_(pa.string())), rows.column("cells")],
                                         names=["file", "header", "cells"])


def read_aliased(spark: SparkSession, folder: str, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """CSV files whose headers differ: the alias fields of every row, and its ``file``.

    One scan reads all files as rows of cells; each task keeps the first row of the file it is in as the names
    of the cells below.  A field is looked up by name in its own row, so there may be as many headers as files.
    """
    if not any_file(spark, f"{folder}/*.[cC][sS][vV]"):
        raise FileNotFoundError(f"no CSV file in {folder}")
    names = [f"c{i}" for i in range(MOST_CELLS + 1)]
    raw = (spark.read.schema(", ".join(f"{c} string" for c in names)).options(**CSV_OPTIONS | {"header": "false"})
           .option("pathGlobFilter", "*.[cC][sS][vV]").csv(folder))
    long = F.when(F.col(names[-1]).isNotNull(), F.raise_error(F.lit(f"a row has more than {MOST_CELLS} cells")).cast("string"))
    cells = F.array(*names[:-1], long)
    rows = raw.select(F.col("_metadata.file_path").alias("file"), cells.alias("cells")).mapInArrow(
        _under_headers, "file string, header array<string>, cells array<string>")

    def cell(name: str) -> Column:
        at = F.array_position("header", name)
        return F.nullif(strip_wide(F.try_element_at("cells", F.when(at > 0, at.cast("int")))), F.lit(""))

    return rows.select("file", *[F.coalesce(*map(cell, found), F.lit("")).alias(target) for target, found in (aliases or ALIASES).items()])


def read_city_events(spark: SparkSession, path: str) -> DataFrame:
    """Dashboard events with a typed ``date`` and ``event_year``."""
    df = spark.read.options(**CSV_OPTIONS).csv(path) if path.endswith(".csv") else spark.read.parquet(path)
    out = df.withColumn("date", F.col("date").cast("string").try_cast("timestamp_ntz"))
    return out if "event_year" in out.columns else out.withColumn("event_year", F.year("date"))


def read_host_events(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.options(**CSV_OPTIONS).csv(path) if path.endswith(".csv") else spark.read.parquet(path)
    return df.withColumns({"date": F.col("date").cast("string").try_cast("timestamp_ntz"),
                           **{c: F.col(c).try_cast("double") for c in ("latitude", "longitude")}})


def located(df: DataFrame) -> DataFrame:
    """Rows with both coordinates and a state."""
    return df.na.drop(subset=["latitude", "longitude", "state"])


def read_payloads(spark: SparkSession, root: str, site: str) -> DataFrame:
    """Landed pages ``root/<site>/<date>/<page>.json|html``, one row per page in path order."""
    raw = spark.read.option("wholetext", "true").text(f"{root}/{site}/*/*").select(
        F.col("value").alias("payload"), F.col("_metadata.file_path").alias("__file"))
    files = number_rows(raw.select("__file").distinct(), [F.col("__file")], "page_no").select("__file", "page_no")
    return raw.join(files, "__file").select(_part(2).alias("landed_date"), "page_no", "payload")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages ``page_id, url, html``."""
    return spark.read.parquet(path).select("page_id", "url", "html")
