"""Incremental landing of listing files: only files not seen before, first row per listing.

The stream finds new files and remembers them in its checkpoint.  What the listings are that landed before
is in the table itself, one partition per batch of files, so no state grows or forgets: a batch keeps its first
row per listing, anti-joins the keys of all other batches, and writes its own partition anew.  A batch that runs
again after a crash therefore gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marquee.functions.text import blank, strip_wide
from marquee.operators.ranking import first_per_key
from marquee.schema import RAW_SCHEMA
from marquee.sources.listings import CSV_OPTIONS, any_file

BATCH = "landed_batch"


# How much older than the newest file a file may be when it arrives; the source remembers the names of files for so long.
LATEST_FILE = "3650d"


def listing_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000, schema=RAW_SCHEMA) -> DataFrame:
    """New listing files as rows with their landing time, file and listing key."""
    raw = (spark.readStream.schema(schema).options(**CSV_OPTIONS)
           .option("maxFilesPerTrigger", files_per_batch).option("maxFileAge", LATEST_FILE).option("recursiveFileLookup", "true")
           .option("pathGlobFilter", "*.csv").csv(folder))
    low = lambda c: F.lower(strip_wide(blank(F.col(c))))
    key = F.to_json(F.array(low("name"), strip_wide(blank(F.col("start_time"))), low("location_name")))
    return raw.withColumns({
        "landed_ts": F.col("_metadata.file_modification_time"),
        "file": F.col("_metadata.file_path"),
        "listing_key": F.sha2(key, 256),
    })


def land_batch(rows: DataFrame, batch: int, table_path: str) -> None:
    """Write the first row, by file and row, of every listing that no other batch of the table has."""
    spark = rows.sparkSession
    # A multi-line file is one split, so the numbers rise with its rows.
    first = first_per_key(rows.withColumn("__row", F.monotonically_increasing_id()), ["listing_key"], ["file", "__row"]).drop("__row")
    if any_file(spark, f"{table_path}/{BATCH}=*"):
        known = spark.read.schema(f"listing_key string, {BATCH} bigint").parquet(table_path).filter(F.col(BATCH) != batch).select("listing_key")
        first = first.join(known, "listing_key", "left_anti").select(*first.columns)
    first.write.mode("overwrite").parquet(f"{table_path}/{BATCH}={batch}")


def land(spark: SparkSession, folder: str, table_path: str, checkpoint: str, files_per_batch: int = 1000, schema=RAW_SCHEMA) -> StreamingQuery:
    """Land the first-seen listings of all files that arrived since the last run, then stop.

    A listing that comes again in a later file, however late, is not landed again.
    """
    return (listing_stream(spark, folder, files_per_batch, schema).writeStream
            .foreachBatch(lambda rows, batch: land_batch(rows, batch, table_path)).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
