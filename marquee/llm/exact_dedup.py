"""Exact dedup against a persistent digest index (DataFrame operations only).

The index is a Parquet table bucketed and sorted by digest in a folder of its own, with one partition for each
batch.  A batch of documents is reduced to one candidate per digest (combined on the map side, so a text with a
third of all rows sends one row per task), sort-merge anti-joined with the other batches' digests, which are read
in their buckets without a shuffle, and what is new is written as the batch's partition.

A batch that comes again, as after a job that died, does not meet its own digests: its partition is
left out when it is compared and written anew.  Spark makes a partition visible when its write is committed,
so a write that died leaves nothing.  A batch is known by its rows' digests and ids unless it is given a name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import expand_copies, id_and_text, join_groups, shared_folder, stage_rows, unused
from marquee.operators.ranking import top_per_group
from marquee.session import own_table


def text_digest(text: Column) -> Column:
    """SHA-256 (lowercase hex) of the text in UTF-8 without any character of ``[\\x20\\x09-\\x0D]``; null is empty."""
    return F.sha2(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", "").cast("binary"), 256)


class DigestIndex:
    """The digests of all documents kept so far: ``digest, keep_id, n_chars, batch``.

    Opening a folder that already holds an index goes on with it, in any session; the number of
    buckets is fixed when it is made (default: the session's shuffle partitions) and kept beside it.
    An index without a folder lies among the application's staged tables and goes with them.

    A repeated row is a copy of itself: one of the rows stays.  A null text is the empty text, a null
    id comes after all other ids, and an empty table gives no rows and leaves the index as it is.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.folder = folder or shared_folder(spark, "digest-index")
        self.table = own_table(spark, "digest_index")
        self.buckets = self._settled(buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
        spark.sql(
            f"CREATE TABLE {self.table} (digest STRING, keep_id BIGINT, n_chars BIGINT, batch STRING) USING parquet "
            f"PARTITIONED BY (batch) CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/rows'")
        spark.catalog.recoverPartitions(self.table)

    def _settled(self, buckets: int) -> int:
        """The bucket number written beside the index, writing it if the index is new."""
        path = f"{self.folder}/buckets"
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        files = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
            self.spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.mode("overwrite").parquet(path)
        files.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{self.folder}/rows"))
        return self.spark.read.parquet(path).head()["buckets"]

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def _before(self, batch: str) -> DataFrame:
        """The digests of all other batches."""
        return self.rows().filter(F.col("batch") != batch).drop("batch")

    def append(self, fresh: DataFrame, batch: str) -> None:
        """Write a batch's new digests, one file per bucket, each sorted by digest; what the batch had before goes."""
        view = f"fresh_{self.table}"
        (fresh.select("digest", "keep_id", "n_chars").repartition(self.buckets, "digest").sortWithinPartitions("digest")
         .createOrReplaceTempView(view))
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.table} PARTITION (batch = '{batch}') SELECT digest, keep_id, n_chars FROM {view}")
        self.spark.catalog.dropTempView(view)
        self.spark.catalog.refreshTable(self.table)

    def classify(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None) -> DataFrame:
        """Add a batch; one row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

        ``group_size`` counts the batch's rows of that text.  The longest original text stays, then
        the smallest id; if another batch knew the text, no row of the batch does.
        """
        rows = stage_rows(
            id_and_text(docs, id_col, text_col).select(
                "doc_id", F.length("text").cast("bigint").alias("n_chars"), text_digest(F.col("text")).alias("digest"))
            .groupBy("digest", "doc_id", "n_chars").agg(F.count(F.lit(1)).alias("copies")), "digests")
        groups = rows.groupBy("digest").agg(
            F.sum("copies").alias("group_size"),
            F.min(F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), F.col("doc_id"))).alias("best")).select(
            "digest", "group_size", F.col("best.doc_id").alias("keep_id"), (-F.col("best.col1")).alias("n_chars"))
        batch = batch or _name(rows, "digest", "doc_id", "n_chars", "copies")
        known = self._before(batch).select("digest", F.col("keep_id").alias("known_id"), F.lit(True).alias("known"))
        # One merge join reads the index for both: the digests that it lacks, and the ids it has for the others.
        settled = stage_rows(groups.hint("merge").join(known, "digest", "left"), "settled-digests")
        fresh = settled.filter("known is null")
        self.append(fresh, batch)
        settled = settled.select("digest", "group_size", F.when(F.col("known"), F.col("known_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                                 F.when(F.col("known").isNull(), F.col("n_chars")).alias("keep_chars"))
        here = (F.coalesce(F.col("n_chars") == F.col("keep_chars"), F.lit(False)) & F.col("doc_id").eqNullSafe(F.col("keep_id")))
        return (join_groups(expand_copies(rows, "copies", "copy"), settled, "digest", "group_size")
                .select("doc_id", "keep_id", "group_size", (here & (F.col("copy") == 0)).alias("kept"),
                        F.col("digest").alias("text_sha256")))

    def new_rows(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None) -> DataFrame:
        """Add a batch and return its documents that stay, with all their columns."""
        digest, size = unused(docs, "digest"), unused(docs, "n_chars_here")
        wide = docs.withColumn(digest, text_digest(F.col(text_col))).withColumn(
            size, F.length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).cast("bigint"))
        best = top_per_group(wide, [digest], [F.desc(size), F.asc_nulls_last(id_col)], rank_col=unused(wide, "rank"))
        batch = batch or _name(docs, id_col, text_col)
        known = self._before(batch).select(F.col("digest").alias(digest))
        kept = stage_rows(best.select(*docs.columns, digest, size).hint("merge").join(known, digest, "left_anti"), "exact-kept")
        self.append(kept.select(F.col(digest).alias("digest"), F.col(id_col).cast("bigint").alias("keep_id"),
                                F.col(size).alias("n_chars")), batch)
        return kept.select(*docs.columns)


def _name(rows: DataFrame, *columns: str) -> str:
    """A name for a batch that equal batches share, whatever the order of their rows."""
    marks = [F.xxhash64(*columns), F.xxhash64(*columns, F.lit(1))]
    n, a, b = rows.agg(F.count(F.lit(1)), *[F.bit_xor(m) for m in marks]).head()
    return f"{n:x}-{(a or 0) & (1 << 64) - 1:016x}-{(b or 0) & (1 << 64) - 1:016x}"
