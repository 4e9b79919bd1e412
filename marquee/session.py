"""Session settings and the lineage cut used by iterative operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app_name: str = "marquee", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the operators are written for."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared checkpoint folder; make one only on a local master."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
        # A folder made here is this process's own and goes with it.
        folder = tempfile.mkdtemp(prefix="marquee-ckpt-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession) -> str:
    """This application's own folder for staged tables in the checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/marquee-{spark.sparkContext.applicationId}"


_TABLES: dict[str, list[str]] = {}


def own_table(spark: SparkSession, prefix: str) -> str:
    """A new name for a catalog table that ``release`` drops."""
    name = f"{prefix}_{uuid.uuid4().hex}"
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(name)
    return name


def release(spark: SparkSession) -> None:
    """Remove the application's staged tables; call it when the results that read them are written.

    Tables in folders that the caller named lose their catalog entry, not their files.
    """
    for name in _TABLES.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the reliable checkpoint folder and go on from there.

    Reliable checkpoints survive the loss of executors, so an iterative job
    that loses a node re-reads its last round instead of replaying all rounds.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame) -> DataFrame:
    """Write wide rows once as a table in the checkpoint folder and read that instead.

    Later reads take only the columns they need, and joins see the table's real size.
    """
    spark = df.sparkSession
    folder = f"{run_folder(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
