"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.session import run_folder

# The blanks that separate words everywhere in this package: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"
# A key is hot when it owns more than one row in this many; so there are at most this many hot keys.
HOT_KEYS = 1000


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder, named for this use only, in the application's part of the folder that all executors share."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage_rows(df: DataFrame, name: str) -> DataFrame:
    """Write rows once to the shared folder and go on from the files: an executor lost later costs one re-read."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` (long, null stays null) and ``text`` (null becomes empty); all other columns go."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def unused(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have, whatever the letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """Inner join of ``rows`` with the one row per key of ``groups``; ``size`` counts the key's rows.

    Keys that own more than one row in ``HOT_KEYS`` are joined by broadcast: there can be at most
    ``HOT_KEYS`` of them, whatever the size of the data.  All other keys go through a shuffle, where
    none of them can fill a task.  ``rows`` is read twice, so pass a staged frame.
    """
    total = groups.agg(F.sum(size)).head()[0] or 0
    hot = F.col(size) * HOT_KEYS > total
    head = rows.join(F.broadcast(groups.filter(hot)), key)
    rest = rows.join(F.broadcast(groups.filter(hot).select(key)), key, "left_anti").join(groups.filter(~hot), key)
    return head.unionByName(rest)


def join_salted(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """As ``join_groups`` for ``groups`` too wide to broadcast: hot ones are copied to several salts.

    Only the hot keys and their number of salts are broadcast, at most ``HOT_KEYS`` of them.
    """
    total = groups.agg(F.sum(size)).head()[0] or 0
    salts, salt = unused(rows, "salts"), unused(rows, "salt")
    spread = groups.withColumn(salts, F.ceil(F.col(size) * HOT_KEYS / F.lit(max(total, 1))).cast("int"))
    hot = spread.filter(F.col(salts) > 1).select(key, salts)
    dealt = rows.join(F.broadcast(hot), key, "left").withColumn(
        salt, F.pmod(F.xxhash64(*rows.columns), F.coalesce(F.col(salts), F.lit(1))).cast("int")).drop(salts)
    copied = spread.withColumn(salt, F.explode(F.sequence(F.lit(0), F.col(salts) - 1))).drop(salts)
    return dealt.join(copied, [key, salt]).drop(salt)


def expand_copies(rows: DataFrame, copies: str, out: str, piece: int = 10_000) -> DataFrame:
    """Every row once for each of its ``copies``, numbered from 0 in ``out``; ``rows`` is a staged frame.

    Rows with more copies than ``piece`` are first dealt out by ranges of them, so one row with a third
    of all copies is no array and no task of that size.
    """
    def numbers(first, last):
        return F.explode(F.sequence(first, last))

    few = rows.filter(F.col(copies) <= piece).withColumn(out, numbers(F.lit(0).cast("bigint"), F.col(copies) - 1))
    part = unused(rows, "copies_from")
    many = rows.filter(F.col(copies) > piece).withColumn(
        part, numbers(F.lit(0).cast("bigint"), F.floor((F.col(copies) - 1) / piece)))
    # A number of partitions that is given is kept; these rows are few until they are expanded.
    many = many.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), copies, part)
    many = many.withColumn(out, numbers(F.col(part) * piece, F.least((F.col(part) + 1) * piece, F.col(copies)) - 1)).drop(part)
    return few.unionByName(many)


def running_sum(df: DataFrame, group: list[str], bucket: str, order: list, value: str, out: str) -> DataFrame:
    """Sum of ``value`` over the rows before, by ``bucket`` and then ``order``, inside ``group``."""
    sums = df.groupBy(*group, bucket).agg(F.sum(value).alias("__sum"))
    earlier = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    heads = sums.select(*group, bucket, F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__head"))
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (df.join(heads, [*group, bucket])
            .withColumn(out, F.col("__head") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("__head"))


def slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``most`` in total, or one row."""
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)
