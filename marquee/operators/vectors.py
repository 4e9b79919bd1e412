"""Unit vectors, cosine distance, medoids and the rescue of noise points."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.ranking import top_per_group

# Rows per vector block: a pair of blocks is one task's dense matrix.
BLOCK_ROWS = 1024


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                       lambda acc, x: acc + x)


def unit(vector: Column) -> Column:
    """Vector of length one; a zero vector stays zero."""
    size = F.sqrt(dot(vector, vector))
    return F.transform(vector, lambda x: F.when(size > 0, x.cast("double") / size).otherwise(F.lit(0.0)))


def cosine_distance(a: Column, b: Column) -> Column:
    """One minus the dot product of unit vectors, kept inside 0..2."""
    return F.least(F.greatest(1.0 - dot(a, b), F.lit(0.0)), F.lit(2.0))


def normalise(df: DataFrame, column: str = "embedding") -> DataFrame:
    """Unit vectors as ``array<double>``; the length is computed once per row."""
    size = F.sqrt(dot(F.col(column), F.col(column)))
    return (df.withColumn("__size", size)
            .withColumn(column, F.transform(column, lambda x: F.when(F.col("__size") > 0,
                                                                     x.cast("double") / F.col("__size"))
                                            .otherwise(F.lit(0.0))))
            .drop("__size"))


def group_sums(df: DataFrame, group: list[str], vector: str = "embedding") -> DataFrame:
    """Vector sum and row count per group, combined on the map side in the JVM."""
    return df.groupBy(*group).agg(
        vector_to_array(Summarizer.sum(array_to_vector(F.col(vector)))).alias("vector_sum"),
        F.count(F.lit(1)).alias("members"))


def member_distances(df: DataFrame, group: list[str], vector: str = "embedding") -> DataFrame:
    """Add each member's mean cosine distance to all members of its group.

    For unit vectors the mean is ``1 - u . S / n`` with the group sum S, so the cost
    is linear and no pair is built.  Self distance counts as zero, also for a zero
    vector.  Adds ``mean_distance`` and ``members``.
    """
    sums = group_sums(df, group, vector)
    empty = (dot(F.col(vector), F.col(vector)) < 0.5).cast("double")
    mean = (F.col("members") - dot(F.col(vector), F.col("vector_sum")) - empty) / F.col("members")
    return (df.join(sums, group).withColumn("mean_distance", F.greatest(mean, F.lit(0.0))).drop("vector_sum"))


def medoids(df: DataFrame, group: list[str], id_col: str = "id", k: int = 3, vector: str = "embedding") -> DataFrame:
    """The k most central members of every group with their rank."""
    scored = member_distances(df, group, vector)
    return top_per_group(scored, group, [F.col("mean_distance"), F.col(id_col)], k, rank_col="rank").select(
        *group, id_col, "mean_distance", "rank")


def member_scores(df: DataFrame, group: list[str], vector: str = "embedding") -> DataFrame:
    """Add ``representativeness`` = 1 - mean distance / largest mean distance of the group."""
    scored = member_distances(df, group, vector)
    widest = scored.groupBy(*group).agg(F.max("mean_distance").alias("widest"))
    score = F.lit(1.0) - F.col("mean_distance") / F.when(F.col("widest") > 0, F.col("widest")).otherwise(1.0)
    return scored.join(widest, group).withColumn("representativeness", score).drop("widest")


def centroids(df: DataFrame, group: list[str], vector: str = "embedding") -> DataFrame:
    """Mean vector per group, scaled to length one unless it is zero."""
    means = group_sums(df, group, vector).select(
        *group, F.transform("vector_sum", lambda x: x / F.col("members")).alias("centroid"))
    return normalise(means, "centroid")


def add_blocks(df: DataFrame, group: str, id_col: str, rows: int) -> DataFrame:
    """Spread every group over blocks of about ``rows`` rows: adds ``block`` and ``blocks``."""
    sizes = df.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("blocks"))
    return df.join(sizes, group).withColumn(
        "block", F.pmod(F.xxhash64(id_col), F.col("blocks").cast("bigint")).cast("int"))


def stack(column: pa.ChunkedArray) -> np.ndarray:
    """Matrix of an Arrow list column whose rows have equal length."""
    flat = column.combine_chunks()
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.chunk(0)
    n = len(flat)
    return np.asarray(flat.flatten(), dtype=np.float64).reshape(n, -1) if n else np.zeros((0, 1))


def distance_matrix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.clip(1.0 - a @ b.T, 0.0, 2.0)


def _nearest_kernel(table: pa.Table) -> pa.Table:
    side = table.column("side").to_numpy()
    noise = table.filter(pa.array(side == 0))
    cents = table.filter(pa.array(side == 1))
    if not len(noise) or not len(cents):
        return pa.table({"id": pa.array([], pa.int64()), "label": pa.array([], pa.int64()),
                         "distance": pa.array([], pa.float64())})
    names = cents.column("id").to_numpy()
    order = np.argsort(names, kind="stable")
    # Rounded so that equal centroids tie, and the tie goes to the lowest label.
    d = np.round(distance_matrix(stack(noise.column("vector")), stack(cents.column("vector"))[order]), 12)
    best = d.argmin(axis=1)
    return pa.table({"id": noise.column("id"), "label": pa.array(names[order][best], pa.int64()),
                     "distance": pa.array(d[np.arange(len(best)), best], pa.float64())})


def rescue_noise(df: DataFrame, group: str = "state", id_col: str = "id", label: str = "semantic_label",
                 vector: str = "embedding", cap: float = 0.30, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Noise rows take the label of the nearest centroid of their group within ``cap``.

    Noise rows and centroids meet as bounded blocks; a task returns one best label
    per noise row and the overall best is a grouped minimum.
    """
    cents = add_blocks(
        centroids(df.filter(F.col(label) >= 0), [group, label], vector).select(
            group, F.col(label).cast("bigint").alias("id"), F.col("centroid").alias("vector")),
        group, "id", block_rows)
    noise = add_blocks(
        df.filter(F.col(label) < 0).select(group, F.col(id_col).alias("id"), F.col(vector).alias("vector")),
        group, "id", block_rows)
    counts_c = cents.groupBy(group).agg(F.max("blocks").alias("other"))
    counts_n = noise.groupBy(group).agg(F.max("blocks").alias("other"))

    def spread(side: DataFrame, other: DataFrame, code: int, own: str, cross: str) -> DataFrame:
        return (side.join(other, group)
                .withColumn(cross, F.explode(F.sequence(F.lit(0), F.col("other") - 1)))
                .select(group, F.col("block").alias(own), cross, F.lit(code).alias("side"), "id", "vector"))

    meet = spread(noise, counts_c, 0, "nb", "cb").unionByName(spread(cents, counts_n, 1, "cb", "nb"))
    found = meet.groupBy(group, "nb", "cb").applyInArrow(
        lambda t: _nearest_kernel(t), "id bigint, label bigint, distance double")
    best = (found.groupBy("id").agg(F.min(F.struct("distance", "label")).alias("b"))
            .filter(F.col("b.distance") <= cap)
            .select(F.col("id").alias(id_col), F.col("b.label").alias("__rescued")))
    return (df.join(best, id_col, "left")
            .withColumn(label, F.coalesce("__rescued", F.col(label).cast("bigint"))).drop("__rescued"))
