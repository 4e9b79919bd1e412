"""First-wins, top-k and numbering that hold when one key owns a third of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import cut_lineage


def top_per_group(df: DataFrame, group: list, order: list, k: int = 1, rank_col: str | None = None) -> DataFrame:
    """The first ``k`` rows of every group.

    ``row_number() <= k`` is planned with a WindowGroupLimit before the shuffle, so
    each map task sends at most ``k`` rows of a group however large the group is.
    """
    rank = rank_col or "__rank"
    w = Window.partitionBy(*group).orderBy(*order)
    out = df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)
    return out if rank_col else out.drop(rank)


def first_per_key(df: DataFrame, key: list, order: list) -> DataFrame:
    return top_per_group(df, key, order, 1)


def top_rows(df: DataFrame, order: list, k: int) -> DataFrame:
    """Global top-k: every task keeps k rows, the last step merges them."""
    return df.orderBy(*order).limit(k)


def number_rows(df: DataFrame, order: list, out: str, group: str | list[str] | None = None) -> DataFrame:
    """Row numbers from 0, overall or per group, without one task per group.

    Rows are range-partitioned, counted per (partition, group), and numbered inside
    their partition; the prefix sums run over one row per (partition, group).
    """
    groups = [group] if isinstance(group, str) else list(group or [])
    ranged = cut_lineage(df.repartitionByRange(*[F.col(g) for g in groups], *order)
                         .withColumn("__part", F.spark_partition_id()))
    sizes = ranged.groupBy("__part", *groups).agg(F.count(F.lit(1)).alias("__size"))
    before = Window.partitionBy(*groups).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(c).alias(f"__{c}") for c in ["__part", *groups]],
                           F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__part", *groups).orderBy(*order)
    same = [ranged[c].eqNullSafe(offsets[f"__{c}"]) for c in ["__part", *groups]]
    numbered = ranged.join(offsets, reduce(lambda a, b: a & b, same))
    return numbered.withColumn(out, F.row_number().over(inside) - 1 + F.col("__before")).drop(
        "__part", "__before", *offsets.columns)


