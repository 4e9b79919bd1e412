"""Connected components by min-parent hooking and shortcutting.

Every step is a join on a node id or a grouped minimum, so a hub with a third of
all edges is combined on the map side and never collected.  The number of rounds
grows with the logarithm of the component size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.session import cut_lineage


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components with one link per node, to the component's smallest node."""
    if not len(a):
        return a, b
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = ends[:len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for end in (x, y):
            np.minimum.at(new, end, low)
            np.minimum.at(new, label[end], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = label != np.arange(len(nodes))
    return nodes[far], nodes[label[far]]


def _batch_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace each Arrow batch of edges by stars: at most one edge per node, and shorter paths for the rounds."""
    for batch in batches:
        src, dst = stars(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst)], names=["src", "dst"])


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``nodes(node)``, ``edges(src, dst)`` -> ``(node, component)``; component = smallest node."""
    stars = edges.select(F.col("src").cast("bigint"), F.col("dst").cast("bigint")).mapInArrow(
        _batch_stars, "src bigint, dst bigint")
    both = cut_lineage(stars.select(F.explode(F.array(
        F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))).alias("e"))
        .select("e.*").distinct())
    parent = nodes.select("node", F.col("node").alias("parent"))
    while True:
        up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        state = parent.select("node", "parent").join(up, "parent")
        near = (both.join(state.select(F.col("node").alias("dst"), "grand"), "dst")
                .groupBy("src").agg(F.min("grand").alias("least"))
                .withColumnRenamed("src", "node"))
        best = state.join(near, "node", "left").withColumn("least", F.least("least", "grand"))
        offers = best.select(F.explode(F.array(
            F.struct(F.col("node").alias("node"), F.least("parent", "least").alias("offer"), F.col("parent").alias("was")),
            F.struct(F.col("parent").alias("node"), F.col("least").alias("offer"),
                     F.lit(None).cast("bigint").alias("was")),
        )).alias("o")).select("o.*")
        parent = cut_lineage(offers.groupBy("node").agg(F.min("offer").alias("parent"), F.max("was").alias("was")))
        if not parent.filter("parent <> was").limit(1).count():
            return parent.select("node", F.col("parent").alias("component"))
