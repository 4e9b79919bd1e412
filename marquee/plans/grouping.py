"""Events + embeddings -> topic groups, place groups, their intersection and host rankings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.aggregates import state_summary
from marquee.operators.filters import mark_small_groups
from marquee.operators.hosts import attach_activity, rank_hosts
from marquee.operators.joins import attach_embeddings
from marquee.operators.spatial import place_groups
from marquee.operators.topics import topic_groups
from marquee.operators.vectors import normalise, rescue_noise
from marquee.session import stage
from marquee.sources.listings import located

NOISE = "noise"


@dataclass(frozen=True)
class GroupingParams:
    # Settings of the scheduled job.
    min_cluster_size: int = 5
    eps_m: float = 500.0
    min_samples: int = 5
    rescue_cap: float | None = 0.30
    min_events: int = 10
    top_hosts: int = 20
    keep_small: bool = False


# Fixed value: the dashboard rescues up to this distance.
DASHBOARD = GroupingParams(rescue_cap=0.8, top_hosts=5, keep_small=True)


@dataclass
class GroupingRun:
    run: DataFrame
    labels: DataFrame
    rankings: DataFrame
    summary: DataFrame
    events: DataFrame


def stage_label(state: Column, label: Column, prefix: str) -> Column:
    return F.when(label < 0, NOISE).otherwise(F.concat(state, F.lit(f"-{prefix}"), label.cast("string")))


def fused_label(state: Column, topic: Column, place: Column) -> Column:
    """Intersection of both labels; noise in either is noise."""
    return F.when((topic < 0) | (place < 0), NOISE).otherwise(
        F.concat(state, F.lit("-sem"), topic.cast("string"), F.lit("_spa"), place.cast("string")))


def group_events(events: DataFrame, embeddings: DataFrame, reference, run_id: str = "1",
                 params: GroupingParams = GroupingParams(), host: str = "host_name") -> GroupingRun:
    """All states in one job.  ``events`` needs unique numeric ``id``, ``state``, ``latitude``,
    ``longitude``, ``date``, a host and ``primary_category``; ``embeddings`` has ``id, embedding``.

    Events without a vector are topic noise; they count in their state, its places and its summary, where
    ``without_vector`` is their number."""
    base = attach_activity(located(events).withColumn("event_type", F.col("primary_category")), host, "date", reference)
    marked = stage(mark_small_groups(normalise(attach_embeddings(base, embeddings, keep=True)), "state", params.min_events))
    work = marked.filter(F.col("group_status") == "ok")
    vectors = work.filter(F.col("embedding").isNotNull()).select("id", "state", "embedding")
    topics = topic_groups(vectors, min_cluster_size=params.min_cluster_size)
    if params.rescue_cap is not None:
        topics = rescue_noise(topics, cap=params.rescue_cap)
    places = place_groups(work.select("id", "state", F.col("latitude").alias("lat"), F.col("longitude").alias("lon")),
                          params.eps_m, params.min_samples)
    labels = places.select("id", "spatial_label").join(topics.select("id", "semantic_label"), "id", "left")
    how = "left" if params.keep_small else "inner"
    full = marked.join(labels, "id", how).na.fill(-1, ["semantic_label", "spatial_label"])
    state, topic, place = F.col("state"), F.col("semantic_label"), F.col("spatial_label")
    full = stage(full.withColumns({
        "semantic_cluster_label": stage_label(state, topic, "sem"),
        "spatial_cluster_label": stage_label(state, place, "spa"),
        "fused_cluster": fused_label(state, topic, place)}))
    rankings = rank_hosts(full.filter(F.col("fused_cluster") != NOISE), "fused_cluster", host, reference,
                          params.top_hosts)
    run = full.sparkSession.range(1).select(
        F.lit(run_id).alias("cluster_run_id"),
        F.create_map(F.lit("semantic_min_cluster_size"), F.lit(float(params.min_cluster_size)),
                     F.lit("spatial_eps_meters"), F.lit(float(params.eps_m)),
                     F.lit("spatial_min_samples"), F.lit(float(params.min_samples))).alias("params"))
    clusters = full.select(F.col("id").alias("event_id"), F.lit(run_id).alias("cluster_run_id"), "state",
                           "semantic_cluster_label", "spatial_cluster_label", "fused_cluster")
    seen = marked.select("id", "state", "group_status").join(
        full.select("id", "semantic_cluster_label", "spatial_cluster_label", "fused_cluster"), "id", "left").na.fill(
        NOISE, ["semantic_cluster_label", "spatial_cluster_label", "fused_cluster"])
    bare = marked.groupBy("state").agg(F.count_if(F.col("embedding").isNull()).alias("without_vector"))
    summary = state_summary(seen).join(bare, "state")
    return GroupingRun(run, clusters, rankings.withColumn("cluster_run_id", F.lit(run_id)), summary, full)
