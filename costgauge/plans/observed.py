"""Recommendations straight from the flat export: one row per cluster, node pool and metric point."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costgauge.functions.numeric import number
from costgauge.functions.timing import zone_to_region
from costgauge.operators import features, ingest, rules
from costgauge.plans import pipeline

ATTRIBUTES = (
    "resource_id", "project_id", "location", "status", "current_node_count", "machine_type", "node_pool_name",
    "autopilot_enabled", "release_channel",
)


@dataclass(frozen=True)
class Assessment:
    """What the export leads to."""

    report: DataFrame
    healthy: DataFrame
    without_metrics: DataFrame
    unhandled: DataFrame


def in_file_order(observations: DataFrame) -> DataFrame:
    """Add ``_file`` and ``_row``, which give the order of the rows however files are packed into tasks.

    Files are ordered by their path. A file of the export is read from its start to its end by one task, so that row numbers
    grow along it. Tables that do not come straight from files must bring both columns.
    """
    if {"_file", "_row"} <= set(observations.columns):
        return observations
    return observations.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_row"))


def clusters(observations: DataFrame) -> DataFrame:
    """Attributes of each cluster's first row in the order of the files; a node count that is no number counts as one."""
    first = ingest.first_rows(in_file_order(observations), "cluster_name", ["_file", "_row"], ATTRIBUTES)
    return first.withColumns(
        {
            "current_node_count": F.coalesce(F.col("current_node_count").try_cast("double"), F.lit(1.0)),
            "machine_type": F.coalesce("machine_type", F.lit("")),
            "region": zone_to_region(F.col("location")),
        }
    )


def assess(
    observations: DataFrame,
    rule_table: DataFrame,
    prices: pipeline.Prices,
    service: str = "GKE",
    codes: tuple[str, ...] = ("GKE_IDLE", "GKE_OVERPROVISIONED"),
) -> Assessment:
    """Aggregate, evaluate the service's rules and recommend, per cluster."""
    points = observations.select("cluster_name", "metric_name", number(F.col("metric_value")).alias("value"))
    known = features.utilisation(points, ["cluster_name"])
    names = list(features.METRIC_NAMES.values())
    described = clusters(observations)
    measured = features.as_map(described.join(known, "cluster_name"), names)
    measured = measured.withColumn("resource_id", F.col("cluster_name"))
    fired = rules.evaluate(measured, rule_table, service)
    return Assessment(
        pipeline.recommend_fired(fired, list(codes), prices),
        rules.healthy(measured, fired).select("cluster_name"),
        features.without_metrics(described, measured.where(F.size("metrics") > 0), "cluster_name").select("cluster_name"),
        rules.unhandled(fired, list(pipeline.RECOMMENDERS)).select("cluster_name", "rule_code"),
    )
