"""Alignment and reduction of metric series."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costgauge.functions.text import iso_minutes
from costgauge.functions.timing import floor_to_interval
from costgauge.operators.scale import percentiles
from costgauge.sources.local import local_table


@dataclass(frozen=True)
class MetricSpec:
    """One metric to collect: how to reduce it and at which interval."""

    metric_name: str
    unit: str = ""
    aggregation: str = "Average"
    interval: str = "PT5M"
    percentile: int | None = None


SPEC_SCHEMA = "metric_name string, unit string, aggregation string, interval string, percentile int"


def spec_frame(spark: SparkSession, specs: Sequence[MetricSpec]) -> DataFrame:
    """Specs as a small table."""
    rows = [(s.metric_name, s.unit, s.aggregation, s.interval, s.percentile) for s in specs]
    return local_table(spark, rows, SPEC_SCHEMA)


def distinct_specs(specs: DataFrame) -> DataFrame:
    """One spec per metric, aggregation, interval and percentile."""
    key = ["metric_name", "aggregation", "interval", "percentile"]
    return specs.groupBy(*key).agg(F.min("unit").alias("unit"))


def bucket_start(ts: Column, interval: Column | int | str) -> Column:
    """Start of the interval a timestamp falls in; the interval as ISO text or minutes."""
    return floor_to_interval(ts, iso_minutes(F.lit(interval)) if isinstance(interval, str) else interval)


def align(
    points: DataFrame,
    series: Sequence[str],
    interval: Column | int | str,
    value: str = "value",
    aggregation: str = "Average",
) -> DataFrame:
    """One value of each series per interval, as columns ``bucket`` and ``value``; the mean by default."""
    return points.groupBy(*series, bucket_start(F.col("ts"), interval).alias("bucket")).agg(
        reducer(aggregation, F.col(value), F.col("ts")).alias("value")
    )


def requested_percentile(percentile: int | None, compat: bool = False) -> float:
    """The asked-for percentile; with ``compat`` 50 is kept and all else becomes 99."""
    if compat:
        return 0.5 if percentile == 50 else 0.99
    return (percentile or 99) / 100.0


def reducer(aggregation: str, value: Column, at: Column | None = None, compat: bool = False) -> Column:
    """Aggregate for a declared aggregation name; unknown names average.

    Without ``compat`` the names ``Sum`` and ``Gauge`` do what they say: total,
    and last value by time (where a time is given; equal times give the larger value).
    """
    known = {
        "Average": F.avg(value),
        "Maximum": F.max(value),
        "Minimum": F.min(value),
        "Total": F.sum(value),
        "Count": F.count(value).cast("double"),
    }
    if not compat:
        known["Sum"] = F.sum(value)
        if at is not None:
            known["Gauge"] = F.max_by(value, F.struct(at, value))
    return known.get(aggregation, F.avg(value))


def reduce_series(
    aligned: DataFrame,
    group: Sequence[str],
    aggregation: str,
    percentile: int | None = None,
    compat: bool = False,
) -> DataFrame:
    """Reduce aligned series across a group per bucket."""
    keys = [*group, "bucket"]
    if aggregation == "Percentile":
        return percentiles(aligned, keys, {"value": ("value", requested_percentile(percentile, compat))})
    return aligned.groupBy(*keys).agg(reducer(aggregation, F.col("value"), None, compat).alias("value"))


def reduce_points(
    bucketed: DataFrame,
    group: Sequence[str],
    aggregation: str,
    percentile: int | None = None,
    compat: bool = False,
) -> DataFrame:
    """Reduce raw points (``ts``, ``value``, ``bucket``) per group and bucket in one step."""
    keys = [*group, "bucket"]
    if aggregation == "Percentile":
        return percentiles(bucketed, keys, {"value": ("value", requested_percentile(percentile, compat))})
    return bucketed.groupBy(*keys).agg(reducer(aggregation, F.col("value"), F.col("ts"), compat).alias("value"))


def reduce_by_spec(
    points: DataFrame, specs: Sequence[MetricSpec], keys: Sequence[str], series: Sequence[str] | None = None
) -> DataFrame:
    """Points reduced as each metric's specs say: keys, metric_name, aggregation_type, percentile, bucket, value.

    ``series`` names the columns that tell a resource's series apart. Each series is then first aligned to its mean in each
    interval, and the reduction is taken across the series; without, it is taken over the raw points.

    One pass serves all plain aggregations, one more each percentile asked for.
    The declared specs are a fixed table.
    """
    declared = distinct_specs(spec_frame(points.sparkSession, specs))
    each = points.join(F.broadcast(declared.drop("unit")), "metric_name")
    each = each.withColumn("bucket", floor_to_interval(F.col("ts"), iso_minutes(F.col("interval"))))
    by = [*keys, "metric_name", "interval", "aggregation", "percentile", "bucket"]
    if series is not None:
        each = each.groupBy(*by, *series).agg(F.avg("value").alias("value"), F.max("ts").alias("ts"))
    names = sorted({s.aggregation for s in specs if s.aggregation != "Percentile"})
    parts = []
    if names:
        plain = each.where(F.col("aggregation") != "Percentile").groupBy(*by)
        found = plain.agg(*[reducer(n, F.col("value"), F.col("ts")).alias(f"_{n}") for n in names])
        chosen = F.coalesce(*[F.when(F.col("aggregation") == n, F.col(f"_{n}")) for n in names])
        parts.append(found.select(*by, chosen.alias("value")))
    for p in sorted({s.percentile or 99 for s in specs if s.aggregation == "Percentile"}):
        asked = each.where((F.col("aggregation") == "Percentile") & (F.coalesce("percentile", F.lit(99)) == p))
        parts.append(percentiles(asked, by, {"value": ("value", p / 100.0)}))
    return reduce(lambda a, b: a.unionByName(b), parts).drop("interval").withColumnRenamed(
        "aggregation", "aggregation_type"
    )


def reduce_all(aligned: DataFrame, group: Sequence[str], aggregations: dict[str, str]) -> DataFrame:
    """Several non-percentile reductions in one pass; output name -> aggregation name."""
    columns = [reducer(a, F.col("value")).alias(name) for name, a in aggregations.items()]
    return aligned.groupBy(*group, "bucket").agg(*columns)
