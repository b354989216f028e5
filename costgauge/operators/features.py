"""Per-resource features the recommenders read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costgauge.functions.numeric import half_even, let, stable
from costgauge.operators.scale import positions, same_join

# Monitoring names the rules know under a short name.
METRIC_NAMES = {
    "kubernetes.io/node/cpu/allocatable_utilization": "cpu_utilization_avg",
    "kubernetes.io/node/memory/allocatable_utilization": "memory_utilization_avg",
    "kubernetes.io/container/cpu/request_utilization": "container_cpu_avg",
    "kubernetes.io/container/memory/request_utilization": "container_memory_avg",
}


def utilisation(points: DataFrame, keys: Sequence[str], names: Mapping[str, str] = METRIC_NAMES, value: str = "value") -> DataFrame:
    """Average of the positive samples per resource and known metric, in percent to four decimals.

    One row per resource with at least one positive sample of any metric; known
    metrics without samples are null.
    """
    named = (F.col(keys[0]).cast("string") != "") & (F.col("metric_name") != "")
    # NaN sorts above every number here, but it is no positive sample.
    positive = points.where(named & (F.col(value) > 0) & ~F.isnan(value))
    means = positive.groupBy(*keys).agg(
        *[F.avg(F.when(F.col("metric_name") == m, F.col(value))).alias(f"_{n}") for m, n in names.items()]
    )
    return means.select(*keys, *[stable(F.col(f"_{n}") * 100, 4).alias(n) for n in names.values()])


def as_map(df: DataFrame, names: Sequence[str], out: str = "metrics") -> DataFrame:
    """Wide metric columns as one map of the metrics that are present."""
    entries = [F.when(F.col(n).isNotNull(), F.struct(F.lit(n).alias("k"), F.col(n).cast("double").alias("v"))) for n in names]
    return df.withColumn(out, F.map_from_entries(F.array_compact(F.array(*entries))))


def without_metrics(resources: DataFrame, metrics: DataFrame, key: str) -> DataFrame:
    """Resources no metrics are known for."""
    return resources.join(metrics.select(key), key, "left_anti")


def account_positions(
    df: DataFrame, account: Sequence[str], order: Sequence[str], position: str, total: str
) -> DataFrame:
    """Position of each resource in its account and the size of the account, which is its last position."""
    placed = positions(df, account, order, position)
    return same_join(placed, placed.groupBy(*account).agg(F.max(position).alias(total)), account)


def weekly_growth(points: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """Growth in percent of the last week against the one before; null where the earlier week has nothing.

    Points are summed per week before the shuffle; a resource then has one entry
    per week on record.
    """
    weekly = points.groupBy(key, F.date_trunc("week", F.col(ts)).alias("week")).agg(F.sum(value).alias("amount"))
    weeks = F.sort_array(F.collect_list(F.struct("week", "amount")), asc=False)
    latest = weekly.groupBy(key).agg(weeks.alias("_weeks")).select(
        key, F.get("_weeks", F.lit(0)).alias("_last"), F.get("_weeks", F.lit(1)).alias("_before")
    )
    adjacent = F.col("_before.week") == F.col("_last.week") - F.expr("INTERVAL 7 DAYS")
    previous = F.nullif(F.when(adjacent, F.col("_before.amount")), F.lit(0.0))
    growth = F.try_divide((F.col("_last.amount") - previous) * 100, previous)
    grown = let(latest, _growth=growth)
    return let(grown, growth_pct_per_week=stable(F.col("_growth"), 4)).select(
        key, F.col("_last.week").alias("week"), "growth_pct_per_week"
    )


def monthly_volume(points: DataFrame, keys: Sequence[str], ts: str, amounts: Mapping[str, Column]) -> DataFrame:
    """Sums per resource and calendar month."""
    month = F.date_format(ts, "yyyy-MM").alias("year_month")
    return points.groupBy(*keys, month).agg(*[F.sum(c).alias(name) for name, c in amounts.items()])


def ratios(points: DataFrame, keys: Sequence[str], parts: Mapping[str, tuple[Column, Column]], percent: bool = True) -> DataFrame:
    """Ratios of conditional sums per resource; 0.0 where the divisor is zero."""
    sums, columns = [], []
    for name, (part, whole) in parts.items():
        sums += [F.sum(part.cast("double")).alias(f"_{name}_p"), F.sum(whole.cast("double")).alias(f"_{name}_w")]
        scaled = F.col(f"_{name}_p") * (100 if percent else 1)
        columns.append(F.coalesce(F.try_divide(scaled, F.col(f"_{name}_w")), F.lit(0.0)).alias(name))
    found = points.groupBy(*keys).agg(*sums).select(*keys, *columns)
    return found.select(*keys, *[half_even(F.col(n), 4).alias(n) for n in parts])


def staleness(rows: DataFrame, keys: Sequence[str], ts: str, run_ts: Column, is_read: Column) -> DataFrame:
    """Days since the last change, reads in the last 30 days and reads per month on record."""
    months = F.size(F.collect_set(F.date_format(ts, "yyyy-MM")))
    recent = is_read & (F.col(ts) >= run_ts - F.expr("INTERVAL 30 DAYS"))
    return rows.groupBy(*keys).agg(
        F.datediff(run_ts, F.max(ts)).alias("days_since_last_update"),
        F.sum(F.when(recent, 1).otherwise(0)).cast("int").alias("read_ops_30d"),
        (F.sum(F.when(is_read, 1.0).otherwise(0.0)) / months).alias("reads_per_month"),
    )


def counts(
    rows: DataFrame, keys: Sequence[str], active: Column, member: str, names: tuple[str, str, str]
) -> DataFrame:
    """All members, active members and distinct members per resource."""
    total, running, distinct = names
    per_member = rows.groupBy(*keys, member).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(active).alias("_active")
    )
    return per_member.groupBy(*keys).agg(
        F.sum("_n").alias(total), F.sum("_active").alias(running), F.count(member).alias(distinct)
    )
