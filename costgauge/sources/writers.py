"""Writers: keyed upsert and reload of partitioned tables, exports, catalog files."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from costgauge.operators.ingest import conform
from costgauge.operators.scale import dim_join
from costgauge.operators.upsert import latest_per_key, reload, upsert
from costgauge.schemas import OBSERVATION, RECOMMENDATION_COLUMNS, parsed
from costgauge.session import ensure_checkpoint_dir


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, partition_by: Sequence[str], fmt: str = "parquet", path: str | None = None
) -> None:
    """Create a partitioned table unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    partitions = ", ".join(f"`{c}`" for c in partition_by)
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt} PARTITIONED BY ({partitions}){place}")


def merge_into(source: DataFrame, table: str, key: Sequence[str], order: Sequence[str]) -> None:
    """Upsert into a table whose format supports MERGE."""
    newest = latest_per_key(source, key, order).alias("s")
    condition = F.expr(" AND ".join(f"{table}.`{k}` = s.`{k}`" for k in key))
    newest.mergeInto(table, condition).whenMatched().updateAll().whenNotMatched().insertAll().merge()


def _read_existing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A new folder, not yet made, in the one the cluster shares."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{kind}-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> tuple[DataFrame, int]:
    """A table written once to the shared folder and read from there, and its number of rows, observed by that write."""
    spark = df.sparkSession
    path = shared_folder(spark, "staged")
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get.get("rows", 0)


def upsert_path(
    source: DataFrame,
    path: str,
    key: Sequence[str],
    order: Sequence[str],
    partition_by: Sequence[str],
) -> int:
    """Upsert into partitioned parquet files; returns the number of source rows, 0 means nothing was done.

    Rewritten are the partitions the source goes to and those that hold an older
    row of a source key; the keys are looked for only in partitions of the
    source's tenants (partition columns that are part of the key). A row may move between partitions (a later
    month replaces an earlier one); partitions left empty are removed. The
    merged rows are checkpointed because a job must not overwrite files it
    still reads.
    """
    spark = source.sparkSession
    # Computed once: it is looked at several times below. Its rows are counted as they are written.
    source, rows = staged(source)
    if rows == 0:
        return 0
    parts = list(partition_by)
    existing = _read_existing(spark, path, source.schema)
    touched = source.select(*parts).distinct()
    if existing is None:
        merged = latest_per_key(source, key, order)
        before = []
    else:
        existing = _may_hold(existing, source, [c for c in parts if c in key])
        holding = existing.join(source.select(*key).distinct(), list(key), "left_semi").select(*parts)
        touched = touched.unionByName(holding).distinct().checkpoint()
        old = existing.join(touched, parts, "left_semi")
        merged = upsert(old, source, key, order).checkpoint()
        before = old.select(*parts).distinct().collect()
    (
        merged.select(*source.columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(path)
    )
    if before:
        after = set(merged.select(*parts).distinct().collect())
        _remove_partitions(spark, path, parts, [p for p in before if p not in after])
    return rows


def _may_hold(existing: DataFrame, source: DataFrame, pinned: Sequence[str]) -> DataFrame:
    """Stored rows whose partition may hold a source key: partition columns that are part of the key (tenants) prune the scan.

    The values that occur in the source are collected: they name folders, as do the partitions below.
    """
    if not pinned:
        return existing
    values = [F.collect_set(c).alias(c) for c in pinned]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_no_{c}") for c in pinned]
    found = source.agg(*values, *nulls).first()
    for c in pinned:
        inside = F.col(c).isin(*found[c]) if found[c] else F.lit(False)
        existing = existing.where(F.col(c).isNull() | inside if found[f"_no_{c}"] else inside)
    return existing


def _remove_partitions(spark: SparkSession, path: str, parts: Sequence[str], values: Sequence[Sequence]) -> None:
    """Delete the folders of emptied partitions."""
    jvm = spark.sparkContext._jvm
    for row in values:
        folder = "/".join(f"{c}={v}" for c, v in zip(parts, row))
        target = jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def reload_path(incoming: DataFrame, path: str, key: str = "service_code") -> None:
    """Replace the rows of the incoming services; others stay. Partitioned by the service."""
    incoming.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def export_flat(
    clusters: DataFrame,
    metrics: Mapping[str, Mapping[str, str]],
    points: DataFrame,
    key: str = "resource_id",
) -> DataFrame:
    """One row per cluster, metric and point; a metric without points keeps one row.

    ``metrics`` maps metric names to their constant columns (unit, interval and
    so on). Points are joined to the cluster rows, pairs without points are
    added, so no list of points is ever built.
    """
    pairs = clusters.select(key, F.explode(F.array(*[F.lit(name) for name in metrics])).alias("metric_name"))
    listed = points.where(F.col("metric_name").isin(*metrics))
    empty = pairs.join(listed.select(key, "metric_name").distinct(), [key, "metric_name"], "left_anti")
    rows = listed.unionByName(empty, allowMissingColumns=True)
    joined = dim_join(rows, clusters, [key], "inner")
    fixed = sorted({column for constants in metrics.values() for column in constants})
    for column in fixed:
        value = F.coalesce(
            *[F.when(F.col("metric_name") == name, F.lit(constants.get(column))) for name, constants in metrics.items()]
        )
        joined = joined.withColumn(column, value)
    return joined


def write_records(records: DataFrame, path: str) -> None:
    """Exported records (columns ``table_name`` and ``line``, a JSON object) as text, a folder for each kind of record."""
    records.select("table_name", "line").write.mode("overwrite").partitionBy("table_name").text(path)


def write_pages(pages: DataFrame, path: str) -> None:
    """Billing pages as JSON, one a line."""
    pages.select("skus").write.mode("overwrite").json(path)


def write_observations(rows: DataFrame, path: str) -> None:
    """The flat export as CSV with its fixed header; quotes are doubled inside quoted values."""
    out = conform(rows, parsed(OBSERVATION)).write.mode("overwrite").option("header", True)
    out.option("escape", '"').csv(path)


def write_catalog(nested: DataFrame, path: str) -> None:
    """A nested catalog as JSON, one list of machines per line."""
    nested.write.mode("overwrite").json(path)


def write_report(recommendations: DataFrame, path: str) -> None:
    recommendations.select(*RECOMMENDATION_COLUMNS).write.mode("overwrite").partitionBy("rule_code").parquet(path)


__all__ = [
    "create_table",
    "export_flat",
    "merge_into",
    "reload",
    "reload_path",
    "shared_folder",
    "staged",
    "upsert_path",
    "write_catalog",
    "write_observations",
    "write_pages",
    "write_records",
    "write_report",
]
