"""One ingestion run of a service: snapshots and metrics from exported records."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costgauge.functions.timing import in_window
from costgauge.operators import ingest, timeseries
from costgauge.params import RunParams
from costgauge.schemas import PARTITION_COLUMNS, parsed
from costgauge.services import ResourceTable, Service
from costgauge.sources.local import local_table
from costgauge.sources.writers import upsert_path

PARENT_ID = "parent_id"
RECORD = "record"


def snapshot(
    records: DataFrame,
    table: ResourceTable,
    service: Service,
    params: RunParams,
    parents: DataFrame | None = None,
) -> DataFrame:
    """Conformed rows of one resource table.

    Child records carry their parent's id in ``parent_id``; without a parent
    they drop.
    """
    keep = [PARENT_ID] if PARENT_ID in records.columns else []
    rows = _mapped(records, table, keep)
    if table.parent_field and parents is not None:
        rows = rows.withColumnRenamed(PARENT_ID, "_parent")
        rows = ingest.inherit_parent(
            rows, parents, {"_parent": table.parent_field}, (*ingest.INHERITED, "dataset_id", "instance_id")
        ).drop("_parent")
    if table.id_fields:
        # Without a mapped project the account is the project.
        if "project_id" in table.id_fields and "project_id" not in rows.columns:
            rows = rows.withColumn("project_id", F.lit(params.account_id))
        rows = ingest.composite_id(rows, table.id_fields)
    rows = ingest.resource_name(rows)
    rows = ingest.stamp(rows, params, service.name)
    if table.keep is not None:
        rows = rows.where(table.keep(rows))
    return ingest.conform(rows, parsed(table.ddl))


def _mapped(records: DataFrame, table: ResourceTable, keep: list[str]) -> DataFrame:
    """Declared columns that have a source; one source may fill several columns.

    Records come as columns of their own or, read without a schema, in one variant column ``record``.
    """
    if isinstance(_kind(records, RECORD), T.VariantType):
        return ingest.read_fields(records, RECORD, [(f.column, f.kind, f.path) for f in table.fields if f.path], keep)
    firsts = {path: columns[0] for path, columns in table.mapping.items()}
    rows = ingest.map_fields(records, firsts, keep)
    copies = {c: F.col(columns[0]) for columns in table.mapping.values() for c in columns[1:]}
    return rows.withColumns(copies) if copies else rows


def _kind(rows: DataFrame, column: str) -> T.DataType | None:
    return rows.schema[column].dataType if column in rows.columns else None


def metric_rows(
    points: DataFrame, resources: DataFrame, service: Service, params: RunParams
) -> DataFrame:
    """Conformed metric rows of the primary resources.

    ``points``: resource_id, metric_name, ts, value, and optionally series, the
    label that tells the series of a resource apart. Each series is aligned to
    its mean per interval, and the series of a resource are reduced as declared.
    """
    spark = points.sparkSession
    run = F.lit(params.run_ts)
    wanted = {s.metric_name for s in service.specs}
    recent = points.where(F.col("metric_name").isin(*wanted) & in_window(F.col("ts"), run, params.window_days))
    reduced = timeseries.reduce_by_spec(recent, service.specs, ["resource_id"], ["series"] if "series" in recent.columns else [])
    value = ingest.point_value(F.col("value"), F.lit(None))
    rows = reduced.select(
        "resource_id",
        "metric_name",
        "aggregation_type",
        "percentile",
        F.col("bucket").alias("ts"),
        value.alias("metric_value"),
    )
    units = local_table(spark, sorted({(s.metric_name, s.unit) for s in service.specs}), "metric_name string, unit string")
    places = resources.select(
        "resource_id",
        "resource_name",
        *[F.col(c) if c in resources.columns else F.lit(None).cast("string").alias(c) for c in ("location", "region")],
    )
    enriched = ingest.enrich_points(rows, places, units, service.name, service.namespace, params.run_ts)
    return ingest.conform(ingest.stamp(enriched, params, service.name), parsed(service.metrics_ddl))


def run_service(
    service: Service,
    records: Mapping[str, DataFrame],
    points: DataFrame | None,
    params: RunParams,
) -> dict[str, DataFrame]:
    """What a run stores, by table name, once per tenant; nothing is written here."""
    tables: dict[str, DataFrame] = {}
    primary: DataFrame | None = None
    for table in service.tables:
        if not table.fetched or table.name not in records:
            continue
        parents = primary if table.parent_field else None
        tables[table.name] = snapshot(records[table.name], table, service, params, parents)
        if primary is None:
            primary = tables[table.name]
    if service.specs and primary is not None and points is not None:
        tables[service.metrics_table] = metric_rows(points, primary, service, params)
    if params.additional_client_id:
        return {name: ingest.fan_out(rows, params.client_ids) for name, rows in tables.items()}
    return tables


def run_export(exported: DataFrame, services: Iterable[Service], params: RunParams) -> dict[str, DataFrame]:
    """Tables of all given services from one folder of exported records (``readers.exported_records``), by table name.

    A table reads only the files of its own kind of record; child records name their parent in ``parent_id``.
    """
    parent = F.try_variant_get(F.col(RECORD), f"$.{PARENT_ID}", "string").alias(PARENT_ID)
    tables: dict[str, DataFrame] = {}
    for service in services:
        records = {t.name: exported.where(F.col("table_name") == t.name).select(RECORD, parent) for t in service.tables}
        tables |= run_service(service, records, None, params)
    return tables


def dry_run(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """Rows a run would store, by table name: every row is computed in full, by one job, and written nowhere."""
    return ingest.observed_counts(tables, lambda rows: rows.write.format("noop").mode("overwrite").save())


def store(service: Service, tables: Mapping[str, DataFrame], warehouse: str) -> dict[str, int]:
    """Upsert the tables of a run under the warehouse folder; returns rows per table."""
    declared = {t.name: (t.key, t.partition_by) for t in service.tables}
    declared[service.metrics_table] = (service.metrics_key, PARTITION_COLUMNS)
    stored = {}
    for name, rows in tables.items():
        key, partition_by = declared[name]
        # The latest run wins; within a run the remaining columns decide, so that a rerun chooses the same row.
        comparable = [f.name for f in rows.schema.fields if not isinstance(f.dataType, T.MapType) and f.name not in key]
        order = ["job_runtime_utc", *[c for c in comparable if c != "job_runtime_utc"]]
        stored[name] = upsert_path(rows, f"{warehouse}/{name}", key, order, partition_by)
    return stored
