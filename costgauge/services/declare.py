"""How a cloud service is declared: its resource tables and the metrics to collect."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column

from costgauge.operators.timeseries import MetricSpec
from costgauge.schemas import METRIC_KEY, METRIC_POINT, PARTITION_COLUMNS, RESOURCE_KEY

METRICS_TABLE = "bronze_gcp_metrics_v2"
STAMPED = (
    ("client_id", "string"),
    ("account_id", "string"),
    ("cloud_name", "string"),
    ("year_month", "string"),
    ("ingestion_timestamp", "string"),
    ("job_runtime_utc", "timestamp"),
)


@dataclass(frozen=True)
class Field:
    """One declared column and the place in the source record it comes from, if any."""

    column: str
    kind: str = "string"
    path: str | None = None


@dataclass(frozen=True)
class ResourceTable:
    """A table of one kind of resource."""

    name: str
    fields: tuple[Field, ...]
    id_fields: tuple[str, ...] = ()
    parent_field: str | None = None
    flatten: bool = True
    with_service: bool = False
    key: tuple[str, ...] = RESOURCE_KEY
    partition_by: tuple[str, ...] = PARTITION_COLUMNS
    keep: Callable[..., Column] | None = None
    fetched: bool = True

    @property
    def mapping(self) -> dict[str, tuple[str, ...]]:
        """Source path to the columns it fills."""
        found: dict[str, tuple[str, ...]] = {}
        for f in self.fields:
            if f.path:
                found[f.path] = (*found.get(f.path, ()), f.column)
        return found

    @property
    def columns(self) -> tuple[tuple[str, str], ...]:
        """The stored columns and their types: id and name first, run columns last."""
        own = [(f.column, f.kind) for f in self.fields]
        names = {c for c, _ in own}
        head = [(c, "string") for c in ("resource_id", "resource_name") if c not in names]
        service = [("service_name", "string")] if self.with_service and "service_name" not in names else []
        return (*head, *own, *service, *STAMPED)

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{c}` {k}" for c, k in self.columns)


@dataclass(frozen=True)
class Service:
    """A service: pure declaration."""

    name: str
    namespace: str
    tables: tuple[ResourceTable, ...]
    specs: tuple[MetricSpec, ...] = ()
    metrics_table: str = METRICS_TABLE
    metrics_ddl: str = METRIC_POINT
    metrics_key: tuple[str, ...] = METRIC_KEY
    resource_id_field: str = "resource_id"
    tags: tuple[str, ...] = field(default=())

    @property
    def primary(self) -> ResourceTable | None:
        """The table whose resources have metrics."""
        return next((t for t in self.tables if t.fetched), None)


def fields(*rows: tuple[str, str, str | None]) -> tuple[Field, ...]:
    """Columns from (column, type, source path or None)."""
    return tuple(Field(*row) for row in rows)
