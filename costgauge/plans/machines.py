"""Rightsizing of machine-based workloads: cluster nodes and data pipeline workers.

Fixed values: the sentences of the recommendations and the names of their details.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costgauge.functions.numeric import count_or_one, half_even, required_capacity, truthy
from costgauge.functions.text import machine_family
from costgauge.operators.matching import (
    Catalog,
    best_fit,
    closest_cheaper,
    fallback_targets,
    lookup,
    with_mean_costs,
)
from costgauge.operators.scale import dim_join
from costgauge.plans.contract import no_targets, optional, recommendation, text_of

RIGHTSIZE_TEXT = "Rightsize from {current_sku} to {target_sku}"
DEFAULT_WORKER = "n1-standard-4"


@dataclass(frozen=True)
class MachineService:
    """What differs between the services that run on machine types."""

    idle_code: str
    overprovisioned_code: str
    idle_text: str
    count_column: str
    count_label: str
    cpu_columns: tuple[str, ...]
    memory_columns: tuple[str, ...]
    # What the details of an idle machine say besides its entry, count and savings.
    idle_details: tuple[str, ...]
    default_machine: str | None = None
    pool: str | None = None


GKE = MachineService(
    idle_code="GKE_IDLE",
    overprovisioned_code="GKE_OVERPROVISIONED",
    idle_text="Idle GKE node pool — consider deleting or scaling to 0",
    count_column="current_node_count",
    count_label="node_count",
    cpu_columns=("cpu_utilization_avg", "cpu_percent"),
    memory_columns=("memory_utilization_avg", "memory_percent"),
    idle_details=("family", "avg_hourly_cost", "avg_monthly_cost", "avg_annual_cost"),
)
DATAFLOW = MachineService(
    idle_code="DATAFLOW_IDLE",
    overprovisioned_code="DATAFLOW_OVERPROVISIONED",
    idle_text="Idle Dataflow job — workers running with no data flowing, consider stopping (current: {current_sku})",
    count_column="current_num_vcpus",
    count_label="worker_count",
    cpu_columns=("cpu_utilization_p95", "cpu_utilization_avg"),
    memory_columns=("memory_utilization_avg",),
    idle_details=("job_name",),
    default_machine=DEFAULT_WORKER,
    pool="batch",
)


def _with_entry(workloads: DataFrame, catalog: Catalog, service: MachineService) -> DataFrame:
    if service.default_machine:
        named = F.coalesce(F.nullif("machine_type", F.lit("")), F.lit(service.default_machine))
        workloads = workloads.withColumn("machine_type", named)
    found = lookup(workloads, catalog)
    count = count_or_one(optional(found, service.count_column, 1.0))
    return found.withColumn("_count", count)


def _entry(prefix: str = "cur_") -> Column:
    """The workload's own entry as a struct."""
    return F.struct(
        F.col("machine_type"),
        *[F.col(prefix + c).alias(c) for c in ("family", "vcpus", "ram_gb", "hourly_cost", "monthly_cost", "annual_cost", "ordinal")],
    )


def idle(workloads: DataFrame, catalog: Catalog, service: MachineService) -> DataFrame:
    """Idle machines cost all they cost; nothing replaces them."""
    found = _with_entry(workloads, catalog, service)
    priced = found.withColumns(
        {
            "_annual": half_even(F.col("cur_annual_cost") * F.col("_count"), 2),
            "_monthly": half_even(F.col("cur_monthly_cost") * F.col("_count"), 2),
        }
    )
    text = text_of(priced, service.idle_text, {"current_sku": F.col("machine_type"), "target_sku": F.lit("N/A")})
    details = {
        "family": F.col("cur_family"),
        "job_name": optional(priced, "job_name", "unknown", "string"),
        "avg_hourly_cost": F.lit(0.0),
        "avg_monthly_cost": F.lit(0.0),
        "avg_annual_cost": F.lit(0.0),
    }
    common = {
        "current_sku": _entry(),
        service.count_label: F.col("_count"),
        "target_skus": no_targets(),
        "monthly_savings": F.col("_monthly"),
        "annual_savings": F.col("_annual"),
    }
    said = {name: details[name] for name in service.idle_details} | common
    return recommendation(priced, service.idle_code, text, F.col("_annual"), F.lit(0.0), F.col("_annual"), said)


def requirements(found: DataFrame, service: MachineService) -> DataFrame:
    """Required capacity of looked-up workloads, which need vCPUs on record."""

    def measured(names: tuple[str, ...]) -> Column:
        return truthy(*[optional(found, n) for n in names])

    usable = found.withColumns({"_cpu": measured(service.cpu_columns), "_memory": measured(service.memory_columns)})
    return usable.where(F.col("cur_vcpus") != 0).withColumns(
        {
            "required_vcpus": required_capacity(F.col("cur_vcpus"), F.col("_cpu")),
            "required_ram": required_capacity(F.col("cur_ram_gb"), F.col("_memory")),
        }
    )


def with_targets(workloads: DataFrame, catalog: Catalog, service: MachineService) -> DataFrame:
    """Workloads with their target machines.

    ``targets`` holds the one best fit, else up to three closest cheaper
    machines (``is_fallback``), else nothing.
    """
    needed = requirements(_with_entry(workloads, catalog, service), service)
    own_family = F.coalesce(F.nullif("cur_family", F.lit("")), machine_family(F.col("machine_type")))
    needed = needed.withColumns(
        {
            "_family": own_family,
            catalog.group: F.lit(service.pool) if service.pool else own_family,
        }
    )
    matched = best_fit(needed, catalog, service.pool)
    cheaper = closest_cheaper(catalog).withColumnRenamed("ordinal", "cur_ordinal")
    keys = [catalog.group, "cur_ordinal"]
    offered = dim_join(matched, cheaper, keys, "left")
    fallback = F.transform(
        fallback_targets(F.col("cheaper"), F.col("machine_type")),
        lambda e: F.struct(*[e[c].alias(c) for c in TARGET_FIELDS]),
    )
    direct = F.array(F.struct(*[F.col(f"target.{c}").alias(c) for c in TARGET_FIELDS]))
    return offered.withColumns(
        {
            "targets": F.when(F.col("target").isNotNull(), direct).otherwise(F.coalesce(fallback, F.array())),
            "is_fallback": F.col("target").isNull(),
        }
    ).drop("target", "cheaper")


TARGET_FIELDS = ("vcpus", "ram_gb", "ordinal", "machine_type", "hourly_cost", "monthly_cost", "annual_cost")


def overprovisioned(workloads: DataFrame, catalog: Catalog, service: MachineService) -> DataFrame:
    """Move to the best fit, or towards the closest cheaper machines; no row where nothing is cheaper."""
    matched = with_targets(workloads, catalog, service).where(F.size("targets") > 0)
    priced = (
        with_mean_costs(matched)
        .withColumns(
            {
                "_current": half_even(F.col("cur_annual_cost") * F.col("_count"), 2),
                "_target": half_even(F.col("avg_annual_cost") * F.col("_count"), 2),
                "_monthly_raw": (F.col("cur_monthly_cost") - F.col("avg_monthly_cost")) * F.col("_count"),
                "_names": F.array_join("targets.machine_type", ", "),
            }
        )
        .withColumns(
            {
                "_savings": half_even(F.col("_current") - F.col("_target"), 2),
                "_monthly": half_even(F.col("_monthly_raw"), 2),
            }
        )
    )
    text = text_of(priced, RIGHTSIZE_TEXT, {"current_sku": F.col("machine_type"), "target_sku": F.col("_names")})
    return recommendation(
        priced,
        service.overprovisioned_code,
        text,
        F.col("_current"),
        F.col("_target"),
        F.col("_savings"),
        {
            "family": F.col("_family"),
            service.count_label: F.col("_count"),
            "current_sku": _entry(),
            "target_skus": F.col("targets"),
            "avg_hourly_cost": F.col("avg_hourly_cost"),
            "avg_monthly_cost": F.col("avg_monthly_cost"),
            "avg_annual_cost": F.col("avg_annual_cost"),
            "monthly_savings": F.col("_monthly"),
            "annual_savings": F.col("_savings"),
        },
        F.col("is_fallback"),
    )
