"""Seed tables: machine shapes, fixed catalogs, rules and service configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from costgauge.operators.rules import Condition, Rule
from costgauge.schemas import SERVICE_CONFIG
from costgauge.sources.local import local_table
from costgauge.sources.readers import explode_job_catalog

# Machines as (type, vCPUs, GB of RAM).
COMPUTE_MACHINES = (
    ("e2-micro", 0.25, 1),
    ("e2-small", 0.5, 2),
    ("e2-medium", 1, 4),
    ("e2-standard-2", 2, 8),
    ("e2-standard-4", 4, 16),
    ("e2-standard-8", 8, 32),
    ("e2-standard-16", 16, 64),
    ("e2-standard-32", 32, 128),
    ("e2-highmem-2", 2, 16),
    ("e2-highmem-4", 4, 32),
    ("e2-highmem-8", 8, 64),
    ("e2-highmem-16", 16, 128),
    ("e2-highcpu-2", 2, 2),
    ("e2-highcpu-4", 4, 4),
    ("e2-highcpu-8", 8, 8),
    ("e2-highcpu-16", 16, 16),
    ("e2-highcpu-32", 32, 32),
    ("n1-standard-1", 1, 3.75),
    ("n1-standard-2", 2, 7.5),
    ("n1-standard-4", 4, 15),
    ("n1-standard-8", 8, 30),
    ("n1-standard-16", 16, 60),
    ("n1-standard-32", 32, 120),
    ("n1-standard-64", 64, 240),
    ("n1-standard-96", 96, 360),
    ("n1-highmem-2", 2, 13),
    ("n1-highmem-4", 4, 26),
    ("n1-highmem-8", 8, 52),
    ("n1-highmem-16", 16, 104),
    ("n1-highmem-32", 32, 208),
    ("n1-highmem-64", 64, 416),
    ("n1-highmem-96", 96, 624),
    ("n1-highcpu-2", 2, 1.8),
    ("n1-highcpu-4", 4, 3.6),
    ("n1-highcpu-8", 8, 7.2),
    ("n1-highcpu-16", 16, 14.4),
    ("n1-highcpu-32", 32, 28.8),
    ("n1-highcpu-64", 64, 57.6),
    ("n1-highcpu-96", 96, 86.4),
    ("n2-standard-2", 2, 8),
    ("n2-standard-4", 4, 16),
    ("n2-standard-8", 8, 32),
    ("n2-standard-16", 16, 64),
    ("n2-standard-32", 32, 128),
    ("n2-standard-48", 48, 192),
    ("n2-standard-64", 64, 256),
    ("n2-standard-80", 80, 320),
    ("n2-standard-96", 96, 384),
    ("n2-standard-128", 128, 512),
    ("n2-highmem-2", 2, 16),
    ("n2-highmem-4", 4, 32),
    ("n2-highmem-8", 8, 64),
    ("n2-highmem-16", 16, 128),
    ("n2-highmem-32", 32, 256),
    ("n2-highmem-48", 48, 384),
    ("n2-highmem-64", 64, 512),
    ("n2-highmem-80", 80, 640),
    ("n2-highcpu-2", 2, 2),
    ("n2-highcpu-4", 4, 4),
    ("n2-highcpu-8", 8, 8),
    ("n2-highcpu-16", 16, 16),
    ("n2-highcpu-32", 32, 32),
    ("n2-highcpu-48", 48, 48),
    ("n2-highcpu-64", 64, 64),
    ("n2-highcpu-80", 80, 80),
    ("n2-highcpu-96", 96, 96),
    ("n2d-standard-2", 2, 8),
    ("n2d-standard-4", 4, 16),
    ("n2d-standard-8", 8, 32),
    ("n2d-standard-16", 16, 64),
    ("n2d-standard-32", 32, 128),
    ("n2d-standard-48", 48, 192),
    ("n2d-standard-64", 64, 256),
    ("n2d-standard-96", 96, 384),
    ("n2d-standard-128", 128, 512),
    ("n2d-standard-224", 224, 896),
    ("n2d-highmem-2", 2, 16),
    ("n2d-highmem-4", 4, 32),
    ("n2d-highmem-8", 8, 64),
    ("n2d-highmem-16", 16, 128),
    ("n2d-highmem-32", 32, 256),
    ("n2d-highmem-48", 48, 384),
    ("n2d-highmem-64", 64, 512),
    ("n2d-highmem-96", 96, 768),
    ("n2d-highcpu-2", 2, 2),
    ("n2d-highcpu-4", 4, 4),
    ("n2d-highcpu-8", 8, 8),
    ("n2d-highcpu-16", 16, 16),
    ("n2d-highcpu-32", 32, 32),
    ("n2d-highcpu-48", 48, 48),
    ("n2d-highcpu-64", 64, 64),
    ("n2d-highcpu-96", 96, 96),
    ("c2-standard-4", 4, 16),
    ("c2-standard-8", 8, 32),
    ("c2-standard-16", 16, 64),
    ("c2-standard-30", 30, 120),
    ("c2-standard-60", 60, 240),
    ("c2d-standard-2", 2, 8),
    ("c2d-standard-4", 4, 16),
    ("c2d-standard-8", 8, 32),
    ("c2d-standard-16", 16, 64),
    ("c2d-standard-32", 32, 128),
    ("c2d-standard-56", 56, 224),
    ("c2d-standard-112", 112, 448),
    ("c2d-highmem-2", 2, 16),
    ("c2d-highmem-4", 4, 32),
    ("c2d-highmem-8", 8, 64),
    ("c2d-highmem-16", 16, 128),
    ("c2d-highmem-32", 32, 256),
    ("c2d-highmem-56", 56, 448),
    ("c2d-highmem-112", 112, 896),
    ("c2d-highcpu-2", 2, 2),
    ("c2d-highcpu-4", 4, 4),
    ("c2d-highcpu-8", 8, 8),
    ("c2d-highcpu-16", 16, 16),
    ("c2d-highcpu-32", 32, 32),
    ("c2d-highcpu-56", 56, 56),
    ("c2d-highcpu-112", 112, 112),
    ("t2d-standard-1", 1, 4),
    ("t2d-standard-2", 2, 8),
    ("t2d-standard-4", 4, 16),
    ("t2d-standard-8", 8, 32),
    ("t2d-standard-16", 16, 64),
    ("t2d-standard-32", 32, 128),
    ("t2d-standard-48", 48, 192),
    ("t2d-standard-60", 60, 240),
    ("t2a-standard-1", 1, 4),
    ("t2a-standard-2", 2, 8),
    ("t2a-standard-4", 4, 16),
    ("t2a-standard-8", 8, 32),
    ("t2a-standard-16", 16, 64),
    ("t2a-standard-32", 32, 128),
    ("t2a-standard-48", 48, 192),
)
# The same for data pipeline workers.
WORKER_MACHINES = (
    ("n1-standard-1", 1, 3.75),
    ("n1-standard-2", 2, 7.5),
    ("n1-standard-4", 4, 15),
    ("n1-standard-8", 8, 30),
    ("n1-standard-16", 16, 60),
    ("n1-standard-32", 32, 120),
    ("n1-standard-64", 64, 240),
    ("n1-highmem-2", 2, 13),
    ("n1-highmem-4", 4, 26),
    ("n1-highmem-8", 8, 52),
    ("n1-highmem-16", 16, 104),
    ("n1-highmem-32", 32, 208),
    ("n1-highcpu-2", 2, 1.8),
    ("n1-highcpu-4", 4, 3.6),
    ("n1-highcpu-8", 8, 7.2),
    ("n1-highcpu-16", 16, 14.4),
    ("n1-highcpu-32", 32, 28.8),
    ("n2-standard-2", 2, 8),
    ("n2-standard-4", 4, 16),
    ("n2-standard-8", 8, 32),
    ("n2-standard-16", 16, 64),
    ("n2-standard-32", 32, 128),
    ("n2-standard-48", 48, 192),
    ("n2-standard-64", 64, 256),
    ("n2-highmem-2", 2, 16),
    ("n2-highmem-4", 4, 32),
    ("n2-highmem-8", 8, 64),
    ("n2-highmem-16", 16, 128),
    ("n2-highcpu-2", 2, 2),
    ("n2-highcpu-4", 4, 4),
    ("n2-highcpu-8", 8, 8),
    ("n2-highcpu-16", 16, 16),
    ("n2-highcpu-32", 32, 32),
    ("e2-standard-2", 2, 8),
    ("e2-standard-4", 4, 16),
    ("e2-standard-8", 8, 32),
    ("e2-standard-16", 16, 64),
    ("e2-standard-32", 32, 128),
    ("e2-highmem-2", 2, 16),
    ("e2-highmem-4", 4, 32),
    ("e2-highmem-8", 8, 64),
    ("e2-highmem-16", 16, 128),
    ("e2-highcpu-2", 2, 2),
    ("e2-highcpu-4", 4, 4),
    ("e2-highcpu-8", 8, 8),
    ("e2-highcpu-16", 16, 16),
    ("e2-highcpu-32", 32, 32),
    ("c2-standard-4", 4, 16),
    ("c2-standard-8", 8, 32),
    ("c2-standard-16", 16, 64),
    ("c2-standard-30", 30, 120),
    ("c2-standard-60", 60, 240),
    ("n2d-standard-2", 2, 8),
    ("n2d-standard-4", 4, 16),
    ("n2d-standard-8", 8, 32),
    ("n2d-standard-16", 16, 64),
    ("n2d-standard-32", 32, 128),
    ("n2d-standard-48", 48, 192),
    ("n2d-standard-64", 64, 256),
)
# Worker prices per hour as (type, vCPUs, GB of RAM, dollars), in price list order.
BATCH_WORKERS = (
    ("n1-standard-1", 1, 3.75, 0.069339),
    ("n1-standard-2", 2, 7.5, 0.138678),
    ("n1-standard-4", 4, 15, 0.277355),
    ("n1-standard-8", 8, 30, 0.554711),
    ("n1-standard-16", 16, 60, 1.109421),
    ("n1-standard-32", 32, 120, 2.218843),
    ("n1-standard-64", 64, 240, 4.437685),
    ("n1-highmem-2", 2, 13, 0.158241),
    ("n1-highmem-4", 4, 26, 0.316481),
    ("n1-highmem-8", 8, 52, 0.632963),
    ("n1-highmem-16", 16, 104, 1.265925),
    ("n1-highmem-32", 32, 208, 2.531851),
    ("n1-highcpu-2", 2, 1.8, 0.118402),
    ("n1-highcpu-4", 4, 3.6, 0.236804),
    ("n1-highcpu-8", 8, 7.2, 0.473608),
    ("n1-highcpu-16", 16, 14.4, 0.947216),
    ("n1-highcpu-32", 32, 28.8, 1.894431),
    ("n2-standard-2", 2, 8, 0.140456),
    ("n2-standard-4", 4, 16, 0.280911),
    ("n2-standard-8", 8, 32, 0.561823),
    ("n2-standard-16", 16, 64, 1.123645),
    ("n2-standard-32", 32, 128, 2.247291),
    ("e2-standard-2", 2, 8, 0.140456),
    ("e2-standard-4", 4, 16, 0.280911),
    ("e2-standard-8", 8, 32, 0.561823),
    ("e2-standard-16", 16, 64, 1.123645),
    ("c2-standard-4", 4, 16, 0.280911),
    ("c2-standard-8", 8, 32, 0.561823),
    ("c2-standard-16", 16, 64, 1.123645),
    ("c2-standard-30", 30, 120, 2.10684),
    ("c2-standard-60", 60, 240, 4.21368),
)
STREAMING_WORKERS = (
    ("n1-standard-4", 4, 15, 0.329355),
    ("n1-standard-8", 8, 30, 0.658711),
    ("n1-standard-16", 16, 60, 1.317421),
    ("n1-standard-32", 32, 120, 2.634843),
    ("n1-highmem-4", 4, 26, 0.368482),
    ("n1-highmem-8", 8, 52, 0.736963),
    ("n2-standard-4", 4, 16, 0.332912),
    ("n2-standard-8", 8, 32, 0.665824),
)
# Network component prices per hour.
COMPONENTS = (
    ("vpn_tunnel", "us-central1", 0.05),
    ("nat_ip", "us-central1", 0.005),
    ("cloud_router", "us-central1", 0.0),
    ("interconnect_vlan", "us-central1", 0.10),
)

# The rules and the service row that stored tables hold.
GKE_RULES = (
    Rule(
        rule_code="GKE_IDLE",
        service_code="GKE",
        conditions=(Condition("cpu_utilization_avg", "lt", 5), Condition("memory_utilization_avg", "lt", 20)),
        logic="AND",
        description="Node pool CPU avg < 5% AND memory avg < 20% — likely idle",
        recommendation_template="Idle GKE node pool — delete or scale to 0 nodes (current: {current_sku})",
        estimated_savings_formula="total_cost * 1",
    ),
    Rule(
        rule_code="GKE_OVERPROVISIONED",
        service_code="GKE",
        conditions=(Condition("cpu_utilization_avg", "lt", 40), Condition("memory_utilization_avg", "lt", 50)),
        logic="OR",
        description="Node pool CPU avg < 40% OR memory avg < 50% — candidate for downsizing",
        recommendation_template="Overprovisioned GKE node pool — rightsize from {current_sku} to {target_sku}",
        estimated_savings_formula="current_cost - target_cost",
    ),
)
SERVICE_CONFIGURATION = (
    (
        "GKE",
        "Google Kubernetes Engine",
        "gcp",
        "Compute",
        "bronze_gcp_metrics_v2",
        "bronze_gcp_gke_clusters",
        True,
        "gke",
        "gke_sku.json",
        "Google Kubernetes Engine (GKE)",
    ),
)


def machine_rows(machines: tuple) -> list[tuple[str, str, float, float]]:
    """(family, machine type, vCPUs, RAM) of every listed machine."""
    return [(name.split("-")[0], name, float(vcpus), float(ram)) for name, vcpus, ram in machines]


MACHINE_COLUMNS = "family string, machine_type string, vcpus double, ram_gb double"


def compute_machines(spark: SparkSession) -> DataFrame:
    return local_table(spark, machine_rows(COMPUTE_MACHINES), MACHINE_COLUMNS)


def worker_machines(spark: SparkSession) -> DataFrame:
    return local_table(spark, machine_rows(WORKER_MACHINES), MACHINE_COLUMNS)


_LISTED = "array<struct<machine_type: string, family: string, vcpus: double, ram_gb: double, hourly_price: double, ordinal: int>>"


def worker_sections(spark: SparkSession) -> DataFrame:
    """The pipeline worker price list in the shape of its file: one row, a section per job type."""

    def section(workers: tuple) -> dict:
        entries = [
            {"machine_type": name, "family": None, "vcpus": float(v), "ram_gb": float(ram), "hourly_price": price, "ordinal": place}
            for place, (name, v, ram, price) in enumerate(workers, 1)
        ]
        return {"machine_types": entries}

    schema = f"batch struct<machine_types: {_LISTED}>, streaming struct<machine_types: {_LISTED}>"
    return local_table(spark, [(section(BATCH_WORKERS), section(STREAMING_WORKERS))], schema)


def worker_catalog(spark: SparkSession) -> DataFrame:
    """The pipeline worker price list as flat rows; the ordinal is the place in the list."""
    return explode_job_catalog(worker_sections(spark))


def components(spark: SparkSession) -> DataFrame:
    return local_table(spark, list(COMPONENTS), "component string, region string, hourly_price double")


def service_configuration(spark: SparkSession) -> DataFrame:
    return local_table(spark, list(SERVICE_CONFIGURATION), SERVICE_CONFIG)
