"""Declared schemas as DDL text; every reader uses one, nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def parsed(ddl: str) -> T.StructType:
    """The schema as a type; needs a running session."""
    return T.StructType.fromDDL(" ".join(ddl.split()))


# The flat export: one row per cluster, node pool and metric point.
OBSERVATION = """
    project_id string, fetched_at string, resource_id string, cluster_name string, location string, status string,
    current_master_version string, current_node_version string, current_node_count string,
    autopilot_enabled string, release_channel string, network string, subnetwork string,
    logging_service string, monitoring_service string, endpoint string,
    node_pool_resource_id string, node_pool_name string, node_pool_status string, node_pool_version string,
    machine_type string, disk_size_gb string, disk_type string, image_type string,
    preemptible string, spot string, initial_node_count string,
    autoscaling_enabled string, min_node_count string, max_node_count string, locations string,
    metric_name string, aggregation string, percentile string, unit string, interval string,
    metric_timestamp string, metric_value string, metric_error string
"""

METRIC_POINT = """
    account_id string, aggregation_type string, client_id string, cloud_name string, date string,
    ingestion_timestamp string, job_runtime_utc timestamp, metric_date string, metric_name string,
    metric_type string, metric_unit string, metric_value double, namespace string, zone string, region string,
    resource_id string, resource_name string, service_name string, unit string, year_month string, percentile int
"""
# Two percentiles of one metric differ in nothing else, so the percentile belongs to the key.
METRIC_KEY = ("client_id", "account_id", "resource_id", "date", "metric_name", "aggregation_type", "percentile")
RESOURCE_KEY = ("client_id", "account_id", "resource_id")
PARTITION_COLUMNS = ("client_id", "account_id", "year_month")

_SKU = """
    skuId: string, description: string,
    category: struct<resourceFamily: string, resourceGroup: string, usageType: string>,
    serviceRegions: array<string>,
    pricingInfo: array<struct<pricingExpression: struct<tieredRates: array<
        struct<unitPrice: struct<units: string, nanos: bigint>>>>>>
    """
BILLING_PAGE = f"skus array<struct<{_SKU}>>"

_MACHINE = """
    machine_type: string, family: string, vcpus: double, ram_gb: double,
    hourly_price: double, monthly_price: double, annual_price: double, ordinal: int
    """
# Family-keyed catalog file: a map at the top level, so it is read as text and parsed with this type.
FAMILY_CATALOG = f"""map<string, struct<
    family: string, region: string, cpu_hourly_price: double, ram_hourly_price_per_gb: double,
    machine_types: array<struct<{_MACHINE}>>>>"""
# The same catalog as this package writes it: lists of machines, one per line.
CATALOG_LINE = f"family string, chunk int, machine_types array<struct<{_MACHINE}>>"
_SECTION = f"""struct<job_type: string, region: string, vcpu_hourly_price: double,
    memory_hourly_price_per_gib: double, machine_types: array<struct<{_MACHINE}>>>"""
JOB_CATALOG = f"batch {_SECTION}, streaming {_SECTION}"
COMPONENT_CATALOG = """map<string, struct<
    region: string, description: string, hourly_price: double, monthly_price: double, annual_price: double,
    hourly_price_per_vm: double, hourly_price_cap: double, vm_cap: int, price_per_gib: double>>"""

RULE_LOGIC = "logic string, conditions array<struct<metric: string, operator: string, threshold: double>>"
RULE = """
    rule_code string, service_code string, service_name string, cloud_provider string, evaluation_logic string,
    category string, title string, description string, recommendation_template string,
    estimated_savings_formula string, is_active boolean
"""
SERVICE_CONFIG = """
    service_code string, service_name string, cloud_provider string, category string,
    iceberg_metrics_table string, iceberg_resources_table string, is_active boolean,
    recommender_class string, sku_json_file string, display_service_name string
"""
RECOMMENDATION_COLUMNS = (
    "resource_id",
    "rule_code",
    "recommendation",
    "current_annual",
    "target_annual",
    "annual_savings",
    "is_fallback",
    "details",
)
