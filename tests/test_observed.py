"""From the exported file to recommendations."""

from __future__ import annotations

import csv

from costgauge import schemas
from costgauge.operators import rules
from costgauge.operators.catalog import specs
from costgauge.operators.matching import Catalog
from costgauge.plans import observed, pipeline
from costgauge.sources import readers, seeds

CPU = "kubernetes.io/node/cpu/allocatable_utilization"
MEMORY = "kubernetes.io/node/memory/allocatable_utilization"


def test_export_to_report(spark, tmp_path):
    path = tmp_path / "export.csv"
    columns = [c.split()[0] for c in schemas.OBSERVATION.split(",")]
    base = {"location": "us-central1-a", "machine_type": "e2-standard-8", "current_node_count": "2"}
    rows = [
        {**base, "cluster_name": "idle", "metric_name": CPU, "metric_value": "0.01"},
        {**base, "cluster_name": "idle", "metric_name": CPU, "metric_value": "0.0"},
        {**base, "cluster_name": "idle", "metric_name": MEMORY, "metric_value": "0.1", "machine_type": "later"},
        {**base, "cluster_name": "busy", "metric_name": CPU, "metric_value": "0.9"},
        {**base, "cluster_name": "busy", "metric_name": MEMORY, "metric_value": "0.9"},
        {**base, "cluster_name": "silent", "metric_name": CPU, "metric_value": ""},
        {**base, "cluster_name": "odd", "metric_name": "other", "metric_value": "0.5"},
        {**base, "cluster_name": "blank", "metric_name": CPU, "metric_value": "0.3", "current_node_count": ""},
        {**base, "cluster_name": "", "metric_name": CPU, "metric_value": "0.3"},
    ]
    with path.open("w", newline="", encoding="utf-8") as file:
        writer = csv.DictWriter(file, columns)
        writer.writeheader()
        writer.writerows(rows)
    machines = [
        ("e2", "e2-standard-2", 2.0, 8.0, 0.07, 1), ("e2", "e2-standard-4", 4.0, 16.0, 0.13, 2), ("e2", "e2-standard-8", 8.0, 32.0, 0.27, 3),
    ]
    entries = specs(
        spark.createDataFrame(machines, "family string, machine_type string, vcpus double, ram_gb double, hourly_price double, ordinal int")
    )
    prices = pipeline.Prices(Catalog(entries, "family", unique=True))
    found = observed.assess(readers.observations(spark, str(path)), rules.rule_frame(spark, seeds.GKE_RULES), prices)
    report = {(r.resource_id, r.rule_code): r for r in found.report.collect()}
    assert set(report) == {("idle", "GKE_IDLE"), ("idle", "GKE_OVERPROVISIONED"), ("blank", "GKE_OVERPROVISIONED")}
    assert report["idle", "GKE_IDLE"].annual_savings == round(0.27 * 8760 * 2, 2)
    assert report["idle", "GKE_OVERPROVISIONED"].recommendation.endswith("rightsize from e2-standard-8 to e2-standard-2")
    # 0.3 x 8 x 1.3 = 3.12 vCPUs; memory was not measured, so half of it.
    assert report["blank", "GKE_OVERPROVISIONED"].recommendation.endswith("to e2-standard-4")
    assert report["blank", "GKE_OVERPROVISIONED"].current_annual == round(0.27 * 8760, 2)
    assert [r.cluster_name for r in found.healthy.collect()] == ["busy"]
    assert sorted(r.cluster_name for r in found.without_metrics.collect()) == ["odd", "silent"]
    assert found.unhandled.count() == 0


def test_first_row_does_not_depend_on_packing(spark, tmp_path):
    """One file, many files, and many files in one task give the same first row of a cluster."""
    columns = [c.split()[0] for c in schemas.OBSERVATION.split(",")]
    rows = [{"cluster_name": f"c{i % 7}", "location": f"place-{i}", "machine_type": f"m{i}"} for i in range(200)]
    sizes = {"one": [200], "many": [3, 120, 1, 50, 26]}
    for name, parts in sizes.items():
        (tmp_path / name).mkdir()
        at = 0
        for place, n in enumerate(parts):
            with (tmp_path / name / f"part-{place:03d}.csv").open("w", newline="", encoding="utf-8") as file:
                writer = csv.DictWriter(file, columns)
                writer.writeheader()
                writer.writerows(rows[at : at + n])
            at += n
    wanted = {f"c{i}": f"place-{i}" for i in range(7)}
    for name in sizes:
        for bytes_, cost in (("128MB", "4MB"), ("128MB", "1"), ("2KB", "1")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_)
            spark.conf.set("spark.sql.files.openCostInBytes", cost)
            try:
                found = observed.clusters(readers.observations(spark, str(tmp_path / name)))
                assert {r.cluster_name: r.location for r in found.collect()} == wanted
            finally:
                spark.conf.unset("spark.sql.files.maxPartitionBytes")
                spark.conf.unset("spark.sql.files.openCostInBytes")
