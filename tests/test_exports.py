"""Exported records of any shape, runs over them, and their counts."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from costgauge.operators import ingest
from costgauge.params import RunParams
from costgauge.plans import ingestion
from costgauge.services import get_service
from costgauge.sources import readers, writers

PARAMS = RunParams("project-1", "client-1", run_ts=datetime(2024, 1, 31, tzinfo=timezone.utc))
CLUSTERS, POOLS = "bronze_gcp_gke_clusters", "bronze_gcp_gke_node_pools"
CLUSTER = {"name": "one", "location": "here", "current_node_count": "3", "autopilot": {"enabled": True}, "resource_labels": {"a": "b"}}
RECORDS = [
    (CLUSTERS, CLUSTER),
    (CLUSTERS, {"name": "two", "current_node_count": "many", "autopilot": "on", "locations": [1]}),
    (POOLS, {"parent_id": "one", "name": "pool", "config": {"machine_type": "e2"}, "locations": ["x", None]}),
    (POOLS, {"parent_id": "unknown", "name": "lost"}),
    (POOLS, {"name": "no parent"}),
]


def exported(spark, folder):
    rows = spark.createDataFrame([(name, json.dumps(record)) for name, record in RECORDS], "table_name string, line string")
    writers.write_records(rows, folder)
    return readers.exported_records(spark, folder)


def test_fields_of_any_record(spark, tmp_path):
    line = {"n": {"x": 2.5, "b": True, "l": [1, "a"], "o": {"k": None}}, "t": "7", "z": None, "e": ""}
    rows = spark.createDataFrame([("t", json.dumps(line)), ("t", "{}"), ("t", "[1]")], "table_name string, line string")
    writers.write_records(rows, str(tmp_path / "x"))
    wanted = [
        ("x", "string", "n.x"), ("b", "string", "n.b"), ("l", "string", "n.l"), ("o", "string", "n.o"), ("t", "double", "t"),
        ("z", "string", "z"), ("e", "string", "e"), ("inside", "string", "n.l.k"), ("no_int", "int", "n.l"), ("gone", "string", "q.r"),
    ]
    found = ingest.read_fields(readers.exported_records(spark, str(tmp_path / "x")), "record", wanted, ["table_name"])
    rows = sorted((tuple(r) for r in found.collect()), key=str)
    full = ("t", "2.5", "true", '[1,"a"]', '{"k":null}', 7.0, None, "", None, None, None)
    assert rows == sorted([full, ("t",) + (None,) * 10, ("t",) + (None,) * 10], key=str)


def test_one_folder_feeds_all_tables(spark, tmp_path):
    tables = ingestion.run_export(exported(spark, str(tmp_path / "r")), [get_service("GKE"), get_service("CloudKMS")], PARAMS)
    clusters = {r.cluster_name: r for r in tables[CLUSTERS].collect()}
    assert clusters["one"].resource_id == "project-1.here.one" and clusters["one"].current_node_count == 3.0
    assert clusters["one"].autopilot_enabled == "true" and clusters["one"].labels == {"a": "b"}
    assert clusters["two"].current_node_count is None and clusters["two"].labels is None and clusters["two"].autopilot_enabled is None
    [pool] = tables[POOLS].collect()
    assert (pool.resource_id, pool.location, pool.machine_type) == ("project-1.here.one.pool", "here", "e2")
    assert pool.locations == '["x",null]'
    # A kind without records has an empty table.
    assert tables["bronze_gcp_kms_key_rings"].count() == 0
    # Only the files of the table's own kind are read.
    plan = tables[CLUSTERS]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(table_name" in plan and f"= {CLUSTERS})" in plan


def test_dry_run_counts_in_one_job(spark, tmp_path):
    tables = ingestion.run_export(exported(spark, str(tmp_path / "r")), [get_service("GKE"), get_service("CloudKMS")], PARAMS)
    tables = {name: t for name, t in tables.items() if name != POOLS}
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("dry", "dry run")
    counts = ingestion.dry_run(tables)
    jobs = tracker.getJobIdsForGroup("dry")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts[CLUSTERS] == 2 and counts["bronze_gcp_kms_key_rings"] == 0
    # The join of keys to their rings may bring a job of its own for its small side.
    assert len(jobs) <= 2


def test_counts_come_with_the_write(spark, tmp_path):
    tables = {"a": spark.range(5), "b": spark.createDataFrame([("x", 1)], "k string, v int"), "none": spark.range(0)}
    folder = str(tmp_path / "w")
    assert ingest.observed_counts(tables, lambda rows: writers.write_records(rows, folder)) == {"a": 5, "b": 1, "none": 0}
    assert readers.exported_records(spark, folder).groupBy("table_name").count().count() == 2


def test_pages_one_per_line(spark, tmp_path):
    page = {"skus": [{"skuId": "a", "serviceRegions": []}, {"skuId": "b"}]}
    (tmp_path / "p.json").write_text(json.dumps(page) + "\n" + json.dumps(page))
    found = readers.billing_skus(spark, str(tmp_path / "p.json"), one_per_line=True)
    assert sorted(r.skuId for r in found.collect()) == ["a", "a", "b", "b"]
