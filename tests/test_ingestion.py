"""From exported records to stored tables."""

from __future__ import annotations

import json
from dataclasses import replace
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from costgauge import schemas
from costgauge.operators import catalog, ingest, timeseries, upsert
from costgauge.params import RunParams, parse_params
from costgauge.plans import ingestion
from costgauge.services import DECLARED, active_services, get_service, list_services
from costgauge.sources import readers, seeds, writers

RUN = datetime(2024, 1, 31, 12, tzinfo=timezone.utc)
PARAMS = RunParams("proj", "client", "partner", run_ts=RUN)


def test_parameters():
    args = {"PROJECT_ID": "p", "CLIENT_ID": "c", "S3_BUCKET": "b", "ACTIVE_SERVICES": " gke, ,Pubsub "}
    params = parse_params(args, RUN)
    assert params.active_services == ("GKE", "PUBSUB") and params.window_days == 7 and params.client_ids == ("c",)
    with pytest.raises(KeyError):
        parse_params({"PROJECT_ID": "p"})


def test_declared_services(spark):
    assert len(DECLARED) == 20 and sum(len(s.tables) for s in DECLARED) == 31
    assert get_service("gke").name == "GKE" and get_service("PUBSUB").name == "Pub/Sub" and get_service("nope") is None
    assert len(list_services("registered")) == 5 and len(list_services("catalog")) == 5 and len(list_services()) == 20
    assert [s.name for s in active_services(["pubsub", "GKE"])] == ["GKE", "Pub/Sub"]
    for service in DECLARED:
        for table in service.tables:
            names = schemas.parsed(table.ddl).fieldNames()
            assert len(names) == len(set(names)) and set(table.key) <= set(names) and set(table.partition_by) <= set(names)
            assert all(f in names for f in table.id_fields)
        keys = [(s.metric_name, s.aggregation, s.interval, s.percentile) for s in service.specs]
        assert len(keys) == len(set(keys))


CLUSTERS = [
    {
        "name": "c1", "location": "us-central1-a", "current_node_count": 3, "autopilot": {"enabled": True},
        "resource_labels": {"team": "a"}, "release_channel": None,
    },
    {"name": "c2", "location": "us-east1", "current_node_count": None},
    {"name": None, "location": "nowhere"},
]
POOLS = [
    {"parent_id": "c1", "name": "p1", "config": {"machine_type": "e2-medium", "spot": False}, "initial_node_count": 2, "locations": ["a", "b"]},
    {"parent_id": "c2", "name": "p2", "config": {"machine_type": "e2-small"}},
    {"parent_id": "lost", "name": "p3"},
]
CLUSTER_DDL = """name string, location string, current_node_count int, autopilot struct<enabled: boolean>,
  release_channel struct<channel: string>, resource_labels map<string, string>"""
POOL_DDL = """parent_id string, name string, config struct<machine_type: string, spot: boolean>, initial_node_count int,
  locations array<string>"""


def records(spark, tmp_path, name, rows, ddl):
    path = tmp_path / name
    path.mkdir()
    (path / "part.json").write_text("\n".join(json.dumps(r) for r in rows))
    return readers.resources(spark, str(path), schemas.parsed(ddl))


def test_run_of_a_service(spark, tmp_path):
    gke = get_service("GKE")
    clusters = records(spark, tmp_path, "clusters", CLUSTERS, CLUSTER_DDL)
    pools = records(spark, tmp_path, "pools", POOLS, POOL_DDL)
    cpu = "kubernetes.io/node/cpu/allocatable_utilization"
    points = spark.createDataFrame(
        [
            ("proj.us-central1-a.c1", cpu, "2024-01-31 11:01:00", 0.2),
            ("proj.us-central1-a.c1", cpu, "2024-01-31 11:04:00", 0.4),
            ("proj.us-central1-a.c1", cpu, "2024-01-01 11:04:00", 0.9),
            ("proj.us-central1-a.c1", "other", "2024-01-31 11:04:00", 0.9),
            ("unknown", cpu, "2024-01-31 11:04:00", 0.9),
        ],
        "resource_id string, metric_name string, ts string, value double",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    tables = ingestion.run_service(
        gke, {"bronze_gcp_gke_clusters": clusters, "bronze_gcp_gke_node_pools": pools}, points, PARAMS
    )
    assert set(tables) == {"bronze_gcp_gke_clusters", "bronze_gcp_gke_node_pools", "bronze_gcp_metrics_v2"}
    for name, table in tables.items():
        assert {r.client_id for r in table.select("client_id").distinct().collect()} == {"client", "partner"}, name
    mine = tables["bronze_gcp_gke_clusters"].where("client_id = 'client'")
    found = {r.resource_id: r for r in mine.collect()}
    first = found["proj.us-central1-a.c1"]
    assert first.labels == {"team": "a"} and first.autopilot_enabled == "true" and first.current_node_count == 3.0
    assert first.year_month == "2024-01" and first.cloud_name == "gcp" and first.resource_name == "c1"
    assert "proj.nowhere." in found
    kids = {r.node_pool_name: r for r in tables["bronze_gcp_gke_node_pools"].where("client_id = 'client'").collect()}
    assert set(kids) == {"p1", "p2"}
    assert kids["p1"].location == "us-central1-a" and kids["p1"].cluster_name == "c1" and kids["p1"].locations == '["a","b"]'
    assert kids["p1"].resource_id == "proj.us-central1-a.c1.p1"
    rows = tables["bronze_gcp_metrics_v2"].where("client_id = 'client'").collect()
    assert len(rows) == 1
    assert (rows[0].metric_value, rows[0].date, rows[0].region) == (0.3, "2024-01-31T11:00:00Z", "us-central1-a")
    assert rows[0].unit == rows[0].metric_unit == "Ratio" and rows[0].metric_type is None
    counts = {r.table_name: r.n_rows for r in ingest.row_counts(tables).collect()}
    assert counts["bronze_gcp_gke_node_pools"] == 4
    warehouse = str(tmp_path / "warehouse")
    for _ in range(2):
        assert ingestion.store(gke, tables, warehouse) == counts
    assert spark.read.parquet(f"{warehouse}/bronze_gcp_gke_node_pools").count() == 4


def test_filter_hook(spark, tmp_path):
    gke = get_service("GKE")
    table = replace(gke.tables[0], keep=lambda df: F.col("location") != "nowhere")
    clusters = records(spark, tmp_path, "clusters", CLUSTERS, CLUSTER_DDL)
    assert ingestion.snapshot(clusters, table, gke, PARAMS).count() == 2


def test_flattening(spark):
    rows = [(1, ["a"], None, None), (2, [], ["b", "c"], None), (3, None, [], None), (4, None, None, "d"), (5, ["e"], ["f"], None)]
    entries = spark.createDataFrame(rows, "k int, instances array<string>, items array<string>, record string")
    got = sorted((r.k, r.record) for r in ingest.flatten_scoped(entries).collect())
    assert got == [(1, "a"), (2, "b"), (2, "c"), (4, "d"), (5, "e")]


def test_first_rows_and_conform(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("", 0, "z"), (None, 0, "z")], "k string, seq int, v string")
    assert [tuple(r) for r in ingest.first_rows(rows, "k", ["seq"], ["v"]).collect()] == [("a", "y")]
    declared = schemas.parsed("v int, missing timestamp, labels map<string,string>")
    odd = spark.createDataFrame([("7", '{"a":"b"}'), ("x", "no")], "v string, labels string")
    assert [(r.v, r.missing, r.labels) for r in ingest.conform(odd, declared).collect()] == [(7, None, {"a": "b"}), (None, None, None)]


# Upsert ----------------------------------------------------------------------------------------

KEY, ORDER, PARTS = ["client_id", "id"], ["run"], ["client_id", "year_month"]


def snapshot(spark, rows):
    return spark.createDataFrame(rows, "client_id string, year_month string, id int, run int, v string")


def test_upsert_takes_the_latest_source_row(spark):
    target = snapshot(spark, [("c", "m1", 1, 9, "old"), ("c", "m1", 2, 1, "kept")])
    source = snapshot(spark, [("c", "m2", 1, 1, "new"), ("c", "m2", 1, 2, "newer"), ("c", "m2", 3, 1, "added")])
    merged = upsert.upsert(target, source, KEY, ORDER)
    want = {(1, "newer", "m2"), (2, "kept", "m1"), (3, "added", "m2")}
    assert {(r.id, r.v, r.year_month) for r in merged.collect()} == want
    again = upsert.upsert(merged, source, KEY, ORDER)
    assert {(r.id, r.v, r.year_month) for r in again.collect()} == want


def test_upsert_into_files_moves_rows_between_partitions(spark, tmp_path):
    path = str(tmp_path / "table")
    one = snapshot(spark, [("c", "m1", 1, 1, "a"), ("d", "m1", 1, 1, "other")])
    two = snapshot(spark, [("c", "m2", 1, 2, "b"), ("c", "m2", 2, 2, "n")])
    assert writers.upsert_path(one.limit(0), path, KEY, ORDER, PARTS) == 0
    assert writers.upsert_path(one, path, KEY, ORDER, PARTS) == 2
    assert writers.upsert_path(two, path, KEY, ORDER, PARTS) == 2
    assert writers.upsert_path(two, path, KEY, ORDER, PARTS) == 2
    stored = spark.read.parquet(path)
    assert {(r.client_id, r.year_month, r.id, r.v) for r in stored.collect()} == {
        ("c", "m2", 1, "b"), ("c", "m2", 2, "n"), ("d", "m1", 1, "other"),
    }
    assert not (tmp_path / "table" / "client_id=c" / "year_month=m1").exists()


def test_reload_by_service(spark, tmp_path):
    path = str(tmp_path / "rules")
    ddl = "rule_code string, service_code string"
    first = spark.createDataFrame([("A", "GKE"), ("B", "GKE"), ("C", "DNS")], ddl)
    second = spark.createDataFrame([("N", "GKE")], ddl)
    assert {r.rule_code for r in upsert.reload(first, second).collect()} == {"C", "N"}
    for _ in range(2):
        writers.reload_path(first, path)
        writers.reload_path(second, path)
        assert {r.rule_code for r in spark.read.parquet(path).collect()} == {"C", "N"}


def test_create_table_once(spark):
    schema = schemas.parsed("id int, v string, year_month string")
    for _ in range(2):
        writers.create_table(spark, "snapshots", schema, ["year_month"])
    assert spark.table("snapshots").columns == ["id", "v", "year_month"]
    spark.sql("DROP TABLE snapshots")


# Sources and files -----------------------------------------------------------------------------


def test_observation_file(spark, tmp_path):
    clusters = spark.createDataFrame([("c1", "us"), ("c2", "eu")], "resource_id string, location string")
    points = spark.createDataFrame(
        [("c1", "cpu", "2024-01-01T00:00:00Z", 0.5)],
        "resource_id string, metric_name string, metric_timestamp string, metric_value double",
    )
    rows = writers.export_flat(clusters, {"cpu": {"unit": "Ratio"}, "mem": {"unit": "Bytes"}}, points)
    assert rows.count() == 4
    path = str(tmp_path / "export")
    writers.write_observations(rows, path)
    back = readers.observations(spark, path)
    assert len(back.columns) == 39
    got = {(r.resource_id, r.metric_name, r.metric_value, r.unit) for r in back.collect()}
    assert got == {("c1", "cpu", "0.5", "Ratio"), ("c1", "mem", None, "Bytes"), ("c2", "cpu", None, "Ratio"), ("c2", "mem", None, "Bytes")}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.observations(spark, str(tmp_path / "missing")).count()


def test_catalog_files(spark, tmp_path):
    family = tmp_path / "family.json"
    family.write_text(json.dumps({"e2": {"family": "e2", "region": "r", "machine_types": [
        {"machine_type": "e2-medium", "family": "e2", "vcpus": 1, "ram_gb": 4, "hourly_price": 0.035158, "ordinal": 1}]}}, indent=2))
    row = readers.family_catalog(spark, str(family)).first()
    assert (row.family, row.machine_type, row.hourly_price) == ("e2", "e2-medium", 0.035158)
    job = tmp_path / "job.json"
    entry = {"machine_type": "n1", "vcpus": 1, "ram_gb": 2, "hourly_price": 0.1, "ordinal": 1}
    job.write_text(json.dumps({"_metadata": {"note": "x"}, "batch": {"machine_types": [entry]}, "streaming": {"machine_types": [entry]}}, indent=2))
    assert [(r.job_type, r.priority) for r in readers.job_catalog(spark, str(job)).collect()] == [("batch", 0), ("streaming", 1)]
    parts = tmp_path / "parts.json"
    parts.write_text(json.dumps({"vpn_tunnel": {"region": "r", "hourly_price": 0.05}, "nat_data_processing": {"price_per_gib": 0.045}}))
    prices = {r.component: r.hourly_price for r in readers.component_catalog(spark, str(parts)).collect()}
    assert prices == {"vpn_tunnel": 0.05, "nat_data_processing": None}


def sku(name, group, nanos, description):
    return {
        "skuId": name, "description": description,
        "category": {"resourceFamily": "Compute", "resourceGroup": group, "usageType": "OnDemand"},
        "serviceRegions": ["us-central1"],
        "pricingInfo": [{"pricingExpression": {"tieredRates": [{"unitPrice": {"units": "0", "nanos": nanos}}]}}],
    }


def test_billing_pages_to_priced_machines(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "1.json").write_text(json.dumps({"skus": [
        sku("1", "CPU", 22890000, "E2 Instance Core"), sku("2", "RAM", 3067000, "E2 Instance Ram"),
        sku("3", "CPU", 99000000, "E2 Custom Instance Core"), sku("4", "CPU", 99000000, "Spot Preemptible E2 Core"),
    ]}, indent=1))
    (pages / "2.json").write_text(json.dumps({"skus": [
        sku("5", "N1Standard", 30000000, "N1 Predefined Instance Core"), sku("6", "N1Standard", 4000000, "N1 Predefined Instance Ram"),
        sku("7", "CPU", 50000000, "E2 Windows Core"),
    ]}, indent=1))
    feed = readers.billing_skus(spark, str(pages))
    assert feed.count() == 7
    prices = catalog.with_default_family(catalog.family_prices_highest(catalog.compute_skus(feed, "us-central1")))
    found = {r.family: (r.cpu_hourly_price, r.ram_hourly_price_per_gb) for r in prices.collect()}
    assert found == {"e2": (0.02289, 0.003067), "n1": (0.03, 0.004), "c2": (0.03398, 0.00455)}
    machines = catalog.with_ordinals(catalog.machine_prices(seeds.compute_machines(spark), prices))
    medium = machines.where("machine_type = 'e2-medium'").first()
    assert medium.hourly_price == 0.035158 and medium.annual_price == round(0.035158 * 8760, 4)
    nested = catalog.nested(machines, chunk_rows=4)
    path = str(tmp_path / "catalog")
    writers.write_catalog(nested, path)
    back = spark.read.json(path)
    assert back.where("family = 'c2'").count() == 2
    again = readers.catalog_lines(spark, path)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, machines.select(*again.columns).collect()))
    assert catalog.summary(machines).first().asDict() == {"machine_families": 3, "machine_types": 17 + 22 + 5}


def test_report_file(spark, tmp_path):
    rows = [("a", "X", "t", 1.0, 0.0, 1.0, False, "{}")]
    report = spark.createDataFrame(
        rows, "resource_id string, rule_code string, recommendation string, current_annual double, target_annual double, annual_savings double, is_fallback boolean, details string"
    )
    writers.write_report(report, str(tmp_path / "report"))
    assert (tmp_path / "report" / "rule_code=X").exists()


# Series ----------------------------------------------------------------------------------------


def test_aggregations_by_name(spark):
    points = spark.createDataFrame(
        [("r", "2024-01-01 00:00:10", 1.0), ("r", "2024-01-01 00:03:00", 5.0), ("r", "2024-01-01 00:02:00", 9.0)],
        "resource_id string, ts string, value double",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    bucketed = points.withColumn("bucket", timeseries.bucket_start(F.col("ts"), "PT5M"))

    def value(name, percentile=None, compat=False):
        return timeseries.reduce_points(bucketed, ["resource_id"], name, percentile, compat).first().value

    assert (value("Average"), value("Maximum"), value("Minimum"), value("Total"), value("Count")) == (5.0, 9.0, 1.0, 15.0, 3.0)
    assert (value("Sum"), value("Gauge"), value("Mean"), value("Other")) == (15.0, 5.0, 5.0, 5.0)
    assert value("Sum", compat=True) == value("Gauge", compat=True) == 5.0
    assert value("Percentile", 50) == 5.0 and value("Percentile", 95) == pytest.approx(8.6)
    assert value("Percentile", 95, compat=True) == value("Percentile", 99) == pytest.approx(8.92)


def test_specs_are_deduplicated(spark):
    spec = timeseries.MetricSpec("m", "Count", "Sum")
    frame = timeseries.spec_frame(spark, [spec, spec, timeseries.MetricSpec("m", "Count", "Percentile", percentile=95)])
    assert timeseries.distinct_specs(frame).count() == 2


def test_points_reduced_by_spec(spark):
    points = spark.createDataFrame(
        [("r", "m", f"2024-01-01 00:0{i}:00", float(i)) for i in range(5)] + [("r", "n", "2024-01-01 00:30:00", 7.0)],
        "resource_id string, metric_name string, ts string, value double",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    spec = timeseries.MetricSpec
    specs = [
        spec("m"), spec("m", aggregation="Sum", interval="PT1H"), spec("m", aggregation="Percentile", percentile=95),
        spec("m", aggregation="Percentile", percentile=50), spec("n", aggregation="Gauge"), spec("n", aggregation="Gauge"),
    ]
    got = sorted((r.metric_name, r.aggregation_type, round(r.value, 6)) for r in timeseries.reduce_by_spec(points, specs, ["resource_id"]).collect())
    assert got == [("m", "Average", 2.0), ("m", "Percentile", 2.0), ("m", "Percentile", 3.8), ("m", "Sum", 10.0), ("n", "Gauge", 7.0)]


def test_observation_file_of_another_writer(spark, tmp_path):
    """JSON lists, quotes, line breaks and reordered or missing columns, as the standard csv module writes them."""
    import csv

    names = [f.name for f in readers.schemas.parsed(readers.schemas.OBSERVATION).fields if f.name != "machine_type"][::-1]
    row = {"cluster_name": "c1", "locations": '["us-a","us-b"]', "metric_name": "cpu", "metric_value": "0.5", "unit": "Ratio",
           "metric_error": 'first line\nsecond "quoted" line, with a comma', "endpoint": 'back\\slash'}
    path = tmp_path / "export.csv"
    with path.open("w", newline="", encoding="utf-8") as file:
        writer = csv.DictWriter(file, names)
        writer.writeheader()
        writer.writerows([row, row | {"cluster_name": "c2"}])
    back = readers.observations(spark, str(path)).collect()
    assert len(back) == 2 and {r.cluster_name for r in back} == {"c1", "c2"}
    for r in back:
        assert all(r[c] == v for c, v in row.items() if c != "cluster_name")
        assert r.machine_type == "e2-medium" and r.status is None

    written = tmp_path / "written"
    writers.write_observations(readers.observations(spark, str(path)), str(written))
    found = []
    for part in written.glob("*.csv"):
        with part.open(newline="", encoding="utf-8") as file:
            found += list(csv.DictReader(file))
    assert sorted(r["cluster_name"] for r in found) == ["c1", "c2"]
    assert all(r["locations"] == row["locations"] and r["metric_error"] == row["metric_error"] for r in found)


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_times_are_utc_in_any_session(spark, zone):
    """Text with a Z, interval starts and months do not follow the session's zone."""
    from datetime import datetime, timezone

    from costgauge.functions.timing import floor_to_interval, iso_text
    from pyspark.sql import functions as F

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        ts = F.timestamp_seconds(F.lit(int(datetime(2024, 2, 1, 0, 34, 56, tzinfo=timezone.utc).timestamp())))
        row = spark.range(1).select(iso_text(ts).alias("t"), iso_text(floor_to_interval(ts, 45)).alias("f")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert (row.t, row.f) == ("2024-02-01T00:34:56Z", "2024-02-01T00:00:00Z")


def test_rows_are_counted_as_they_are_written(spark):
    """One job writes and counts; empty tables count zero."""
    context = spark.sparkContext
    context.setJobGroup("staged", "write and count")
    try:
        rows, n = writers.staged(spark.range(1_000, numPartitions=4).withColumn("x", F.col("id") % 7))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert n == 1_000 == rows.count()
    assert len(context.statusTracker().getJobIdsForGroup("staged")) == 1
    empty, none = writers.staged(rows.limit(0))
    assert none == 0 == empty.count() and empty.schema == rows.schema
    assert writers.staged(spark.createDataFrame([], "a int"))[1] == 0


def test_upsert_reads_no_other_tenant(spark, tmp_path):
    """The files of another tenant are not even opened; a tenant without a name is one of its own."""
    path = tmp_path / "table"
    rows = [("c", "m1", 1, 1, "a"), ("d", "m1", 1, 1, "other"), (None, "m1", 1, 1, "nameless")]
    writers.upsert_path(snapshot(spark, rows), str(path), KEY, ORDER, PARTS)
    others = [*(path / "client_id=d").rglob("*.parquet")]
    assert others
    for file in others:
        file.write_bytes(b"not parquet")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    assert writers.upsert_path(snapshot(spark, [("c", "m2", 1, 2, "b"), ("c", "m2", 2, 2, "n")]), str(path), KEY, ORDER, PARTS) == 2
    assert writers.upsert_path(snapshot(spark, [(None, "m2", 1, 2, "later")]), str(path), KEY, ORDER, PARTS) == 1
    stored = spark.read.schema("client_id string, year_month string, id int, v string").parquet(str(path))
    mine = stored.where("client_id IS NULL OR client_id <> 'd'").collect()
    assert {(r.client_id, r.year_month, r.id, r.v) for r in mine} >= {("c", "m2", 1, "b"), ("c", "m2", 2, "n"), (None, "m2", 1, "later")}
    assert ("c", "m1") not in {(r.client_id, r.year_month) for r in mine}
