"""Recommenders at their boundaries, with hand-computed numbers."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from costgauge.operators.catalog import specs
from costgauge.operators.matching import Catalog
from costgauge.plans import machines, messaging, network, pipeline, storage
from costgauge.plans.contract import as_report
from costgauge.schemas import RECOMMENDATION_COLUMNS
from costgauge.sources import seeds


def one(frame, schema, rows, spark):
    """Results by resource id."""
    return {r.resource_id: r for r in frame(spark.createDataFrame(rows, schema)).collect()}


def money(row):
    return row.current_annual, row.target_annual, row.annual_savings


@pytest.fixture(scope="module")
def compute(spark):
    rows = [
        ("e2", "e2-small", 1.0, 2.0, 0.1, 1),
        ("e2", "e2-medium", 2.0, 4.0, 0.2, 2),
        ("e2", "e2-large", 4.0, 8.0, 0.4, 3),
        ("e2", "e2-huge", 8.0, 16.0, 0.8, 4),
        ("e2", "e2-wide", 8.0, 16.0, 0.8, 4),
        ("n1", "n1-none", 0.0, 4.0, 0.5, 1),
    ]
    entries = specs(
        spark.createDataFrame(rows, "family string, machine_type string, vcpus double, ram_gb double, hourly_price double, ordinal int")
    )
    return Catalog(entries, "family", unique=True)


MACHINE = "resource_id string, machine_type string, current_node_count double, cpu_utilization_avg double, memory_utilization_avg double"


def test_gke_idle(spark, compute):
    rows = [("a", "e2-medium", 3.0, 1.0, 1.0), ("b", "e2-medium", 0.0, 1.0, 1.0), ("gone", "x", 1.0, 1.0, 1.0)]
    got = one(lambda d: machines.idle(d, compute, machines.GKE), MACHINE, rows, spark)
    assert money(got["a"]) == (5256.0, 0.0, 5256.0) and got["a"].details.monthly_savings == 438.0
    assert money(got["b"]) == (1752.0, 0.0, 1752.0)
    assert "gone" not in got
    assert got["a"].recommendation == "Idle GKE node pool — consider deleting or scaling to 0"


def test_gke_overprovisioned(spark, compute):
    rows = [
        ("fits", "e2-huge", 2.0, 20.0, 30.0),  # needs 2.08 vCPUs and 6.24 GB: the large one
        ("half", "e2-huge", 1.0, 0.0, 0.0),  # nothing measured: half of it
        ("full", "e2-huge", 1.0, 95.0, 95.0),  # nothing fits: the closest cheaper ones
        ("smallest", "e2-small", 1.0, 1.0, 1.0),  # nothing cheaper
        ("no_cpu", "n1-none", 1.0, 1.0, 1.0),
    ]
    got = one(lambda d: machines.overprovisioned(d, compute, machines.GKE), MACHINE, rows, spark)
    assert set(got) == {"fits", "half", "full"}
    assert got["fits"].recommendation == "Rightsize from e2-huge to e2-large"
    assert money(got["fits"]) == (14016.0, 7008.0, 7008.0) and not got["fits"].is_fallback
    assert got["half"].recommendation == "Rightsize from e2-huge to e2-large"
    assert got["full"].is_fallback
    assert got["full"].recommendation == "Rightsize from e2-huge to e2-large, e2-medium, e2-small"
    mean = round((3504.0 + 1752.0 + 876.0) / 3, 4)
    assert money(got["full"]) == (7008.0, round(mean, 2), round(7008.0 - round(mean, 2), 2))


def test_dataflow_defaults_and_pool(spark):
    catalog = Catalog(specs(seeds.worker_catalog(spark)).drop("hourly_price"), "job_type", True)
    schema = "resource_id string, job_name string, machine_type string, current_num_vcpus double, cpu_utilization_p95 double, cpu_utilization_avg double, memory_utilization_avg double"
    rows = [
        ("none", "j1", None, 2.0, 10.0, 5.0, 10.0),
        ("n2", "j2", "n2-standard-8", 1.0, 0.0, 20.0, 20.0),
    ]
    got = one(lambda d: machines.overprovisioned(d, catalog, machines.DATAFLOW), schema, rows, spark)
    # The default worker needs 1 vCPU and 1.95 GB; any batch type may answer.
    assert got["none"].recommendation == "Rightsize from n1-standard-4 to n1-standard-1"
    assert money(got["none"]) == (4859.26, 1214.82, 3644.44)
    # The average stands in for a zero percentile: 8 x 0.2 x 1.3 = 2.08 vCPUs and 8.32 GB.
    assert got["n2"].recommendation == "Rightsize from n2-standard-8 to n1-standard-4"
    idle = one(lambda d: machines.idle(d, catalog, machines.DATAFLOW), schema, rows, spark)
    assert money(idle["none"])[0] == round(round(0.277355 * 8760, 4) * 2, 2)
    assert "consider stopping (current: n1-standard-4)" in idle["none"].recommendation


def test_routers(spark):
    prices = seeds.components(spark)
    idle = one(lambda d: network.router_idle(d, prices), "resource_id string, router_name string, vpn_tunnel_count double",
               [("a", "r1", 2.0), ("b", None, 0.0)], spark)
    assert money(idle["a"]) == (876.0, 0.0, 876.0) and idle["a"].details.monthly_savings == 73.0
    assert money(idle["b"])[0] == 438.0 and "(router: unknown)" in idle["b"].recommendation
    schema = "resource_id string, nat_ip_count double, nat_port_usage_p95 double, nat_allocated_ports_avg double"
    rows = [
        ("used", 10.0, 50.0, 100.0),  # 10 x 0.5 x 1.2 = 6
        ("tight", 10.0, 90.0, 100.0),  # 10.8 -> 11 >= 10
        ("unknown", 5.0, 0.0, 100.0),  # 2.5 -> 2, ties to even
        ("single", 1.0, 1.0, 100.0),
    ]
    nat = one(lambda d: network.router_nat(d, prices), schema, rows, spark)
    assert set(nat) == {"used", "unknown"}
    assert nat["used"].recommendation.endswith("from 10.0 to 6")
    assert money(nat["used"]) == (438.0, 262.8, 175.2) and nat["used"].details.monthly_savings == 14.6
    assert nat["unknown"].details.recommended_nat_ip_count == 2
    empty = prices.where("component = 'none'")
    assert network.router_idle(spark.createDataFrame([("a", 1.0)], "resource_id string, vpn_tunnel_count double"), empty).count() == 0


def test_topics(spark):
    schema = (
        "resource_id string, topic_name string, monthly_data_gb double, subscription_count double, active_subscription_count double, "
        "num_undelivered_messages_p95 double, oldest_unacked_message_age_p95_seconds double, byte_cost_p95 double, byte_cost_baseline double"
    )
    rows = [
        ("edge", "t", 10.0, 2.0, 2.0, 10000.0, 300.0, 10.0, 1.0),
        ("all", "t", 35.0, 3.0, 1.0, 10001.0, 301.0, 10.5, 1.0),
        ("nobase", "t", 35.0, None, None, 0.0, 0.0, 99.0, 0.0),
    ]
    idle = one(messaging.pubsub_idle, schema, rows, spark)
    assert money(idle["edge"])[0] == 0.0 and money(idle["all"])[0] == 36.0 and money(idle["nobase"])[0] == 12.0
    over = one(messaging.pubsub_overprovisioned, schema, rows, spark)
    assert over["edge"].details.signals_fired == ["multiple subscriptions on topic — review for unused delivery copies"]
    assert over["edge"].recommendation.endswith("review subscription configuration")
    assert len(over["all"].details.signals_fired) == 4 and money(over["all"]) == (36.0, 12.0, 24.0)
    assert "P95=10,001 > 10,000" in over["all"].details.signals_fired[0]
    assert "remove 2.0 unused subscription(s)" in over["all"].recommendation
    assert over["all"].details.target_skus[0].label == "1 active subscription(s)"
    assert not over["nobase"].details.high_byte_cost


def test_scheduled_jobs(spark):
    schema = "resource_id string, job_name string, job_ordinal int, total_jobs_in_account int, job_state string, error_rate_pct double, attempt_dispatch_count double, attempt_count double"
    rows = [
        ("third", "j", 3, 5, "ENABLED", 100.0, 3.0, 1.0),
        ("fourth", "j", 4, 5, "paused", 0.0, 31.0, 10.0),
        ("single", "j", None, 1, None, 99.9, 0.0, 0.0),
    ]
    idle = one(messaging.scheduler_idle, schema, rows, spark)
    assert [money(idle[k])[0] for k in ("third", "fourth", "single")] == [0.0, 1.2, 0.0]
    assert "100% error rate" in idle["third"].recommendation and "paused job" in idle["fourth"].recommendation
    assert "no successful executions" in idle["single"].recommendation
    over = one(messaging.scheduler_overprovisioned, schema, rows, spark)
    assert money(over["third"]) == (2.4, 0.0, 2.4) and "consolidate 2.0 job(s)" in over["third"].recommendation
    assert "ratio is 3.1x" in over["fourth"].recommendation
    assert "reduce execution frequency" in over["single"].recommendation
    assert over["single"].details.target_skus[0].label == "1 jobs (free tier)"
    assert over["third"].details.target_skus[0].label == "3 jobs (free tier)"


def test_buckets(spark):
    schema = "resource_id string, bucket_name string, storage_gb double, storage_class string, reads_per_month double, storage_growth_pct_per_week double, read_ops_30d double"
    rows = [
        ("empty", "b", 0.0, "standard", 0.0, 0.0, 0.0),
        ("plain", "b", 1000.0, None, 0.5, 10.0, 0.0),
        ("grows", "b", 1000.0, "NEARLINE", 5.0, 10.1, 0.0),
        ("cold", "b", 1000.0, "ARCHIVE", 0.0, 50.0, 0.0),
        ("fees", "b", 0.1, "COLDLINE", 0.05, 0.0, 1.0),
    ]
    idle = one(storage.storage_idle, schema, rows, spark)
    assert idle["empty"].details.target_class == "DELETE" and money(idle["empty"]) == (0.0, 0.0, 0.0)
    assert money(idle["plain"]) == (240.0, 120.0, 120.0)
    assert idle["cold"].details.target_class == "ARCHIVE" and idle["cold"].annual_savings == 0.0
    over = one(storage.storage_overprovisioned, schema, rows, spark)
    assert set(over) == {"plain", "grows"}
    assert money(over["plain"]) == (240.0, round(round(10.0 + 0.005, 4) * 12, 2), 119.94)
    assert over["grows"].details.signal == "storage_growth_no_reads"
    assert over["grows"].recommendation.endswith("(storage growing 10.1%/wk with zero reads)")
    assert over["plain"].recommendation.endswith("(access < 0.50 reads/mo)")


def test_origins(spark):
    schema = (
        "resource_id string, origin_name string, region string, egress_gb_monthly double, cache_hit_ratio double, "
        "request_count_monthly double, miss_ratio_pct double, backend_latency_p95_ms double, cache_mode string"
    )
    rows = [
        ("fine", "o", "us", 100.0, 80.0, 5.0, 20.0, 500.0, None),
        ("poor", "o", "asia-east1", 100.0, 29.9, 5.0, 20.1, 500.1, None),
        ("edge", "o", "us", 100.0, 30.0, 5.0, 0.0, 0.0, "FORCE_DYNAMIC"),
        ("slow", "o", "us", 100.0, 90.0, 0.0, 0.0, 501.0, None),
    ]
    over = one(network.cdn_overprovisioned, schema, rows, spark)
    assert set(over) == {"poor", "edge", "slow"}
    assert len(over["poor"].details.signals_fired) == 3
    assert over["poor"].details.origin_traffic_reduction_gb == 50.1
    assert money(over["poor"]) == (168.0, 83.83, 84.17)
    assert over["edge"].details.signals_fired == ["cache_hit_ratio=30% below target 60%"]
    assert money(over["slow"]) == (96.0, 96.0, 0.0)
    idle = one(network.cdn_idle, schema, rows, spark)
    assert idle["fine"].details.triggered_signals == ["no meaningful CDN traffic over 14-30 days"]
    assert idle["slow"].details.triggered_signals == ["zero requests (14-30 days)"]


def test_zones(spark):
    schema = "resource_id string, zone_name string, zone_type string, zone_ordinal double, query_count_millions double, record_set_count double, days_since_last_update double, forwarding_targets_reachable double"
    rows = [
        ("free", "z", "PUBLIC", 25.0, 0.0, 4.0, 200.0, None),
        ("paid", "z", "private", 26.0, 0.0, 5.0, 91.0, None),
        ("busy", "z", None, 1.0, 1500.0, 9.0, 0.0, None),
        ("quiet", "z", "PRIVATE", 30.0, 20.0, 9.0, 0.0, None),
        ("orphan", "z", "FORWARDING", 30.0, 0.0, 9.0, 90.0, 0.0),
        ("ten", "z", "PUBLIC", 30.0, 10.0, 9.0, 0.0, None),
    ]
    idle = one(network.dns_idle, schema, rows, spark)
    assert money(idle["free"])[0] == 0.0 and "< 5 records (4) and zero queries" in idle["free"].recommendation
    assert money(idle["paid"])[0] == 2.4 and "no zone updates in 91 days" in idle["paid"].recommendation
    assert money(idle["busy"])[0] == 6000.0 and "near-zero query volume" in idle["orphan"].recommendation
    over = one(network.dns_overprovisioned, schema, rows, spark)
    assert set(over) == {"busy", "quiet", "orphan"}
    assert money(over["busy"]) == (6002.4, 4922.4, 1080.0)
    assert "(1500.0M queries/mo -> ~1050.0M)" in over["busy"].recommendation
    assert money(over["quiet"]) == (2.4, 69.6, -67.2)
    assert money(over["orphan"]) == (2.4, 0.0, 2.4) and "targets unreachable" in over["orphan"].recommendation


def test_templates_win_over_built_in_texts(spark):
    schema = "resource_id string, topic_name string, monthly_data_gb double, template string"
    rows = [("a", "t", 1.0, "Drop {current_sku} for {target_sku}"), ("b", "t", 1.0, ""), ("c", "t", 1.0, None)]
    got = one(messaging.pubsub_idle, schema, rows, spark)
    assert got["a"].recommendation == "Drop t for N/A"
    assert got["b"].recommendation == got["c"].recommendation == "Idle Pub/Sub topic — delete topic and all subscriptions (current: t)"


def test_dispatch_report_and_summary(spark):
    topics = spark.createDataFrame(
        [("a", "t", 35.0, 3.0, 1.0), ("b", "t", 35.0, 1.0, 1.0)],
        "resource_id string, topic_name string, monthly_data_gb double, subscription_count double, active_subscription_count double",
    )
    report = pipeline.recommend({"PUBSUB_IDLE": topics, "PUBSUB_OVERPROVISIONED": topics, "UNKNOWN": topics}, pipeline.Prices())
    assert tuple(report.columns) == RECOMMENDATION_COLUMNS
    details = json.loads(report.where("rule_code = 'PUBSUB_IDLE' AND resource_id = 'a'").first().details)
    assert details["monthly_savings"] == 3.0 and details["is_fallback"] is False
    totals = {r.rule_code: (r.recommendations, r.total_annual_savings, r.savings_once) for r in pipeline.summary(report).collect()}
    assert totals == {"PUBSUB_IDLE": (2, 48.0, 48.0), "PUBSUB_OVERPROVISIONED": (2, 24.0, 0.0), None: (4, 72.0, 48.0)}
    with pytest.raises(ValueError):
        pipeline.recommend({"UNKNOWN": topics}, pipeline.Prices())
    marked = topics.withColumn("rule_code", F.lit("PUBSUB_IDLE"))
    assert pipeline.recommend_fired(marked, ["PUBSUB_IDLE"], pipeline.Prices()).count() == 2


def test_registering_a_recommender(spark):
    pipeline.register("extra_idle", lambda rows, prices: messaging.pubsub_idle(rows))
    try:
        rows = spark.createDataFrame([("a", "t", 35.0)], "resource_id string, topic_name string, monthly_data_gb double")
        assert pipeline.recommend({"EXTRA_IDLE": rows}, pipeline.Prices()).count() == 1
    finally:
        del pipeline.RECOMMENDERS["EXTRA_IDLE"]


def test_metric_side_gives_way_when_zero(spark):
    schema = "resource_id string, origin_name string, region string, metric_egress_gb_monthly double, egress_gb_monthly double"
    got = one(lambda d: as_report(network.cdn_idle(d)), schema, [("a", "o", "us", 0.0, 10.0), ("b", "o", "us", 5.0, 10.0)], spark)
    assert (got["a"].current_annual, got["b"].current_annual) == (9.6, 4.8)
