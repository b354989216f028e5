"""Queries of the other services: workers, routers, topics, jobs, buckets, origins, zones, and the portfolio."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costgauge.functions.numeric import half_even, stable
from costgauge.operators import features
from costgauge.operators.rules import savings_by_formula
from costgauge.operators.scale import materialised, percentiles
from costgauge.plans import machines as plan
from costgauge.plans import messaging, network, pipeline, storage
from costgauge.sources import seeds
from costgauge.workload import compute
from costgauge.workload import models as m
from costgauge.workload.compute import MACHINE_DETAILS, RECO_COLUMNS, with_details
from costgauge.workload.registry import SQL, query, r, rs

ZERO = "CAST(0 AS DOUBLE)"
# When the rules of these services fire.
JOB_IDLE = "cpu_utilization_p95 = 0"
JOB_OVER = "cpu_utilization_p95 < 25"
ORIGIN_IDLE = "request_count_monthly = 0 OR sent_bytes_gb = 0 OR cache_hit_ratio = 0"

# Data pipeline jobs: one per ordering customer -------------------------------------------------


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = m.table(spark, sf_dir, "orders")
    key = F.col("o_custkey")
    spent = orders.groupBy("o_custkey").agg(F.avg("o_totalprice").alias("mean_price"))
    batch = seeds.worker_catalog(spark).where("job_type = 'batch'").select("ordinal", "machine_type")
    placed = spent.withColumn("ordinal", (key % len(seeds.BATCH_WORKERS) + 1).cast("int"))
    named = placed.join(F.broadcast(batch), "ordinal")
    return named.select(
        key.cast("string").alias("resource_id"),
        F.concat(F.lit("job-"), key).alias("job_name"),
        F.when(key % 37 == 0, F.lit("")).otherwise(F.col("machine_type")).alias("machine_type"),
        (key % 7).cast("double").alias("current_num_vcpus"),
        stable(F.col("mean_price") / 5000 * ((key % 5) / 4.0), 4).alias("cpu_utilization_p95"),
        m.pick(key % 3, {0: 0.0, 1: 40.0, 2: 90.0}, 0.0).alias("memory_utilization_avg"),
    )


def _values(rows: tuple) -> str:
    return ", ".join(
        f"('{name}', CAST({v} AS DOUBLE), CAST({ram} AS DOUBLE), CAST({price} AS DOUBLE), {place})"
        for place, (name, v, ram, price) in enumerate(rows, start=1)
    )


JOBS = f"""batch AS (
  SELECT * FROM (VALUES {_values(seeds.BATCH_WORKERS)}) t(machine_type, vcpus, ram_gb, hourly_price, ordinal)),
worker AS (
  SELECT *, {r('hourly_price * 730', 4)} AS monthly_cost, {r('hourly_price * 8760', 4)} AS annual_cost FROM batch),
jobs AS (
  SELECT CAST(o_custkey AS VARCHAR) AS resource_id, 'job-' || o_custkey AS job_name,
         CASE WHEN o_custkey % 37 = 0 THEN 'n1-standard-4' ELSE machine_type END AS machine_type,
         CASE WHEN o_custkey % 7 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(o_custkey % 7 AS DOUBLE) END AS n,
         {rs('mean_price / 5000 * ((o_custkey % 5) / CAST(4 AS DOUBLE))', 4)} AS cpu,
         CASE o_custkey % 3 WHEN 0 THEN CAST(0 AS DOUBLE) WHEN 1 THEN CAST(40 AS DOUBLE) ELSE CAST(90 AS DOUBLE) END AS mem
  FROM (SELECT o_custkey, avg(o_totalprice) AS mean_price FROM orders GROUP BY o_custkey) o
  JOIN batch ON ordinal = o_custkey % {len(seeds.BATCH_WORKERS)} + 1)"""


def dataflow_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    idle = jobs(spark, sf_dir).where(JOB_IDLE)
    return plan.idle(idle, m.worker_catalog(spark), plan.DATAFLOW)


@query(
    "reco_dataflow_idle",
    m.lines(
        JOBS,
        f"""priced AS (SELECT j.*, {r('annual_cost * n', 2)} AS annual, {r('monthly_cost * n', 2)} AS monthly
  FROM jobs j JOIN worker w ON j.machine_type = w.machine_type WHERE cpu = 0)""",
    )
    + f"""SELECT resource_id, 'DATAFLOW_IDLE' AS rule_code,
  'Idle Dataflow job — workers running with no data flowing, consider stopping (current: ' || machine_type || ')'
    AS recommendation,
  annual AS current_annual, {ZERO} AS target_annual, annual AS annual_savings, false AS is_fallback,
  monthly AS monthly_savings, job_name, n AS worker_count FROM priced""",
)
def reco_dataflow_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_details(
        dataflow_idle(spark, sf_dir),
        {"monthly_savings": "monthly_savings", "job_name": "job_name", "worker_count": "worker_count"},
    )


def _mean3(field: str, digits: int) -> str:
    parts = " + ".join(f"sum(CASE WHEN rn = {i} THEN {field} ELSE 0 END)" for i in (1, 2, 3))
    return r(f"({parts}) / count(*)", digits)


_DATAFLOW_OVER = m.lines(JOBS) + f"""
, needed AS (
  SELECT j.resource_id, j.machine_type, j.n, w.vcpus, w.ram_gb, w.ordinal, w.annual_cost, w.monthly_cost,
         CASE WHEN cpu > 0 THEN greatest(CAST(1 AS DOUBLE), w.vcpus * (cpu / 100) * 1.3) ELSE w.vcpus * 0.5 END AS need_vcpus,
         CASE WHEN mem > 0 THEN greatest(CAST(1 AS DOUBLE), w.ram_gb * (mem / 100) * 1.3) ELSE w.ram_gb * 0.5 END AS need_ram
  FROM jobs j JOIN worker w ON j.machine_type = w.machine_type WHERE cpu < 25),
direct AS (
  SELECT * FROM (
    SELECT d.*, c.machine_type AS target_type, c.hourly_price AS t_hourly, c.monthly_cost AS t_monthly,
           c.annual_cost AS t_annual, false AS is_fallback,
           row_number() OVER (PARTITION BY d.resource_id ORDER BY c.vcpus, c.ram_gb, c.ordinal, c.machine_type) AS rn
    FROM needed d JOIN worker c ON c.machine_type <> d.machine_type AND c.ordinal < d.ordinal
      AND c.vcpus >= d.need_vcpus AND c.ram_gb >= d.need_ram)
  WHERE rn = 1),
fallback AS (
  SELECT * FROM (
    SELECT d.*, c.machine_type AS target_type, c.hourly_price AS t_hourly, c.monthly_cost AS t_monthly,
           c.annual_cost AS t_annual, true AS is_fallback,
           row_number() OVER (PARTITION BY d.resource_id ORDER BY c.ordinal DESC, c.machine_type) AS rn
    FROM needed d JOIN worker c ON c.machine_type <> d.machine_type AND c.ordinal < d.ordinal
    WHERE d.resource_id NOT IN (SELECT resource_id FROM direct))
  WHERE rn <= 3),
means AS (
  SELECT resource_id, any_value(machine_type) AS machine_type, any_value(n) AS n, any_value(annual_cost) AS annual_cost,
         any_value(monthly_cost) AS monthly_cost, string_agg(target_type, ', ' ORDER BY rn) AS names,
         {_mean3('t_hourly', 6)} AS avg_hourly, {_mean3('t_monthly', 4)} AS avg_monthly,
         {_mean3('t_annual', 4)} AS avg_annual, is_fallback
  FROM (SELECT * FROM direct UNION ALL SELECT * FROM fallback) GROUP BY resource_id, is_fallback),
priced AS (
  SELECT *, {r('annual_cost * n', 2)} AS current_annual, {r('avg_annual * n', 2)} AS target_annual,
         {r('(monthly_cost - avg_monthly) * n', 2)} AS monthly_savings FROM means)
SELECT resource_id, 'DATAFLOW_OVERPROVISIONED' AS rule_code,
       'Rightsize from ' || machine_type || ' to ' || names AS recommendation, current_annual, target_annual,
       {r('current_annual - target_annual', 2)} AS annual_savings, is_fallback, avg_hourly, avg_monthly, avg_annual,
       monthly_savings, split_part(machine_type, '-', 1) AS family
FROM priced"""


def dataflow_overprovisioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    busy = jobs(spark, sf_dir).where(JOB_OVER)
    return plan.overprovisioned(busy, m.worker_catalog(spark), plan.DATAFLOW)


@query("reco_dataflow_overprovisioned", _DATAFLOW_OVER + " WHERE NOT is_fallback")
def reco_dataflow_overprovisioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_details(dataflow_overprovisioned(spark, sf_dir).where(~F.col("is_fallback")), MACHINE_DETAILS)


@query("reco_dataflow_fallback", _DATAFLOW_OVER + " WHERE is_fallback")
def reco_dataflow_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_details(dataflow_overprovisioned(spark, sf_dir).where("is_fallback"), MACHINE_DETAILS)


# Routers: one per supplier ---------------------------------------------------------------------


def routers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("resource_id"),
        F.col("s_name").alias("router_name"),
        (F.col("s_suppkey") % 4).alias("vpn_tunnel_count"),
    )


def router_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.router_idle(routers(spark, sf_dir), seeds.components(spark))


@query(
    "reco_router_idle",
    f"""WITH routers AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS resource_id, s_name,
         CASE WHEN s_suppkey % 4 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(s_suppkey % 4 AS DOUBLE) END AS tunnels
  FROM supplier),
priced AS (SELECT *, {r('CAST(0.05 AS DOUBLE) * 8760 * tunnels', 2)} AS annual,
                  {r('CAST(0.05 AS DOUBLE) * 730 * tunnels', 2)} AS monthly FROM routers)
SELECT resource_id, 'CLOUDROUTER_IDLE' AS rule_code,
  'Idle Cloud Router — no active BGP sessions or NAT usage, consider deleting (router: ' || s_name || ')' AS recommendation,
  annual AS current_annual, {ZERO} AS target_annual, annual AS annual_savings, false AS is_fallback,
  monthly AS monthly_savings, tunnels AS tunnel_count FROM priced""",
)
def reco_router_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_details(
        router_idle(spark, sf_dir), {"monthly_savings": "monthly_savings", "tunnel_count": "tunnel_count"}
    )


def nat_routers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = m.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("resource_id"),
        (F.col("l_quantity") * F.col("l_discount") * 10).alias("ports"),
        "l_quantity",
    )
    allocated = {"nat_allocated_ports_avg": F.max("l_quantity")}
    used = percentiles(lineitem, ["resource_id"], {"p95": ("ports", 0.95)}, also=allocated)
    key = F.col("resource_id")
    return used.select(
        "resource_id",
        F.concat(F.lit("router-"), key).alias("router_name"),
        (key % 16 + 1).alias("nat_ip_count"),
        F.when(key % 7 == 0, 0.0).otherwise(stable(F.col("p95"), 6)).alias("nat_port_usage_p95"),
        "nat_allocated_ports_avg",
    )


def router_nat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.router_nat(nat_routers(spark, sf_dir), seeds.components(spark))


@query(
    "reco_router_nat",
    f"""WITH routers AS (
  SELECT l_suppkey, CAST(l_suppkey % 16 + 1 AS DOUBLE) AS ips, max(l_quantity) AS allocated,
         CASE WHEN l_suppkey % 7 = 0 THEN CAST(0 AS DOUBLE)
              ELSE {rs('quantile_cont(l_quantity * l_discount * 10, 0.95)', 6)} END AS used
  FROM lineitem GROUP BY l_suppkey),
needed AS (
  SELECT *, greatest(1, {r('CASE WHEN allocated > 0 AND used > 0 THEN ips * (used / allocated) * 1.2 ELSE ips * 0.5 END', 0)})
    AS need FROM routers),
priced AS (
  SELECT *, {r('CAST(0.005 AS DOUBLE) * 8760 * ips', 2)} AS cur, {r('CAST(0.005 AS DOUBLE) * 8760 * need', 2)} AS tgt
  FROM needed WHERE need < ips)
SELECT CAST(l_suppkey AS VARCHAR) AS resource_id, 'CLOUDROUTER_NAT_OVERPROVISIONED' AS rule_code,
  'Overprovisioned Cloud NAT — reduce NAT IPs from ' || CAST(ips AS VARCHAR) || ' to ' || CAST(CAST(need AS BIGINT) AS VARCHAR)
    AS recommendation,
  cur AS current_annual, tgt AS target_annual, {r('cur - tgt', 2)} AS annual_savings, false AS is_fallback,
  {r('(cur - tgt) / 12', 2)} AS monthly_savings, CAST(need AS BIGINT) AS recommended_nat_ip_count, used AS port_usage_p95
FROM priced""",
)
def reco_router_nat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_details(
        router_nat(spark, sf_dir),
        {
            "monthly_savings": "monthly_savings",
            "recommended_nat_ip_count": "recommended_nat_ip_count",
            "port_usage_p95": "port_usage_p95",
        },
    )


# Message topics: one per ordered part ----------------------------------------------------------


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = m.table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("resource_id"),
        "l_quantity",
        (F.col("l_extendedprice") / 6).alias("backlog"),
        (F.col("l_quantity") * F.col("l_tax") * 100).alias("age"),
        (F.col("l_quantity") * F.col("l_discount")).alias("byte_cost"),
    )
    levels = {
        "num_undelivered_messages_p95": ("backlog", 0.95),
        "oldest_unacked_message_age_p95_seconds": ("age", 0.95),
        "byte_cost_p95": ("byte_cost", 0.95),
        "byte_cost_baseline": ("byte_cost", 0.25),
    }
    volumes = {"_quantity": F.sum("l_quantity"), "subscription_count": F.count(F.lit(1))}
    found = percentiles(samples, ["resource_id"], levels, also=volumes)
    key = F.col("resource_id")
    return found.select(
        key,
        "subscription_count",
        *[stable(F.col(c), 4).alias(c) for c in levels],
        F.concat(F.lit("topic-"), key).alias("topic_name"),
        stable(F.col("_quantity") / 75, 4).alias("monthly_data_gb"),
        F.greatest(F.lit(1), F.col("subscription_count") - key % 3).alias("active_subscription_count"),
    )


TOPICS = f"""topics AS (
  SELECT l_partkey, {rs('sum(l_quantity) / 75', 4)} AS gb, CAST(count(*) AS DOUBLE) AS subs,
         CAST(greatest(1, count(*) - l_partkey % 3) AS DOUBLE) AS active,
         {rs('quantile_cont(l_extendedprice / 6, 0.95)', 4)} AS backlog,
         {rs('quantile_cont(l_quantity * l_tax * 100, 0.95)', 4)} AS age,
         {rs('quantile_cont(l_quantity * l_discount, 0.95)', 4)} AS cost_p95,
         {rs('quantile_cont(l_quantity * l_discount, 0.25)', 4)} AS cost_base
  FROM lineitem GROUP BY l_partkey)"""


def pubsub_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = m.table(spark, sf_dir, "lineitem")
    volumes = lineitem.groupBy(F.col("l_partkey").alias("resource_id")).agg(
        F.sum("l_quantity").alias("_quantity"), F.count(F.lit(1)).alias("subscription_count")
    )
    rows = volumes.select(
        "resource_id",
        F.concat(F.lit("topic-"), F.col("resource_id")).alias("topic_name"),
        "subscription_count",
        stable(F.col("_quantity") / 75, 4).alias("monthly_data_gb"),
    )
    return messaging.pubsub_idle(rows)


@query(
    "reco_pubsub_idle",
    f"""WITH topics AS (
  SELECT l_partkey, {rs('sum(l_quantity) / 75', 4)} AS gb, CAST(count(*) AS DOUBLE) AS subs FROM lineitem GROUP BY l_partkey),
monthly AS (SELECT *, {r('(greatest(CAST(0 AS DOUBLE), gb - 10) * subs) * 0.04', 4)} AS cost FROM topics),
annual AS (SELECT *, {r('cost * 12', 2)} AS yearly FROM monthly)
SELECT CAST(l_partkey AS VARCHAR) AS resource_id, 'PUBSUB_IDLE' AS rule_code,
  'Idle Pub/Sub topic — delete topic and all subscriptions (current: topic-' || l_partkey || ')' AS recommendation,
  yearly AS current_annual, {ZERO} AS target_annual, yearly AS annual_savings, false AS is_fallback,
  cost AS monthly_savings FROM annual""",
)
def reco_pubsub_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_details(pubsub_idle(spark, sf_dir), {"monthly_savings": "monthly_savings"})


def pubsub_overprovisioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messaging.pubsub_overprovisioned(topics(spark, sf_dir))


@query(
    "reco_pubsub_overprovisioned",
    m.lines(
        TOPICS,
        f"""flags AS (
  SELECT *, cost_base > 0 AND cost_p95 > cost_base * 10 AS heavy, greatest(CAST(0 AS DOUBLE), subs - active) AS unused,
         greatest(CAST(0 AS DOUBLE), gb - 10) AS paid FROM topics)""",
        f"""monthly AS (
  SELECT *, {r('paid * subs * 0.04', 4)} AS cur_m, {r('paid * active * 0.04', 4)} AS tgt_m,
    nullif(concat_ws('; ',
      CASE WHEN backlog > 10000 THEN 'large unacked backlog (num_undelivered_messages P95='
        || format('{{:,}}', CAST({r('backlog', 0)} AS BIGINT)) || ' > 10,000)' END,
      CASE WHEN age > 300 THEN 'consumer not keeping up (oldest_unacked_message_age P95='
        || format('{{:.0f}}', age) || 's > 300s)' END,
      CASE WHEN heavy THEN 'large message payloads (byte_cost P95=' || format('{{:.2f}}', cost_p95)
        || ' > 10× baseline=' || format('{{:.2f}}', cost_base) || ')' END,
      CASE WHEN unused > 0 THEN CAST(unused AS VARCHAR) || ' unused subscription(s) accumulating delivery charges' END), '')
      AS signals,
    nullif(concat_ws('; ',
      CASE WHEN backlog > 10000 OR age > 300 THEN 'scale up consumer (increase Cloud Run min_instances or replicas)' END,
      CASE WHEN heavy THEN 'reduce payload size — store large data in GCS, send URI in message instead' END,
      CASE WHEN unused > 0 THEN 'remove ' || CAST(unused AS VARCHAR)
        || ' unused subscription(s) to eliminate duplicate delivery charges' END), '') AS action
  FROM flags)""",
        f"""annual AS (SELECT *, {r('cur_m * 12', 2)} AS cur, {r('tgt_m * 12', 2)} AS tgt FROM monthly)""",
    )
    + f"""SELECT CAST(l_partkey AS VARCHAR) AS resource_id, 'PUBSUB_OVERPROVISIONED' AS rule_code,
  'Overprovisioned Pub/Sub topic-' || l_partkey || ' — ' || coalesce(action, 'review subscription configuration')
    AS recommendation,
  cur AS current_annual, tgt AS target_annual, {r('cur - tgt', 2)} AS annual_savings, false AS is_fallback,
  {r('cur_m - tgt_m', 4)} AS monthly_savings,
  coalesce(signals, 'multiple subscriptions on topic — review for unused delivery copies') AS signals_fired
FROM annual""",
)
def reco_pubsub_overprovisioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_details(
        pubsub_overprovisioned(spark, sf_dir),
        {"monthly_savings": "monthly_savings", "signals_fired": "signals_fired"},
    )
    return found.withColumn("signals_fired", F.array_join("signals_fired", "; "))


# Scheduled jobs: customers, accounts are nations -------------------------------------------------


def scheduled(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = m.table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    rows = features.account_positions(
        customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_name"),
        ["c_nationkey"],
        ["c_custkey"],
        "job_ordinal",
        "total_jobs_in_account",
    )
    return rows.select(
        key.alias("resource_id"),
        F.col("c_name").alias("job_name"),
        "job_ordinal",
        "total_jobs_in_account",
        F.when(key % 3 == 1, "PAUSED").otherwise("ENABLED").alias("job_state"),
        F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.col("c_acctbal") / 50)).alias("error_rate_pct"),
        (key % 9).alias("attempt_dispatch_count"),
        (key % 4).alias("attempt_count"),
    )


SCHEDULED = """scheduled AS (
  SELECT CAST(c_custkey AS VARCHAR) AS resource_id, c_name AS job_name,
         CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS DOUBLE) AS ordinal,
         CAST(count(*) OVER (PARTITION BY c_nationkey) AS DOUBLE) AS total,
         c_custkey % 3 = 1 AS paused, greatest(0.0, least(100.0, c_acctbal / 50)) AS errors,
         CAST(c_custkey % 9 AS DOUBLE) AS dispatched,
         CASE WHEN c_custkey % 4 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(c_custkey % 4 AS DOUBLE) END AS attempts
  FROM customer)"""


def scheduler_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messaging.scheduler_idle(scheduled(spark, sf_dir))


@query(
    "reco_scheduler_idle",
    m.lines(
        SCHEDULED,
        """told AS (SELECT *, CASE WHEN ordinal > 3 THEN CAST(0.10 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS monthly,
  CASE WHEN paused THEN 'paused job (still incurs monthly billing)'
       WHEN errors >= 100 THEN 'job targeting deleted/unreachable resource (100% error rate)'
       ELSE 'no successful executions in 14-30 days' END AS reason FROM scheduled)""",
    )
    + f"""SELECT resource_id, 'CLOUDSCHEDULER_IDLE' AS rule_code,
  'Idle Cloud Scheduler job — delete ' || job_name || ' (' || reason || ')' AS recommendation,
  {r('monthly * 12', 2)} AS current_annual, {ZERO} AS target_annual, {r('monthly * 12', 2)} AS annual_savings,
  false AS is_fallback, monthly AS monthly_savings, ordinal > 3 AS is_billable, paused AS is_paused FROM told""",
)
def reco_scheduler_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_details(
        scheduler_idle(spark, sf_dir),
        {"monthly_savings": "monthly_savings", "is_billable": "is_billable", "is_paused": "is_paused"},
    )


def scheduler_overprovisioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messaging.scheduler_overprovisioned(scheduled(spark, sf_dir))


@query(
    "reco_scheduler_overprovisioned",
    m.lines(
        SCHEDULED,
        f"""told AS (SELECT *, greatest(0.0, total - 3) AS billable, least(total, 3.0) AS keep, dispatched / attempts AS ratio,
  {r('greatest(0.0, total - 3) * 0.10', 4)} AS monthly FROM scheduled)""",
    )
    + f"""SELECT resource_id, 'CLOUDSCHEDULER_OVERPROVISIONED' AS rule_code,
  'Overprovisioned Cloud Scheduler — ' ||
  CASE WHEN ratio > 3 THEN 'tune retry settings — dispatch/attempt ratio is ' || format('{{:.1f}}', ratio)
         || 'x (dispatch_count >> attempt_count)'
       WHEN total - keep > 0 THEN 'consolidate ' || CAST(total - keep AS VARCHAR)
         || ' job(s) to stay within free tier (3 jobs)'
       ELSE 'reduce execution frequency to lower downstream compute costs' END
  || ' (current: ' || job_name || ')' AS recommendation,
  {r('monthly * 12', 2)} AS current_annual, {ZERO} AS target_annual, {r('monthly * 12', 2)} AS annual_savings,
  false AS is_fallback, monthly AS monthly_savings, billable AS billable_jobs, {r('ratio', 2)} AS retry_ratio FROM told""",
)
def reco_scheduler_overprovisioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_details(
        scheduler_overprovisioned(spark, sf_dir),
        {"monthly_savings": "monthly_savings", "billable_jobs": "billable_jobs", "retry_ratio": "retry_ratio"},
    )


# Buckets: one per supplier ---------------------------------------------------------------------

CLASSES = {0: "STANDARD", 1: "NEARLINE", 2: "COLDLINE", 3: "archive"}


def buckets(spark: SparkSession, sf_dir: str, growth: bool = True) -> DataFrame:
    lineitem = m.table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", "l_shipdate")
    key = F.col("l_suppkey")
    sized = lineitem.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("stored"))
    if growth:
        grown = features.weekly_growth(lineitem, "l_suppkey", "l_shipdate", "l_quantity")
        sized = sized.join(grown, "l_suppkey").withColumnRenamed("growth_pct_per_week", "storage_growth_pct_per_week")
    return sized.select(
        "*",
        key.alias("resource_id"),
        F.concat(F.lit("bucket-"), key).alias("bucket_name"),
        F.when(key % 10 == 9, 0.0).otherwise(F.col("stored")).alias("storage_gb"),
        m.pick(key % 5, CLASSES, "").alias("storage_class"),
        ((key % 8) / 6.0).alias("reads_per_month"),
        (key % 2).alias("read_ops_30d"),
    ).drop("stored")


WEEKLY = f"""weekly AS (
  SELECT l_suppkey, date_trunc('week', l_shipdate) AS week, sum(l_quantity) AS amount FROM lineitem GROUP BY 1, 2),
numbered AS (
  SELECT *, lag(amount) OVER w AS previous, lag(week) OVER w AS previous_week,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY week DESC) AS back
  FROM weekly WINDOW w AS (PARTITION BY l_suppkey ORDER BY week)),
growth AS (
  SELECT l_suppkey, week, CASE WHEN previous_week = week - INTERVAL 7 DAY AND previous <> 0
    THEN {rs('(amount - previous) * 100 / previous', 4)} END AS growth FROM numbered WHERE back = 1)"""
BUCKETS = f"""sized AS (
  SELECT l_suppkey, CASE WHEN l_suppkey % 10 = 9 THEN CAST(0 AS DOUBLE) ELSE sum(l_quantity) END AS gb,
         CASE l_suppkey % 5 WHEN 1 THEN 'NEARLINE' WHEN 2 THEN 'COLDLINE' WHEN 3 THEN 'ARCHIVE' ELSE 'STANDARD' END AS class,
         (l_suppkey % 8) / CAST(6 AS DOUBLE) AS reads, l_suppkey % 2 AS reads_30d
  FROM lineitem GROUP BY l_suppkey),
price(class, gb_price, read_price, rank) AS (VALUES ('STANDARD', CAST(0.020 AS DOUBLE), CAST(0 AS DOUBLE), 0),
  ('NEARLINE', 0.010, 0.01, 1), ('COLDLINE', 0.004, 0.02, 2), ('ARCHIVE', 0.0012, 0.05, 3)),
buckets AS (
  SELECT sized.*, rank, {r('gb * gb_price', 4)} AS cur_m FROM sized JOIN price ON sized.class = price.class)"""


def storage_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return storage.storage_idle(buckets(spark, sf_dir, growth=False))


@query(
    "reco_storage_idle",
    m.lines(
        BUCKETS,
        """moved AS (SELECT *, CASE class WHEN 'STANDARD' THEN 'NEARLINE' WHEN 'NEARLINE' THEN 'COLDLINE'
  ELSE 'ARCHIVE' END AS colder FROM buckets)""",
        f"""monthly AS (SELECT moved.*, {r('gb * gb_price', 4)} AS tgt_m FROM moved JOIN price ON price.class = colder)""",
        f"""annual AS (SELECT *, {r('cur_m * 12', 2)} AS cur, {r('tgt_m * 12', 2)} AS tgt FROM monthly)""",
    )
    + f"""SELECT CAST(l_suppkey AS VARCHAR) AS resource_id, 'CLOUDSTORAGE_IDLE' AS rule_code,
  CASE WHEN gb = 0 THEN 'Idle Cloud Storage bucket with zero objects — delete bucket (current: bucket-' || l_suppkey || ')'
       ELSE 'Idle Cloud Storage bucket — transition from ' || class || ' to ' || colder || ' storage class' END
    AS recommendation,
  cur AS current_annual, tgt AS target_annual, {r('cur - tgt', 2)} AS annual_savings, false AS is_fallback,
  {r('cur_m - tgt_m', 4)} AS monthly_savings, CASE WHEN gb = 0 THEN 'DELETE' ELSE colder END AS target_class
FROM annual""",
)
def reco_storage_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_details(
        storage_idle(spark, sf_dir), {"monthly_savings": "monthly_savings", "target_class": "target_class"}
    )


def storage_overprovisioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return storage.storage_overprovisioned(buckets(spark, sf_dir))


@query(
    "reco_storage_overprovisioned",
    m.lines(
        WEEKLY,
        BUCKETS,
        """aimed AS (
  SELECT b.*, coalesce(growth, 0) AS growth,
    CASE WHEN coalesce(growth, 0) > 10 AND reads_30d = 0 AND class <> 'ARCHIVE' THEN 'ARCHIVE'
         WHEN reads < 1 AND rank < 1 THEN 'NEARLINE' WHEN reads < 0.25 AND rank < 2 THEN 'COLDLINE'
         WHEN reads < 0.083 AND rank < 3 THEN 'ARCHIVE' END AS colder,
    CASE WHEN coalesce(growth, 0) > 10 AND reads_30d = 0 AND class <> 'ARCHIVE' THEN 'storage_growth_no_reads'
         ELSE 'low_read_frequency' END AS signal
  FROM buckets b JOIN growth g ON b.l_suppkey = g.l_suppkey)""",
        f"""fees AS (SELECT aimed.*, gb_price, {r('reads * read_price', 4)} AS fee FROM aimed JOIN price ON price.class = colder)""",
        f"""monthly AS (SELECT *, {r('gb * gb_price + fee', 4)} AS tgt_m FROM fees)""",
        f"""annual AS (SELECT *, {r('cur_m * 12', 2)} AS cur, {r('tgt_m * 12', 2)} AS tgt FROM monthly)""",
    )
    + f"""SELECT CAST(l_suppkey AS VARCHAR) AS resource_id, 'CLOUDSTORAGE_OVERPROVISIONED' AS rule_code,
  'Overprovisioned Cloud Storage — transition from ' || class || ' to ' || colder ||
  CASE WHEN signal = 'low_read_frequency' THEN ' (access < ' || format('{{:.2f}}', reads) || ' reads/mo)'
       ELSE ' (storage growing ' || format('{{:.1f}}', growth) || '%/wk with zero reads)' END AS recommendation,
  cur AS current_annual, tgt AS target_annual, {r('cur - tgt', 2)} AS annual_savings, false AS is_fallback,
  {r('cur_m - tgt_m', 4)} AS monthly_savings, signal, colder AS target_class, fee AS retrieval_cost_monthly
FROM annual WHERE {r('cur - tgt', 2)} > 0""",
)
def reco_storage_overprovisioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("monthly_savings", "signal", "target_class", "retrieval_cost_monthly")
    return with_details(storage_overprovisioned(spark, sf_dir), {n: n for n in names})


# CDN origins: one per user and day --------------------------------------------------------------


def origins(spark: SparkSession, sf_dir: str, latency: bool = True) -> DataFrame:
    events = m.table(spark, sf_dir, "events")
    keyed = events.select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type", "value")
    keys = ["user_id", "day"]

    def total(condition: Column, value: Column) -> Column:
        return F.sum(F.when(condition, value).otherwise(0.0))

    kind = F.col("event_type")
    sums = {
        "_value": F.sum("value"),
        "_sent": total(kind == "purchase", F.col("value")),
        "requests": total(kind == "view", F.lit(1.0)),
        "misses": total(kind == "error", F.lit(1.0)),
    }
    if latency:
        timed = keyed.withColumn("ms", F.col("value") * 10)
        counted = percentiles(timed, keys, {"backend_latency_p95_ms": ("ms", 0.95)}, also=sums)
    else:
        counted = keyed.groupBy(*keys).agg(*[c.alias(name) for name, c in sums.items()])
    hit = F.try_divide(F.col("requests") * 100, F.col("requests") + F.col("misses"))
    missed = F.try_divide(F.col("misses") * 100, F.col("requests") + F.col("misses"))
    places = m.resources(spark, sf_dir).select("resource_id", F.col("client_id").alias("region"))
    rows = counted.withColumns(
        {
            "resource_id": F.col("user_id").cast("string"),
            "egress_gb_monthly": stable(F.col("_value") / 100, 4),
            "sent_bytes_gb": stable(F.col("_sent") / 100, 4),
            "request_count_monthly": F.col("requests"),
            "cache_hit_ratio": F.coalesce(hit, F.lit(0.0)),
            "miss_ratio_pct": F.coalesce(missed, F.lit(0.0)),
            "cache_mode": F.when(F.col("user_id") % 2 == 0, "FORCE_DYNAMIC").otherwise("CACHE_ALL_STATIC"),
        }
    )
    if latency:
        rows = rows.withColumn("backend_latency_p95_ms", stable(F.col("backend_latency_p95_ms"), 4))
    named = rows.join(places, "resource_id").withColumn("origin_name", F.concat(F.lit("origin-"), F.col("user_id")))
    return named.withColumn("resource_id", F.concat_ws("|", "resource_id", "day")).drop("user_id", "day", "_value", "_sent")


ORIGINS = f"""counted AS (
  SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, {rs('sum(value) / 100', 4)} AS egress,
         {rs("sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) / 100", 4)} AS sent,
         CAST(count(*) FILTER (WHERE event_type = 'view') AS DOUBLE) AS requests,
         CAST(count(*) FILTER (WHERE event_type = 'error') AS DOUBLE) AS misses,
         {rs('quantile_cont(value * 10, 0.95)', 4)} AS latency
  FROM events GROUP BY 1, 2),
origins AS (
  SELECT CAST(user_id AS VARCHAR) || '|' || day AS resource_id, 'origin-' || user_id AS origin_name, egress, sent, requests,
         latency, coalesce(requests * 100 / nullif(requests + misses, 0), 0) AS hit,
         coalesce(misses * 100 / nullif(requests + misses, 0), 0) AS miss,
         CASE WHEN user_id % 2 = 0 THEN CAST(60 AS DOUBLE) ELSE CAST(80 AS DOUBLE) END AS goal,
         CASE WHEN client_id LIKE 'ASIA%' THEN CAST(0.14 AS DOUBLE) ELSE CAST(0.08 AS DOUBLE) END AS price
  FROM counted JOIN resources r ON r.resource_id = CAST(user_id AS VARCHAR))"""


def cdn_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.cdn_idle(origins(spark, sf_dir, latency=False).where(ORIGIN_IDLE))


@query(
    "reco_cdn_idle",
    m.lines(
        m.RESOURCES,
        ORIGINS,
        f"""told AS (SELECT *, {r('egress * price', 4)} AS monthly, concat_ws('; ',
    CASE WHEN requests = 0 THEN 'zero requests (14-30 days)' END,
    CASE WHEN sent = 0 THEN 'zero edge bytes served (sent_bytes_count = 0)' END,
    CASE WHEN hit = 0 THEN 'cache never used (cache_hit_ratio = 0%)' END) AS reason
  FROM origins WHERE requests = 0 OR sent = 0 OR hit = 0)""",
    )
    + f"""SELECT resource_id, 'CLOUDCDN_IDLE' AS rule_code,
  'Idle Cloud CDN origin — disable CDN or delete backend service ' || origin_name || ' (' || reason || ')' AS recommendation,
  {r('monthly * 12', 2)} AS current_annual, {ZERO} AS target_annual, {r('monthly * 12', 2)} AS annual_savings,
  false AS is_fallback, monthly AS monthly_savings, price AS egress_price_per_gb FROM told""",
)
def reco_cdn_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_details(
        cdn_idle(spark, sf_dir),
        {"monthly_savings": "monthly_savings", "egress_price_per_gb": "egress_price_per_gb"},
    )


def cdn_overprovisioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.cdn_overprovisioned(origins(spark, sf_dir))


@query(
    "reco_cdn_overprovisioned",
    m.lines(
        m.RESOURCES,
        ORIGINS,
        f"""fired AS (
  SELECT *, {r('egress * price', 4)} AS cur_m, {r('egress * greatest(0.0, (goal - hit) / 100.0)', 4)} AS less
  FROM origins WHERE hit < goal OR miss > 20 OR latency > 500)""",
        f"""saved AS (SELECT *, {r('less * price', 4)} AS sav_m FROM fired)""",
        f"""monthly AS (SELECT *, {r('cur_m - sav_m', 4)} AS tgt_m, concat_ws('; ',
    CASE WHEN hit < 30 THEN 'force aggressive caching (cache_hit_ratio=' || format('{{:.0f}}', hit)
           || '% < 30% — paying CDN premium for origin traffic)'
         WHEN hit < goal THEN 'optimize TTL and cache keys to improve hit ratio from ' || format('{{:.0f}}', hit)
           || '% to ' || format('{{:.0f}}', goal) || '%' END,
    CASE WHEN miss > 20 THEN 'reduce cache misses (current miss rate ' || format('{{:.0f}}', miss) || '% > 20%)' END,
    CASE WHEN latency > 500 THEN 'tune origin TTL/cache mode to reduce origin latency (P95='
           || format('{{:.0f}}', latency) || 'ms > 500ms)' END) AS action,
  concat_ws('; ',
    CASE WHEN hit < 30 THEN 'cache_hit_ratio=' || format('{{:.0f}}', hit) || '% < 30% — CDN is ineffective'
         WHEN hit < goal THEN 'cache_hit_ratio=' || format('{{:.0f}}', hit) || '% below target '
           || format('{{:.0f}}', goal) || '%' END,
    CASE WHEN miss > 20 THEN 'miss_ratio=' || format('{{:.0f}}', miss) || '% > 20% — high origin load' END,
    CASE WHEN latency > 500 THEN 'backend_latency P95=' || format('{{:.0f}}', latency) || 'ms > 500ms — slow origin' END)
    AS signals
  FROM saved)""",
    )
    + f"""SELECT resource_id, 'CLOUDCDN_OVERPROVISIONED' AS rule_code,
  'Overprovisioned Cloud CDN — ' || action || ' (current: ' || origin_name || ')' AS recommendation,
  {r('cur_m * 12', 2)} AS current_annual, {r('tgt_m * 12', 2)} AS target_annual, {r('sav_m * 12', 2)} AS annual_savings,
  false AS is_fallback, sav_m AS monthly_savings, less AS origin_traffic_reduction_gb, signals AS signals_fired
FROM monthly""",
)
def reco_cdn_overprovisioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("monthly_savings", "origin_traffic_reduction_gb", "signals_fired")
    found = with_details(cdn_overprovisioned(spark, sf_dir), {n: n for n in names})
    return found.withColumn("signals_fired", F.array_join("signals_fired", "; "))


# DNS zones: customers, accounts are regions ----------------------------------------------------


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = m.table(spark, sf_dir, "customer"), m.table(spark, sf_dir, "nation")
    placed = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        "c_custkey", "n_regionkey", "c_acctbal", "c_name"
    )
    key = F.col("c_custkey")
    rows = features.account_positions(placed, ["n_regionkey"], ["c_custkey"], "zone_ordinal", "total_zones_in_account")
    return rows.select(
        key.alias("resource_id"),
        F.col("c_name").alias("zone_name"),
        "zone_ordinal",
        "total_zones_in_account",
        m.pick(key % 3, {0: "PUBLIC", 1: "private"}, "FORWARDING").alias("zone_type"),
        F.when(key % 4 == 0, 0.0).otherwise(F.abs("c_acctbal") / 5).alias("query_count_millions"),
        (key % 10).alias("record_set_count"),
        (key % 180).alias("days_since_last_update"),
        (key % 2).alias("forwarding_targets_reachable"),
    )


ZONES = """zones AS (
  SELECT c_custkey, c_name AS zone_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY c_custkey) AS ordinal,
         CASE c_custkey % 3 WHEN 0 THEN 'PUBLIC' WHEN 1 THEN 'PRIVATE' ELSE 'FORWARDING' END AS kind,
         CASE WHEN c_custkey % 4 = 0 THEN CAST(0 AS DOUBLE) ELSE abs(c_acctbal) / 5 END AS queries,
         c_custkey % 10 AS records, c_custkey % 180 AS days, c_custkey % 2 AS reachable
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def _query_cost_sql(millions: str) -> str:
    cost = f"least({millions}, 1000.0) * 0.40 + greatest(0.0, {millions} - 1000) * 0.20"
    return f"CASE WHEN {millions} > 0 THEN {r(cost, 4)} ELSE 0.0 END"


def dns_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.dns_idle(zones(spark, sf_dir))


@query(
    "reco_dns_idle",
    m.lines(
        ZONES,
        f"""fees AS (SELECT *, CASE WHEN ordinal > 25 THEN 0.20 ELSE 0.0 END AS fee,
  CASE WHEN kind = 'PUBLIC' THEN {_query_cost_sql('queries')} ELSE 0.0 END AS query_fee,
  CASE WHEN records < 5 AND queries = 0 THEN '< 5 records (' || records || ') and zero queries'
       WHEN days > 90 AND queries = 0 THEN 'no zone updates in ' || days || ' days (update_time metadata) and zero queries'
       ELSE 'zero or near-zero query volume over 14-30 days' END AS reason FROM zones)""",
        f"""monthly AS (SELECT *, {r('CAST(fee AS DOUBLE) + query_fee', 4)} AS cost FROM fees)""",
    )
    + f"""SELECT CAST(c_custkey AS VARCHAR) AS resource_id, 'CLOUDDNS_IDLE' AS rule_code,
  'Idle Cloud DNS zone — delete ' || zone_name || ' (' || reason || ')' AS recommendation,
  {r('cost * 12', 2)} AS current_annual, {ZERO} AS target_annual, {r('cost * 12', 2)} AS annual_savings,
  false AS is_fallback, cost AS monthly_savings, ordinal > 25 AS is_billable_zone FROM monthly""",
)
def reco_dns_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_details(
        dns_idle(spark, sf_dir), {"monthly_savings": "monthly_savings", "is_billable_zone": "is_billable_zone"}
    )


def dns_overprovisioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.dns_overprovisioned(zones(spark, sf_dir))


@query(
    "reco_dns_overprovisioned",
    m.lines(
        ZONES,
        f"""fired AS (SELECT *, kind = 'FORWARDING' AND reachable = 0 AS orphan, {r('queries * 0.70', 2)} AS fewer,
  CASE WHEN kind = 'PUBLIC' THEN {_query_cost_sql('queries')} ELSE 0.0 END AS query_fee
  FROM zones WHERE (kind = 'FORWARDING' AND reachable = 0) OR queries > 10)""",
        f"""monthly AS (SELECT *, {r('CAST(0.20 AS DOUBLE) + query_fee', 4)} AS cur_m,
  CASE WHEN orphan THEN 0.0 ELSE {r('CAST(0.20 AS DOUBLE) + ' + _query_cost_sql('fewer'), 4)} END AS tgt_m FROM fired)""",
        f"""annual AS (SELECT *, {r('cur_m * 12', 2)} AS cur, {r('tgt_m * 12', 2)} AS tgt FROM monthly)""",
    )
    + f"""SELECT CAST(c_custkey AS VARCHAR) AS resource_id, 'CLOUDDNS_OVERPROVISIONED' AS rule_code,
  CASE WHEN orphan THEN 'Overprovisioned Cloud DNS — delete orphaned forwarding zone ' || zone_name || ' (targets unreachable)'
       ELSE 'Overprovisioned Cloud DNS — add wildcard records or delegate to Cloud Load Balancer ('
         || format('{{:.1f}}', queries) || 'M queries/mo -> ~' || format('{{:.1f}}', fewer) || 'M) (current: '
         || zone_name || ')' END AS recommendation,
  cur AS current_annual, tgt AS target_annual, {r('cur - tgt', 2)} AS annual_savings, false AS is_fallback,
  {r('cur_m - tgt_m', 4)} AS monthly_savings, CASE WHEN NOT orphan THEN fewer END AS optimized_query_millions
FROM annual""",
)
def reco_dns_overprovisioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("monthly_savings", "optimized_query_millions")
    return with_details(dns_overprovisioned(spark, sf_dir), {n: n for n in names})


# The portfolio ---------------------------------------------------------------------------------

_PARTS = (
    "reco_gke_idle",
    "reco_gke_overprovisioned",
    "reco_dataflow_idle",
    "reco_dataflow_overprovisioned",
    "reco_router_idle",
    "reco_router_nat",
    "reco_pubsub_idle",
    "reco_pubsub_overprovisioned",
    "reco_scheduler_idle",
    "reco_scheduler_overprovisioned",
    "reco_storage_idle",
    "reco_storage_overprovisioned",
    "reco_cdn_idle",
    "reco_cdn_overprovisioned",
    "reco_dns_idle",
    "reco_dns_overprovisioned",
)
_FALLBACKS = ("reco_gke_fallback", "reco_dataflow_fallback")
ALL_SQL = "\nUNION ALL\n".join(
    f"SELECT {', '.join(RECO_COLUMNS)} FROM ({SQL[name]}) AS {name}" for name in (*_PARTS, *_FALLBACKS)
)


def portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every recommendation of every service: the fired rows of each rule through the dispatcher.

    What two rules read is aggregated once and stored: a shared shuffle alone would leave each rule to order all values anew.
    """
    over = (spark, sf_dir)
    job, topic, bucket, origin = (materialised(f(*over)) for f in (jobs, topics, buckets, origins))
    task, zone = scheduled(*over), zones(*over)
    fired = {
        "GKE_IDLE": compute.idle_windows(*over),
        "GKE_OVERPROVISIONED": compute.over_users(*over),
        "DATAFLOW_IDLE": job.where(JOB_IDLE),
        "DATAFLOW_OVERPROVISIONED": job.where(JOB_OVER),
        "CLOUDROUTER_IDLE": routers(*over),
        "CLOUDROUTER_NAT_OVERPROVISIONED": nat_routers(*over),
        "PUBSUB_IDLE": topic,
        "PUBSUB_OVERPROVISIONED": topic,
        "CLOUDSCHEDULER_IDLE": task,
        "CLOUDSCHEDULER_OVERPROVISIONED": task,
        "CLOUDSTORAGE_IDLE": bucket,
        "CLOUDSTORAGE_OVERPROVISIONED": bucket,
        "CLOUDCDN_IDLE": origin.where(ORIGIN_IDLE),
        "CLOUDCDN_OVERPROVISIONED": origin,
        "CLOUDDNS_IDLE": zone,
        "CLOUDDNS_OVERPROVISIONED": zone,
    }
    prices = pipeline.Prices(m.compute_catalog(*over), m.worker_catalog(spark), seeds.components(spark))
    return pipeline.recommend(fired, prices).select(*RECO_COLUMNS)


@query("recommendations_all", ALL_SQL)
def recommendations_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio(spark, sf_dir)


@query(
    "savings_summary",
    f"""WITH reco AS ({ALL_SQL}),
best AS (SELECT rule_code, sum(annual_savings) AS once FROM (
  SELECT *, row_number() OVER (PARTITION BY resource_id ORDER BY annual_savings DESC, rule_code DESC) AS rn FROM reco)
  WHERE rn = 1 GROUP BY rule_code),
plain AS (SELECT rule_code, count(*) AS n, sum(annual_savings) AS savings FROM reco GROUP BY rule_code)
SELECT rule_code, CAST(sum(n) AS BIGINT) AS recommendations, {rs('sum(savings)', 2)} AS total_annual_savings,
       {rs('sum(coalesce(once, 0))', 2)} AS savings_once
FROM plain LEFT JOIN best USING (rule_code) GROUP BY ROLLUP (rule_code)""",
)
def savings_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.summary(portfolio(spark, sf_dir))


@query(
    "savings_formula",
    f"""WITH reco AS ({ALL_SQL})
SELECT rule_code, resource_id, CASE WHEN rule_code LIKE '%IDLE' THEN {r('current_annual * 1', 2)}
  ELSE {r('current_annual - target_annual', 2)} END AS estimated_savings FROM reco""",
)
def savings_formula(spark: SparkSession, sf_dir: str) -> DataFrame:
    idle, over = (rule.estimated_savings_formula for rule in seeds.GKE_RULES)
    rows = portfolio(spark, sf_dir).select(
        "rule_code",
        "resource_id",
        F.col("current_annual").alias("total_cost"),
        F.col("current_annual").alias("current_cost"),
        F.col("target_annual").alias("target_cost"),
        F.when(F.col("rule_code").endswith("IDLE"), idle).otherwise(over).alias("estimated_savings_formula"),
    )
    done = savings_by_formula(rows, [idle, over])
    return done.select("rule_code", "resource_id", half_even(F.col("estimated_savings"), 2).alias("estimated_savings"))
