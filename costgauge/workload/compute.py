"""Queries on machine workloads: metrics, rules, matching, recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costgauge.functions.numeric import half_even
from costgauge.operators import features, matching, rules
from costgauge.operators.catalog import specs, with_ordinals
from costgauge.plans import machines as plan
from costgauge.sources import seeds
from costgauge.workload import models as m
from costgauge.workload.registry import query, r

ENTRY_SQL = "family, vcpus, ram_gb, hourly_price, monthly_cost, annual_cost, ordinal"
METRIC_COLUMNS = tuple(features.METRIC_NAMES.values())


@query(
    "metrics_pivot",
    m.lines(m.POINTS, m.USER_METRICS) + f"SELECT resource_id, {', '.join(METRIC_COLUMNS)} FROM user_metrics",
)
def metrics_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.user_metrics(spark, sf_dir)


@query(
    "resources_without_metrics",
    m.lines(m.POINTS, m.USER_METRICS, m.RESOURCES)
    + "SELECT resource_id, client_id, machine_type FROM resources"
    + " WHERE resource_id NOT IN (SELECT resource_id FROM user_metrics)",
)
def resources_without_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = m.points(spark, sf_dir).where(F.col("value") > 0).select("resource_id").distinct()
    return features.without_metrics(m.resources(spark, sf_dir), known, "resource_id").select(
        "resource_id", "client_id", "machine_type"
    )


def _tested(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = features.as_map(m.daily_metrics(spark, sf_dir), METRIC_COLUMNS)
    return daily.select(F.concat_ws("|", "resource_id", "day").alias("resource_id"), "metrics")


RULE_FIXTURES = (
    *seeds.GKE_RULES,
    rules.Rule("CPU_HIGH", "GKE", (rules.Condition("cpu_utilization_avg", "gte", 30),), "and"),
    rules.Rule("CPU_UP_TO_TEN", "GKE", (rules.Condition("cpu_utilization_avg", "lte", 10),)),
    rules.Rule("POD_CPU_ABOVE", "GKE", (rules.Condition("container_cpu_avg", "gt", 50),)),
    rules.Rule("MEMORY_ZERO", "GKE", (rules.Condition("memory_utilization_avg", "eq", 0),)),
    rules.Rule(
        "ODD_LOGIC",
        "GKE",
        (rules.Condition("cpu_utilization_avg", "gt", 60), rules.Condition("memory_utilization_avg", "gt", 60)),
        "XOR",
    ),
    rules.Rule(
        "UNKNOWN_OPERATOR",
        "GKE",
        (rules.Condition("cpu_utilization_avg", "near", 5), rules.Condition("container_memory_avg", "lt", 20)),
    ),
    rules.Rule("NO_CONDITIONS", "GKE", ()),
    rules.Rule("SWITCHED_OFF", "GKE", (rules.Condition("cpu_utilization_avg", "gte", 0),), is_active=False),
    rules.Rule("OTHER_SERVICE", "PUBSUB", (rules.Condition("cpu_utilization_avg", "gte", 0),)),
)
_TESTED_SQL = m.lines(m.POINTS, m.DAILY_METRICS) + (
    ", tested AS (SELECT resource_id || '|' || day AS resource_id, coalesce(cpu_utilization_avg, 0) AS cpu, "
    "coalesce(memory_utilization_avg, 0) AS mem, coalesce(container_cpu_avg, 0) AS pod_cpu, "
    f"coalesce(container_memory_avg, 0) AS pod_mem FROM daily_metrics WHERE {m.HAS_METRICS})\n"
)


@query(
    "rule_eval",
    _TESTED_SQL
    + """SELECT resource_id, 'GKE_IDLE' AS rule_code FROM tested WHERE cpu < 5 AND mem < 20
UNION ALL SELECT resource_id, 'GKE_OVERPROVISIONED' FROM tested WHERE cpu < 40 OR mem < 50
UNION ALL SELECT resource_id, 'CPU_HIGH' FROM tested WHERE cpu >= 30
UNION ALL SELECT resource_id, 'CPU_UP_TO_TEN' FROM tested WHERE cpu <= 10
UNION ALL SELECT resource_id, 'POD_CPU_ABOVE' FROM tested WHERE pod_cpu > 50
UNION ALL SELECT resource_id, 'MEMORY_ZERO' FROM tested WHERE abs(mem) < 0.001
UNION ALL SELECT resource_id, 'ODD_LOGIC' FROM tested WHERE cpu > 60 OR mem > 60
UNION ALL SELECT resource_id, 'UNKNOWN_OPERATOR' FROM tested WHERE pod_mem < 20""",
)
def rule_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    fired = rules.evaluate(_tested(spark, sf_dir), rules.rule_frame(spark, RULE_FIXTURES), "GKE")
    return fired.select("resource_id", "rule_code")


@query(
    "healthy_resources",
    _TESTED_SQL + "SELECT resource_id, cpu, mem FROM tested WHERE NOT (cpu < 40 OR mem < 50)",
)
def healthy_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    tested = _tested(spark, sf_dir)
    fired = rules.evaluate(tested, rules.rule_frame(spark, seeds.GKE_RULES), "GKE")
    return rules.healthy(tested, fired).select(
        "resource_id",
        F.coalesce(F.try_element_at("metrics", F.lit("cpu_utilization_avg")), F.lit(0.0)).alias("cpu"),
        F.coalesce(F.try_element_at("metrics", F.lit("memory_utilization_avg")), F.lit(0.0)).alias("mem"),
    )


HANDLED = ("GKE_IDLE", "GKE_OVERPROVISIONED")


@query(
    "unhandled_rules",
    _TESTED_SQL
    + """, fired AS (SELECT 'CPU_HIGH' AS rule_code FROM tested WHERE cpu >= 30
UNION ALL SELECT 'CPU_UP_TO_TEN' FROM tested WHERE cpu <= 10
UNION ALL SELECT 'POD_CPU_ABOVE' FROM tested WHERE pod_cpu > 50
UNION ALL SELECT 'MEMORY_ZERO' FROM tested WHERE abs(mem) < 0.001
UNION ALL SELECT 'ODD_LOGIC' FROM tested WHERE cpu > 60 OR mem > 60
UNION ALL SELECT 'UNKNOWN_OPERATOR' FROM tested WHERE pod_mem < 20)
SELECT rule_code, count(*) AS n_resources FROM fired GROUP BY rule_code""",
)
def unhandled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    fired = rules.evaluate(_tested(spark, sf_dir), rules.rule_frame(spark, RULE_FIXTURES), "GKE")
    return rules.unhandled(fired, HANDLED).groupBy("rule_code").agg(F.count(F.lit(1)).alias("n_resources"))


# Machine catalog ------------------------------------------------------------------------------


@query("price_ordinal", m.lines(m.MACHINES) + "SELECT family, machine_type, hourly_price, ordinal FROM sku")
def price_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_ordinals(m.machines(spark, sf_dir)).select("family", "machine_type", "hourly_price", "ordinal")


@query(
    "sku_specs",
    m.lines(m.MACHINES)
    + "SELECT family, machine_type, vcpus, ram_gb, hourly_price AS hourly_cost, monthly_cost, annual_cost, 999 AS ordinal"
    + " FROM sku",
)
def sku_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return specs(m.machines(spark, sf_dir)).drop("hourly_price")


@query(
    "sku_lookup",
    m.lines(m.RESOURCES, m.MACHINES)
    + "SELECT resource_id, r.machine_type, family, vcpus, ram_gb, annual_cost, ordinal"
    + " FROM resources r JOIN sku s ON r.machine_type = s.machine_type",
)
def sku_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matching.lookup(m.resources(spark, sf_dir), m.compute_catalog(spark, sf_dir))
    return found.select(
        "resource_id",
        "machine_type",
        F.col("cur_family").alias("family"),
        F.col("cur_vcpus").alias("vcpus"),
        F.col("cur_ram_gb").alias("ram_gb"),
        F.col("cur_annual_cost").alias("annual_cost"),
        F.col("cur_ordinal").alias("ordinal"),
    )


@query(
    "sku_missing",
    m.lines(m.RESOURCES, m.MACHINES)
    + "SELECT resource_id, machine_type FROM (SELECT resource_id, CASE WHEN CAST(resource_id AS BIGINT) % 11 = 0"
    + " THEN machine_type || '-gone' ELSE machine_type END AS machine_type FROM resources) w"
    + " WHERE machine_type NOT IN (SELECT machine_type FROM sku WHERE vcpus > 0)",
)
def sku_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = F.col("resource_id").cast("bigint") % 11 == 0
    workloads = m.resources(spark, sf_dir).select(
        "resource_id",
        F.when(gone, F.concat("machine_type", F.lit("-gone"))).otherwise(F.col("machine_type")).alias("machine_type"),
    )
    return matching.missing_types(workloads, m.compute_catalog(spark, sf_dir)).select("resource_id", "machine_type")


@query(
    "required_capacity",
    m.lines(m.POINTS, m.USER_METRICS, m.RESOURCES, m.USERS, m.MACHINES)
    + f"""SELECT resource_id,
  {r('''CASE WHEN coalesce(cpu_utilization_avg, 0) > 0 THEN greatest(1.0, vcpus * (cpu_utilization_avg / 100) * 1.3)
        ELSE vcpus * 0.5 END''', 4)} AS required_vcpus,
  {r('''CASE WHEN coalesce(memory_utilization_avg, 0) > 0
        THEN greatest(1.0, ram_gb * (memory_utilization_avg / 100) * 1.3) ELSE ram_gb * 0.5 END''', 4)} AS required_ram
FROM users u JOIN sku s ON u.machine_type = s.machine_type""",
)
def required_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matching.lookup(m.users(spark, sf_dir), m.compute_catalog(spark, sf_dir))
    needed = plan.requirements(found, plan.GKE)
    return needed.select(
        "resource_id",
        half_even(F.col("required_vcpus"), 4).alias("required_vcpus"),
        half_even(F.col("required_ram"), 4).alias("required_ram"),
    )


# Overprovisioned machines ---------------------------------------------------------------------

_OVER = m.lines(m.POINTS, m.USER_METRICS, m.RESOURCES, m.USERS, m.MACHINES) + f"""
, needed AS (
  SELECT u.resource_id, u.machine_type, u.current_node_count AS n, s.family, s.vcpus, s.ram_gb, s.ordinal, s.annual_cost,
         s.monthly_cost,
         CASE WHEN coalesce(cpu_utilization_avg, 0) > 0 THEN greatest(1.0, s.vcpus * (cpu_utilization_avg / 100) * 1.3)
              ELSE s.vcpus * 0.5 END AS need_vcpus,
         CASE WHEN coalesce(memory_utilization_avg, 0) > 0
              THEN greatest(1.0, s.ram_gb * (memory_utilization_avg / 100) * 1.3) ELSE s.ram_gb * 0.5 END AS need_ram
  FROM users u JOIN sku s ON u.machine_type = s.machine_type WHERE {m.OVER_SQL}),
direct AS (
  SELECT * FROM (
    SELECT d.*, c.machine_type AS target_type, c.vcpus AS target_vcpus, c.ram_gb AS target_ram,
           c.ordinal AS target_ordinal, c.hourly_price AS t_hourly, c.monthly_cost AS t_monthly, c.annual_cost AS t_annual,
           row_number() OVER (PARTITION BY d.resource_id ORDER BY c.vcpus, c.ram_gb, c.ordinal, c.machine_type) AS rn
    FROM needed d JOIN sku c ON c.family = d.family AND c.machine_type <> d.machine_type AND c.ordinal < d.ordinal
      AND c.vcpus >= d.need_vcpus AND c.ram_gb >= d.need_ram)
  WHERE rn = 1),
fallback AS (
  SELECT * FROM (
    SELECT d.*, c.machine_type AS target_type, c.ordinal AS target_ordinal, c.hourly_price AS t_hourly,
           c.monthly_cost AS t_monthly, c.annual_cost AS t_annual,
           row_number() OVER (PARTITION BY d.resource_id ORDER BY c.ordinal DESC, c.machine_type) AS rn
    FROM needed d JOIN sku c ON c.family = d.family AND c.machine_type <> d.machine_type AND c.ordinal < d.ordinal
    WHERE d.resource_id NOT IN (SELECT resource_id FROM direct))
  WHERE rn <= 3),
means AS (
  SELECT resource_id, machine_type, n, family, annual_cost, monthly_cost, target_type AS names,
         {r('t_hourly', 6)} AS avg_hourly, {r('t_monthly', 4)} AS avg_monthly, {r('t_annual', 4)} AS avg_annual,
         false AS is_fallback FROM direct
  UNION ALL
  SELECT resource_id, any_value(machine_type), any_value(n), any_value(family), any_value(annual_cost),
         any_value(monthly_cost), string_agg(target_type, ', ' ORDER BY rn),
         {r('(sum(CASE WHEN rn = 1 THEN t_hourly ELSE 0 END) + sum(CASE WHEN rn = 2 THEN t_hourly ELSE 0 END) + sum(CASE WHEN rn = 3 THEN t_hourly ELSE 0 END)) / count(*)', 6)},
         {r('(sum(CASE WHEN rn = 1 THEN t_monthly ELSE 0 END) + sum(CASE WHEN rn = 2 THEN t_monthly ELSE 0 END) + sum(CASE WHEN rn = 3 THEN t_monthly ELSE 0 END)) / count(*)', 4)},
         {r('(sum(CASE WHEN rn = 1 THEN t_annual ELSE 0 END) + sum(CASE WHEN rn = 2 THEN t_annual ELSE 0 END) + sum(CASE WHEN rn = 3 THEN t_annual ELSE 0 END)) / count(*)', 4)},
         true FROM fallback GROUP BY resource_id),
over_priced AS (
  SELECT *, {r('annual_cost * n', 2)} AS current_annual, {r('avg_annual * n', 2)} AS target_annual,
         {r('(monthly_cost - avg_monthly) * n', 2)} AS monthly_savings FROM means),
over_reco AS (
  SELECT resource_id, 'GKE_OVERPROVISIONED' AS rule_code,
         'Overprovisioned GKE node pool — rightsize from ' || machine_type || ' to ' || names AS recommendation,
         current_annual, target_annual, {r('current_annual - target_annual', 2)} AS annual_savings, is_fallback,
         avg_hourly, avg_monthly, avg_annual, monthly_savings, family
  FROM over_priced)
"""


def over_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users the overprovisioned rule fires on; a rule declared in code is compiled into the filter."""
    rule = seeds.GKE_RULES[1]
    fired = m.users(spark, sf_dir).where(rules.as_filter(rule))
    return fired.withColumn("template", F.lit(rule.recommendation_template))


@query(
    "sku_candidates",
    _OVER + "SELECT resource_id, machine_type, target_type, target_vcpus, target_ram, target_ordinal FROM direct",
)
def sku_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched = plan.with_targets(over_users(spark, sf_dir), m.compute_catalog(spark, sf_dir), plan.GKE)
    target = F.get("targets", F.lit(0))
    return matched.where(~F.col("is_fallback")).select(
        "resource_id",
        "machine_type",
        target["machine_type"].alias("target_type"),
        target["vcpus"].alias("target_vcpus"),
        target["ram_gb"].alias("target_ram"),
        target["ordinal"].alias("target_ordinal"),
    )


@query(
    "sku_fallback",
    _OVER + "SELECT resource_id, CAST(rn AS INTEGER) AS place, target_type, target_ordinal FROM fallback",
)
def sku_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched = plan.with_targets(over_users(spark, sf_dir), m.compute_catalog(spark, sf_dir), plan.GKE)
    placed = matched.where("is_fallback").select("resource_id", F.posexplode("targets").alias("pos", "target"))
    return placed.select(
        "resource_id",
        (F.col("pos") + 1).alias("place"),
        F.col("target.machine_type").alias("target_type"),
        F.col("target.ordinal").alias("target_ordinal"),
    )


RECO_COLUMNS = (
    "resource_id",
    "rule_code",
    "recommendation",
    "current_annual",
    "target_annual",
    "annual_savings",
    "is_fallback",
)
MACHINE_DETAILS = {
    "avg_hourly_cost": "avg_hourly",
    "avg_monthly_cost": "avg_monthly",
    "avg_annual_cost": "avg_annual",
    "monthly_savings": "monthly_savings",
    "family": "family",
}


def with_details(recommendations: DataFrame, names: dict[str, str]) -> DataFrame:
    """Contract columns and some details."""
    return recommendations.select(*RECO_COLUMNS, *[F.col(f"details.{d}").alias(a) for d, a in names.items()])


def gke_overprovisioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.overprovisioned(over_users(spark, sf_dir), m.compute_catalog(spark, sf_dir), plan.GKE)


def idle_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User days the idle rule fires on."""
    rule = seeds.GKE_RULES[0]
    fired = m.windows(spark, sf_dir).where(rules.as_filter(rule))
    return fired.withColumn("template", F.lit(rule.recommendation_template))


@query("reco_gke_overprovisioned", _OVER + "SELECT * FROM over_reco WHERE NOT is_fallback")
def reco_gke_overprovisioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = gke_overprovisioned(spark, sf_dir).where(~F.col("is_fallback"))
    return with_details(found, MACHINE_DETAILS)


@query("reco_gke_fallback", _OVER + "SELECT * FROM over_reco WHERE is_fallback")
def reco_gke_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_details(gke_overprovisioned(spark, sf_dir).where("is_fallback"), MACHINE_DETAILS)


GKE_IDLE_SQL = f"""
idle_priced AS (
  SELECT w.resource_id, w.machine_type, {r('annual_cost * current_node_count', 2)} AS annual,
         {r('monthly_cost * current_node_count', 2)} AS monthly, current_node_count AS node_count
  FROM windows w JOIN sku s ON w.machine_type = s.machine_type WHERE {m.IDLE_SQL}),
idle_reco AS (
  SELECT resource_id, 'GKE_IDLE' AS rule_code,
         'Idle GKE node pool — delete or scale to 0 nodes (current: ' || machine_type || ')' AS recommendation,
         annual AS current_annual, CAST(0 AS DOUBLE) AS target_annual, annual AS annual_savings, false AS is_fallback,
         monthly AS monthly_savings, node_count FROM idle_priced)
"""


def gke_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.idle(idle_windows(spark, sf_dir), m.compute_catalog(spark, sf_dir), plan.GKE)


@query(
    "reco_gke_idle",
    m.lines(m.POINTS, m.DAILY_METRICS, m.RESOURCES, m.WINDOWS, m.MACHINES, GKE_IDLE_SQL) + "SELECT * FROM idle_reco",
)
def reco_gke_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_details(gke_idle(spark, sf_dir), {"monthly_savings": "monthly_savings", "node_count": "node_count"})
