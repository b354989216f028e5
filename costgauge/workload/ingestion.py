"""Queries on ingestion: mapping, ids, inheritance, stamping, upsert, export, configuration."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costgauge.functions.prices import class_for_reads, egress_price, query_cost
from costgauge.functions.text import fixed, machine_family, render, template_or
from costgauge.functions.timing import zone_to_region
from costgauge.operators import ingest, rules, upsert
from costgauge.operators.features import account_positions
from costgauge.params import RunParams, parse_params
from costgauge.schemas import parsed
from costgauge.sources import readers, writers
from costgauge.sources.local import local_table
from costgauge.workload import models as m
from costgauge.workload.registry import query, r

PARAMS = RunParams(
    account_id="project-1", client_id="client-1", run_ts=datetime(2024, 1, 31, 12, 30, tzinfo=timezone.utc)
)

# Raw records: one nested record per customer ---------------------------------------------------

RECORD = """name string, location string, status int, current_node_count int, autopilot struct<enabled: boolean>,
  release_channel struct<channel: string>, resource_labels map<string, string>, locations array<string>"""


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = m.table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return customer.select(
        key,
        F.col("c_name").alias("name"),
        F.concat(F.lit("region-"), F.col("c_nationkey")).alias("location"),
        (key % 4).cast("int").alias("status"),
        (key % 5).cast("int").alias("current_node_count"),
        F.struct((key % 2 == 0).alias("enabled")).alias("autopilot"),
        F.when(key % 3 != 0, F.struct(F.lit("RAPID").alias("channel"))).alias("release_channel"),
        F.create_map(F.lit("segment"), F.col("c_mktsegment")).alias("resource_labels"),
        F.array(F.lit("a"), F.col("c_nationkey").cast("string")).alias("locations"),
    )


@query(
    "resource_scan",
    """SELECT c_name AS name, 'region-' || c_nationkey AS location, CAST(c_custkey % 5 AS INTEGER) AS current_node_count,
  c_custkey % 2 = 0 AS autopilot, CASE WHEN c_custkey % 3 <> 0 THEN 'RAPID' END AS channel, c_mktsegment AS segment,
  2 AS n_locations FROM customer""",
)
def resource_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = records(spark, sf_dir)
    path = writers.shared_folder(spark, "resources")
    rows.drop("c_custkey").write.json(path)
    scanned = readers.resources(spark, path, parsed(RECORD))
    return scanned.select(
        "name",
        "location",
        "current_node_count",
        F.col("autopilot.enabled").alias("autopilot"),
        F.col("release_channel.channel").alias("channel"),
        F.try_element_at("resource_labels", F.lit("segment")).alias("segment"),
        F.size("locations").alias("n_locations"),
    )


MAPPING = {
    "name": "cluster_name",
    "location": "location",
    "current_node_count": "current_node_count",
    "autopilot.enabled": "autopilot_enabled",
    "release_channel.channel": "release_channel",
    "resource_labels": "labels",
    "locations": "locations",
    "release_channel.missing": "absent",
}


@query(
    "field_mapping",
    """SELECT c_custkey, c_name AS cluster_name, 'region-' || c_nationkey AS location,
  CAST(c_custkey % 5 AS INTEGER) AS current_node_count, c_custkey % 2 = 0 AS autopilot_enabled,
  CASE WHEN c_custkey % 3 <> 0 THEN 'RAPID' END AS release_channel, '{"segment":"' || c_mktsegment || '"}' AS labels,
  '["a","' || c_nationkey || '"]' AS locations, CAST(NULL AS VARCHAR) AS absent FROM customer""",
)
def field_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.map_fields(records(spark, sf_dir), MAPPING, keep=["c_custkey"])


@query(
    "flatten_scoped_items",
    """SELECT o_orderkey, o_orderkey || '-' || i AS member FROM orders, range(3) t(i)
WHERE o_orderkey % 4 IN (0, 1) AND i < o_orderkey % 3
UNION ALL SELECT o_orderkey, 'plain-' || o_orderkey FROM orders WHERE o_orderkey % 4 = 2""",
)
def flatten_scoped_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    # Members of a scope; a scope may be empty.
    members = F.transform(
        F.filter(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda i: i < key % 3),
        lambda i: F.concat(key.cast("string"), F.lit("-"), i.cast("string")),
    )
    entries = m.table(spark, sf_dir, "orders").select(
        key,
        F.when(key % 4 == 0, members).alias("instances"),
        F.when(key % 4 == 1, members).when(key % 4 == 3, F.slice(members, 1, 0)).alias("items"),
        F.when(key % 4 == 2, F.concat(F.lit("plain-"), key)).alias("record"),
    )
    return ingest.flatten_scoped(entries).select("o_orderkey", F.col("record").alias("member"))


@query(
    "composite_id",
    """WITH named AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN c_mktsegment END AS project,
  CASE WHEN c_custkey % 2 = 0 THEN 'loc-' || c_nationkey END AS location,
  CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS cluster_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, coalesce(nullif(project, ''), n_name) || '.' || coalesce(location, '') || '.' || coalesce(cluster_name, '')
  AS resource_id, coalesce(cluster_name, coalesce(nullif(project, ''), n_name) || '.' || coalesce(location, '') || '.')
  AS resource_name FROM named""",
)
def composite_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = m.table(spark, sf_dir, "customer"), m.table(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    rows = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        key,
        "n_name",
        F.when(key % 3 == 0, "").when(key % 3 == 1, F.col("c_mktsegment")).alias("project_id"),
        F.when(key % 2 == 0, F.concat(F.lit("loc-"), F.col("c_nationkey"))).alias("location"),
        F.when(key % 5 != 0, F.col("c_name")).alias("cluster_name"),
    )
    named = ingest.composite_id(rows, ("project_id", "location", "cluster_name"), {"project_id": F.col("n_name")})
    return ingest.resource_name(named).select("c_custkey", "resource_id", "resource_name")


@query(
    "stamp_metadata",
    """SELECT CAST(s_suppkey AS VARCHAR) AS resource_id, 'client-1' AS client_id, 'project-1' AS account_id, 'gcp' AS cloud_name,
  '2024-01' AS year_month, 'GKE' AS service_name, '2024-01-31T12:30:00' AS ran_at FROM supplier""",
)
def stamp_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = m.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("resource_id"))
    stamped = ingest.stamp(rows, PARAMS, "GKE")
    ran_at = F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("job_runtime_utc").cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss")
    return stamped.withColumn("ran_at", ran_at).drop("ingestion_timestamp", "job_runtime_utc")


@query(
    "schema_conform",
    """SELECT c_name AS resource_id, CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS current_node_count,
  CAST(c_nationkey AS VARCHAR) AS location, CAST(NULL AS INTEGER) AS disk_count, c_custkey % 2 = 0 AS spot FROM customer""",
)
def schema_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = m.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("resource_id"),
        F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal").cast("string")).otherwise("none").alias("current_node_count"),
        F.col("c_nationkey").alias("location"),
        F.when(F.col("c_custkey") % 2 == 0, "true").otherwise("false").alias("spot"),
        "c_mktsegment",
    )
    declared = "resource_id string, current_node_count double, location string, disk_count int, spot boolean"
    return ingest.conform(rows, parsed(declared))


@query(
    "metric_enrich",
    m.lines(m.POINTS, m.RESOURCES)
    + f"""SELECT p.resource_id, 'customer-' || p.resource_id AS resource_name, metric_name,
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS date, strftime(ts, '%Y-%m-%d') AS metric_date, location AS region,
  CASE WHEN metric_name = '{m.UNMAPPED}' THEN '' ELSE 'Ratio' END AS unit,
  CASE WHEN metric_name = '{m.UNMAPPED}' THEN '' ELSE 'Ratio' END AS metric_unit, 'GKE' AS service_name,
  'kubernetes.io' AS namespace, {r('value', 6)} AS metric_value
FROM points p JOIN resources r ON p.resource_id = r.resource_id""",
)
def metric_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = m.points(spark, sf_dir).drop("event_id")
    placed = m.resources(spark, sf_dir).select(
        "resource_id",
        F.concat(F.lit("customer-"), F.col("resource_id")).alias("resource_name"),
        "location",
        F.lit(None).cast("string").alias("region"),
    )
    units = local_table(spark, [(name, "Ratio") for name in m.METRIC_NAMES], "metric_name string, unit string")
    rows = ingest.enrich_points(points, placed, units, "GKE", "kubernetes.io", PARAMS.run_ts)
    value = ingest.point_value(F.col("value"), F.lit(None))
    return rows.withColumn("metric_value", value).drop("value", "job_runtime_utc")


@query(
    "zone_to_region",
    """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'us-central' || c_nationkey WHEN 1 THEN 'us-central' || c_nationkey
  WHEN 2 THEN 'global' ELSE 'a-b-c-d' END AS region FROM customer""",
)
def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey") % 4
    base = F.concat(F.lit("us-central"), F.col("c_nationkey"))
    location = (
        F.when(key == 0, F.concat(base, F.lit("-a"))).when(key == 1, base).when(key == 2, "global").otherwise("a-b-c-d")
    )
    return m.table(spark, sf_dir, "customer").select("c_custkey", zone_to_region(location).alias("region"))


CHANNELS = {0: "UNSPECIFIED", 1: "RAPID", 2: "REGULAR", 3: "STABLE", 4: "EXTENDED"}


@query(
    "enum_decode",
    "SELECT c_custkey, coalesce(CASE c_custkey % 7 "
    + " ".join(f"WHEN {k} THEN '{v}'" for k, v in CHANNELS.items())
    + " END, CAST(c_custkey % 7 AS VARCHAR)) AS channel, CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END AS flag"
    + " FROM customer",
)
def enum_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return m.table(spark, sf_dir, "customer").select(
        key, ingest.decode(key % 7, CHANNELS).alias("channel"), ingest.lower_flag(key % 2 == 0).alias("flag")
    )


@query(
    "tenant_fanout",
    """SELECT c_custkey, c_mktsegment AS client_id FROM customer
UNION ALL SELECT c_custkey, 'partner' FROM customer WHERE c_custkey % 2 = 0""",
)
def tenant_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = m.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    partner = F.when(F.col("c_custkey") % 2 == 0, "partner").otherwise("")
    return ingest.fan_out(rows, [F.col("c_mktsegment"), partner]).drop("c_mktsegment")


@query(
    "active_services",
    """SELECT p_brand AS service, count(*) AS n_rows FROM part
WHERE upper(p_brand) IN ('BRAND#1', 'BRAND#7', 'BRAND#12') GROUP BY p_brand""",
)
def active_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    args = {"PROJECT_ID": "p", "CLIENT_ID": "c", "S3_BUCKET": "b", "ACTIVE_SERVICES": " brand#1, Brand#7 ,,BRAND#12,"}
    asked = parse_params(args, PARAMS.run_ts).active_services
    part = m.table(spark, sf_dir, "part").where(F.upper("p_brand").isin(*asked))
    return part.groupBy(F.col("p_brand").alias("service")).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "parent_inherit",
    """WITH parents AS (SELECT o_orderkey, o_orderpriority AS location, 'project-' || (o_custkey % 5) AS project
  FROM orders WHERE o_orderstatus <> 'P')
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber = 1 THEN 'own' ELSE location END AS location,
  project AS project_id FROM lineitem JOIN parents ON l_orderkey = o_orderkey""",
)
def parent_inherit(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = m.table(spark, sf_dir, "orders")
    parents = orders.select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("order_id"),
        F.col("o_orderpriority").alias("location"),
        F.concat(F.lit("project-"), F.col("o_custkey") % 5).alias("project_id"),
    )
    children = m.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_linenumber") == 1, "own").otherwise("").alias("location")
    )
    return ingest.inherit_parent(children, parents, {"l_orderkey": "order_id"})


def _cluster(key: str) -> str:
    """Customers in threes: one has a cluster to itself, two share one."""
    return f"CASE WHEN {key} % 3 = 0 THEN {key} ELSE {key} - {key} % 3 + 1 END"


@query(
    "pool_default_join",
    f"""WITH pools AS (SELECT {_cluster('c_custkey')} AS cluster_name, 'pool-' || c_custkey AS pool, c_acctbal AS disk
  FROM customer),
sole AS (SELECT cluster_name, any_value(pool) AS pool, any_value(disk) AS disk FROM pools GROUP BY cluster_name
  HAVING count(*) = 1),
rows AS (SELECT event_id, {_cluster('user_id')} AS cluster_name,
  CASE WHEN event_id % 2 = 0 THEN 'pool-' || user_id END AS pool FROM events)
SELECT event_id, r.cluster_name, CASE WHEN n.pool IS NOT NULL THEN n.pool ELSE o.pool END AS node_pool_name,
  CASE WHEN n.pool IS NOT NULL THEN n.disk ELSE o.disk END AS disk
FROM rows r LEFT JOIN pools n ON n.cluster_name = r.cluster_name AND n.pool = r.pool
LEFT JOIN sole o ON o.cluster_name = r.cluster_name""",
)
def pool_default_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    pools = m.table(spark, sf_dir, "customer").select(
        F.expr(_cluster("c_custkey")).alias("cluster_name"),
        F.concat(F.lit("pool-"), F.col("c_custkey")).alias("node_pool_name"),
        F.col("c_acctbal").alias("disk"),
    )
    rows = m.table(spark, sf_dir, "events").select(
        "event_id",
        F.expr(_cluster("user_id")).alias("cluster_name"),
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("pool-"), F.col("user_id"))).alias("node_pool_name"),
    )
    return ingest.default_pool(rows, pools)


FIRST = ["location", "current_node_count", "machine_type"]


@query(
    "first_per_resource",
    """WITH rows AS (SELECT event_id, CAST(user_id AS VARCHAR) AS cluster_name, event_type AS location,
  CASE WHEN event_id % 3 = 0 THEN '' WHEN event_id % 3 = 1 THEN 'x' ELSE CAST(event_id % 9 AS VARCHAR) END AS node_count,
  CASE WHEN event_id % 2 = 0 THEN '' ELSE 'n1-standard-' || (event_id % 8) END AS machine_type FROM events)
SELECT cluster_name, location, coalesce(TRY_CAST(node_count AS DOUBLE), 1) AS current_node_count, machine_type
FROM (SELECT *, row_number() OVER (PARTITION BY cluster_name ORDER BY event_id) AS rn FROM rows) x WHERE rn = 1""",
)
def first_per_resource(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    count = F.when(key % 3 == 0, "").when(key % 3 == 1, "x").otherwise((key % 9).cast("string"))
    rows = m.table(spark, sf_dir, "events").select(
        key,
        F.col("user_id").cast("string").alias("cluster_name"),
        F.col("event_type").alias("location"),
        F.coalesce(count.try_cast("double"), F.lit(1.0)).alias("current_node_count"),
        F.when(key % 2 == 0, "").otherwise(F.concat(F.lit("n1-standard-"), key % 8)).alias("machine_type"),
    )
    return ingest.first_rows(rows, "cluster_name", ["event_id"], FIRST)


@query(
    "account_ordinals",
    """SELECT c_custkey, c_nationkey, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS INTEGER)
  AS job_ordinal, CAST(count(*) OVER (PARTITION BY c_nationkey) AS INTEGER) AS total_jobs_in_account FROM customer""",
)
def account_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = m.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return account_positions(rows, ["c_nationkey"], ["c_custkey"], "job_ordinal", "total_jobs_in_account")


# Upsert and reload -----------------------------------------------------------------------------

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]


@query(
    "upsert_latest",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
  l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_returnflag <> 'A' DESC,
  {', '.join(c + ' DESC' for c in LINE_ORDER)}) AS rn FROM lineitem) x WHERE rn = 1""",
)
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = m.table(spark, sf_dir, "lineitem")
    target, source = lineitem.where("l_returnflag = 'A'"), lineitem.where("l_returnflag <> 'A'")
    merged = upsert.upsert(target, source, LINE_KEY, LINE_ORDER)
    return merged.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@query(
    "config_reload",
    """WITH stored AS (SELECT 'R' || p_partkey AS rule_code, p_brand || '/' || p_type AS service_code, p_size AS threshold
  FROM part),
incoming AS (SELECT 'N' || p_partkey AS rule_code, p_brand || '/' || p_type AS service_code, p_size + 100 AS threshold
  FROM part WHERE p_size = 50)
SELECT * FROM stored WHERE service_code NOT IN (SELECT service_code FROM incoming) UNION ALL SELECT * FROM incoming""",
)
def config_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = m.table(spark, sf_dir, "part")
    service = F.concat_ws("/", "p_brand", "p_type").alias("service_code")
    stored = part.select(F.concat(F.lit("R"), "p_partkey").alias("rule_code"), service, F.col("p_size").alias("threshold"))
    incoming = part.where("p_size = 50").select(
        F.concat(F.lit("N"), "p_partkey").alias("rule_code"), service, (F.col("p_size") + 100).alias("threshold")
    )
    return upsert.reload(stored, incoming)


@query(
    "export_flat",
    m.lines(m.POINTS, m.RESOURCES)
    + f"""SELECT r.resource_id, r.location, r.machine_type, names.metric_name, names.unit, 'PT5M' AS interval,
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS metric_timestamp, value AS metric_value
FROM resources r, (VALUES {', '.join(f"('{n}', 'Ratio')" for n in m.METRIC_NAMES)}, ('{m.UNMAPPED}', 'Bytes'))
  names(metric_name, unit) LEFT JOIN points p ON p.resource_id = r.resource_id AND p.metric_name = names.metric_name""",
)
def export_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    constants = {n: {"unit": "Ratio", "interval": "PT5M"} for n in m.METRIC_NAMES}
    constants[m.UNMAPPED] = {"unit": "Bytes", "interval": "PT5M"}
    points = m.points(spark, sf_dir).select(
        "resource_id",
        "metric_name",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("metric_timestamp"),
        F.col("value").alias("metric_value"),
    )
    clusters = m.resources(spark, sf_dir).select("resource_id", "location", "machine_type")
    return writers.export_flat(clusters, constants, points)


COUNTED = ("customer", "orders", "lineitem", "events", "part", "supplier")


@query(
    "ingest_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in COUNTED),
)
def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.row_counts({t: m.table(spark, sf_dir, t) for t in COUNTED})


# Configuration: one rule per part --------------------------------------------------------------

OPERATORS = {0: "lt", 1: "lte", 2: "gt", 3: "gte", 4: "eq", 5: "near"}


def stored_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = m.table(spark, sf_dir, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    condition = F.struct(
        F.lit("cpu_utilization_avg").alias("metric"),
        m.pick(key % 6, OPERATORS, "lt").alias("operator"),
        size.cast("double").alias("threshold"),
    )
    logic = F.when(key % 3 == 0, "and").when(key % 3 == 1, "OR")
    payload = F.struct(logic.alias("logic"), F.array(condition).alias("conditions"))
    return part.select(
        F.concat(F.lit("RULE_"), key).alias("rule_code"),
        F.col("p_brand").alias("service_code"),
        F.to_json(payload).alias("evaluation_logic"),
        (key % 10 != 0).alias("is_active"),
    )


@query(
    "rules_parse",
    "SELECT 'RULE_' || p_partkey AS rule_code, CASE WHEN p_partkey % 3 = 1 THEN 'OR' ELSE 'AND' END AS logic, "
    + "1 AS n_conditions, CASE p_partkey % 6 "
    + " ".join(f"WHEN {k} THEN '{v}'" for k, v in OPERATORS.items())
    + " END AS operator, CAST(p_size AS DOUBLE) AS threshold FROM part",
)
def rules_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.get("conditions", F.lit(0))
    return rules.parse_rules(stored_rules(spark, sf_dir)).select(
        "rule_code",
        "logic",
        F.size("conditions").alias("n_conditions"),
        first["operator"].alias("operator"),
        first["threshold"].alias("threshold"),
    )


@query(
    "service_rule_config",
    """WITH config AS (SELECT p_brand AS service_code, 'metrics_' || min(p_partkey) AS metrics_table, count(*) % 7 <> 0 AS is_active
  FROM part GROUP BY p_brand)
SELECT 'RULE_' || p_partkey AS rule_code, p_brand AS service_code, metrics_table FROM part JOIN config ON p_brand = service_code
WHERE p_partkey % 10 <> 0 AND config.is_active""",
)
def service_rule_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = m.table(spark, sf_dir, "part")
    config = part.groupBy(F.col("p_brand").alias("service_code")).agg(
        F.concat(F.lit("metrics_"), F.min("p_partkey")).alias("metrics_table"),
        (F.count(F.lit(1)) % 7 != 0).alias("is_active"),
    )
    joined = rules.with_service_config(stored_rules(spark, sf_dir), config)
    return joined.select("rule_code", "service_code", "metrics_table")


# Scalar functions ------------------------------------------------------------------------------


@query(
    "machine_family",
    """SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'e2' WHEN 1 THEN 'n2d' WHEN 2 THEN 'custom' || p_size WHEN 3 THEN 'n2d'
  WHEN 4 THEN '' ELSE 'x9' END AS family FROM part""",
)
def machine_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey") % 6, F.col("p_size").cast("string")
    kind = (
        F.when(key == 0, F.concat(F.lit("e2-standard-"), size))
        .when(key == 1, F.concat(F.lit("n2-d-"), size))
        .when(key == 2, F.concat(F.lit("custom"), size))
        .when(key == 3, "n2d-highmem-4")
        .when(key == 4, "")
        .otherwise("x9-d-1")
    )
    return m.table(spark, sf_dir, "part").select("p_partkey", machine_family(kind).alias("family"))


@query(
    "tiered_price",
    f"""WITH q AS (SELECT c_custkey, c_acctbal / 4 AS millions FROM customer)
SELECT c_custkey, CASE WHEN millions > 0 THEN {r('least(millions, 1000.0) * 0.40 + greatest(0.0, millions - 1000) * 0.20', 4)}
  ELSE 0.0 END AS cost FROM q""",
)
def tiered_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.table(spark, sf_dir, "customer").select("c_custkey", query_cost(F.col("c_acctbal") / 4).alias("cost"))


REGIONS = {0: "us-east1", 1: "northamerica-x", 2: "Europe-west1", 3: "asia-east1", 4: "southamerica-east1", 5: "australia-x", 6: ""}


@query(
    "egress_price",
    """SELECT c_custkey, CASE c_custkey % 8 WHEN 3 THEN CAST(0.14 AS DOUBLE) WHEN 4 THEN 0.12 WHEN 5 THEN 0.19 ELSE 0.08 END
  AS price FROM customer""",
)
def egress_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = m.pick(F.col("c_custkey") % 8, REGIONS, "me-central1")
    return m.table(spark, sf_dir, "customer").select("c_custkey", egress_price(region).alias("price"))


@query(
    "storage_target_class",
    """WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_discount * 20 AS reads,
  CASE l_suppkey % 5 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 ELSE 0 END AS rank FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN reads < 1 AND rank < 1 THEN 'NEARLINE'
  WHEN reads < 0.25 AND rank < 2 THEN 'COLDLINE' WHEN reads < 0.083 AND rank < 3 THEN 'ARCHIVE' END AS target_class,
  CASE WHEN reads < 0.083 AND rank < 3 THEN 'ARCHIVE' WHEN reads < 0.25 AND rank < 2 THEN 'COLDLINE'
  WHEN reads < 1 AND rank < 1 THEN 'NEARLINE' END AS best_class FROM b""",
)
def storage_target_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = m.table(spark, sf_dir, "lineitem")
    current = m.pick(F.col("l_suppkey") % 5, {0: "STANDARD", 1: "NEARLINE", 2: "COLDLINE", 3: "ARCHIVE"}, "OTHER")
    reads = F.col("l_discount") * 20
    return lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        class_for_reads(reads, current).alias("target_class"),
        class_for_reads(reads, current, best_class=True).alias("best_class"),
    )


@query(
    "render_template",
    """SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'Move ' || c_name || ' to ' || c_mktsegment || ' (growing '
  || format('{:.1f}', c_acctbal / 7) || '%)' ELSE 'Keep ' || c_name || ' N/A' END AS text FROM customer""",
)
def render_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    template = F.when(F.col("c_custkey") % 2 == 0, "Move {current_sku} to {target_sku} (growing {growth:.1f}%)").otherwise("")
    values = {
        "current_sku": F.col("c_name"),
        "target_sku": F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise("N/A"),
        "growth:.1f": fixed(F.col("c_acctbal") / 7, 1),
    }
    text = render(template_or(template, "Keep {current_sku} {target_sku}"), values)
    return m.table(spark, sf_dir, "customer").select("c_custkey", text.alias("text"))
