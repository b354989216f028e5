"""Model tables as views of the given tables, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costgauge.functions.numeric import half_even
from costgauge.operators.catalog import specs, with_ordinals
from costgauge.operators.features import METRIC_NAMES, utilisation
from costgauge.operators.matching import Catalog
from costgauge.operators.scale import materialised
from costgauge.sources import seeds
from costgauge.workload.registry import r, rs

CPU, MEMORY, POD_CPU, POD_MEMORY = METRIC_NAMES
UNMAPPED = "kubernetes.io/pod/volume/total_bytes"
METRIC_BY_EVENT = {"click": CPU, "view": MEMORY, "purchase": POD_CPU, "signup": POD_MEMORY, "error": UNMAPPED}
RAM_FACTOR = {"ECONOMY": 1, "SMALL": 2, "MEDIUM": 3, "STANDARD": 4, "LARGE": 6}
RUN_TS = "2024-01-31 00:00:00"


# Schemas of the given tables that are read here; a declared schema saves a job per reader.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def pick(value: Column, table: dict, other: object) -> Column:
    """Value looked up in a small fixed table."""
    return F.coalesce(*[F.when(value == k, F.lit(v)) for k, v in table.items()], F.lit(other))


def sql_case(column: str, table: dict, other: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN " + (f"'{v}'" if isinstance(v, str) else str(v)) for k, v in table.items())
    return f"CASE {column} {whens} ELSE {other} END"


# Metric points: one per event; every tenth has the value zero.
def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    live = F.when(F.col("event_id") % 10 != 0, F.col("value")).otherwise(0.0)
    return events.select(
        F.col("user_id").cast("string").alias("resource_id"),
        pick(F.col("event_type"), METRIC_BY_EVENT, "").alias("metric_name"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.least(live, F.lit(100.0)) / 100).alias("value"),
        "event_id",
    )


POINTS = f"""points AS (
  SELECT CAST(user_id AS VARCHAR) AS resource_id, {sql_case('event_type', METRIC_BY_EVENT, "''")} AS metric_name, ts,
         least(CASE WHEN event_id % 10 <> 0 THEN value ELSE 0.0 END, 100.0) / 100 AS value, event_id
  FROM events)"""


# Resources: one per customer.
def resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    n_parts = table(spark, sf_dir, "part").agg(F.count(F.lit(1))).scalar()
    placed = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    return placed.select(
        F.col("c_custkey").cast("string").alias("resource_id"),
        F.col("r_name").alias("client_id"),
        F.col("c_mktsegment").alias("account_id"),
        F.col("n_name").alias("location"),
        ((F.col("c_custkey") * 7) % n_parts).cast("string").alias("machine_type"),
        (F.col("c_custkey") % 5 + 1).cast("double").alias("current_node_count"),
    )


RESOURCES = """resources AS (
  SELECT CAST(c_custkey AS VARCHAR) AS resource_id, r_name AS client_id, c_mktsegment AS account_id, n_name AS location,
         CAST((c_custkey * 7) % (SELECT count(*) FROM part) AS VARCHAR) AS machine_type,
         CAST(c_custkey % 5 + 1 AS DOUBLE) AS current_node_count
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


# Machines: one per part, priced by size.
def machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    sized = part.select(
        F.col("p_brand").alias("family"),
        F.col("p_partkey").cast("string").alias("machine_type"),
        F.col("p_size").cast("double").alias("vcpus"),
        (F.col("p_size") * pick(F.col("p_type"), RAM_FACTOR, 8)).cast("double").alias("ram_gb"),
    )
    return sized.withColumn("hourly_price", half_even(F.col("vcpus") * 0.0316 + F.col("ram_gb") * 0.0042, 6))


MACHINES = f"""machines AS (
  SELECT p_brand AS family, CAST(p_partkey AS VARCHAR) AS machine_type, CAST(p_size AS DOUBLE) AS vcpus,
         CAST(p_size * {sql_case('p_type', RAM_FACTOR, '8')} AS DOUBLE) AS ram_gb FROM part),
priced AS (
  SELECT *, {r('vcpus * 0.0316 + ram_gb * 0.0042', 6)} AS hourly_price FROM machines),
sku AS (
  SELECT *, CAST(dense_rank() OVER (PARTITION BY family ORDER BY hourly_price) AS INTEGER) AS ordinal,
         {r('hourly_price * 730', 4)} AS monthly_cost, {r('hourly_price * 8760', 4)} AS annual_cost FROM priced)"""


def compute_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """The part-based catalog with ordinals and costs, ranked and stored once for all its uses."""
    entries = materialised(specs(with_ordinals(machines(spark, sf_dir))).drop("hourly_price"))
    # A part is listed once, so its type needs no choice between families.
    return Catalog(entries, "family", unique=True)


def worker_catalog(spark: SparkSession) -> Catalog:
    """The pipeline worker list: a fixed seed of 39 rows."""
    entries = specs(seeds.worker_catalog(spark)).drop("hourly_price")
    return Catalog(entries, "job_type")


# Utilisation per user over the whole period, and per user and day.
def user_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return utilisation(points(spark, sf_dir), ["resource_id"])


def daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = points(spark, sf_dir).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return utilisation(dated, ["resource_id", "day"])


def _utilisation_sql(keys: str, source: str) -> str:
    columns = ", ".join(
        f"{rs(f'''avg(value) FILTER (WHERE metric_name = '{m}') * 100''', 4)} AS {n}" for m, n in METRIC_NAMES.items()
    )
    return f"SELECT {keys}, {columns} FROM {source} WHERE value > 0 AND metric_name <> '' GROUP BY {keys}"


USER_METRICS = f"user_metrics AS ({_utilisation_sql('resource_id', 'points')})"
DAILY_METRICS = (
    "daily_metrics AS ("
    + _utilisation_sql("resource_id, day", "(SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM points)")
    + ")"
)
HAS_METRICS = " OR ".join(f"{n} IS NOT NULL" for n in METRIC_NAMES.values())


def with_any_metric(df: DataFrame) -> DataFrame:
    """Rows with at least one known metric."""
    present = F.lit(False)
    for n in METRIC_NAMES.values():
        present = present | F.col(n).isNotNull()
    return df.where(present)


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workloads per user and day: id, machine, node count, utilisation."""
    daily = with_any_metric(daily_metrics(spark, sf_dir))
    joined = daily.join(resources(spark, sf_dir), "resource_id")
    return joined.withColumn("resource_id", F.concat_ws("|", "resource_id", "day")).drop("day")


WINDOWS = f"""windows AS (
  SELECT m.resource_id || '|' || m.day AS resource_id, r.client_id, r.account_id, r.location, r.machine_type,
         r.current_node_count, {', '.join(METRIC_NAMES.values())}
  FROM daily_metrics m JOIN resources r ON m.resource_id = r.resource_id WHERE {HAS_METRICS})"""
IDLE_SQL = "coalesce(cpu_utilization_avg, 0) < 5 AND coalesce(memory_utilization_avg, 0) < 20"
OVER_SQL = "(coalesce(cpu_utilization_avg, 0) < 40 OR coalesce(memory_utilization_avg, 0) < 50)"


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workloads per user over the whole period."""
    return with_any_metric(user_metrics(spark, sf_dir)).join(resources(spark, sf_dir), "resource_id")


USERS = f"""users AS (
  SELECT m.*, r.client_id, r.account_id, r.location, r.machine_type, r.current_node_count
  FROM user_metrics m JOIN resources r ON m.resource_id = r.resource_id WHERE {HAS_METRICS})"""


def lines(*parts: str) -> str:
    """WITH clause from named parts."""
    return "WITH " + ",\n".join(parts) + "\n"
