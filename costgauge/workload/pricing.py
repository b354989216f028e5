"""Queries on price feeds and catalogs. The feed has one price entry per part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costgauge.functions.prices import hourly_price
from costgauge.functions.text import COMPUTE_FAMILIES, family_in_description, family_substring
from costgauge.operators import catalog
from costgauge.sources import readers, seeds, writers
from costgauge.workload import models as m
from costgauge.workload.registry import query, r

REGION = "us-central1"
FEED_FAMILIES = tuple(f for f in COMPUTE_FAMILIES if f != "c2")
KINDS = {
    0: "Instance Core running in Americas",
    1: "Instance Ram running in Americas",
    2: "Custom Instance Core running in Americas",
    3: "Spot Preemptible Instance Ram running in Americas",
    4: "Sole Tenancy Memory running in Americas",
    5: "VPN Tunnel running in Americas",
    6: "Preemptible VPN Tunnel",
    7: "Cloud NAT Gateway",
    8: "NAT External IP Charge",
    9: "Windows Server Instance Core",
}
CORE_GROUPS = {0: "CPU", 1: "N1Standard", 2: "E2"}
MEMORY_GROUPS = {0: "RAM", 1: "N1Standard", 2: "RAM"}
PAGE_SIZE = 5000


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw nested price entries."""
    part = m.table(spark, sf_dir, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    family = m.pick((key / 10).cast("bigint") % len(FEED_FAMILIES), dict(enumerate(FEED_FAMILIES)), "")
    kind = key % len(KINDS)
    cents = F.rint(F.col("p_retailprice") * 100).cast("bigint")
    amount = F.struct(
        (cents / 100000).cast("bigint").cast("string").alias("units"), (cents % 100000 * 10000).alias("nanos")
    )
    free = F.struct(F.lit("0").alias("units"), F.lit(0).cast("bigint").alias("nanos"))
    tiers = F.array(F.struct(free.alias("unitPrice")), F.struct(amount.alias("unitPrice")))
    pricing = F.array(F.struct(F.struct(tiers.alias("tieredRates")).alias("pricingExpression")))
    return part.select(
        key.cast("string").alias("skuId"),
        F.concat_ws(" ", "p_name", F.upper(family), m.pick(kind, KINDS, "")).alias("description"),
        F.struct(
            F.when(size % 13 == 0, "Network").otherwise("Compute").alias("resourceFamily"),
            F.when(kind.isin(1, 3, 4), m.pick(size % 3, MEMORY_GROUPS, ""))
            .otherwise(m.pick(size % 3, CORE_GROUPS, ""))
            .alias("resourceGroup"),
            F.when(size % 7 == 0, "Commit1Yr").otherwise("OnDemand").alias("usageType"),
        ).alias("category"),
        F.when(size % 4 == 0, F.array(F.lit("europe-west1")))
        .otherwise(F.array(F.lit(REGION), F.lit("us-east1")))
        .alias("serviceRegions"),
        F.when(size % 17 == 0, F.slice(pricing, 1, 0)).otherwise(pricing).alias("pricingInfo"),
        key.alias("seq"),
    )


def _case(expression: str, table: dict) -> str:
    return f"CASE {expression} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in table.items()) + " END"


FEED = f"""feed AS (
  SELECT CAST(p_partkey AS VARCHAR) AS sku_id, p_partkey AS seq,
         p_name || ' ' || upper({_case(f'(p_partkey // 10) % {len(FEED_FAMILIES)}', dict(enumerate(FEED_FAMILIES)))}) || ' '
           || {_case(f'p_partkey % {len(KINDS)}', KINDS)} AS description,
         CASE WHEN p_size % 13 = 0 THEN 'Network' ELSE 'Compute' END AS resource_family,
         CASE WHEN p_partkey % 10 IN (1, 3, 4) THEN {_case('p_size % 3', MEMORY_GROUPS)}
              ELSE {_case('p_size % 3', CORE_GROUPS)} END AS resource_group,
         CASE WHEN p_size % 7 = 0 THEN 'Commit1Yr' ELSE 'OnDemand' END AS usage_type,
         p_size % 4 <> 0 AS in_region,
         CASE WHEN p_size % 17 = 0 THEN CAST(0 AS DOUBLE)
              ELSE {r('CAST(round(p_retailprice * 100) AS BIGINT) // 100000 + CAST((CAST(round(p_retailprice * 100) AS BIGINT) % 100000) * 10000 AS DOUBLE) / CAST(1000000000 AS DOUBLE)', 8)}
         END AS hourly
  FROM part)"""
COMPUTE_FEED = """compute_feed AS (
  SELECT * FROM feed WHERE resource_family = 'Compute' AND usage_type = 'OnDemand' AND in_region
    AND description NOT ILIKE '%preemptible%' AND description NOT ILIKE '%spot%' AND description NOT ILIKE '%windows%')"""
# Family names that are followed by no letter or digit, longest first.
_FAMILY = "coalesce(" + ", ".join(
    f"CASE WHEN regexp_matches(lower(description), '{f}([^a-z0-9]|$)') THEN '{f}' END"
    for f in sorted(COMPUTE_FAMILIES, key=len, reverse=True)
) + ")"
_SUBSTRING = "coalesce(" + ", ".join(
    f"CASE WHEN contains(lower(description), '{f}') THEN '{f}' END" for f in ("n1", "n2", "n2d", "e2", "c2", "c2d", "t2d")
) + ")"


@query("billing_sku_scan", m.lines(FEED) + "SELECT sku_id, description, resource_group, usage_type FROM feed")
def billing_sku_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = feed(spark, sf_dir)
    row = F.struct(*[c for c in entries.columns if c != "seq"])
    # Pages of the size the price service hands out: bounded lists by construction.
    pages = entries.groupBy((F.col("seq") / PAGE_SIZE).cast("bigint").alias("page")).agg(F.collect_list(row).alias("skus"))
    path = writers.shared_folder(spark, "pages")
    writers.write_pages(pages, path)
    return readers.billing_skus(spark, path, one_per_line=True).select(
        F.col("skuId").alias("sku_id"),
        "description",
        F.col("category.resourceGroup").alias("resource_group"),
        F.col("category.usageType").alias("usage_type"),
    )


@query(
    "sku_filter_compute",
    m.lines(FEED, COMPUTE_FEED)
    + "SELECT sku_id, resource_group, true AS for_nodes FROM compute_feed UNION ALL "
    + "SELECT sku_id, resource_group, false FROM feed WHERE resource_family = 'Compute' AND usage_type = 'OnDemand' "
    + "AND in_region AND description NOT ILIKE '%preemptible%' AND description NOT ILIKE '%spot%'",
)
def sku_filter_compute(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = feed(spark, sf_dir)
    nodes = catalog.compute_skus(entries, REGION).withColumn("for_nodes", F.lit(True))
    workers = catalog.worker_skus(entries, REGION).withColumn("for_nodes", F.lit(False))
    return nodes.unionByName(workers).select(
        F.col("skuId").alias("sku_id"), F.col("category.resourceGroup").alias("resource_group"), "for_nodes"
    )


_COMPONENT = """CASE WHEN description ILIKE '%vpn tunnel%' AND description NOT ILIKE '%preemptible%' THEN 'vpn_tunnel'
  WHEN description ILIKE '%cloud nat%' OR (description ILIKE '%nat%' AND description ILIKE '%ip%') THEN 'nat_ip' END"""


@query(
    "sku_filter_network",
    m.lines(FEED)
    + f"SELECT sku_id, component FROM (SELECT sku_id, {_COMPONENT} AS component FROM feed WHERE in_region) x "
    + "WHERE component IS NOT NULL",
)
def sku_filter_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.network_skus(feed(spark, sf_dir), REGION).select(F.col("skuId").alias("sku_id"), "component")


@query("hourly_price", m.lines(FEED) + "SELECT sku_id, hourly FROM feed")
def hourly_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed(spark, sf_dir).select(F.col("skuId").alias("sku_id"), hourly_price(F.col("pricingInfo")).alias("hourly"))


@query("family_from_desc", m.lines(FEED) + f"SELECT sku_id, {_FAMILY} AS family, {_SUBSTRING} AS naive FROM feed")
def family_from_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed(spark, sf_dir).select(
        F.col("skuId").alias("sku_id"),
        family_in_description(F.col("description")).alias("family"),
        family_substring(F.col("description")).alias("naive"),
    )


HIGHEST = f"""classed AS (
  SELECT {_FAMILY} AS family, hourly,
         resource_group = 'RAM' OR (resource_group = 'N1Standard'
           AND (description ILIKE '%ram%' OR description ILIKE '%memory%')) AS is_memory,
         NOT (description ILIKE '%custom%' OR description ILIKE '%extended%' OR description ILIKE '%sole tenancy%'
           OR description ILIKE '%premium%') AS is_base
  FROM compute_feed WHERE hourly <> 0),
highest AS (
  SELECT family, coalesce(max(hourly) FILTER (WHERE is_base AND NOT is_memory), CAST(0 AS DOUBLE)) AS cpu_hourly_price,
         coalesce(max(hourly) FILTER (WHERE is_base AND is_memory), CAST(0 AS DOUBLE)) AS ram_hourly_price_per_gb,
         count(*) AS n_skus
  FROM classed WHERE family IS NOT NULL GROUP BY family),
with_default AS (
  SELECT * FROM highest UNION ALL
  SELECT * FROM (VALUES ('c2', CAST(0.03398 AS DOUBLE), CAST(0.00455 AS DOUBLE), 2))
  WHERE NOT EXISTS (SELECT 1 FROM highest WHERE family = 'c2'))"""


def node_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.family_prices_highest(catalog.compute_skus(feed(spark, sf_dir), REGION))


@query("family_prices_max", m.lines(FEED, COMPUTE_FEED, HIGHEST) + "SELECT * FROM highest")
def family_prices_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return node_prices(spark, sf_dir)


@query("family_defaults", m.lines(FEED, COMPUTE_FEED, HIGHEST) + "SELECT * FROM with_default")
def family_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.with_default_family(node_prices(spark, sf_dir))


WORKER_FEED = f"""worker_feed AS (
  SELECT {_SUBSTRING} AS family, hourly, seq, resource_group = 'RAM' AS is_memory FROM feed
  WHERE resource_family = 'Compute' AND usage_type = 'OnDemand' AND in_region
    AND description NOT ILIKE '%preemptible%' AND description NOT ILIKE '%spot%' AND hourly <> 0)"""
FIRST = """SELECT family, coalesce(arg_min(hourly, seq) FILTER (WHERE NOT is_memory), CAST(0 AS DOUBLE)) AS cpu_hourly_price,
  coalesce(arg_min(hourly, seq) FILTER (WHERE is_memory), CAST(0 AS DOUBLE)) AS ram_hourly_price_per_gb, count(*) AS n_skus
FROM worker_feed WHERE family IS NOT NULL GROUP BY family"""


@query("family_prices_first", m.lines(FEED, WORKER_FEED) + FIRST)
def family_prices_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.family_prices_first(catalog.worker_skus(feed(spark, sf_dir), REGION), "seq")


@query(
    "component_prices",
    m.lines(
        FEED,
        f"""found AS (SELECT {_COMPONENT} AS component, arg_min(hourly, seq) FILTER (WHERE hourly > 0) AS found
  FROM feed WHERE in_region GROUP BY 1)""",
        """prices AS (SELECT d.component, coalesce(found, fallback) AS hourly_price
  FROM (VALUES ('vpn_tunnel', CAST(0.05 AS DOUBLE)), ('nat_ip', 0.004), ('interconnect_vlan', 0)) d(component, fallback)
  LEFT JOIN found ON d.component = found.component)""",
    )
    + f"""SELECT component, hourly_price, {r('hourly_price * 730', 4)} AS monthly_price,
  {r('hourly_price * 8760', 4)} AS annual_price FROM prices""",
)
def component_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.component_prices(catalog.network_skus(feed(spark, sf_dir), REGION), "seq")


def _seed_values(machines: tuple) -> str:
    rows = seeds.machine_rows(machines)
    return ", ".join(f"('{f}', '{t}', CAST({v} AS DOUBLE), CAST({ram} AS DOUBLE))" for f, t, v, ram in rows)


PRICED = f"""seed AS (SELECT * FROM (VALUES {_seed_values(seeds.COMPUTE_MACHINES)}) t(family, machine_type, vcpus, ram_gb)),
priced AS (
  SELECT seed.*, {r('vcpus * cpu_hourly_price + ram_gb * ram_hourly_price_per_gb', 6)} AS hourly_price
  FROM seed JOIN with_default USING (family))"""


@query(
    "catalog_price",
    m.lines(FEED, COMPUTE_FEED, HIGHEST, PRICED)
    + f"""SELECT *, {r('hourly_price * 730', 4)} AS monthly_price, {r('hourly_price * 8760', 4)} AS annual_price,
  CAST(dense_rank() OVER (PARTITION BY family ORDER BY hourly_price) AS INTEGER) AS ordinal FROM priced""",
)
def catalog_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = catalog.with_default_family(node_prices(spark, sf_dir))
    # The machine list is a fixed seed, so the window over it is bounded.
    return catalog.with_ordinals(catalog.machine_prices(seeds.compute_machines(spark), prices))


@query(
    "worker_catalog_price",
    m.lines(
        FEED,
        WORKER_FEED,
        f"first_prices AS ({FIRST})",
        f"""seed AS (SELECT * FROM (VALUES {_seed_values(seeds.WORKER_MACHINES)}) t(family, machine_type, vcpus, ram_gb))""",
        f"""priced AS (
  SELECT seed.*, {r('vcpus * cpu_hourly_price + ram_gb * ram_hourly_price_per_gb', 6)} AS hourly_price
  FROM seed JOIN first_prices USING (family))""",
    )
    + f"""SELECT *, {r('hourly_price * 730', 4)} AS monthly_price, {r('hourly_price * 8760', 4)} AS annual_price,
  CAST(dense_rank() OVER (PARTITION BY family ORDER BY hourly_price) AS INTEGER) AS ordinal FROM priced""",
)
def worker_catalog_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog of data pipeline workers: the first price in feed order, and no default for a family that the feed lacks."""
    return catalog.with_ordinals(catalog.machine_prices(seeds.worker_machines(spark), family_prices_first(spark, sf_dir)))


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = catalog.with_ordinals(m.machines(spark, sf_dir))
    return flat.withColumns(
        {
            "monthly_price": catalog.monthly_of(F.col("hourly_price")),
            "annual_price": catalog.annual_of(F.col("hourly_price")),
        }
    )


@query(
    "catalog_nest",
    m.lines(
        m.MACHINES,
        """placed AS (SELECT *, (row_number() OVER (PARTITION BY family ORDER BY ordinal, machine_type) - 1) // 1000 AS chunk
  FROM sku)""",
    )
    + """SELECT family, CAST(chunk AS INTEGER) AS chunk, count(*) AS n_types, min(hourly_price) AS cheapest,
  string_agg(machine_type, ',' ORDER BY ordinal, machine_type) AS machine_types FROM placed GROUP BY family, chunk""",
)
def catalog_nest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.nested(_flat(spark, sf_dir)).select(
        "family",
        "chunk",
        F.size("machine_types").cast("bigint").alias("n_types"),
        F.get("machine_types", F.lit(0))["hourly_price"].alias("cheapest"),
        F.array_join("machine_types.machine_type", ",").alias("machine_types"),
    )


@query(
    "sku_catalog_explode",
    m.lines(m.MACHINES)
    + "SELECT family, machine_type, vcpus, ram_gb, hourly_price, monthly_cost AS monthly_price, "
    + "annual_cost AS annual_price, ordinal FROM sku",
)
def sku_catalog_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = writers.shared_folder(spark, "catalog")
    writers.write_catalog(catalog.nested(_flat(spark, sf_dir)), path)
    return readers.catalog_lines(spark, path)


@query(
    "catalog_summary",
    m.lines(m.MACHINES) + "SELECT count(DISTINCT family) AS machine_families, count(*) AS machine_types FROM sku",
)
def catalog_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.summary(m.machines(spark, sf_dir))


def _list_sql(job_type: str, rows: tuple) -> str:
    return ", ".join(
        f"('{job_type}', '{name}', CAST({price} AS DOUBLE), {place})" for place, (name, _, _, price) in enumerate(rows, 1)
    )


@query(
    "sku_catalog_jobtype",
    f"""WITH listed AS (SELECT * FROM (VALUES {_list_sql('batch', seeds.BATCH_WORKERS)},
  {_list_sql('streaming', seeds.STREAMING_WORKERS)}) t(job_type, machine_type, hourly_price, ordinal)),
named AS (SELECT o_orderkey, machine_type FROM orders JOIN listed ON job_type = 'batch' AND ordinal = o_custkey % 31 + 1)
SELECT job_type, l.machine_type, ordinal, hourly_price, count(*) AS n_jobs
FROM named n JOIN listed l ON n.machine_type = l.machine_type GROUP BY ALL""",
)
def sku_catalog_jobtype(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = readers.explode_job_catalog(seeds.worker_sections(spark))
    batch = listed.where("job_type = 'batch'").select("ordinal", "machine_type")
    orders = m.table(spark, sf_dir, "orders").select((F.col("o_custkey") % 31 + 1).cast("int").alias("ordinal"))
    per_type = orders.groupBy("ordinal").agg(F.count(F.lit(1)).alias("n_jobs")).join(batch, "ordinal").drop("ordinal")
    return listed.join(per_type, "machine_type").select("job_type", "machine_type", "ordinal", "hourly_price", "n_jobs")
