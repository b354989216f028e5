"""Price catalogs: from a raw billing feed to flat machine and component prices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costgauge.functions.numeric import half_even, number
from costgauge.functions.prices import annual_of, hourly_price, machine_hourly, monthly_of
from costgauge.functions.text import COMPUTE_FAMILIES, WORKER_FAMILIES, family_in_description, family_substring
from costgauge.operators.scale import dense_positions, dim_join, positions
from costgauge.sources.local import local_table

# Resource groups that carry compute prices.
COMPUTE_GROUPS = (
    "CPU", "RAM", "N1Standard", "N2Standard", "E2", "C2", "C2D", "N2D", "T2D", "T2A", "N1Highmem", "N1Highcpu",
)
WORKER_GROUPS = tuple(g for g in COMPUTE_GROUPS if g != "T2A")
# Words that mark a price as an add-on.
ADD_ON_WORDS = ("custom", "extended", "sole tenancy", "premium")
# Prices used where the feed has none.
DEFAULT_FAMILY = ("c2", 0.03398, 0.00455)
DEFAULT_COMPONENT_PRICES = {"vpn_tunnel": 0.05, "nat_ip": 0.004}


def _names_any(text: Column, words: Sequence[str]) -> Column:
    hit = F.lit(False)
    for word in words:
        hit = hit | text.contains(word)
    return hit


def compute_skus(feed: DataFrame, region: str, groups: Sequence[str] = COMPUTE_GROUPS, skip_windows: bool = True) -> DataFrame:
    """On-demand compute prices of a region, without spot and (by default) Windows ones."""
    text = F.lower("description")
    skipped = ("preemptible", "spot") + (("windows",) if skip_windows else ())
    return feed.where(
        (F.col("category.resourceFamily") == "Compute")
        & F.col("category.resourceGroup").isin(*groups)
        & (F.col("category.usageType") == "OnDemand")
        & F.array_contains("serviceRegions", region)
        & ~_names_any(text, skipped)
    )


def worker_skus(feed: DataFrame, region: str) -> DataFrame:
    """The same for data pipeline workers: Windows stays, the Arm group goes."""
    return compute_skus(feed, region, WORKER_GROUPS, skip_windows=False)


def network_skus(feed: DataFrame, region: str) -> DataFrame:
    """Prices of a region that belong to a network component, with the component's name."""
    text = F.lower("description")
    component = F.when(
        text.contains("vpn tunnel") & ~text.contains("preemptible"), F.lit("vpn_tunnel")
    ).when(text.contains("cloud nat") | (text.contains("nat") & text.contains("ip")), F.lit("nat_ip"))
    return (
        feed.where(F.array_contains("serviceRegions", region))
        .withColumn("component", component)
        .where(F.col("component").isNotNull())
    )


def _priced(skus: DataFrame, family: Column) -> DataFrame:
    """Prices that name a family and are not zero."""
    return skus.withColumns(
        {"family": family, "resource_group": F.col("category.resourceGroup"), "hourly": hourly_price(F.col("pricingInfo"))}
    ).where(F.col("family").isNotNull() & (F.col("hourly") != 0))


def family_prices_highest(skus: DataFrame) -> DataFrame:
    """CPU and RAM price per family: the highest base price; add-on prices do not count."""
    text = F.lower("description")
    is_memory = (F.col("resource_group") == "RAM") | (
        (F.col("resource_group") == "N1Standard") & _names_any(text, ("ram", "memory"))
    )
    base = ~_names_any(text, ADD_ON_WORDS)
    rows = _priced(skus, family_in_description(F.col("description"), COMPUTE_FAMILIES))
    return rows.groupBy("family").agg(
        F.coalesce(F.max(F.when(base & ~is_memory, F.col("hourly"))), F.lit(0.0)).alias("cpu_hourly_price"),
        F.coalesce(F.max(F.when(base & is_memory, F.col("hourly"))), F.lit(0.0)).alias("ram_hourly_price_per_gb"),
        F.count(F.lit(1)).alias("n_skus"),
    )


def family_prices_first(skus: DataFrame, order: str) -> DataFrame:
    """CPU and RAM price per family: the first non-zero one in feed order."""
    rows = _priced(skus, family_substring(F.col("description"), WORKER_FAMILIES))
    is_memory = F.col("resource_group") == "RAM"

    def first_of(condition: Column) -> Column:
        return F.coalesce(F.min_by(F.when(condition, F.col("hourly")), F.when(condition, F.col(order))), F.lit(0.0))

    return rows.groupBy("family").agg(
        first_of(~is_memory).alias("cpu_hourly_price"),
        first_of(is_memory).alias("ram_hourly_price_per_gb"),
        F.count(F.lit(1)).alias("n_skus"),
    )


def component_prices(skus: DataFrame, order: str) -> DataFrame:
    """First positive price per network component, a default where there is none.

    Components without any price row get their default too; the interconnect is
    billed elsewhere and costs nothing here.
    """
    spark = skus.sparkSession
    priced = skus.withColumn("hourly", hourly_price(F.col("pricingInfo")))
    paid = F.col("hourly") > 0
    found = priced.groupBy("component").agg(
        F.min_by(F.when(paid, F.col("hourly")), F.when(paid, F.col(order))).alias("found")
    )
    defaults = local_table(
        spark, [*DEFAULT_COMPONENT_PRICES.items(), ("interconnect_vlan", 0.0)], "component string, fallback double"
    )
    hourly = F.coalesce("found", "fallback")
    return defaults.join(found, "component", "left").select(
        "component",
        hourly.alias("hourly_price"),
        monthly_of(hourly).alias("monthly_price"),
        annual_of(hourly).alias("annual_price"),
    )


def with_default_family(prices: DataFrame) -> DataFrame:
    """Add the fixed family prices where the feed lacks that family; the feed is read once."""
    family, cpu, ram = DEFAULT_FAMILY
    columns = ["cpu_hourly_price", "ram_hourly_price_per_gb", "n_skus"]
    default = local_table(
        prices.sparkSession,
        [(family, cpu, ram, 2)],
        "family string, cpu_hourly_price double, ram_hourly_price_per_gb double, n_skus bigint",
    )
    both = prices.select("family", *columns, F.lit(0).alias("_rank")).unionByName(default.withColumn("_rank", F.lit(1)))
    first = F.min_by(F.struct(*columns), F.col("_rank"))
    return both.groupBy("family").agg(first.alias("_first")).select("family", "_first.*")


def machine_prices(machines: DataFrame, prices: DataFrame) -> DataFrame:
    """Price every machine of a priced family: hourly, monthly, annual. Families without prices drop."""
    joined = dim_join(machines, prices.select("family", "cpu_hourly_price", "ram_hourly_price_per_gb"), ["family"], "inner")
    priced = joined.withColumn(
        "hourly_price",
        machine_hourly(F.col("vcpus"), F.col("ram_gb"), F.col("cpu_hourly_price"), F.col("ram_hourly_price_per_gb")),
    )
    return priced.withColumns(
        {"monthly_price": monthly_of(F.col("hourly_price")), "annual_price": annual_of(F.col("hourly_price"))}
    ).drop("cpu_hourly_price", "ram_hourly_price_per_gb")


def with_ordinals(machines: DataFrame) -> DataFrame:
    """Rank of the hourly price inside the family, equal prices sharing a rank. The distinct prices are put in order at once."""
    return dense_positions(machines, ["family"], "hourly_price", "ordinal")


def specs(entries: DataFrame) -> DataFrame:
    """Catalog entries with safe numbers and the costs the matcher works with."""
    present = entries.columns
    hourly = number(F.col("hourly_price"))
    ordinal = F.coalesce(F.col("ordinal"), F.lit(999)) if "ordinal" in present else F.lit(999)
    return entries.withColumns(
        {
            "machine_type": F.coalesce("machine_type", F.lit("")),
            "family": F.coalesce("family", F.lit("")) if "family" in present else F.lit(""),
            "vcpus": number(F.col("vcpus")),
            "ram_gb": number(F.col("ram_gb")),
            "hourly_cost": hourly,
            "monthly_cost": half_even(hourly * 730, 4),
            "annual_cost": half_even(hourly * 8760, 4),
            "ordinal": ordinal.cast("int"),
        }
    )


def nested(catalog: DataFrame, chunk_rows: int = 1_000) -> DataFrame:
    """Machines in price order, as lists of ``chunk_rows``: the shape of the catalog file, keyed by family and chunk at every size.

    No row grows with the catalog. The order is taken over all machines at once, so that the many without a price rank are
    spread over tasks as well.
    """
    entry = F.struct(
        "ordinal", "machine_type", "family", "vcpus", "ram_gb", "hourly_price", "monthly_price", "annual_price"
    )
    placed = positions(catalog, ["family"], ["ordinal", "machine_type"], "_place")
    chunk = F.floor((F.col("_place") - 1) / chunk_rows).cast("int")
    return placed.groupBy("family", chunk.alias("chunk")).agg(
        F.array_sort(F.collect_list(entry)).alias("machine_types")
    )


def summary(catalog: DataFrame) -> DataFrame:
    """Families and machine types of a catalog."""
    return catalog.groupBy("family").agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).alias("machine_families"), F.sum("n").alias("machine_types")
    )
