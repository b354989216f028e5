"""Price expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from costgauge.functions.numeric import HOURS_PER_MONTH, HOURS_PER_YEAR, half_even

# List prices.
QUERY_PRICE_FIRST_TIER = 0.40
QUERY_PRICE_SECOND_TIER = 0.20
QUERY_FIRST_TIER_MILLIONS = 1000.0
EGRESS_PRICE_DEFAULT = 0.08
EGRESS_PRICES = (
    ("US", 0.08),
    ("NORTHAMERICA", 0.08),
    ("EUROPE", 0.08),
    ("ASIA", 0.14),
    ("SOUTHASIA", 0.14),
    ("SOUTHAMERICA", 0.12),
    ("AUSTRALIA", 0.19),
)
STORAGE_CLASSES = ("STANDARD", "NEARLINE", "COLDLINE", "ARCHIVE")
STORAGE_PRICE_PER_GB = {"STANDARD": 0.020, "NEARLINE": 0.010, "COLDLINE": 0.004, "ARCHIVE": 0.0012}
STORAGE_RETRIEVAL_PER_GB = {"STANDARD": 0.0, "NEARLINE": 0.01, "COLDLINE": 0.02, "ARCHIVE": 0.05}
STORAGE_READ_LIMITS = ((1.0, "NEARLINE"), (0.25, "COLDLINE"), (0.083, "ARCHIVE"))


def hourly_price(pricing_info: Column) -> Column:
    """First positive tier of the first pricing entry, in dollars; 0.0 where there is none."""
    tiers = F.get(pricing_info, F.lit(0))["pricingExpression"]["tieredRates"]
    amounts = F.transform(
        tiers,
        lambda t: F.coalesce(t["unitPrice"]["units"].try_cast("double"), F.lit(0.0))
        + F.coalesce(t["unitPrice"]["nanos"].cast("double"), F.lit(0.0)) / 1e9,
    )
    return F.coalesce(half_even(F.get(F.filter(amounts, lambda p: p > 0), F.lit(0)), 8), F.lit(0.0))


def monthly_of(hourly: Column) -> Column:
    return half_even(hourly * HOURS_PER_MONTH, 4)


def annual_of(hourly: Column) -> Column:
    return half_even(hourly * HOURS_PER_YEAR, 4)


def yearly_price(hourly: Column) -> Column:
    """Default yearly price of a target: hourly x 8760 in cents, 0.0 without a target."""
    return F.coalesce(half_even(hourly * HOURS_PER_YEAR, 2), F.lit(0.0))


def machine_hourly(vcpus: Column, ram_gb: Column, cpu_price: Column, ram_price: Column) -> Column:
    return half_even(vcpus * cpu_price + ram_gb * ram_price, 6)


def query_cost(millions: Column) -> Column:
    """Monthly cost of DNS queries, two tiers."""
    first = F.least(millions, F.lit(QUERY_FIRST_TIER_MILLIONS)) * QUERY_PRICE_FIRST_TIER
    second = F.greatest(F.lit(0.0), millions - QUERY_FIRST_TIER_MILLIONS) * QUERY_PRICE_SECOND_TIER
    return F.when(millions > 0, half_even(first + second, 4)).otherwise(F.lit(0.0))


def egress_price(region: Column) -> Column:
    """Price per GB by region prefix."""
    name = F.upper(F.coalesce(region, F.lit("")))
    return F.coalesce(
        *[F.when(name.startswith(prefix), F.lit(price)) for prefix, price in EGRESS_PRICES],
        F.lit(EGRESS_PRICE_DEFAULT),
    )


def _by_class(storage_class: Column, table: dict[str, float | int]) -> Column:
    """Value of a storage class; unknown classes count as the first one."""
    return F.coalesce(
        *[F.when(storage_class == name, F.lit(value)) for name, value in table.items()],
        F.lit(table[STORAGE_CLASSES[0]]),
    )


def storage_price(storage_class: Column) -> Column:
    return _by_class(storage_class, STORAGE_PRICE_PER_GB)


def retrieval_price(storage_class: Column) -> Column:
    return _by_class(storage_class, STORAGE_RETRIEVAL_PER_GB)


def class_rank(storage_class: Column) -> Column:
    return _by_class(storage_class, {name: i for i, name in enumerate(STORAGE_CLASSES)})


def colder_class(storage_class: Column) -> Column:
    """Next colder class; unknown classes go to the second one, the coldest stays."""
    following = dict(zip(STORAGE_CLASSES, STORAGE_CLASSES[1:] + STORAGE_CLASSES[-1:]))
    return F.coalesce(
        *[F.when(storage_class == name, F.lit(nxt)) for name, nxt in following.items()], F.lit(STORAGE_CLASSES[1])
    )


def class_for_reads(reads_per_month: Column, storage_class: Column, best_class: bool = False) -> Column:
    """Colder class by access frequency, null where no colder one applies.

    Limits are tried loosest first; ``best_class`` tries the tightest first.
    """
    limits = STORAGE_READ_LIMITS[::-1] if best_class else STORAGE_READ_LIMITS
    rank = class_rank(storage_class)
    return F.coalesce(
        *[
            F.when((reads_per_month < limit) & (rank < STORAGE_CLASSES.index(target)), F.lit(target))
            for limit, target in limits
        ]
    )
