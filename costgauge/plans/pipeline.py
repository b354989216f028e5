"""Dispatch of fired rules to recommenders, and the portfolio summary."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costgauge.functions.numeric import stable
from costgauge.operators.matching import Catalog
from costgauge.plans import machines, messaging, network, storage
from costgauge.plans.contract import as_report


@dataclass(frozen=True)
class Prices:
    """Price tables the recommenders share."""

    compute: Catalog | None = None
    workers: Catalog | None = None
    components: DataFrame | None = None


Recommender = Callable[[DataFrame, Prices], DataFrame]

RECOMMENDERS: dict[str, Recommender] = {
    "GKE_IDLE": lambda rows, p: machines.idle(rows, p.compute, machines.GKE),
    "GKE_OVERPROVISIONED": lambda rows, p: machines.overprovisioned(rows, p.compute, machines.GKE),
    "DATAFLOW_IDLE": lambda rows, p: machines.idle(rows, p.workers, machines.DATAFLOW),
    "DATAFLOW_OVERPROVISIONED": lambda rows, p: machines.overprovisioned(rows, p.workers, machines.DATAFLOW),
    "CLOUDROUTER_IDLE": lambda rows, p: network.router_idle(rows, p.components),
    "CLOUDROUTER_NAT_OVERPROVISIONED": lambda rows, p: network.router_nat(rows, p.components),
    "PUBSUB_IDLE": lambda rows, p: messaging.pubsub_idle(rows),
    "PUBSUB_OVERPROVISIONED": lambda rows, p: messaging.pubsub_overprovisioned(rows),
    "CLOUDSCHEDULER_IDLE": lambda rows, p: messaging.scheduler_idle(rows),
    "CLOUDSCHEDULER_OVERPROVISIONED": lambda rows, p: messaging.scheduler_overprovisioned(rows),
    "CLOUDSTORAGE_IDLE": lambda rows, p: storage.storage_idle(rows),
    "CLOUDSTORAGE_OVERPROVISIONED": lambda rows, p: storage.storage_overprovisioned(rows),
    "CLOUDCDN_IDLE": lambda rows, p: network.cdn_idle(rows),
    "CLOUDCDN_OVERPROVISIONED": lambda rows, p: network.cdn_overprovisioned(rows),
    "CLOUDDNS_IDLE": lambda rows, p: network.dns_idle(rows),
    "CLOUDDNS_OVERPROVISIONED": lambda rows, p: network.dns_overprovisioned(rows),
}


def register(rule_code: str, recommender: Recommender) -> None:
    """Add or replace the recommender of a rule code."""
    RECOMMENDERS[rule_code.upper()] = recommender


def recommend(fired: Mapping[str, DataFrame], prices: Prices) -> DataFrame:
    """Recommendations for the fired rows of each rule code, as one report.

    Codes no recommender knows give nothing; see ``rules.unhandled``.
    """
    parts = [as_report(RECOMMENDERS[code](rows, prices)) for code, rows in fired.items() if code in RECOMMENDERS]
    if not parts:
        raise ValueError(f"no recommender for any of {sorted(fired)}")
    return reduce(lambda a, b: a.unionByName(b), parts)


def recommend_fired(fired: DataFrame, codes: list[str], prices: Prices) -> DataFrame:
    """The same for one table of fired rows with a ``rule_code`` column."""
    return recommend({c: fired.where(F.col("rule_code") == c).drop("rule_code") for c in codes}, prices)


def summary(recommendations: DataFrame) -> DataFrame:
    """Recommendations and savings per rule and in all (null rule), in one pass over the report.

    ``savings_once`` counts a resource's best recommendation only, because an
    idle resource is overprovisioned as well.
    """
    per_rule = recommendations.groupBy("resource_id", "rule_code").agg(
        F.count(F.lit(1)).alias("n"), F.sum("annual_savings").alias("savings"), F.max("annual_savings").alias("top")
    )
    # One entry per rule that fired on the resource.
    per_resource = per_rule.groupBy("resource_id").agg(
        F.max(F.struct("top", "rule_code")).alias("best"),
        F.collect_list(F.struct("rule_code", "n", "savings")).alias("entries"),
    )
    rows = per_resource.select("best", F.inline("entries"))
    once = F.when(F.col("rule_code") == F.col("best.rule_code"), F.col("best.top"))
    totals = rows.groupBy("rule_code").agg(
        F.sum("n").alias("n"), F.sum("savings").alias("savings"), F.sum(once).alias("once")
    )
    both = totals.rollup("rule_code").agg(
        F.sum("n").alias("recommendations"),
        F.sum("savings").alias("_savings"),
        F.coalesce(F.sum("once"), F.lit(0.0)).alias("_once"),
    )
    return both.select(
        "rule_code",
        "recommendations",
        stable(F.col("_savings"), 2).alias("total_annual_savings"),
        stable(F.col("_once"), 2).alias("savings_once"),
    )
