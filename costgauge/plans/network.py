"""Recommendations for routers, CDN origins and DNS zones.

Fixed values: the sentences of the recommendations and the names of their details.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costgauge.functions.numeric import (
    HOURS_PER_MONTH,
    HOURS_PER_YEAR,
    MONTHS_PER_YEAR,
    count_or_one,
    half_even,
    number,
)
from costgauge.functions.prices import egress_price, query_cost
from costgauge.functions.text import fixed, join_present
from costgauge.plans.contract import either, no_targets, optional, recommendation, target_sku, text_of

ZONE_FEE_PER_MONTH = 0.20
FREE_ZONES = 25


def _with_price(rows: DataFrame, prices: DataFrame, component: str, default: float) -> DataFrame:
    """The component's hourly price on every row, as a scalar subquery; no rows where the component is not listed.

    A component listed for several regions has the price of the first region by name that states one.
    """
    listed = prices.where(F.col("component") == component)
    by = F.when(F.col("hourly_price").isNotNull(), F.struct(*[c for c in ("region", "hourly_price") if c in prices.columns]))
    price = listed.agg(
        F.when(F.count(F.lit(1)) > 0, number(F.coalesce(F.min_by("hourly_price", by), F.lit(default))))
    )
    return rows.withColumn("_hourly", price.scalar()).where(F.col("_hourly").isNotNull())


def router_idle(routers: DataFrame, prices: DataFrame) -> DataFrame:
    """Idle routers cost their VPN tunnels."""
    rows = _with_price(routers, prices, "vpn_tunnel", 0.05)
    rows = rows.withColumn("_tunnels", count_or_one(optional(rows, "vpn_tunnel_count", 1.0)))
    rows = rows.withColumns(
        {
            "_name": optional(rows, "router_name", "unknown", "string"),
            "_annual": half_even(F.col("_hourly") * HOURS_PER_YEAR * F.col("_tunnels"), 2),
            "_monthly": half_even(F.col("_hourly") * HOURS_PER_MONTH * F.col("_tunnels"), 2),
        }
    )
    text = text_of(
        rows,
        "Idle Cloud Router — no active BGP sessions or NAT usage, consider deleting (router: {current_sku})",
        {"current_sku": F.col("_name"), "target_sku": F.lit("N/A")},
    )
    return recommendation(
        rows,
        "CLOUDROUTER_IDLE",
        text,
        F.col("_annual"),
        F.lit(0.0),
        F.col("_annual"),
        {
            "router_name": F.col("_name"),
            "tunnel_count": F.col("_tunnels"),
            "current_sku": F.struct(F.col("_hourly").alias("hourly_price"), F.col("_annual").alias("annual_cost")),
            "target_skus": no_targets(),
            "monthly_savings": F.col("_monthly"),
            "annual_savings": F.col("_annual"),
        },
    )


def router_nat(routers: DataFrame, prices: DataFrame) -> DataFrame:
    """Fewer NAT addresses where the ports in use need fewer; no row without a gain."""
    rows = _with_price(routers, prices, "nat_ip", 0.004)
    rows = rows.withColumns(
        {
            "_ips": count_or_one(optional(rows, "nat_ip_count", 1.0)),
            "_used": number(optional(rows, "nat_port_usage_p95")),
            "_allocated": number(optional(rows, "nat_allocated_ports_avg")),
            "_name": optional(rows, "router_name", "unknown", "string"),
        }
    )
    by_use = F.rint(F.col("_ips") * (F.col("_used") / F.nullif("_allocated", F.lit(0.0))) * 1.2)
    needed = F.when((F.col("_allocated") > 0) & (F.col("_used") > 0), by_use).otherwise(F.rint(F.col("_ips") * 0.5))
    rows = rows.withColumn("_needed", F.greatest(F.lit(1.0), needed)).where(F.col("_needed") < F.col("_ips"))
    rows = rows.withColumns(
        {
            "_current": half_even(F.col("_hourly") * HOURS_PER_YEAR * F.col("_ips"), 2),
            "_target": half_even(F.col("_hourly") * HOURS_PER_YEAR * F.col("_needed"), 2),
        }
    ).withColumn("_gain", F.col("_current") - F.col("_target"))
    rows = rows.withColumns({"_savings": half_even(F.col("_gain"), 2), "_monthly": half_even(F.col("_gain") / 12, 2)})
    text = text_of(
        rows,
        "Overprovisioned Cloud NAT — reduce NAT IPs from {current_sku} to {target_sku}",
        {"current_sku": F.col("_ips").cast("string"), "target_sku": F.col("_needed").cast("bigint").cast("string")},
    )
    return recommendation(
        rows,
        "CLOUDROUTER_NAT_OVERPROVISIONED",
        text,
        F.col("_current"),
        F.col("_target"),
        F.col("_savings"),
        {
            "router_name": F.col("_name"),
            "current_nat_ip_count": F.col("_ips"),
            "recommended_nat_ip_count": F.col("_needed").cast("bigint"),
            "port_usage_p95": F.col("_used"),
            "allocated_ports_avg": F.col("_allocated"),
            "current_sku": F.struct(F.col("_ips").alias("nat_ip_count"), F.col("_current").alias("annual_cost")),
            "target_skus": F.array(
                F.struct(F.col("_needed").cast("bigint").alias("nat_ip_count"), F.col("_target").alias("annual_cost"))
            ),
            "monthly_savings": F.col("_monthly"),
            "annual_savings": F.col("_savings"),
        },
    )


def _cdn_inputs(origins: DataFrame) -> DataFrame:
    egress, hit = either(origins, "egress_gb_monthly"), number(optional(origins, "cache_hit_ratio"))
    return origins.withColumns(
        {
            "_egress": egress,
            "_hit": hit,
            "_requests": number(optional(origins, "request_count_monthly")),
            "_sent": either(origins, "sent_bytes_gb", egress),
            "_edge_hit": either(origins, "edge_cache_hit_ratio", hit),
            "_miss": number(optional(origins, "miss_ratio_pct")),
            "_latency": either(origins, "backend_latency_p95_ms"),
            "_mode": optional(origins, "cache_mode", "CACHE_ALL_STATIC", "string"),
            "_price": egress_price(F.col("region")),
        }
    )


def cdn_idle(origins: DataFrame) -> DataFrame:
    """Idle origins by any of three signals; all egress cost is saved."""
    rows = _cdn_inputs(origins)
    signals = F.array_compact(
        F.array(
            F.when(F.col("_requests") == 0, F.lit("zero requests (14-30 days)")),
            F.when(F.col("_sent") == 0, F.lit("zero edge bytes served (sent_bytes_count = 0)")),
            F.when((F.col("_hit") == 0) | (F.col("_edge_hit") == 0), F.lit("cache never used (cache_hit_ratio = 0%)")),
        )
    )
    rows = rows.withColumns(
        {"_signals": signals, "_monthly": half_even(F.col("_egress") * F.col("_price"), 4)}
    )
    generic = F.array(F.lit("no meaningful CDN traffic over 14-30 days"))
    rows = rows.withColumns(
        {
            "_signals": F.when(F.size("_signals") > 0, F.col("_signals")).otherwise(generic),
            "_annual": half_even(F.col("_monthly") * MONTHS_PER_YEAR, 2),
        }
    )
    reason = F.array_join("_signals", "; ")
    text = text_of(
        rows,
        "Idle Cloud CDN origin — disable CDN or delete backend service {current_sku} ({reason})",
        {"current_sku": F.col("origin_name"), "target_sku": F.lit("N/A"), "reason": reason},
    )
    return recommendation(
        rows,
        "CLOUDCDN_IDLE",
        text,
        F.col("_annual"),
        F.lit(0.0),
        F.col("_annual"),
        {
            "origin_name": F.col("origin_name"),
            "region": F.col("region"),
            "egress_gb_monthly": F.col("_egress"),
            "sent_bytes_gb": F.col("_sent"),
            "cache_hit_ratio": F.col("_hit"),
            "edge_cache_hit_ratio": F.col("_edge_hit"),
            "request_count_monthly": F.col("_requests"),
            "triggered_signals": F.col("_signals"),
            "egress_price_per_gb": F.col("_price"),
            "monthly_cost": F.col("_monthly"),
            "annual_cost": F.col("_annual"),
            "monthly_savings": F.col("_monthly"),
            "annual_savings": F.col("_annual"),
            "reason": reason,
            "target_skus": no_targets(),
        },
    )


def cdn_overprovisioned(origins: DataFrame) -> DataFrame:
    """Origins below their hit target, with many misses or a slow backend; no row where all is well."""
    rows = _cdn_inputs(origins)
    rows = rows.withColumn("_goal", F.when(F.upper("_mode").contains("DYNAMIC"), 60.0).otherwise(80.0))
    hit, goal, miss, latency = F.col("_hit"), F.col("_goal"), F.col("_miss"), F.col("_latency")
    rows = rows.where((hit < goal) | (miss > 20) | (latency > 500))
    poor, below = hit < 30, (hit >= 30) & (hit < goal)
    hit_text, goal_text, miss_text, latency_text = fixed(hit, 0), fixed(goal, 0), fixed(miss, 0), fixed(latency, 0)
    signals = F.array_compact(
        F.array(
            F.when(poor, F.concat(F.lit("cache_hit_ratio="), hit_text, F.lit("% < 30% — CDN is ineffective"))),
            F.when(below, F.concat(F.lit("cache_hit_ratio="), hit_text, F.lit("% below target "), goal_text, F.lit("%"))),
            F.when(miss > 20, F.concat(F.lit("miss_ratio="), miss_text, F.lit("% > 20% — high origin load"))),
            F.when(
                latency > 500,
                F.concat(F.lit("backend_latency P95="), latency_text, F.lit("ms > 500ms — slow origin")),
            ),
        )
    )
    action = join_present(
        "; ",
        F.when(
            poor,
            F.concat(
                F.lit("force aggressive caching (cache_hit_ratio="),
                hit_text,
                F.lit("% < 30% — paying CDN premium for origin traffic)"),
            ),
        ),
        F.when(
            below,
            F.concat(
                F.lit("optimize TTL and cache keys to improve hit ratio from "), hit_text, F.lit("% to "), goal_text, F.lit("%")
            ),
        ),
        F.when(miss > 20, F.concat(F.lit("reduce cache misses (current miss rate "), miss_text, F.lit("% > 20%)"))),
        F.when(
            latency > 500,
            F.concat(
                F.lit("tune origin TTL/cache mode to reduce origin latency (P95="), latency_text, F.lit("ms > 500ms)")
            ),
        ),
    )
    improvement = F.greatest(F.lit(0.0), (goal - hit) / 100.0)
    rows = rows.withColumns(
        {
            "_signals": signals,
            "_action": action,
            "_current_monthly": half_even(F.col("_egress") * F.col("_price"), 4),
            "_raw_gb": F.col("_egress") * improvement,
        }
    )
    rows = rows.withColumn("_saved_gb", half_even(F.col("_raw_gb"), 4))
    rows = rows.withColumn("_saved_monthly", half_even(F.col("_saved_gb") * F.col("_price"), 4))
    rows = rows.withColumn("_target_monthly", half_even(F.col("_current_monthly") - F.col("_saved_monthly"), 4))
    rows = rows.withColumns(
        {
            "_current": half_even(F.col("_current_monthly") * MONTHS_PER_YEAR, 2),
            "_target": half_even(F.col("_target_monthly") * MONTHS_PER_YEAR, 2),
            "_savings": half_even(F.col("_saved_monthly") * MONTHS_PER_YEAR, 2),
        }
    )
    label = F.concat(goal_text, F.lit("% hit ratio"))
    text = text_of(
        rows,
        "Overprovisioned Cloud CDN — {action} (current: {current_sku})",
        {"current_sku": F.col("origin_name"), "target_sku": label, "action": F.col("_action")},
    )
    return recommendation(
        rows,
        "CLOUDCDN_OVERPROVISIONED",
        text,
        F.col("_current"),
        F.col("_target"),
        F.col("_savings"),
        {
            "origin_name": F.col("origin_name"),
            "region": F.col("region"),
            "cache_mode": F.col("_mode"),
            "cache_hit_ratio_current": hit,
            "cache_hit_ratio_target": goal,
            "miss_ratio_pct": miss,
            "backend_latency_p95_ms": latency,
            "egress_gb_monthly": F.col("_egress"),
            "origin_traffic_reduction_gb": F.col("_saved_gb"),
            "egress_price_per_gb": F.col("_price"),
            "monthly_cost_current": F.col("_current_monthly"),
            "monthly_cost_target": F.col("_target_monthly"),
            "monthly_savings": F.col("_saved_monthly"),
            "annual_savings": F.col("_savings"),
            "signals_fired": F.col("_signals"),
            "action": F.col("_action"),
            "target_skus": target_sku(label, F.col("_target_monthly")),
        },
    )


def _zone_type(zones: DataFrame) -> Column:
    return F.upper(F.coalesce(F.nullif(optional(zones, "zone_type", "PUBLIC", "string"), F.lit("")), F.lit("PUBLIC")))


def dns_idle(zones: DataFrame) -> DataFrame:
    """Idle zones cost their fee beyond the free ones, and their queries if public."""
    rows = zones.withColumns(
        {
            "_type": _zone_type(zones),
            "_ordinal": number(optional(zones, "zone_ordinal", float(FREE_ZONES + 1))),
            "_queries": number(optional(zones, "query_count_millions")),
            "_records": number(optional(zones, "record_set_count")),
            "_days": number(optional(zones, "days_since_last_update")),
        }
    )
    rows = rows.withColumns(
        {
            "_billable": F.col("_ordinal") > FREE_ZONES,
            "_query_monthly": F.when(F.col("_type") == "PUBLIC", query_cost(F.col("_queries"))).otherwise(F.lit(0.0)),
        }
    )
    rows = rows.withColumn("_fee", F.when(F.col("_billable"), ZONE_FEE_PER_MONTH).otherwise(0.0))
    rows = rows.withColumn("_monthly", half_even(F.col("_fee") + F.col("_query_monthly"), 4))
    rows = rows.withColumn("_annual", half_even(F.col("_monthly") * MONTHS_PER_YEAR, 2))
    silent = F.col("_queries") == 0
    reason = (
        F.when(
            (F.col("_records") < 5) & silent,
            F.concat(F.lit("< 5 records ("), F.col("_records").cast("bigint"), F.lit(") and zero queries")),
        )
        .when(
            (F.col("_days") > 90) & silent,
            F.concat(
                F.lit("no zone updates in "),
                F.col("_days").cast("bigint"),
                F.lit(" days (update_time metadata) and zero queries"),
            ),
        )
        .otherwise(F.lit("zero or near-zero query volume over 14-30 days"))
    )
    rows = rows.withColumn("_reason", reason)
    text = text_of(
        rows,
        "Idle Cloud DNS zone — delete {current_sku} ({reason})",
        {"current_sku": F.col("zone_name"), "target_sku": F.lit("N/A"), "reason": F.col("_reason")},
    )
    return recommendation(
        rows,
        "CLOUDDNS_IDLE",
        text,
        F.col("_annual"),
        F.lit(0.0),
        F.col("_annual"),
        {
            "zone_name": F.col("zone_name"),
            "zone_type": F.col("_type"),
            "record_set_count": F.col("_records"),
            "days_since_last_update": F.col("_days"),
            "query_count_millions_per_month": F.col("_queries"),
            "is_billable_zone": F.col("_billable"),
            "zone_monthly_fee": F.col("_fee"),
            "query_monthly_cost": F.col("_query_monthly"),
            "monthly_cost": F.col("_monthly"),
            "annual_cost": F.col("_annual"),
            "monthly_savings": F.col("_monthly"),
            "annual_savings": F.col("_annual"),
            "reason": F.col("_reason"),
            "target_skus": no_targets(),
        },
    )


def dns_overprovisioned(zones: DataFrame) -> DataFrame:
    """Orphaned forwarding zones go; busy zones get fewer queries; no row otherwise.

    The zone fee is always charged here, and the target prices the queries of
    private zones too, so their savings can be negative.
    """
    rows = zones.withColumns(
        {
            "_type": _zone_type(zones),
            "_queries": number(optional(zones, "query_count_millions")),
            "_reachable": number(optional(zones, "forwarding_targets_reachable", 1.0)),
        }
    )
    rows = rows.withColumn("_orphan", (F.col("_type") == "FORWARDING") & (F.col("_reachable") == 0))
    rows = rows.where(F.col("_orphan") | (F.col("_queries") > 10))
    public = F.col("_type") == "PUBLIC"
    rows = rows.withColumns(
        {
            "_query_current": F.when(public, query_cost(F.col("_queries"))).otherwise(F.lit(0.0)),
            "_fewer": half_even(F.col("_queries") * 0.70, 2),
        }
    )
    rows = rows.withColumn("_query_target", query_cost(F.col("_fewer")))
    rows = rows.withColumns(
        {
            "_current_monthly": half_even(F.lit(ZONE_FEE_PER_MONTH) + F.col("_query_current"), 4),
            "_reduced_monthly": half_even(F.lit(ZONE_FEE_PER_MONTH) + F.col("_query_target"), 4),
        }
    )
    rows = rows.withColumn("_target_monthly", F.when(F.col("_orphan"), 0.0).otherwise(F.col("_reduced_monthly")))
    rows = rows.withColumns(
        {
            "_current": half_even(F.col("_current_monthly") * MONTHS_PER_YEAR, 2),
            "_target": half_even(F.col("_target_monthly") * MONTHS_PER_YEAR, 2),
            "_monthly": half_even(F.col("_current_monthly") - F.col("_target_monthly"), 4),
        }
    )
    rows = rows.withColumn("_savings", half_even(F.col("_current") - F.col("_target"), 2))
    busy_action = F.concat(
        F.lit("add wildcard records or delegate to Cloud Load Balancer ("),
        fixed(F.col("_queries"), 1),
        F.lit("M queries/mo -> ~"),
        fixed(F.col("_fewer"), 1),
        F.lit("M)"),
    )
    label = F.when(F.col("_orphan"), F.lit("N/A")).otherwise(F.concat(F.col("_fewer").cast("string"), F.lit("M queries/mo")))
    default = F.when(
        F.col("_orphan"),
        F.lit("Overprovisioned Cloud DNS — delete orphaned forwarding zone {current_sku} (targets unreachable)"),
    ).otherwise(F.lit("Overprovisioned Cloud DNS — {action} (current: {current_sku})"))
    given = F.nullif(F.col("template"), F.lit("")) if "template" in rows.columns else F.lit(None).cast("string")
    rows = rows.withColumn("template", F.coalesce(given, default))
    text = text_of(rows, "", {"current_sku": F.col("zone_name"), "target_sku": label, "action": busy_action})
    action = F.when(F.col("_orphan"), F.lit("delete_orphaned_forwarding_zone")).otherwise(F.lit("optimize_query_volume"))
    busy = ~F.col("_orphan")
    return recommendation(
        rows,
        "CLOUDDNS_OVERPROVISIONED",
        text,
        F.col("_current"),
        F.col("_target"),
        F.col("_savings"),
        {
            "zone_name": F.col("zone_name"),
            "zone_type": F.col("_type"),
            "action": action,
            "query_count_millions_per_month": F.col("_queries"),
            "optimized_query_millions": F.when(busy, F.col("_fewer")),
            "monthly_cost_current": F.col("_current_monthly"),
            "monthly_cost_target": F.col("_target_monthly"),
            "monthly_savings": F.col("_monthly"),
            "annual_savings": F.col("_savings"),
            "target_skus": F.when(busy, target_sku(label, F.col("_target_monthly"))).otherwise(
                F.array().cast("array<struct<label: string, monthly_cost: double>>")
            ),
        },
    )
