"""Recommendations for message topics and scheduled jobs.

Fixed values: the sentences of the recommendations and the names of their details.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costgauge.functions.numeric import MONTHS_PER_YEAR, count_or_one, half_even, number
from costgauge.functions.text import fixed, join_present, thousands
from costgauge.plans.contract import no_targets, optional, recommendation, target_sku, text_of

FREE_GB_PER_MONTH = 10.0
PRICE_PER_GB = 0.04
FREE_JOBS = 3
PRICE_PER_JOB = 0.10


def _counted(count: Column) -> Column:
    """Counts print as floats, the floor of one as a whole number."""
    return F.when(count == 1, F.lit("1")).otherwise(count.cast("string"))


def _subscriptions(topics: DataFrame) -> DataFrame:
    return topics.withColumns(
        {
            "_gb": number(optional(topics, "monthly_data_gb")),
            "_subs": F.greatest(F.lit(1.0), number(optional(topics, "subscription_count", 1.0))),
            "_kind": optional(topics, "resource_type", "topic", "string"),
        }
    )


def pubsub_idle(topics: DataFrame) -> DataFrame:
    """Idle topics cost every delivered copy beyond the free volume."""
    rows = _subscriptions(topics)
    rows = rows.withColumn("_billable", F.greatest(F.lit(0.0), F.col("_gb") - FREE_GB_PER_MONTH) * F.col("_subs"))
    rows = rows.withColumn("_monthly", half_even(F.col("_billable") * PRICE_PER_GB, 4))
    rows = rows.withColumn("_annual", half_even(F.col("_monthly") * MONTHS_PER_YEAR, 2))
    text = text_of(
        rows,
        "Idle Pub/Sub topic — delete topic and all subscriptions (current: {current_sku})",
        {"current_sku": F.col("topic_name"), "target_sku": F.lit("N/A")},
    )
    return recommendation(
        rows,
        "PUBSUB_IDLE",
        text,
        F.col("_annual"),
        F.lit(0.0),
        F.col("_annual"),
        {
            "resource_type": F.col("_kind"),
            "current_sku": F.col("topic_name"),
            "monthly_data_gb": F.col("_gb"),
            "subscription_count": F.col("_subs"),
            "billable_gb_per_month": F.col("_billable"),
            "monthly_cost": F.col("_monthly"),
            "annual_cost": F.col("_annual"),
            "monthly_savings": F.col("_monthly"),
            "annual_savings": F.col("_annual"),
            "target_skus": no_targets(),
        },
    )


def pubsub_overprovisioned(topics: DataFrame) -> DataFrame:
    """Backlogs, large payloads and unused subscriptions; unused subscriptions are what is priced."""
    rows = _subscriptions(topics)
    active = optional(rows, "active_subscription_count", None)
    rows = rows.withColumns(
        {
            "_active": F.greatest(F.lit(1.0), F.coalesce(active, F.col("_subs"))),
            "_backlog": number(optional(rows, "num_undelivered_messages_p95")),
            "_age": number(optional(rows, "oldest_unacked_message_age_p95_seconds")),
            "_cost_p95": number(optional(rows, "byte_cost_p95")),
            "_cost_base": number(optional(rows, "byte_cost_baseline")),
        }
    )
    rows = rows.withColumns(
        {
            "_heavy": (F.col("_cost_base") > 0) & (F.col("_cost_p95") > F.col("_cost_base") * 10),
            "_unused": F.greatest(F.lit(0.0), F.col("_subs") - F.col("_active")),
            "_paid_gb": F.greatest(F.lit(0.0), F.col("_gb") - FREE_GB_PER_MONTH),
        }
    )
    backlog, age, heavy, unused = F.col("_backlog") > 10_000, F.col("_age") > 300, F.col("_heavy"), F.col("_unused") > 0
    unused_text = F.col("_unused").cast("string")
    signals = F.array_compact(
        F.array(
            F.when(
                backlog,
                F.concat(
                    F.lit("large unacked backlog (num_undelivered_messages P95="), thousands(F.col("_backlog")), F.lit(" > 10,000)")
                ),
            ),
            F.when(
                age,
                F.concat(
                    F.lit("consumer not keeping up (oldest_unacked_message_age P95="), fixed(F.col("_age"), 0), F.lit("s > 300s)")
                ),
            ),
            F.when(
                heavy,
                F.concat(
                    F.lit("large message payloads (byte_cost P95="),
                    fixed(F.col("_cost_p95"), 2),
                    F.lit(" > 10× baseline="),
                    fixed(F.col("_cost_base"), 2),
                    F.lit(")"),
                ),
            ),
            F.when(unused, F.concat(unused_text, F.lit(" unused subscription(s) accumulating delivery charges"))),
        )
    )
    actions = join_present(
        "; ",
        F.when(backlog | age, F.lit("scale up consumer (increase Cloud Run min_instances or replicas)")),
        F.when(heavy, F.lit("reduce payload size — store large data in GCS, send URI in message instead")),
        F.when(
            unused,
            F.concat(
                F.lit("remove "), unused_text, F.lit(" unused subscription(s) to eliminate duplicate delivery charges")
            ),
        ),
    )
    review = F.array(F.lit("multiple subscriptions on topic — review for unused delivery copies"))
    rows = rows.withColumns(
        {
            "_signals": F.when(F.size(signals) > 0, signals).otherwise(review),
            "_action": F.coalesce(F.nullif(actions, F.lit("")), F.lit("review subscription configuration")),
            "_monthly_current": half_even(F.col("_paid_gb") * F.col("_subs") * PRICE_PER_GB, 4),
            "_monthly_target": half_even(F.col("_paid_gb") * F.col("_active") * PRICE_PER_GB, 4),
        }
    )
    rows = rows.withColumns(
        {
            "_monthly": half_even(F.col("_monthly_current") - F.col("_monthly_target"), 4),
            "_current": half_even(F.col("_monthly_current") * MONTHS_PER_YEAR, 2),
            "_target": half_even(F.col("_monthly_target") * MONTHS_PER_YEAR, 2),
        }
    )
    rows = rows.withColumn("_savings", half_even(F.col("_current") - F.col("_target"), 2))
    label = F.concat(_counted(F.col("_active")), F.lit(" active subscription(s)"))
    text = text_of(
        rows,
        "Overprovisioned Pub/Sub {current_sku} — {action}",
        {"current_sku": F.col("topic_name"), "target_sku": label, "action": F.col("_action")},
    )
    return recommendation(
        rows,
        "PUBSUB_OVERPROVISIONED",
        text,
        F.col("_current"),
        F.col("_target"),
        F.col("_savings"),
        {
            "resource_type": F.col("_kind"),
            "current_sku": F.col("topic_name"),
            "monthly_data_gb": F.col("_gb"),
            "subscription_count": F.col("_subs"),
            "active_subscription_count": F.col("_active"),
            "unused_subscriptions": F.col("_unused"),
            "signals_fired": F.col("_signals"),
            "undelivered_messages_p95": F.col("_backlog"),
            "oldest_unacked_age_p95_seconds": F.col("_age"),
            "byte_cost_p95": F.col("_cost_p95"),
            "byte_cost_baseline": F.col("_cost_base"),
            "high_byte_cost": F.col("_heavy"),
            "monthly_cost_current": F.col("_monthly_current"),
            "monthly_cost_target": F.col("_monthly_target"),
            "monthly_savings": F.col("_monthly"),
            "annual_savings": F.col("_savings"),
            "target_skus": target_sku(label, F.col("_monthly_target")),
        },
    )


def _account_size(jobs: DataFrame) -> DataFrame:
    return jobs.withColumn("_total", F.greatest(F.lit(1.0), number(optional(jobs, "total_jobs_in_account", 1.0))))


def scheduler_idle(jobs: DataFrame) -> DataFrame:
    """Idle jobs cost their fee if they are beyond the free ones of the account."""
    rows = _account_size(jobs)
    ordinal = F.coalesce(optional(rows, "job_ordinal", None), F.col("_total"))
    rows = rows.withColumns(
        {
            "_ordinal": ordinal,
            "_state": optional(rows, "job_state", "ENABLED", "string"),
            "_errors": number(optional(rows, "error_rate_pct")),
        }
    )
    rows = rows.withColumns({"_billable": F.col("_ordinal") > FREE_JOBS, "_paused": F.upper("_state") == "PAUSED"})
    reason = (
        F.when(F.col("_paused"), F.lit("paused job (still incurs monthly billing)"))
        .when(F.col("_errors") >= 100.0, F.lit("job targeting deleted/unreachable resource (100% error rate)"))
        .otherwise(F.lit("no successful executions in 14-30 days"))
    )
    rows = rows.withColumns({"_monthly": F.when(F.col("_billable"), PRICE_PER_JOB).otherwise(0.0), "_reason": reason})
    rows = rows.withColumn("_annual", half_even(F.col("_monthly") * MONTHS_PER_YEAR, 2))
    text = text_of(
        rows,
        "Idle Cloud Scheduler job — delete {current_sku} ({reason})",
        {"current_sku": F.col("job_name"), "target_sku": F.lit("N/A"), "reason": F.col("_reason")},
    )
    return recommendation(
        rows,
        "CLOUDSCHEDULER_IDLE",
        text,
        F.col("_annual"),
        F.lit(0.0),
        F.col("_annual"),
        {
            "job_name": F.col("job_name"),
            "job_state": F.col("_state"),
            "is_paused": F.col("_paused"),
            "is_billable": F.col("_billable"),
            "job_ordinal": F.col("_ordinal"),
            "total_jobs_in_account": F.col("_total"),
            "error_rate_pct": F.col("_errors"),
            "reason": F.col("_reason"),
            "monthly_cost": F.col("_monthly"),
            "annual_cost": F.col("_annual"),
            "monthly_savings": F.col("_monthly"),
            "annual_savings": F.col("_annual"),
            "target_skus": no_targets(),
        },
    )


def scheduler_overprovisioned(jobs: DataFrame) -> DataFrame:
    """Accounts beyond the free jobs, and jobs that are dispatched again and again."""
    rows = _account_size(jobs)
    rows = rows.withColumns(
        {
            "_billable": F.greatest(F.lit(0.0), F.col("_total") - FREE_JOBS),
            "_keep": F.least(F.col("_total"), F.lit(float(FREE_JOBS))),
            "_dispatched": number(optional(rows, "attempt_dispatch_count")),
            "_attempts": count_or_one(optional(rows, "attempt_count", 1.0)),
        }
    )
    # The free job count itself is a whole number in the text.
    keep_text = F.when(F.col("_total") > FREE_JOBS, F.lit(str(FREE_JOBS))).otherwise(_counted(F.col("_keep")))
    rows = rows.withColumns(
        {
            "_remove": F.col("_total") - F.col("_keep"),
            "_keep_text": keep_text,
            "_retries": F.when(F.col("_attempts") > 0, F.col("_dispatched") / F.col("_attempts")).otherwise(0.0),
            "_monthly": half_even(F.col("_billable") * PRICE_PER_JOB, 4),
        }
    )
    action = (
        F.when(
            F.col("_retries") > 3.0,
            F.concat(
                F.lit("tune retry settings — dispatch/attempt ratio is "),
                fixed(F.col("_retries"), 1),
                F.lit("x (dispatch_count >> attempt_count)"),
            ),
        )
        .when(
            F.col("_remove") > 0,
            F.concat(
                F.lit("consolidate "),
                F.col("_remove").cast("string"),
                F.lit(f" job(s) to stay within free tier ({FREE_JOBS} jobs)"),
            ),
        )
        .otherwise(F.lit("reduce execution frequency to lower downstream compute costs"))
    )
    rows = rows.withColumns(
        {
            "_action": action,
            "_annual": half_even(F.col("_monthly") * MONTHS_PER_YEAR, 2),
            "_retries_shown": half_even(F.col("_retries"), 2),
        }
    )
    text = text_of(
        rows,
        "Overprovisioned Cloud Scheduler — {action} (current: {current_sku})",
        {
            "current_sku": F.col("job_name"),
            "target_sku": F.concat(F.col("_keep_text"), F.lit(" jobs")),
            "action": F.col("_action"),
        },
    )
    return recommendation(
        rows,
        "CLOUDSCHEDULER_OVERPROVISIONED",
        text,
        F.col("_annual"),
        F.lit(0.0),
        F.col("_annual"),
        {
            "job_name": F.col("job_name"),
            "total_jobs_in_account": F.col("_total"),
            "billable_jobs": F.col("_billable"),
            "target_jobs": F.col("_keep"),
            "jobs_to_remove": F.col("_remove"),
            "retry_ratio": F.col("_retries_shown"),
            "action": F.col("_action"),
            "current_monthly_cost": F.col("_monthly"),
            "target_monthly_cost": F.lit(0.0),
            "monthly_savings": F.col("_monthly"),
            "annual_savings": F.col("_annual"),
            "target_skus": target_sku(F.concat(F.col("_keep_text"), F.lit(" jobs (free tier)")), F.lit(0.0)),
        },
    )
