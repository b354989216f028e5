"""Recommendations for storage buckets.

Fixed values: the sentences of the recommendations and the names of their details.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costgauge.functions.numeric import MONTHS_PER_YEAR, half_even, let, number
from costgauge.functions.prices import class_for_reads, colder_class, retrieval_price, storage_price
from costgauge.functions.text import fixed
from costgauge.plans.contract import either, optional, recommendation, target_sku, text_of


def _bucket(buckets: DataFrame) -> DataFrame:
    """Size, class and current cost; a missing class is the standard one."""
    named = F.upper(F.coalesce(F.nullif(optional(buckets, "storage_class", "STANDARD", "string"), F.lit("")), F.lit("STANDARD")))
    rows = buckets.withColumns({"_gb": number(optional(buckets, "storage_gb")), "_class": named})
    rows = rows.withColumn("_current_monthly", half_even(F.col("_gb") * storage_price(F.col("_class")), 4))
    return rows.withColumn("_current", half_even(F.col("_current_monthly") * MONTHS_PER_YEAR, 2))


def storage_idle(buckets: DataFrame) -> DataFrame:
    """Empty idle buckets go, others move one class colder."""
    rows = _bucket(buckets)
    empty = F.col("_gb") == 0
    rows = rows.withColumn("_to", F.when(empty, F.lit("DELETE")).otherwise(colder_class(F.col("_class"))))
    rows = rows.withColumn("_target_monthly", half_even(F.col("_gb") * storage_price(F.col("_to")), 4))
    rows = rows.withColumns(
        {
            "_target": half_even(F.col("_target_monthly") * MONTHS_PER_YEAR, 2),
            "_monthly": half_even(F.col("_current_monthly") - F.col("_target_monthly"), 4),
        }
    )
    rows = rows.withColumn("_savings", half_even(F.col("_current") - F.col("_target"), 2))
    default = F.when(
        empty, F.lit("Idle Cloud Storage bucket with zero objects — delete bucket (current: {current_sku})")
    ).otherwise(F.lit("Idle Cloud Storage bucket — transition from {current_sku} to {target_sku} storage class"))
    rows = _with_template(rows, default)
    text = text_of(
        rows,
        "",
        {
            "current_sku": F.when(empty, F.col("bucket_name")).otherwise(F.col("_class")),
            "target_sku": F.when(empty, F.lit("N/A")).otherwise(F.col("_to")),
        },
    )
    return recommendation(
        rows,
        "CLOUDSTORAGE_IDLE",
        text,
        F.col("_current"),
        F.col("_target"),
        F.col("_savings"),
        {
            "current_class": F.col("_class"),
            "target_class": F.col("_to"),
            "storage_gb": F.col("_gb"),
            "current_monthly_cost": F.col("_current_monthly"),
            "target_monthly_cost": F.col("_target_monthly"),
            "monthly_savings": F.col("_monthly"),
            "annual_savings": F.col("_savings"),
            "target_skus": F.when(~empty, target_sku(F.col("_to"), F.col("_target_monthly"))).otherwise(
                F.array().cast("array<struct<label: string, monthly_cost: double>>")
            ),
        },
    )


def _with_template(rows: DataFrame, default: Column) -> DataFrame:
    given = F.nullif(F.col("template"), F.lit("")) if "template" in rows.columns else F.lit(None).cast("string")
    return rows.withColumn("template", F.coalesce(given, default))


def storage_overprovisioned(buckets: DataFrame, best_class: bool = False) -> DataFrame:
    """Growing unread buckets go to the archive, rarely read ones to a colder class, if that saves money."""
    rows = _bucket(buckets)
    rows = rows.withColumns(
        {
            "_reads": either(rows, "reads_per_month"),
            "_growth": either(rows, "storage_growth_pct_per_week"),
            "_reads_30d": either(rows, "read_ops_30d"),
        }
    )
    archive = (F.col("_growth") > 10.0) & (F.col("_reads_30d") == 0) & (F.col("_class") != "ARCHIVE")
    rows = rows.withColumns(
        {
            "_signal": F.when(archive, F.lit("storage_growth_no_reads")).otherwise(F.lit("low_read_frequency")),
            "_to": F.when(archive, F.lit("ARCHIVE")).otherwise(class_for_reads(F.col("_reads"), F.col("_class"), best_class)),
        }
    ).where(F.col("_to").isNotNull())
    rows = rows.withColumn("_retrieval", half_even(F.col("_reads") * retrieval_price(F.col("_to")), 4))
    rows = rows.withColumn(
        "_target_monthly", half_even(F.col("_gb") * storage_price(F.col("_to")) + F.col("_retrieval"), 4)
    )
    rows = rows.withColumn("_target", half_even(F.col("_target_monthly") * MONTHS_PER_YEAR, 2))
    rows = let(
        rows,
        _savings=half_even(F.col("_current") - F.col("_target"), 2),
        _monthly=half_even(F.col("_current_monthly") - F.col("_target_monthly"), 4),
    ).where(F.col("_savings") > 0)
    default = F.when(
        F.col("_signal") == "storage_growth_no_reads",
        F.lit(
            "Overprovisioned Cloud Storage — transition from {current_sku} to {target_sku} "
            "(storage growing {growth:.1f}%/wk with zero reads)"
        ),
    ).otherwise(
        F.lit(
            "Overprovisioned Cloud Storage — transition from {current_sku} to {target_sku} "
            "(access < {reads_per_month:.2f} reads/mo)"
        )
    )
    rows = _with_template(rows, default)
    text = text_of(
        rows,
        "",
        {
            "current_sku": F.col("_class"),
            "target_sku": F.col("_to"),
            "growth:.1f": fixed(F.col("_growth"), 1),
            "reads_per_month:.2f": fixed(F.col("_reads"), 2),
        },
    )
    return recommendation(
        rows,
        "CLOUDSTORAGE_OVERPROVISIONED",
        text,
        F.col("_current"),
        F.col("_target"),
        F.col("_savings"),
        {
            "signal": F.col("_signal"),
            "current_class": F.col("_class"),
            "target_class": F.col("_to"),
            "storage_gb": F.col("_gb"),
            "reads_per_month": F.col("_reads"),
            "read_ops_30d": F.col("_reads_30d"),
            "storage_growth_pct_per_week": F.col("_growth"),
            "current_monthly_cost": F.col("_current_monthly"),
            "target_monthly_cost": F.col("_target_monthly"),
            "retrieval_cost_monthly": F.col("_retrieval"),
            "monthly_savings": F.col("_monthly"),
            "annual_savings": F.col("_savings"),
            "target_skus": target_sku(F.col("_to"), F.col("_target_monthly")),
        },
    )
