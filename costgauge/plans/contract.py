"""The row every recommender returns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costgauge.functions.text import render, template_or
from costgauge.schemas import RECOMMENDATION_COLUMNS


def template_of(df: DataFrame) -> Column | None:
    """The rule's template where the input carries one."""
    return F.col("template") if "template" in df.columns else None


def text_of(df: DataFrame, default: str, values: Mapping[str, Column]) -> Column:
    """Recommendation text from the row's template or the built-in one."""
    return render(template_or(template_of(df), default), dict(values))


def optional(df: DataFrame, name: str, default: object = None, kind: str = "double") -> Column:
    """A column of the input, or the default where the input has no such column or a null in it."""
    missing = F.lit(default).cast(kind)
    if name not in df.columns:
        return missing
    return F.coalesce(F.col(name).try_cast(kind), missing)


def either(df: DataFrame, name: str, default: Column | float = 0.0) -> Column:
    """A value that may come as a metric (``metric_<name>``) or as a resource attribute (``<name>``).

    A metric that is missing or zero gives way to the attribute, a missing
    attribute to the default.
    """
    options = []
    if f"metric_{name}" in df.columns:
        options.append(F.nullif(F.col(f"metric_{name}").try_cast("double"), F.lit(0.0)))
    if name in df.columns:
        options.append(F.col(name).try_cast("double"))
    return F.coalesce(*options, default if isinstance(default, Column) else F.lit(float(default)))


def recommendation(
    df: DataFrame,
    rule_code: str,
    text: Column,
    current: Column,
    target: Column,
    savings: Column,
    details: Mapping[str, Column],
    is_fallback: Column | bool = False,
) -> DataFrame:
    """Contract columns; ``details`` stays a struct until the report is written."""
    fallback = is_fallback if isinstance(is_fallback, Column) else F.lit(is_fallback)
    fields = [text.alias("recommendation"), *[c.alias(n) for n, c in details.items()], fallback.alias("is_fallback")]
    return df.select(
        F.col("resource_id").cast("string").alias("resource_id"),
        F.lit(rule_code).alias("rule_code"),
        text.alias("recommendation"),
        current.cast("double").alias("current_annual"),
        target.cast("double").alias("target_annual"),
        savings.cast("double").alias("annual_savings"),
        fallback.alias("is_fallback"),
        F.struct(*fields).alias("details"),
    )


def as_report(recommendations: DataFrame) -> DataFrame:
    """Recommendations with the details as JSON text, ready to union and to write."""
    return recommendations.withColumn("details", F.to_json("details")).select(*RECOMMENDATION_COLUMNS)


def target_sku(label: Column, monthly: Column) -> Column:
    """One-element target list."""
    return F.array(F.struct(label.alias("label"), monthly.alias("monthly_cost")))


def no_targets() -> Column:
    return F.array().cast("array<string>")
