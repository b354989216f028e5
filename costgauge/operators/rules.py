"""Threshold rules: parsing, evaluation, savings formulas."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costgauge.functions.numeric import number
from costgauge.operators.scale import dim_join
from costgauge.schemas import RULE_LOGIC
from costgauge.sources.local import local_table


@dataclass(frozen=True)
class Condition:
    metric: str
    operator: str
    threshold: float


@dataclass(frozen=True)
class Rule:
    """A threshold rule declared in code."""

    rule_code: str
    service_code: str
    conditions: tuple[Condition, ...]
    logic: str = "AND"
    description: str = ""
    recommendation_template: str = ""
    estimated_savings_formula: str = ""
    is_active: bool = True


OPERATORS = ("lt", "lte", "gt", "gte", "eq")
RULE_COLUMNS = (
    "rule_code string, service_code string, logic string, "
    "conditions array<struct<metric: string, operator: string, threshold: double>>, "
    "description string, recommendation_template string, estimated_savings_formula string, is_active boolean"
)


def rule_frame(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """Declared rules as a table."""
    rows = [
        (
            r.rule_code,
            r.service_code,
            r.logic,
            [{"metric": c.metric, "operator": c.operator, "threshold": float(c.threshold)} for c in r.conditions],
            r.description,
            r.recommendation_template,
            r.estimated_savings_formula,
            r.is_active,
        )
        for r in rules
    ]
    return local_table(spark, rows, RULE_COLUMNS)


def parse_rules(rules: DataFrame) -> DataFrame:
    """Read the JSON ``evaluation_logic`` of stored rules into logic and conditions."""
    parsed = F.from_json("evaluation_logic", RULE_LOGIC)
    return (
        rules.withColumn("_parsed", parsed)
        .withColumns(
            {
                "logic": F.upper(F.coalesce("_parsed.logic", F.lit("AND"))),
                "conditions": F.coalesce("_parsed.conditions", F.array().cast(
                    "array<struct<metric: string, operator: string, threshold: double>>"
                )),
            }
        )
        .drop("_parsed")
    )


def compare(value: Column, operator: Column, threshold: Column) -> Column:
    """Outcome of one condition; null for an unknown operator."""
    return (
        F.when(operator == "lt", value < threshold)
        .when(operator == "lte", value <= threshold)
        .when(operator == "gt", value > threshold)
        .when(operator == "gte", value >= threshold)
        .when(operator == "eq", F.abs(value - threshold) < 0.001)
    )


def fires(metrics: Column, logic: Column, conditions: Column, missing_is_zero: bool = True) -> Column:
    """Whether a rule fires on a map of metrics.

    AND needs all outcomes, any other logic needs one. Unknown operators add no
    outcome; without outcomes a rule does not fire. A missing metric counts as
    zero unless ``missing_is_zero`` is off.
    """

    def outcome(c: Column) -> Column:
        value = F.try_element_at(metrics, c["metric"])
        return compare(number(value) if missing_is_zero else value, c["operator"], c["threshold"])

    outcomes = F.array_compact(F.transform(conditions, outcome))
    every = F.forall(outcomes, lambda o: o)
    some = F.exists(outcomes, lambda o: o)
    both = F.when(F.upper(F.coalesce(logic, F.lit("AND"))) == "AND", every).otherwise(some)
    return (F.size(outcomes) > 0) & both


def as_filter(rule: Rule, missing_is_zero: bool = True) -> Column:
    """A rule declared in code as a predicate on wide metric columns, for use without a rules table."""
    outcomes = []
    for c in rule.conditions:
        value = F.coalesce(F.col(c.metric), F.lit(0.0)) if missing_is_zero else F.col(c.metric)
        outcomes.append(compare(value, F.lit(c.operator), F.lit(float(c.threshold))))
    known = [o for o, c in zip(outcomes, rule.conditions) if c.operator in OPERATORS]
    if not known:
        return F.lit(False)
    both = (lambda a, b: a & b) if rule.logic.upper() == "AND" else (lambda a, b: a | b)
    return reduce(both, known)


def evaluate(
    resources: DataFrame,
    rules: DataFrame,
    service: str | None = None,
    missing_is_zero: bool = True,
) -> DataFrame:
    """One row per resource and fired rule.

    ``resources``: resource_id, metrics (map) and, unless ``service`` names the
    one service all belong to, service_code. Resources without metrics never
    fire. The rules of one service are a list that is tested in place; with
    several services a resource meets the rules of its own in a join that keeps
    only those that fire. Either way only fired rules become rows.
    """
    entry = F.struct("rule_code", "logic", "conditions", "recommendation_template")
    active = rules.where(F.col("is_active"))
    if service is not None:
        active = active.where(F.col("service_code") == service)
        resources = resources.withColumn("service_code", F.lit(service))
    tested = resources.where(F.size("metrics") > 0)
    if service is not None:
        joined = tested.withColumn("_rules", active.agg(F.collect_list(entry)).scalar())
        hits = F.filter("_rules", lambda r: fires(F.col("metrics"), r["logic"], r["conditions"], missing_is_zero))
        fired = joined.withColumn("_rule", F.explode(hits)).drop("_rules")
    else:
        listed = active.select(F.col("service_code").alias("_service"), entry.alias("_rule"))
        hit = fires(F.col("metrics"), F.col("_rule.logic"), F.col("_rule.conditions"), missing_is_zero)
        fired = tested.join(listed, (F.col("service_code") == F.col("_service")) & hit).drop("_service")
    return fired.select(
        "*", F.col("_rule.rule_code").alias("rule_code"), F.col("_rule.recommendation_template").alias("template")
    ).drop("_rule")


def with_service_config(rules: DataFrame, services: DataFrame) -> DataFrame:
    """Active rules of active services, with the service's tables and recommender."""
    active = services.where(F.col("is_active")).drop("is_active")
    return dim_join(rules.where(F.col("is_active")), active, ["service_code"], "inner")


def healthy(resources: DataFrame, fired: DataFrame) -> DataFrame:
    """Resources with metrics on which no rule fired."""
    tested = resources.where(F.size("metrics") > 0)
    return tested.join(fired.select("resource_id").distinct(), "resource_id", "left_anti")


def unhandled(fired: DataFrame, known_codes: Sequence[str]) -> DataFrame:
    """Fired rules no recommender knows."""
    return fired.where(~F.col("rule_code").isin(*known_codes))


SAVINGS_COLUMNS = ("total_cost", "current_cost", "target_cost")


def savings_by_formula(df: DataFrame, formulas: Sequence[str], formula: str = "estimated_savings_formula") -> DataFrame:
    """Evaluate each row's savings formula.

    ``formulas`` lists the formulas that may occur (they are configuration, a
    handful); each is compiled to a column expression over the cost columns.
    Rows with any other formula get null.
    """
    outcome = F.lit(None).cast("double")
    for text in formulas:
        words = "".join(c if c.isalnum() or c == "_" else " " for c in text).split()
        unknown = [w for w in words if not w[0].isdigit() and w not in SAVINGS_COLUMNS]
        if unknown:
            raise ValueError(f"formula {text!r} uses {unknown}; allowed are {SAVINGS_COLUMNS}")
        outcome = F.when(F.col(formula) == text, F.expr(text).cast("double")).otherwise(outcome)
    return df.withColumn("estimated_savings", outcome)
