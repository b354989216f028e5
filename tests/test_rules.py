"""Rule parsing, evaluation and formulas."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from costgauge.operators import rules
from costgauge.operators.rules import Condition, Rule
from costgauge.sources import seeds

CPU, MEMORY = "cpu_utilization_avg", "memory_utilization_avg"


def resources(spark):
    rows = [
        ("idle", "GKE", {CPU: 4.9, MEMORY: 19.9}),
        ("edge", "GKE", {CPU: 5.0, MEMORY: 20.0}),
        ("pods", "GKE", {"container_cpu_avg": 50.0}),
        ("busy", "GKE", {CPU: 90.0, MEMORY: 90.0}),
        ("memory", "GKE", {CPU: 90.0, MEMORY: 49.0}),
        ("silent", "GKE", {}),
        ("topic", "PUBSUB", {CPU: 1.0}),
    ]
    return spark.createDataFrame(rows, "resource_id string, service_code string, metrics map<string, double>")


def fired(frame):
    return sorted((r.resource_id, r.rule_code) for r in frame.collect())


def test_seed_rules(spark):
    got = fired(rules.evaluate(resources(spark), rules.rule_frame(spark, seeds.GKE_RULES)))
    assert got == [
        ("edge", "GKE_OVERPROVISIONED"),
        ("idle", "GKE_IDLE"),
        ("idle", "GKE_OVERPROVISIONED"),
        ("memory", "GKE_OVERPROVISIONED"),
        ("pods", "GKE_IDLE"),
        ("pods", "GKE_OVERPROVISIONED"),
    ]


def test_one_service(spark):
    """Naming the service replaces the join."""
    declared = rules.rule_frame(spark, [*seeds.GKE_RULES, Rule("T", "PUBSUB", (Condition(CPU, "gte", 0),))])
    mine = resources(spark).where("service_code = 'GKE'").drop("service_code")
    got = fired(rules.evaluate(mine, declared, "GKE"))
    assert got == fired(rules.evaluate(resources(spark).where("service_code = 'GKE'"), declared))


def test_missing_metrics_need_not_be_zero(spark):
    got = fired(rules.evaluate(resources(spark), rules.rule_frame(spark, seeds.GKE_RULES), missing_is_zero=False))
    assert ("pods", "GKE_IDLE") not in got and ("idle", "GKE_IDLE") in got


def test_operators_and_logic(spark):
    cases = {
        "lt": [("edge", False), ("idle", True)],
        "lte": [("edge", True), ("busy", False)],
        "gt": [("edge", False), ("busy", True)],
        "gte": [("edge", True), ("idle", False)],
        "eq": [("edge", True), ("idle", False)],
        "near": [("edge", False), ("idle", False)],
    }
    declared = [Rule(op, "GKE", (Condition(CPU, op, 5.0),)) for op in cases]
    declared += [
        Rule("none", "GKE", ()),
        Rule("lower", "GKE", (Condition(CPU, "lt", 5), Condition(MEMORY, "lt", 10)), "and"),
        Rule("odd", "GKE", (Condition(CPU, "lt", 5), Condition(MEMORY, "lt", 10)), "XOR"),
        Rule("mixed", "GKE", (Condition(CPU, "near", 5), Condition(MEMORY, "lt", 20))),
        Rule("off", "GKE", (Condition(CPU, "lt", 500),), is_active=False),
    ]
    got = set(fired(rules.evaluate(resources(spark), rules.rule_frame(spark, declared))))
    for op, checks in cases.items():
        for resource, expected in checks:
            assert ((resource, op) in got) is expected, (resource, op)
    codes = {c for _, c in got}
    assert not codes & {"none", "off", "near"}
    assert ("idle", "lower") not in got and ("idle", "odd") in got and ("idle", "mixed") in got


def test_rules_as_filters_agree_with_rules_as_rows(spark):
    wide = resources(spark).where(F.size("metrics") > 0).where("service_code = 'GKE'").select(
        "resource_id", *[F.try_element_at("metrics", F.lit(n)).alias(n) for n in (CPU, MEMORY)]
    )
    by_rows = fired(rules.evaluate(resources(spark), rules.rule_frame(spark, seeds.GKE_RULES)))
    by_filter = [(r.resource_id, rule.rule_code) for rule in seeds.GKE_RULES for r in wide.where(rules.as_filter(rule)).collect()]
    assert sorted(by_filter) == by_rows
    assert wide.where(rules.as_filter(Rule("x", "GKE", (Condition(CPU, "near", 1),)))).count() == 0


def test_healthy_and_unhandled(spark):
    tested = resources(spark)
    hit = rules.evaluate(tested, rules.rule_frame(spark, seeds.GKE_RULES))
    assert sorted(r.resource_id for r in rules.healthy(tested, hit).collect()) == ["busy", "topic"]
    assert {r.rule_code for r in rules.unhandled(hit, ["GKE_IDLE"]).collect()} == {"GKE_OVERPROVISIONED"}


def test_parsing(spark):
    texts = [
        ("a", '{"logic": "or", "conditions": [{"metric": "m", "operator": "lt", "threshold": 5}]}'),
        ("b", '{"conditions": []}'),
        ("c", "no json"),
    ]
    got = {r.rule_code: (r.logic, len(r.conditions)) for r in rules.parse_rules(
        spark.createDataFrame(texts, "rule_code string, evaluation_logic string")
    ).collect()}
    assert got == {"a": ("OR", 1), "b": ("AND", 0), "c": ("AND", 0)}


def test_formulas(spark):
    rows = [(100.0, 80.0, 30.0, "total_cost * 1"), (100.0, 80.0, 30.0, "current_cost - target_cost"), (1.0, 1.0, 1.0, "other")]
    frame = spark.createDataFrame(
        rows, "total_cost double, current_cost double, target_cost double, estimated_savings_formula string"
    )
    done = rules.savings_by_formula(frame, ["total_cost * 1", "current_cost - target_cost"])
    assert [r.estimated_savings for r in done.collect()] == [100.0, 50.0, None]
    with pytest.raises(ValueError):
        rules.savings_by_formula(frame, ["drop_everything * 1"])


def test_service_configuration(spark):
    stored = rules.rule_frame(spark, seeds.GKE_RULES)
    joined = rules.with_service_config(stored, seeds.service_configuration(spark).select("service_code", "is_active", "sku_json_file"))
    assert {r.sku_json_file for r in joined.collect()} == {"gke_sku.json"}
