"""Best fit and fallback against a plain double loop."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from costgauge.operators import catalog as prices
from costgauge.operators import matching

FIELDS = "family string, machine_type string, vcpus double, ram_gb double, hourly_price double"


@pytest.fixture(scope="module")
def machines():
    random.seed(5)
    rows = []
    for i in range(120):
        vcpus, ram = random.choice([1, 2, 4, 8, 16]), random.choice([1, 2, 4, 8, 16, 32])
        family = "hot" if random.random() < 0.4 else random.choice(["a", "b", "c"])
        rows.append((family, f"m{i:03d}", float(vcpus), float(ram), round(vcpus * 0.03 + ram * 0.004 + random.choice([0, 0.01]), 6)))
    return rows


def ranked(rows):
    out = []
    for family in {r[0] for r in rows}:
        steps = {p: i + 1 for i, p in enumerate(sorted({r[4] for r in rows if r[0] == family}))}
        out += [(*r, steps[r[4]]) for r in rows if r[0] == family]
    return out


def needs(rows, seed=9):
    random.seed(seed)
    picked = [random.choice(rows) for _ in range(150)]
    return [
        (f"w{i}", r[1], r[0], r[5], round(r[2] * random.random(), 3), round(r[3] * random.random(), 3))
        for i, r in enumerate(picked)
    ]


def best(rows, need):
    _, own, family, ordinal, vcpus, ram = need
    fits = [r for r in rows if r[0] == family and r[1] != own and r[5] < ordinal and r[2] >= vcpus and r[3] >= ram]
    return min(fits, key=lambda r: (r[2], r[3], r[5], r[1]))[1] if fits else None


def cheaper(rows, need):
    _, own, family, ordinal, _, _ = need
    lower = [r for r in rows if r[0] == family and r[1] != own and r[5] < ordinal]
    return list(dict.fromkeys(r[1] for r in sorted(lower, key=lambda r: (-r[5], r[1]))))[:3]


def frames(spark, rows):
    base = spark.createDataFrame(rows, FIELDS)
    entries = prices.specs(prices.with_ordinals(base)).drop("hourly_price")
    return matching.Catalog(entries, "family")


def listed_again(rows, seed=4):
    """Every third type a second time at its own size, some at another price."""
    random.seed(seed)
    return rows + [(*r[:4], round(r[4] + random.choice([0, 0, 0.003]), 6)) for r in rows[::3]]


@pytest.mark.parametrize("repeats", [False, True])
def test_best_fit_and_fallback(spark, machines, repeats):
    machines = listed_again(machines) if repeats else machines
    catalog = frames(spark, machines)
    rows = ranked(machines)
    wanted = needs(rows) * 2  # a workload may be listed twice
    workloads = spark.createDataFrame(
        wanted,
        "workload_id string, machine_type string, family string, cur_ordinal int, required_vcpus double, required_ram double",
    )
    found = matching.best_fit(workloads, catalog).collect()
    assert len(found) == len(wanted)
    got = {r.workload_id: r.target and r.target.machine_type for r in found}
    assert got == {n[0]: best(rows, n) for n in wanted}

    lists = matching.closest_cheaper(catalog).withColumnRenamed("ordinal", "cur_ordinal")
    joined = workloads.join(lists, ["family", "cur_ordinal"], "left")
    names = matching.fallback_targets(F.col("cheaper"), F.col("machine_type"))
    found = {r[0]: r[1] or [] for r in joined.select("workload_id", names["machine_type"]).collect()}
    assert found == {n[0]: cheaper(rows, n) for n in wanted}


def test_best_fit_in_one_pool(spark, machines):
    catalog = frames(spark, machines)
    rows = ranked(machines)
    wanted = [n for n in needs(rows) if n[2] == "hot"]
    workloads = spark.createDataFrame(
        wanted,
        "workload_id string, machine_type string, family string, cur_ordinal int, required_vcpus double, required_ram double",
    )
    got = {r.workload_id: r.target and r.target.machine_type for r in matching.best_fit(workloads, catalog, "hot").collect()}
    assert got == {n[0]: best(rows, n) for n in wanted}


def test_fallback_with_gaps_in_the_ordinals(spark, machines):
    catalog = frames(spark, machines)
    gaps = catalog.entries.withColumn("ordinal", F.col("ordinal") * 10)
    spread = matching.Catalog(gaps, "family")
    rows = [(*r[:5], r[5] * 10) for r in ranked(machines)]
    lists = {(r.family, r.ordinal): r.cheaper for r in matching.closest_cheaper(spread).collect()}
    for need in needs(rows):
        found = [e.machine_type for e in lists.get((need[2], need[3]), []) if e.machine_type != need[1]][:3]
        assert found == cheaper(rows, need)


def test_ordinals_are_dense_from_one(spark, machines):
    catalog = frames(spark, machines)
    steps = catalog.entries.groupBy("family").agg(F.collect_set("ordinal").alias("s")).collect()
    assert all(sorted(r.s) == list(range(1, len(r.s) + 1)) for r in steps)


def test_lookup_prefers_priority_then_drops_unknown(spark):
    rows = [("batch", 0, "n1", 2.0, 4.0, 0.1, 1), ("streaming", 1, "n1", 2.0, 4.0, 0.2, 1), ("streaming", 1, "x", 1.0, 1.0, 0.3, 2)]
    entries = prices.specs(
        spark.createDataFrame(
            rows, "job_type string, priority int, machine_type string, vcpus double, ram_gb double, hourly_price double, ordinal int"
        )
    )
    catalog = matching.Catalog(entries, "job_type")
    workloads = spark.createDataFrame([("a", "n1"), ("b", "x"), ("c", "gone")], "resource_id string, machine_type string")
    got = {r.resource_id: r.cur_job_type for r in matching.lookup(workloads, catalog).collect()}
    assert got == {"a": "batch", "b": "streaming"}
    assert [r.resource_id for r in matching.missing_types(workloads, catalog).collect()] == ["c"]


def test_own_family_comes_first(spark):
    rows = [("zz", "n2-standard-4"), ("n2", "n2-standard-4"), ("aa", "odd")]
    marked = matching.own_family_first(spark.createDataFrame(rows, "family string, machine_type string"))
    assert {(r.family, r.machine_type): r.priority for r in marked.collect()} == {
        ("zz", "n2-standard-4"): 1,
        ("n2", "n2-standard-4"): 0,
        ("aa", "odd"): 1,
    }
