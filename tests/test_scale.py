"""Both ways of every size-dependent operator give the same rows, also with one hot key."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from costgauge.operators import scale

@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key; values repeat."""
    rng = np.random.default_rng(3)
    keys = np.where(rng.random(3000) < 0.34, 7, rng.integers(0, 40, 3000))
    frame = pd.DataFrame(
        {
            "k": keys.astype("int64"),
            "g": (keys % 3).astype("int64"),
            "v": np.round(rng.normal(50, 20, 3000), 1),
            "w": np.round(rng.random(3000), 3),
            "id": np.arange(3000, dtype="int64"),
        }
    )
    return spark.createDataFrame(frame), frame


@pytest.mark.parametrize("how", ["inner", "left"])
def test_dim_join(spark, skewed, how):
    facts, frame = skewed
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(20)], "k bigint, name string")
    joined = scale.dim_join(facts, dim, ["k"], how)
    want = [(i, f"n{k}" if k < 20 else None) for i, k in zip(frame["id"], frame["k"], strict=True) if how == "left" or k < 20]
    assert sorted(map(tuple, joined.select("id", "name").collect())) == sorted(want)
    assert "explode" not in joined._jdf.queryExecution().optimizedPlan().toString()


def test_row_numbers(skewed):
    facts, frame = skewed
    got = scale.row_numbers(facts, ["g"], ["v", "id"], "n").select("id", "n").toPandas().set_index("id")["n"]
    ordered = frame.sort_values(["g", "v", "id"])
    want = pd.Series(ordered.groupby("g").cumcount().values + 1, index=ordered["id"].values)
    assert (got.sort_index() == want.sort_index()).all()


def test_dense_ranks(skewed):
    facts, frame = skewed
    got = scale.dense_ranks(facts, ["g"], "v", "n").select("id", "n").toPandas().set_index("id")["n"]
    want = frame.set_index("id").groupby("g")["v"].rank("dense").astype(int)
    assert (got.sort_index() == want.sort_index()).all()


def test_percentiles(skewed):
    facts, frame = skewed
    wanted = {"p50": ("v", 0.5), "p95": ("v", 0.95), "low": ("w", 0.0), "w99": ("w", 0.99)}
    also = {"rows": F.count(F.lit(1)), "most": F.max("v")}
    got = scale.percentiles(facts, ["k"], wanted, also).toPandas().set_index("k").sort_index()
    assert (got["rows"] == frame.groupby("k").size()).all() and (got["most"] == frame.groupby("k")["v"].max()).all()
    for name, (column, p) in wanted.items():
        want = frame.groupby("k")[column].quantile(p).sort_index()
        assert np.allclose(got[name], want)


NULLS = [("a", i, float(i % 4), i) for i in range(8)] + [("b", 0, None, 8), (None, 0, 1.0, 9), (None, 1, 3.0, 10), ("b", 1, None, 11)]


@pytest.fixture(scope="module")
def with_nulls(spark):
    return spark.createDataFrame(NULLS, "k string, j int, v double, id int")


def test_percentiles_keep_null_keys_and_groups_without_values(with_nulls):
    got = scale.percentiles(with_nulls, ["k"], {"m": ("v", 0.5)}, {"n": F.count(F.lit(1))}).collect()
    assert {r.k: (r.m, r.n) for r in got} == {"a": (1.5, 8), "b": (None, 2), None: (2.0, 2)}
    plain = scale.percentiles(with_nulls, ["k"], {"m": ("v", 0.5)}).collect()
    assert {r.k: r.m for r in plain} == {"a": 1.5, "b": None, None: 2.0}


def test_ranks_keep_null_groups_and_values(with_nulls):
    got = {r.id: (r.n, r.d) for r in scale.dense_ranks(
        scale.row_numbers(with_nulls, ["k"], ["v", "id"], "n"), ["k"], "v", "d").collect()}
    assert len(got) == len(NULLS)
    assert got[8] == (1, 1) and got[11] == (2, 1) and got[9] == (1, 1) and got[10] == (2, 2)
    assert [got[i] for i in range(8)] == [(1, 1), (3, 2), (5, 3), (7, 4), (2, 1), (4, 2), (6, 3), (8, 4)]


def test_nothing_runs_while_a_plan_is_built(spark, with_nulls):
    """No job is started before the result is asked for."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    scale.percentiles(with_nulls, ["k"], {"m": ("v", 0.5)})
    scale.dense_ranks(with_nulls, ["k"], "v", "d")
    scale.row_numbers(with_nulls, ["k"], ["v", "id"], "n")
    started = tracker.getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not started


def test_percentiles_beyond_the_sketch(spark, monkeypatch):
    """Groups larger than their sketch: hot key, ties, null keys and values, NaN, two columns, further aggregates."""
    monkeypatch.setattr(scale, "KEPT", 64)
    rng = np.random.default_rng(8)
    n = 12_000
    frame = pd.DataFrame(
        {
            "k": np.where(rng.random(n) < 0.4, 1, rng.integers(0, 400, n)),
            "v": np.where(rng.random(n) < 0.3, 5.0, rng.normal(0, 100, n)),
            "w": np.where(rng.random(n) < 0.5, np.nan, rng.integers(0, 9, n)),
        }
    )
    facts = spark.createDataFrame(frame).withColumns(
        {"w": F.when(~F.isnan("w"), F.col("w")), "k": F.when(F.col("k") != 7, F.col("k"))}
    )
    frame["k"] = frame["k"].where(frame["k"] != 7)
    wanted = {f"v{p}".replace(".", "_"): ("v", p) for p in (0.0, 0.01, 0.5, 0.95, 0.999, 1.0)} | {"w5": ("w", 0.5), "w9": ("w", 0.9)}
    got = scale.percentiles(facts, ["k"], wanted, {"rows": F.count(F.lit(1)), "top": F.max("v")})
    rows = {r.k: r for r in got.collect()}
    groups = frame.groupby("k", dropna=False)
    assert len(rows) == groups.ngroups
    for key, part in groups:
        row = rows[None if pd.isna(key) else key]
        assert row.rows == len(part) and row.top == part["v"].max()
        for name, (column, p) in wanted.items():
            values = part[column].dropna()
            assert row[name] == pytest.approx(values.quantile(p), abs=1e-9) if len(values) else row[name] is None


def test_percentiles_take_nan_as_greatest(spark):
    rows = [("a", float(i)) for i in range(5)] + [("a", float("nan")), ("b", 1.0), ("b", 2.0)]
    got = scale.percentiles(spark.createDataFrame(rows, "k string, v double"), ["k"], {"m": ("v", 0.6), "top": ("v", 1.0)})
    found = {r.k: (r.m, r.top) for r in got.collect()}
    assert found["b"] == (1.6, 2.0) and found["a"][0] == 3.0 and np.isnan(found["a"][1])


@pytest.mark.parametrize("partitions", [3, 40])
def test_positions(spark, skewed, partitions):
    facts, frame = skewed
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = scale.positions(facts, ["g"], ["v", "id"], "n").select("id", "n").toPandas().set_index("id")["n"]
        ties = scale.positions(facts.withColumn("one", F.lit(999)), ["g"], ["one"], "n").groupBy("g").agg(
            F.max("n").alias("most"), F.count_distinct("n").alias("different")
        )
        sizes = frame.groupby("g").size()
        assert {r.g: (r.most, r.different) for r in ties.collect()} == {g: (n, n) for g, n in sizes.items()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    ordered = frame.sort_values(["g", "v", "id"])
    want = pd.Series(ordered.groupby("g").cumcount().values + 1, index=ordered["id"].values)
    assert (got.sort_index() == want.sort_index()).all()


def test_dense_positions_keep_null_groups_and_values(with_nulls):
    got = {r.id: r.d for r in scale.dense_positions(with_nulls, ["k"], "v", "d").collect()}
    assert got == {r.id: r.d for r in scale.dense_ranks(with_nulls, ["k"], "v", "d").collect()} and len(got) == len(NULLS)
    empty = scale.dense_positions(with_nulls.where("id < 0"), ["k"], "v", "d")
    assert empty.count() == 0
