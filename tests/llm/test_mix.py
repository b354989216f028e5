"""The mix: targets as shared out by hand, totals near them, and the draw balanced and repeatable."""

from __future__ import annotations

import random

import pytest
from hard import empty_documents, hard_documents, words
from pyspark.sql import functions as F

from costgauge.llm import cube_mix


def plain_targets(sizes, weights, share, most):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        per = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if most * sizes[s] <= per * weight[s]}
        if not full:
            return out | {s: per * weight[s] for s in open_}
        out |= {s: most * sizes[s] for s in full}
        left -= sum(most * sizes[s] for s in full)
        open_ -= full
    return out


def test_flight_keeps_totals():
    rng = random.Random(3)
    for _ in range(50):
        sizes = [float(rng.choice([0, 5, 5, 40, 300])) for _ in range(200)]
        p = [rng.random() for _ in sizes]
        moved = cube_mix.flight(sizes, p, "x", land=False)
        assert sum(0 < q < 1 for q in moved) <= 2
        assert sum(moved) == pytest.approx(sum(p)) and sum(a * q for a, q in zip(sizes, moved, strict=True)) == pytest.approx(
            sum(a * q for a, q in zip(sizes, p, strict=True))
        )
        assert set(cube_mix.flight(sizes, moved, "y", land=True)) <= {0.0, 1.0}


def test_inclusion_is_unbiased():
    sizes, p = [1.0, 2.0, 3.0, 10.0, 4.0, 4.0], [0.3, 0.5, 0.2, 0.7, 0.1, 0.9]
    runs = [cube_mix.flight(sizes, p, str(i), land=True) for i in range(4_000)]
    assert [sum(c) / len(runs) for c in zip(*runs, strict=True)] == pytest.approx(p, abs=0.03)


def test_mix(spark):
    docs = hard_documents(spark)
    got = cube_mix.mix(docs).collect()
    assert sorted(str((r.id, r.source, r.size)) for r in got) == sorted(
        str((r.doc_id, r.source, len(words(r.text)))) for r in docs.collect()
    )
    sizes: dict = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    wanted = plain_targets(sizes, (3, 1, 2), 1.5, 2.0)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(wanted[r.source])
        assert 0 <= r.times <= 2
    again = cube_mix.mix(docs.repartition(7)).collect()
    assert sorted(str((r.id, r.source, r.size, r.times)) for r in got) == sorted(str((r.id, r.source, r.size, r.times)) for r in again)


def test_totals_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(cube_mix, "BLOCK", 64)
    monkeypatch.setattr(cube_mix, "MERGE", 4)
    sized = spark.range(5_000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"),
        (F.col("id") * 7919 % 400).alias("size"),
    )
    rows = cube_mix.decide(sized, order=["id"], weights=(3, 1, 2)).select("_row.*", "target", "times", "source_size").collect()
    taken: dict = {}
    for r in rows:
        taken[r.source] = taken.get(r.source, 0) + r.size * r.times
    for source, target in {r.source: r.target for r in rows}.items():
        assert taken[source] == pytest.approx(target, abs=400)


def test_mixed_documents(spark):
    docs = hard_documents(spark)
    used = cube_mix.mixed_documents(docs)
    assert used.columns == docs.columns
    before = docs.groupBy("doc_id").count().collect()
    after = {r.doc_id: r["count"] for r in used.groupBy("doc_id").count().collect()}
    assert all(after.get(r.doc_id, 0) <= 2 * r["count"] for r in before)
    assert cube_mix.mixed_documents(empty_documents(spark)).count() == 0
    assert cube_mix.mix(empty_documents(spark)).count() == 0
