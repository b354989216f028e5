"""Bit-sliced search against plain arithmetic."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from costgauge.llm import bit_sliced

SCHEMA = "vec_id long, embedding array<float>, label int, ids int, score int"


def rows_of(n: int, dims: int, spread: int) -> list[tuple]:
    rng = random.Random(n + spread)
    rows = [(i, [rng.randrange(-spread, spread + 1) / 64 for _ in range(dims)], 0, 1, 2) for i in range(n)]
    rows += [(n, None, 0, 1, 2), (n + 1, [0.1, None] + [0.0] * (dims - 2), 0, 1, 2), (n + 2, [math.nan] * dims, 0, 1, 2),
             (n + 3, [math.inf] * dims, 0, 1, 2), (None, [0.5] * dims, 0, 1, 2), (n + 4, [0.5] * (dims - 1), 0, 1, 2),
             (n + 5, [], 0, 1, 2), (n + 6, [3e5] * dims, 0, 1, 2), (n + 7, [-7e6] + [0.25] * (dims - 1), 0, 1, 2),
             (n + 8, [1e8] + [0.0] * (dims - 1), 0, 1, 2)]
    return rows + rows[:3]


def plain(rows, asked, k):
    good = [
        (i, [math.floor(np.float32(x).item() * 256) for x in v])
        for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q in sorted({i for i, _ in good if asked(i)}):
        query = next(v for i, v in good if i == q)
        scores = sorted((-sum(a * b for a, b in zip(query, v, strict=False)), i) for i, v in good if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize(("n", "dims", "spread", "block"), [(150, 8, 64, 64), (90, 5, 1, 32), (3, 3, 9, 1000)])
def test_top_k(spark, n, dims, spread, block):
    rows = rows_of(n, dims, spread)
    vectors = spark.createDataFrame(rows, SCHEMA)
    got = bit_sliced.top_k(vectors, vectors.where("vec_id % 5 = 0"), k=5, block_rows=block, group_rows=7)
    assert sorted(map(tuple, got.collect())) == plain(rows, lambda i: i % 5 == 0, 5)


@pytest.mark.parametrize("large", [[1e30, 0.0], [1e10, 1e10]])
def test_scores_beyond_64_bits_stop_the_query(spark, large):
    vectors = spark.createDataFrame([(0, large, 0, 1, 2), (1, large, 0, 1, 2)], SCHEMA)
    with pytest.raises(Exception, match="64 bits"):
        bit_sliced.top_k(vectors, vectors).collect()


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert bit_sliced.top_k(empty, empty).count() == 0


def test_added_is_a_sum():
    rng = np.random.default_rng(1)
    weights = rng.integers(0, 6, 40)
    bits = rng.integers(0, 2, (40, 128)).astype(np.uint8)
    columns: dict = {}
    for weight, row in zip(weights, bits, strict=True):
        columns.setdefault(int(weight), []).append(np.packbits(row, bitorder="little").view(np.uint64))
    total = bit_sliced.added(columns)
    unpacked = sum(np.unpackbits(b.view(np.uint8), bitorder="little").astype(int) << r for r, b in total)
    assert (unpacked == (bits * (1 << weights)[:, None]).sum(axis=0)).all()
