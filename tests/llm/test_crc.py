"""Importance resampling with CRC buckets against plain Python."""

from __future__ import annotations

import math
import re
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa
from hard import empty_documents, hard_documents, prose

from costgauge.llm import crc_resampling

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_features(text, max_run):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    runs = [" ".join(words[i : i + n]) for n in range(1, max_run + 1) for i in range(len(words) - n + 1)]
    return len(words), runs


def plain_draw(rows, target, percent, min_words, max_run, buckets, seed):
    """doc_id, n_features, weight, score, rank of each (doc_id, text)."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    cut = [(i, *plain_features(text, max_run)) for i, text in rows]
    for _, _, runs in cut:
        for run in runs:
            s[bucket(run)] += 1
    for text in target:
        for run in plain_features(text, max_run)[1]:
            t[bucket(run)] += 1
    gain = [
        math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t, strict=True)
    ]
    out = []
    for i, n_words, runs in cut:
        h = int(sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(run)] for run in runs)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(runs), weight, score, n_words])
    able = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = {id(r): k + 1 for k, r in enumerate(able[: len(able) * percent // 100])}
    return [(*r[:4], drawn.get(id(r))) for r in out]


def test_crc_of_bytes():
    words = [b"", b"a", b"abc", "é日".encode(), b"abd", b"x" * 5_000, bytes(range(256)), b"abc"]
    bounds = np.cumsum([0, *map(len, words)])
    found = crc_resampling.crc_of(np.frombuffer(b"".join(words), np.uint8), bounds)
    assert found.tolist() == [zlib.crc32(w) for w in words]


def test_buckets_of_runs():
    texts = ["A b-c b", "", None, "b", "x1 é日 y", "...", "end"]
    got = list(crc_resampling.buckets_of(pa.array(texts, pa.string()), 3, 1_000))
    for n, (found, counts) in enumerate(got, 1):
        runs = [plain_features(t, n)[1][len(plain_features(t, n - 1)[1]) if n > 1 else 0 :] for t in texts]
        assert counts.tolist() == [len(r) for r in runs]
        assert found.tolist() == [zlib.crc32(f.encode()) % 1_000 for r in runs for f in r]


def test_draw(spark):
    docs = hard_documents(spark)
    aim = [prose(20, 60), "The HOUSE line of every page", None, ""]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(aim)], "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for max_run, percent in ((1, 10), (2, 40), (3, 100)):
        drawn = crc_resampling.draw(docs, target, percent=percent, max_run=max_run, buckets=500, min_words=20, seed=9)
        assert set(drawn.columns) == set(docs.columns) - {"text"} | {"n_features", "weight", "score", "rank"}
        got = [(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in drawn.collect()]
        assert sorted(got, key=str) == sorted(plain_draw(rows, aim, percent, 20, max_run, 500, 9), key=str)


def test_resample(spark):
    docs = hard_documents(spark)
    target = docs.where("doc_id = 22").select("text")
    ranks = crc_resampling.draw(docs, target, percent=30).where("rank is not null").collect()
    drawn = crc_resampling.resample(docs, target, percent=30)
    assert drawn.columns == docs.columns
    assert {r.doc_id for r in drawn.collect()} == {r.doc_id for r in ranks}


def test_empty(spark):
    docs, none = hard_documents(spark), spark.createDataFrame([], "text string")
    assert crc_resampling.draw(empty_documents(spark), none).count() == 0
    assert crc_resampling.resample(empty_documents(spark), none).count() == 0
    assert crc_resampling.draw(docs, none).count() == docs.count()
