"""Importance resampling, and all stages over a small corpus against plain Python."""

from __future__ import annotations

import math
import random

import public_tokenizers
import pytest
from hard import CLASHES, SCHEMA, empty_documents, hard_documents, prose, words
from test_lines import plain_dedup
from test_near import plain_classes
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from costgauge.llm import resampling

TINY = "/root/testdata/sf0.001"


def junk(seed: int, n: int) -> str:
    return " ".join(w.upper() + "!!" for w in prose(seed, n).split())


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """60 good and 30 bad documents, near copies, a shared line; labels for half of them."""
    folder = tmp_path_factory.mktemp("corpus")
    rows, labels = [], []
    for i in range(60):
        text = prose(i, 90)
        rows.append((i, text + ("\nShared line of the house" if i % 3 == 0 else ""), "en", f"s{i % 4}"))
        labels.append((i, 1, 0))
        if i % 5 == 0:
            rows.append((1_000 + i, text.replace("alpha", "alphas", 1), "en", "s9"))
    for i in range(100, 130):
        rows.append((i, junk(i, 80), "en", f"s{i % 4}"))
        labels.append((i, 0, 0))
    rows += [(200, None, None, None), (201, "", "en", "s1"), (202, rows[0][1], "en", "s1")]
    frame = spark.createDataFrame([(*r, len(r[1] or ""), *range(len(CLASHES))) for r in rows], SCHEMA)
    frame.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels + [(None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    return str(folder), rows


def test_classifier(spark, corpus):
    folder, rows = corpus
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    judged = resampling.classify(docs, labels).collect()
    kept = {r.doc_id for r in judged if r.kept}
    assert len(judged) == len(rows)
    assert not kept & {200, 201} and len(kept & set(range(60))) >= 57 and len(kept & set(range(100, 130))) <= 2
    drawn = resampling.resample(docs, labels)
    assert drawn.columns == docs.columns and {r.doc_id for r in drawn.collect()} == kept
    again = resampling.resample(docs.repartition(5), labels)
    assert {r.doc_id for r in again.collect()} == kept


def test_ratio_is_that_of_the_models(spark, corpus):
    """Counts, ratios and sums by plain Python over the same hashes."""
    import numpy as np
    import pyarrow as pa

    folder, rows = corpus
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    chosen = {r._id: (r._good, r._held) for r in resampling.labelled_sample(labels).collect()}
    raw, target = [1] * resampling.BUCKETS, [1] * resampling.BUCKETS
    grams = {}
    for i, text, *_ in rows:
        buckets, _ = resampling._buckets(pa.array([text], pa.string()))
        grams[i] = buckets.tolist()
        for b in grams[i]:
            raw[b] += 1
            target[b] += bool(i in chosen and chosen[i][0] and not chosen[i][1])
    model = resampling.fit(docs, labels)
    wanted = [math.log(t / sum(target)) - math.log(r / sum(raw)) for t, r in zip(target, raw, strict=True)]
    assert np.allclose(model.ratio, wanted)
    for r in resampling.classify(docs, labels).collect():
        assert r.n_grams == len(grams[r.doc_id])
        assert r.log_ratio == pytest.approx(sum(wanted[b] for b in grams[r.doc_id]), abs=1e-6)


def test_classifier_on_hard_rows(spark):
    docs = hard_documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    judged = resampling.classify(docs, none).collect()
    assert len(judged) == docs.count() and all(r.kept in (True, False) for r in judged)
    assert resampling.classify(empty_documents(spark), none).count() == 0
    assert resampling.resample(empty_documents(spark), none).count() == 0


def test_stages(spark, corpus):
    """Each stage on what the one before it kept; the last gives the ids of the texts."""
    folder, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names, rng = docs.columns, random.Random(1)
    quality, lines, near, mix, encode = (f for _, f in corpus_pipeline.STAGES)
    drawn = quality(spark, docs, folder)
    cut = lines(spark, drawn, folder)
    assert cut.columns == names
    rows = [(r.doc_id, r.text) for r in drawn.collect()]
    found = [(r.doc_id, r.text) for r in cut.collect()]
    assert sorted(found, key=str) == plain_dedup(rows, 10, True)
    assert all(r.n_chars == len(r.text) for r in cut.collect())
    single = near(spark, cut, folder)
    assert sorted(str(r.doc_id) for r in single.collect()) == sorted({str(c) for _, c in plain_classes(found)})
    used = mix(spark, single, folder)
    assert used.columns == names
    size, total = sum(len(words(r.text)) for r in single.collect()), sum(len(words(r.text)) for r in used.collect())
    assert total == pytest.approx(1.5 * size, rel=0.1)
    encoded = encode(spark, used, folder).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in used.collect()}
    for row in rng.sample(encoded, 20):
        assert row.ids == library.encode(texts[row.doc_id], add_special_tokens=False).ids
    assert len(encoded) == used.count()


def test_run(spark, corpus):
    folder, _ = corpus
    first = corpus_pipeline.run(spark, folder)
    second = corpus_pipeline.run(spark, folder)
    assert "ids" in first.columns and "text" not in first.columns
    assert sorted(map(str, first.collect())) == sorted(map(str, second.collect()))


def test_registered():
    names = [n for n in queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in queries() and corpus_pipeline.ORACLE_SQL is None and "pipeline" not in oracle_sql()


def test_queries_equal_sql(spark):
    """The operators that SQL can express, over the smallest tables."""
    import pandas as pd

    import check
    from costgauge.llm.queries import QUERIES, SQL

    connection = check.duck(TINY)
    for name, sql in SQL.items():
        frame = QUERIES[name](spark, TINY)
        got = pd.DataFrame([tuple(row) for row in frame.collect()], columns=frame.columns, dtype=object)
        found = connection.execute(sql)
        wanted = pd.DataFrame(found.fetchall(), columns=[d[0] for d in found.description], dtype=object)
        assert check.differences(got, wanted) is None, name


def test_draw_is_gumbel_top_k(spark, corpus):
    """Noise, keys, k and the drawn rows by plain Python, from the rows' identities and weights."""
    import math
    import struct

    import xxhash
    from pyspark.sql import functions as F

    from costgauge.llm.rows import with_key

    folder, rows = corpus
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = resampling.fit(docs, labels)
    scored = resampling.with_scores(docs, model, id_col="doc_id", text_col="text")
    keyed = with_key(docs.select("doc_id", "text"), F.col("doc_id"), F.col("text")).collect()
    identity = {r.doc_id: (r._r1, r._r2) for r in keyed}
    assert len(identity) == len(rows) and None not in identity

    def noise(pair):
        seed = xxhash.xxh64_intdigest(struct.pack("<i", resampling.SEED), seed=42)
        for half in pair:
            seed = xxhash.xxh64_intdigest(struct.pack("<q", half), seed=seed)
        return -math.log(-math.log(((seed >> 11) + 0.5) / float(1 << 53)))

    got = [(r._id, r._n, r._ratio, r._weight, r._key) for r in scored.collect()]
    keys = {}
    for i, n, ratio, weight, key in got:
        assert (weight is None) == (key is None) == (not n)
        if n:
            assert math.isclose(weight, ratio - model.rate * n, abs_tol=1e-9)
            assert math.isclose(key, weight + noise(identity[i]), abs_tol=1e-9)
            keys[i] = weight + noise(identity[i])
    k = sum(weight is not None and weight >= 0 for *_, weight, _ in got)
    assert 0 < k < len(keys)
    kept = {r.doc_id for r in resampling.classify(docs, labels).collect() if r.kept}
    assert kept == set(sorted(keys, key=keys.get, reverse=True)[:k])
