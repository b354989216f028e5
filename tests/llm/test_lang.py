"""Languages by compression: held-out accuracy, rejection, hard rows."""

from __future__ import annotations

import zlib

import pytest
from hard import empty_documents, hard_documents
from pyspark.sql import functions as F

from costgauge.llm import compress_lang
from costgauge.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def test_held_out(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    truth = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    rows = QUERIES["op13_compress_lang"](spark, SMALL).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        has_letter = any(c.isalpha() for c in truth[r.doc_id][1] or "")
        assert (r.lang_pred == "und") != has_letter
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert sum(r.lang_pred == truth[r.doc_id][0] for r in held) / len(held) > 0.98
    sure = [r for r in held if not r.narrow]
    assert sum(r.lang_pred == truth[r.doc_id][0] for r in sure) / len(sure) > 0.99


def test_text_alone_decides(spark):
    """Neither id, source nor given language of a row changes what is predicted for it."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(200)
    model = compress_lang.fit(docs)
    other = docs.select((F.col("doc_id") + 7).alias("doc_id"), "text", F.lit("xx").alias("lang"), F.lit("s").alias("source"))
    first = {(r.doc_id, r.lang_pred, r.score) for r in compress_lang.identify(docs, model).collect()}
    second = {(r.doc_id - 7, r.lang_pred, r.score) for r in compress_lang.identify(other, model).collect()}
    assert first == second


def test_letters():
    assert compress_lang.letters("Ab, 12 c!\n") == b" ab c "
    assert compress_lang.letters("ÄB") == " äb ".encode()
    assert compress_lang.letters("12 … — 😀") == b"" and compress_lang.letters("") == b""
    assert compress_lang.letters("日本") == " 日本 ".encode()


def test_pieces_cover_the_text():
    text = compress_lang.letters("word " * 1_000 + "x" * 900 + " tail")
    parts = compress_lang._pieces_of(text)
    assert b"".join(parts) + b" " == text and all(p for p in parts)


def test_hard_rows(spark):
    docs = hard_documents(spark)
    model = compress_lang.fit(docs)
    assert "ja" in model.dictionaries and "en" in model.dictionaries
    for reject in (True, False):
        found = compress_lang.identify(docs, model, reject=reject)
        assert set(found.columns) == set(docs.columns) | {"lang_pred", "score", "lead", "narrow"}
        rows = found.collect()
        assert len(rows) == docs.count()
        for r in rows:
            if not any(c.isalpha() for c in r.text or ""):
                assert (r.lang_pred, r.score) == ("und", 0.0)
            elif r.narrow and reject:
                assert r.lang_pred == "und"
            else:
                assert r.lang_pred in model.dictionaries
    same = {r.text: set() for r in rows}
    for r in rows:
        same[r.text].add((r.lang_pred, r.score))
    assert all(len(v) == 1 for v in same.values())


def test_nothing_to_learn(spark):
    none = compress_lang.fit(empty_documents(spark))
    assert none.dictionaries == {}
    assert {r.lang_pred for r in compress_lang.identify(hard_documents(spark), none).collect()} == {"und"}
    assert compress_lang.identify(empty_documents(spark), none).count() == 0


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(compress_lang, "LANGUAGES", 2)
    with pytest.raises(ValueError, match="languages"):
        compress_lang.fit(hard_documents(spark))
