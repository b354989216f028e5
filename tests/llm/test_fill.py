"""Fill-in-the-middle texts against plain Python, and back."""

from __future__ import annotations

import re
from hashlib import sha256

import pytest
from hard import SCHEMA, empty_documents, hard_documents
from pyspark.sql import functions as F

from costgauge.llm import fill_middle


def plain_fill(i, text, rate=50, spm_rate=80, seed=42):
    """n, form, prefix_chars, middle_chars, output."""
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digits = sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digits[8 * k : 8 * k + 8], 16) for k in range(4)]
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(u) for u in (units[:low], units[low:high], units[high:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm_rate:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.fixture(scope="module")
def docs(spark):
    """The hard rows, and many small ones around marks and white space."""
    texts = ["a <P", "P> b", "<P> x", "x <S>", "a\x00b c", " \n", "\n a", "a \n", "<", "a < S > b", "\xa0x y", "<M", "M>", "日 本 語"]
    rows = [(1_000 + k, texts[k % len(texts)], "en", "a", 1, *[0] * (len(SCHEMA.split(",")) - 5)) for k in range(200)]
    return hard_documents(spark).unionByName(spark.createDataFrame(rows, SCHEMA))


@pytest.mark.parametrize(("rate", "spm_rate"), [(50, 80), (100, 0), (100, 50), (0, 80)])
def test_transform(docs, rate, spm_rate):
    made = fill_middle.transform(docs, rate=rate, spm_rate=spm_rate)
    assert set(made.columns) == set(docs.columns) | set(fill_middle.MADE)
    rows = made.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert len(rows) == docs.count()
    for r in rows:
        got = (r.n, r.form, r.prefix_chars, r.middle_chars, r.output)
        assert got == plain_fill(r.doc_id, r.text, rate, spm_rate) and r.back == (r.text or "")
    assert {r.source for r in rows} == {r.source for r in docs.collect()}


def test_empty(spark):
    assert fill_middle.transform(empty_documents(spark)).count() == 0


def test_marks():
    assert fill_middle.checked_marks(("[pre]", "[suf]", "[mid]"))
    for marks in (("<P>", "<P>", "<M>"), ("aba", "x", "y"), ("ab", "bc", "x"), ("abc", "b", "x"), ("", "a", "b")):
        with pytest.raises(ValueError):
            fill_middle.checked_marks(marks)
