"""Line dedup and line frequency against plain Python."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from hard import CLASHES, empty_documents, hard_documents, words

from costgauge.llm import line_dedup, line_frequency

WHITE = " \t\n\x0b\f\r"


def key(line: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(WHITE))


def plain_dedup(rows, min_docs, keep_first):
    docs, first = defaultdict(set), {}
    for i, text in rows:
        for pos, line in enumerate((text or "").split("\n")):
            place = (i is not None, i or 0, pos)
            docs[key(line)].add(i)
            first[key(line)] = min(first.get(key(line), place), place)
    out = []
    for i, text in rows:
        kept = []
        for pos, line in enumerate((text or "").split("\n")):
            frequent = key(line) and len(docs[key(line)]) >= min_docs
            if not frequent or keep_first and first[key(line)] == (i is not None, i or 0, pos):
                kept.append(line)
        out.append((i, "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("min_docs", "keep_first"), [(10, False), (2, True), (2, False), (1, True)])
def test_dedup_lines(spark, min_docs, keep_first):
    docs = hard_documents(spark)
    got = line_dedup.dedup_lines(docs, min_docs=min_docs, keep_first=keep_first)
    assert got.columns == docs.columns
    found = got.collect()
    rows = [(row.doc_id, row.text) for row in docs.collect()]
    assert sorted(((row.doc_id, row.text) for row in found), key=str) == plain_dedup(rows, min_docs, keep_first)
    assert all([row[c] for c in CLASHES] == list(range(len(CLASHES))) for row in found)


def test_bitmaps_are_sparse(spark):
    """A word of 64 lines that loses none is not stored."""
    text = "\n".join(f"line {i}" for i in range(1_000)) + "\nshared"
    docs = spark.createDataFrame([(i, text if i == 1 else "shared") for i in (1, 2)], "doc_id long, text string")
    sizes = {len(row.keep): [w.word for w in row.keep] for row in line_dedup.keep_bitmaps(docs, min_docs=2).collect()}
    assert sorted(sum(sizes.values(), [])) in ([0], [0, 15], [15]) or sizes == {1: [0]}
    kept = line_dedup.dedup_lines(docs, min_docs=2, keep_first=False).collect()
    assert {row.doc_id: len(row.text.split("\n")) for row in kept} == {1: 1_000, 2: 1}


def test_empty_table(spark):
    empty = empty_documents(spark)
    assert line_dedup.dedup_lines(empty).count() == 0
    assert line_frequency.judge(empty).count() == 0


def plain_counts(text):
    text = text or ""
    w = words(text)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    filled = [line for line in text.split("\n") if words(line)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, len(filled) - len(set(filled)), len(covered)


def plain_kept(rows, max_docs, min_share, distinct_texts):
    texts = defaultdict(set)
    for i, text, host in rows:
        for line in (text or "").split("\n"):
            texts[key(line), host].add(text if distinct_texts else (i, text))
    out = []
    for i, text, host in rows:
        keys = [key(line) for line in (text or "").split("\n")]
        chars = sum(map(len, keys))
        own = sum(len(k) for k in keys if len(texts[k, host]) <= max_docs)
        counts = plain_counts(text)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        out.append((i, *counts, failed, not failed and (not chars or own / chars >= min_share)))
    return sorted(out, key=str)


@pytest.mark.parametrize("distinct_texts", [False, True])
@pytest.mark.parametrize(("max_docs", "min_share"), [(10, 0.3), (10, 0.95), (1, 0.5)])
def test_judge(spark, max_docs, min_share, distinct_texts):
    docs = hard_documents(spark)
    found = line_frequency.judge(docs, max_docs=max_docs, min_share=min_share, distinct_texts=distinct_texts)
    assert [c for c in docs.columns if c not in ("text", "kept")] == found.columns[: len(docs.columns) - 2]
    got = [(r.doc_id, *[r[c] for c in line_frequency.COUNTS], r.base_failed, r.kept) for r in found.collect()]
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert sorted(got, key=str) == plain_kept(rows, max_docs, min_share, distinct_texts)


def test_repeated_words(spark):
    texts = ["a b c a b c", "a a a a", "a b c d", "a b", "x y z " * 500 + "u v w", "a b c x a b c y a b c"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.n_repeat_words for r in line_frequency.with_text_counts(docs).collect()}
    assert got == {i: plain_counts(t)[4] for i, t in enumerate(texts)}


def test_counts_keep_a_tables_own_columns(spark):
    """Columns that have the names used inside stay, and so does one whose name holds a dot."""
    docs = hard_documents(spark).withColumnsRenamed({"n": "_words", "times": "_grams"})
    found = line_frequency.with_text_counts(docs)
    assert found.columns == [*docs.columns, *line_frequency.COUNTS]
    got = [tuple(row) for row in found.collect()]
    assert sorted(got, key=str) == sorted(((*r, *plain_counts(r.text)) for r in docs.collect()), key=str)
