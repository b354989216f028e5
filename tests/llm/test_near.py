"""Near duplicates against all pairs, and what the sketches promise."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from hard import empty_documents, hard_documents, prose, words

from costgauge.llm import components, order_minhash
from costgauge.llm.grams import word_hashes


def similarity(a, b):
    """Longest common row of words over all words, by plain dynamic programming."""
    if not a or not b:
        return float(a == b)
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1] / (len(a) + len(b) - row[-1])


def shared_words(a, b):
    return sum((Counter(a) & Counter(b)).values())


def plain_classes(rows):
    runs = [words(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if runs[i] == runs[j] or min(len(runs[i]), len(runs[j])) >= 0.8 * max(len(runs[i]), len(runs[j])) and (
                shared_words(runs[i], runs[j]) > 0.8 * len(runs[i]) and similarity(runs[i], runs[j]) >= 0.8
            ):
                up[top(i)] = top(j)
    least: dict = {}
    for i, (doc, _) in enumerate(rows):
        best = least.get(top(i))
        least[top(i)] = doc if best is None else best if doc is None else min(best, doc)
    return [(doc, least[top(i)]) for i, (doc, _) in enumerate(rows)]


def near(seed, text, edits):
    rng = random.Random(seed)
    w = text.split(" ")
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(9)}"
    return " ".join(w)


def family(n=8):
    """Near copies of some texts, copies that drift step by step, and unlike texts around one shared passage."""
    passage, rows = prose(99, 90), []
    for t in range(4):
        text = prose(1000 + t, 150)
        rows += [(100 * t + i, near(i, text, i % 4)) for i in range(n)]
        drift = prose(2000 + t, 120)
        for i in range(6):
            drift = near(50 + i, drift, 1)
            rows.append((1000 + 100 * t + i, drift))
    return rows + [(5000 + i, prose(3000 + i, 60) + " " + passage) for i in range(30)]


def test_classes_equal_all_pairs(spark):
    rows = family()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((r.doc_id, r.class_id) for r in order_minhash.classes(docs).collect())
    assert got == sorted(plain_classes(rows))


def test_hard_rows(spark):
    docs = hard_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = [(r.doc_id, r.class_id) for r in order_minhash.classes(docs).collect()]
    assert sorted(got, key=str) == sorted(plain_classes(rows), key=str)
    kept = order_minhash.representatives(docs)
    assert kept.columns == docs.columns
    classes = {c for _, c in got}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, classes))
    assert order_minhash.classes(empty_documents(spark)).count() == 0
    assert order_minhash.representatives(empty_documents(spark)).count() == 0


def test_order_matters():
    """Two texts of the same runs in another order share few sketches and do not align."""
    rng = np.random.default_rng(1)
    runs = rng.integers(0, 2**63, 400).astype(np.uint64)
    swapped = np.concatenate([runs[200:], runs[:200]])
    same = order_minhash.sketch(runs) == order_minhash.sketch(runs.copy())
    assert same.all() and (order_minhash.sketch(runs) == order_minhash.sketch(swapped)).mean() < 0.7
    assert order_minhash.aligned(runs, swapped) == 0.0 and order_minhash.aligned(runs, runs) == 1.0


def test_alignment_equals_dynamic_programming():
    """Also with words that repeat, insertions, deletions and moved parts, in short and long texts."""
    rng = random.Random(5)
    for trial in range(300):
        a = [rng.randrange(rng.choice([3, 40, 10_000])) for _ in range(rng.choice([1, 3, 9, 60, 200]))]
        b = list(a)
        for _ in range(rng.randrange(1 + len(a) // 8)):
            at = rng.randrange(len(b))
            b[at : at + rng.randrange(3)] = [rng.randrange(40) for _ in range(rng.randrange(3))]
            b = b or [1]
        if trial % 7 == 0:
            b = b[len(b) // 9 :] + b[: len(b) // 9]
        wanted = similarity(a, b)
        got = order_minhash.aligned(np.array(a, np.uint64), np.array(b, np.uint64))
        assert got == pytest.approx(wanted) if wanted >= 0.8 else got < 0.8


def test_word_hashes_do_not_depend_on_place():
    texts = ["", "a bb  ccc", "ccc a", " \n", "x" * 3_000_000 + " bb", "a b " * 600_000 + "ccc"]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    bounds = np.cumsum([0, *map(len, raw)])
    hashes, first = word_hashes(data, bounds, marks=False)
    seen: dict = {}
    for i, text in enumerate(texts):
        own = hashes[first[i] : first[i + 1]].tolist()
        assert len(own) == len(text.split())
        for word, value in zip(text.split(), own, strict=True):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_components(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    mixed = [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    links = chain + star + mixed
    got = {r.node: r.comp for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    up: dict = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        if a != b:
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    assert got == {x: top(x) for x in up}


def test_components_store_few_tables(spark, monkeypatch):
    """Links of a hub with the greatest id are read again by their tops only, and short chains end in one job."""
    sizes = []

    def counted(df, name):
        sizes.append(df.count())
        return stored(df, name)

    stored = components.stored
    monkeypatch.setattr(components, "stored", counted)
    links = [(i, 10_000) for i in range(500)] + [(20_000 + i, 20_001 + i) for i in range(2)]
    got = {r.node: r.comp for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(500)}, 10_000: 0, **{20_000 + i: 20_000 for i in range(3)}}
    assert len(sizes) <= 4 and sum(sizes) < 2.1 * len(links)


def star(n=1000, size=150):
    """A source and copies of it at 0.82 to 0.88 whose edits are independent, so that most are under 0.8 to each other."""
    source = prose(77, size).split()
    copies = []
    for seed in range(n):
        rng = random.Random(seed)
        w = list(source)
        while similarity_of_edits(source, w) > 0.88:
            w[rng.randrange(size)] = f"own{seed}x{rng.randrange(10**6)}"
        copies.append(" ".join(w))
    return " ".join(source), copies


def similarity_of_edits(a, b):
    """Of texts that differ in replaced words only."""
    runs = [[tuple(w[i : i + 5]) for i in range(len(w) - 4)] for w in (a, b)]
    common = sum(x == y for x, y in zip(*runs, strict=True))
    return common / (2 * len(runs[0]) - common)


def test_star(spark):
    """Copies meet through their source, wherever it is in their buckets."""
    source, copies = star()
    copies = [c for c in copies if similarity_of_edits(source.split(), c.split()) >= 0.82]
    assert len(copies) > 600
    pairs = [similarity_of_edits(a.split(), b.split()) for a, b in zip(copies, copies[1:], strict=False)]
    assert sum(p < 0.8 for p in pairs) > 0.9 * len(pairs)
    rows = [(1, source)] + [(10 + i, c) for i, c in enumerate(copies)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {r.class_id for r in order_minhash.classes(docs).collect()} == {1}


def test_signatures_allow_every_similar_pair():
    """What blocks of signatures leave out is not similar, at all sizes and components."""
    rng = np.random.default_rng(3)
    texts = []
    for base in (3, 9, 31, 33, 70, 130):
        runs = rng.integers(0, 2**63, base).astype(np.uint64)
        for _ in range(12):
            own = runs.copy()
            edits = rng.integers(0, base // 5 + 1)
            own[rng.integers(0, base, edits)] = rng.integers(0, 2**63, edits).astype(np.uint64)
            texts.append(own[: base - rng.integers(0, base // 8 + 1)])
    texts.sort(key=len)
    n = np.array([len(t) for t in texts])
    comp = np.arange(len(texts)) % 7
    got = {(i, int(j)) for i, js in order_minhash.near_pairs(n, [order_minhash.signature(t) for t in texts], comp, 0.8) for j in js}
    wanted = {
        (i, j) for i in range(len(texts)) for j in range(i + 1, len(texts))
        if comp[i] != comp[j] and order_minhash.aligned(texts[i], texts[j]) >= 0.8 - 1e-9
    }
    assert wanted and wanted <= got and len(got) < 2 * len(wanted) + 20


def sketches_of(text):
    data = text.encode()
    hashes, _ = word_hashes(np.frombuffer(data, np.uint8), np.array([0, len(data)]), marks=False)
    return order_minhash.sketch(order_minhash.runs_of(hashes))


def test_short_pairs_of_few_sketches(spark):
    """Texts of 8 and 9 words are one class though they share a few sketches only."""
    rows, seed = [], 0
    while len(rows) < 6:
        text = prose(100_000 + seed, 9).replace("\n", " ")
        short = text.rsplit(" ", 1)[0]
        if 1 <= (sketches_of(text) == sketches_of(short)).sum() <= 5:
            rows += [(2 * len(rows) + 1, text), (2 * len(rows) + 2, short)]
        seed += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.class_id) for r in order_minhash.classes(docs).collect())
    assert got == sorted(plain_classes(rows)) and len({c for _, c in got}) == 3


def test_recall_by_edit_similarity(spark):
    """Pairs of all documents of sf0.01 by the words that difflib-like alignment finds in both, against classes."""
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    of = {r.doc_id: r.class_id for r in order_minhash.classes(frame).collect()}
    texts = [(r.doc_id, words(r.text)) for r in frame.collect()]
    held: dict = {}
    for at, (_, w) in enumerate(texts):
        for word in set(w):
            held.setdefault(word, []).append(at)
    shared: Counter = Counter()
    for places in held.values():
        if len(places) <= 60:  # rarer words; near copies of long texts share many
            shared.update((i, j) for k, i in enumerate(places) for j in places[k + 1 :])
    pairs = {0.95: [], 0.9: [], 0.85: []}
    hashed = {at: np.array([hash(x) & (2**63 - 1) for x in w], np.uint64) for at, (_, w) in enumerate(texts)}
    for (i, j), n in shared.items():
        a, b = texts[i][1], texts[j][1]
        if a != b and n >= 3 and min(len(a), len(b)) > 0.7 * max(len(a), len(b)) and min(len(a), len(b)) >= 8:
            found = order_minhash.aligned(hashed[i], hashed[j], 0.7)
            ratio = 2 * found / (1 + found)  # 2 x aligned words over the words of both
            for least in pairs:
                if ratio >= least:
                    pairs[least].append(of[texts[i][0]] == of[texts[j][0]])
    rates = {least: (sum(met), len(met)) for least, met in pairs.items()}
    print(rates)
    for least in (0.9, 0.95):
        met, n = rates[least]
        assert n > 20 and met >= 0.9 * n, rates
