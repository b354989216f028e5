"""The prefix tree: texts come back, layout and attention intervals are those of a walk."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from costgauge.llm import chat_tree

SCHEMA = "conv_id long, turn long, role string, text string, node int, k1 int, formatted string"
HARD = "\\### Assistant: </turn> <turn user> &lt;&amp; &gt; ok"


def rows_of(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 7)):
            role = ("user", "assistant")[turn % 2]
            rows.append((conv, turn, role, f"say {rng.randrange(2)}" if turn < 3 else f"more {rng.randrange(5)}"))
    rows += [(100, 0, "user", HARD), (100, 1, "assistant", HARD), (101, 0, None, None), (101, None, "a>b<&", ""),
             (102, 0, "user", "twice"), (102, 0, "user", "twice"), (None, 0, "assistant", "x" * 50_000)]
    return [(*row, 1, 2, "clash") for row in rows]


@pytest.fixture(scope="module")
def tree(spark):
    turns = spark.createDataFrame(rows_of(1), SCHEMA)
    nodes, held = chat_tree.build(turns)
    return rows_of(1), nodes.collect(), held.collect(), chat_tree.read_back(nodes, held).collect()


def said(rows):
    convs: dict = {}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    for conv, _, role, text, *_ in order:
        convs.setdefault(conv, []).append((role or "", text or ""))
    return convs


def test_texts_come_back(tree):
    rows, _, _, read = tree
    got = {row.conv: [(t.role, t.text) for t in row.turns] for row in read}
    assert got == said(rows)
    for row in read:
        for turn in row.turns:
            assert turn.loss == (turn.text if turn.role == "assistant" else None)


def test_layout(tree):
    rows, nodes, held, _ = tree
    convs = said(rows)
    prefixes = {tuple(turns[: i + 1]) for turns in convs.values() for i in range(len(turns))}
    assert len(nodes) == len(prefixes)  # a shared beginning is written once
    by_node = {n.node: n for n in nodes}
    assert sorted(by_node) == list(range(len(nodes)))
    at, open_ = 0, []
    for i in range(len(nodes)):
        node = by_node[i]
        assert node.start == at and node.end - node.start == len(node.formatted)
        at = node.end
        open_ = open_[: node.depth - 1]  # depth first: the node above is on the way down
        assert node.parent == (open_[-1].node if open_ else None)
        assert node.position == sum(len(n.formatted) for n in open_)
        covered = [p for a in node.attends for p in range(a.start, a.end)]
        assert covered == [p for n in open_ for p in range(n.start, n.end)]
        assert all(a.end < b.start for a, b in zip(node.attends, node.attends[1:], strict=False))
        open_.append(node)
    assert sum(n.conversations for n in nodes) == len(rows) == len(held)


def test_empty(spark):
    nodes, held = chat_tree.build(spark.createDataFrame([], SCHEMA))
    assert nodes.count() == held.count() == chat_tree.read_back(nodes, held).count() == 0


def test_long_conversations_share_beginnings(spark):
    """20,000 turns in one conversation, others that leave it at many depths, and many rows without an id."""
    long = [(1, i, ("user", "assistant")[i % 2], f"t{i % 7}") for i in range(20_000)]
    leaving = [row for conv in range(2, 12) for row in [(conv, *r[1:]) for r in long[: conv * 50]] + [(conv, 10**6, "user", f"x{conv}")]]
    nameless = [(None, i, "user", "n") for i in range(3_000)]
    rows = [(*row, 1, 2, "clash") for row in long + leaving + nameless]
    nodes, held = chat_tree.build(spark.createDataFrame(rows, SCHEMA))
    got = {row.conv: [(t.role, t.text) for t in row.turns] for row in chat_tree.read_back(nodes, held).collect()}
    assert got == said(rows)
    found = nodes.select("node", "parent", "depth", "start", "end", "position", "attends").orderBy("node").collect()
    assert len(found) == 20_000 + 10 + 3_000
    path: list = []
    for node in found:
        del path[node.depth - 1 :]
        assert node.parent == (path[-1].node if path else None)
        assert node.position == sum(a.end - a.start for a in node.attends)
        if path:
            assert node.position == path[-1].position + path[-1].end - path[-1].start
            assert node.attends[-1].end == path[-1].end and node.attends[0].start == path[0].start
        path.append(node)


def test_tokens_of_no_length(spark):
    """Turns may have no tokens: they take no place and no interval."""
    rows = [(c, i, "user", f"{i if i < 2 else c}") for c in range(3) for i in range(4)]
    turns = spark.createDataFrame([(*row, 1, 2, "clash") for row in rows], SCHEMA)
    nodes, _ = chat_tree.build(turns, n_tokens=lambda line: F.when(F.contains(line, F.lit(">0<")), 0).otherwise(2))
    for node in nodes.collect():
        assert all(a.start < a.end for a in node.attends)
        assert node.position == sum(a.end - a.start for a in node.attends)
