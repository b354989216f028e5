"""Mixing sources to target weights by balanced sampling (the cube method).

A source's target over its size is the number of times each of its documents should be used. The whole part is taken as it
is; the fraction is an inclusion probability, and all probabilities of a source are moved together until they are 0 or 1.
Three open documents have one direction in which their probabilities can move without changing the expected number of
words and of documents; a move along it, forward or back with the odds that keep each probability's mean, closes at least
one of them. Blocks of a source move apart from each other and leave at most two open documents; these meet in larger
blocks in the next round, until a source has one block, whose last two documents are landed.

Only ids, sources and sizes are shuffled. Blocks are cut from the rank of all rows, so that no group grows with a source
and every run decides alike, however the rows are partitioned.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costgauge.llm.rows import WORD, checkpointed, packed, quoted, ranked, text_of, unpacked, with_key

BLOCK = 4096
MERGE = 1024
NEAR = 1e-12


def n_words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null text has none."""
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def targets(
    units: DataFrame, *, source_col: str, size_col: str, weights: Sequence[float], share: float, max_use: float
) -> DataFrame:
    """One row for each source: _source, _s (its place by code point, null last), source_size, target.

    The sources share `share` times all sizes by their weights, which repeat in the order of the sources. A target stops at
    max_use times its source's size, and the excess is shared again by weight among the others until none is above.
    """
    sizes = units.groupBy(F.col(source_col).alias("_source")).agg(F.sum(size_col).cast("long").alias("source_size"))
    placed = ranked(sizes.withColumn("_null", F.col("_source").isNull()), ["_null", "_source"], "_s").drop("_null")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_s") % len(weights)).cast("int"))
    weighed = checkpointed(placed.withColumns({"_weight": weight, "_cap": max_use * F.col("source_size")}))
    total = float(weighed.agg(F.sum("source_size")).first()[0] or 0) * share
    level, closed = 0.0, -1
    while True:
        # Closed: at their cap under the level so far. The level rises with each source that closes, so none opens again.
        at_cap = F.col("_cap") <= F.lit(level) * F.col("_weight")
        n, capped, open_weight = weighed.agg(
            F.count_if(at_cap),
            F.sum(F.when(at_cap, F.col("_cap")).otherwise(0.0)),
            F.sum(F.when(at_cap, 0.0).otherwise(F.col("_weight"))),
        ).first()
        if not n and not open_weight or n == closed or not open_weight:
            break
        closed, level = n, max(level, (total - capped) / open_weight)
    if closed >= 0 and not open_weight:
        target = F.col("_cap")
    else:
        target = F.least(F.col("_cap"), F.lit(level) * F.col("_weight"))
    return weighed.select("_source", "_s", "source_size", target.alias("target"))


def _step(sizes: list[float], p: list[float], at: list[int], draw: float) -> None:
    """Move the open probabilities `at` along the one direction that keeps the totals; close at least one."""
    if len(at) == 3:
        a, b, c = (sizes[i] for i in at)
        u = (b - c, c - a, a - b) if not a == b == c else (1.0, -1.0, 0.0)
    elif len(at) == 2:
        u = (sizes[at[1]], -sizes[at[0]]) if sizes[at[0]] or sizes[at[1]] else (1.0, -1.0)
    else:
        u = (1.0,)
    moving = [(i, x) for i, x in zip(at, u, strict=True) if x]
    ahead = min(((1 - p[i]) / x if x > 0 else p[i] / -x, i) for i, x in moving)
    back = min((p[i] / x if x > 0 else (1 - p[i]) / -x, i) for i, x in moving)
    forward = draw * (ahead[0] + back[0]) < back[0]
    length, hit = ahead if forward else back
    sign = 1.0 if forward else -1.0
    for i, x in moving:
        moved = p[i] + sign * length * x
        if i == hit:
            moved = 1.0 if sign * x > 0 else 0.0
        p[i] = 0.0 if moved < NEAR else 1.0 if moved > 1 - NEAR else moved


def flight(sizes: list[float], p: list[float], seed: str, land: bool) -> list[float]:
    """The probabilities after moving three open ones at a time; with land, the last two are closed as well."""
    p, at, rng = list(p), [], random.Random(seed)
    for i in range(len(p)):
        if 0.0 < p[i] < 1.0:
            at.append(i)
        while len(at) == 3:
            _step(sizes, p, at, rng.random())
            at = [j for j in at if 0.0 < p[j] < 1.0]
    while land and at:
        _step(sizes, p, at, rng.random())
        at = [j for j in at if 0.0 < p[j] < 1.0]
    return p


def _flights(seed: str, land: bool):
    """Map over partitions whose groups (_s, _block) lie together; a group has at most BLOCK rows."""

    def moved(group: pd.DataFrame) -> pd.DataFrame:
        # From large to small, so that what stays open weighs little.
        ordered = group.sort_values(["size", "_rank"], ascending=[False, True], kind="stable")
        key = f"{seed}/{ordered['_s'].iat[0]}/{ordered['_block'].iat[0]}"
        ordered["_p"] = flight(ordered["size"].astype(float).tolist(), ordered["_p"].tolist(), key, land)
        return ordered

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if rows.empty:
                continue
            last = (rows["_s"] == rows["_s"].iat[-1]) & (rows["_block"] == rows["_block"].iat[-1])
            whole, rest = rows[~last], rows[last]
            if len(whole):
                yield pd.concat([moved(group) for _, group in whole.groupby(["_s", "_block"], sort=False)])
        if rest is not None and len(rest):
            yield moved(rest)

    return run


def decide(
    units: DataFrame,
    *,
    order: Sequence[str],
    source_col: str = "source",
    size_col: str = "size",
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    max_use: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """How often each unit is used: _row (all columns), source_size, target (its source's) and times (long).

    order names columns that put the units in an order of their own; units equal in it and in size are interchangeable.
    No unit is used more than max_use times, rounded up. Units of size 0 count in the number of documents only.
    """
    inner = {f"_o{i}": c for i, c in enumerate(order)}
    rows = packed(units, _own=source_col, size=size_col, **inner)
    shares = targets(rows, source_col="_own", size_col="size", weights=weights, share=share, max_use=max_use)
    joined = rows.join(shares, F.col("_own").eqNullSafe(F.col("_source"))).drop("_source", "_own")
    mean = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    planned = joined.withColumn("_mean", mean).withColumn("_whole", F.floor("_mean").cast("long"))
    planned = planned.withColumn("_p", F.col("_mean") - F.col("_whole")).drop("_mean")
    placed = checkpointed(ranked(planned, ["_s", *inner, "size"]))
    blocks = max(1, -(-placed.count() // BLOCK))
    open_ = placed.select("_s", "_rank", "size", "_p", F.floor(F.col("_rank") / BLOCK).cast("long").alias("_block"))
    turn, done = 0, None
    while True:
        land = blocks == 1
        dealt = open_.repartition("_s", "_block").sortWithinPartitions("_s", "_block")
        moved = checkpointed(dealt.mapInPandas(_flights(f"{seed}/{turn}", land), dealt.schema))
        closed = (F.col("_p") == 0.0) | (F.col("_p") == 1.0)
        done = moved.where(closed) if done is None else done.unionByName(moved.where(closed))
        if land:
            break
        open_ = moved.where(~closed).withColumn("_block", F.floor(F.col("_block") / MERGE).cast("long"))
        blocks, turn = -(-blocks // MERGE), turn + 1
    chosen = done.select(F.col("_rank").alias("_place"), F.col("_p").cast("long").alias("_extra"))
    result = placed.join(chosen, F.col("_rank") == F.col("_place"))
    return result.select("_row", "source_size", "target", (F.col("_whole") + F.col("_extra")).alias("times"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """For each row: id, source, size (words), source_size, target and times; null text has size 0."""
    id_ = quoted(id_col)
    units = docs.select(
        id_.alias("id"), quoted(source_col).alias("source"), n_words(quoted(text_col)).alias("size"),
        F.xxhash64(F.lit(5), id_).alias("order"),
    )
    decided = decide(units, order=["order", "id"], **options)
    return decided.select("_row.id", "_row.source", "_row.size", "source_size", "target", "times")


def mixed_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The documents, all columns, each as often as the mix uses it.

    Rows with the same id, text and source are one unit, sized as all of them, and are used equally often.
    """
    rows = packed(docs, _id=id_col, _text=text_col, _own=source_col)
    keyed = with_key(rows, F.col("_id"), F.col("_text"), F.col("_own"))
    sized = keyed.select("_r1", "_r2", F.col("_own").alias("source"), n_words(F.col("_text")).alias("size"))
    units = sized.groupBy("_r1", "_r2", "source").agg(F.sum("size").alias("size"))
    decided = decide(units, order=["_r1", "_r2"], **options).where(F.col("times") > 0)
    used = keyed.select("_row", "_r1", "_r2").join(decided.select("_row._r1", "_row._r2", "times"), ["_r1", "_r2"])
    copies = used.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("_copy"))
    return unpacked(copies, docs.columns, {})
