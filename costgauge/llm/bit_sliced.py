"""Exact top-k by inner product over a bit-sliced index.

Vectors are turned into whole numbers and cut into blocks of rows in the order of their ids. A block stores, for each
dimension, one bitmap for each bit of the values above the block's least. A query's scores over a block are added bit by bit:
each bitmap counts once for each bit of the query's weight, full adders turn three bitmaps of one rank into one of that rank
and one of the next, and what is left is the block's scores as bitmaps. The k best are then chosen from the most significant
bitmap downward; rows that are still equal at the end are taken in the order of their ids.

Queries travel to every block in groups; that is the stated query set against all rows. A task holds one block and one group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costgauge.llm.rows import checkpointed, quoted, ranked

BLOCK_ROWS = 32_768
GROUP_ROWS = 128
LIMIT = 1 << 62  # values of this size and beyond stop the query: they have no score in 64 bits

INDEX = "block long, n int, ids binary, dims int, low binary, bits binary, slices binary"
FOUND = "query_id long, vec_id long, score long"


def quantised(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of each component, x as double; null if the vector or a component is null or not finite.

    A finite component whose value does not fit LIMIT is an error, as it has no score.
    """
    too_large = F.raise_error(F.lit("a component is too large for a score of 64 bits")).cast("long")

    def whole(x: Column) -> Column:
        scaled = x.cast("double") * scale
        return F.when(F.abs(scaled) < float(LIMIT), F.floor(scaled)).otherwise(too_large)

    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, whole))


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("id", kind="stable")
    n, dims = len(rows), max(map(len, rows["values"]), default=0)
    values = np.zeros((n, dims), dtype=np.int64)
    for i, v in enumerate(rows["values"]):
        values[i, : len(v)] = v
    low = values.min(axis=0) if dims else np.zeros(0, dtype=np.int64)
    above = values - low
    bits = np.array([int(above[:, d].max()).bit_length() for d in range(dims)], dtype=np.int64)
    padded = np.zeros((-(-n // 64) * 64, dims), dtype=np.int64)
    padded[:n] = above
    planes = [
        np.packbits(((padded[:, d] >> b) & 1).astype(np.uint8), bitorder="little").tobytes()
        for d in range(dims)
        for b in range(bits[d])
    ]
    return pd.DataFrame(
        {
            "block": [int(rows["block"].iat[0])],
            "n": [n],
            "ids": [rows["id"].to_numpy(np.int64).tobytes()],
            "dims": [dims],
            "low": [low.tobytes()],
            "bits": [bits.tobytes()],
            "slices": [b"".join(planes)],
        }
    )


def build_index(vectors: DataFrame, *, id_col: str, vector_col: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row for each block of vectors: its ids, and its bit slices. Rows without id or quantised vector are left out."""
    rows = vectors.select(quoted(id_col).cast("long").alias("id"), quantised(quoted(vector_col)).alias("values"))
    placed = ranked(rows.where(F.col("id").isNotNull() & F.col("values").isNotNull()), ["id"])
    blocked = placed.withColumn("block", F.floor(F.col("_rank") / block_rows).cast("long")).drop("_rank")
    return blocked.groupBy("block").applyInPandas(_block, INDEX)


def added(columns: dict[int, list[np.ndarray]]) -> list[tuple[int, np.ndarray]]:
    """The sum of bitmaps, each worth 2^rank: one bitmap for each rank, from the least significant."""
    total = []
    rank = min(columns, default=0)
    while any(r >= rank for r in columns):
        at = columns.pop(rank, [])
        carried = columns.setdefault(rank + 1, [])
        while len(at) > 2:
            a, b, c = at.pop(), at.pop(), at.pop()
            half = a ^ b
            at.append(half ^ c)
            carried.append((a & b) | (half & c))
        if len(at) == 2:
            carried.append(at[0] & at[1])
            at = [at[0] ^ at[1]]
        if at:
            total.append((rank, at[0]))
        if not carried:
            del columns[rank + 1]
        rank += 1
    return total


def _set(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def best(total: list[tuple[int, np.ndarray]], rows: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k best of `rows` (a bitmap), from the most significant bitmap down; ties to the smaller index."""
    sure, open_ = np.zeros_like(rows), rows.copy()
    for _, bitmap in reversed(total):
        above = open_ & bitmap
        n = int(np.bitwise_count(sure | above).sum())
        if n > k:
            open_ = above
        else:
            sure |= above
            open_ &= ~bitmap
            if n == k:
                return _set(sure)
    certain = _set(sure)
    return np.concatenate([certain, _set(open_)[: k - len(certain)]])


class _Block:
    """One block, read back."""

    def __init__(self, row: pd.Series) -> None:
        self.n, self.ids = int(row["n"]), np.frombuffer(row["ids"], dtype=np.int64)
        self.low = np.frombuffer(row["low"], dtype=np.int64).tolist()
        bits = np.frombuffer(row["bits"], dtype=np.int64).tolist()
        words = -(-self.n // 64)
        planes = np.frombuffer(row["slices"], dtype=np.uint64).reshape(-1, words)
        flipped, at = ~planes, 0
        self.planes: list[list[np.ndarray]] = []
        self.flipped: list[list[np.ndarray]] = []
        for count in bits:
            self.planes.append([planes[i] for i in range(at, at + count)])
            self.flipped.append([flipped[i] for i in range(at, at + count)])
            at += count
        every = np.zeros(words * 64, dtype=np.uint8)
        every[: self.n] = 1
        self.every = np.packbits(every, bitorder="little").view(np.uint64)

    def search(self, own: int, query: list[int], k: int) -> tuple[list[int], list[int]]:
        """Ids and scores of the k best rows with another id."""
        fixed, columns = 0, {}
        for low, planes, flipped, weight in zip(self.low, self.planes, self.flipped, query, strict=False):
            size = abs(weight)
            fixed += weight * low
            if weight < 0:  # count what is missing to the largest value instead
                fixed += weight * ((1 << len(planes)) - 1)
            chosen = planes if weight > 0 else flipped
            for shift in range(size.bit_length()):
                if size >> shift & 1:
                    for b, plane in enumerate(chosen):
                        columns.setdefault(b + shift, []).append(plane)
        total = added(columns)
        rows = self.every
        first, last = np.searchsorted(self.ids, own, "left"), np.searchsorted(self.ids, own, "right")
        if last > first:
            mask = np.ones(len(rows) * 64, dtype=np.uint8)
            mask[first:last] = 0
            rows = rows & np.packbits(mask, bitorder="little").view(np.uint64)
        picked = best(total, rows, k).tolist()
        scores = [fixed + sum(int(bm[i >> 6] >> np.uint64(i & 63) & np.uint64(1)) << r for r, bm in total) for i in picked]
        return self.ids[picked].tolist(), scores


def _search(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: tuple[int, _Block] | None = None
        for batch in batches:
            for _, row in batch.iterrows():
                if held is None or held[0] != row["block"]:
                    held = (row["block"], _Block(row))
                out: list[tuple[int, int, int]] = []
                for query in row["queries"]:
                    ids, scores = held[1].search(int(query["id"]), [int(x) for x in query["values"]], k)
                    if any(not -(1 << 63) <= s < 1 << 63 for s in scores):
                        raise OverflowError(f"a score of query {query['id']} does not fit 64 bits")
                    out += [(int(query["id"]), i, s) for i, s in zip(ids, scores, strict=True)]
                yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return run


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Each query's k best rows with another id: query_id, rank (int, from 1), vec_id, score (long).

    Score: inner product of the quantised vectors; components that one of the two lacks count as 0. Ties go to the smaller
    id. Vectors that are null, or hold a null or non-finite component, and rows without id take no part. Scores are exact; one of
    the k best that does not fit a long, and a component beyond LIMIT, stop the query. Rows that repeat an id are candidates each; as a query, an id is used once, with its least vector.
    """
    index = checkpointed(build_index(vectors, id_col=id_col, vector_col=vector_col, block_rows=block_rows))
    asked = queries.select(quoted(id_col).cast("long").alias("id"), quantised(quoted(vector_col)).alias("values"))
    asked = asked.where(F.col("id").isNotNull() & F.col("values").isNotNull())
    single = asked.groupBy("id").agg(F.min("values").alias("values"))
    grouped = ranked(single, ["id"]).withColumn("group", F.floor(F.col("_rank") / group_rows).cast("long"))
    groups = checkpointed(grouped.groupBy("group").agg(F.collect_list(F.struct("id", "values")).alias("queries")))
    # The small side is sent to each block; blocks are numbered from 0.
    n_blocks = index.count()
    sent = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(n_blocks, 1) - 1).cast("long"))))
    met = index.join(sent, "block").select("block", "n", "ids", "low", "bits", "slices", "queries")
    found = met.mapInPandas(_search(k), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
