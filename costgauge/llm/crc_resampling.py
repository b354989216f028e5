"""Importance resampling towards a target, with feature buckets from length-bucketed CRC matrices.

Features are runs of 1 to `max_run` words; a feature's bucket is its CRC modulo BUCKETS. For a batch of texts the distinct
features are found once. Those of equal length in bytes are the rows of one two-dimensional array of uint8, and the CRCs of
all its rows are updated column by column; the buckets are then scattered back to the places of the features in the texts.

A bucket's gain is the smoothed log ratio of its share in the target over its share in the documents, in thousandths. A document's
weight is the sum of its features' gains; with Gumbel noise from a hash of its id added, the highest scores are drawn.

Texts are read twice and never shuffled. Counts are added up in each task before they are shuffled (at most BUCKETS rows a task),
and BUCKETS gains come to the driver, whatever the size of the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costgauge.llm.batches import PIECE, pieces
from costgauge.llm.grams import buffer_of
from costgauge.llm.rows import checkpointed, packed, quoted, ranked, text_of, unpacked

BUCKETS = 10_000
POLYNOMIAL = 0xEDB88320
WIDE = 4_096  # features longer than this are few to a length: their matrix has rows, but no columns to share


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), table >> np.uint32(1))
    return table


TABLE = _crc_table()


def _lowered() -> tuple[np.ndarray, np.ndarray]:
    """Each byte with A-Z lower-cased, and whether it is part of a word (a letter, a digit, or beyond ASCII)."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    word = np.zeros(256, bool)
    word[48:58] = word[97:123] = word[128:] = True
    return lower, word[lower]


LOWER, IN_WORD = _lowered()


def crc_of_equal(rows: np.ndarray) -> np.ndarray:
    """CRC-32 of each row of a two-dimensional array of bytes, one column at a time."""
    crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(rows.T):
        crc = TABLE[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
    return crc ^ np.uint32(0xFFFFFFFF)


def crc_of(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """CRC-32 of each of the byte strings raw[bounds[i]:bounds[i + 1]], all of one length in one matrix."""
    lengths = np.diff(bounds)
    out = np.zeros(len(lengths), np.uint32)
    by_length = np.argsort(lengths, kind="stable")
    edges = np.flatnonzero(np.diff(lengths[by_length], prepend=-1))
    for group in np.split(by_length, edges[1:]) if len(by_length) else []:
        length = int(lengths[group[0]])
        if length > WIDE:
            out[group] = [zlib.crc32(raw[a : a + length]) for a in bounds[group]]
        else:
            out[group] = crc_of_equal(raw[bounds[group][:, None] + np.arange(length)])
    return out


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all words without what is between them, where each begins (and the last ends), and words a text."""
    raw, bounds = buffer_of(texts)
    word = IN_WORD[raw]
    first = word.copy()
    first[1:] &= ~word[:-1]
    edges = bounds[:-1][bounds[:-1] < len(raw)]
    first[edges] = word[edges]
    begins = np.flatnonzero(first)
    kept = np.concatenate([[0], np.cumsum(word)])
    counts = np.diff(np.searchsorted(begins, bounds, "left"))
    return LOWER[raw[word]], np.append(kept[begins], kept[-1]), counts


def _runs(raw: np.ndarray, at: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of n words in the same form as _words gives words (which are the runs of one)."""
    if n == 1:
        return raw, at, counts
    # With one space after each word a run is one slice, less its last space.
    spaced = np.insert(raw, at[1:], np.uint8(32))
    begins = at[:-1] + np.arange(len(at) - 1)
    ends = np.append(begins[1:], len(spaced)) - 1
    of = np.repeat(np.arange(len(counts)), counts)
    last = np.arange(len(begins)) + n - 1
    heads = np.flatnonzero((last < len(begins)) & (of[np.minimum(last, len(of) - 1)] == of)) if len(of) else last
    begins, lengths = begins[heads], ends[heads + n - 1] - begins[heads]
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    places = np.repeat(begins - bounds[:-1], lengths) + np.arange(bounds[-1])
    return spaced[places], bounds, np.maximum(counts - (n - 1), 0)


def buckets_of(texts: pa.Array, max_run: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of run: the bucket of each feature, in order, and how many of them each text has."""
    words = _words(texts)
    for n in range(1, max_run + 1):
        raw, bounds, counts = _runs(*words, n)
        kind = pa.large_binary()
        every = pa.Array.from_buffers(kind, len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(raw)])
        distinct = every.dictionary_encode()
        own, own_bounds = buffer_of(distinct.dictionary.cast(pa.large_binary()).view(pa.large_string()))
        found = (crc_of(own, own_bounds) % np.uint32(buckets)).astype(np.int64)
        yield found[distinct.indices.to_numpy(zero_copy_only=False)] if len(found) else np.zeros(0, np.int64), counts


def counted(texts: DataFrame, text_col: str, max_run: int, buckets: int) -> DataFrame:
    """bucket and n: features of all the texts, for each bucket that has any."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in pieces(batches, 0, PIECE):
            for found, _ in buckets_of(batch.column(0), max_run, buckets):
                total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    return texts.select(text_of(quoted(text_col)).alias("text")).mapInArrow(work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(
    docs: DataFrame, target: DataFrame, *, text_col: str = "text", target_col: str = "text", max_run: int = 1, buckets: int = BUCKETS
) -> np.ndarray:
    """The gain of each bucket, floor(1000 ln(its smoothed share in the target over that in the documents)).

    At most `buckets` rows come to the driver.
    """
    s = counted(docs, text_col, max_run, buckets).withColumnRenamed("n", "s")
    t = counted(target, target_col, max_run, buckets).withColumnRenamed("n", "t")
    # At most `buckets` rows on each side.
    both = s.join(t, "bucket", "full").select("bucket", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("s", "t")])
    both = checkpointed(both)
    total = both.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("s", "t")]).first()
    found = both.select("bucket", _gain(F.col("s"), F.col("t"), total.s, total.t, buckets).alias("gain")).collect()
    blank = docs.sparkSession.range(1).select(_gain(F.lit(0), F.lit(0), total.s, total.t, buckets).alias("gain")).first().gain
    out = np.full(buckets, blank, np.int64)
    for row in found:
        out[row.bucket] = row.gain
    return out


def _gain(s: Column, t: Column, all_s: int, all_t: int, buckets: int) -> Column:
    def real(value: Column) -> Column:
        return value.cast("double")

    above = (real(t) + 1.0) * F.lit(float(all_s + buckets))
    below = (real(s) + 1.0) * F.lit(float(all_t + buckets))
    return F.floor(1000.0 * F.log(above / below)).cast("long")


def scored(
    docs: DataFrame,
    target: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    max_run: int = 1,
    buckets: int = BUCKETS,
    seed: int = 2024,
    keep_text: bool = False,
) -> DataFrame:
    """_row (all columns; without the text unless keep_text), _id, _words, _features, _weight, _score for every document."""
    gain = gains(docs, target, text_col=text_col, target_col=target_col, max_run=max_run, buckets=buckets)
    rows = packed(docs, () if keep_text else (text_col,), _id=id_col, _text=text_col)
    ready = rows.select(text_of(F.col("_text")).alias("_text"), "_id", "_row")
    fields = "_words long, _features long, _weight long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 0, PIECE):
            words, features, weight = None, 0, 0
            for found, counts in buckets_of(batch.column(0), max_run, buckets):
                ends = np.cumsum(counts)
                sums = np.concatenate([[0], np.cumsum(gain[found])])
                words = counts if words is None else words
                features = features + counts
                weight = weight + (sums[ends] - sums[ends - counts])
            made = [pa.array(np.asarray(v, np.int64)) for v in (words, features, weight)]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), *made], ["_id", "_row", "_words", "_features", "_weight"])

    schema = ready.select("_id", "_row").schema
    for part in fields.split(", "):
        name, kind = part.split(" ")
        schema = schema.add(name, kind)
    made = ready.mapInArrow(work, schema)
    return made.withColumn("_score", F.col("_weight") + noise(F.col("_id"), seed))


def noise(id_value: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 8 hex digits of the sha256 of seed:id; a null id counts as empty."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), text_of(id_value)), 256)
    h = F.conv(F.substring(digits, 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def draw(
    docs: DataFrame,
    target: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    percent: int = 10,
    min_words: int = 20,
    max_run: int = 1,
    buckets: int = BUCKETS,
    seed: int = 2024,
) -> DataFrame:
    """All columns but the text, and n_features, weight, score, rank for every document; rank is null if it is not drawn.

    Of the N documents with at least `min_words` words, floor(percent * N / 100) are drawn: the highest scores, ties to the
    smaller id (null last). Defined results: a null text has no words; rows that repeat whole are ranked one after the other, each
    of them counts; an empty table gives an empty one, an empty target gives gains from the smoothing alone; columns of the table
    with a new column's name are replaced.
    """
    names = [c for c in docs.columns if c != text_col]
    made = scored(
        docs, target, id_col=id_col, text_col=text_col, target_col=target_col, max_run=max_run, buckets=buckets, seed=seed
    )
    made = checkpointed(made.withColumn("_able", F.col("_words") >= min_words))
    wanted = made.where("_able").count() * percent // 100
    order = {"_late": ~F.col("_able"), "_least": -F.col("_score"), "_none": F.col("_id").isNull()}
    placed = ranked(made.withColumns(order), [*order, "_id", "_features", "_weight"])
    rank = F.when(F.col("_able") & (F.col("_rank") < wanted), F.col("_rank") + 1).cast("long")
    new = {"n_features": F.col("_features"), "weight": F.col("_weight"), "score": F.col("_score"), "rank": rank}
    return unpacked(placed, names, new)


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    percent: int = 10,
    min_words: int = 20,
    max_run: int = 1,
    buckets: int = BUCKETS,
    seed: int = 2024,
) -> DataFrame:
    """The drawn documents, all columns. Texts are scored again where they are read; only scores and ids are put in order.

    As draw(), but rows with the score and the id of the last one drawn are all returned.
    """
    made = scored(
        docs, target, id_col=id_col, text_col=text_col, target_col=target_col, max_run=max_run, buckets=buckets, seed=seed,
        keep_text=True,
    ).where(F.col("_words") >= min_words)
    slim = checkpointed(made.select((-F.col("_score")).alias("_least"), F.col("_id").isNull().alias("_none"), "_id"))
    wanted = slim.count() * percent // 100
    if not wanted:
        return docs.limit(0)
    order = ["_least", "_none", "_id"]
    last = ranked(slim, order).where(F.col("_rank") == wanted - 1).select(F.struct(*order).alias("last")).first().last
    here = F.struct((-F.col("_score")).alias("_least"), F.col("_id").isNull().alias("_none"), F.col("_id").alias("_id"))
    kind = slim.schema["_id"].dataType
    limit = F.struct(F.lit(last._least).cast("long"), F.lit(last._none), F.lit(last._id).cast(kind))
    return unpacked(made.where(here <= limit), docs.columns, {})
