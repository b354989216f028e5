"""Quality classifier by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k.

Single words and pairs of neighbours are hashed to BUCKETS numbers. The target model counts them over labelled documents of
good quality, the raw model over all documents. A document's log weight is the sum, over its n-grams, of the log ratio of the
two, less a rate for each n-gram, which is set where good and bad documents held out of the target model part best. With Gumbel noise added, the
k largest are a draw of k documents without replacement in proportion to their weights; k is the number of documents
whose weight is at least 1. Noise comes from hashes of the documents, so that every run and every repeated task draws alike.

The text is read three times at most and never shuffled. What comes to the driver is BUCKETS counts for each model, the scores of
the labelled sample, and one threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from costgauge.llm.batches import PIECE, give_back, pieces, ranges
from costgauge.llm.grams import buffer_of, mixed, word_hashes
from costgauge.llm.rows import checkpointed, packed, quoted, ranked, text_of, unpacked, with_key

BITS = 16
BUCKETS = 1 << BITS
SAMPLE = 20_000
SEED = 11


@dataclass(frozen=True)
class Model:
    """The log ratio of each bucket, and the rate that an n-gram must reach for a document to be drawn."""

    ratio: np.ndarray
    rate: float


def _buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all texts, and which text each is of."""
    words, first = word_hashes(*buffer_of(texts), marks=True)
    counts = np.diff(first)
    of = np.repeat(np.arange(len(counts)), counts)
    shift = np.uint64(64 - BITS)
    pairs = mixed(words[:-1] * np.uint64(3) + words[1:])[of[:-1] == of[1:]] if len(words) else words
    pair_of = of[:-1][of[:-1] == of[1:]] if len(words) else of
    return np.concatenate([words >> shift, pairs >> shift]).astype(np.int64), np.concatenate([of, pair_of])


def labelled_sample(labels: DataFrame, *, id_col: str = "doc_id", sample: int = SAMPLE) -> DataFrame:
    """_id, _good and _held of the `sample` labelled ids that come first by hash; an id is good if all its labels are 1.

    Every other id is held out: it stays out of the target model, and the rate is set on those.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull())
    single = known.groupBy(F.col(id_col).alias("_id")).agg((F.min("quality") == 1).alias("_good"))
    held = F.xxhash64(F.lit(SEED + 1), F.col("_id")) % 2 == 0
    return single.withColumn("_held", held).orderBy(F.xxhash64(F.lit(SEED), F.col("_id")), "_id").limit(sample)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in pieces(batches, 0, PIECE // 2):
        buckets, of = _buckets(batch.column(0))
        raw += np.bincount(buckets, minlength=BUCKETS)
        good = batch.column(1).fill_null(False).to_numpy(zero_copy_only=False).astype(bool)
        target += np.bincount(buckets[good[of]], minlength=BUCKETS)
    at = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], ["bucket", "raw", "target"])


def _scorer(ratio: np.ndarray):
    kind = StructType([StructField("n", LongType()), StructField("ratio", DoubleType())])

    @F.arrow_udf(kind)
    def score(texts: pa.Array) -> pa.Array:
        counts, totals = [np.zeros(0, np.int64)], [np.zeros(0)]
        for a, b in ranges(texts, PIECE // 2):
            buckets, of = _buckets(texts.slice(a, b - a))
            counts.append(np.bincount(of, minlength=b - a))
            totals.append(np.bincount(of, weights=ratio[buckets], minlength=b - a))
        give_back()
        arrays = [pa.array(np.concatenate(counts), pa.int64()), pa.array(np.concatenate(totals), pa.float64())]
        return pa.StructArray.from_arrays(arrays, ["n", "ratio"])

    return score


def with_scores(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_row (all columns), _id, _n (n-grams), _ratio (their summed log ratio), _weight (log weight), _key (with Gumbel noise).

    A document without words has no weight and no key.
    """
    scored = with_key(packed(docs, _id=id_col, _text=text_col), F.col("_id"), F.col("_text"))
    scored = scored.withColumn("_score", _scorer(model.ratio)(text_of(F.col("_text"))))
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col("_r1"), F.col("_r2")), 11) + 0.5) / float(1 << 53)
    weight = F.when(F.col("_score.n") > 0, F.col("_score.ratio") - F.lit(model.rate) * F.col("_score.n"))
    scored = scored.withColumns({"_n": F.col("_score.n"), "_ratio": F.col("_score.ratio"), "_weight": weight})
    return scored.withColumn("_key", F.col("_weight") - F.log(-F.log(uniform))).drop("_score", "_r1", "_r2", "_text")


def best_rate(scores: list[tuple[float, bool]]) -> float:
    """The cut between labelled good and bad scores with the best mean of both accuracies, in the middle of its gap.

    Without labels of both kinds, 0.
    """
    ordered = sorted(scores)
    good = sum(g for _, g in ordered)
    bad = len(ordered) - good
    if not good or not bad:
        return 0.0
    best, rate, below_good, below_bad = -1.0, 0.0, 0, 0
    for i, (value, is_good) in enumerate(ordered):
        if i and value > ordered[i - 1][0]:
            quality = (good - below_good) / good + below_bad / bad
            if quality > best:
                best, rate = quality, (value + ordered[i - 1][0]) / 2
        below_good += is_good
        below_bad += not is_good
    return rate


def fit(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE
) -> Model:
    """The models: raw text is all documents, target text the good ones of at most `sample` labelled ids."""
    chosen = checkpointed(labelled_sample(labels, id_col=id_col, sample=sample))
    # At most `sample` ids.
    source = docs.select(quoted(id_col).alias("id"), text_of(quoted(text_col)).alias("text"))
    marked = source.join(F.broadcast(chosen), F.col("id") == F.col("_id"), "left")
    texts = marked.select("text", (F.col("_good") & ~F.col("_held")).alias("target"))
    counts = texts.mapInArrow(_counted, "bucket long, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")
    )
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    for row in counts.collect():
        raw[row.bucket] += row.raw
        target[row.bucket] += row.target
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    labelled = source.join(F.broadcast(chosen.where("_held")), F.col("id") == F.col("_id")).select("id", "text", "_good")
    scored = with_scores(labelled, Model(ratio, 0.0), id_col="id", text_col="text").where(F.col("_n") > 0)
    # Rows that share a labelled id count once, by their mean.
    single = scored.groupBy("_id").agg(
        F.avg(F.col("_ratio") / F.col("_n")).alias("score"), F.first("_row._good").alias("good")
    )
    return Model(ratio, best_rate([(row.score, row.good) for row in single.collect()]))


def threshold(scored: DataFrame) -> float | None:
    """The k-th largest key, k the number of documents whose weight is at least 1; None if there are none."""
    k = scored.where(F.col("_weight") >= 0).count()
    if not k:
        return None
    placed = ranked(scored.where(F.col("_key").isNotNull()).select((-F.col("_key")).alias("_last")), ["_last"])
    return -placed.where(F.col("_rank") == k - 1).first()["_last"]


def drawn(key: Column, least: float | None) -> Column:
    """Whether a key is among the largest; keys equal to the k-th are all drawn, so rows that repeat whole stay together."""
    return F.lit(False) if least is None else F.coalesce(key >= F.lit(least), F.lit(False))


def classify(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE
) -> DataFrame:
    """All columns but the text, and n_grams, log_ratio, log_weight, kept. Documents without words are not kept."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, sample=sample)
    names = [c for c in docs.columns if c != text_col]
    scored = with_scores(docs, model, id_col=id_col, text_col=text_col)
    slim = F.struct(*[F.col("_row").getField(c).alias(c) for c in names])
    scored = checkpointed(scored.select(slim.alias("_row"), "_n", "_ratio", "_weight", "_key"))
    kept = drawn(F.col("_key"), threshold(scored))
    new = {"n_grams": F.col("_n"), "log_ratio": F.col("_ratio"), "log_weight": F.col("_weight"), "kept": kept}
    return unpacked(scored, names, new)


def resample(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE
) -> DataFrame:
    """The documents that are drawn, all columns. Texts are scored again where they are read, and are not shuffled."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, sample=sample)
    scored = with_scores(docs, model, id_col=id_col, text_col=text_col)
    least = threshold(checkpointed(scored.select("_weight", "_key")))
    return unpacked(scored.where(drawn(F.col("_key"), least)), docs.columns, {})
