"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir), works on every document that the stage before it kept, and returns the columns of
documents, the last one token ids instead of the text. Stages meet through Parquet tables: run() writes each result to the
folder that spark.checkpoint.dir names and reads it again, so that an executor lost later repeats no stage.

Defined results: documents without words are not drawn by the first stage; the line dedup may leave a text empty, but drops
no document; of rows that repeat whole the near dedup keeps one; an empty table stays empty through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costgauge.llm import cube_mix, line_dedup, order_minhash, resampling, word_bpe
from costgauge.llm.rows import stored

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws; the target is what `labels` calls good."""
    return resampling.resample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of at least 10 documents stay in their first place only; n_chars is that of the text that is left."""
    kept = line_dedup.dedup_lines(docs, min_docs=10, keep_first=True)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: runs of five words, similarity 0.8."""
    return order_minhash.representatives(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at 3 : 1 : 2 to 150 % of all words; a document that is used twice is there twice."""
    return cube_mix.mixed_documents(docs, weights=(3, 1, 2), share=1.5, max_use=2.0)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, instead of the text."""
    return word_bpe.encode(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near dedup", near_duplicates),
    ("source mix", mix),
    ("bpe encoding", encode),
]

# The classifier's sums, the alignment, the balanced draw and the merges are not SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
