"""Helpers shared by the operators: row identity, line keys, global ranks, reliable checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def quoted(name: str) -> Column:
    """A column by its whole name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, drop: Sequence[str] = (), **used: str) -> DataFrame:
    """All columns but the dropped ones as one struct _row, and the used ones again under the given names.

    What an operator adds then cannot clash with a name of the table.
    """
    fields = [quoted(c) for c in df.columns if c not in drop] or [F.lit(0).alias("_none")]
    return df.select(F.struct(*fields).alias("_row"), *[quoted(c).alias(name) for name, c in used.items()])


def unpacked(df: DataFrame, names: Sequence[str], new: Mapping[str, Column]) -> DataFrame:
    """The named columns of _row, and the new ones, which replace columns of their name."""
    old = [F.col("_row").getField(c).alias(c) for c in names if c not in new]
    return df.select(*old, *[value.alias(name) for name, value in new.items()])


def text_of(text: Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def hash128(*values: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of the values; null and empty differ."""
    parts = [part for value in values for part in (value.isNull(), value)]
    return F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)


def with_key(df: DataFrame, *values: Column, names: Sequence[str] = ("_r1", "_r2")) -> DataFrame:
    """Add the 128-bit identity of a row's values."""
    first, second = hash128(*values)
    return df.withColumns({names[0]: first, names[1]: second})


def ascii_lower(value: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    plain = F.octet_length(value) == F.char_length(value)
    return F.when(plain, F.lower(value)).otherwise(F.translate(value, UPPER, UPPER.lower()))


def lines_of(text: Column) -> Column:
    """The lines of a text; null and empty text have one empty line."""
    return F.split(text_of(text), "\n", -1)


def line_keys(lines: Column) -> Column:
    """For each line: h1, h2 (hashes of its key) and size (code points of the key).

    The key is the line without white space at its ends, A-Z lower-cased. Each step is one pass over the array, so that no
    step is computed twice.
    """
    trimmed = F.transform(lines, lambda line: F.btrim(line, F.lit(WHITE)))
    keys = F.transform(trimmed, ascii_lower)

    def hashed(key: Column) -> Column:
        first, second = hash128(key)
        return F.struct(first.alias("h1"), second.alias("h2"), F.char_length(key).alias("size"))

    return F.transform(keys, hashed)


def shared_folder(spark: SparkSession) -> str:
    """This application's folder below the one that spark.checkpoint.dir names, which all executors share.

    Only a session in local mode may come without that setting; it gets a folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with checkpoint() in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def merged(df: DataFrame) -> DataFrame:
    """A side that grows with the corpus, to be joined by a merge join at every size, and not by a broadcast while it is small."""
    return df.hint("merge")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table as Parquet to the shared folder and read it again.

    Unlike a checkpoint, what is read carries nothing of the plan that made it, which matters where rounds follow on rounds.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, order: Sequence[str], name: str = "_rank") -> DataFrame:
    """Add each row's position, from 0, in the order of all rows.

    The rows are range-partitioned by the order and sorted within partitions, so that no task holds more than a range;
    a partition's first position is the sum of the counts before it. Rows equal in the order get any of their positions.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = checkpointed(ordered.withColumn("_place", F.monotonically_increasing_id()))
    part, within = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    # One row for each partition.
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    joined = placed.withColumn("_part", part).join(F.broadcast(first), "_part")
    return joined.withColumn(name, F.col("_first") + within).drop("_part", "_place", "_first")


def running_total(df: DataFrame, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Add the sum of `value` over all rows before each row, in the order of all rows, which must have no ties.

    As ranked(): ranges are summed apart, and a range starts at the sum of the ranges before it.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ordered.withColumn("_place", F.monotonically_increasing_id())
    placed = checkpointed(numbered.withColumn("_part", F.shiftright("_place", 33)))
    inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each partition.
    sums = placed.groupBy("_part").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_first"))
    within = placed.withColumn("_within", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = within.join(F.broadcast(first), "_part")
    return joined.withColumn(name, F.col("_first") + F.col("_within")).drop("_part", "_place", "_first", "_within")
