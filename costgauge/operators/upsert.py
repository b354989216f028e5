"""Keyed upsert and reload of stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costgauge.operators.scale import dim_join


def latest_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in the given order.

    The filter on the row number is applied on each task before the shuffle as
    well, so a key with many copies sends one row per task.
    """
    newest = Window.partitionBy(*key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return rows.withColumn("_place", F.row_number().over(newest)).where("_place = 1").drop("_place")


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Target after the merge: source rows win over target rows, the latest source row wins among copies.

    Target and source go through one choice per key, so the merge costs a single
    shuffle and duplicate source keys cannot fail it.
    """
    both = target.withColumn("_from_source", F.lit(0)).unionByName(source.withColumn("_from_source", F.lit(1)))
    return latest_per_key(both, key, ["_from_source", *order]).drop("_from_source")


def reload(
    existing: DataFrame, incoming: DataFrame, key: str = "service_code"
) -> DataFrame:
    """Replace every existing row whose key value occurs in the incoming rows."""
    replaced = incoming.select(key).distinct()
    return dim_join(existing, replaced, [key], "left_anti").unionByName(incoming)
