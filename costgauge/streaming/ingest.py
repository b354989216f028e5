"""Incremental ingestion: every file that arrives goes through the same keyed upsert as a batch run."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from costgauge.sources.writers import upsert_path


def new_records(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1_000) -> DataFrame:
    """Exported records as they arrive, one JSON object per line."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def upsert_arrivals(
    records: DataFrame,
    shape: Callable[[DataFrame], DataFrame],
    path: str,
    key: Sequence[str],
    order: Sequence[str],
    partition_by: Sequence[str],
    checkpoint: str,
) -> StreamingQuery:
    """Shape each micro-batch and upsert it; processes what is there and stops.

    A batch that is replayed after a failure changes nothing, because the upsert
    of the same rows is idempotent.
    """

    def store(batch: DataFrame, _: int) -> None:
        upsert_path(shape(batch), path, key, order, partition_by)

    return (
        records.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
