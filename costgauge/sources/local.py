"""Small fixed tables as local relations: no tasks to read them, sizes known to the optimizer."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from costgauge.schemas import parsed


def local_table(spark: SparkSession, rows: Sequence[Sequence], ddl: str) -> DataFrame:
    """Rows as a table; nested structs are given as dicts."""
    schema = parsed(ddl)
    columns = {name: [row[i] for row in rows] for i, name in enumerate(schema.names)}
    return spark.createDataFrame(pa.table(columns), schema=schema)
