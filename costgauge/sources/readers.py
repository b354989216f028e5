"""Readers with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costgauge import schemas

DEFAULT_MACHINE_TYPE = "e2-medium"  # fixed value


def observations(spark: SparkSession, path: str) -> DataFrame:
    """The flat export: CSV with a header, every value as text, columns found by name. A missing path fails at once.

    Quotes are doubled inside quoted values, which may hold line breaks; a file is therefore read by one task, and a large
    export is many files, with one order of columns. Columns the header lacks are null, but for the machine type, which is
    then the default one.
    """
    read = spark.read.option("header", True).option("encoding", "UTF-8").option("escape", '"').option("multiLine", True)
    rows = read.option("enforceSchema", False).csv(path)
    names = schemas.parsed(schemas.OBSERVATION).names
    absent = {"machine_type": F.lit(DEFAULT_MACHINE_TYPE)}
    return rows.select(
        *[F.col(c) if c in rows.columns else absent.get(c, F.lit(None)).cast("string").alias(c) for c in names]
    )


def metric_points(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.METRIC_POINT).parquet(path)


def resources(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Exported nested resource records, one JSON object per line."""
    return spark.read.schema(schema).json(path)


def exported_records(spark: SparkSession, path: str) -> DataFrame:
    """Resource records of any kind, one JSON object per line, each in a column ``record`` with a shape of its own.

    The folder has one part for each kind of record (``table_name=...``), so that a filter on ``table_name`` prunes files. A
    line that is no JSON stops the job once its record is looked at.
    """
    lines = spark.read.text(path)
    return lines.select("table_name", F.parse_json("value").alias("record"))


def billing_skus(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Every price of every exported billing page: a page per file, or a page per line, which lets files be split."""
    return explode_pages(spark.read.schema(schemas.BILLING_PAGE).option("multiLine", not one_per_line).json(path))


def explode_pages(pages: DataFrame) -> DataFrame:
    """The price entries of all pages."""
    return pages.select(F.explode("skus").alias("sku")).select("sku.*")


def _whole_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def explode_family_catalog(catalog: DataFrame, column: str = "catalog") -> DataFrame:
    """Family-keyed catalogs (a map column) as one row per machine type."""
    families = catalog.select(F.explode(column).alias("family_key", "family_entry"))
    return families.select(
        "family_key", "family_entry.region", F.explode("family_entry.machine_types").alias("m")
    ).select(
        F.coalesce("m.family", "family_key").alias("family"),
        "region",
        "m.machine_type",
        "m.vcpus",
        "m.ram_gb",
        "m.hourly_price",
        "m.monthly_price",
        "m.annual_price",
        "m.ordinal",
    )


def family_catalog(spark: SparkSession, path: str) -> DataFrame:
    """A family-keyed catalog file; its top level is a map, so the file is parsed as a whole."""
    parsed = _whole_files(spark, path).select(F.from_json("value", schemas.FAMILY_CATALOG).alias("catalog"))
    return explode_family_catalog(parsed)


def catalog_lines(spark: SparkSession, path: str) -> DataFrame:
    """A catalog written by ``write_catalog``, one row per machine type; files split between tasks."""
    lines = spark.read.schema(schemas.CATALOG_LINE).json(path)
    return lines.select("family", F.explode("machine_types").alias("m")).select(
        F.coalesce("m.family", "family").alias("family"),
        *[f"m.{c}" for c in ("machine_type", "vcpus", "ram_gb", "hourly_price", "monthly_price", "annual_price", "ordinal")],
    )


def explode_job_catalog(catalog: DataFrame) -> DataFrame:
    """Job-type-keyed catalogs (columns ``batch`` and ``streaming``) as flat rows, batch first."""

    def section(name: str, priority: int) -> Column:
        return F.struct(
            F.lit(name).alias("job_type"), F.lit(priority).alias("priority"), F.col(f"{name}.machine_types").alias("entries")
        )

    sections = catalog.select(F.explode(F.array(section("batch", 0), section("streaming", 1))).alias("s"))
    return sections.select("s.job_type", "s.priority", F.explode("s.entries").alias("m")).select(
        "job_type",
        "priority",
        F.coalesce("m.family", F.lit("")).alias("family"),
        "m.machine_type",
        "m.vcpus",
        "m.ram_gb",
        "m.hourly_price",
        "m.ordinal",
    )


def job_catalog(spark: SparkSession, path: str) -> DataFrame:
    return explode_job_catalog(spark.read.schema(schemas.JOB_CATALOG).option("multiLine", True).json(path))


def component_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Price components, one row each."""
    parsed = _whole_files(spark, path).select(F.from_json("value", schemas.COMPONENT_CATALOG).alias("c"))
    return parsed.select(F.explode("c").alias("component", "entry")).select("component", "entry.*")
