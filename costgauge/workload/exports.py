"""Queries that read exported files: records of every declared table, price components, created tables, own hooks."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costgauge.functions.numeric import half_even
from costgauge.operators import ingest
from costgauge.plans import contract, ingestion, pipeline
from costgauge.services import DECLARED, ResourceTable, get_service
from costgauge.sources import readers, writers
from costgauge.sources.local import local_table
from costgauge.workload import models as m
from costgauge.workload.ingestion import PARAMS, records
from costgauge.workload.registry import query, r

# Exported records: each customer is one record of one kind, and every seventh value of a record is missing -----------

SERVICE_OF = {t.name: s for s in DECLARED for t in s.tables if t.fetched}
KINDS: dict[str, ResourceTable] = {t.name: t for s in DECLARED for t in s.tables if t.fetched}
PLACE = {name: place for place, name in enumerate(KINDS)}
NAMING = ("resource_id", "resource_name", "name", "id")
MISSING_EVERY = 7
NOT_COMPARED = ("ingestion_timestamp", "job_runtime_utc")


def _parent(table: ResourceTable) -> ResourceTable | None:
    return SERVICE_OF[table.name].primary if table.parent_field else None


def _sources(table: ResourceTable) -> dict[str, str]:
    """Source path to what its values look like."""
    named = {*NAMING, *table.id_fields, *(t.parent_field for t in SERVICE_OF[table.name].tables)}
    found = {}
    for place, (path, columns) in enumerate(table.mapping.items()):
        kind = next(f.kind for f in table.fields if f.column == columns[0])
        mixed = kind == "string" and not named & {path, *columns}
        found[path] = {1: "int", 2: "boolean", 3: "list"}.get(place % 5, kind) if mixed else kind
    return found


def _value(path: str, kind: str, place: int, key: Column) -> Column:
    """One value of the record of a customer."""
    value = {
        "string": lambda: F.concat(F.lit(f"{path.split('.')[-1]}-"), key.cast("string")),
        "double": lambda: (key % 1000 + place) / F.lit(4.0),
        "int": lambda: (key % (place + 2)).cast("int"),
        "boolean": lambda: (key + place) % 2 == 0,
        "list": lambda: F.array(F.lit("x"), F.col("c_nationkey").cast("string")),
        "map<string,string>": lambda: F.create_map(F.lit("segment"), F.col("c_mktsegment")),
    }[kind]()
    return F.when((key + place) % MISSING_EVERY != 0, value)


def _nested(values: Mapping[str, Column]) -> Column:
    """A record from its dot paths."""
    groups: dict[str, dict[str, Column]] = {}
    for path, value in values.items():
        first, _, rest = path.partition(".")
        groups.setdefault(first, {})[rest] = value
    return F.struct(
        *[(inner[""] if "" in inner else _nested(inner)).alias(name) for name, inner in groups.items()]
    )


def exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of all kinds, written to files and read from there."""
    customer, key = m.table(spark, sf_dir, "customer"), F.col("c_custkey")
    parts = []
    for name, table in KINDS.items():
        sources = _sources(table)
        values = {p: _value(p, kind, i, key) for i, (p, kind) in enumerate(sources.items())}
        if parent := _parent(table):
            path, place = _path_of(parent, table.parent_field)
            values[ingestion.PARENT_ID] = _value(path, "string", place, key - (PLACE[name] - PLACE[parent.name]))
        own = customer.where(key % len(KINDS) == PLACE[name])
        parts.append(own.select(F.lit(name).alias("table_name"), F.to_json(_nested(values)).alias("line")))
    path = writers.shared_folder(spark, "records")
    writers.write_records(reduce(DataFrame.unionByName, parts), path)
    return readers.exported_records(spark, path)


def _path_of(table: ResourceTable, column: str) -> tuple[str, int]:
    """Source of a column, and its place among the sources of the table."""
    return next((p, i) for i, (p, columns) in enumerate(table.mapping.items()) if column in columns)


# The same rows as SQL --------------------------------------------------------------------------------------------


def _value_sql(path: str, kind: str, place: int, key: str = "c_custkey") -> str:
    value = {
        "string": f"'{path.split('.')[-1]}-' || {key}",
        "double": f"(({key}) % 1000 + {place}) / 4.0",
        "int": f"CAST(({key}) % {place + 2} AS INTEGER)",
        "boolean": f"(({key}) + {place}) % 2 = 0",
        "list": """'["x","' || c_nationkey || '"]'""",
        "map<string,string>": "c_mktsegment",
    }[kind]
    return f"CASE WHEN (({key}) + {place}) % {MISSING_EVERY} <> 0 THEN {value} END"


def _declared_sql(value: str, kind: str, wanted: str) -> str:
    """A value as a declared type; texts that are no such value are null."""
    types = {"string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "boolean": "BOOLEAN"}
    return value if kind == wanted == "map<string,string>" else f"TRY_CAST({value} AS {types[wanted]})"


def _filled_sql(column: str) -> str:
    return f"nullif(CAST({column} AS VARCHAR), '')"


def _rows_sql(table: ResourceTable) -> list[str]:
    """Common table expressions that lead to the named rows of one table."""
    name, sources = table.name, _sources(table)
    columns = {}
    for f in table.fields:
        if f.path:
            place = list(sources).index(f.path)
            columns[f.column] = _declared_sql(_value_sql(f.path, sources[f.path], place), sources[f.path], f.kind)
    found = list(columns)
    parts = [f"{v} AS {c}" for c, v in columns.items()]
    where = f"c_custkey % {len(KINDS)} = {PLACE[name]}"
    if parent := _parent(table):
        path, place = _path_of(parent, table.parent_field)
        offset = PLACE[name] - PLACE[parent.name]
        parts.append(f"{_value_sql(path, 'string', place, f'c_custkey - {offset}')} AS _parent")
        raw = f"raw_{name} AS (SELECT {', '.join(parts)} FROM customer WHERE {where})"
        known = _columns_of(parent)
        taken = [c for c in (*ingest.INHERITED, "dataset_id", "instance_id") if c in known]
        own = [f"coalesce({_filled_sql('c.' + c)}, p.{c}) AS {c}" if c in taken else f"c.{c}" for c in found]
        more = [f"p.{c}" for c in taken if c not in found]
        found += [c for c in taken if c not in found]
        source = (
            f"(SELECT {', '.join(own + more)} FROM raw_{name} c JOIN named_{parent.name} p ON c._parent = p.{table.parent_field} "
            f"WHERE p.{table.parent_field} <> '') raw"
        )
    else:
        raw = f"raw_{name} AS (SELECT {', '.join(parts)} FROM customer WHERE {where})"
        source = f"raw_{name} raw"
    given = ["*"]
    if table.id_fields:
        if "project_id" in table.id_fields and "project_id" not in found:
            source = f"(SELECT *, '{PARAMS.account_id}' AS project_id FROM {source}) raw"
            found.append("project_id")
        texts = [f"coalesce({_filled_sql(c)}, '')" if c in found else "''" for c in table.id_fields]
        given.append(" || '.' || ".join(texts) + " AS resource_id")
        found.append("resource_id")
    source = f"(SELECT {', '.join(given)} FROM {source}) raw"
    order = [c for c in ("resource_name", "cluster_name", "node_pool_name", "resource_id") if c in found]
    named = f"coalesce({', '.join(_filled_sql(c) for c in order)}, '') AS resource_name"
    rest = "* EXCLUDE (resource_name)" if "resource_name" in found else "*"
    return [raw, f"named_{name} AS (SELECT {rest}, {named} FROM {source})"]


def _columns_of(table: ResourceTable) -> set[str]:
    """Columns of the stored rows of a table."""
    return {"resource_id", "resource_name", *(f.column for f in table.fields)}


def _compared_sql(table: ResourceTable) -> str:
    """One table's rows in the columns of the query."""
    constants = {
        "client_id": PARAMS.client_id,
        "account_id": PARAMS.account_id,
        "cloud_name": "gcp",
        "year_month": PARAMS.run_ts.strftime("%Y-%m"),
        "service_name": SERVICE_OF[table.name].name,
    }
    inherited = {*ingest.INHERITED, "dataset_id", "instance_id"} & _columns_of(_parent(table)) if table.parent_field else set()
    present = {f.column for f in table.fields if f.path} | inherited | {"resource_id", "resource_name"}
    present |= {"project_id"} & set(table.id_fields)
    texts = []
    for column in _compared(table):
        if column in constants:
            texts.append(f"'{column}={constants[column]}'")
        elif column in present:
            texts.append(f"'{column}=' || CAST({column} AS VARCHAR)")
    return (
        f"SELECT '{table.name}' AS table_name, resource_id, resource_name, {len(_compared(table))} AS n_columns, "
        f"concat_ws('|', {', '.join(texts)}) AS fields FROM named_{table.name}"
    )


def _compared(table: ResourceTable) -> list[str]:
    """The stored columns that the query shows."""
    return [c for c, _ in table.columns if c not in NOT_COMPARED]


RESOURCES_SQL = (
    "WITH "
    + ",\n".join(part for t in KINDS.values() for part in _rows_sql(t))
    + "\n"
    + "\nUNION ALL ".join(_compared_sql(t) for t in KINDS.values())
)


@query("resource_tables", RESOURCES_SQL)
def resource_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every declared table from one folder of exported records, each row as text."""
    tables = ingestion.run_export(exported(spark, sf_dir), DECLARED, PARAMS)
    out = None
    for name, rows in tables.items():
        kinds = dict(KINDS[name].columns)
        texts = [
            F.concat(F.lit(f"{c}="), F.col(c)["segment"] if kinds[c] == "map<string,string>" else F.col(c).cast("string"))
            for c in _compared(KINDS[name])
        ]
        part = rows.select(
            F.lit(name).alias("table_name"),
            "resource_id",
            "resource_name",
            F.lit(len(texts)).alias("n_columns"),
            F.concat_ws("|", *texts).alias("fields"),
        )
        out = part if out is None else out.unionByName(part)
    return out


# Runs: what would be stored, and what is ------------------------------------------------------------------------

STORED = ("GKE", "CloudKMS")


def _counts_sql(names: list[str], column: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS {column} FROM named_{n}" for n in names)


@query(
    "dry_run",
    "WITH "
    + ",\n".join(part for t in KINDS.values() for part in _rows_sql(t))
    + "\n"
    + _counts_sql(list(KINDS), "n_rows"),
)
def dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table of a run, from one job that stores nothing."""
    counted = ingestion.dry_run(ingestion.run_export(exported(spark, sf_dir), DECLARED, PARAMS))
    return local_table(spark, list(counted.items()), "table_name string, n_rows bigint")


_STORED_KINDS = [t for n in STORED for t in get_service(n).tables if t.fetched]


@query(
    "stored_run",
    "WITH "
    + ",\n".join(part for t in _STORED_KINDS for part in _rows_sql(t))
    + "\n"
    + " UNION ALL ".join(
        f"SELECT '{t.name}' AS table_name, resource_id, tenant AS client_id, count(*) AS n_source "
        f"FROM named_{t.name}, (VALUES ('{PARAMS.client_id}'), ('partner')) v(tenant) WHERE resource_id IS NOT NULL "
        "GROUP BY resource_id, tenant"
        for t in _STORED_KINDS
    ),
)
def stored_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two services stored for two tenants and read back from their files: one row a key."""
    params = replace(PARAMS, additional_client_id="partner")
    records_ = exported(spark, sf_dir)
    warehouse = writers.shared_folder(spark, "warehouse")
    out = None
    for name in STORED:
        service = get_service(name)
        tables = {n: t.where("resource_id IS NOT NULL") for n, t in ingestion.run_export(records_, [service], params).items()}
        ingestion.store(service, tables, warehouse)
        for table, rows in tables.items():
            kept = spark.read.schema(rows.schema).parquet(f"{warehouse}/{table}")
            source = rows.groupBy("resource_id", "client_id").agg(F.count(F.lit(1)).alias("n_source"))
            part = kept.join(source, ["resource_id", "client_id"]).select(
                F.lit(table).alias("table_name"), "resource_id", "client_id", "n_source"
            )
            out = part if out is None else out.unionByName(part)
    return out


# Price components, created tables, hooks --------------------------------------------------------------------------


@query(
    "component_prices",
    f"""SELECT n_name AS component, 'region-' || n_regionkey AS region, {r('max(s_acctbal) / 10000', 6)} AS hourly_price,
  CAST(count(*) AS INTEGER) AS vm_cap FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name, n_regionkey""",
)
def component_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of price components, one entry for each nation of suppliers, written and read."""
    suppliers, nation = m.table(spark, sf_dir, "supplier"), m.table(spark, sf_dir, "nation")
    priced = (
        suppliers.groupBy("s_nationkey")
        .agg(F.max("s_acctbal").alias("top"), F.count(F.lit(1)).cast("int").alias("vm_cap"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            "n_name",
            F.struct(
                F.concat(F.lit("region-"), F.col("n_regionkey")).alias("region"),
                (F.col("top") / 10000).alias("hourly_price"),
                "vm_cap",
            ).alias("entry"),
        )
    )
    path = writers.shared_folder(spark, "components")
    # The file is one object with an entry for each nation.
    entries = priced.agg(F.map_from_entries(F.collect_list(F.struct("n_name", "entry"))).alias("c"))
    entries.select(F.to_json("c")).write.text(path)
    found = readers.component_catalog(spark, path)
    return found.select("component", "region", half_even(F.col("hourly_price"), 6).alias("hourly_price"), "vm_cap")


@query(
    "created_table",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders",
)
def created_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned table is created twice (the second time is no error), filled and read from its files."""
    rows = m.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    path = writers.shared_folder(spark, "created")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    for _ in range(2):
        writers.create_table(spark, name, rows.schema, ["o_orderstatus"], path=path)
    rows.select(*spark.table(name).columns).write.insertInto(name)
    # The table is external: its files stay.
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(rows.schema).parquet(path)


@query(
    "row_predicate",
    f"""SELECT '{PARAMS.account_id}.region-' || c_nationkey || '.' || c_name AS resource_id,
  CAST(c_custkey % 5 AS DOUBLE) AS current_node_count FROM customer WHERE c_custkey % 5 > 1""",
)
def row_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declared table with a predicate of one's own on its mapped rows."""
    gke = get_service("GKE")
    clusters = replace(gke.primary, keep=lambda rows: F.col("current_node_count") > 1)
    rows = ingestion.snapshot(records(spark, sf_dir).drop("c_custkey"), clusters, gke, PARAMS)
    return rows.select("resource_id", "current_node_count")


def _stopped(rows: DataFrame, prices: pipeline.Prices) -> DataFrame:
    yearly = F.col("monthly") * 12
    text = F.concat(F.lit("Stop "), F.col("resource_id"))
    return contract.recommendation(rows, "STOP_CLOSED", text, yearly, F.lit(0.0), yearly, {"status": F.col("status")})


@query(
    "custom_recommender",
    """SELECT CAST(o_orderkey AS VARCHAR) AS resource_id, 'STOP_CLOSED' AS rule_code, 'Stop ' || o_orderkey AS recommendation,
  o_totalprice * 12 AS annual_savings, '{"recommendation":"Stop ' || o_orderkey || '","status":"F","is_fallback":false}' AS details
FROM orders WHERE o_orderstatus = 'F'""",
)
def custom_recommender(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recommender of one's own, registered under its rule code and dispatched with the others."""
    pipeline.register("STOP_CLOSED", _stopped)
    fired = m.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").cast("string").alias("resource_id"),
        F.col("o_totalprice").alias("monthly"),
        F.col("o_orderstatus").alias("status"),
        F.lit("STOP_CLOSED").alias("rule_code"),
    )
    report = pipeline.recommend_fired(fired, ["STOP_CLOSED"], pipeline.Prices())
    return report.select("resource_id", "rule_code", "recommendation", "annual_savings", "details")
