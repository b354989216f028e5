"""From exported resource records to conformed snapshot rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costgauge.functions.numeric import half_even, truthy
from costgauge.functions.timing import iso_text, utc
from costgauge.operators.scale import dim_join
from costgauge.params import RunParams

INHERITED = ("project_id", "location", "cluster_name")
_NESTED = (T.StructType, T.ArrayType, T.MapType)
_PLAIN = (T.NumericType, T.BooleanType)


def _lookup(schema: T.DataType, path: str) -> T.DataType | None:
    """Type at a dot path through structs and maps, None where a segment is missing."""
    for segment in path.split("."):
        if isinstance(schema, T.StructType):
            schema = schema[segment].dataType if segment in schema.fieldNames() else None
        elif isinstance(schema, T.MapType):
            schema = schema.valueType
        else:
            schema = None
        if schema is None:
            return None
    return schema


def _at(path: str) -> Column:
    first, *rest = path.split(".")
    value = F.col(f"`{first}`")
    for segment in rest:
        value = value[segment]
    return value


def map_fields(records: DataFrame, mapping: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Project dot paths to output columns.

    A missing path gives null. Structs, lists and maps become JSON text, numbers
    and booleans pass, anything else becomes a string.
    """
    columns = []
    for path, name in mapping.items():
        kind = _lookup(records.schema, path)
        if kind is None:
            value = F.lit(None).cast("string")
        elif isinstance(kind, _NESTED):
            value = F.to_json(_at(path))
        elif isinstance(kind, _PLAIN):
            value = _at(path)
        else:
            value = _at(path).cast("string")
        columns.append(value.alias(name))
    return records.select(*[F.col(c) for c in keep], *columns)


def read_fields(
    records: DataFrame, record: str, fields: Sequence[tuple[str, str, str]], keep: Sequence[str] = ()
) -> DataFrame:
    """Project (column, type, dot path) from a variant column, whose records may each have a shape of their own.

    A missing path, a null, a path through a list and a value that is not of the type give null. As a string, nested values are
    JSON text, flags ``true`` or ``false``, and numbers are without zeros at the end.
    """

    def at(path: str) -> str:
        return "$" + "".join(f"['{segment}']" for segment in path.split("."))

    columns = [F.try_variant_get(F.col(record), at(path), kind).alias(name) for name, kind, path in fields]
    return records.select(*[F.col(c) for c in keep], *columns)


def flatten_scoped(entries: DataFrame, members: str = "items", alternative: str = "instances") -> DataFrame:
    """Members of aggregated list entries, plus the entries that are no aggregates.

    An entry is an aggregate when it carries one of the two lists, even an
    empty one; empty aggregates vanish. Plain entries carry their record in
    ``record``.
    """
    lists = F.coalesce(F.when(F.size(alternative) > 0, F.col(alternative)), F.col(members))
    one = F.when(
        F.col(members).isNull() & F.col(alternative).isNull(), F.array(F.col("record"))
    ).otherwise(lists)
    kept = [c for c in entries.columns if c not in (members, alternative, "record")]
    return entries.select(*kept, F.explode(one).alias("record"))


def _filled(value: Column) -> Column:
    return F.nullif(value.cast("string"), F.lit(""))


def composite_id(df: DataFrame, fields: Sequence[str], parent: Mapping[str, Column] | None = None) -> DataFrame:
    """``resource_id`` from the given fields joined by dots: own value, else the parent's, else empty."""
    parent = parent or {}
    parts = []
    for name in fields:
        options = [_filled(F.col(name))] if name in df.columns else []
        if name in parent:
            options.append(_filled(parent[name]))
        parts.append(F.coalesce(*options, F.lit("")))
    return df.withColumn("resource_id", F.concat_ws(".", *parts))


def resource_name(df: DataFrame) -> DataFrame:
    """Keep a given name, else cluster, else node pool, else the id."""
    order = [c for c in ("resource_name", "cluster_name", "node_pool_name", "resource_id") if c in df.columns]
    return df.withColumn("resource_name", F.coalesce(*[_filled(F.col(c)) for c in order], F.lit("")))


def inherit_parent(
    children: DataFrame,
    parents: DataFrame,
    on: Mapping[str, str],
    fields: Sequence[str] = INHERITED,
) -> DataFrame:
    """Children of known parents, taking over the fields they lack.

    ``on`` maps child column to parent column. Parents without an id have no
    children, and without parents there are none.
    """
    known = parents.where(F.coalesce(*[_filled(F.col(p)) for p in on.values()]).isNotNull())
    taken = [f for f in fields if f in parents.columns]
    keys = {p: F.col(p).alias(c) for c, p in on.items()}
    side = known.select(*keys.values(), *[F.col(f).alias(f"_parent_{f}") for f in taken])
    joined = dim_join(children, side, list(on), "inner")
    for f in taken:
        own = [_filled(F.col(f))] if f in children.columns else []
        joined = joined.withColumn(f, F.coalesce(*own, F.col(f"_parent_{f}").cast("string")))
    return joined.drop(*[f"_parent_{f}" for f in taken])


def stamp(df: DataFrame, params: RunParams, service_name: str) -> DataFrame:
    """Tenancy and run columns on every row."""
    run = F.lit(params.run_ts)
    return df.withColumns(
        {
            "client_id": F.lit(params.client_id),
            "account_id": F.lit(params.account_id),
            "cloud_name": F.lit("gcp"),
            "year_month": F.date_format(utc(run), "yyyy-MM"),
            "ingestion_timestamp": F.date_format(utc(run), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"),
            "service_name": F.lit(service_name),
            "job_runtime_utc": run,
        }
    )


def fan_out(df: DataFrame, client_ids: Sequence[str | Column]) -> DataFrame:
    """The same rows once per non-empty tenant id."""
    ids = [_filled(c if isinstance(c, Column) else F.lit(c)) for c in client_ids]
    return df.withColumn("client_id", F.explode(F.array_compact(F.array(*ids))))


def conform(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Exactly the declared columns in order: missing ones null, others dropped, unparseable values null."""
    present = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for f in declared.fields:
        if f.name not in present:
            value = F.lit(None).cast(f.dataType)
        elif isinstance(f.dataType, T.MapType) and isinstance(present[f.name], T.StringType):
            value = F.from_json(F.col(f"`{f.name}`"), f.dataType)
        elif present[f.name] == f.dataType:
            value = F.col(f"`{f.name}`")
        else:
            value = F.col(f"`{f.name}`").try_cast(f.dataType)
        columns.append(value.alias(f.name))
    return df.select(*columns)


def decode(value: Column, names: Mapping[int, str]) -> Column:
    """Name of an enum number; unknown numbers stay as text."""
    known = [F.when(value == number, F.lit(name)) for number, name in names.items()]
    return F.coalesce(*known, value.cast("string"))


def lower_flag(value: Column) -> Column:
    """Boolean as the text ``true`` or ``false``."""
    return F.lower(value.cast("string"))


def point_value(double_value: Column, int_value: Column, mean_value: Column | None = None) -> Column:
    """First non-zero of the typed values of a point, else 0.0, to six decimals."""
    options = [double_value, int_value] + ([mean_value] if mean_value is not None else [])
    return half_even(truthy(*options), 6)


def enrich_points(
    points: DataFrame,
    resources: DataFrame,
    units: DataFrame,
    service_name: str,
    namespace: str,
    run_ts: Column | datetime,
) -> DataFrame:
    """Metric points with the name, place and unit of their resource; points of unknown resources drop.

    ``points``: resource_id, metric_name, ts and values; ``resources``:
    resource_id, resource_name, location, region; ``units``: metric_name, unit.
    """
    known = points.where(F.length(F.trim("resource_id")) > 0)
    side = resources.select(
        "resource_id",
        F.coalesce("resource_name", F.lit("")).alias("resource_name"),
        F.coalesce("location", "region", F.lit("")).alias("region"),
    )
    joined = dim_join(known, side, ["resource_id"], "inner")
    joined = dim_join(joined, units.select("metric_name", "unit"), ["metric_name"], "left")
    run = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    date = iso_text(F.col("ts"))
    return joined.withColumns(
        {
            "unit": F.coalesce("unit", F.lit("")),
            "metric_unit": F.coalesce("unit", F.lit("")),
            "date": date,
            "metric_date": F.substring(date, 1, 10),
            "service_name": F.lit(service_name),
            "namespace": F.lit(namespace),
            "job_runtime_utc": run,
        }
    ).drop("ts")


def default_pool(
    rows: DataFrame, pools: DataFrame, cluster: str = "cluster_name", pool: str = "node_pool_name"
) -> DataFrame:
    """Attach node pool columns: the named pool, else the cluster's only pool, else nulls."""
    columns = [c for c in pools.columns if c not in (cluster, pool)]
    named = pools.select(cluster, pool, F.struct(pool, *columns).alias("_named"))
    only = (
        pools.groupBy(cluster)
        .agg(F.count(F.lit(1)).alias("_pools"), F.first(F.struct(pool, *columns)).alias("_only"))
        .where("_pools = 1")
        .select(cluster, "_only")
    )
    joined = dim_join(rows, named, [cluster, pool], "left")
    joined = dim_join(joined, only, [cluster], "left")
    chosen = F.coalesce("_named", "_only")
    kept = [c for c in rows.columns if c != pool]
    return joined.select(*kept, chosen[pool].alias(pool), *[chosen[c].alias(c) for c in columns])


def first_rows(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Attributes of the first row per key, by one map-side combined aggregate."""
    first = F.min_by(F.struct(*columns), F.struct(*order))
    return df.where(_filled(F.col(key)).isNotNull()).groupBy(key).agg(first.alias("_first")).select(key, "_first.*")


def observed_counts(tables: Mapping[str, DataFrame], write: Callable[[DataFrame], None]) -> dict[str, int]:
    """Rows per table, counted by the one job that ``write`` runs on all of them together; tables without rows count 0.

    ``write`` is given the rows of all tables: ``table_name``, and the whole row as JSON text in ``line``.
    """
    names = list(tables)
    parts = [t.select(F.lit(name).alias("table_name"), F.to_json(F.struct("*")).alias("line")) for name, t in tables.items()]
    rows = reduce(DataFrame.unionByName, parts)
    seen = Observation()
    counts = [F.count_if(F.col("table_name") == name).alias(f"n{i}") for i, name in enumerate(names)]
    write(rows.observe(seen, *counts))
    return {name: seen.get.get(f"n{i}", 0) for i, name in enumerate(names)}


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table as a lazy table, by a job of their own; ``observed_counts`` needs none."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows") for t, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
