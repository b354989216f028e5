"""Queries on metric series and features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costgauge.functions.numeric import half_even, number, stable, truthy
from costgauge.functions.text import iso_minutes
from costgauge.functions.timing import floor_to_interval, in_window, iso_text
from costgauge.operators import features, timeseries
from costgauge.operators.ingest import point_value
from costgauge.operators.scale import percentiles
from costgauge.services import all_specs
from costgauge.sources import readers, writers
from costgauge.sources.local import local_table
from costgauge.workload import models as m
from costgauge.workload.registry import query, r, rs

ISO = "'%Y-%m-%dT%H:%M:%SZ'"


def run_ts() -> Column:
    return F.lit(m.RUN_TS).cast("timestamp")


@query(
    "scan_observations",
    f"""WITH observed AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS cluster_name, event_type AS metric_name,
         CASE WHEN event_id % 13 = 0 THEN '' WHEN event_id % 17 = 0 THEN 'None' ELSE CAST(value AS VARCHAR) END AS metric_value
  FROM events)
SELECT event_id, cluster_name, metric_name, {r('coalesce(TRY_CAST(metric_value AS DOUBLE), 0)', 6)} AS metric_value
FROM observed""",
)
def scan_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = m.table(spark, sf_dir, "events")
    text = (
        F.when(F.col("event_id") % 13 == 0, "")
        .when(F.col("event_id") % 17 == 0, "None")
        .otherwise(F.col("value").cast("string"))
    )
    path = writers.shared_folder(spark, "export")
    exported = events.select(
        F.col("event_id").cast("string").alias("resource_id"),
        F.col("user_id").cast("string").alias("cluster_name"),
        F.col("event_type").alias("metric_name"),
        text.alias("metric_value"),
    )
    writers.write_observations(exported, path)
    return readers.observations(spark, path).select(
        F.col("resource_id").cast("bigint").alias("event_id"),
        "cluster_name",
        "metric_name",
        half_even(number(F.col("metric_value")), 6).alias("metric_value"),
    )


@query(
    "metric_points",
    f"""SELECT event_id, {r('''coalesce(nullif(CASE WHEN event_id % 3 = 0 THEN value WHEN event_id % 3 = 1 THEN 0 END, 0),
    nullif(CASE WHEN event_id % 2 = 0 THEN CAST(floor(value) AS BIGINT) END, 0),
    nullif(CASE WHEN event_id % 5 <> 0 THEN value / 7 END, 0), 0)''', 6)} AS metric_value
FROM events""",
)
def metric_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    typed = m.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(key % 3 == 0, F.col("value")).when(key % 3 == 1, 0.0).alias("double_value"),
        F.when(key % 2 == 0, F.floor("value")).alias("int64_value"),
        F.when(key % 5 != 0, F.col("value") / 7).alias("mean_value"),
    )
    value = point_value(F.col("double_value"), F.col("int64_value"), F.col("mean_value"))
    return typed.select("event_id", value.alias("metric_value"))


@query(
    "metric_window_filter",
    m.lines(m.POINTS)
    + f"""SELECT event_id, resource_id, metric_name FROM points
WHERE ts >= TIMESTAMP '{m.RUN_TS}' - INTERVAL 7 DAY AND ts <= TIMESTAMP '{m.RUN_TS}'""",
)
def metric_window_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.points(spark, sf_dir).where(in_window(F.col("ts"), run_ts(), 7)).select(
        "event_id", "resource_id", "metric_name"
    )


@query(
    "align_series",
    m.lines(m.POINTS)
    + f"""SELECT resource_id, metric_name, strftime(time_bucket(INTERVAL 1 HOUR, ts), {ISO}) AS bucket,
  {rs('avg(value)', 6)} AS value FROM points GROUP BY 1, 2, 3""",
)
def align_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = timeseries.align(m.points(spark, sf_dir), ["resource_id", "metric_name"], "PT1H")
    return aligned.select(
        "resource_id", "metric_name", iso_text(F.col("bucket")).alias("bucket"), stable(F.col("value"), 6).alias("value")
    )


ALIGNED = """aligned AS (
  SELECT resource_id, metric_name, time_bucket(INTERVAL 1 DAY, ts) AS bucket, avg(value) AS value
  FROM points GROUP BY 1, 2, 3)"""
REDUCED = {
    "average": "Average",
    "maximum": "Maximum",
    "minimum": "Minimum",
    "total": "Total",
    "n": "Count",
    "summed": "Sum",
    "unknown": "Median",
}


@query(
    "reduce_series",
    m.lines(m.POINTS, ALIGNED)
    + f"""SELECT metric_name, strftime(bucket, {ISO}) AS bucket, {rs('avg(value)', 6)} AS average,
  {rs('max(value)', 6)} AS maximum, {rs('min(value)', 6)} AS minimum, {rs('sum(value)', 6)} AS total,
  {rs('count(value)', 6)} AS n, {rs('sum(value)', 6)} AS summed, {rs('avg(value)', 6)} AS unknown
FROM aligned GROUP BY metric_name, aligned.bucket""",
)
def reduce_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = timeseries.align(m.points(spark, sf_dir), ["resource_id", "metric_name"], "P1D")
    reduced = timeseries.reduce_all(aligned, ["metric_name"], REDUCED)
    return reduced.select(
        "metric_name", iso_text(F.col("bucket")).alias("bucket"), *[stable(F.col(n), 6).alias(n) for n in REDUCED]
    )


@query(
    "last_value_series",
    m.lines(m.POINTS)
    + f"""SELECT resource_id, metric_name, strftime(time_bucket(INTERVAL 1 DAY, ts), {ISO}) AS bucket,
  {rs('arg_max(value, (ts, value))', 6)} AS value FROM points GROUP BY 1, 2, 3""",
)
def last_value_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = timeseries.align(m.points(spark, sf_dir), ["resource_id", "metric_name"], "P1D", aggregation="Gauge")
    return last.select(
        "resource_id", "metric_name", iso_text(F.col("bucket")).alias("bucket"), stable(F.col("value"), 6).alias("value")
    )


@query(
    "reduce_percentile",
    m.lines(m.POINTS, ALIGNED)
    + f"""SELECT metric_name, strftime(bucket, {ISO}) AS bucket, {rs('quantile_cont(value, 0.5)', 6)} AS p50,
  {rs('quantile_cont(value, 0.95)', 6)} AS p95, {rs('quantile_cont(value, 0.99)', 6)} AS p95_compat
FROM aligned GROUP BY metric_name, aligned.bucket""",
)
def reduce_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = timeseries.align(m.points(spark, sf_dir), ["resource_id", "metric_name"], "P1D")
    wanted = {
        "p50": timeseries.requested_percentile(50),
        "p95": timeseries.requested_percentile(95),
        "p95_compat": timeseries.requested_percentile(95, compat=True),
    }
    found = percentiles(aligned, ["metric_name", "bucket"], {n: ("value", p) for n, p in wanted.items()})
    return found.select(
        "metric_name", iso_text(F.col("bucket")).alias("bucket"), *[stable(F.col(n), 6).alias(n) for n in wanted]
    )


SERIES_SPECS = [
    timeseries.MetricSpec(metric, "", aggregation, "P1D", percentile)
    for metric in (m.CPU, m.MEMORY)
    for aggregation, percentile in (
        ("Average", None), ("Maximum", None), ("Minimum", None), ("Total", None), ("Count", None),
        ("Percentile", 50), ("Percentile", 95), ("Percentile", 99),
    )
]


@query(
    "reduce_series_by_spec",
    m.lines(
        m.POINTS,
        f"""own AS (SELECT resource_id, metric_name, date_trunc('day', ts) AS bucket, event_id % 2 AS series, avg(value) AS value
  FROM points WHERE metric_name IN ('{m.CPU}', '{m.MEMORY}') GROUP BY ALL)""",
        """reduced AS (SELECT resource_id, metric_name, bucket, avg(value) AS a, max(value) AS b, min(value) AS c, sum(value) AS d,
    CAST(count(*) AS DOUBLE) AS e, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.95) AS p95,
    quantile_cont(value, 0.99) AS p99 FROM own GROUP BY resource_id, metric_name, bucket)""",
        """listed AS (SELECT resource_id, metric_name, bucket, unnest([
    {'t': 'Average', 'p': NULL, 'v': a}, {'t': 'Maximum', 'p': NULL, 'v': b}, {'t': 'Minimum', 'p': NULL, 'v': c},
    {'t': 'Total', 'p': NULL, 'v': d}, {'t': 'Count', 'p': NULL, 'v': e}, {'t': 'Percentile', 'p': 50, 'v': p50},
    {'t': 'Percentile', 'p': 95, 'v': p95}, {'t': 'Percentile', 'p': 99, 'v': p99}]) AS x FROM reduced)""",
    )
    + f"""SELECT resource_id, metric_name, x.t AS aggregation_type, CAST(x.p AS INTEGER) AS percentile,
  strftime(bucket, {ISO}) AS bucket, {rs('x.v', 6)} AS value FROM listed""",
)
def reduce_series_by_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two series for each resource, aligned to days and reduced as each spec says."""
    points = m.points(spark, sf_dir).withColumn("series", F.col("event_id") % 2)
    found = timeseries.reduce_by_spec(points, SERIES_SPECS, ["resource_id"], ["series"])
    return found.select(
        "resource_id", "metric_name", "aggregation_type", "percentile",
        iso_text(F.col("bucket")).alias("bucket"), stable(F.col("value"), 6).alias("value"),
    )


@query(
    "dedupe_specs",
    """SELECT p_name AS metric_name, p_type AS aggregation, 'PT' || (p_size % 3) || 'H' AS interval,
  CASE WHEN p_size % 2 = 0 THEN p_size END AS percentile, min(p_brand) AS unit FROM part GROUP BY 1, 2, 3, 4""",
)
def dedupe_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = m.table(spark, sf_dir, "part").select(
        F.col("p_name").alias("metric_name"),
        F.col("p_type").alias("aggregation"),
        F.concat(F.lit("PT"), F.col("p_size") % 3, F.lit("H")).alias("interval"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_size")).alias("percentile"),
        F.col("p_brand").alias("unit"),
    )
    return timeseries.distinct_specs(specs)


DURATION_KINDS = 7


@query(
    "iso_duration",
    """WITH texts AS (SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'PT' || p_size || 'M' WHEN 1 THEN 'PT' || p_size || 'H'
  WHEN 2 THEN 'P' || p_size || 'D' WHEN 3 THEN 'P1DT' || p_size || 'H30M' WHEN 4 THEN 'P' WHEN 5 THEN p_size || 'M'
  ELSE 'PT5S' END AS interval FROM part)
SELECT p_partkey, interval, CASE WHEN starts_with(interval, 'P') THEN
  coalesce(TRY_CAST(regexp_extract(interval, '^P(?:(\\d+)D)?T?(?:(\\d+)H)?(?:(\\d+)M)?', 1) AS INTEGER), 0) * 1440
  + coalesce(TRY_CAST(regexp_extract(interval, '^P(?:(\\d+)D)?T?(?:(\\d+)H)?(?:(\\d+)M)?', 2) AS INTEGER), 0) * 60
  + coalesce(TRY_CAST(regexp_extract(interval, '^P(?:(\\d+)D)?T?(?:(\\d+)H)?(?:(\\d+)M)?', 3) AS INTEGER), 0)
  ELSE 5 END AS minutes FROM texts""",
)
def iso_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey") % DURATION_KINDS, F.col("p_size").cast("string")
    text = (
        F.when(key == 0, F.concat(F.lit("PT"), size, F.lit("M")))
        .when(key == 1, F.concat(F.lit("PT"), size, F.lit("H")))
        .when(key == 2, F.concat(F.lit("P"), size, F.lit("D")))
        .when(key == 3, F.concat(F.lit("P1DT"), size, F.lit("H30M")))
        .when(key == 4, "P")
        .when(key == 5, F.concat(size, F.lit("M")))
        .otherwise("PT5S")
    )
    texts = m.table(spark, sf_dir, "part").select("p_partkey", text.alias("interval"))
    return texts.withColumn("minutes", iso_minutes(F.col("interval")))


STEPS = {0: 5, 1: 15, 2: 60, 3: 1440, 4: 7, 5: 0}


@query(
    "floor_interval",
    f"""WITH steps AS (SELECT event_id, ts, CASE event_id % 6 {' '.join(f'WHEN {k} THEN {v}' for k, v in STEPS.items())} END
  AS step FROM events)
SELECT event_id, CASE WHEN step > 0 THEN strftime(date_trunc('day', ts)
  + to_minutes(CAST(((hour(ts) * 60 + minute(ts)) // step) * step AS BIGINT)), {ISO}) END AS floored FROM steps""",
)
def floor_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = m.pick(F.col("event_id") % 6, STEPS, 5)
    floored = floor_to_interval(F.col("ts").cast("timestamp"), step)
    return m.table(spark, sf_dir, "events").select("event_id", iso_text(floored).alias("floored"))


@query(
    "truthy_coalesce",
    """SELECT event_id, coalesce(nullif(CASE WHEN event_id % 4 = 0 THEN 0 WHEN event_id % 4 = 1 THEN NULL ELSE value END, 0),
  CASE WHEN event_id % 3 = 0 THEN CAST(user_id AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS chosen FROM events""",
)
def truthy_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    first = F.when(key % 4 == 0, 0.0).when(key % 4 == 1, F.lit(None)).otherwise(F.col("value"))
    second = F.when(key % 3 == 0, F.col("user_id").cast("double")).otherwise(0.0)
    return m.table(spark, sf_dir, "events").select("event_id", truthy(first, second).alias("chosen"))


# Features --------------------------------------------------------------------------------------

PERCENTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


@query(
    "feature_percentiles",
    m.lines(m.POINTS)
    + "SELECT resource_id, metric_name, "
    + ", ".join(f"{rs(f'quantile_cont(value, {p})', 6)} AS {n}" for n, p in PERCENTILES.items())
    + " FROM points GROUP BY 1, 2",
)
def feature_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = {n: ("value", p) for n, p in PERCENTILES.items()}
    found = percentiles(m.points(spark, sf_dir), ["resource_id", "metric_name"], wanted)
    return found.select("resource_id", "metric_name", *[stable(F.col(n), 6).alias(n) for n in PERCENTILES])


@query(
    "feature_weekly_growth",
    f"""WITH weekly AS (
  SELECT l_suppkey, date_trunc('week', l_shipdate) AS week, sum(l_quantity) AS amount FROM lineitem GROUP BY 1, 2),
numbered AS (
  SELECT *, lag(amount) OVER w AS previous, lag(week) OVER w AS previous_week,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY week DESC) AS back
  FROM weekly WINDOW w AS (PARTITION BY l_suppkey ORDER BY week))
SELECT l_suppkey, strftime(week, '%Y-%m-%d') AS week, CASE WHEN previous_week = week - INTERVAL 7 DAY AND previous <> 0
  THEN {rs('(amount - previous) * 100 / previous', 4)} END AS growth_pct_per_week FROM numbered WHERE back = 1""",
)
def feature_weekly_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = m.table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity")
    grown = features.weekly_growth(lineitem, "l_suppkey", "l_shipdate", "l_quantity")
    return grown.withColumn("week", F.date_format("week", "yyyy-MM-dd"))


@query(
    "feature_monthly_volume",
    f"""SELECT l_partkey, strftime(l_shipdate, '%Y-%m') AS year_month, {rs('sum(l_quantity) / 75', 4)} AS monthly_data_gb,
  {rs('sum(l_extendedprice) / 1000', 4)} AS egress_gb_monthly, count(*) AS request_count_monthly,
  {rs('sum(l_quantity * l_discount)', 4)} AS query_count_millions FROM lineitem GROUP BY 1, 2""",
)
def feature_monthly_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = m.table(spark, sf_dir, "lineitem")
    volume = features.monthly_volume(
        lineitem,
        ["l_partkey"],
        "l_shipdate",
        {
            "_gb": F.col("l_quantity"),
            "_egress": F.col("l_extendedprice"),
            "request_count_monthly": F.lit(1),
            "_queries": F.col("l_quantity") * F.col("l_discount"),
        },
    )
    return volume.select(
        "l_partkey",
        "year_month",
        stable(F.col("_gb") / 75, 4).alias("monthly_data_gb"),
        stable(F.col("_egress") / 1000, 4).alias("egress_gb_monthly"),
        "request_count_monthly",
        stable(F.col("_queries"), 4).alias("query_count_millions"),
    )


@query(
    "feature_ratios",
    f"""WITH counted AS (SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS errors,
  count(*) FILTER (WHERE event_type = 'view') AS views, count(*) FILTER (WHERE event_type = 'click') AS clicks,
  count(*) FILTER (WHERE event_type = 'purchase') AS purchases FROM events GROUP BY user_id)
SELECT user_id, {r('errors * 100 / n', 4)} AS error_rate_pct,
  {r('coalesce(errors * 100 / nullif(errors + views, 0), 0)', 4)} AS miss_ratio_pct,
  {r('coalesce(views * 100 / nullif(errors + views, 0), 0)', 4)} AS cache_hit_ratio,
  {r('coalesce(clicks * 100 / nullif(purchases, 0), 0)', 4)} AS dispatch_per_attempt_pct FROM counted""",
)
def feature_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    error, view = (kind == "error").cast("int"), (kind == "view").cast("int")
    return features.ratios(
        m.table(spark, sf_dir, "events"),
        ["user_id"],
        {
            "error_rate_pct": (error, F.lit(1)),
            "miss_ratio_pct": (error, error + view),
            "cache_hit_ratio": (view, error + view),
            "dispatch_per_attempt_pct": ((kind == "click").cast("int"), (kind == "purchase").cast("int")),
        },
    )


@query(
    "feature_counts",
    """SELECT l_partkey, count(*) AS subscription_count, count(*) FILTER (WHERE l_linestatus = 'O')
  AS active_subscription_count, count(DISTINCT l_suppkey) AS record_set_count FROM lineitem GROUP BY l_partkey""",
)
def feature_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = m.table(spark, sf_dir, "lineitem")
    return features.counts(
        lineitem, ["l_partkey"], active=F.col("l_linestatus") == "O", member="l_suppkey",
        names=("subscription_count", "active_subscription_count", "record_set_count"),
    )


@query(
    "feature_staleness",
    f"""WITH rows AS (SELECT o_custkey, o_orderdate, o_orderstatus = 'F' AS is_read FROM orders)
SELECT o_custkey, CAST(DATE '2002-01-01' - CAST(max(o_orderdate) AS DATE) AS INTEGER) AS days_since_last_update,
  CAST(count(*) FILTER (WHERE is_read AND o_orderdate >= TIMESTAMP '2002-01-01' - INTERVAL 30 DAY) AS INTEGER) AS read_ops_30d,
  {r("count(*) FILTER (WHERE is_read) / count(DISTINCT strftime(o_orderdate, '%Y-%m'))", 4)} AS reads_per_month
FROM rows GROUP BY o_custkey""",
)
def feature_staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = m.table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    run = F.lit("2002-01-01 00:00:00").cast("timestamp")
    stale = features.staleness(orders, ["o_custkey"], "o_orderdate", run, F.col("o_orderstatus") == "F")
    return stale.withColumn("reads_per_month", half_even(F.col("reads_per_month"), 4))


# Declared services -----------------------------------------------------------------------------


def _spec_rows() -> list[tuple]:
    return [
        (i, service, s.metric_name, s.unit, s.aggregation, s.interval, s.percentile)
        for i, (service, s) in enumerate(all_specs())
    ]


def _spec_values() -> str:
    def text(v: object) -> str:
        return "NULL" if v is None else str(v) if isinstance(v, int) else f"'{v}'"

    return ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in _spec_rows())


@query(
    "service_catalog",
    f"""WITH spec AS (SELECT * FROM (VALUES {_spec_values()})
  t(place, service, metric_name, unit, aggregation, interval, percentile))
SELECT service, metric_name, unit, aggregation, interval, percentile, count(*) AS n_points, {rs('avg(value)', 6)} AS mean_value
FROM events JOIN spec ON place = event_id % (SELECT count(*) FROM spec) GROUP BY ALL""",
)
def service_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spec_rows()
    specs = local_table(
        spark, rows, "place int, service string, metric_name string, unit string, aggregation string, interval string, percentile int"
    )
    events = m.table(spark, sf_dir, "events")
    per_place = events.groupBy((F.col("event_id") % len(rows)).cast("int").alias("place")).agg(
        F.count(F.lit(1)).alias("n_points"), F.avg("value").alias("_mean")
    )
    # The declared specs are a fixed table.
    joined = per_place.join(F.broadcast(specs), "place")
    return joined.withColumn("mean_value", stable(F.col("_mean"), 6)).drop("place", "_mean")
