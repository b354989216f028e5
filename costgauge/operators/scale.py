"""Joins, ranks and percentiles that hold when one key has a third of all rows.

There is one plan for every size. row_numbers and dense_ranks are lazy: a group of any size is cut into value buckets whose
bounds come from the group's own quantiles; rows are ordered inside buckets, and a bucket starts where the ones below it
end. positions and dense_positions store the ordered rows once and are the better choice where a result is used many times.
Null keys and null values are groups and values like any other.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costgauge.functions.numeric import let
from costgauge.session import ensure_checkpoint_dir

BUCKETS = 32
ACCURACY = 1_000


def dim_join(fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join facts to a dimension that is unique on ``on``.

    The planner broadcasts a side under its own threshold of bytes; otherwise the adaptive skew join splits the partition of a
    hot key, and only that one.
    """
    return fact.join(dim, list(on), how)


def same_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys of which null is a value like any other; the columns of ``on`` come from the left."""
    renamed = right.withColumnsRenamed({c: f"_same_{c}" for c in on})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_same_{c}")) for c in on])
    return left.join(renamed, same, how).drop(*[f"_same_{c}" for c in on])


def bucketed(rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Add ``_bucket``: how many of the group's quantiles lie below the row's numeric value, -1 for null.

    Buckets are in the order of the values; only their balance depends on the quantiles.
    """
    levels = [i / BUCKETS for i in range(1, BUCKETS)]
    number = F.col(value).cast("double")
    cuts = rows.groupBy(*by).agg(F.percentile_approx(number, levels, ACCURACY).alias("_cuts"))
    below = F.size(F.filter(F.coalesce("_cuts", F.array().cast("array<double>")), lambda cut: cut < number))
    placed = same_join(rows, cuts, by).withColumn("_bucket", F.when(number.isNull(), -1).otherwise(below))
    return placed.drop("_cuts")


def _before_buckets(rows: DataFrame, group: Sequence[str], amount: Column) -> DataFrame:
    """Sum of ``amount`` in the bucket, in all lower ones and in the group; one row per group and bucket."""
    totals = rows.groupBy(*group, "_bucket").agg(F.sum(amount).alias("_in"))
    whole = Window.partitionBy(*group)
    lower = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_in").over(lower), F.lit(0))
    return totals.withColumns({"_before": before, "_total": F.sum("_in").over(whole)})


def row_numbers(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """Position of each row in its group; ``order`` starts with a numeric column and is unique in the group."""
    rows = bucketed(df, group, order[0])
    offsets = _before_buckets(rows, group, F.lit(1)).select(*group, "_bucket", "_before")
    inner = F.row_number().over(Window.partitionBy(*group, "_bucket").orderBy(*order))
    placed = same_join(rows.withColumn("_inner", inner), offsets, [*group, "_bucket"])
    position = (F.col("_inner") + F.col("_before")).cast("int")
    return placed.withColumn(out, position).drop("_bucket", "_inner", "_before")


def dense_ranks(df: DataFrame, group: Sequence[str], value: str, out: str) -> DataFrame:
    """Dense rank of a numeric value inside its group, null first.

    Ranks are taken over the distinct values only, so copies of a value cost nothing beyond the map-side distinct, and go
    back by a join.
    """
    values = df.select(*group, value).distinct()
    return same_join(df, row_numbers(values, group, [value], out), [*group, value])


def positions(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """Position of each row in its group, from 1, by the whole ``order``; rows equal in it get any of their positions.

    Unlike row_numbers this runs at once: rows are range-partitioned by group and order, so that neither a hot group nor the
    ties of a hot value meet in one task, and stored with checkpoint(); a partition's rows of a group start where those of the
    partitions before it end.
    """
    by = [*group, *order]
    ordered = df.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = materialised(ordered.withColumn("_id", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_id", 33).cast("int"))
    parts = placed.groupBy(*group, "_part").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    lower = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(lower), F.lit(0))).drop("_n")
    joined = same_join(placed, starts, [*group, "_part"])
    position = (F.col("_id") - F.col("_first") + F.col("_before") + 1).cast("int")
    return joined.withColumn(out, position).drop("_id", "_part", "_first", "_before")


def dense_positions(df: DataFrame, group: Sequence[str], value: str, out: str) -> DataFrame:
    """dense_ranks by way of positions(): the distinct values are ordered once, at once."""
    values = df.select(*group, value).distinct()
    return same_join(df, positions(values, group, [value], out), [*group, value])


def materialised(df: DataFrame) -> DataFrame:
    """Compute now and cut the lineage with checkpoint(), in the folder that spark.checkpoint.dir names."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


# Values of a group that are kept one by one, and the size of the quantile sketch for more. The rank error of one answer of such a
# sketch is about normal, with a standard deviation of 0.9 / KEPT ** 0.9 of the group; brackets reach eight of them to each side.
KEPT = 4_096


def _margin() -> float:
    return 8 * 0.9 / KEPT**0.9


def percentiles(
    df: DataFrame,
    keys: Sequence[str],
    wanted: Mapping[str, tuple[str, float]],
    also: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Exact interpolated percentiles per group; ``wanted`` maps output names to (column, fraction).

    One aggregate keeps the values of each group and column with their counts, whole as long as there are at most KEPT, from which the
    percentile is read; its state is bounded and it combines before the shuffle. For larger groups a mergeable quantile sketch
    gives a bracket for each wanted position; another pass counts the values between brackets in the tasks that read them,
    and orders only those inside, under 1 % of the group for each position. Where no group is that large both passes drop all
    rows as they are read. A position outside its bracket stops the query.

    Groups without any value have null, NaN is the greatest value; ``also`` holds further aggregates of the groups.
    """
    columns = sorted({c for c, _ in wanted.values()})
    place = {c: i for i, c in enumerate(columns)}
    fractions = [sorted({float(p) for name, p in wanted.values() if name == c}) for c in columns]
    numbers = [F.col(c).cast("double") for c in columns]
    others = {f"_also{i}": column for i, column in enumerate((also or {}).values())}
    sizes = [F.count(number).alias(f"_n{i}") for i, number in enumerate(numbers)]
    common = [*sizes, *[column.alias(name) for name, column in others.items()]]
    items = [F.call_function("approx_top_k", n, F.lit(KEPT), F.lit(2 * KEPT)).alias(f"_items{i}") for i, n in enumerate(numbers)]
    large = reduce(lambda a, b: a | b, [F.col(f"_n{i}") > KEPT for i in range(len(columns))])
    grouped = df.groupBy(*keys).agg(*common, *items)
    # Both uses ask for all aggregates, so that they share one exchange.
    whole = let(grouped, **{name: F.col(name) for name in grouped.columns if name not in keys})
    any_large = whole.where(large).agg(F.count(F.lit(1))).scalar() > 0

    def named(values: Mapping[str, Column]) -> list[Column]:
        renamed = [F.col(old).alias(new) for old, new in zip(others, also or {}, strict=True)]
        return [*[F.col(k) for k in keys], *[v.alias(n) for n, v in values.items()], *renamed]

    values = {f"_values{i}": _in_order(F.col(f"_items{i}")) for i in range(len(columns))}
    kept = let(whole.where(~large), **values)
    small = {}
    for j, (column, p) in enumerate(wanted.values()):
        i = place[column]
        at = _position(F.col(f"_n{i}"), p)
        low, high = (F.get(f"_values{i}", index.cast("int")) for index in (F.floor(at), F.ceil(at)))
        small[f"_p{j}"] = F.when(F.col(f"_n{i}") > 0, low + (high - low) * (at - F.floor(at)))
    read = let(kept, **small).select(*named({n: F.col(f"_p{j}") for j, n in enumerate(wanted)}))

    facts = df.where(any_large)
    sketches = [F.call_function("kll_sketch_agg_double", n, F.lit(KEPT)).alias(f"_sketch{i}") for i, n in enumerate(numbers)]
    bounds = F.array(*[_brackets(i, levels) for i, levels in enumerate(fractions)]).alias("_bounds")
    rest = F.struct(F.lit(0).alias("_none"), *others).alias("_rest")
    open_groups = facts.groupBy(*keys).agg(*common, *sketches).where(large).select(*keys, bounds, rest)
    each = [F.struct(F.lit(i).alias("_c"), n.alias("_v")) for i, n in enumerate(numbers)]
    rows = facts.select(*keys, F.inline(F.array(*each))).where(F.col("_v").isNotNull())
    found = _selected(same_join(rows, open_groups, keys), keys, wanted, place)
    picked = {n: F.col(f"_lo{j}") + (F.col(f"_hi{j}") - F.col(f"_lo{j}")) * F.col(f"_part{j}") for j, n in enumerate(wanted)}
    return read.unionByName(found.select(*named(picked)))


def _in_order(items: Column) -> Column:
    """All values of a group from its different ones and their counts."""
    known = F.filter(items, lambda e: e["item"].isNotNull())
    return F.flatten(F.transform(F.sort_array(known), lambda e: F.array_repeat(e["item"], e["count"].cast("int"))))


def _position(n: Column, p: float) -> Column:
    return (n - 1) * F.lit(float(p))


def _brackets(i: int, levels: Sequence[float]) -> Column:
    """The size of a column, and the bracket of each wanted position; both lists are in order. NaN is beyond every value."""
    margin, size, sketch = _margin(), F.col(f"_n{i}"), F.col(f"_sketch{i}")
    # The sketch passes over NaN; such a column is taken whole, and so is a small one.
    held = F.when(size > 0, F.call_function("kll_sketch_get_n_double", sketch))
    whole = (size <= KEPT) | (held != size)

    def level(p: float) -> Column:
        return F.call_function("kll_sketch_get_quantile_double", sketch, F.lit(p))

    lows = [F.lit(float("-inf")) if p <= margin else F.when(whole, float("-inf")).otherwise(level(p - margin)) for p in levels]
    highs = [F.lit(float("nan")) if p >= 1 - margin else F.when(whole, float("nan")).otherwise(level(p + margin)) for p in levels]
    return F.struct(size.alias("total"), F.array(*lows).alias("lows"), F.array(*highs).alias("highs"))


def _selected(rows: DataFrame, keys: Sequence[str], wanted: Mapping[str, tuple[str, float]], place: Mapping[str, int]) -> DataFrame:
    """The values on both sides of each wanted position, from rows with _c, _v, the _bounds and the _rest of their group.

    A cell is a value inside a bracket, or all values between two brackets; cells are in the order of their values.
    """
    own = F.get("_bounds", F.col("_c"))
    bounded = rows.select(*keys, "_c", "_v", "_rest", own["total"].alias("_total"), own["lows"].alias("_lows"), own["highs"].alias("_highs"))
    passed = F.size(F.filter("_highs", lambda high: high < F.col("_v")))
    inside = (F.col("_zone") < F.size("_highs")) & (F.col("_v") >= F.get("_lows", F.col("_zone")))
    zoned = bounded.withColumn("_zone", passed).withColumn("_slot", F.when(inside, F.col("_v")))
    cells = zoned.groupBy(*keys, "_c", "_zone", "_slot").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_at"), F.first("_total").alias("_total"), F.first("_rest").alias("_rest")
    )
    lower = Window.partitionBy(*keys, "_c").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    started = cells.withColumn("_start", F.coalesce(F.sum("_n").over(lower), F.lit(0)))
    outside = F.raise_error(F.lit("percentile outside the bracket of its sketch")).cast("double")
    value = F.when(F.col("_slot").isNull(), outside).otherwise(F.col("_at"))
    picks = []
    for j, (column, p) in enumerate(wanted.values()):
        this, at = F.col("_c") == place[column], _position(F.col("_total"), p)
        for label, index in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            hit = this & (index >= F.col("_start")) & (index < F.col("_start") + F.col("_n"))
            picks.append(F.max(F.when(hit, value)).alias(f"_{label}{j}"))
        picks.append(F.max(F.when(this, at - F.floor(at))).alias(f"_part{j}"))
    return started.groupBy(*keys).agg(*picks, F.first("_rest").alias("_rest")).select("*", "_rest.*").drop("_rest")
