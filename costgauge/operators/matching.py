"""Matching workloads to cheaper machine types.

A workload asks for the smallest machine of its group that is cheaper and still
big enough. The catalog is first reduced to what can ever be an answer, so a
workload is never paired with every machine of its group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costgauge.functions.numeric import half_even
from costgauge.functions.text import machine_family
from costgauge.operators.scale import dim_join, same_join

# A machine with the fields in front that decide between two that fit.
RANKED = ("vcpus", "ram_gb", "ordinal", "machine_type", "hourly_cost", "monthly_cost", "annual_cost")


@dataclass(frozen=True)
class Catalog:
    """Flat machine specs to look up and match in.

    A type may be listed several times in a ``group``, the set inside which
    cheaper machines are sought, for example once per region. ``unique`` says
    that no type occurs in two groups or twice in one.
    """

    entries: DataFrame
    group: str = "family"
    unique: bool = False


def lookup(workloads: DataFrame, catalog: Catalog) -> DataFrame:
    """Attach the catalog entry of each workload's ``machine_type`` as ``cur_*`` columns.

    Where a type occurs several times one aggregate keeps the entry of the
    lowest ``priority``, then the first family. Unknown types drop.
    """
    present = catalog.entries.columns
    columns = [c for c in present if c not in ("machine_type", "priority")]
    if catalog.unique:
        entries = catalog.entries.select("machine_type", *[F.col(c).alias(f"cur_{c}") for c in columns])
    else:
        order = [c for c in ("priority", "family", "ordinal") if c in present]
        best = F.min_by(F.struct(*columns), F.struct(*order)).alias("_entry")
        entries = catalog.entries.groupBy("machine_type").agg(best).select(
            "machine_type", *[F.col(f"_entry.{c}").alias(f"cur_{c}") for c in columns]
        )
    return dim_join(workloads, entries, ["machine_type"])


def own_family_first(entries: DataFrame) -> DataFrame:
    """Priority column: entries whose family is the type's own prefix come first."""
    own = F.col("family") == machine_family(F.col("machine_type"))
    return entries.withColumn("priority", F.when(own, 0).otherwise(1))


def missing_types(workloads: DataFrame, catalog: Catalog) -> DataFrame:
    """Workloads whose machine type is not in the catalog or has no vCPUs there."""
    usable = catalog.entries.where(F.col("vcpus") > 0).select("machine_type").distinct()
    return dim_join(workloads, usable, ["machine_type"], "left_anti")


def _candidates(catalog: Catalog) -> DataFrame:
    """The entries that can be a best answer: per size, the two cheapest types.

    A type listed several times stands with its cheapest entry. The second type
    answers for workloads that already run the first. The row number filter is
    applied before the shuffle as well.
    """
    size = [catalog.group, "vcpus", "ram_gb"]
    rest = F.struct(*[c for c in RANKED if c not in ("vcpus", "ram_gb", "machine_type")])
    types = catalog.entries.groupBy(*size, "machine_type").agg(F.min(rest).alias("_rest"))
    types = types.select(*size, "machine_type", "_rest.*")
    place = Window.partitionBy(*size).orderBy("ordinal", "machine_type")
    placed = types.withColumn("_place", F.row_number().over(place)).where("_place <= 2")
    return placed.select(catalog.group, F.struct(*RANKED).alias("entry"))


def _first_fit(entries: Column) -> Column:
    """First entry of a sorted list that is cheaper and big enough for the row's workload."""
    fits = F.filter(
        entries,
        lambda e: (e["vcpus"] >= F.col("required_vcpus"))
        & (e["ram_gb"] >= F.col("required_ram"))
        & (e["ordinal"] < F.col("cur_ordinal"))
        & (e["machine_type"] != F.col("machine_type")),
    )
    return F.get(fits, F.lit(0))


def best_fit(workloads: DataFrame, catalog: Catalog, pool: str | None = None) -> DataFrame:
    """Column ``target``: the smallest cheaper machine that fits, null where there is none.

    Workloads carry ``machine_type``, ``cur_ordinal``, ``required_vcpus``,
    ``required_ram`` and the ``group`` column. The candidates of a group, two
    for each machine size in it, travel as one sorted list, in which each
    workload finds its own; a workload stays one row. With ``pool`` all
    workloads ask in that one group: its list is then a scalar subquery and
    there is no join at all.
    """
    group = catalog.group
    candidates = _candidates(catalog)
    if pool is not None:
        own = candidates.where(F.col(group) == pool)
        listed = workloads.withColumn("_entries", own.agg(F.array_sort(F.collect_list("entry"))).scalar())
    else:
        index = candidates.groupBy(group).agg(F.array_sort(F.collect_list("entry")).alias("_entries"))
        listed = workloads.join(index, group, "left")
    return listed.withColumn("target", _first_fit(F.col("_entries"))).drop("_entries")


STEPS = 1_024  # ordinals that are folded as one list


def closest_cheaper(catalog: Catalog, keep: int = 3) -> DataFrame:
    """Per group and ordinal, the ``keep`` next cheaper machine types, nearest price first.

    What lies below an ordinal is a state of at most ``keep`` + 1 different types, nearest first, which is carried upwards:
    inside blocks of STEPS ordinals, and over the blocks of a group. Two states combine to the first types of both, so each
    block is folded on its own, and the work grows with the catalog only. A type listed several times counts once, with its
    nearest entry. One type is kept to spare for workloads whose own type is among them. Ordinals may have gaps.
    """
    group, spare = catalog.group, keep + 1
    entry = F.struct((-F.col("ordinal")).alias("_down"), F.col("machine_type").alias("_name"), *RANKED)
    if catalog.unique:
        types = catalog.entries.select(group, "ordinal", "machine_type", entry.alias("_entry"))
    else:
        types = catalog.entries.groupBy(group, "ordinal", "machine_type").agg(F.min(entry).alias("_entry"))
    place = Window.partitionBy(group, "ordinal").orderBy("machine_type")
    firsts = types.withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= spare)
    steps = firsts.groupBy(group, "ordinal").agg(F.array_sort(F.collect_list("_entry")).alias("_own"))

    def listed(at: str) -> Column:
        """Steps or blocks as one list in order."""
        return F.sort_array(F.collect_list(F.struct(F.col(at).alias("_at"), "_own"))).alias("_list")

    blocks = steps.groupBy(group, F.floor(F.col("ordinal") / STEPS).alias("_block")).agg(listed("ordinal"))
    spans = blocks.withColumn("_own", _state_after("_list", spare)).groupBy(group).agg(listed("_block"))
    nothing = F.flatten(F.slice(F.col("_list")["_own"], 1, 0))
    carried = spans.select(group, F.inline(_states_before("_list", nothing, spare))).withColumnRenamed("_at", "_block")
    joined = same_join(blocks, carried, [group, "_block"])
    found = joined.select(group, F.inline(_states_before("_list", F.col("_before"), spare)))
    return found.select(group, F.col("_at").alias("ordinal"), F.col("_before").alias("cheaper")).where(F.size("cheaper") > 0)


def _nearest(near: Column, far: Column, spare: int) -> Column:
    """The first different types of a nearer state and a farther one."""
    new = F.filter(far, lambda e: ~F.exists(near, lambda n: n["machine_type"] == e["machine_type"]))
    return F.slice(F.concat(near, new), 1, spare)


def _state_after(steps: str, spare: int) -> Column:
    """The state that a list of steps makes by itself."""
    start = F.flatten(F.slice(F.col(steps)["_own"], 1, 0))
    return F.aggregate(steps, start, lambda state, step: _nearest(step["_own"], state, spare))


def _states_before(steps: str, start: Column, spare: int) -> Column:
    """For each step of a list, the state below it, where ``start`` is the state below the first."""
    rows = F.transform(F.slice(steps, 1, 0), lambda s: F.struct(s["_at"].alias("_at"), s["_own"].alias("_before")))
    first = F.struct(start.alias("state"), rows.alias("rows"))

    def carry(so_far: Column, step: Column) -> Column:
        here = F.struct(step["_at"].alias("_at"), so_far["state"].alias("_before"))
        return F.struct(
            _nearest(step["_own"], so_far["state"], spare).alias("state"), F.concat(so_far["rows"], F.array(here)).alias("rows")
        )

    return F.aggregate(steps, first, carry)["rows"]


def fallback_targets(cheaper: Column, own_type: Column, keep: int = 3) -> Column:
    """The first ``keep`` cheaper machines that are not the workload's own type."""
    return F.slice(F.filter(cheaper, lambda e: e["machine_type"] != own_type), 1, keep)


def mean_of(targets: Column, field: str, most: int = 3) -> Column:
    """Mean of a field over the (at most ``most``) targets of a row, summed in order."""
    total = F.lit(0.0)
    for i in range(most):
        total = total + F.coalesce(F.get(targets, F.lit(i))[field], F.lit(0.0))
    return total / F.size(targets)


def with_mean_costs(df: DataFrame, targets: str = "targets") -> DataFrame:
    """Mean hourly, monthly and annual cost of the targets."""
    sums = {f"_{f}": mean_of(F.col(targets), f) for f in ("hourly_cost", "monthly_cost", "annual_cost")}
    return (
        df.withColumns(sums)
        .withColumns(
            {
                "avg_hourly_cost": half_even(F.col("_hourly_cost"), 6),
                "avg_monthly_cost": half_even(F.col("_monthly_cost"), 4),
                "avg_annual_cost": half_even(F.col("_annual_cost"), 4),
            }
        )
        .drop(*sums)
    )
