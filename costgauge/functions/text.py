"""Text handling as Column expressions: durations, machine families, templates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from costgauge.functions.numeric import half_even

# Machine families named in price descriptions, in listed order.
COMPUTE_FAMILIES = ("e2", "n1", "n2", "n2d", "c2", "c2d", "c3", "c3d", "n4", "t2d", "t2a", "m1", "m2", "a2")
WORKER_FAMILIES = ("n1", "n2", "n2d", "e2", "c2", "c2d", "t2d")
COMPOUND_FAMILIES = ("n2d", "c2d", "t2d", "t2a", "m1", "m2", "a2")

def iso_minutes(interval: Column) -> Column:
    """Minutes of an ISO-8601 duration of days, hours and minutes; other text gives 5."""

    def amount(unit: str) -> Column:
        """The number in front of a unit's letter."""
        return F.coalesce(F.regexp_extract(interval, f"([0-9]+){unit}", 1).try_cast("int"), F.lit(0))

    minutes = amount("D") * 24 * 60 + amount("H") * 60 + amount("M")
    return F.when(interval.startswith("P"), minutes).otherwise(F.lit(5))


def machine_family(machine_type: Column) -> Column:
    """Family prefix of a machine type such as ``n2-standard-4``."""
    first = F.substring_index(machine_type, "-", 1)
    second = F.get(F.split(machine_type, "-"), F.lit(1))
    compound = F.concat(first, second)
    split_family = first.rlike(r"^.{0,2}[0-9]$") & second.rlike(r"^[A-Za-z]{1,2}$") & compound.isin(*COMPOUND_FAMILIES)
    return F.when(machine_type.isNull(), F.lit("")).when(split_family, compound).otherwise(first)


def family_in_description(description: Column, families: Sequence[str] = COMPUTE_FAMILIES) -> Column:
    """Family named in a price description: longest name first, not followed by a letter or digit."""
    text = F.lower(description)
    hits = [F.when(text.rlike(f"{f}(?![a-z0-9])"), F.lit(f)) for f in sorted(families, key=len, reverse=True)]
    return F.coalesce(*hits)


def family_substring(description: Column, families: Sequence[str] = WORKER_FAMILIES) -> Column:
    """First listed family that occurs anywhere in the description."""
    text = F.lower(description)
    return F.coalesce(*[F.when(text.contains(f), F.lit(f)) for f in families])


def render(template: Column, values: dict[str, Column]) -> Column:
    """Fill ``{name}`` fields of a template column."""
    text = template
    for name, value in values.items():
        text = F.replace(text, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return text


def template_or(template: Column | None, default: str) -> Column:
    """The given template, or the built-in text where it is null or empty."""
    if template is None:
        return F.lit(default)
    return F.coalesce(F.nullif(template, F.lit("")), F.lit(default))


def fixed(x: Column, digits: int) -> Column:
    """Fixed-decimal text of a number, rounded half to even; a negative number that rounds to zero keeps its sign (-0.0)."""
    if digits == 0:
        text = F.rint(F.abs(x)).cast("bigint").cast("string")
    else:
        text = F.format_string(f"%.{digits}f", F.abs(half_even(x, digits)))
    negative = x.cast("double").cast("string").startswith("-")
    return F.concat(F.when(negative, F.lit("-")).otherwise(F.lit("")), text)


def thousands(x: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(F.rint(x), 0)


def join_present(separator: str, *parts: Column) -> Column:
    """Join the parts that are not null."""
    return F.array_join(F.array_compact(F.array(*parts)), separator)
