"""Number handling as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOURS_PER_MONTH = 730
HOURS_PER_YEAR = 8760
MONTHS_PER_YEAR = 12


def half_even(x: Column, digits: int) -> Column:
    """Round to ``digits`` decimals, ties to even, judged on the exact binary value.

    ``x * 10^digits`` can land on a tie that ``x`` itself is not on. Where the
    product is a tie, its rounding error (exact, by splitting ``x`` into a float
    and a rest) tells which side ``x`` is really on. Everything stays in
    generated code; bind ``x`` to a column first when it is a long expression.
    """
    x = x.cast("double")
    scale = float(10**digits)
    product = x * scale
    even = F.rint(product)
    gap = product - even
    head = x.cast("float").cast("double")
    error = (head * scale - product) + (x - head) * scale
    beyond_tie = (gap * gap == 0.25) & (error * gap > 0)
    return (even + F.when(beyond_tie, gap * 2).otherwise(0.0)) / scale


def stable(x: Column, digits: int) -> Column:
    """Round an aggregate so that the order of summation does not show.

    Sums differ in their last bits from run to run; where the true value is a
    tie that would tip the result. Rounding four digits finer first settles it.
    """
    finer = float(10 ** (digits + 4))
    return half_even(F.rint(x.cast("double") * finer) / finer, digits)


def number(x: Column) -> Column:
    """Any value as a double; missing, blank or unparseable gives 0.0."""
    return F.coalesce(x.try_cast("double"), F.lit(0.0))


def truthy(*options: Column) -> Column:
    """First option that is neither null nor zero, else the last one, else 0.0."""
    chain = [F.nullif(o.cast("double"), F.lit(0.0)) for o in options]
    return F.coalesce(*chain, options[-1].cast("double"), F.lit(0.0))


def count_or_one(x: Column) -> Column:
    """A count where missing and zero both mean one."""
    return truthy(number(x), F.lit(1.0))


def required_capacity(capacity: Column, utilisation_pct: Column) -> Column:
    """Capacity the load needs with 30 % headroom; half of it where nothing was measured."""
    return F.when(
        utilisation_pct > 0,
        F.greatest(F.lit(1.0), capacity * (utilisation_pct / 100) * 1.3),
    ).otherwise(capacity * 0.5)


def let(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later steps refer to many times.

    The values go through a one-element ``inline`` so that a filter on a result
    is evaluated on the computed value instead of being rewritten in terms of
    the whole expression behind it.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*[F.col(f"`{c}`") for c in kept], F.inline(F.array(row)))
