"""Aggregate building blocks.

Means and shares are kept as partial sums and counts until the last step, so a fact table can be
reduced by its own keys first and joined to a dimension afterwards, on the reduced rows.
"""

from pyspark.sql import functions as F
from pyspark.sql.functions import Column


def count_where(condition):
    """COUNT(*) FILTER (WHERE condition): rows where the condition is null do not count."""
    return F.count_if(condition)


def total_where(value, condition):
    return F.sum(F.when(condition, value))


def present_where(value, condition):
    return F.count(F.when(condition, value))


def rounded(value: Column, digits: int) -> Column:
    return F.round(value, digits).cast("double")


def mean(total: Column, n: Column, digits=2) -> Column:
    """Rounded mean from an exact decimal sum and a count; null when nothing was counted."""
    return rounded(raw_mean(total, n), digits)


def raw_mean(total: Column, n: Column) -> Column:
    """Mean to 16 decimals: the cast keeps Spark from trading the scale for more digits than any
    sum of minutes or miles can have."""
    return total.cast("decimal(28,6)") / F.nullif(n, F.lit(0))


def percent(part: Column, whole: Column, digits=2) -> Column:
    """100 * part / whole, null when whole is zero."""
    return rounded(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)


def percentiles(value: Column, shares: list) -> Column:
    """Exact continuous percentiles, interpolated as PERCENTILE_CONT does, as one array.

    The state of a group is a count per distinct value. For delays that is a few hundred whole
    minutes, however many rows the group has, and each task sends one such state per group.
    """
    return F.percentile(value.cast("double"), F.array(*[F.lit(p) for p in shares]))


def counted_percentiles(value: Column, n: Column, shares: list) -> Column:
    """`percentiles` of values that come with the number of rows that have them."""
    return F.percentile(value.cast("double"), F.array(*[F.lit(p) for p in shares]), n)


def distinct_few(value: Column) -> Column:
    """COUNT(DISTINCT value) for a domain of a few dozen values, such as carriers: the set is the
    state, which spares the extra shuffle of a general distinct count."""
    return F.size(F.collect_set(value)).cast("bigint")
