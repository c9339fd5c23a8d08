"""Number parsing, exact ratios, and aggregate expressions.

Ratios are taken on decimals so that results do not depend on the order rows
arrive in; a zero denominator gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.text import col

COUNT = "decimal(20,0)"


def to_decimal(c: Column | str, precision: int, scale: int, strict: bool = True) -> Column:
    """Text to a fixed-point number, rounding half away from zero."""
    kind = f"decimal({precision},{scale})"
    return col(c).cast(kind) if strict else col(c).try_cast(kind)


def to_whole(c: Column | str, kind: str = "int", strict: bool = True) -> Column:
    """Text such as ``1.1156E+4`` or ``2.5`` to an integer by rounding, not truncating."""
    rounded = F.round(to_decimal(c, 38, 10, strict), 0)
    return rounded.cast(kind) if strict else rounded.try_cast(kind)


def half_up(c: Column | str, digits: int) -> Column:
    """Round a decimal half away from zero."""
    return F.round(col(c), digits)


def half_up_double(c: Column | str, digits: int) -> Column:
    """Round a double by its decimal reading (1.005 -> 1.01)."""
    return F.round(col(c).cast("decimal(38,15)"), digits)


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, NULL where the denominator is zero."""
    return numerator / F.nullif(denominator, F.lit(0))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """Rounded percentage of two counts."""
    hundred = F.lit(100).cast("decimal(3,0)")
    return half_up(ratio(hundred * part.cast(COUNT), whole.cast(COUNT)), digits)


def thousands(c: Column | str) -> Column:
    """``1234567.8`` -> ``1,234,568``."""
    return F.format_number(F.round(col(c), 0), 0)


# --- aggregate expressions -------------------------------------------------


def only(value: Column | str, where: Column | None) -> Column:
    """The value on rows where the condition is true, NULL elsewhere."""
    return col(value) if where is None else F.when(where, col(value))


def total(value: Column | str, where: Column | None = None) -> Column:
    return F.sum(only(value, where))


def mean(value: Column | str, where: Column | None = None) -> Column:
    """Exact average of a value with up to four decimals: sum over count."""
    kept = only(value, where)
    return ratio(F.sum(kept.cast("decimal(18,4)")), F.count(kept).cast(COUNT))


def ratio_of_sums(value: Column | str, where: Column) -> Column:
    """Period-weighted mean: the whole sum over the number of rows that count."""
    return ratio(F.sum(col(value)), F.count_if(where).cast(COUNT))


def weighted_mean(value: Column | str, weight: Column | str) -> Column:
    weights = col(weight).cast(COUNT)
    return ratio(F.sum(col(value).cast("decimal(12,4)") * weights), F.sum(weights))


def pearson(x: Column | str, y: Column | str) -> Column:
    """Correlation; NULL when either side has no variance."""
    a = F.when(col(y).isNotNull(), col(x).cast("double"))
    b = F.when(col(x).isNotNull(), col(y).cast("double"))
    return ratio(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def small_median(value: Column | str, where: Column | None = None) -> Column:
    """Interpolated median inside one aggregate.

    Spark keeps one counter per distinct value of the group in memory, so this
    suits groups with few distinct values; ``operators.aggregates.exact_median``
    has no such limit.
    """
    return F.median(only(value, where).cast("double"))
