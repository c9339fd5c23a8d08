"""Window-style operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.functions.dates import previous_month
from tidemark.functions.numbers import half_up, ratio
from tidemark.operators.joins import null_safe_join, salted_join

# digits resolved per step when values are placed on a scale
STEP = 6


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    hot: Sequence | None = None,
    by: Sequence[str] | None = None,
) -> DataFrame:
    """First row per key in the given order.

    ``row_number() = 1`` lets Spark drop all but one row per key and task before
    the shuffle, so a key that fills a third of the table costs no more than any.

    That takes a sort of each task's rows, which is lost work where most keys have one row.
    ``hot`` are the values of the first key that have many rows: only their rows, and those
    without a first key, are then reduced before the shuffle; all others are sorted
    once, after it. ``by`` are the keys to shuffle on, by default all.
    """
    if hot is not None:
        many = F.col(keys[0]).isNull()
        if hot:
            many = many | F.col(keys[0]).isin(list(hot))
        few = latest_per_key(df.filter(many), keys, order)
        df = df.filter(~many).unionByName(few).repartition(*(by or keys))
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(window)).filter("_row = 1").drop("_row")


def group_rank(
    df: DataFrame, column: str, name: str, descending: bool = False, ties: str = "min"
) -> DataFrame:
    """Rank a result already aggregated to a bounded number of groups.

    One task sees all groups; use :func:`global_rank` on tables that grow.
    """
    value = F.col(column)
    order = Window.orderBy(value.desc_nulls_last() if descending else value.asc_nulls_last())
    rank = F.rank().over(order)
    if ties == "average":
        rank = rank + (F.count("*").over(Window.partitionBy(column)) - 1) / 2
    return df.withColumn(name, rank)


def keep_rank(df: DataFrame, rank_col: str, n: int) -> DataFrame:
    return df.filter(F.col(rank_col) <= n)


def version_number(df: DataFrame, key: str, order: str, name: str = "version_num") -> DataFrame:
    window = Window.partitionBy(key).orderBy(F.col(order).asc_nulls_last())
    return df.withColumn(name, F.row_number().over(window))


def lag_by(
    df: DataFrame, keys: Sequence[str], order: str, columns: Mapping[str, str]
) -> DataFrame:
    """Previous values within a group: ``columns`` maps new name to source."""
    window = Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_last())
    return df.withColumns({new: F.lag(old).over(window) for new, old in columns.items()})


def pct_change(
    df: DataFrame,
    keys: Sequence[str],
    period: str,
    measures: Mapping[str, str],
    digits: int = 2,
) -> DataFrame:
    """Percentage change against the month before; ``measures`` maps new name to source.

    NULL when the previous row is not exactly one month earlier or is zero. A
    group holds one row per period here, so its window is small.
    """
    before = {f"_prev_{i}": old for i, old in enumerate(measures.values())}
    lagged = lag_by(df, keys, period, {"_prev_period": period, **before})
    adjacent = F.col("_prev_period") == previous_month(period)
    hundred = F.lit(100).cast("decimal(3,0)")
    changes = {}
    for (new, old), prev in zip(measures.items(), before):
        step = hundred * (F.col(old) - F.col(prev)).cast("decimal(20,0)")
        change = ratio(step, F.col(prev).cast("decimal(20,0)"))
        changes[new] = F.when(adjacent, half_up(change, digits))
    return lagged.withColumns(changes).drop("_prev_period", *before)


def top_k_per_group(
    df: DataFrame, group: Sequence[str], by: Column, k: int, rank_col: str = "rank"
) -> DataFrame:
    """Rows with rank <= k in their group, ties kept; limited per task before the shuffle."""
    window = Window.partitionBy(*group).orderBy(by)
    return df.withColumn(rank_col, F.rank().over(window)).filter(F.col(rank_col) <= k)


def group_spread(df: DataFrame, group: Sequence[str], column: str, name: str) -> DataFrame:
    """:func:`spread` of a result already aggregated, by a window that shares the shuffle of
    other windows over the same groups."""
    whole = Window.partitionBy(*group)
    return df.withColumn(name, F.max(column).over(whole) - F.min(column).over(whole))


def spread(df: DataFrame, group: Sequence[str], column: str, name: str) -> DataFrame:
    """Add ``max - min`` of the group to each of its rows, from a pre-aggregated table."""
    gap = df.groupBy(*group).agg((F.max(column) - F.min(column)).alias(name))
    return null_safe_join(df, gap, group)


def share_of_total(df: DataFrame, columns: Mapping[str, str], digits: int = 1) -> DataFrame:
    """Percentage of the grand total; ``columns`` maps new name to source.

    The total is one broadcast row instead of a window over everything.
    """
    totals = df.agg(*[F.sum(old).alias(f"_all_{new}") for new, old in columns.items()])
    hundred = F.lit(100).cast("decimal(3,0)")
    shares = {
        new: half_up(
            ratio(
                hundred * F.col(old).cast("decimal(20,0)"),
                F.col(f"_all_{new}").cast("decimal(20,0)"),
            ),
            digits,
        )
        for new, old in columns.items()
    }
    added = df.crossJoin(F.broadcast(totals)).withColumns(shares)
    return added.drop(*[f"_all_{new}" for new in columns])


def scaled_units(df: DataFrame, column: str) -> tuple[Column, int, int]:
    """The column as a whole number of its smallest unit, its precision and scale."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        units = (F.col(column) * F.lit(10**kind.scale).cast("decimal(19,0)")).cast("bigint")
        return units, kind.precision, kind.scale
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return F.col(column).cast("bigint"), 10, 0
    if isinstance(kind, T.LongType):
        return F.col(column), 18, 0
    raise TypeError(f"{column}: cast {kind.simpleString()} to a decimal of at most 18 digits")


def cells(units: Column, precision: int) -> list[Column]:
    """Coarse to exact positions of a value, ``STEP`` digits at a time."""
    positions = []
    for digits in range(STEP * ((precision - 1) // STEP), 0, -STEP):
        width = F.lit(10**digits).cast("bigint")
        positions.append(F.call_function("div", units - F.pmod(units, width), width))
    return [*positions, units]


def global_rank(
    df: DataFrame,
    column: str,
    name: str = "rank",
    descending: bool = False,
    ties: str = "min",
    hot: Sequence = (),
) -> DataFrame:
    """Rank over all rows without sorting them in one task.

    Equal values are counted first and ranked by :func:`value_ranks`, so the rows themselves
    are only joined to the rank of their value. ``ties`` is ``min`` (SQL rank) or ``average``.
    NULL gets no rank.
    """
    units, precision, _ = scaled_units(df, column)
    units = -units if descending else units
    valued = df.withColumn("_units", units)
    single = valued.filter("_units IS NOT NULL").select("_units", F.lit(1).alias("_n"))
    ranks = value_ranks(single, precision, name, ties).select("_value", name)
    return salted_join(valued, ranks, "_units", "_value", "left", hot=hot).drop("_units")


def value_ranks(
    counts: DataFrame, precision: int, name: str = "rank", ties: str = "min"
) -> DataFrame:
    """(_value, _n, rank) of values ``counts`` (_units, _n) of ``precision`` digits, summed here.

    The sums are placed on a scale of 10**6-wide cells, and each window runs over cells or
    over the values of one cell, which bounds it by 10**6 rows whatever the table's size.
    """
    levels = cells(F.col("_own"), precision)
    names = [f"_cell_{i}" for i in range(len(levels) - 1)] + ["_value"]
    # cells of an aggregated column: what the joins below imply of a cell then stays above
    # the sums, so that all branches share the shuffle of one and the same plan
    summed = counts.groupBy("_units").agg(F.sum("_n").alias("_n"), F.min("_units").alias("_own"))
    placed = summed.select(*[c.alias(n) for c, n in zip(levels, names)], "_n")
    ranked = placed.withColumn("_below", F.lit(0).cast("bigint"))
    for depth in range(1, len(names)):
        path = names[:depth]
        sizes = placed.groupBy(*path).agg(F.sum("_n").alias("_size"))
        window = Window.partitionBy(*path[:-1]).orderBy(path[-1])
        before = sizes.withColumn("_before", F.sum("_size").over(window) - F.col("_size"))
        ranked = (
            ranked.join(before.drop("_size"), path)
            .withColumn("_below", F.col("_below") + F.col("_before"))
            .drop("_before")
        )
    window = Window.partitionBy(*names[:-1]).orderBy("_value")
    below = F.col("_below") + F.sum("_n").over(window) - F.col("_n")
    if ties == "min":
        rank = below + 1
    else:
        rank = (below.cast("double") + (F.col("_n") + 1) / 2).cast("double")
    return ranked.select("_value", "_n", rank.alias(name))
