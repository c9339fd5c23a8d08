"""Aggregations beyond one ``groupBy().agg()``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.numbers import mean, percent
from tidemark.operators.windows import cells, scaled_units


def having(
    df: DataFrame, keys: Sequence[str], aggs: Sequence[Column], predicate: Column | str
) -> DataFrame:
    return df.groupBy(*keys).agg(*aggs).filter(predicate)


def two_level(
    df: DataFrame,
    inner_keys: Sequence[str],
    inner: Sequence[Column],
    outer_keys: Sequence[str],
    outer: Sequence[Column],
) -> DataFrame:
    """Aggregate per entity, then aggregate the entities."""
    return df.groupBy(*inner_keys).agg(*inner).groupBy(*outer_keys).agg(*outer)


def distinct_count(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """Distinct values per group by two plain aggregations, so a hot group is
    first reduced on (keys, value) in many tasks."""
    pairs = df.filter(F.col(column).isNotNull()).select(*keys, column).distinct()
    return pairs.groupBy(*keys).agg(F.count("*").alias(name))


def with_total(
    df: DataFrame,
    keys: Sequence[str],
    aggs: Sequence[Column],
    label: str,
    marker: str = "is_total",
) -> DataFrame:
    """Group rows plus one total row, both from one pass over the input.

    The first key of the total row holds ``label``; ``marker`` (0 or 1) sorts it last.
    """
    first = keys[0]
    rows = df.groupingSets([[F.col(k) for k in keys], []], *keys).agg(
        F.when(F.grouping_id() > 0, 1).otherwise(0).alias(marker), *aggs
    )
    return rows.withColumn(
        first, F.when(F.col(marker) == 1, F.lit(label)).otherwise(F.col(first))
    )


def composition(df: DataFrame, bands: Sequence[str], digits: int = 1) -> DataFrame:
    """Each band as a percentage of the sum of all bands, as ``pct_<band>``."""
    whole = F.lit(0)
    for band in bands:
        whole = whole + F.col(band)
    return df.withColumns({f"pct_{b}": percent(F.col(b), whole, digits) for b in bands})


def bucketize(
    column: Column | str, bounds: Sequence[int], labels: Sequence[str]
) -> tuple[Column, Column]:
    """Label and sort position of the first bucket whose upper bound holds the value."""
    value = F.col(column) if isinstance(column, str) else column
    label, order = None, None
    for i, (bound, text) in enumerate(zip(bounds, labels)):
        fits = value <= bound
        label = F.when(fits, text) if label is None else label.when(fits, text)
        order = F.when(fits, i + 1) if order is None else order.when(fits, i + 1)
    return label.otherwise(labels[-1]), order.otherwise(len(labels))


def mean_of_means(
    df: DataFrame, keys: Sequence[str], period: str, value: Column, name: str
) -> DataFrame:
    """Mean per period first, then the plain mean of the periods."""
    return two_level(df, [*keys, period], [value.alias("_period_mean")], keys, [
        mean("_period_mean").alias(name)
    ])


def exact_median(
    df: DataFrame, keys: Sequence[str], column: str, name: str, weight: str | None = None
) -> DataFrame:
    """Interpolated median per group, exact, without holding a group in one task.

    ``weight`` names a column that says how often a row's value counts. Equal values are
    counted first (partial counts before the shuffle, spread by key *and* value). The middle
    positions are then followed down a scale of 10**6-wide cells: each window runs over the
    cells of a group, or the values inside its one or two middle cells, never over the
    group's rows.
    """
    units, precision, scale = scaled_units(df, column)
    keys = list(keys)
    often = F.count("*") if weight is None else F.sum("_weight")
    counts = (
        df.select(*keys, units.alias("_units"), *([F.col(weight).alias("_weight")] if weight else []))
        .groupBy(*keys, "_units")
        # rows without a value go after the count: a filter on the key would be pushed down
        # to the scan, which then differs from that of a caller's other branches
        .agg(often.alias("_n"), F.count("_units").alias("_known"))
        .filter("_known > 0")
        .drop("_known")
    )
    levels = cells(F.col("_units"), precision)
    names = [f"_cell_{i}" for i in range(len(levels))]
    counts = counts.select(*keys, *[c.alias(n) for c, n in zip(levels, names)], "_n")
    low, high, before = F.col("_low"), F.col("_high"), F.col("_before")
    found = None
    for depth, cell in enumerate(names, start=1):
        path = names[: depth - 1]
        group = Window.partitionBy(*keys, *path)
        rows = counts
        ends = []
        if found is not None:
            # rows and wanted positions meet in one shuffle, NULL keys included
            rows = rows.unionByName(found, allowMissingColumns=True)
            rows = rows.withColumns({c: F.max(c).over(group) for c in ("_low", "_high")})
            rows = rows.filter("coalesce(_low, _high) IS NOT NULL AND _n IS NOT NULL")
            ends = [F.max(c).alias(c) for c in ("_low", "_high")]
        if depth < len(names):
            rows = rows.groupBy(*keys, *path, cell).agg(F.sum("_n").alias("_n"), *ends)
        if found is None:
            size = F.sum("_n").over(group)
            rows = rows.withColumns(
                {
                    "_low": F.floor((size - 1) / 2).cast("bigint"),
                    "_high": F.floor(size / 2).cast("bigint"),
                }
            )
        rows = rows.withColumn("_before", F.sum("_n").over(group.orderBy(cell)) - F.col("_n"))
        after = before + F.col("_n")
        found = rows.select(
            *keys,
            *path,
            cell,
            F.when((low >= before) & (low < after), low - before).alias("_low"),
            F.when((high >= before) & (high < after), high - before).alias("_high"),
        ).filter("coalesce(_low, _high) IS NOT NULL")
    value = F.col(names[-1])
    middle = F.sum(F.when(low.isNotNull(), value)) + F.sum(F.when(high.isNotNull(), value))
    median = (middle.cast("decimal(20,0)") / F.lit(2 * 10**scale).cast("decimal(19,0)")).cast(
        f"decimal(20,{scale + 1})"
    )
    return found.groupBy(*keys).agg(median.alias(name))
