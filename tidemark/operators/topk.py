"""Top-k selections without a global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def top_k(df: DataFrame, by: Column, k: int, tiebreak: Sequence[Column] = ()) -> DataFrame:
    """The first k rows; every task keeps k rows before they are merged."""
    return df.orderBy(by, *tiebreak).limit(k)


def top_bottom(
    df: DataFrame, metric: str, n: int = 3, labels: tuple[str, str] | None = None
) -> DataFrame:
    """The n best and n worst rows by ``metric``, ties kept, tagged ``revenue_group``.

    A row ranks within n exactly when its value reaches the n-th value, so two
    n-row limits replace two ranks over the whole table. A row in both tails is
    tagged as top. Rows without a metric are left out.
    """
    top_label, bottom_label = labels or (f"Top {n}", f"Bottom {n}")
    valued = df.filter(F.col(metric).isNotNull())
    best = valued.select(metric).orderBy(F.col(metric).desc()).limit(n)
    worst = valued.select(metric).orderBy(F.col(metric).asc()).limit(n)
    edges = best.agg(F.min(metric).alias("_low_top")).crossJoin(
        F.broadcast(worst.agg(F.max(metric).alias("_high_bottom")))
    )
    in_top = F.col(metric) >= F.col("_low_top")
    return (
        valued.crossJoin(F.broadcast(edges))
        .filter(in_top | (F.col(metric) <= F.col("_high_bottom")))
        .withColumn("revenue_group", F.when(in_top, top_label).otherwise(bottom_label))
        .drop("_low_top", "_high_bottom")
    )
