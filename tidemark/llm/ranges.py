"""Contiguous ranges of ids, balanced by their distribution."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import keep

# even cells of the whole id range; the number of ranges is at most twice that
CELLS = 4096
# ids in a range, at least, before a cell is cut
LEAST = 1000


def id_ranges(ids: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A function that gives rows with a doc_id the columns ``cell`` and ``part``.

    (cell, part) grows with the id. The range of all ids is cut into even cells, one for
    LEAST ids and CELLS at most, and a cell with more than its share of the ids into even
    parts between its own smallest and largest id. Both lookup tables are bounded by CELLS
    and therefore broadcast. Rows without an id get null in both columns.
    """
    count = F.count(F.lit(1))
    ends = ids.agg(
        F.min("doc_id").alias("lo"),
        F.max("doc_id").alias("hi"),
        count.alias("n"),
        F.least(F.floor(count / LEAST) + 1, F.lit(CELLS)).cast("int").alias("cells"),
    )

    def offset(value: str, low: str) -> Column:
        # of two 64-bit numbers, without overflow
        return F.col(value).cast("decimal(20,0)") - F.col(low).cast("decimal(20,0)")

    def share(value: str, low: str, high: str, parts: Column) -> Column:
        width = offset(high, low).cast("double") + 1
        return F.floor(offset(value, low).cast("double") * parts / width).cast("int")

    def within(place: Column, parts: Column) -> Column:
        # least() passes over nulls
        return F.when(F.col("doc_id").isNotNull(), F.least(place, parts - 1))

    def cell() -> Column:
        return within(share("doc_id", "lo", "hi", F.col("cells")), F.col("cells"))

    fair = F.greatest(F.first("n") / F.first("cells"), F.lit(LEAST))
    cells = keep(
        ids.crossJoin(F.broadcast(ends))
        .withColumn("cell", cell())
        .groupBy("cell")
        .agg(
            F.min("doc_id").alias("a"),
            F.max("doc_id").alias("b"),
            F.ceil(F.count(F.lit(1)) / fair).cast("int").alias("parts"),
        ),
        "id-cells",
    )
    part = within(share("doc_id", "a", "b", F.col("parts")), F.col("parts"))

    def place(rows: DataFrame) -> DataFrame:
        return (
            rows.join(F.broadcast(ends), F.lit(True), "left")
            .withColumn("cell", cell())
            .drop("lo", "hi", "n", "cells")
            .join(F.broadcast(cells), "cell", "left")
            .withColumn("part", part)
            .drop("a", "b", "parts")
        )

    return place
