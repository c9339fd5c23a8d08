"""Facts meet the versions of their keys on one timeline.

The versions of a key do not overlap, so the version that is valid at a date is the last one
that started, if it has not ended. Facts and version starts are therefore put side by side,
sorted once per key, and every fact row takes the last start before it: the rows on the way are those of
the facts plus those of the versions, however many versions a key has. Counting versions works
the same way on starts and ends, where versions may overlap.

A hot key would be one long timeline. It is cut into slices of its dates, each of which takes
over the versions that are still valid at its first date, and a date with many rows is dealt
to several copies of its slice (see :func:`date_slices`).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

from tidemark.functions.text import col
from tidemark.operators.joins import heavy_keys, partitions, salted_join, salts_of

# key -> (first date, copies) of each of its slices, in order; or just the keys
Slices = Mapping[Any, Sequence[tuple[Any, int]]]
Hot = Slices | Sequence


def _up_to_now(*keys: str) -> WindowSpec:
    order = Window.partitionBy(*keys, "_key", "_place").orderBy("_at", "_kind")
    return order.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def date_slices(df: DataFrame, key: Column | str, at: str) -> Slices:
    """The hot keys of ``df`` with slices of about one shuffle partition's rows.

    Only counts per hot key and date are computed, and what comes to the driver has at most two
    entries per shuffle partition and one per hot key.
    """
    hot = heavy_keys(df, key)
    if not hot:
        return {}
    share = df.count() / partitions(df)
    rows = df.select(col(key).alias("k"), F.col(at).alias("at")).filter(F.col("k").isin(hot))
    dated = rows.filter(F.col("at").isNotNull()).groupBy("k", "at").agg(F.count("*").alias("n"))
    so_far = Window.partitionBy("k").orderBy("at")
    before = F.sum("n").over(so_far) - F.col("n")
    sliced = dated.withColumn("slice", F.floor(before / share)).groupBy("k", "slice").agg(
        F.min("at").alias("start"),
        F.greatest(F.lit(1), F.floor(F.sum("n") / share)).cast("int").alias("copies"),
    )
    found: dict = {k: [] for k in hot}
    for r in sliced.orderBy("k", "slice").collect():
        found[r["k"]].append((r["start"], r["copies"]))
    return {k: tuple(v) for k, v in found.items()}


def pit_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str | tuple[Column | str, str],
    at: str = "month_date",
    how: str = "inner",
    hot: Hot = (),
    overlapping: bool = False,
    apart: bool = False,
) -> DataFrame:
    """Join each fact row to the version valid at its date: ``valid_from <= at < valid_to``.

    ``on`` is a shared column, or a pair of a left expression and a right column. ``hot`` has the
    left keys to spread: the result of :func:`date_slices`, or keys alone. The versions
    of a key must not overlap. Where nothing rules that out, as with versions of several
    entities under one name, ``overlapping`` asks for an equi join with the interval as residual
    condition, which gives a row per valid version; it suits tables of few versions. ``apart`` as
    in :func:`timeline`.
    """
    left_key, right_key = (on, on) if isinstance(on, str) else on
    names = [c for c in dim.columns if c not in (right_key, "valid_from", "valid_to")]
    if overlapping:
        return _interval_join(fact, dim, left_key, right_key, names, at, how, hot)
    line = timeline(fact, dim, on, at, how, hot, apart)
    version = F.last("_version", ignorenulls=True).over(_up_to_now())
    met = line.withColumn("_version", version).filter("_kind = 1")
    valid = F.col("_at") < F.col("_version._to")
    if how == "inner":
        met = met.filter(valid)
        found = [F.col(f"_version.{c}").alias(c) for c in names]
    else:
        found = [F.when(valid, F.col(f"_version.{c}")).alias(c) for c in names]
    own = [F.col("_key").alias(c) if c == on else F.col(c) for c in fact.columns]
    return met.select(*own, *found)


def timeline(
    fact: DataFrame,
    dim: DataFrame,
    on: str | tuple[Column | str, str],
    at: str = "month_date",
    how: str = "inner",
    hot: Hot = (),
    apart: bool = False,
) -> DataFrame:
    """Facts (``_kind`` 1) and version starts (``_kind`` 0) of each key, in places (_key, _place).

    A version is a row of the slices it is valid in, so only those of hot keys are repeated.
    Versions that are never valid are left out, as are facts without a key in an inner join.
    A shared key column is ``_key`` alone, so that two tables with equal buckets on it
    stay in their buckets and need no shuffle.

    ``apart`` sends facts and versions to their key one by one, in an inner join on a shared column
    without hot keys. Versions that a window over the key has just made then stay where they are,
    and so does what is grouped by the key after the join. It is not for tables in buckets.
    """
    left_key, right_key = (on, on) if isinstance(on, str) else on
    names = [c for c in dim.columns if c not in (right_key, "valid_from", "valid_to")]
    versions = dim.filter("valid_from < valid_to").select(
        F.col(right_key).alias("_key"),
        F.col("valid_from").alias("_at"),
        F.lit(0).alias("_kind"),
        F.struct(F.col("valid_to").alias("_to"), *names).alias("_version"),
    )
    facts = fact.withColumns({"_key": col(left_key), "_at": F.col(at), "_kind": F.lit(1)})
    if isinstance(on, str):
        facts = facts.drop(on)
    kinds = {df.schema["_at"].dataType for df in (facts, versions)}
    if len(kinds) > 1:
        facts, versions = (df.withColumn("_at", F.col("_at").cast(T.TimestampType())) for df in (facts, versions))
    if how == "inner":
        facts = facts.filter("_key IS NOT NULL")
    versions = versions.filter("_key IS NOT NULL")
    if apart and how == "inner" and isinstance(on, str) and not hot:
        # Spark leaves out the second of two equal shuffles
        sent = (df.withColumn("_place", F.lit(0)).repartition("_key") for df in (facts, versions))
        facts, versions = sent
        return facts.unionByName(versions, allowMissingColumns=True)
    facts = _placed_facts(facts, hot)
    versions = _placed_versions(versions, F.col("_at"), F.col("_version._to"), hot)
    line = facts.unionByName(versions, allowMissingColumns=True)
    # buckets would hold a hot key together
    return line.repartition("_key", "_place") if hot else line


def count_versions(
    fact: DataFrame,
    dims: Mapping[str, tuple[DataFrame, str]],
    rows: Sequence[str],
    at: str,
    hot: Mapping[str, Hot] = {},
    apart: bool = False,
) -> DataFrame:
    """(dimension, *rows, nb_versions): versions valid for the fact rows of each ``rows`` key.

    A running sum of starts minus ends over the timeline of each key, for all
    dimensions in one pass over the facts. Versions may overlap or leave gaps. ``apart`` as in
    :func:`timeline`: the facts are then sent to each dimension's versions, where these are not hot.
    """
    kinds = {df.schema[on].dataType for dim, on in dims.values() for df in (fact, dim)}
    # whole numbers of one type stay as they are, and dimensions are numbered: rows to sort are short
    text = len(kinds) > 1 or not isinstance(next(iter(kinds)), (T.IntegerType, T.LongType))

    def key_of(on: str) -> Column:
        return (F.col(on).cast("string") if text else F.col(on)).alias("_key")

    keyed = F.explode(
        F.array(*[
            F.struct(F.lit(i).alias("_dimension"), key_of(on))
            for i, (_, on) in enumerate(dims.values())
        ])
    )
    facts = fact.select(*dict.fromkeys(rows), F.col(at).alias("_at"), keyed.alias("_k")).select(
        *dict.fromkeys(rows), "_at", F.col("_k._dimension"), F.col("_k._key"), F.lit(1).alias("_kind")
    )
    valid = F.coalesce(F.sum("_step").over(_up_to_now("_dimension")), F.lit(0))
    lines = None
    for i, (name, (dim, on)) in enumerate(dims.items()):
        slices = _as_text(hot.get(name, ())) if text else hot.get(name, ())
        own = facts.filter(F.col("_dimension") == i)
        versions = dim.filter("valid_from < valid_to").select(
            F.lit(i).alias("_dimension"),
            key_of(on),
            F.lit(0).alias("_kind"),
            "valid_from",
            "valid_to",
        ).filter("_key IS NOT NULL")
        keyless = None
        if apart and not slices:
            keyless = own.filter("_key IS NULL").withColumn("_valid", F.lit(0).cast("bigint"))
            own, versions = (
                df.withColumn("_place", F.lit(0)).repartition("_key")
                for df in (own.filter("_key IS NOT NULL"), versions)
            )
        else:
            own = _placed_facts(own, slices)
            versions = _placed_versions(versions, F.col("valid_from"), F.col("valid_to"), slices)
        both = F.array(
            F.struct(F.col("valid_from").alias("_at"), F.lit(1).alias("_step")),
            F.struct(F.col("valid_to").alias("_at"), F.lit(-1).alias("_step")),
        )
        steps = versions.select("_dimension", "_key", "_place", "_kind", F.inline(both))
        line = own.unionByName(steps, allowMissingColumns=True)
        if apart:
            line = line.withColumn("_valid", valid)
        if keyless is not None:
            line = line.unionByName(keyless, allowMissingColumns=True)
        lines = line if lines is None else lines.unionByName(line)
    counted = (lines if apart else lines.withColumn("_valid", valid)).filter("_kind = 1")
    # a fact without a date meets no version
    counted = counted.withColumn("_valid", F.when(F.col("_at").isNull(), 0).otherwise(F.col("_valid")))
    summed = counted.groupBy("_dimension", *rows).agg(F.sum("_valid").alias("nb_versions"))
    name = F.get(F.array(*[F.lit(n) for n in dims]), F.col("_dimension"))
    return summed.select(name.alias("dimension"), *dict.fromkeys(rows), "nb_versions")


def _as_text(hot: Hot) -> Hot:
    if isinstance(hot, Mapping):
        return {str(k): v for k, v in hot.items()}
    return [str(k) for k in hot]


def _cuts(df: DataFrame, hot: Hot) -> DataFrame | None:
    """(_hot_key, _cuts): the slices of each hot key; as many rows as there are hot keys."""
    salts = salts_of(df)
    listed = hot if isinstance(hot, Mapping) else dict.fromkeys(hot, ())
    rows = []
    for key, slices in listed.items():
        slices = slices or ((None, salts),)
        place, cuts = 0, []
        for i, (start, copies) in enumerate(slices):
            until = slices[i + 1][0] if i + 1 < len(slices) else None
            cuts.append((start if i else None, until, place, copies))
            place += copies
        rows.append((key, cuts))
    kind, at = df.schema["_key"].dataType, df.schema["_at" if "_at" in df.columns else "valid_from"].dataType
    cut = T.StructType(
        [T.StructField("start", at), T.StructField("until", at),
         T.StructField("first", T.IntegerType()), T.StructField("copies", T.IntegerType())]
    )
    schema = T.StructType([T.StructField("_hot_key", kind), T.StructField("_cuts", T.ArrayType(cut))])
    return df.sparkSession.createDataFrame(rows, schema)


def _placed_facts(facts: DataFrame, hot: Hot) -> DataFrame:
    """``facts`` with ``_place``; rows without a key are spread."""
    deal = F.xxhash64(F.spark_partition_id(), *facts.columns)
    keyless = F.pmod(deal, F.lit(salts_of(facts))).cast("int")
    place = F.when(F.col("_key").isNull(), keyless).otherwise(0)
    if not hot:
        return facts.withColumn("_place", place)
    # bounded by the number of hot keys and shuffle partitions
    found = facts.join(F.broadcast(_cuts(facts, hot)), F.col("_key") == F.col("_hot_key"), "left")
    begun = F.filter("_cuts", lambda c: c["start"].isNull() | (c["start"] <= F.col("_at")))
    own = F.element_at(begun, -1)
    dealt = own["first"] + F.pmod(deal, own["copies"]).cast("int")
    place = F.when(F.col("_cuts").isNotNull(), dealt).otherwise(place)
    return found.withColumn("_place", place).drop("_hot_key", "_cuts")


def _placed_versions(versions: DataFrame, start: Column, end: Column, hot: Hot) -> DataFrame:
    """``versions`` with ``_place``, a row for each place of the slices they are valid in."""
    if not hot:
        return versions.withColumn("_place", F.lit(0))
    found = versions.join(F.broadcast(_cuts(versions, hot)), F.col("_key") == F.col("_hot_key"), "left")
    met = F.filter(
        "_cuts",
        lambda c: (c["until"].isNull() | (start < c["until"]))
        & (c["start"].isNull() | (end > c["start"])),
    )
    places = F.flatten(
        F.transform(met, lambda c: F.sequence(c["first"], c["first"] + c["copies"] - 1))
    )
    where = F.when(F.col("_cuts").isNotNull(), places).otherwise(F.array(F.lit(0)))
    return found.withColumn("_place", F.explode(where)).drop("_hot_key", "_cuts")


def _interval_join(
    fact: DataFrame,
    dim: DataFrame,
    left_key: Column | str,
    right_key: str,
    names: Iterable[str],
    at: str,
    how: str,
    hot: Hot,
) -> DataFrame:
    versions = dim.select(
        F.col(right_key).alias("_key"),
        F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"),
        *names,
    )
    valid = (F.col(at) >= F.col("_from")) & (F.col(at) < F.col("_to"))
    keyed = fact.withColumn("_left_key", col(left_key))
    joined = salted_join(keyed, versions, "_left_key", "_key", how, valid, list(hot))
    return joined.drop("_left_key", "_from", "_to")
