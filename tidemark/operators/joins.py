"""Equi joins of several kinds, and help against hot keys."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import col, join_key

# keys that are found hot, at most, and counters of the sketch that finds them
HOT_KEYS = 1024
COUNTERS = 65_536


def heavy_keys(df: DataFrame, key: Column | str, share: float | None = None) -> list:
    """Keys that hold at least ``share`` of the rows (one pass, constant-size result).

    The default share is that of one shuffle partition, but not below one in HOT_KEYS. The
    frequent-items sketch keeps many times as many counters, so no key above the
    share is missed. The answer only decides which keys are spread over several
    tasks, never which rows are kept.
    """
    if share is None:
        share = max(1 / partitions(df), 1 / HOT_KEYS)
    keys = df.select(col(key).alias("k")).filter(F.col("k").isNotNull())
    row = keys.agg(
        F.expr(f"approx_top_k(k, {HOT_KEYS}, {COUNTERS})").alias("top"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    return [item["item"] for item in row["top"] or [] if item["count"] >= share * row["n"]]


def partitions(df: DataFrame) -> int:
    """The number of shuffle partitions of the session."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def salts_of(df: DataFrame) -> int:
    """Enough for a key with a third of all rows to come down to one partition's share."""
    return max(8, -(-partitions(df) // 3))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "inner",
    residual: Column | None = None,
    hot: Sequence = (),
    salts: int | None = None,
) -> DataFrame:
    """Equi join that spreads hot keys of the left side over ``salts`` tasks.

    Only rows of hot keys get a salt, and only the right rows of those keys are
    repeated, so the right side grows by at most ``len(hot) * salts`` keys. The
    salt is a hash of the row and of the task that reads it: equal rows of different
    tasks are spread, and a task that is retried deals the same salts. In a left or anti
    join the rows without a key are spread as well. By default a third of the shuffle
    partitions take part. ``right_key`` is dropped.
    """
    salts = salts or salts_of(left)
    nulls = F.col(left_key).isNull()
    spread = None
    if hot:
        spread = F.col(left_key).isin(list(hot))
    if how in ("left", "left_anti"):
        spread = nulls if spread is None else spread | nulls
    on = F.col(left_key) == F.col(right_key)
    if spread is not None:
        pick = F.pmod(F.xxhash64(F.spark_partition_id(), *left.columns), F.lit(salts)).cast("int")
        left = left.withColumn("_salt", F.when(spread, pick).otherwise(0))
        if hot:
            copies = F.when(
                F.col(right_key).isin(list(hot)), F.sequence(F.lit(0), F.lit(salts - 1))
            ).otherwise(F.array(F.lit(0)))
            right = right.withColumn("_copy", F.explode(copies))
        else:
            # not a literal, which the optimizer would fold out of the join key
            right = right.withColumn("_copy", F.when(F.col(right_key).isNull(), 1).otherwise(0))
        on = on & (F.col("_salt") == F.col("_copy"))
    if residual is not None:
        on = on & residual
    return left.join(right, on, how).drop(right_key, "_salt", "_copy")


def current_join(
    df: DataFrame,
    dim: DataFrame,
    on: str | tuple[Column | str, str],
    how: str = "inner",
    hot: Sequence = (),
) -> DataFrame:
    """Join to the current version only; the filter runs before the join."""
    left_key, right_key = (on, on) if isinstance(on, str) else on
    attributes = [
        c for c in dim.columns if c not in (right_key, "valid_from", "valid_to", "is_current")
    ]
    current = dim.filter("is_current").select(F.col(right_key).alias("_key"), *attributes)
    keyed = df.withColumn("_left_key", col(left_key))
    return salted_join(keyed, current, "_left_key", "_key", how, hot=hot).drop("_left_key")


def name_join(
    df: DataFrame,
    other: DataFrame,
    left_col: str,
    key_col: str,
    how: str = "inner",
    hot: Sequence = (),
) -> DataFrame:
    """Join a display name to a table keyed by the trimmed upper-case name."""
    named = df.withColumn("_name", join_key(left_col))
    keyed = other.withColumnRenamed(key_col, "_key")
    return salted_join(named, keyed, "_name", "_key", how, hot=hot).drop("_name")


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Iterable[str], how: str = "inner"
) -> DataFrame:
    """Join two aggregates on their group keys, where NULL is a group like any other."""
    keys = list(keys)
    if not keys:
        # both sides hold one row: a total next to another total
        return left.crossJoin(F.broadcast(right))
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    on = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        on = same if on is None else on & same
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def unmatched(
    df: DataFrame, other: DataFrame, on: tuple[Column | str, str], hot: Sequence = ()
) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``."""
    left_key, right_key = on
    # each key once: a hot key of the list would otherwise meet in one task
    keys = other.select(F.col(right_key).alias("_key")).distinct()
    keyed = df.withColumn("_left_key", col(left_key))
    lost = salted_join(keyed, keys, "_left_key", "_key", "left_anti", hot=hot)
    return lost.drop("_left_key")


def not_in(
    df: DataFrame, column: str, other: DataFrame, other_column: str, hot: Sequence = ()
) -> DataFrame:
    """SQL ``NOT IN``: one NULL in the list rejects every row, an empty list none.

    Written as an ordinary anti join plus two facts about the list, because the
    built-in null-aware anti join always broadcasts the list.
    """
    listed = other.select(F.col(other_column).alias("_listed"))
    facts = listed.agg(
        F.count(F.lit(1)).alias("_size"), F.count_if(F.col("_listed").isNull()).alias("_nulls")
    )
    missing = salted_join(df, listed.distinct(), column, "_listed", "left_anti", hot=hot)
    keep = (F.col("_size") == 0) | ((F.col("_nulls") == 0) & F.col(column).isNotNull())
    return missing.crossJoin(F.broadcast(facts)).filter(keep).drop("_size", "_nulls")


def restrict_to(df: DataFrame, top: DataFrame, on: str) -> DataFrame:
    """Keep the rows of a chosen set of keys and attach that set's columns.

    The set is the right side of an inner join without a hint: a top-k list is small enough for
    Spark to broadcast, and a larger set is shuffled, so that no key is lost.
    """
    return df.join(top, on)


def join_aggregates(a: DataFrame, b: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join two aggregates of one key; both are already partitioned by it."""
    return a.join(b, on, how)


def side_by_side(*one_row: DataFrame) -> DataFrame:
    """One-row results as one row."""
    first, *rest = one_row
    for df in rest:
        first = first.crossJoin(F.broadcast(df))
    return first


def pick_first(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The first row in the given order."""
    return df.orderBy(*order).limit(1)
