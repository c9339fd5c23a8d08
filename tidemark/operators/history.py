"""Slowly changing history: versions of an entity with half-open validity.

A history table holds the entity's columns plus ``version_id``, ``valid_from``
and ``valid_to`` (NULL while the version is open).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions.dates import FIRST_DAY, LAST_DAY, month_floor
from tidemark.operators.windows import latest_per_key, version_number
from tidemark.sources.paths import read_if_present

BOUNDS = ("version_id", "valid_from", "valid_to")


def version_id(key: str, updated_at: str) -> Column:
    """Stable id of a version: hash of its key and start."""
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.col(updated_at).cast("string")))


def build_history(
    observations: DataFrame,
    key: str,
    period: str,
    order: Sequence[Column] = (),
    hot: Sequence | None = None,
) -> DataFrame:
    """All versions at once from retained observations.

    Equal to applying :func:`scd2_apply` once per period in order: every period
    in which a key was seen starts a version, changed or not. The first shuffle
    carries one row per key and period, so the window that follows is as short
    as the number of periods. Where the ``hot`` keys are known, only their rows need it, and all
    others are shuffled once, on the key.
    """
    seen = observations.filter(F.col(key).isNotNull())
    seen = latest_per_key(seen, [key, period], order or [F.col(period)], hot, [key])
    until = F.lead(period).over(Window.partitionBy(key).orderBy(period))
    # the id is made after the shuffle, which it would double
    return seen.withColumn("valid_to", until).select(
        *seen.columns,
        version_id(key, period).alias("version_id"),
        F.col(period).alias("valid_from"),
        "valid_to",
    )


def scd2_apply(
    current: DataFrame | None, incoming: DataFrame, key: str, updated_at: str
) -> DataFrame:
    """The history after one more snapshot.

    A newer ``updated_at`` closes the open version and starts another, whether or
    not an attribute changed; an equal or older one is ignored. Keys that are
    absent from ``incoming`` stay open, and closed versions pass through. One
    full join on the key does all of it, so the plan grows by one join per step.
    """
    fresh = incoming.filter(F.col(key).isNotNull() & F.col(updated_at).isNotNull())
    fresh = fresh.select(
        *incoming.columns,
        version_id(key, updated_at).alias("version_id"),
        F.col(updated_at).alias("valid_from"),
        F.lit(None).cast(incoming.schema[updated_at].dataType).alias("valid_to"),
    )
    if current is None:
        return fresh
    versions = F.struct(*fresh.columns)
    old = current.select(F.col(key).alias("_old_key"), versions.alias("_old"))
    new = fresh.select(F.col(key).alias("_new_key"), versions.alias("_new"))
    on = (F.col("_old_key") == F.col("_new_key")) & F.col("_old.valid_to").isNull()
    started = F.col("_new.valid_from")
    closed = F.col("_old").withField("valid_to", started)
    result = (
        F.when(F.col("_old").isNull(), F.array("_new"))
        .when(started > F.col("_old.valid_from"), F.array(closed, F.col("_new")))
        .otherwise(F.array("_old"))
    )
    return old.join(new, on, "full").select(F.explode(result).alias("_row")).select("_row.*")


def scd2_apply_all(
    current: DataFrame | None,
    observations: DataFrame,
    key: str,
    updated_at: str,
    order: Sequence[Column] = (),
    hot: Sequence | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The open versions ``current`` after the snapshots of several periods.

    Equal to :func:`scd2_apply` once per period, oldest first: observations not newer than the
    open version of their key are ignored, each later period starts a version and closes the
    one before. Of several observations of a key and period the first in ``order`` counts.

    Where the ``hot`` keys are known, only their observations are reduced to one per period in
    a shuffle of their own, and all others meet the open versions in one shuffle, on the key.
    ``columns`` are those that the history keeps, by default all of the observations.
    """
    order = order or [F.col(updated_at)]
    seen = observations.filter(F.col(key).isNotNull() & F.col(updated_at).isNotNull())
    if hot is None:
        seen = latest_per_key(seen, [key, updated_at], order)
    elif hot:
        many = F.col(key).isin(list(hot))
        few = latest_per_key(seen.filter(many), [key, updated_at], order)
        seen = seen.filter(~many).unionByName(few)
    # ids are made after the shuffle, which they would double
    steps = seen.withColumns(
        {
            "version_id": F.lit(None).cast("string"),
            "valid_from": F.col(updated_at),
            "_open": F.lit(False),
        }
    )
    if current is not None:
        # an id that follows from key and start is made again below
        own_id = F.nullif("version_id", version_id(key, updated_at))
        known = current.drop("valid_to").withColumns({"_open": F.lit(True), "version_id": own_id})
        steps = steps.unionByName(known, allowMissingColumns=columns is not None)
    if hot is not None:
        rank = Window.partitionBy(key, updated_at, "_open").orderBy(*order)
        steps = steps.repartition(key).withColumn("_row", F.row_number().over(rank))
        steps = steps.filter("_open OR _row = 1").drop("_row")
    steps = steps.select(*(columns or observations.columns), "version_id", "valid_from", "_open")
    of_key = Window.partitionBy(key)
    since = F.max(F.when(F.col("_open"), F.col("valid_from"))).over(of_key)
    newer = F.col("_since").isNull() | (F.col("valid_from") > F.col("_since"))
    kept = steps.withColumn("_since", since).filter(F.col("_open") | newer)
    until = F.lead("valid_from").over(of_key.orderBy("valid_from"))
    named = F.coalesce("version_id", version_id(key, updated_at))
    return kept.withColumns({"version_id": named, "valid_to": until}).drop("_open", "_since")


class HistoryTable:
    """A history kept as Parquet, advanced one batch at a time.

    Every batch writes its open versions and the versions it closed, side by
    side and in one job. A step reads only the open versions, so its cost follows
    the number of entities and not the length of their history. The row in
    ``commits`` is written last: a step that died half-way is ignored by readers
    and written again, under the same number, when it is repeated. ``hot`` are the keys with
    many observations a period, where they are known: none if there is one a period.

    A commit of :meth:`cut` holds the date of the cut, after which readers leave out what earlier
    batches closed on that date or later, so that a cut writes open versions only.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str,
        updated_at: str,
        hot: Sequence | None = None,
    ):
        self.spark, self.path = spark, path.rstrip("/")
        self.key, self.updated_at, self.hot = key, updated_at, hot

    def _commits(self) -> DataFrame | None:
        return read_if_present(self.spark, f"{self.path}/commits", "batch INT, base INT, cut DATE")

    def _last_commit(self) -> tuple[int, int]:
        """Last batch and the batch its history starts at; (0, 1) before the first."""
        commits = self._commits()
        if commits is None:
            return 0, 1
        row = commits.agg(F.max(F.struct("batch", "base")).alias("last")).first()["last"]
        return (row["batch"], row["base"]) if row else (0, 1)

    def _versions(self) -> DataFrame:
        stored = self.spark.read.parquet(f"{self.path}/versions")
        own_id = version_id(self.key, "valid_from")
        return stored.withColumn("version_id", F.coalesce("version_id", own_id))

    def last_batch(self) -> int:
        return self._last_commit()[0]

    def open_versions(self) -> DataFrame | None:
        batch, _ = self._last_commit()
        if batch == 0:
            return None
        now = self._versions().filter((F.col("batch") == batch) & (F.col("state") == "open"))
        return now.drop("batch", "state")

    def read(self) -> DataFrame:
        """All versions as of the last committed batch."""
        batch, base = self._last_commit()
        if batch == 0:
            raise ValueError(f"{self.path} holds no committed batch")
        past = F.col("batch").between(base, batch) & (F.col("state") == "closed")
        # one row per replay since the history was built
        cuts = self._commits().filter((F.col("batch") > base) & F.col("cut").isNotNull())
        for row in cuts.collect():
            day = F.lit(row["cut"])
            kept = (F.col("valid_from") < day) & (F.col("valid_to") < day)
            past = past & ((F.col("batch") > row["batch"]) | kept)
        now = (F.col("batch") == batch) & (F.col("state") == "open")
        return self._versions().filter(past | now).drop("batch", "state")

    def _write(
        self, versions: DataFrame, batch: int, base: int, cut: dt.date | None = None
    ) -> None:
        state = F.when(F.col("valid_to").isNull(), "open").otherwise("closed")
        # hashes do not pack, and an id that follows from key and start is made again by readers
        stored_id = F.nullif("version_id", version_id(self.key, "valid_from"))
        (
            versions.withColumns({"state": state, "version_id": stored_id})
            .write.mode("overwrite")
            .partitionBy("state")
            .option("compression", "zstd")
            .parquet(f"{self.path}/versions/batch={batch}")
        )
        day = F.lit(cut).cast("date")
        commit = self.spark.range(1).select(
            F.lit(batch).alias("batch"), F.lit(base).alias("base"), day.alias("cut")
        )
        commit.write.mode("append").parquet(f"{self.path}/commits")

    def apply(self, incoming: DataFrame) -> int:
        """One snapshot step; returns the committed batch number."""
        batch, base = self._last_commit()
        stepped = scd2_apply(self.open_versions(), incoming, self.key, self.updated_at)
        self._write(stepped, batch + 1, base)
        return batch + 1

    def apply_all(
        self,
        observations: DataFrame,
        order: Sequence[Column] = (),
        hot: Sequence | None = None,
        columns: Sequence[str] | None = None,
    ) -> int:
        """The snapshot steps of several periods at once; returns the committed batch number."""
        batch, base = self._last_commit()
        hot = self.hot if hot is None else hot
        stepped = scd2_apply_all(
            self.open_versions(), observations, self.key, self.updated_at, order, hot, columns
        )
        self._write(stepped, batch + 1, base)
        return batch + 1

    def cut(self, period: dt.date) -> int:
        """Forget every version that started at ``period`` or later and reopen the ones before."""
        batch, base = self._last_commit()
        versions, day = self.read(), F.lit(period)
        ended = F.coalesce(F.col("valid_to") < day, F.lit(False))
        opened = versions.filter((F.col("valid_from") < day) & ~ended)
        end = F.lit(None).cast(versions.schema["valid_to"].dataType)
        self._write(opened.withColumn("valid_to", end), batch + 1, base, period)
        return batch + 1

    def vacuum(self, keep: int = 1) -> list[str]:
        """Empty the partitions that no reader needs; returns them.

        Open versions are copied by every batch, so those more than ``keep`` batches behind the
        last commit go, and everything behind the batch that the history starts at. A reader
        that began before the last ``keep`` batches has to start over.
        """
        batch, base = self._last_commit()
        if batch == 0:
            return []
        old_open = (F.col("state") == "open") & (F.col("batch") < batch - keep)
        unread = F.col("batch") < F.least(F.lit(base), F.lit(batch - keep))
        # partition values only
        stale = self._versions().filter(old_open | unread).select("batch", "state").distinct()
        paths = [f"{self.path}/versions/batch={r['batch']}/state={r['state']}" for r in stale.collect()]
        empty = self._versions().drop("batch", "state").limit(0)
        for path in paths:
            empty.write.mode("overwrite").parquet(path)
        return sorted(paths)

    def replace(self, history: DataFrame) -> int:
        """Start over from a rebuilt history; earlier batches are no longer read."""
        batch = self._last_commit()[0] + 1
        self._write(history, batch, batch)
        return batch


def collapse_unchanged(history: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Merge consecutive versions whose attributes are equal.

    Point-in-time results stay the same, because intervals are merged and none
    is dropped; counts of versions do not.
    """
    by_start = Window.partitionBy(key).orderBy("valid_from")
    whole = by_start.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    same = F.lag(F.lit(True)).over(by_start).isNotNull()
    for name in attributes:
        same = same & F.col(name).eqNullSafe(F.lag(name).over(by_start))
    # all three windows share one shuffle and one sort
    marked = history.withColumns({"_same": same, "_end": F.last("valid_to").over(whole)})
    starts = marked.filter(~F.col("_same"))
    until = F.coalesce(F.lead("valid_from").over(by_start), F.col("_end"))
    return starts.withColumn("valid_to", until).drop("_same", "_end")


def to_dimension(history: DataFrame, key: str, attributes: Sequence[str], name: str) -> DataFrame:
    """Dimension with month-grained validity.

    The first version is valid from the beginning of time, later ones from the
    first of their month, and an open version to the end of time (exclusive).
    Of two versions in one month the earlier gets an empty interval.
    """
    numbered = version_number(history, key, "valid_from")
    start = F.when(F.col("version_num") == 1, F.lit(FIRST_DAY).cast("date")).otherwise(
        month_floor("valid_from")
    )
    end = F.coalesce(month_floor("valid_to"), F.lit(LAST_DAY).cast("date"))
    return numbered.select(
        F.col("version_id").alias(f"{name}_version_id"),
        key,
        *attributes,
        start.alias("valid_from"),
        end.alias("valid_to"),
        F.col("valid_to").isNull().alias("is_current"),
    )


def changed_entities(history: DataFrame, key: str, attribute: str) -> DataFrame:
    """Keys whose attribute took more than one known value."""
    values = F.min(attribute).alias("_low"), F.max(attribute).alias("_high")
    return history.groupBy(key).agg(*values).filter("_low <> _high").select(key)


def timeline(history: DataFrame, key: str, attribute: str) -> DataFrame:
    """Versions of the first entity whose attribute changed, in order."""
    first = changed_entities(history, key, attribute).orderBy(key).limit(1)
    return history.join(F.broadcast(first), key).orderBy("valid_from")
