"""Loading files once and in calendar order; table and view sinks.

A loaded table is Parquet partitioned by ``source_file``. A file is loaded by
overwriting its own partition, so loading it again replaces its rows and leaves
every other file alone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import quote

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.dates import period_of
from tidemark.sources.paths import read_if_present

# keeps one written file near a gigabyte for rows of about 200 bytes
MAX_RECORDS = 5_000_000


def _partition(table: str, file_name: str) -> str:
    return f"{table.rstrip('/')}/source_file={quote(file_name, safe='._- ')}"


def one_writer_per(df: DataFrame, column: str) -> DataFrame:
    """Bring the rows of a partition together before they are written.

    Without it every task would leave a small file in every partition. A
    rebalance splits partitions that are too large and merges small ones.
    """
    return df.hint("rebalance", column)


def load_file(df: DataFrame, table: str, file_name: str) -> None:
    """Replace the rows of one file; an empty file leaves none behind.

    The partition is exchanged when the job commits: a load that fails half-way leaves
    the rows of the last one in place.
    """
    rows = df.filter(F.col("source_file") == file_name)
    if rows.isEmpty():
        unload(df.sparkSession, table, [file_name])
    else:
        load_files(rows, table)


def load_files(df: DataFrame, table: str, gathered: bool = False) -> None:
    """Replace the rows of every file present in ``df`` in one job.

    ``gathered`` tells that the rows of a file are together, as in a scan of the files themselves;
    they are then written without a shuffle.
    """
    rows = df if gathered else one_writer_per(df, "source_file")
    (
        rows.write.mode("overwrite")
        .partitionBy("source_file")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_RECORDS)
        .option("compression", "zstd")
        .parquet(table)
    )


def read_table(spark: SparkSession, table: str) -> DataFrame | None:
    """The loaded table, or None before the first load."""
    df = read_if_present(spark, table)
    if df is None or "source_file" not in df.columns:
        return None
    return df.withColumn("source_file", F.col("source_file").cast("string"))


def loaded_files(spark: SparkSession, table: str) -> DataFrame:
    """Names of the files with at least one loaded row; reads no data columns."""
    df = read_table(spark, table)
    if df is None:
        return spark.createDataFrame([], "source_file STRING")
    return df.select("source_file").distinct()


def is_loaded(spark: SparkSession, table: str, file_name: str) -> bool:
    df = read_table(spark, table)
    return df is not None and not df.filter(F.col("source_file") == file_name).isEmpty()


def load_if_absent(df: DataFrame, table: str, file_name: str) -> bool:
    """Load a static file once; a reload would move ``loaded_at`` and fake a new version."""
    if is_loaded(df.sparkSession, table, file_name):
        return False
    load_file(df, table, file_name)
    return True


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Files of a folder as ``path``, ``source_file``; lists names, reads no content."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return listed.select("path", F.element_at(F.split("path", "/"), -1).alias("source_file"))


def pending_periods(available: DataFrame, loaded: DataFrame) -> DataFrame:
    """Files not loaded yet, in calendar order of their ``MM_YYYY`` names."""
    return (
        available.join(loaded.select("source_file"), "source_file", "left_anti")
        .withColumn("period", period_of("source_file"))
        .orderBy("period")
    )


def late_files(pending: DataFrame, loaded: DataFrame) -> DataFrame:
    """Pending files older than a period already loaded."""
    newest = loaded.agg(F.max(period_of("source_file")).alias("_newest"))
    late = pending.crossJoin(F.broadcast(newest)).filter(F.col("period") < F.col("_newest"))
    return late.drop("_newest")


def assert_in_order(pending: DataFrame, loaded: DataFrame) -> None:
    """Refuse to load a period behind the newest loaded one."""
    late = late_files(pending, loaded).orderBy("period").select("source_file").first()
    if late is not None:
        raise ValueError(f"{late['source_file']} is older than a period already loaded")


def next_period(pending: DataFrame, loaded: DataFrame) -> str | None:
    """The file to load next, or None when everything is loaded."""
    assert_in_order(pending, loaded)
    row = pending.orderBy("period").select("source_file").first()
    return row and row["source_file"]


def unload(spark: SparkSession, table: str, file_names: Iterable[str]) -> None:
    """Empty the partitions of the named files (the first half of a replay)."""
    df = read_table(spark, table)
    if df is None:
        return
    empty_partitions(df.drop("source_file"), [_partition(table, name) for name in file_names])


def empty_partitions(rows: DataFrame, paths: Iterable[str]) -> None:
    """Leave no row in the partitions at ``paths``, which hold the columns of ``rows``."""
    spark = rows.sparkSession
    empty = spark.createDataFrame([], rows.schema).coalesce(1)

    def clear(path: str) -> None:
        empty.write.mode("overwrite").parquet(path)

    # nothing but one small job per partition, so several run at a time
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(inheritable_thread_target(spark)(clear), paths))


def unload_from(spark: SparkSession, table: str, period: dt.date) -> list[str]:
    """Empty every file of ``period`` or later and return their names, oldest first."""
    loaded = loaded_files(spark, table).withColumn("period", period_of("source_file"))
    rows = loaded.filter(F.col("period") >= F.lit(period)).orderBy("period").collect()
    names = [row["source_file"] for row in rows]
    unload(spark, table, names)
    return names


def write_table(
    df: DataFrame,
    root: str,
    layer: str,
    name: str,
    partition_by: str | None = None,
    bucket_by: str | None = None,
    buckets: int = 0,
    table: str | None = None,
) -> DataFrame:
    """Materialise a table and return it read back, which cuts its lineage.

    Bucketed tables are registered as ``table``, by default ``<layer>_<name>``; two tables with
    equal buckets on their join key are joined without a shuffle. With ``partition_by`` as well
    every partition has its own buckets: one file each, as one task writes a bucket.
    """
    path = f"{root.rstrip('/')}/{layer}/{name}"
    # halves the hashes that name versions
    packed = {"compression": "zstd"}
    if bucket_by:
        table = table or f"{layer}_{name}"
        # the hash of the shuffle is that of the buckets, so a task has the rows of one bucket
        writer = df.repartition(buckets, bucket_by).write.mode("overwrite").options(path=path, **packed)
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.bucketBy(buckets, bucket_by).sortBy(bucket_by).saveAsTable(table)
        return df.sparkSession.table(table).select(df.columns)
    rows = one_writer_per(df, partition_by) if partition_by else df
    writer = rows.write.mode("overwrite").options(maxRecordsPerFile=MAX_RECORDS, **packed)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a mart under a name; nothing is computed until it is queried."""
    df.createOrReplaceTempView(name)
    return df
