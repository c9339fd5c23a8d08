"""Helpers that several operators share: tables on the shared folder, Arrow columns."""

from __future__ import annotations

import atexit
import os
import pathlib
import tempfile
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.session import shared_dir


# Workers stay for the next task: give the memory of a batch back to the system.
pa.set_memory_pool(pa.system_memory_pool())


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage: a lost executor costs the tasks that ran on it, not
    the steps before. Files written by one run are never written again.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) without any other column; a null text counts as empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def fresh(df: DataFrame, name: str) -> str:
    """``name``, longer if ``df`` has such a column already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A column without nulls as a numpy array."""
    return batch.column(name).to_numpy(zero_copy_only=False)


def raw_texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text, one at a time."""
    binary = column.cast(pa.binary())
    for value in binary:
        yield value.as_py()


def table(schema: pa.Schema, *columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def sorted_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[pa.RecordBatch]:
    """Batches of whole groups from a partition that is sorted by ``keys``.

    Only the last group of a batch waits for the next batch, so memory is bounded
    by a batch and the largest group; callers split groups that can grow.
    """
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        changed = group_starts(batch, keys)
        if rest and _same(rest[0], 0, batch, 0, keys):
            if len(changed) == 1:
                rest.append(batch)
                continue
            cut, head = int(changed[-1]), int(changed[1])
            rest.append(batch.slice(0, head))
            yield _joined(rest)
            if cut > head:
                yield batch.slice(head, cut - head)
        else:
            if rest:
                yield _joined(rest)
            cut = int(changed[-1])
            if cut:
                yield batch.slice(0, cut)
        rest = [batch.slice(cut)]
    if rest:
        yield _joined(rest)


def group_slices(
    batches: Iterator[pa.RecordBatch], keys: list[str], rows: int
) -> Iterator[pa.RecordBatch]:
    """``sorted_groups`` in smaller portions: whole groups, of about ``rows`` rows together."""
    for batch in sorted_groups(batches, keys):
        starts = group_starts(batch, keys)
        cuts = starts[np.flatnonzero(np.diff(starts // rows, prepend=-1))].tolist()
        for s, e in zip(cuts, [*cuts[1:], batch.num_rows]):
            yield batch.slice(s, e - s)


def group_starts(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Rows at which a new key begins, the first row included."""
    new = np.zeros(batch.num_rows, bool)
    new[0] = True
    for k in keys:
        column = longs(batch, k)
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)


def _same(a: pa.RecordBatch, i: int, b: pa.RecordBatch, j: int, keys: list[str]) -> bool:
    return all(a.column(k)[i] == b.column(k)[j] for k in keys)


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of index pairs: the smallest index of each set, by hooking and pointer jumping."""
    while True:
        x, y = labels[a], labels[b]
        open_ = x != y
        if not open_.any():
            return labels
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        low, high = np.minimum(x, y), np.maximum(x, y)
        np.minimum.at(labels, high, low)
        while True:
            jumped = labels[labels]
            if (jumped == labels).all():
                break
            labels = jumped


_SHIPPED: set[str] = set()
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application.

    The functions that run inside tasks are pickled by name. A cluster that
    already has the package on its Python path only gets a second copy. Unless the session
    says otherwise, Arrow batches are bounded in bytes: texts differ much in length.
    """
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = pathlib.Path(__file__).parents[1]
    # the driver serves this file as long as the application runs
    folder = tempfile.TemporaryDirectory()
    atexit.register(folder.cleanup)
    archive = os.path.join(folder.name, "tidemark-package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(top.rglob("*.py")):
            out.write(path, path.relative_to(top.parent))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
