"""Embedding near-duplicates: sign hashing in several tables, exact cosines, components.

Every vector gets one bit per random hyperplane, and tables of some bits each put vectors of
one label and equal bits into one bucket. All pairs of a bucket are then compared exactly, in
double precision. The bits of a table grow with the different vectors of the label, so that a
bucket of unrelated vectors keeps about ``FULL`` of them. A pair at cosine c shares one bit with
probability p = 1 - arccos(c)/pi and is missed by all tables with probability
(1 - p^bits)^tables; there are as many tables as keep that below ``MISS`` at the threshold, and
it is far less above. At 0.93 and n vectors a label the tables grow with n^0.18:

    vectors of a label   65,000   1 million   100 million   1 billion
    bits, tables          8, 16      12, 29        19, 75     22, 111

A pair that shares several buckets counts in the first of its tables only, which
both signatures show, so no list of pairs is ever built: per vector a tile returns
the number of links and one link towards its component. Buckets above
``TILE`` vectors are cut into blocks and compared block against block. Equal
vectors of one label are one class with a weight.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.common import group_starts, keep, longs, merge_labels, sorted_groups, table
from tidemark.llm.components import connected_components

# bits of a table, at least, and unrelated vectors in a bucket beyond which there are more
LEAST_BITS = 8
FULL = 256
# share of the pairs at the threshold that no table finds, at most
MISS = 0.001
TILE = 1024
SEED = 20240601

_KEYS = ["slot", "label", "dims", "bucket", "row_block", "col_block"]


def tables_for(bits: int, threshold: float) -> int:
    """Tables of ``bits`` bits that miss a pair at ``threshold`` with probability ``MISS`` or less."""
    alike = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    found = alike**bits
    return 1 if found >= 1 else math.ceil(math.log(MISS) / math.log1p(-found))


def bits_for(vectors: Column) -> Column:
    """Bits of a table for a label of as many different vectors."""
    return F.greatest(F.lit(LEAST_BITS), F.ceil(F.log2(vectors / F.lit(FULL)))).cast("int")


@cache
def _planes(dims: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, dims]).standard_normal((dims, tables * bits))


def usable(embedding: Column) -> Column:
    """Not null, no null or non-finite component, and not the zero vector."""
    lost = F.exists(
        embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    return F.coalesce(~lost & F.exists(embedding, lambda x: x != 0), F.lit(False))


def signatures(classes: DataFrame, threshold: float = 0.93) -> DataFrame:
    """(id, dims, bits, sig) of ``classes`` (id, label, embedding, …); the bits of each table of
    ``sig`` fill whole bytes."""
    schema = pa.schema(
        [("id", pa.int64()), ("dims", pa.int64()), ("bits", pa.int32()), ("sig", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            dims = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            bits = longs(batch, "bits")
            begins = np.cumsum(dims) - dims
            sigs = [b""] * len(dims)
            for d, b in {*zip(dims.tolist(), bits.tolist())}:
                rows = np.flatnonzero((dims == d) & (bits == b))
                tables = tables_for(b, threshold)
                for some in np.array_split(rows, len(rows) // 500 + 1):
                    vectors = _scaled(flat[begins[some][:, None] + np.arange(d)])
                    sides = vectors @ _planes(d, b, tables) > 0
                    packed = np.packbits(sides.reshape(len(some), tables, b), axis=2)
                    for row, sig in zip(some.tolist(), packed):
                        sigs[row] = sig.tobytes()
            yield table(schema, longs(batch, "id"), dims, bits, sigs)

    sizes = classes.groupBy("label").agg(bits_for(F.count(F.lit(1))).alias("bits"))
    sized = classes.join(sizes, "label").select("id", "bits", "embedding")
    made = sized.mapInArrow(run, "id long, dims long, bits int, sig binary")
    return keep(made, "signatures")


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Each row times a power of two, so that squares neither overflow nor vanish."""
    _, exponents = np.frexp(np.abs(vectors).max(axis=1))
    return np.ldexp(vectors, -exponents[:, None])


def near_links(vectors: DataFrame, threshold: float) -> DataFrame:
    """(id, n, near): per vector and tile the weighted links found, and one linked id or itself.

    ``vectors`` has id, label, weight, embedding, dims, bits and sig. Links between (id, near)
    connect all vectors that are linked.
    """
    width = F.ceil(F.col("bits") / 8).cast("int")
    slots = F.sequence(F.lit(0), (F.octet_length("sig") / width).cast("int") - 1)
    own_bits = F.substring("sig", F.col("slot") * width + 1, width)
    placed = vectors.select("*", F.explode(slots).alias("slot")).withColumn(
        "bucket", F.conv(F.hex(own_bits), 16, 10).cast("long")
    )
    own = ["slot", "label", "dims", "bucket"]
    crowded = keep(
        placed.groupBy(own)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > TILE)
        .select(*own, F.ceil(F.col("n") / TILE).cast("int").alias("blocks")),
        "crowded-buckets",
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tiled = (
        placed.join(crowded, own, "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", other)
        .withColumn("row_block", F.least("block", "other"))
        .withColumn("col_block", F.greatest("block", "other"))
        .select(*_KEYS, "block", "id", "weight", "bits", "sig", "embedding")
    )
    return (
        tiled.repartition(*_KEYS)
        .sortWithinPartitions(*_KEYS)
        .mapInArrow(_compare(threshold), "id long, n long, near long")
    )


def _compare(threshold: float):
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("near", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sorted_groups(batches, _KEYS):
            starts = group_starts(batch, _KEYS).tolist()
            ids, weights, block = longs(batch, "id"), longs(batch, "weight"), longs(batch, "block")
            slots, dims = longs(batch, "slot"), longs(batch, "dims")
            row_block, col_block = longs(batch, "row_block"), longs(batch, "col_block")
            column = batch.column("embedding")
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            first = np.cumsum(dims) - dims
            bits, sigs = longs(batch, "bits"), batch.column("sig")
            found = []
            for s, e in zip(starts, [*starts[1:], batch.num_rows]):
                if e - s < 2:
                    continue
                vectors = flat[first[s] : first[s] + (e - s) * dims[s]].reshape(e - s, -1)
                vectors = _scaled(vectors)
                vectors = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
                rows = np.flatnonzero(block[s:e] == row_block[s])
                cols = rows
                if row_block[s] != col_block[s]:
                    cols = np.flatnonzero(block[s:e] == col_block[s])
                near = vectors[rows] @ vectors[cols].T >= threshold
                if rows is cols:
                    np.fill_diagonal(near, False)
                i, j = np.nonzero(near)
                if not len(i):
                    continue
                own = _buckets(sigs.slice(s, e - s).to_pylist(), int(bits[s]))
                for t in range(slots[s]):
                    met = own[rows[i], t] == own[cols[j], t]
                    near[i[met], j[met]] = False
                    i, j = i[~met], j[~met]
                if not len(i):
                    continue
                n = np.zeros(e - s, np.int64)
                n[rows] += near @ weights[s + cols]
                if rows is not cols:
                    n[cols] += weights[s + rows] @ near
                labels = merge_labels(np.arange(e - s), rows[i], cols[j])
                hit = np.flatnonzero(n)
                found.append((ids[s + hit], n[hit], ids[s + labels[hit]]))
            if found:
                yield table(schema, *map(np.concatenate, zip(*found)))

    return run


def _buckets(sigs: list[bytes], bits: int) -> np.ndarray:
    """The bucket of each vector (row) in each table (column)."""
    width = -(-bits // 8)
    parts = np.frombuffer(b"".join(sigs), np.uint8).reshape(len(sigs), -1, width)
    return parts.astype(np.int64) @ (256 ** np.arange(width - 1, -1, -1, dtype=np.int64))


def near_duplicates(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per vec_id.

    ``vectors`` has vec_id, embedding and label; other columns are ignored. Vectors of
    one label and one length are linked at a cosine of ``threshold`` or more. A vector
    that is null, zero or holds a null or non-finite component, or has no label, links
    with nothing. Components may be of any numeric type and are kept as doubles unless they are
    floats. ``n_links`` counts the other vectors linked directly, copies included;
    ``component_id`` is the smallest vec_id reachable. Rows that repeat a vec_id count
    as one vector, the smallest (label, embedding) of them; rows without vec_id are left out.
    """
    kind = vectors.schema["embedding"].dataType
    floats = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    components = "array<float>" if floats else "array<double>"
    spark_rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast(components).alias("embedding"),
    ).filter(F.col("vec_id").isNotNull())
    value = F.min(F.struct("label", "embedding")).alias("v")
    single = spark_rows.groupBy("vec_id").agg(value).select("vec_id", "v.*")
    all_rows = keep(
        single.withColumn("ok", usable(F.col("embedding")) & F.col("label").isNotNull()), "vectors"
    )
    good = all_rows.filter("ok")
    classes = keep(
        good.groupBy("label", "embedding").agg(
            F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight")
        ),
        "vector-classes",
    )
    signed = classes.join(signatures(classes, threshold), "id")
    found = keep(near_links(signed, threshold), "vector-links")
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    roots = connected_components(found.select(F.col("id").alias("a"), F.col("near").alias("b")))
    per_class = (
        classes.join(counts, "id", "left")
        .join(roots.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "label",
            "embedding",
            (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    linked = good.join(per_class, ["label", "embedding"]).select(
        "vec_id", "n_links", "component_id"
    )
    alone = all_rows.filter("not ok").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
