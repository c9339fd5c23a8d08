"""Token ids of a corpus as patched frame-of-reference blocks.

Documents are shuffled once, as texts, into ranges of ids; a task encodes the documents of a
range in order and packs their ids into segments. A segment is one byte string:

====================  =====================================================================
header                magic, documents, ids, blocks (unsigned 64-bit each)
documents             doc_id (signed 64-bit) and number of ids (unsigned 64-bit) of each
index                 where each block starts, from the beginning of the segment
block                 minimum (32-bit), width (8-bit), exceptions (16-bit), then
                      BLOCK differences to the minimum, ``width`` bits each, and for every
                      exception its place (16-bit) and its difference (32-bit)
====================  =====================================================================

All numbers are little-endian; packed bits run from the most significant bit on. The width of
a block is that of its percentile ``PERCENTILE``; larger differences are packed as zero and
patched from the exceptions. Segments are rows of a Parquet table, so that they are written
with Spark's commit protocol, to any store that Spark can write.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import group_starts, keep, longs, table
from tidemark.llm.ranges import CELLS, id_ranges
from tidemark.llm.tokens import encoder

MAGIC = 0x314B4F4C42524F46
BLOCK = 1024
PERCENTILE = 98
# ids in a segment, about: the next document opens a new one
SEGMENT = 1 << 21

# widths of whole bytes need no shifting
_WHOLE = {8: ">u1", 16: ">u2", 32: ">u4"}
_HEAD = struct.Struct("<QQQQ")
_BLOCK_HEAD = struct.Struct("<IBH")


def pack_ids(ids: np.ndarray) -> list[bytes]:
    """Blocks of up to BLOCK ids; the last is filled up with its own minimum."""
    count = -(-len(ids) // BLOCK)
    if not count:
        return []
    grid = np.full(count * BLOCK, ids[(count - 1) * BLOCK :].min(), np.uint32)
    grid[: len(ids)] = ids
    grid = grid.reshape(count, BLOCK)
    low = grid.min(axis=1)
    rest = grid - low[:, None]
    at = (BLOCK * PERCENTILE - 1) // 100
    typical = np.partition(rest, at, axis=1)[:, at]
    widths = np.ceil(np.log2(typical.astype(np.float64) + 1)).astype(int)
    out: list[bytes] = [b""] * count
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        for some in np.array_split(rows, len(rows) // 256 + 1):
            part = rest[some]
            outliers = part >> width > 0 if width < 32 else np.zeros_like(part, bool)
            packed = _bits(np.where(outliers, 0, part), width)
            for k, row in enumerate(some.tolist()):
                place = np.flatnonzero(outliers[k])
                out[row] = b"".join(
                    (
                        _BLOCK_HEAD.pack(int(low[row]), width, len(place)),
                        packed[k].tobytes(),
                        place.astype("<u2").tobytes(),
                        part[k, place].astype("<u4").tobytes(),
                    )
                )
    return out


def _bits(values: np.ndarray, width: int) -> np.ndarray:
    """The lower ``width`` bits of each value, row by row, as bytes."""
    if width in _WHOLE:
        return values.astype(_WHOLE[width]).view(np.uint8)
    bits = np.unpackbits(values.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(bits[:, 32 - width :].reshape(len(values), -1), axis=1)


def write_segment(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    blocks = pack_ids(ids)
    begin = _HEAD.size + 16 * len(doc_ids) + 8 * len(blocks)
    sizes = np.fromiter(map(len, blocks), np.int64, len(blocks))
    index = begin + np.cumsum(sizes) - sizes
    return b"".join(
        (
            _HEAD.pack(MAGIC, len(doc_ids), len(ids), len(blocks)),
            doc_ids.astype("<i8").tobytes(),
            counts.astype("<u8").tobytes(),
            index.astype("<u8").tobytes(),
            *blocks,
        )
    )


def read_segment(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, their numbers of ids, and all ids."""
    magic, n_docs, n_ids, n_blocks = _HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a segment of token ids")
    at = _HEAD.size
    doc_ids = np.frombuffer(data, "<i8", n_docs, at)
    counts = np.frombuffer(data, "<u8", n_docs, at + 8 * n_docs).astype(np.int64)
    index = np.frombuffer(data, "<u8", n_blocks, at + 16 * n_docs).astype(np.int64)
    heads = [_BLOCK_HEAD.unpack_from(data, i) for i in index.tolist()]
    widths = np.array([h[1] for h in heads], np.int64)
    octets = np.frombuffer(data, np.uint8)
    grid = np.zeros((n_blocks, BLOCK), np.uint32)
    for width in np.unique(widths[widths > 0]).tolist():
        rows = np.flatnonzero(widths == width)
        size = BLOCK * width // 8
        for some in np.array_split(rows, len(rows) // 256 + 1):
            begins = index[some] + _BLOCK_HEAD.size
            packed = octets[begins[:, None] + np.arange(size)]
            if width in _WHOLE:
                grid[some] = packed.view(_WHOLE[width])
                continue
            bits = np.unpackbits(packed, axis=1).reshape(-1, width)
            wide = np.zeros((len(bits), 32), np.uint8)
            wide[:, 32 - width :] = bits
            grid[some] = np.packbits(wide, axis=1).view(">u4").reshape(len(some), BLOCK)
    for k, (low, width, outliers) in enumerate(heads):
        if outliers:
            at = int(index[k]) + _BLOCK_HEAD.size + BLOCK * width // 8
            place = np.frombuffer(data, "<u2", outliers, at)
            grid[k, place] = np.frombuffer(data, "<u4", outliers, at + 2 * outliers)
        grid[k] += np.uint32(low)
    return doc_ids, counts, grid.ravel()[:n_ids]


def write_ids(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, segment: int = SEGMENT
) -> None:
    """Encode all documents with a byte-level tokenizer file and write segments to ``path``.

    Each document is followed by ``end_id``; ``segment`` is about how many ids a segment has;
    a null text counts as empty. The rows
    (cell, part, piece, n_ids, segment) are in ascending order of doc_id; of rows that
    share a doc_id the smaller text comes first. Documents without a doc_id come last, in
    the order of a hash of their texts, in cells of their own. Other columns are ignored.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    place = id_ranges(rows.select("doc_id").filter(F.col("doc_id").isNotNull()))
    loose = F.pmod(F.xxhash64("text"), F.lit(CELLS)).cast("int")
    placed = place(rows).select(
        F.coalesce("cell", F.lit(CELLS)).alias("cell"),
        F.coalesce("part", loose).alias("part"),
        F.coalesce("doc_id", F.lit(-1)).alias("doc_id"),
        "text",
    )
    kinds = [("cell", pa.int32()), ("part", pa.int32()), ("piece", pa.int32())]
    kinds += [("n_ids", pa.int64()), ("segment", pa.binary())]
    schema = pa.schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, True).encode
        key, piece = None, 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def closed() -> pa.RecordBatch:
            ids = np.concatenate([h[2] for h in held])
            data = write_segment(*(np.concatenate([h[i] for h in held]) for i in (0, 1)), ids)
            return table(schema, [key[0]], [key[1]], [piece], [len(ids)], [data])

        for batch in batches:
            if not batch.num_rows:
                continue
            flat, bounds = encode(batch.column("text"))
            # the end id after the ids of each document
            ends = bounds[1:] + np.arange(1, batch.num_rows + 1)
            with_end = np.empty(len(flat) + batch.num_rows, np.uint32)
            is_end = np.zeros(len(with_end), bool)
            is_end[ends - 1] = True
            with_end[is_end], with_end[~is_end] = end_id, flat
            counts = np.diff(ends, prepend=0)
            doc_ids, cell, part = (longs(batch, c) for c in ("doc_id", "cell", "part"))
            starts = group_starts(batch, ["cell", "part"])
            cuts = np.union1d(starts, _even_cuts(ends, segment)).tolist()
            for s, e in zip(cuts, [*cuts[1:], batch.num_rows]):
                full = held and sum(len(h[2]) for h in held) >= segment
                if held and (key != (cell[s], part[s]) or full):
                    yield closed()
                    held = []
                if key != (cell[s], part[s]):
                    key, piece = (cell[s], part[s]), 0
                elif full:
                    piece += 1
                ids = with_end[ends[s] - counts[s] : ends[e - 1]]
                held.append((doc_ids[s:e], counts[s:e], ids))
        if held:
            yield closed()

    segments = (
        placed.repartition("cell", "part")
        .sortWithinPartitions("cell", "part", "doc_id", "text")
        .mapInArrow(run, "cell int, part int, piece int, n_ids long, segment binary")
    )
    # packed ids do not shrink any further
    segments.write.option("compression", "none").parquet(path)


def _even_cuts(ends: np.ndarray, size: int) -> np.ndarray:
    """Rows at which a new multiple of ``size`` ids has been passed."""
    passed = ends // size
    return np.flatnonzero(np.diff(passed) > 0) + 1


def _starts(segments: DataFrame) -> DataFrame:
    """(cell, part, piece, base): the ids of all segments before each one."""
    # totals per cell first: the one window without partition has at most CELLS + 1 rows
    own = Window.partitionBy("cell").orderBy("part", "piece")
    above = Window.orderBy("cell")
    sizes = segments.select("cell", "part", "piece", "n_ids")
    cells = sizes.groupBy("cell").agg(F.sum("n_ids").alias("total"))
    cells = cells.select("cell", (F.sum("total").over(above) - F.col("total")).alias("cells"))
    before = F.sum("n_ids").over(own) - F.col("n_ids")
    return keep(
        sizes.withColumn("before", before)
        .join(cells, "cell")
        .select("cell", "part", "piece", (F.col("cells") + F.col("before")).alias("base")),
        "segment-starts",
    )


def read_ids(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document of the segments at ``path``.

    ``start`` is the number of ids of all documents before it, ``ids`` holds little-endian
    unsigned 32-bit integers. With ``digest`` their crc32 (``ids_crc32``, unsigned) comes
    instead, so that no ids leave the task that unpacks them.
    """
    segments = spark.read.parquet(path)
    kinds = [("cell", pa.int32()), ("part", pa.int32()), ("piece", pa.int32())]
    kinds += [("doc_id", pa.int64()), ("offset", pa.int64()), ("n_tokens", pa.int64())]
    value = ("ids_crc32", pa.int64()) if digest else ("ids", pa.binary())
    schema = pa.schema([*kinds, value])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                doc_ids, counts, ids = read_segment(batch.column("segment")[k].as_py())
                ends = np.cumsum(counts)
                data = memoryview(ids.astype("<u4")).cast("B")
                each = (data[4 * (e - c) : 4 * e] for c, e in zip(counts.tolist(), ends.tolist()))
                values = [zlib.crc32(x) if digest else x.tobytes() for x in each]
                where = (
                    np.full(len(ends), batch.column(c)[k].as_py()) for c in ("cell", "part", "piece")
                )
                yield table(schema, *where, doc_ids, ends - counts, counts, values)

    kind = "ids_crc32 long" if digest else "ids binary"
    docs = segments.drop("n_ids").mapInArrow(
        run, f"cell int, part int, piece int, doc_id long, offset long, n_tokens long, {kind}"
    )
    return docs.join(_starts(segments), ["cell", "part", "piece"]).select(
        F.when(F.col("cell") < CELLS, F.col("doc_id")).alias("doc_id"),
        (F.col("base") + F.col("offset")).alias("start"),
        "n_tokens",
        value[0],
    )
