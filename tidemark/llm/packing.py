"""Packing of documents into sequences by cutting-stock column generation.

A document's ids are cut after every CAPACITY ids; what remains is one more piece. Pieces are
counted by length class (UNIT ids wide, rounded up), so the histogram has at most
CAPACITY / UNIT entries at every size of the corpus. On it a linear program chooses
how often to use each pattern, a multiset of classes that fits a sequence: starting from
greedy patterns, a knapsack dynamic program over the current prices finds the patterns
that improve it, until none does. The uses are rounded down, and
the few pieces per class that are left over are packed by best fit. Then the pieces of
each class are ranked, and ranks are dealt to the patterns' places.

Only the histogram comes to the driver, and only the list of patterns leaves it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import keep, table
from tidemark.llm.tokens import encoder

CAPACITY = 2048
UNIT = 8
# pieces of one class that are ranked in one group, about
RANKED = 200_000

# the linear program ends within this share of its optimum
TOLERANCE = 5e-4
# patterns that are tried again before the knapsack is asked for others
KNOWN = 4096

Pattern = tuple[tuple[int, int], ...]


def best_patterns(
    prices: np.ndarray, sizes: np.ndarray, room: int, above: float
) -> tuple[float, np.ndarray]:
    """Knapsack over the room: the highest total price of a multiset of sizes that fits.

    Also returns, one per row, the counts of the best multiset that holds each single size,
    where its price is over ``above``.
    """
    value = np.zeros(room + 1)
    taken = np.full(room + 1, -1)
    fits = np.searchsorted(sizes, np.arange(room + 1), "right")
    for w in range(1, room + 1):
        gains = value[w - sizes[: fits[w]]] + prices[: fits[w]]
        k = int(gains.argmax()) if len(gains) else -1
        if k >= 0 and gains[k] > value[w - 1]:
            value[w], taken[w] = gains[k], k
        else:
            value[w] = value[w - 1]
    rows = []
    for k in np.flatnonzero(prices + value[room - sizes] > above).tolist():
        counts, w = np.zeros(len(sizes), np.int64), room - int(sizes[k])
        counts[k] = 1
        while w > 0:
            if taken[w] < 0:
                w -= 1
            else:
                counts[taken[w]] += 1
                w -= int(sizes[taken[w]])
        rows.append(counts)
    return float(value[room]), np.array(rows, np.int64).reshape(len(rows), len(sizes))


def first_patterns(sizes: np.ndarray, demand: np.ndarray, room: int) -> np.ndarray:
    """A basis of patterns: fill up with the largest sizes left, until one of them is used up.

    A size used up by one pattern is in none of the later ones, so that the patterns are
    independent; a size that is used up along with another gets a pattern of its own.
    """
    left = demand.astype(float)
    columns = np.diag(room // sizes).astype(float)
    while (left > 0).any():
        counts, free = np.zeros(len(sizes)), room
        for k in np.flatnonzero(left > 0)[::-1].tolist():
            counts[k] = free // sizes[k]
            free -= int(counts[k] * sizes[k])
        used = np.flatnonzero(counts)
        times = (left[used] / counts[used]).min()
        left[used] -= times * counts[used]
        gone = used[left[used] <= 1e-9 * demand[used]]
        columns[:, gone[0]] = counts
        left[gone] = 0
    return columns


def inverted(matrix: np.ndarray) -> np.ndarray:
    """The inverse by elimination, a row at a time.

    Threads of a linear algebra library and the driver's JVM do not always go together, so the
    driver uses elementwise arithmetic only; a basis has CAPACITY / UNIT rows at most.
    """
    m = len(matrix)
    both = np.concatenate([matrix, np.eye(m)], axis=1)
    for k in range(m):
        pivot = k + int(np.abs(both[k:, k]).argmax())
        both[[k, pivot]] = both[[pivot, k]]
        both[k] /= both[k, k]
        others = both[:, k].copy()
        others[k] = 0
        both -= others[:, None] * both[k]
    return both[:, m:].copy()


def product(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """``matrix @ vector`` by numpy's own loops (see :func:`inverted`)."""
    return np.einsum("ij,j->i", matrix, vector)


def column_generation(
    sizes: np.ndarray, demand: np.ndarray, room: int
) -> list[tuple[float, np.ndarray]]:
    """A basis of the cutting-stock program within TOLERANCE of its optimum: (uses, counts).

    ``sizes`` ascend and fit the room, every demand is positive.
    """
    m = len(sizes)
    columns = first_patterns(sizes, demand, room)
    inverse = inverted(columns)
    uses = product(inverse, demand)
    known = np.zeros((0, m))
    # each step brings in one pattern; the basis is feasible at any time
    for step in range(40 * m):
        prices = inverse.sum(axis=0)
        worth = product(known, prices)
        if not len(known) or worth.max() <= 1 + TOLERANCE:
            value, found = best_patterns(prices, sizes, room, 1 + TOLERANCE)
            # all prices divided by this are a bound from below
            if value <= 1 + TOLERANCE:
                break
            known = np.concatenate([known, found])[-KNOWN:]
            worth = product(known, prices)
        counts = known[int(worth.argmax())]
        rise = product(inverse, counts)
        rising = rise > 1e-9
        ratios = np.full(m, np.inf)
        ratios[rising] = np.maximum(uses[rising], 0) / rise[rising]
        leave = int(ratios.argmin())
        columns[:, leave] = counts
        if step % 200 == 199:
            inverse = inverted(columns)
        else:
            pivot = inverse[leave] / rise[leave]
            inverse -= rise[:, None] * pivot
            inverse[leave] = pivot
        uses = product(inverse, demand)
    return [(float(max(0, u)), c.astype(np.int64)) for u, c in zip(uses, columns.T)]


def plan(histogram: dict[int, int], room: int = CAPACITY // UNIT) -> list[tuple[int, Pattern]]:
    """(uses, pattern) that hold exactly the counted pieces; a pattern is (class, pieces) pairs."""
    sizes = np.array(sorted(c for c, n in histogram.items() if n > 0), np.int64)
    if not len(sizes):
        return []
    left = np.array([histogram[c] for c in sizes.tolist()], np.int64)
    out: list[tuple[int, Pattern]] = []
    basis = column_generation(sizes, left.astype(float), room)
    for uses, counts in sorted(basis, key=lambda b: -b[0]):
        # never more than is there, whatever rounding the arithmetic has done
        possible = (left[counts > 0] // counts[counts > 0]).min() if counts.any() else 0
        times = int(min(np.floor(uses + 1e-6), possible))
        if times:
            left -= times * counts
            out.append((times, _pattern(sizes, counts)))
    bins: list[tuple[int, np.ndarray]] = []
    for k in range(len(sizes) - 1, -1, -1):
        for _ in range(int(left[k])):
            fitting = [i for i, (free, _) in enumerate(bins) if free >= sizes[k]]
            if fitting:
                i = min(fitting, key=lambda i: bins[i][0])
            else:
                bins.append((room, np.zeros(len(sizes), np.int64)))
                i = len(bins) - 1
            bins[i][1][k] += 1
            bins[i] = (bins[i][0] - int(sizes[k]), bins[i][1])
    return out + [(1, _pattern(sizes, counts)) for _, counts in bins]


def _pattern(sizes: np.ndarray, counts: np.ndarray) -> Pattern:
    return tuple((int(s), int(n)) for s, n in zip(sizes, counts) if n)


def pieces(docs: DataFrame, tokenizer: str, end_id: int, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) of the pieces of all documents.

    The tokenizer file drops white space; ``end_id`` follows each document. With
    ``with_ids`` the ids come as well (binary, little-endian unsigned 32-bit).
    """
    kinds = [(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
    schema = pa.schema(kinds + [("ids", pa.binary())] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, False).encode
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            if not batch.num_rows:
                continue
            flat, bounds = encode(batch.column("text"))
            data = memoryview(np.ascontiguousarray(flat, "<u4")).cast("B")
            rows = []
            edges = bounds.tolist()
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), edges, edges[1:]):
                n = b - a + 1
                for s in range(0, n, CAPACITY):
                    e = min(n, s + CAPACITY)
                    part = data[4 * (a + s) : 4 * min(b, a + e)]
                    crc = zlib.crc32(part)
                    if e == n:
                        crc = zlib.crc32(end, crc)
                    row = (doc_id, s, e - s, crc, n)
                    if with_ids:
                        row = (*row, part.tobytes() + (end if e == n else b""))
                    rows.append(row)
            yield table(schema, *zip(*rows))

    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    columns = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return base.mapInArrow(run, columns + ", ids binary" * with_ids)


def assign(cut: DataFrame) -> DataFrame:
    """``cut`` with sequence_id and offset; all pieces of one sequence fit CAPACITY.

    ``cut`` has at least doc_id, start, length and ids_crc32, is read several times and
    should be a table. The pieces of a sequence lie side by side from offset 0.
    """
    spark = cut.sparkSession
    classed = cut.withColumn("class", F.ceil(F.col("length") / UNIT).cast("int"))
    # bounded by CAPACITY / UNIT rows
    counted = classed.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()
    histogram = {row["class"]: row["n"] for row in counted}
    patterns = plan(histogram)

    # the places of each class: ranks from slot on belong to the uses of one pattern
    slots = dict.fromkeys(histogram, 0)
    rows, sequence = [], 0
    for times, pattern in patterns:
        for size, each in pattern:
            rows.append((size, slots[size], slots[size] + times * each, each, sequence))
            slots[size] += times * each
        sequence += times
    # as many rows as the patterns have classes, whatever the size of the corpus
    places = spark.createDataFrame(
        rows, "size int, slot long, slot_end long, each long, first_sequence long"
    )

    # ranks within a class: counts of groups first, then ranks within each group
    groups = max(1, sum(histogram.values()) // RANKED) * 16
    order = ["doc_id", "start", "ids_crc32"]
    grouped = classed.withColumn("part", F.pmod(F.xxhash64("doc_id", "start"), F.lit(groups)))
    sizes = grouped.groupBy("class", "part").agg(F.count(F.lit(1)).alias("n"))
    above = Window.partitionBy("class").orderBy("part")
    bases = sizes.select("class", "part", (F.sum("n").over(above) - F.col("n")).alias("base"))
    within = Window.partitionBy("class", "part").orderBy(*order)
    ranked = (
        grouped.withColumn("rank", F.row_number().over(within) - 1)
        .join(bases, ["class", "part"])
        .withColumn("rank", F.col("rank") + F.col("base"))
        .drop("part", "base")
    )
    inside = (
        (F.col("class") == F.col("size"))
        & (F.col("rank") >= F.col("slot"))
        & (F.col("rank") < F.col("slot_end"))
    )
    nth = F.floor((F.col("rank") - F.col("slot")) / F.col("each"))
    dealt = ranked.join(F.broadcast(places), inside).withColumn(
        "sequence_id", F.col("first_sequence") + nth
    )
    side_by_side = Window.partitionBy("sequence_id").orderBy(F.col("class").desc(), "rank")
    offset = F.sum("length").over(side_by_side) - F.col("length")
    return dealt.withColumn("offset", offset).select(*cut.columns, "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer: str, end_id: int, with_ids: bool = False) -> DataFrame:
    """All documents packed: one row per piece, as ``pieces``, with sequence_id and offset.

    Sequences hold at most CAPACITY ids and are padded by the reader. A null text counts
    as empty and has the end id alone. Repeated rows are packed as often as they come;
    rows without a doc_id are packed too. Other columns are ignored.
    """
    return assign(keep(pieces(docs, tokenizer, end_id, with_ids), "pieces"))
