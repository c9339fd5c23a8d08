"""SimHash near-duplicates by anchor-point covering.

A text becomes a 64-bit fingerprint: each bit is the majority of that bit over
the XXH64 values of its word shingles. To find all pairs that differ in at most
``distance`` bits, the code words of the perfect binary Golay code (23 bits, 4096
words, covering radius 3) serve as anchors. Every fingerprint is at home at the
one anchor within the covering radius, and is replicated to every anchor within
covering radius plus distance. Two fingerprints within the distance therefore
meet at the home of either. At large sizes the anchors are pairs of code words
over two separate groups of 23 bits; the excess over the covering radius, summed
over the two groups, is at most the distance. The number of groups changes how
much is compared, never which pairs are found.

Equal fingerprints are one class before the search. An anchor with many
fingerprints at home is split into several groups of bounded size. Per group
only a spanning forest of the links leaves the task, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import group_starts, keep, longs, merge_labels, raw_texts, table, texts
from tidemark.llm.components import connected_components

# Generator polynomial, length and covering radius of the binary Golay code.
GOLAY_POLYNOMIAL = 0b101011100011
GOLAY_BITS = 23
GOLAY_RADIUS = 3
WORD_BITS = 12
XXH64_SEED = 42

# homes of one anchor that are compared in one group, and cells of one comparison
HOMES_PER_GROUP = 4096
CELLS = 1 << 20


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of a UTF-8 text: A-Z lower-cased, ASCII white space between words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) <= shingle:
        spans = [(0, len(joined))]
    else:
        starts = np.concatenate([[0], ends[:-1] + 1])
        spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], XXH64_SEED) for a, b in spans], np.uint64)
    ones = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 4096):
        octets = hashes[part : part + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed 64-bit number."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, shingle) for t in raw_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(found, np.uint64).view(np.int64))],
                schema=schema,
            )

    return texts(docs).mapInArrow(run, "doc_id long, fp long")


@cache
def _covering(distance: int) -> tuple[np.ndarray, ...]:
    """The differences from a 23-bit value to all code words within radius plus distance.

    They depend on the value's syndrome alone. Returns the syndromes of the single
    bits, the first row of each syndrome, the rows up to each excess, and per row
    the difference and its excess.
    """
    syndromes = []
    for bit in range(GOLAY_BITS):
        rest = 1 << bit
        for high in range(bit, 10, -1):
            if rest >> high & 1:
                rest ^= GOLAY_POLYNOMIAL << (high - 11)
        syndromes.append(rest)
    rows = []
    for weight in range(GOLAY_RADIUS + distance + 1):
        for bits in combinations(range(GOLAY_BITS), weight):
            difference = syndrome = 0
            for b in bits:
                difference |= 1 << b
                syndrome ^= syndromes[b]
            rows.append((syndrome, max(0, weight - GOLAY_RADIUS), difference))
    rows = np.array(sorted(rows), np.int64)
    keys = np.arange(1 << 11)
    first = np.searchsorted(rows[:, 0], keys)
    steps = rows[:, 0] * (distance + 1) + rows[:, 1]
    upto = np.stack(
        [np.searchsorted(steps, keys * (distance + 1) + k, "right") for k in range(distance + 1)],
        axis=1,
    )
    return np.array(syndromes, np.int64), first, upto, rows[:, 2].copy(), rows[:, 1].copy()


def anchors(
    prints: np.ndarray, distance: int, groups: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (index of the fingerprint, anchor, excess) for all anchors it is replicated to."""
    syndromes, first, upto, difference, excess = _covering(distance)
    row = np.arange(len(prints))
    anchor = np.zeros(len(prints), np.int64)
    used = np.zeros(len(prints), np.int64)
    for g in range(groups):
        value = (prints >> np.uint64(g * GOLAY_BITS)).astype(np.int64) & ((1 << GOLAY_BITS) - 1)
        syndrome = np.zeros(len(prints), np.int64)
        for bit in range(GOLAY_BITS):
            syndrome ^= np.where(value >> bit & 1, syndromes[bit], 0)
        begin = first[syndrome[row]]
        count = upto[syndrome[row], distance - used] - begin
        at = np.repeat(np.arange(len(row)), count)
        pick = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + begin[at]
        row = row[at]
        word = (value[row] ^ difference[pick]) >> (GOLAY_BITS - WORD_BITS)
        anchor = (anchor[at] << WORD_BITS) | word
        used = used[at] + excess[pick]
    return row, anchor, used


def bit_groups(classes: int) -> int:
    """Groups of bits for this many fingerprints: one while few are at home at each anchor."""
    return 1 if classes <= HOMES_PER_GROUP << WORD_BITS - 4 else 2


def near_links(classes: DataFrame, distance: int = 3) -> DataFrame:
    """Links (a, b) that connect all fingerprints (column fp, distinct) within ``distance`` bits.

    The links are a spanning forest of the whole relation.
    """
    groups = bit_groups(classes.count())

    def replicate(only_home: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                prints = longs(batch, "fp").view(np.uint64)
                for part in range(0, len(prints), 2000):
                    some = prints[part : part + 2000]
                    row, anchor, used = anchors(some, distance, groups)
                    if only_home:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(anchor[used == 0])], names=["anchor"]
                        )
                    else:
                        columns = [anchor, some.view(np.int64)[row], used == 0]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c) for c in columns], names=["anchor", "fp", "home"]
                        )

        return run

    homes = classes.mapInArrow(replicate(True), "anchor long")
    # few anchors by nature: each has HOMES_PER_GROUP fingerprints or more
    crowded = keep(
        homes.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > HOMES_PER_GROUP)
        .select("anchor", F.ceil(F.col("n") / HOMES_PER_GROUP).cast("int").alias("parts")),
        "crowded-anchors",
    )
    # at home in one part, and a visitor in the others
    part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")) == F.col("part")
    placed = (
        classes.mapInArrow(replicate(False), "anchor long, fp long, home boolean")
        .join(crowded, "anchor", "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .select("anchor", "fp", "home", "parts", part)
        .select("anchor", "part", (F.col("home") & own).alias("home"), "fp")
    )
    return (
        placed.repartition("anchor", "part")
        .sortWithinPartitions("anchor", "part", F.col("home").desc())
        .mapInArrow(_compare(distance), "a long, b long")
    )


def _compare(distance: int):
    """Fingerprints at home come first in each group; the others stream past them."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, homes, labels = None, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = group_starts(batch, ["anchor", "part"]).tolist()
            anchor, part = longs(batch, "anchor"), longs(batch, "part")
            at_home = longs(batch, "home")
            prints = longs(batch, "fp").view(np.uint64)
            a, b = [], []
            for s, e in zip(starts, [*starts[1:], batch.num_rows]):
                if key != (anchor[s], part[s]):
                    yield from _forest(schema, homes, labels)
                    key, homes, labels = (anchor[s], part[s]), homes[:0], labels[:0]
                n = int(at_home[s:e].sum())
                if n:
                    fresh = prints[s : s + n]
                    labels = np.concatenate([labels, np.arange(len(homes), len(homes) + n)])
                    homes = np.concatenate([homes, fresh])
                    if len(homes) > 1:
                        labels, _, _ = _meet(homes, labels, fresh, distance, False)
                if len(homes) and n < e - s:
                    labels, x, y = _meet(homes, labels, prints[s + n : e], distance, True)
                    a.append(x)
                    b.append(y)
            if a:
                a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
                yield table(schema, a, b)
        yield from _forest(schema, homes, labels)

    return run


def _forest(schema: pa.Schema, homes: np.ndarray, labels: np.ndarray) -> Iterator[pa.RecordBatch]:
    moved = np.flatnonzero(labels != np.arange(len(labels)))
    if len(moved):
        yield table(schema, homes[moved].view(np.int64), homes[labels[moved]].view(np.int64))


def _meet(
    homes: np.ndarray, labels: np.ndarray, others: np.ndarray, distance: int, visiting: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge homes that share a near fingerprint, and link each visitor to one near home.

    A visitor looks at homes above itself only: the pair's lower member visits the
    home of the higher one as well.
    """
    linked, to = [others[:0]], [homes[:0]]
    width = max(1, CELLS // len(homes))
    for p in range(0, len(others), width):
        some = others[p : p + width]
        near = np.bitwise_count(some[:, None] ^ homes[None, :]) <= distance
        if visiting:
            near &= some[:, None] < homes[None, :]
        i, j = np.nonzero(near)
        if not len(i):
            continue
        begins = np.flatnonzero(np.diff(i, prepend=-1))
        lead = j[begins]
        labels = merge_labels(labels, np.repeat(lead, np.diff(begins, append=len(i))), j)
        if visiting:
            linked.append(some[i[begins]])
            to.append(homes[lead])
    return labels, np.concatenate(linked), np.concatenate(to)


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id, kept) for every document.

    Documents whose fingerprints differ in at most ``distance`` bits are linked;
    ``component_id`` is the smallest doc_id reachable by links, the document itself
    included, and ``kept`` marks that one. A null or empty text, or one of white
    space, has fingerprint zero and is linked like any other. Repeated rows of one
    document get equal results. A document without a doc_id gets a fingerprint but
    no component, links nothing and is kept. Other columns are ignored.
    """
    prints = keep(fingerprints(docs, shingle), "fingerprints")
    with_id = prints.filter(F.col("doc_id").isNotNull())
    classes = keep(with_id.groupBy("fp").agg(F.min("doc_id").alias("low")), "fingerprint-classes")
    roots = connected_components(near_links(classes.select("fp"), distance))
    rooted = keep(
        classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "low", F.coalesce("component", "fp").alias("root")
        ),
        "fingerprint-roots",
    )
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = keep(rooted.join(lowest, "root").select("fp", "component_id"), "fingerprint-components")
    found = prints.join(named, "fp", "left").withColumn(
        "component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    )
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )
