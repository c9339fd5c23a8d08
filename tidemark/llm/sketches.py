"""Document fingerprints: threshold-scaled sketches of word shingles, DataFrame functions only.

A shingle is five consecutive words; its hash chains the 64-bit hashes of the words. A
fingerprint keeps every shingle hash below a fixed fraction of the hash range, so its size
follows the text, two fingerprints of any sizes can be compared, and the fingerprint of a
union is the union of the fingerprints. A text that keeps none keeps its smallest
hash, so that only texts without words have an empty fingerprint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import keep
from tidemark.llm.ranges import id_ranges

SHINGLE = 5
# one in 2^SHIFT hashes is kept
SHIFT = 3

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sketch(text: Column) -> Column:
    """Kept hashes, ascending. Words are split at ASCII white space, A-Z lower-cased."""
    words = F.filter(
        F.split(F.translate(text, _UPPER, _LOWER), "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != ""
    )
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    # arrays of one element bind a value, so that it is computed once and not per shingle
    shingles = F.transform(
        F.array(hashed),
        lambda w: F.when(
            F.size(w) > 0,
            F.transform(
                F.sequence(F.lit(0), F.greatest(F.size(w) - SHINGLE, F.lit(0))),
                lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    kept = F.transform(shingles, _below)
    return F.get(kept, F.lit(0))


def _below(hashes: Column) -> Column:
    # unsigned order: the signed values from 0 on are the lower half
    low = F.filter(hashes, lambda h: (h >= 0) & (h < 1 << (64 - SHIFT)))
    flip = F.lit(-(1 << 63)).cast("long")
    least = F.array_min(F.transform(hashes, lambda h: h.bitwiseXOR(flip))).bitwiseXOR(flip)
    bound = F.transform(
        F.array(low),
        lambda x: F.when(F.size(x) > 0, F.array_sort(F.array_distinct(x)))
        .when(F.size(hashes) > 0, F.array(least))
        .otherwise(x),
    )
    return F.get(bound, F.lit(0))


def merge(a: Column, b: Column) -> Column:
    """The sketch of two texts taken together (without shingles across their border)."""
    both = F.array_union(a, b)
    return F.when(F.size(both) > 0, _below(both)).otherwise(both)


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles among all shingles of both; 1 for two empty sketches."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / both)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first text's shingles that the second has.

    Null where there is no estimate: the first text has no shingle, or keeps none below the
    threshold and stands for itself by its smallest hash, which a longer text need not keep.
    """
    kept = F.forall(a, lambda h: (h >= 0) & (h < 1 << (64 - SHIFT)))
    return F.when(kept, F.size(F.array_intersect(a, b)) / F.nullif(F.size(a), F.lit(0)))


def as_text(kept: Column) -> Column:
    """16 hexadecimal digits per kept hash, ascending."""
    digits = F.transform(kept, lambda h: F.lower(F.lpad(F.hex(h), 16, "0")))
    return F.array_join(digits, "")


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, kept, next_text, next_kept): each document with the next one by doc_id.

    After the last comes the first. The texts are shuffled once, by range of ids; the
    first document of a range is sent to the range before it as well. The table of ranges
    is bounded and therefore broadcast.
    """
    ids = docs.select("doc_id").filter(F.col("doc_id").isNotNull())
    place = id_ranges(ids)
    ranges = place(ids).groupBy("cell", "part").agg(F.min("doc_id").alias("first"))
    order = Window.orderBy("cell", "part")
    last = ranges.agg(F.max(F.struct("cell", "part")).alias("last"))
    before = (
        ranges.withColumn("prev", F.lag(F.struct("cell", "part")).over(order))
        .crossJoin(F.broadcast(last))
        .select(F.col("first").alias("first"), F.coalesce("prev", "last").alias("prev"))
    )
    before = keep(before, "id-ranges")
    own = F.struct(F.lit(0).alias("guest"), F.col("cell"), F.col("part"))
    guest = F.struct(F.lit(1).alias("guest"), F.col("prev.cell"), F.col("prev.part"))
    placed = (
        place(docs)
        # rows without an id have no place in the order; spread them
        .withColumn(
            "part",
            F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("text"), F.lit(1 << 20)))
            .otherwise(F.col("part"))
            .cast("int"),
        )
        .join(F.broadcast(before), F.col("doc_id") == F.col("first"), "left")
        .withColumn(
            "at",
            F.explode(F.when(F.col("prev").isNull(), F.array(own)).otherwise(F.array(own, guest))),
        )
        .select("doc_id", "text", "kept", "at.*")
    )
    following = Window.partitionBy("cell", "part").orderBy("guest", "doc_id", "text")
    return (
        placed.withColumn("next_text", F.lead("text").over(following))
        .withColumn("next_kept", F.lead("kept").over(following))
        .filter("guest = 0")
        .select(
            "doc_id",
            "text",
            "kept",
            *[
                F.when(F.col("doc_id").isNotNull(), F.col(c)).alias(c)
                for c in ("next_text", "next_kept")
            ],
        )
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, one row per row.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as
    many of the next document (all, if it has fewer). A null text counts as empty.
    Repeated ids are ordered by their texts. A document without an id has no next one:
    its tail is replaced by nothing and ``near_next`` is null. Other columns are ignored.
    """
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = with_next(base.withColumn("kept", sketch(F.col("text"))))
    size = F.char_length("text")
    tail = F.floor(size / 4).cast("int")
    head = F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), tail)
    edited = F.concat(F.substring(F.col("text"), F.lit(1), size - tail), head)
    made = rows.select(
        "doc_id",
        size.cast("long").alias("n_chars"),
        F.struct(edited.alias("text"), F.col("kept"), F.col("next_kept")).alias("e"),
    ).select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("e.text").cast("binary"), 256).alias("edited_sha256"),
        F.col("e.kept").alias("kept"),
        F.col("e.next_kept").alias("next_kept"),
        sketch(F.col("e.text")).alias("edited_kept"),
    )
    return made.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("kept")).alias("fingerprint"),
        as_text(F.col("edited_kept")).alias("edited_fingerprint"),
        likeness(F.col("kept"), F.col("edited_kept")).alias("near_edited"),
        likeness(F.col("kept"), F.col("next_kept")).alias("near_next"),
    )
