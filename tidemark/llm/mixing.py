"""Mixing of sources to target weights: capped water-filling, then seeded repetitions.

The sources share the words of the whole corpus by their weights, but none may be repeated more
than ``epochs`` times. Sources above that are clamped there, what they leave over is shared
again by weight among the rest, until none is above. The level (words per unit of weight) is a
fraction of two whole numbers, so clamping is decided without rounding.

A source's target is a number of whole repetitions of all its documents, and a rest. The
rest is taken from the documents in the order of a keyed hash: whole ones until the rest is
used up, and the first words of the last one. So the words taken are the target, rounded down to a
whole word, whatever the sizes of the documents, and equal on every run.

Nothing is gathered in one task: sources are ranked by a range-partitioned sort, and the running
sum of a source is cut into hash ranges of about ``RUN`` documents, whose sums come first.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import fresh, keep
from tidemark.operators.joins import heavy_keys, salted_join

# documents of one source in a window, about
RUN = 4_000
# hexadecimal digits of the hash that place a document in a range
PLACE = 12

_WORD = r"[^\x20\x09-\x0D]+"
_WHOLE = "decimal(38,0)"


def word_count(text: Column) -> Column:
    """Words between ASCII white space; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A source as a text that is never null, in the order of the sources, null last."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("\U0010ffff"))


def source_ranks(sources: DataFrame) -> DataFrame:
    """``sources`` (one row per ``key``) with ``rank``, 0 for the first in the order of code points.

    A range-partitioned sort deals the sources out; each row's number within its range and the
    number of rows in the ranges before it make the rank.
    """
    in_range = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = keep(
        sources.orderBy("key").select(
            "*", F.spark_partition_id().alias("range"), in_range.alias("nth")
        ),
        "sorted-sources",
    )
    # as many rows as there are ranges
    sizes = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("range")
    bases = sizes.select("range", (F.sum("n").over(before) - F.col("n")).alias("base"))
    return (
        dealt.join(F.broadcast(bases), "range")
        .withColumn("rank", F.col("base") + F.col("nth"))
        .drop("range", "nth", "base")
    )


def fill(sources: DataFrame, epochs: int) -> tuple[Fraction, DataFrame]:
    """The level of the water, and ``sources`` (source_size, weight, ...) with ``clamped``.

    Every round clamps the sources whose share is above ``epochs`` times their size and
    raises the level for the rest; only sums come to the driver. The last round clamps none.
    """
    size, weight = F.col("source_size").cast(_WHOLE), F.col("weight").cast(_WHOLE)
    cap = size * F.lit(epochs).cast("decimal(9,0)")

    def above(level: Fraction) -> Column:
        # weight x level > cap
        return weight * F.lit(level.numerator).cast("decimal(19,0)") > cap * F.lit(
            level.denominator
        ).cast("decimal(19,0)")

    level, clamped = None, F.lit(False)
    while True:
        found = sources.agg(
            F.sum(size).alias("whole"),
            F.sum(F.when(clamped, cap)).alias("held"),
            F.sum(F.when(~clamped, weight)).alias("open"),
        ).first()
        left = int(found["whole"] or 0) - int(found["held"] or 0)
        now = Fraction(left, int(found["open"])) if found["open"] else level or Fraction(0)
        if now == level or not found["open"]:
            return now, sources.withColumn("clamped", clamped)
        level = now
        clamped = above(level)


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), epochs: int = 3, seed: int = 12
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, repetitions, partial) of every row of ``docs``.

    ``docs`` has doc_id, text and source; other columns are ignored. ``size`` counts the words
    of the text (null: 0). Sources weigh ``weights`` in turn, in the order of their code points,
    rows without a source being the last one. ``target`` are the words that the source gives to
    a mix as large as the corpus, at most ``epochs`` times its own (``source_size``), and
    ``taken`` those of the document: ``repetitions`` times all of them and the first ``partial``
    ones once more. Rows that repeat a doc_id are documents of their own; their order is settled
    by their sizes. An empty table gives an empty result, a source without words the target 0.
    Sources that weigh nothing give nothing, even if the others are all clamped.
    """
    # rows without a doc_id go by their texts, so that they do not all have one hash
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5("text")))
    hashed = F.md5(F.concat_ws(":", F.lit(str(seed)), name))
    rows = keep(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            word_count(F.col("text").cast("string")).alias("size"),
            source_key(F.col("source")).alias("key"),
            hashed.alias("hash"),
        ),
        "document-sizes",
    )
    per_source = rows.groupBy("key").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents")
    )
    turn = F.pmod(F.col("rank"), F.lit(len(weights))).cast("int")
    weighed = source_ranks(per_source).withColumn(
        "weight", F.array(*[F.lit(w).cast("long") for w in weights])[turn]
    )
    sources = keep(weighed.drop("rank"), "source-sizes")
    level, sources = fill(sources, epochs)
    share = F.col("weight").cast("decimal(19,0)") * F.lit(level.numerator).cast("decimal(19,0)")
    words = F.when(F.col("clamped"), F.col("source_size") * epochs).otherwise(
        F.call_function("div", share, F.lit(level.denominator).cast("decimal(19,0)"))
    )
    target = F.when(
        F.col("clamped"), (F.col("source_size") * epochs).cast("double")
    ).otherwise(share.cast("double") / F.lit(level.denominator).cast("double"))
    size = F.nullif(F.col("source_size"), F.lit(0))
    sources = (
        sources.withColumn("words", words.cast("long"))
        .withColumn("target", target)
        .withColumn("repetitions", F.coalesce(F.call_function("div", "words", size), F.lit(0)))
        .withColumn("rest", F.col("words") - F.col("repetitions") * F.col("source_size"))
        .withColumn("ranges", F.ceil(F.col("documents") / RUN))
        .select("key", "source_size", "target", "repetitions", "rest", "ranges")
    )
    sources = keep(sources.withColumnRenamed("key", "source_key"), "source-targets")
    placed = salted_join(rows, sources, "key", "source_key", hot=heavy_keys(rows, "key"))
    # ranges of the hash, so that the order of (range, hash) is that of the hash
    place = F.conv(F.substring("hash", 1, PLACE), 16, 10).cast("decimal(20,0)")
    placed = placed.withColumn(
        "range", F.floor(place * F.col("ranges") / F.lit(16**PLACE)).cast("long")
    )
    ranges = placed.groupBy("key", "range").agg(F.sum("size").alias("words"))
    of_source = Window.partitionBy("key").orderBy("range")
    before = ranges.select(
        "key", "range", (F.sum("words").over(of_source) - F.col("words")).alias("base")
    )
    in_range = (
        Window.partitionBy("key", "range")
        .orderBy("hash", F.col("doc_id").asc_nulls_first(), "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = placed.withColumn("up_to", F.sum("size").over(in_range)).join(before, ["key", "range"])
    start = F.col("base") + F.col("up_to") - F.col("size")
    partial = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - start)).cast("long")
    return summed.withColumn("partial", partial).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("repetitions") * F.col("size") + F.col("partial")).cast("long").alias("taken"),
        F.col("repetitions").cast("long").alias("repetitions"),
        "partial",
    )


def mixed_texts(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents of a mix: ``docs`` (unique doc_id) repeated, the partial repetition cut.

    The rows are those of ``docs`` with ``copy``, 0 for the first repetition; a document that
    the mix does not take is left out. The cut text ends after the words that were taken.
    """
    copy, part = fresh(docs, "copy"), fresh(docs, "partial")
    counts = mixed.select(
        "doc_id", F.col("repetitions").alias("_whole"), F.col("partial").alias(part)
    )
    whole = F.array_repeat(F.lit(False), F.col("_whole").cast("int"))
    cut = F.array_repeat(F.lit(True), (F.col(part) > 0).cast("int"))
    words = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), 0)
    text = F.array_join(F.slice(words, F.lit(1), F.col(part).cast("int")), "")
    return (
        docs.join(counts, "doc_id")
        .select("*", F.posexplode(F.concat(whole, cut)).alias(copy, "_cut"))
        .withColumn("text", F.when(F.col("_cut"), text).otherwise(F.col("text")))
        .select(*docs.columns, copy)
    )


# The same rows in DuckDB's SQL.
ORACLE = r"""
with docs as (
    select doc_id, source,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
        md5('12:' || doc_id) as hash
    from documents
), per_source as (
    select source, cast(sum(size) as hugeint) as source_size from docs group by source
), weighed as (
    select *, 1 + (row_number() over (order by source collate "binary" nulls last) - 1) % 3 as weight,
        sum(source_size) over () as whole
    from per_source
), ordered as (
    -- those that are clamped first come first
    select *, row_number() over (order by source_size * 6 // weight, source_size * 6 % weight, source) as k
    from weighed
), levels as (
    select *, whole - coalesce(sum(3 * source_size) over (order by k rows between unbounded preceding and 1 preceding), 0) as water,
        sum(weight) over (order by k rows between current row and unbounded following) as open
    from ordered
), level as (
    -- the first source that its share does not fill ends the clamping
    select water, open, k from levels where weight * water <= 3 * source_size * open order by k limit 1
), targets as (
    select o.source, o.source_size,
        case when o.k < l.k then cast(3 * o.source_size as double)
            else cast(o.weight * l.water as double) / cast(l.open as double) end as target,
        cast(case when o.k < l.k then 3 * o.source_size else o.weight * l.water // l.open end as bigint) as words
    from ordered o, level l
), placed as (
    select d.doc_id, d.size, t.source_size, t.target,
        case when t.source_size > 0 then t.words // t.source_size else 0 end as repetitions,
        case when t.source_size > 0 then t.words % t.source_size else 0 end as rest,
        sum(d.size) over (partition by d.source order by d.hash, d.doc_id, d.size
            rows between unbounded preceding and current row) - d.size as start
    from docs d join targets t on d.source is not distinct from t.source
)
select doc_id, cast(size as bigint) as size, cast(source_size as bigint) as source_size, target,
    cast(repetitions * size + greatest(0, least(size, rest - start)) as bigint) as taken,
    cast(repetitions as bigint) as repetitions,
    cast(greatest(0, least(size, rest - start)) as bigint) as "partial"
from placed
"""
