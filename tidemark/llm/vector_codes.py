"""Product codes of vectors from an integer Walsh-Hadamard transform.

A vector's components become whole numbers, ``floor(4096 x)``, and the vector is cut into
``PARTS`` equal parts. Each part is coded by the nearest of ``ENTRIES`` codebook entries. Parts and
entries are filled up with zeros to a power of two and transformed by additions and
subtractions only. The transform stretches all squared distances by the same factor (the padded
width), so distances compare in transformed coefficients as they are; the factor is divided out,
without rest, at the end. The coefficients are added up in sequency order, that is by the
number of sign changes of their basis, where slowly changing parts have most of their
weight: an entry whose sum is already above the whole distance of another one is
eliminated before its other coefficients are looked at. All of it is integer arithmetic, so codes,
codebooks and errors are exact and the same on every run and partitioning.

A round of codebook learning is one pass over a table of whole-number vectors: every task adds up
the parts of each entry, and the sums (PARTS x ENTRIES entries, whatever the size of
the table) are added by Spark. Only the codebooks come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import keep, longs, table
from tidemark.operators.joins import heavy_keys, salted_join

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
# magnitude of components, at most: the sums of a batch fit 64 bits
LARGEST = 2.0**37
# rows whose distances are computed together
ROWS = 2048

Book = np.ndarray  # (parts, entries, width), whole numbers


@cache
def sequency_order(width: int) -> np.ndarray:
    """The rows of the Hadamard matrix of a power of two, by their number of sign changes.

    Row r of the matrix in natural order has the Walsh function whose sequency is the inverse
    Gray code of r's bits in reverse.
    """
    bits = width.bit_length() - 1
    order = np.zeros(width, np.int64)
    for r in range(width):
        gray = int(f"{r:0{bits}b}"[::-1], 2) if bits else 0
        sequency = gray
        while gray := gray >> 1:
            sequency ^= gray
        order[sequency] = r
    return order


def transform(parts: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of the last axis, filled up with zeros, in sequency order."""
    size = parts.shape[-1]
    width = 1 << max(0, size - 1).bit_length()
    out = np.zeros((*parts.shape[:-1], width), parts.dtype)
    out[..., :size] = parts
    step = 1
    while step < width:
        pairs = out.reshape(*out.shape[:-1], width // (2 * step), 2, step)
        low, high = pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]
        pairs[..., 0, :], pairs[..., 1, :] = low, high
        step *= 2
    return out[..., sequency_order(width)]


def _exact(parts: np.ndarray, book: Book) -> tuple[np.ndarray, Book]:
    """Both as 64-bit numbers where no sum of squares can overflow, else as Python's integers."""
    width = 1 << max(0, book.shape[-1] - 1).bit_length()
    high = max((int(np.abs(x).max(initial=0)) for x in (parts, book)), default=0)
    # width coefficients of at most width x 2 high each, squared
    if width**3 * (2 * high) ** 2 < 1 << 63:
        return parts, book
    return parts.astype(object), book.astype(object)


def nearest(parts: np.ndarray, book: Book) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part (rows, parts, width), ties to the lower, and its distance."""
    parts, book = _exact(parts, book)
    codes, errors = [], []
    for begin in range(0, len(parts), ROWS):
        code, error = _nearest(transform(parts[begin : begin + ROWS]), transform(book))
        codes.append(code)
        errors.append(error)
    if not codes:
        return np.zeros(parts.shape[:2], np.int64), np.zeros(parts.shape[:2], np.int64)
    return np.concatenate(codes), np.concatenate(errors)


def _nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``nearest`` of transformed parts (rows, parts, width) and entries (parts, entries, width)."""
    rows, parts, width = x.shape
    entries = c.shape[1]
    cells = rows * parts
    flat, part_of = x.reshape(cells, width), np.tile(np.arange(parts), rows)

    def distances(cell: np.ndarray, entry: np.ndarray, begin: int, end: int) -> np.ndarray:
        gap = flat[cell, begin:end] - c[part_of[cell], entry, begin:end]
        return (gap * gap).sum(axis=1)

    # the first coefficient of every entry; the nearest by it gives the first whole distance
    first = flat[:, None, 0] - c[part_of, :, 0]
    partial = first * first
    guess = partial.argmin(axis=1)
    everyone = np.arange(cells)
    bound = partial[everyone, guess] + distances(everyone, guess, 1, width)
    cell, entry = np.divmod(np.flatnonzero((partial <= bound[:, None]).ravel()), entries)
    sums = partial[cell, entry]
    begin = 1
    while begin < width:
        end = min(width, 2 * begin)
        sums = sums + distances(cell, entry, begin, end)
        stays = sums <= bound[cell]
        cell, entry, sums = cell[stays], entry[stays], sums[stays]
        begin = end
    # whole distances now, sorted by cell and entry: of the nearest the first
    starts = np.flatnonzero(np.diff(cell, prepend=-1))
    least = np.minimum.reduceat(sums, starts)
    hits = np.flatnonzero(sums == np.repeat(least, np.diff(starts, append=len(cell))))
    code = entry[hits[np.unique(cell[hits], return_index=True)[1]]]
    return code.reshape(rows, parts), (least // width).reshape(rows, parts)


def usable(embedding: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    lost = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~lost, F.lit(False))


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, dims, values) of the usable rows; ``values`` are 64-bit whole numbers."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).filter(usable(F.col("embedding")))
    refused = F.raise_error(F.lit("a component is too large for whole numbers of 64 bits"))
    whole = F.transform(
        "embedding",
        lambda x: F.when(F.abs(x) < LARGEST, F.floor(x * SCALE)).otherwise(refused.cast("long")),
    )
    return rows.select(
        "vec_id", "label", F.size("embedding").cast("long").alias("dims"), whole.alias("values")
    )


def cut(values: pa.Array, width: int) -> np.ndarray:
    """List values as (rows, PARTS, width), short vectors filled up with zeros."""
    flat = values.flatten().to_numpy(zero_copy_only=False)
    dims = values.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(dims), PARTS * width), np.int64)
    if len(dims) and (dims == PARTS * width).all():
        out = flat.reshape(len(dims), -1).astype(np.int64)
    else:
        begins = np.cumsum(dims) - dims
        row = np.repeat(np.arange(len(dims)), dims)
        out[row, np.arange(len(flat)) - begins[row]] = flat
    return out.reshape(len(dims), PARTS, width)


def part_sums(rows: DataFrame, book: Book) -> DataFrame:
    """(part, entry, place, total, n): the sum of the parts of each entry, and their number."""
    parts, entries, width = book.shape
    schema = pa.schema(
        [("part", pa.int32()), ("entry", pa.int32()), ("totals", pa.list_(pa.int64())), ("n", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = cut(batch.column("values"), width)
            code, _ = nearest(values, book)
            cell = (code + np.arange(parts) * entries).ravel()
            order = np.argsort(cell, kind="stable")
            starts = np.flatnonzero(np.diff(cell[order], prepend=-1))
            sums = np.add.reduceat(values.reshape(-1, width)[order], starts, axis=0)
            found = cell[order][starts]
            n = np.diff(starts, append=len(cell))
            yield table(schema, found // entries, found % entries, list(sums), n)

    made = rows.select("values").mapInArrow(
        run, "part int, entry int, totals array<long>, n long"
    )
    placed = made.select("part", "entry", "n", F.posexplode("totals").alias("place", "total"))
    return placed.groupBy("part", "entry", "place").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")
    )


@dataclass(frozen=True)
class Codebooks:
    book: Book

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and place, as decimal numbers."""
        return hashlib.sha256(",".join(map(str, self.book.ravel().tolist())).encode()).hexdigest()


def learn(rows: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> Codebooks:
    """Codebooks of a table made by :func:`whole_vectors`.

    They start as the parts of the ``entries`` smallest vec_ids (of rows that share one the
    smaller vector first, rows without vec_id last; fewer rows give fewer entries), and each round
    puts every entry at the mean of its parts, rounded down. Entries without parts stay.
    """
    dims = rows.agg(F.max("dims")).first()[0] or 0
    width = max(1, -(-dims // PARTS))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "values").limit(entries)
    start = [r["values"] for r in first.select("values").collect()]
    values = pa.array(start, pa.list_(pa.int64()))
    book = np.ascontiguousarray(cut(values, width).transpose(1, 0, 2))
    for _ in range(rounds if start else 0):
        # PARTS x entries x width rows
        for r in part_sums(rows, book).collect():
            book[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return Codebooks(book)


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error): two hexadecimal digits per part, and the squared distance."""
    book = books.book
    schema = pa.schema(
        [("vec_id", pa.int64()), ("label", pa.string()), ("code", pa.string()), ("error", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            code, error = nearest(cut(batch.column("values"), book.shape[2]), book)
            names = [row.tobytes().hex() for row in code.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    pa.array(names, pa.string()),
                    pa.array(error.sum(axis=1).tolist(), pa.int64()),
                ],
                schema=schema,
            )

    made = rows.select("vec_id", "label", "values")
    return made.mapInArrow(run, "vec_id long, label string, code string, error long")


def decode(codes: DataFrame, books: Codebooks, dims: int) -> DataFrame:
    """``codes`` (with a column ``code``) and ``approximation``: the vector that the entries make."""
    book = F.array(*[
        F.array(*[F.array(*[F.lit(int(x)) for x in entry]) for entry in part])
        for part in books.book
    ])
    part = F.sequence(F.lit(0), F.lit(PARTS - 1))

    def entry(p: Column) -> Column:
        return F.conv(F.substring(F.col("code"), 2 * p + 1, F.lit(2)), 16, 10).cast("int")

    whole = F.flatten(F.transform(part, lambda p: book[p][entry(p)]))
    vector = F.transform(F.slice(whole, 1, dims), lambda x: x.cast("double") / SCALE)
    return codes.withColumn("approximation", vector)


def compress(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable row of ``vectors``.

    ``vectors`` has vec_id, embedding and label; other columns are ignored. Rows whose vector is
    null or holds a null or non-finite component are left out. ``error`` is the squared distance
    to the approximation, in units of 1/4096 squared, ``label_error`` its sum over all rows with
    the label, null labels together. Vectors that cannot be cut into equal parts, or are shorter
    than the longest, count as filled up with zeros. Rows that repeat a vec_id are rows of their
    own. Components of 2^37 or more, and errors that do not fit a long, are refused with an error.
    An empty table gives an empty result.
    """
    rows = keep(whole_vectors(vectors), "whole-vectors")
    books = learn(rows)
    coded = keep(encode(rows, books), "vector-codes")
    key = F.coalesce(F.concat(F.lit("="), F.col("label")), F.lit(""))
    keyed = coded.select("vec_id", "code", "error", key.alias("key"))
    sums = keyed.groupBy(F.col("key").alias("sum_key")).agg(F.sum("error").alias("label_error"))
    return salted_join(keyed, sums, "key", "sum_key", hot=heavy_keys(keyed, "key")).select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256")
    )


def _oracle(rounds: int = ROUNDS) -> str:
    """The same rows in DuckDB's SQL, a pair of common tables per round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
assigned{r} as materialized (
    select vec_id, part, entry, gap from (
        select vec_id, part, entry, gap,
            row_number() over (partition by vec_id, part order by gap, entry) as place
        from (
            select v.vec_id, v.part, b.entry, sum((v.value - b.value) * (v.value - b.value)) as gap
            from cells v join book{r} b on v.part = b.part and v.pos = b.pos
            group by v.vec_id, v.part, b.entry
        )
    ) where place = 1
)""")
        if r < rounds:
            steps.append(f"""
book{r + 1} as materialized (
    select b.part, b.entry, b.pos, coalesce(s.value, b.value) as value
    from book{r} b left join (
        select v.part, a.entry, v.pos,
            (sum(v.value) - ((sum(v.value) % count(*)) + count(*)) % count(*)) // count(*) as value
        from cells v join assigned{r} a on v.vec_id = a.vec_id and v.part = a.part
        group by v.part, a.entry, v.pos
    ) s on b.part = s.part and b.entry = s.entry and b.pos = s.pos
)""")
    return f"""
with kept as materialized (
    select vec_id, label, embedding from embeddings
    where embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
cells as materialized (
    select vec_id, (i - 1) // (len(embedding) // {PARTS}) as part, (i - 1) % (len(embedding) // {PARTS}) as pos,
        cast(floor(cast(embedding[i] as double) * {SCALE}) as hugeint) as value
    from kept, unnest(range(1, len(embedding) + 1)) as u(i)
),
book0 as materialized (
    select c.part, s.entry, c.pos, c.value from cells c join (
        select vec_id, row_number() over (order by vec_id) - 1 as entry from kept
        order by vec_id limit {ENTRIES}
    ) s on c.vec_id = s.vec_id
),{",".join(steps)},
coded as (
    select k.vec_id, k.label, string_agg(printf('%02x', cast(a.entry as bigint)), '' order by a.part) as code,
        cast(sum(a.gap) as bigint) as error
    from kept k join assigned{rounds} a on k.vec_id = a.vec_id group by k.vec_id, k.label
)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
    (select sha256(string_agg(cast(value as varchar), ',' order by part, entry, pos)) from book{rounds})
        as codebooks_sha256
from coded
"""


ORACLE = _oracle()
