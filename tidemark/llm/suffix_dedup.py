"""Repeated passages by prefix-free parsing and suffix order.

A byte goes when it is covered by a string of ``LENGTH`` bytes that also starts anywhere
else. Two suffixes of the corpus share such a string exactly when their common
prefix is at least that long, so the suffix order of the corpus is needed only down to
that depth, and equal names can stand for equal ranks.

*Parse.* A rolling hash of 8 bytes is computed at every position. For every window
start, the smallest hash among the next ``SPAN`` positions is the trigger of that window;
the triggers depend on the window's own bytes alone, so equal strings have equal
triggers, and a phrase begins at every trigger. (A trigger at a fixed residue of the
hash can leave a string without any; the minimum cannot.)

*Parse order.* The suffix at each trigger is named by the bytes that every window of the
trigger contains, and once more by all bytes that any window of it can contain. Sorting
by these names puts equal suffixes next to each other. A trigger whose short
name is unique has no repeated window, and one whose long name repeats has only
repeated windows. On ordinary text this decides nearly everything, and only two
64-bit names per phrase were shuffled.

*Dictionary order.* The remaining triggers, and one witness for each repeated long
name, are sorted by short name together with the bytes before and after it. There every
suffix of the part before the trigger (the dictionary's suffixes) is combined with
the order of what follows it (the parse's suffixes), which decides each single window.

*Crowded names.* The windows of a name that very many triggers share, as those at the edges
of a passage in very many texts, do not meet by name. Each is a row under the hash of its own
bytes, and a task decides by itself those that it sees twice and sends on one row of them.

Identical texts count once, with the fact that they have copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import fresh, group_slices, keep, longs, raw_texts, table

LENGTH = 200
SPAN = 128
GRAM = 8
# bytes from the trigger on that all windows of a trigger contain
SHORT = LENGTH - SPAN + 1
# rows of one short name that are looked at together; beyond, its windows go one by one
CROWD = 4096
# windows of crowded names that a task compares before it sends them on, about
WINDOWS = 1 << 19
# rows whose windows are compared at a time, about
GROUPED = 2000
# texts of a batch are read in portions of this many bytes
PORTION = 4 << 20

UNRESOLVED, RESOLVED, WITNESS = 0, 1, 2
ASKED, SHOWN, SETTLED = 0, 1, 2
_KNOWN = 1 << 15
_MIX = np.uint64(0x9E3779B97F4A7C15)


def content_id(text: Column) -> Column:
    """The 64-bit name of a text."""
    return F.xxhash64(text)


def _window_triggers(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Triggers of a text with the first and last window start that belong to each."""
    size = len(text)
    octets = np.frombuffer(text, np.uint8)
    grams = np.lib.stride_tricks.sliding_window_view(octets, GRAM)
    hashes = np.ascontiguousarray(grams).view(np.uint64).ravel() * _MIX
    hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    count = size - LENGTH + 1
    used = count + SPAN - 1
    keys = np.full(-(-used // SPAN) * SPAN, np.iinfo(np.uint64).max)
    # leftmost of equal hashes: the position is the lower half of the key
    keys[:used] = (hashes[:used] >> np.uint64(32) << np.uint64(32)) | np.arange(
        used, dtype=np.uint64
    )
    blocks = keys.reshape(-1, SPAN)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:count], ahead[SPAN - 1 : SPAN - 1 + count])
    trigger = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.diff(trigger, prepend=-1))
    last = np.append(first[1:] - 1, count - 1)
    return trigger[first], first, last


def phrases(docs: DataFrame) -> DataFrame:
    """(name, deep, cid, pack) per trigger of all texts (columns text, cid) of LENGTH or more bytes.

    ``pack`` holds the trigger and how far before it its first and last window start.
    Copies of a text within a task are read once. Of more than two equal long names in
    a batch the others are marked as known and spread, so that a passage in very many
    documents does not meet in one task.
    """
    schema = pa.schema([(c, pa.int64()) for c in ("name", "deep", "cid", "pack")])
    digest = xxhash.xxh3_64_intdigest

    def parse(some: list[tuple[int, bytes]]) -> pa.RecordBatch | None:
        rows = [np.zeros((0, 4), np.int64)]
        for cid, text in some:
            trigger, first, last = _window_triggers(text)
            at = trigger.tolist()
            names = np.array([digest(text[t : t + SHORT]) for t in at], np.uint64)
            deep = [
                digest(text[t - SPAN + 1 : t + LENGTH])
                if t >= SPAN - 1 and t + LENGTH <= len(text)
                else digest(b"%d %d" % (cid, t))
                for t in at
            ]
            pack = trigger << 16 | (trigger - first) << 8 | (trigger - last)
            columns = [
                names.view(np.int64),
                np.array(deep, np.uint64).view(np.int64),
                np.full(len(at), cid),
                pack,
            ]
            rows.append(np.stack(columns, axis=1))
        rows = np.concatenate(rows)
        if not len(rows):
            return None
        order = np.argsort(rows[:, 1], kind="stable")
        sorted_deep = rows[order, 1]
        new = np.flatnonzero(np.diff(sorted_deep, prepend=sorted_deep[0] - 1))
        place = np.arange(len(order)) - np.repeat(new, np.diff(new, append=len(order)))
        known = order[place >= 2]
        rows[known, 3] |= _KNOWN
        spread = rows[known, 2].view(np.uint64) * _MIX + rows[known, 3].view(np.uint64)
        rows[known, 0] = (spread * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)
        return table(schema, *rows.T)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            some, size = [], 0
            ids = longs(batch, "cid").tolist()
            for cid, text in zip(ids, raw_texts(batch.column("text"))):
                if len(text) < LENGTH or cid in seen:
                    continue
                seen.add(cid)
                some.append((cid, text))
                size += len(text)
                if size >= PORTION:
                    yield parse(some)
                    some, size = [], 0
            if some:
                yield parse(some)

    return docs.select("text", "cid").mapInArrow(run, "name long, deep long, cid long, pack long")


def parse_order(rows: DataFrame) -> DataFrame:
    """(cid, pack, name, status) of the triggers whose short name repeats."""
    schema = pa.schema(
        [("cid", pa.int64()), ("pack", pa.int64()), ("name", pa.int64()), ("status", pa.int32())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the last row waits until it is known whether the next one equals it
        held, held_name, held_deep = np.zeros((0, 4), np.int64), False, False
        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = np.stack([longs(batch, c) for c in ("name", "deep", "cid", "pack")], axis=1)
            block = np.concatenate([held, fresh])
            again = np.zeros(len(block), bool)
            again[1:] = (block[1:] == block[:-1]).all(axis=1)
            block = block[~again]
            name, deep = _as_before(block, held_name, held_deep)
            yield _marked(schema, block[:-1], name, deep)
            held, held_name, held_deep = block[-1:], name[-1], deep[-1]
        if len(held):
            name, deep = np.array([held_name]), np.array([held_deep])
            yield _marked(schema, held, name, deep)

    return (
        rows.repartition("name")
        .sortWithinPartitions("name", "deep", "cid", "pack")
        .mapInArrow(run, "cid long, pack long, name long, status int")
    )


def _as_before(
    block: np.ndarray, first_name: bool, first_deep: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Whether each row has the name, and the long name, of the row before it."""
    name = np.concatenate([[first_name], block[1:, 0] == block[:-1, 0]])
    deep = np.concatenate([[first_deep], name[1:] & (block[1:, 1] == block[:-1, 1])])
    return name, deep


def _marked(
    schema: pa.Schema, rows: np.ndarray, name: np.ndarray, deep: np.ndarray
) -> pa.RecordBatch:
    """``name`` and ``deep`` may have one entry more, that of the row after the last."""
    pad = np.zeros(len(rows) + 1 - len(name), bool)
    after_name, after_deep = np.concatenate([name[1:], pad]), np.concatenate([deep[1:], pad])
    name, deep = name[: len(rows)], deep[: len(rows)]
    repeats, resolved = name | after_name, deep | after_deep
    status = np.where(resolved, np.where(deep, RESOLVED, WITNESS), UNRESOLVED)
    known = rows[:, 3] & _KNOWN > 0
    status[known] = RESOLVED
    some = repeats | known
    rows = rows[some]
    return table(schema, rows[:, 2], rows[:, 3] & ~_KNOWN, rows[:, 0], status[some])


def contexts(candidates: DataFrame) -> DataFrame:
    """(name, cid, start, lead, context) of the triggers that are still open.

    ``start`` is the first window, ``lead`` how far it starts before the trigger, and
    ``context`` the bytes of all windows without those that the name stands for: every
    window is one string of SPAN - 1 bytes of it. Crowded names are left to ``windows``.
    """
    kinds = [("name", pa.int64()), ("cid", pa.int64()), ("start", pa.int64())]
    schema = pa.schema([*kinds, ("lead", pa.int64()), ("context", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for found in _open(batch, False):
                rows.append(found)
                if len(rows) >= 20_000:
                    yield table(schema, *zip(*rows))
                    rows = []
            if rows:
                yield table(schema, *zip(*rows))

    return candidates.select("cid", "text", "marks").mapInArrow(
        run, "name long, cid long, start long, lead long, context binary"
    )


def _open(batch: pa.RecordBatch, crowded: bool) -> Iterator[tuple[int, int, int, int, bytes]]:
    """(name, cid, start, lead, context) of the open triggers, crowded or not, of a batch."""
    for cid, text, own in zip(
        longs(batch, "cid").tolist(), raw_texts(batch.column("text")), batch.column("marks")
    ):
        for mark in own.as_py():
            if mark["status"] == RESOLVED or mark["crowded"] != crowded:
                continue
            t, far, near = _unpack(mark["pack"])
            context = text[t - far : t] + text[t + SHORT : t + LENGTH - near]
            yield mark["name"], cid, t - far, far, context


def _unpack(pack):
    return pack >> 16, pack >> 8 & 127, pack & 127


@cache
def _octet_names() -> np.ndarray:
    return np.random.default_rng(29).integers(0, 1 << 63, 256, np.uint64) * 2 + 1


def _window_names(buffer: bytes) -> np.ndarray:
    """The polynomial hash of the SPAN - 1 bytes from each position of the buffer on."""
    width = SPAN - 1
    base = np.uint64(0xD1342543DE82EF95)
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    size = len(buffer)
    powers = np.full(size, base)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(_octet_names()[np.frombuffer(buffer, np.uint8)] * powers, out=sums[1:])
    back = np.full(size - width + 1, inverse)
    back[0] = 1
    return (sums[width:] - sums[: size - width + 1]) * np.multiply.accumulate(back)


def _coded(
    name: np.ndarray, lead: np.ndarray, held: list[bytes], some: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window of ``some`` contexts the row, its place there and the hash of its bytes."""
    sizes = np.fromiter(map(len, held), np.int64, len(held))
    begins = np.cumsum(sizes) - sizes
    windows = np.where(some, sizes - (SPAN - 1) + 1, 0)
    row = np.repeat(np.arange(len(held)), windows)
    step = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    code = _window_names(b"".join(held))[begins[row] + step]
    distance = (lead[row] - step).astype(np.uint64)
    code = (code ^ name.view(np.uint64)[row] * _MIX) + distance
    code *= np.uint64(0xBF58476D1CE4E5B9)
    code ^= code >> np.uint64(31)
    return row, step, code


def _repeated(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which codes come more than once, and one place of each of these."""
    order = np.argsort(code, kind="stable")
    equal = code[order][1:] == code[order][:-1]
    repeated = np.zeros(len(code), bool)
    repeated[order[1:][equal]] = True
    repeated[order[:-1][equal]] = True
    return repeated, order[:-1][equal & ~np.concatenate([[False], equal[:-1]])[: len(equal)]]


def _runs(row: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and last of runs of neighbouring windows of a row."""
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (where[1:] != where[:-1] + 1)
    first = np.flatnonzero(new)
    return first, np.append(first[1:] - 1, len(row) - 1)


def dictionary_order(rows: DataFrame) -> DataFrame:
    """(cid, start, stop): runs of window starts that are repeated, decided one by one."""
    schema = pa.schema([(c, pa.int64()) for c in ("cid", "start", "stop")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in group_slices(batches, ["name"], GROUPED):
            name, lead = longs(batch, "name"), longs(batch, "lead")
            cid, start = longs(batch, "cid"), longs(batch, "start")
            # a row that came twice counts once
            twice = np.zeros(len(cid), bool)
            twice[1:] = (
                (name[1:] == name[:-1]) & (cid[1:] == cid[:-1]) & (start[1:] == start[:-1])
            )
            row, step, code = _coded(name, lead, batch.column("context").to_pylist(), ~twice)
            hit = np.flatnonzero(_repeated(code)[0])
            if not len(hit):
                continue
            row, where = row[hit], start[row[hit]] + step[hit]
            first, last = _runs(row, where)
            yield table(schema, cid[row[first]], where[first], where[last])

    return (
        rows.repartition("name")
        .sortWithinPartitions("name", "cid", "start")
        .mapInArrow(run, "cid long, start long, stop long")
    )


def windows(candidates: DataFrame) -> DataFrame:
    """(code, cid, start, stop, kind) of the open windows of crowded names.

    Of windows that a task sees twice, one goes on as SHOWN, and the runs of all as SETTLED;
    any other is ASKED. So a window in however many texts gives one row per task and
    WINDOWS windows.
    """
    schema = pa.schema([(c, pa.int64()) for c in ("code", "cid", "start", "stop", "kind")])

    def decided(rows: list) -> pa.RecordBatch:
        # a row that came twice counts once
        name, cid, start, lead, held = zip(*{r[1:3]: r for r in rows}.values())
        name, cid, start, lead = (np.array(c, np.int64) for c in (name, cid, start, lead))
        row, step, code = _coded(name, lead, list(held), np.ones(len(cid), bool))
        where = start[row] + step
        repeated, shown = _repeated(code)
        code = code.view(np.int64)
        parts = [
            (code[some], cid[row[some]], where[some], where[some], np.full(len(some), kind))
            for some, kind in ((np.flatnonzero(~repeated), ASKED), (shown, SHOWN))
        ]
        row, where = row[repeated], where[repeated]
        if len(row):
            first, last = _runs(row, where)
            own = cid[row[first]]
            # spread
            key = (own.view(np.uint64) + where[first].view(np.uint64)) * _MIX
            settled = np.full(len(first), SETTLED)
            parts.append((key.view(np.int64), own, where[first], where[last], settled))
        return table(schema, *map(np.concatenate, zip(*parts)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for found in _open(batch, True):
                rows.append(found)
                size += len(found[4]) - (SPAN - 1) + 1
                if size >= WINDOWS:
                    yield decided(rows)
                    rows, size = [], 0
        if rows:
            yield decided(rows)

    crowds = candidates.filter(F.exists("marks", lambda m: m["crowded"]))
    return crowds.select("cid", "text", "marks").mapInArrow(
        run, "code long, cid long, start long, stop long, kind long"
    )


def settled(rows: DataFrame) -> DataFrame:
    """(cid, start, stop) as ``dictionary_order``, of ``windows``; a code's rows are never gathered."""
    schema = pa.schema([(c, pa.int64()) for c in ("cid", "start", "stop")])

    def told(block: np.ndarray, some: np.ndarray) -> pa.RecordBatch:
        return table(schema, *block[some, 1:4].T)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the last row waits until it is known whether the next one equals it
        held, held_before = np.zeros((0, 5), np.int64), False
        for batch in batches:
            block = np.stack([longs(batch, c) for c in batch.schema.names], axis=1)
            yield told(block, block[:, 4] == SETTLED)
            block = np.concatenate([held, block[block[:, 4] != SETTLED]])
            again = np.zeros(len(block), bool)
            again[1:] = (block[1:, :3] == block[:-1, :3]).all(axis=1)
            block = block[~again]
            if not len(block):
                continue
            before = np.concatenate([[held_before], block[1:, 0] == block[:-1, 0]])
            several = before[:-1] | before[1:]
            yield told(block[:-1], several & (block[:-1, 4] == ASKED))
            held, held_before = block[-1:], bool(before[-1])
        if len(held):
            yield told(held, np.array([held_before]) & (held[:, 4] == ASKED))

    return (
        rows.repartition("code")
        .sortWithinPartitions("code", "cid", "start")
        .mapInArrow(run, "cid long, start long, stop long")
    )


def _spans(text: bytes, marks: list, ranges: list) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes from resolved triggers and runs of window starts."""
    found = [(r["start"], r["stop"] + LENGTH) for r in ranges or ()]
    for mark in marks:
        if mark["status"] != UNRESOLVED:
            t, far, near = _unpack(mark["pack"])
            found.append((t - far, t - near + LENGTH))
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What goes from the texts: (facts per document, results per distinct text).

    The facts hold doc_id, cid, n_bytes, sha256 and copied (the text occurs more than once
    and is long enough to go). The results hold cid, n_removed, n_spans and kept (bytes),
    for texts that lose anything.
    """
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("cid", content_id(F.col("text")))
    facts = keep(
        base.select(
            "doc_id",
            "cid",
            F.octet_length("text").cast("long").alias("n_bytes"),
            F.sha2(F.col("text").cast("binary"), 256).alias("sha256"),
        ),
        "text-facts",
    )
    marks = keep(parse_order(phrases(base)), "phrase-marks")
    crowded = keep(
        marks.filter(F.col("status") != RESOLVED)
        .groupBy("name")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > CROWD)
        .select("name", F.lit(True).alias("crowded")),
        "crowded-names",
    )
    mark = F.struct("pack", "name", "status", F.coalesce("crowded", F.lit(False)).alias("crowded"))
    per_text = (
        marks.join(crowded, "name", "left").groupBy("cid").agg(F.collect_list(mark).alias("marks"))
    )
    # one document stands for each distinct text; null-safe, as ids may be missing
    stands = facts.groupBy("cid").agg(F.min("doc_id").alias("stand"))
    wanted = per_text.join(stands, "cid").withColumnRenamed("cid", "text_id")
    candidates = keep(
        base.join(
            wanted, (F.col("cid") == F.col("text_id")) & F.col("doc_id").eqNullSafe(F.col("stand"))
        ).select("cid", "text", "marks"),
        "candidate-texts",
    )
    runs = keep(
        dictionary_order(contexts(candidates)).union(settled(windows(candidates))),
        "repeated-windows",
    )
    per_run = runs.groupBy("cid").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))

    schema = pa.schema(
        [("cid", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
         ("kept", pa.binary())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for cid, text, own, more in zip(
                longs(batch, "cid").tolist(),
                raw_texts(batch.column("text")),
                batch.column("marks"),
                batch.column("ranges"),
            ):
                spans = _spans(text, own.as_py(), more.as_py())
                if not spans:
                    continue
                ends = [0, *[b for _, b in spans]]
                kept = b"".join(text[a:b] for a, b in zip(ends, [*[a for a, _ in spans], None]))
                rows.append((cid, len(text) - len(kept), len(spans), kept))
            if rows:
                yield table(schema, *zip(*rows))

    joined = candidates.join(per_run, "cid", "left")
    results = keep(
        joined.mapInArrow(cut, "cid long, n_removed long, n_spans long, kept binary"),
        "cut-texts",
    ).dropDuplicates(["cid"])
    copies = (
        facts.groupBy("cid")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("cid", F.lit(True).alias("many"))
    )
    known = facts.join(copies, "cid", "left").withColumn(
        "copied", F.coalesce("many", F.lit(False)) & (F.col("n_bytes") >= LENGTH)
    )
    return known.drop("many"), results


def removed(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every document.

    Texts are UTF-8 bytes, null counts as empty; matches never cross documents. A byte goes
    if a string of 200 bytes that covers it also starts anywhere else, in the same
    document as well; all strings are judged on the input. A repeated row is another
    document with the same text. Other columns are ignored.
    """
    facts, results = repeats(docs)
    small = results.select("cid", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    none = F.sha2(F.lit("").cast("binary"), 256)
    return facts.join(small, "cid", "left").select(
        "doc_id",
        "n_bytes",
        F.when(F.col("copied"), F.col("n_bytes"))
        .otherwise(F.coalesce("n_removed", F.lit(0)))
        .alias("n_removed"),
        F.when(F.col("copied"), F.lit(1))
        .otherwise(F.coalesce("n_spans", F.lit(0)))
        .cast("long")
        .alias("n_spans"),
        F.when(F.col("copied"), none)
        .otherwise(F.coalesce("kept_sha256", "sha256"))
        .alias("kept_sha256"),
    )


def cleaned(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text``; all rows and columns stay.

    ``n_chars`` follows where the text changes. What is left of a character that was
    cut in two becomes U+FFFD. Texts that lose nothing stay as they are, null included.
    """
    facts, results = repeats(docs)
    cid, kept = fresh(docs, "text_id"), fresh(docs, "kept_text")
    copied = facts.filter("copied").select("cid").distinct()
    gone = copied.select(F.col("cid").alias(cid), F.lit("").alias(kept))
    shorter = results.join(copied, "cid", "left_anti").select(
        F.col("cid").alias(cid), F.make_valid_utf8(F.col("kept").cast("string")).alias(kept)
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    joined = docs.withColumn(cid, content_id(text)).join(gone.union(shorter), cid, "left")
    changed = F.col(kept).isNotNull()
    new = {"text": F.when(changed, F.col(kept)).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        size = F.length(kept).cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(changed, size).otherwise(F.col("n_chars"))
    return joined.withColumns(new).select(docs.columns)
