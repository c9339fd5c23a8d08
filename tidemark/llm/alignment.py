"""Alignment of two tokenizers on the same bytes, by fragments that compose.

Both tokenizers encode a space and the text. Where both have a token end, the bytes are cut into
groups; an A and a B token are linked where their bytes overlap. A byte range of a document
yields a *fragment*: an open prefix, closed groups, and an open suffix. What is open are the bytes
before the first and after the last sure cut of the range, a space between two other characters
over which neither tokenizer merges; what lies between them is closed and can be encoded without
the rest. Two neighbouring fragments compose to one: the left suffix and the right prefix join to
bytes that are closed on both sides, or, if a side has no cut, to a longer open end. Composing is
associative, so the fragments of a long document are composed in a tree, ``FAN`` neighbours per
task and level, whichever task made them. The beginning and the end of a document are cuts.

A document of at most ``CHUNK`` bytes is one fragment with nothing open. All closed bytes are
encoded and aligned by the same function; as both tokenizers treat the words between sure cuts
apart, what a worker finds out about a word (ids, groups, links) is remembered, up to a bound.

The links' document counts concern the whole corpus. Tasks number the id pairs of a *portion* of
documents, and count each document once; the counts of all portions are summed by pair, the
highest per A id is found, and the figures go back to the portions that have the pair. So a
document's links are shuffled as numbers within its portion, and no table of pairs is broadcast.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import keep, longs, sorted_groups
from tidemark.llm.tokens import encoder, flattened

SPACE = "▁"
# bytes of a document in a fragment
CHUNK = 1 << 16
# neighbouring fragments that compose to one
FAN = 16
# words that a worker remembers, before it starts afresh
REMEMBERED = 200_000
# bytes of text that are handled together
SLICE = 1 << 20
# a portion ends after about so many distinct pairs, or ten times as many words
PORTION = 400_000

# Between these two characters of UTF-8, ASCII signs and letters that are no white space and not
# U+2581 in any version of Unicode, a single space is a sure cut.
_BEFORE = rb"(?:(?<=[\x21-\x7e])|(?<=[\xc3-\xdf][\x80-\xbf])|(?<=[\xe4-\xed][\x80-\xbf][\x80-\xbf]))"
_AFTER = rb"(?=[\x21-\x7e\xc3-\xdf\xe4-\xed])"
CUT = re.compile(_BEFORE + b" " + _AFTER)
# the last cut: what follows holds none
_LAST = 1 << 10


def first_cut(data: bytes) -> int:
    found = CUT.search(data)
    return found.start() if found else -1


def last_cut(data: bytes) -> int:
    """The last sure cut, searched from the end in growing windows; -1 if there is none."""
    span = _LAST
    while True:
        begin = max(0, len(data) - span)
        found = None
        for found in CUT.finditer(data, begin):
            pass
        if found or not begin:
            return found.start() if found else -1
        span *= 8


Open = tuple[bytes, bytes | None]


def compose(left: Open, right: Open) -> tuple[Open, bytes | None]:
    """The open ends of two neighbouring fragments, and the bytes that close between them.

    A fragment's ends are (prefix, suffix); one without a cut is (bytes, None). Nothing closes
    unless both have a cut.
    """
    if left[1] is None:
        return (left[0] + right[0], right[1]), None
    if right[1] is None:
        return (left[0], left[1] + right[0]), None
    return (left[0], right[1]), left[1] + right[0]


def fragment(data: bytes, first: bool, last: bool) -> tuple[Open, bytes]:
    """The open ends and the closed middle of one byte range.

    The first range of a document begins, and the last one ends, with a cut. Closed bytes begin
    with a space, and their groups do not depend on anything around them.
    """
    begin = 0 if first else first_cut(data)
    end = len(data) if last else last_cut(data)
    if begin < 0 and end < 0:
        return (data, None), b""
    # a range without a cut inside still has the one at the document's beginning or end
    begin, end = (end if begin < 0 else begin), (begin if end < 0 else end)
    return (data[:begin], data[end:]), data[begin:end]


# --- words -------------------------------------------------------------------


def _byte_signs() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Words:
    """What both tokenizers make of words, one after the other in arrays.

    A word stands for a space and the word. Pairs are numbered: ``pair_keys`` has A id x 2^32 +
    B id of each.
    """

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = encoder(a_path, True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        signs = _byte_signs()
        vocabulary = self.a.tokenizer.get_vocab(with_added_tokens=True)
        a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            # an added token is its own text
            coded = all(c in signs for c in token)
            a_bytes[i] = bytes(signs[c] for c in token) if coded else token.encode()
        b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            data = bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else None
            b_bytes.append(piece.replace(SPACE, " ").encode() if data is None else data)
        self.a_sizes = np.fromiter(map(len, a_bytes), np.int64)
        self.b_sizes = np.fromiter(map(len, b_bytes), np.int64)
        self.a_bytes, self.b_bytes = (pa.array(x, pa.large_binary()) for x in (a_bytes, b_bytes))
        # every id as it is written, with the sign before it: A's ids, then B's
        a, b = (list(map(str, range(len(x)))) for x in (a_bytes, b_bytes))
        written = [sign + i for sign in ("", ";", ",") for i in a]
        written += [sign + i for sign in ("|", ",") for i in b]
        self.written = pa.array(written, pa.large_string()).cast(pa.large_binary())
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.groups: list[bytes] = []
        # n_a, n_b, n_groups, n_links and whether the bytes come back
        self.figures = np.zeros((1024, 5), np.int64)
        self.pair_at: dict[int, int] = {}
        self.pair_keys = np.zeros(1024, np.int64)
        # the pair of every link, and where each word's links begin
        self.links = np.zeros(4096, np.int32)
        self.begins = np.zeros(1025, np.int64)

    def look_up(self, words: list[str]) -> np.ndarray:
        """The places of distinct words."""
        at = self.at
        new = [w for w in words if w not in at]
        if new:
            self._learn(new)
        return np.fromiter((at[w] for w in words), np.int64, len(words))

    def _learn(self, new: list[str]) -> None:
        words = pa.array(new, pa.string())
        a_ids, a_n = self.a.learn(words)
        b_ids, b_n = flattened(self.b.encode(new, num_threads=1))
        a_ids, b_ids, a_n = a_ids.astype(np.int64), b_ids.astype(np.int64), a_n.astype(np.int64)
        nothing, space = (pa.scalar(x, pa.large_string()) for x in ("", " "))
        data = pc.binary_join_element_wise(nothing, words.cast(pa.large_string()), space)
        data = data.cast(pa.large_binary())
        same = [
            pc.equal(_joined(pieces.take(pa.array(ids)), n), data)
            for pieces, ids, n in ((self.a_bytes, a_ids, a_n), (self.b_bytes, b_ids, b_n))
        ]
        good = pc.and_(*same).to_numpy(zero_copy_only=False)
        # words that do not come back have no tokens
        a_ids, b_ids = a_ids[np.repeat(good, a_n)], b_ids[np.repeat(good, b_n)]
        a_n, b_n = a_n * good, b_n * good
        # all words side by side: every word begins and ends a group
        a_ends, b_ends = np.cumsum(self.a_sizes[a_ids]), np.cumsum(self.b_sizes[b_ids])
        a_starts = a_ends - self.a_sizes[a_ids]
        low = np.searchsorted(b_ends, a_starts, "right")
        high = np.searchsorted(b_ends, a_ends, "left")
        each = high - low + 1
        mate = np.repeat(low - (np.cumsum(each) - each), each) + np.arange(int(each.sum()))
        pairs = np.repeat(a_ids, each) << 32 | b_ids[mate]
        word_of_a = np.repeat(np.arange(len(new)), a_n)
        n_links = np.bincount(word_of_a, each, len(new)).astype(np.int64)
        # both end where the last linked B token ends
        a_closes = b_ends[high] == a_ends if len(a_ids) else np.zeros(0, bool)
        b_closes = np.zeros(len(b_ids), bool)
        b_closes[high[a_closes]] = True
        n_groups = np.bincount(word_of_a, a_closes, len(new)).astype(np.int64)
        self._keep(new, self._texts(a_ids, b_ids, a_n, b_n, a_closes, b_closes),
                   np.stack([a_n, b_n, n_groups, n_links, good], axis=1), pairs)

    def _texts(
        self,
        a_ids: np.ndarray,
        b_ids: np.ndarray,
        a_n: np.ndarray,
        b_n: np.ndarray,
        a_closes: np.ndarray,
        b_closes: np.ndarray,
    ) -> list[bytes]:
        """The groups of each word, ``a1,a2|b1`` joined by ``;``."""
        a_group, b_group = np.cumsum(a_closes) - a_closes, np.cumsum(b_closes) - b_closes
        a_stops, b_stops = (np.concatenate([[0], np.flatnonzero(c) + 1]) for c in (a_closes, b_closes))
        a_first, b_first = (np.diff(g, prepend=-1) > 0 for g in (a_group, b_group))
        # the written id of every token, at its place: A's of a group, then B's
        out = np.zeros(len(a_ids) + len(b_ids), np.int64)
        a_sign = np.where(a_first, 1, 2)
        a_sign[(np.cumsum(a_n) - a_n)[a_n > 0]] = 0
        vocabulary = len(self.a_bytes)
        out[np.arange(len(a_ids)) + b_stops[a_group]] = a_sign * vocabulary + a_ids
        b_sign = 3 * vocabulary + np.where(b_first, 0, len(self.b_bytes))
        out[np.arange(len(b_ids)) + a_stops[b_group + 1]] = b_sign + b_ids
        return _joined(self.written.take(pa.array(out)), a_n + b_n).to_pylist()

    def _keep(self, new: list[str], texts: list[bytes], figures: np.ndarray, pairs: np.ndarray) -> None:
        n, m = len(self.groups), len(self.pair_at)
        held = int(self.begins[n])
        distinct, inverse = np.unique(pairs, return_inverse=True)
        numbers = self.pair_at
        place = [numbers.setdefault(p, len(numbers)) for p in distinct.tolist()]
        place = np.array(place, np.int64)
        self.pair_keys = _room(self.pair_keys, len(numbers))
        fresh = place >= m
        self.pair_keys[place[fresh]] = distinct[fresh]
        self.links = _room(self.links, held + len(pairs))
        self.links[held : held + len(pairs)] = place[inverse]
        self.begins = _room(self.begins, n + len(new) + 1)
        self.begins[n + 1 : n + len(new) + 1] = held + np.cumsum(figures[:, 3])
        self.figures = _room(self.figures, n + len(new))
        self.figures[n : n + len(new)] = figures
        self.at.update(zip(new, range(n, n + len(new))))
        self.groups += texts


def _joined(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """Runs of binary values, each joined to one."""
    bounds = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int64())
    return pc.binary_join(pa.LargeListArray.from_arrays(bounds, values), pa.scalar(b"", pa.large_binary()))


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """``array`` with room for ``size`` rows; it at least doubles when it grows."""
    if size <= len(array):
        return array
    out = np.zeros((max(size, 2 * len(array)), *array.shape[1:]), array.dtype)
    out[: len(array)] = array
    return out


@cache
def _words(a_path: str, b_path: str) -> Words:
    """One per worker process."""
    return Words(a_path, b_path)


def split_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, the word at each place, and the number of words of each text.

    The texts begin where a space was taken off. A text is cut at single spaces; one with a
    space next to other white space only at sure cuts.
    """
    cut = pc.split_pattern(texts, " ")
    coded = cut.flatten().dictionary_encode()
    space = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}▁]"
    edged = pc.match_substring_regex(coded.dictionary, f"^$|^{space}|{space}$")
    edged = edged.to_numpy(zero_copy_only=False)
    at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = cut.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    words = coded.dictionary.to_pylist()
    odd = np.unique(np.searchsorted(np.cumsum(sizes), np.flatnonzero(edged[at]), "right"))
    if len(odd):
        known = {w: i for i, w in enumerate(words)}
        parts = np.split(at, np.cumsum(sizes)[:-1])
        for k in odd.tolist():
            found = [w.decode() for w in CUT.split(texts[k].as_py().encode())]
            parts[k] = np.array([known.setdefault(w, len(known)) for w in found], np.int64)
        words, at = list(known), np.concatenate(parts)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return words, at, sizes


# --- portions ----------------------------------------------------------------

# rows of kind PAIR: (portion, pair, a, b, n); rows of kind PART: the figures of closed bytes
_SCHEMA = pa.schema(
    [
        ("pair", pa.bool_()), ("portion", pa.string()), ("number", pa.int32()),
        ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64()),
        ("doc_id", pa.int64()), ("row", pa.int64()), ("place", pa.int64()), ("ok", pa.bool_()),
        ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
        ("digest", pa.string()), ("groups", pa.binary()), ("steps", pa.binary()), ("times", pa.binary()),
    ]
)
_COLUMNS = (
    "pair boolean, portion string, number int, a int, b int, n long, doc_id long, row long, "
    "place long, ok boolean, n_a long, n_b long, n_groups long, n_links long, digest string, "
    "groups binary, steps binary, times binary"
)


def _stepped(numbers: np.ndarray, times: np.ndarray) -> tuple[bytes, bytes]:
    """Ascending numbers as 16-bit steps, and how often each comes in 8 bits.

    A wide step is cut into several, and a large number of times dealt to several entries.
    """
    over = (np.maximum(times, 1) - 1) // 255
    if over.any():
        numbers = np.repeat(numbers, over + 1)
        dealt = np.full(len(numbers), 255)
        dealt[np.cumsum(over + 1) - 1] = times - 255 * over
        times = dealt
    steps = np.diff(numbers, prepend=0)
    wide = steps // 65535
    if wide.any():
        ends = np.cumsum(wide + 1) - 1
        spread, often = np.full(int(ends[-1]) + 1, 65535), np.zeros(int(ends[-1]) + 1, np.int64)
        spread[ends], often[ends] = steps - 65535 * wide, times
        steps, times = spread, often
    return steps.astype("<u2").tobytes(), times.astype(np.uint8).tobytes()


class _Portion:
    """The numbers of a portion's pairs, and how many documents have each."""

    def __init__(self, name: str, words: Words):
        self.name, self.words, self.held = name, words, 0
        self.number = np.full(1024, -1, np.int32)
        self.pairs: list[np.ndarray] = []
        self.size = 0
        self.documents = np.zeros(1024, np.int64)

    def numbers(self, pairs: np.ndarray) -> np.ndarray:
        """Numbers within the portion of a worker's pairs; new ones get the next."""
        have = len(self.number)
        if have < len(self.words.pair_at):
            self.number = _room(self.number, len(self.words.pair_at))
            self.number[have:] = -1
        new = np.unique(pairs[self.number[pairs] < 0])
        self.number[new] = np.arange(self.size, self.size + len(new))
        self.pairs.append(self.words.pair_keys[new])
        self.size += len(new)
        self.documents = _room(self.documents, self.size)
        return self.number[pairs].astype(np.int64)

    def rows(self) -> pa.RecordBatch:
        keys = np.concatenate([np.zeros(0, np.int64), *self.pairs])
        columns = {
            "pair": np.ones(len(keys), bool),
            "portion": [self.name] * len(keys),
            "number": np.arange(len(keys), dtype=np.int32),
            "a": (keys >> 32).astype(np.int32),
            "b": (keys & 0xFFFFFFFF).astype(np.int32),
            "n": self.documents[: len(keys)],
        }
        return _rows(len(keys), columns)


def _rows(n: int, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            (x if isinstance(x, pa.Array) else pa.nulls(n, f.type) if x is None else pa.array(x, f.type))
            for f, x in ((f, columns.get(f.name)) for f in _SCHEMA)
        ],
        schema=_SCHEMA,
    )


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in portions of about SLICE bytes of text."""
    for batch in batches:
        if batch.num_rows:
            sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
            slots = np.cumsum(sizes.astype(np.int64)) // SLICE
            starts = np.flatnonzero(np.diff(slots, prepend=-1)).tolist()
            for s, e in zip(starts, [*starts[1:], batch.num_rows]):
                yield batch.slice(s, e - s)


def measure(
    closed: DataFrame, a_path: str, b_path: str, remembered: int = REMEMBERED, size: int = PORTION
) -> DataFrame:
    """Rows of both kinds for closed bytes (doc_id, row, place, text).

    ``text`` lacks its first space; a null ``row`` says that it is a whole document. Parts of
    longer documents carry their groups, and their pairs are not counted here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(a_path, b_path)
        task = TaskContext.get().partitionId()
        portion, made = _Portion(f"{task}-0", words), 0
        for batch in _slices(batches):
            distinct, at, sizes = split_words(batch.column("text"))
            full = len(words.at) + len(distinct) > remembered
            if portion.size and (full or portion.size > size or portion.held > 10 * size):
                yield portion.rows()
                made += 1
                portion = _Portion(f"{task}-{made}", words)
            if full:
                words.clear()
                portion = _Portion(f"{task}-{made}", words)
            portion.held += len(at)
            yield _part_rows(batch, words, portion, words.look_up(distinct)[at], sizes)
        if portion.size:
            yield portion.rows()

    wanted = closed.select("doc_id", "row", "place", "text")
    return wanted.mapInArrow(run, _COLUMNS)


def _part_rows(
    batch: pa.RecordBatch, words: Words, portion: _Portion, at: np.ndarray, sizes: np.ndarray
) -> pa.RecordBatch:
    n = batch.num_rows
    ends = np.cumsum(sizes)
    text_of = np.repeat(np.arange(n), sizes)
    sums = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum(words.figures[at], axis=0)])
    figures = sums[ends] - sums[ends - sizes]
    ok = figures[:, 4] == sizes
    # the words of each text once, with their number, then their pairs
    keys, times = np.unique(text_of * len(words.groups) + at, return_counts=True)
    text, word = np.divmod(keys, len(words.groups))
    each = words.begins[word + 1] - words.begins[word]
    link = np.repeat(words.begins[word] - (np.cumsum(each) - each), each)
    link = words.links[link + np.arange(len(link))]
    text, times = np.repeat(text, each), np.repeat(times, each)
    good = ok[text]
    text, times, link = text[good], times[good], link[good]
    numbers = portion.numbers(link)
    room = max(1, portion.size)
    keys, back = np.unique(text * room + numbers, return_inverse=True)
    times = np.bincount(back, times, len(keys)).astype(np.int64)
    text, numbers = np.divmod(keys, room)
    whole = batch.column("row").is_null().to_numpy(zero_copy_only=False)
    portion.documents[: portion.size] += np.bincount(
        numbers[whole[text]], minlength=portion.size
    )[: portion.size]
    bounds = np.searchsorted(text, np.arange(n + 1)).tolist()
    digests, groups, steps, often = [], [], [], []
    known, places = words.groups, at.tolist()
    for k, (s, e) in enumerate(zip((ends - sizes).tolist(), ends.tolist())):
        joined = b";".join([known[w] for w in places[s:e]]) if ok[k] else None
        digests.append(hashlib.sha256(joined).hexdigest() if whole[k] and ok[k] else None)
        groups.append(None if whole[k] else joined)
        a, b = bounds[k], bounds[k + 1]
        x, y = _stepped(numbers[a:b], times[a:b])
        steps.append(x)
        often.append(y)
    names = ("n_a", "n_b", "n_groups", "n_links")
    columns = {
        "pair": np.zeros(n, bool),
        "portion": [portion.name] * n,
        **{c: batch.column(c) for c in ("doc_id", "row", "place")},
        "ok": ok,
        **{c: figures[:, i] for i, c in enumerate(names)},
        "digest": digests,
        "groups": groups,
        "steps": steps,
        "times": often,
    }
    return _rows(n, columns)


def link_sums(rows: DataFrame) -> DataFrame:
    """The PART rows with ``count_sum`` and ``n_best``.

    ``rows`` are both kinds, PAIR rows with the pair's corpus-wide ``n`` and ``best``. A portion's
    pairs come before its parts, so a task holds the pairs of one portion at a time.
    """
    names = ["doc_id", "row", "place", "ok", "n_a", "n_b", "n_groups", "n_links", "digest", "groups"]
    kinds = [_SCHEMA.field(c) for c in names]
    schema = pa.schema([*kinds, ("count_sum", pa.int64()), ("n_best", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = best = np.zeros(0, np.int64)
        now = None
        for batch in batches:
            if not batch.num_rows:
                continue
            portions = batch.column("portion").to_pylist()
            starts = [0] + [i for i in range(1, len(portions)) if portions[i] != portions[i - 1]]
            for s, e in zip(starts, [*starts[1:], len(portions)]):
                some = batch.slice(s, e - s)
                if portions[s] != now:
                    now, count, best = portions[s], np.zeros(1024, np.int64), np.zeros(1024, np.int64)
                pairs = some.filter(some.column("pair"))
                if pairs.num_rows:
                    number = longs(pairs, "number")
                    count, best = (_room(x, int(number.max()) + 1) for x in (count, best))
                    count[number] = longs(pairs, "n")
                    best[number] = longs(pairs, "best")
                parts = some.filter(pc.invert(some.column("pair")))
                if not parts.num_rows:
                    continue
                sums, bests = [], []
                for x, y in zip(parts.column("steps").to_pylist(), parts.column("times").to_pylist()):
                    number = np.cumsum(np.frombuffer(x, "<u2"), dtype=np.int64)
                    times = np.frombuffer(y, np.uint8)
                    # a cut step ends at a number that need not be a pair
                    number = number[times > 0]
                    times = times[times > 0].astype(np.int64)
                    sums.append(int((count[number] * times).sum()))
                    bests.append(int((best[number] * times).sum()))
                columns = [parts.column(c) for c in names]
                columns += [pa.array(sums, pa.int64()), pa.array(bests, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    spec = (
        "doc_id long, row long, place long, ok boolean, n_a long, n_b long, n_groups long, "
        "n_links long, digest string, groups binary, count_sum long, n_best long"
    )
    return (
        rows.repartition("portion")
        .sortWithinPartitions("portion", F.col("pair").desc())
        .mapInArrow(run, spec)
    )


# --- long documents ----------------------------------------------------------


def fragments(long_docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(row, place, prefix, suffix, closed) of every byte range of documents (row, text).

    The ranges are those of a space and the text. A null ``suffix`` says that there is no cut.
    """
    whole = F.concat(F.lit(b" "), F.col("text").cast("binary"))
    ranges = F.ceil((F.octet_length("text") + 1) / chunk).cast("int")
    ranged = (
        long_docs.select("row", whole.alias("data"), ranges.alias("ranges"))
        .withColumn("place", F.explode(F.sequence(F.lit(0), F.col("ranges") - 1)))
        .select(
            "row",
            F.col("place").cast("long").alias("place"),
            (F.col("place") == F.col("ranges") - 1).alias("last"),
            F.expr(f"substring(data, place * {chunk} + 1, {chunk})").alias("data"),
        )
    )
    schema = pa.schema(
        [("row", pa.int64()), ("place", pa.int64()), ("prefix", pa.binary()),
         ("suffix", pa.binary()), ("closed", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                fragment(data, place == 0, last)
                for place, last, data in zip(*(batch.column(c).to_pylist() for c in ("place", "last", "data")))
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("place"),
                    pa.array([o[0] for o, _ in found], pa.binary()),
                    pa.array([o[1] for o, _ in found], pa.binary()),
                    pa.array([c for _, c in found], pa.binary()),
                ],
                schema=schema,
            )

    # the ranges of a long document go to many tasks
    return ranged.repartition("row", "place").mapInArrow(
        run, "row long, place long, prefix binary, suffix binary, closed binary"
    )


def reduce_level(ends: DataFrame, width: int, fan: int = FAN) -> DataFrame:
    """One level of the tree over (row, place, prefix, suffix).

    ``fan`` neighbours, ``width`` places each, compose to one row with a null ``closed``; the
    bytes that close on the way are rows of their own, at the place of the fragment left of them.
    """
    schema = pa.schema(
        [("row", pa.int64()), ("place", pa.int64()), ("prefix", pa.binary()),
         ("suffix", pa.binary()), ("closed", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sorted_groups(batches, ["row", "parent"]):
            out: list[tuple] = []
            open_: tuple | None = None
            columns = ("row", "parent", "place", "prefix", "suffix")
            for row, parent, place, prefix, suffix in zip(
                *(batch.column(c).to_pylist() for c in columns)
            ):
                if open_ and open_[:2] == (row, parent):
                    ends, closed = compose(open_[3], (prefix, suffix))
                    if closed is not None:
                        out.append((row, place - 1, None, None, closed))
                    open_ = (row, parent, open_[2], ends)
                    continue
                if open_:
                    out.append((open_[0], open_[2], *open_[3], None))
                open_ = (row, parent, place, (prefix, suffix))
            if open_:
                out.append((open_[0], open_[2], *open_[3], None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema
            )

    parent = F.floor(F.col("place") / (fan * width)).cast("long")
    return (
        ends.select("row", "place", "prefix", "suffix", parent.alias("parent"))
        .repartition("row", "parent")
        .sortWithinPartitions("row", "parent", "place")
        .mapInArrow(run, "row long, place long, prefix binary, suffix binary, closed binary")
    )


def closed_parts(long_docs: DataFrame, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """(row, place, text) of all closed bytes of documents (row, text), without their first space.

    Places ascend with the bytes. A document's closed bytes make up the whole document.
    """
    made = keep(fragments(long_docs, chunk), "fragments")
    parts = made.filter(F.octet_length("closed") > 0).select(
        "row", (2 * F.col("place")).alias("place"), "closed"
    )
    ends, width = made.select("row", "place", "prefix", "suffix"), 1
    most = made.agg(F.max("place")).first()[0]
    while most is not None and width <= most:
        level = keep(reduce_level(ends, width, fan), "composed")
        parts = parts.unionByName(
            level.filter("closed IS NOT NULL").select(
                "row", (2 * F.col("place") + 1).alias("place"), "closed"
            )
        )
        ends = level.filter("closed IS NULL").drop("closed")
        width *= fan
    text = F.expr("substring(closed, 2)").cast("string")
    return parts.select("row", "place", text.alias("text"))


def joined_digests(parts: DataFrame) -> DataFrame:
    """(row, digest): the SHA-256 of the groups of each row's parts, in the order of places."""
    schema = pa.schema([("row", pa.int64()), ("digest", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, hashlib.sha256()
        for batch in batches:
            done = []
            for row, groups in zip(batch.column("row").to_pylist(), batch.column("groups").to_pylist()):
                if row != now:
                    if now is not None:
                        done.append((now, sha.hexdigest()))
                    now, sha = row, hashlib.sha256()
                else:
                    sha.update(b";")
                sha.update(groups or b"")
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*done) if done else ([], []), schema)],
                schema=schema,
            )
        if now is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int64()), pa.array([sha.hexdigest()])], schema=schema
            )

    ordered = parts.select("row", "place", "groups").repartition("row")
    return ordered.sortWithinPartitions("row", "place").mapInArrow(run, "row long, digest string")


# --- the operator ------------------------------------------------------------


def long_pairs(parts: DataFrame, pairs: DataFrame, bad: DataFrame) -> DataFrame:
    """(a, b, n): how many long documents hold each pair linked, each of them once."""
    numbers = parts.filter("row IS NOT NULL AND NOT pair").select("portion", "row", "steps", "times")
    spec = "portion string, row long, number int"
    schema = pa.schema([("portion", pa.string()), ("row", pa.int64()), ("number", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in batch.schema.names)
            for portion, row, x, y in zip(*columns):
                number = np.cumsum(np.frombuffer(x, "<u2"), dtype=np.int64)
                number = np.unique(number[np.frombuffer(y, np.uint8) > 0]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([portion] * len(number)), pa.array([row] * len(number), pa.int64()),
                     pa.array(number)], schema=schema,
                )

    spread = numbers.mapInArrow(run, spec).join(bad, "row", "left_anti")
    named = spread.join(pairs.select("portion", "number", "a", "b"), ["portion", "number"])
    return named.select("row", "a", "b").distinct().groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("n")
    )


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    chunk: int = CHUNK,
    fan: int = FAN,
    remembered: int = REMEMBERED,
    portion: int = PORTION,
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), a row per row.

    ``docs`` has doc_id and text; other columns are ignored. ``a_path`` is a byte-level tokenizer
    file, which encodes a space and the text, ``b_path`` a SentencePiece model, which adds the
    space itself. Special tokens in a text are plain text. A text that is null or empty, or does
    not come back from the bytes of its tokens, has no tokens: zeros and an empty digest. A pair
    of ids counts once per row that links it; rows that repeat are counted as often as they come.
    The other parameters bound memory and never change a result.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    size = F.octet_length("text")
    none = F.lit(None).cast("long")
    whole = rows.filter((size > 0) & (size < chunk))
    numbered = rows.filter(size >= chunk).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text"
    )
    long_docs = keep(numbered, "long-documents")
    closed = keep(closed_parts(long_docs, chunk, fan), "closed-parts")
    both = whole.select("doc_id", none.alias("row"), none.alias("place"), "text").unionByName(
        closed.select(none.alias("doc_id"), "row", "place", "text")
    )
    measured = keep(measure(both, a_path, b_path, remembered, portion), "aligned-parts")
    pairs, parts = measured.filter("pair"), measured.filter("NOT pair")
    of_long = parts.filter("row IS NOT NULL")
    bad = keep(of_long.filter("NOT ok").select("row").distinct(), "lost-documents")
    counts = (
        pairs.select("a", "b", "n")
        .unionByName(long_pairs(measured, pairs, bad))
        .groupBy("a", "b")
        .agg(F.sum("n").alias("n"))
    )
    # the highest count of each A id; the table of pairs has each of them once
    counts = keep(counts, "pair-counts")
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))
    counts = counts.join(highest, "a").select(
        "a", "b", "n", (F.col("n") == F.col("highest")).cast("long").alias("best")
    )
    known = pairs.drop("n").join(counts, ["a", "b"])
    lookups = known.select(*[F.col(c) for c in measured.columns], "best")
    summed = keep(
        link_sums(lookups.unionByName(parts.withColumn("best", F.lit(None).cast("long")))),
        "linked-parts",
    )
    figures = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

    def shown(ok: Column, digest: Column) -> list[Column]:
        return [
            *[F.when(ok, F.col(c)).otherwise(F.lit(0)).cast("long").alias(c) for c in figures],
            F.when(ok, digest).otherwise(F.lit("")).alias("groups_sha256"),
        ]

    single = summed.filter("row IS NULL").select("doc_id", *shown(F.col("ok"), F.col("digest")))
    composed = summed.filter("row IS NOT NULL")
    per_row = composed.groupBy("row").agg(
        *[F.sum(c).alias(c) for c in figures], F.min("ok").alias("ok")
    )
    joined = (
        long_docs.select("row", "doc_id")
        .join(per_row, "row")
        .join(joined_digests(composed), "row")
        .select("doc_id", *shown(F.col("ok"), F.col("digest")))
    )
    empty = rows.filter(F.coalesce(size, F.lit(0)) == 0).select(
        "doc_id",
        *[F.lit(0).cast("long").alias(c) for c in figures],
        F.lit("").alias("groups_sha256"),
    )
    return single.unionByName(joined).unionByName(empty)
