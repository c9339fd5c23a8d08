"""SentencePiece encoding with seeded merge dropout, and decoding.

A word (with the spaces before it) starts as single characters. The agenda holds the
adjacent pairs whose concatenation is a piece of the vocabulary; the pair with the highest
score is merged first, of equal ones the leftmost. With dropout each candidate is
skipped for good with a given probability. The decision is a keyed hash of the seed, the
document's id, the word's place in the document, and where the two parts lie in the word, so
that a rerun, a retry or another partitioning gives the same ids, while every occurrence
of a word is decided anew. Characters that are no piece become bytes, and so does U+2581,
which stands for the space in the vocabulary; thus every text decodes to itself.

No piece of these vocabularies goes on after a space, so words can be handled one by one. The
ids depend on the word and on the candidates that are skipped, and on nothing else, so they are
remembered per worker for each word and set of skipped candidates, up to a bound; the
decisions themselves are made for every occurrence. New words walk their agendas side by
side, one merge of every word in each step; very long ones use a heap.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import sys
import zlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import longs, table
from tidemark.llm.tokens import WordMemory, gathered

SPACE = "▁"
# words of more characters are merged with a heap
SIDE_BY_SIDE = 48
# sets of skipped candidates of all words that are remembered per worker, before it starts
# afresh; at twice as many, which one batch can reach, occurrences are walked one by one
REMEMBERED = 3 << 19
# words with more candidates are walked for every occurrence
MOST_CANDIDATES = 40
# occurrences that are decided at a time
DECIDED = 1 << 15

_WORDS = re.compile(" *[^ ]+| +$")
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces, scores and possible merges of a SentencePiece BPE model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain, self.bytes_of = {}, []
        self.byte_ids = [0] * 256
        self.scores = np.zeros(model.get_piece_size())
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.scores[i] = model.get_score(i)
            data = b""
            if model.is_byte(i):
                data = bytes([int(piece[3:5], 16)])
                self.byte_ids[data[0]] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                plain[piece] = i
                data = piece.replace(SPACE, " ").encode()
                if SPACE in piece.lstrip(SPACE):
                    raise ValueError("a piece goes on after a space; words cannot be cut there")
            self.bytes_of.append(data)
        self.ids = plain
        self.merges = {
            (plain[p[:k]], plain[p[k:]]): i
            for p, i in plain.items()
            for k in range(1, len(p))
            if p[:k] in plain and p[k:] in plain
        }
        self.bits = len(self.scores).bit_length()
        # short numbers keep the table small, as all workers of a machine share its cache
        kind = np.int32 if 2 * self.bits < 32 else np.int64
        self._fill(
            np.array([a << self.bits | b for a, b in self.merges], kind),
            np.array(list(self.merges.values()), np.int32),
        )
        # the piece of each character, or -1; ``plain_signs`` for texts before ``_marked``
        self.signs = np.full(sys.maxunicode + 1, -1, np.int32)
        for p, i in plain.items():
            if len(p) == 1:
                self.signs[ord(p)] = i
        self.plain_signs = self.signs.copy()
        self.plain_signs[[ord(" "), ord(SPACE)]] = self.signs[[ord(SPACE), 0]]
        self.pieces = pa.array(self.bytes_of, pa.large_binary())

    def _fill(self, keys: np.ndarray, merged: np.ndarray) -> None:
        """Layers of a hash table: the first key of each place in the first, the next in another."""
        self.shift = np.uint64(64 - max(4, (8 * len(keys)).bit_length()))
        size = 1 << 64 - int(self.shift)
        place = self._place(keys)
        self.layers = []
        while len(keys):
            _, first = np.unique(place, return_index=True)
            held = np.full(size, np.iinfo(keys.dtype).min, keys.dtype)
            made = np.full(size, -1, np.int32)
            held[place[first]], made[place[first]] = keys[first], merged[first]
            self.layers.append((held, made))
            keys, merged, place = (np.delete(x, first) for x in (keys, merged, place))

    def _place(self, pairs: np.ndarray) -> np.ndarray:
        return (pairs.astype(np.uint64) * _STEP >> self.shift).astype(np.int64)

    def merge_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece of each pair, or -1. Parts below 0 are no pieces."""
        # negative, as no key is, where a part is below 0
        kind = self.layers[0][0].dtype
        want, none = (left << self.bits | right).astype(kind), np.iinfo(kind).min
        found = np.full(len(want), -1, np.int64)
        place, rows = self._place(want), np.arange(len(want))
        for held, made in self.layers:
            there = held[place]
            same = there == want
            found[rows[same]] = made[place[same]]
            # a later layer holds only what an earlier one had no room for
            on = ~same & (there != none)
            want, place, rows = want[on], place[on], rows[on]
        return found


def _word_key(word: str, seed: int, variant: int) -> int:
    return xxhash.xxh64_intdigest(word.encode(), (seed * 1_000_003 + variant) & (1 << 64) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _skipped(key: np.ndarray, ends: np.ndarray, middle: np.ndarray, limit: int) -> np.ndarray:
    """Whether the keyed hash of each candidate, named by its two ends and its middle, skips it."""
    x = key + (ends.astype(np.uint64) << np.uint64(32) | middle.astype(np.uint64)) * _STEP
    return _mixed(x) < np.uint64(limit)


def _skips(key: int, ends: int, middle: int, limit: int) -> bool:
    """``_skipped`` for one candidate."""
    whole = (1 << 64) - 1
    x = (key + ((ends << 32 & whole) | middle) * int(_STEP)) & whole
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & whole
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & whole
    return (x ^ x >> 31) < limit


def _limit(dropout: float) -> int:
    return min(int(dropout * 2.0**64), (1 << 64) - 1)


def agenda(vocabulary: Vocabulary, word: str, key: int, dropout: float) -> list[int]:
    """Merge one word with a heap; -1 - position stands for a character that is no piece."""
    symbols = [vocabulary.ids.get(c, -1 - i) for i, c in enumerate(word)]
    begin = list(range(len(word)))
    end = [i + 1 for i in begin]
    before, after = [i - 1 for i in begin], [i + 1 for i in begin]
    alive = [True] * len(word)
    heap: list[tuple[float, int, int, int, int]] = []
    limit = _limit(dropout)

    def add(i: int, j: int) -> None:
        if i < 0 or j >= len(word):
            return
        merged = vocabulary.merges.get((symbols[i], symbols[j]))
        if merged is None:
            return
        if limit and _skips(key, begin[i] << 16 | end[j], begin[j], limit):
            return
        heapq.heappush(heap, (-vocabulary.scores[merged], i, j, end[j], merged))

    for i in range(len(word) - 1):
        add(i, i + 1)
    while heap:
        _, i, j, stop, merged = heapq.heappop(heap)
        # stale if a part was merged away or has grown
        if not (alive[i] and alive[j]) or after[i] != j or end[j] != stop:
            continue
        if vocabulary.merges.get((symbols[i], symbols[j])) != merged:
            continue
        symbols[i], end[i], alive[j] = merged, end[j], False
        after[i] = after[j]
        if after[j] < len(word):
            before[after[j]] = i
        add(before[i], i)
        add(i, after[i])
    return [s for s, a in zip(symbols, alive) if a]


def agendas(
    vocabulary: Vocabulary, words: list[str], keys: np.ndarray, dropout: float
) -> tuple[np.ndarray, np.ndarray]:
    """As ``agenda``, for many words at once: all ids one after the other, and how many of each."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    short = order[lengths[order] <= SIDE_BY_SIDE]
    parts = [np.zeros(0, np.int64)]
    counts = np.zeros(len(words), np.int64)
    limit = _limit(dropout)
    for some in np.array_split(short, len(short) // 8192 + 1):
        if len(some):
            own = keys[some]

            def skip(r: np.ndarray, c: np.ndarray, middle: np.ndarray, end: np.ndarray):
                return _skipped(own[r], c << 16 | end, middle, limit)

            ids, each = _side_by_side(
                vocabulary, [words[k] for k in some], skip if limit else None, vocabulary.signs
            )
            parts.append(ids)
            counts[some] = each
    for k in order[len(short) :].tolist():
        ids = agenda(vocabulary, words[k], int(keys[k]), dropout)
        parts.append(np.array(ids, np.int64))
        counts[k] = len(ids)
    begins = np.zeros(len(words), np.int64)
    begins[order] = np.cumsum(counts[order]) - counts[order]
    return gathered(np.concatenate(parts), begins, counts), counts


def _side_by_side(
    vocabulary: Vocabulary,
    words: list[str],
    skip: Callable[..., np.ndarray] | None,
    pieces: np.ndarray,
    met: list[tuple[np.ndarray, ...]] | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Symbols are linked lists in one row per word; a symbol stands where its text begins.

    ``pieces`` has the piece of each character. ``skip`` tells for rows, beginnings, middles and ends of candidates which of them are
    skipped; those that are not are added to ``met``.
    """
    size = np.fromiter(map(len, words), np.int64, len(words))
    # the column after a word's last character stands for its end
    width = int(size.max()) + 1
    columns = np.arange(width)
    inside = columns < size[:, None]
    signs = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    known = pieces[signs]
    none = -1 - width
    symbols = np.full((len(words), width), none, np.int64)
    place = np.broadcast_to(columns, symbols.shape)[inside]
    symbols[inside] = np.where(known >= 0, known, -1 - place)
    after = np.minimum(columns + 1, size[:, None])
    before = np.broadcast_to(columns - 1, symbols.shape).copy()
    merged = np.zeros(symbols.shape, np.int64)
    score = np.full(symbols.shape, -np.inf)
    alive = inside.copy()

    def weigh(r: np.ndarray, c: np.ndarray) -> None:
        """The candidate of the symbol at c with the next one."""
        middle = after[r, c]
        made = vocabulary.merge_of(symbols[r, c], symbols[r, middle])
        good = made >= 0
        if skip:
            good &= ~skip(r, c, middle, after[r, middle])
        if met is not None:
            met.append((r[good], _packed(c[good], middle[good], after[r, middle][good])))
        merged[r, c] = made
        score[r, c] = np.where(good, vocabulary.scores[made], -np.inf)

    weigh(*np.nonzero(inside))
    rows = np.arange(len(words))
    while True:
        best = score[rows].argmax(axis=1)
        open_ = score[rows, best] > -np.inf
        rows, best = rows[open_], best[open_]
        if not len(rows):
            break
        right = after[rows, best]
        end = after[rows, right]
        symbols[rows, best] = merged[rows, best]
        after[rows, best] = end
        before[rows, end] = best
        score[rows, right] = -np.inf
        alive[rows, right] = False
        weigh(rows, best)
        left = before[rows, best]
        weigh(rows[left >= 0], left[left >= 0])
    return symbols[alive], alive.sum(axis=1)


def _packed(begin: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (begin << 12 | middle << 6 | end).astype(np.uint32)


def agendas_without(
    vocabulary: Vocabulary, words: list[str], skips: np.ndarray, counts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``agendas``, for words before ``_marked`` of SIDE_BY_SIDE characters at most, with
    named candidates skipped.

    ``counts`` of the packed ``skips`` belong to each word. Also gives the packed candidates
    that were met and not skipped, and how many of them each word has.
    """
    order = np.argsort(np.fromiter(map(len, words), np.int64, len(words)), kind="stable")
    firsts = np.cumsum(counts) - counts
    parts, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
    sizes, many = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    for some in np.array_split(order, len(words) // 8192 + 1):
        if not len(some):
            continue
        held = np.repeat(np.arange(len(some)), counts[some]) << 18
        held = np.sort(held | gathered(skips, firsts[some], counts[some]))

        def skip(r: np.ndarray, c: np.ndarray, middle: np.ndarray, end: np.ndarray):
            want = r << 18 | _packed(c, middle, end)
            return held[np.minimum(np.searchsorted(held, want), len(held) - 1)] == want

        met: list[tuple[np.ndarray, ...]] = []
        chosen = [words[k] for k in some.tolist()]
        ids, sizes[some] = _side_by_side(
            vocabulary, chosen, skip if len(held) else None, vocabulary.plain_signs, met
        )
        # at most 8,192 rows: numbers of 16 bits are sorted without comparisons
        rows = np.concatenate([r for r, _ in met]).astype(np.uint16)
        parts.append(ids)
        found.append(np.concatenate([c for _, c in met])[np.argsort(rows, kind="stable")])
        many[some] = np.bincount(rows, minlength=len(some))
    out = []
    for values, size in ((np.concatenate(parts), sizes), (np.concatenate(found), many)):
        begins = np.zeros(len(words), np.int64)
        begins[order] = np.cumsum(size[order]) - size[order]
        out += [gathered(values, begins, size), size]
    return out[0], out[1], out[2], out[3]


class _Runs:
    """Runs of numbers by number of the run, one after the other."""

    def __init__(self, kind: type):
        self.values = np.zeros(0, kind)
        self.begins = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)

    def add(self, values: np.ndarray, counts: np.ndarray) -> None:
        begins = len(self.values) + np.cumsum(counts) - counts
        self.values = np.concatenate([self.values, values.astype(self.values.dtype)])
        self.begins = np.concatenate([self.begins, begins])
        self.counts = np.concatenate([self.counts, counts])

    def of(self, runs: np.ndarray) -> np.ndarray:
        return gathered(self.values, self.begins[runs], self.counts[runs])


class DropoutEncoder:
    """Walks are numbered: one per word and set of skipped candidates.

    A walk holds its ids and the candidates that it met and did not skip. An occurrence begins
    at the walk of its word without skips; where the occurrence's key skips candidates
    that the walk met, it goes on to the walk that skips these as well, until none is left.
    """

    def __init__(self, path: str, seed: int, dropout: float):
        self.vocabulary = vocabulary(path)
        self.seed, self.dropout = seed, dropout
        self.clear()

    def clear(self) -> None:
        # the first walk of each word
        self.memory = WordMemory(self._learn, 4 * REMEMBERED)
        self.ids, self.met, self.skips = _Runs(np.uint32), _Runs(np.uint32), _Runs(np.uint32)
        # walks that follow: the walk before and which of its candidates are skipped
        self.nexts = np.zeros(0, np.int64)
        self.walks = np.zeros(0, np.int64)

    def _learn(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The first walks of words, each with a space before it."""
        words = [" " + w for w in new.to_pylist()]
        none = np.zeros(0, np.uint32)
        return self._walk(words, none, np.zeros(len(words), np.int64)), np.ones(len(words), int)

    def _walk(self, words: list[str], skips: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The numbers of new walks. A word of too many characters has no ids and no candidates."""
        short = np.fromiter((len(w) <= SIDE_BY_SIDE for w in words), bool, len(words))
        some = [w if s else "" for w, s in zip(words, short.tolist())]
        ids, sizes, met, many = agendas_without(self.vocabulary, some, skips, counts)
        begin = len(self.ids.begins)
        self.ids.add(*self._in_bytes(some, ids, sizes))
        self.met.add(met, many)
        self.skips.add(skips, counts)
        return np.arange(begin, begin + len(words))

    def _in_bytes(
        self, words: list[str], ids: np.ndarray, counts: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """``ids`` with bytes for characters that are no piece."""
        lost = np.unique(np.searchsorted(np.cumsum(counts), np.flatnonzero(ids < 0), "right"))
        if len(lost):
            begins = np.cumsum(counts) - counts
            parts, end = [ids], len(ids)
            for k in lost.tolist():
                text = words[k] if SPACE in words[k] else _marked([words[k]])[0]
                own = ids[begins[k] : begins[k] + counts[k]].tolist()
                parts.append(np.array(self._with_bytes(own, text), np.int64))
                begins[k], counts[k] = end, len(parts[-1])
                end += len(parts[-1])
            ids = gathered(np.concatenate(parts), begins, counts)
        return ids, counts

    def _with_bytes(self, ids: list[int], text: str) -> list[int]:
        out = []
        for i in ids:
            if i >= 0:
                out.append(i)
            else:
                out.extend(self.vocabulary.byte_ids[b] for b in text[-1 - i].encode())
        return out

    def encode(
        self, texts: pa.Array, keys: np.ndarray | int
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's ids begin and end.

        ``keys`` tell the documents apart.
        """
        if len(self.ids.begins) > REMEMBERED:
            self.clear()
        # where words are parted by single spaces, each is one space and the word
        odd = pc.or_(pc.match_substring(texts, "  "), pc.ends_with(texts, " "))
        odd = pc.or_(odd, pc.or_(pc.starts_with(texts, " "), pc.equal(texts, "")))
        cut = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        coded = cut.flatten().dictionary_encode()
        at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = cut.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        begins = np.cumsum(sizes) - sizes
        # the others are cut before each run of spaces, and after the last word
        others = np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()
        pieces = [
            [p[1:] for p in _WORDS.findall(" " + t)] if (t := texts[k].as_py()) else []
            for k in others
        ]
        more = {p: n for n, p in enumerate(dict.fromkeys(chain.from_iterable(pieces)))}
        extra, end = [at], len(at)
        for k, own in zip(others, pieces):
            extra.append(np.array([len(coded.dictionary) + more[p] for p in own], np.int64))
            begins[k], sizes[k] = end, len(own)
            end += len(own)
        words = pa.concat_arrays([coded.dictionary, pa.array(list(more), pa.string())])
        at = gathered(np.concatenate(extra), begins, sizes)
        ends = np.cumsum(sizes)
        place = np.arange(len(at)) - np.repeat(ends - sizes, sizes)
        seed = np.uint64(xxhash.xxh64_intdigest(b"", self.seed & (1 << 64) - 1))
        base = _mixed(np.broadcast_to(np.asarray(keys), len(texts)).astype(np.uint64) * _STEP + seed)
        own = _mixed(np.repeat(base, sizes) + place.astype(np.uint64) * _STEP)
        flat, counts = self._occurrences(words, at, own)
        return flat, np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], ends])]

    def _occurrences(
        self, words: pa.Array, at: np.ndarray, keys: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ids of occurrences of ``words``, and how many each has."""
        first, _ = self.memory.look_up(words)
        walk = self.memory.ids[first].astype(np.int64)[at]
        alone = (pc.utf8_length(words).to_numpy(zero_copy_only=False) >= SIDE_BY_SIDE)[at]
        open_ = np.flatnonzero(~alone) if self.dropout > 0 else alone[:0].nonzero()[0]
        while len(open_):
            many = (self.met.counts[walk[open_]] > MOST_CANDIDATES) | (
                walk[open_] >= 2 * REMEMBERED
            )
            alone[open_[many]] = True
            open_ = open_[~many]
            masks = np.zeros(len(open_), np.int64)
            for k in range(0, len(open_), DECIDED):
                some = open_[k : k + DECIDED]
                masks[k : k + DECIDED] = self._masks(walk[some], keys[some])
            open_, masks = open_[masks > 0], masks[masks > 0]
            walk[open_] = self._next(walk[open_], masks, words, at[open_])
        begins, counts = self.ids.begins[walk], self.ids.counts[walk]
        held = self.ids.values
        rows = np.flatnonzero(alone)
        if len(rows):
            own = [" " + w for w in words.take(pa.array(at[rows])).to_pylist()]
            ids, sizes = agendas(self.vocabulary, _marked(own), keys[rows], self.dropout)
            ids, counts[rows] = self._in_bytes(own, ids, sizes)
            begins[rows] = len(held) + np.cumsum(counts[rows]) - counts[rows]
            held = np.concatenate([held, ids.astype(np.uint32)])
        return gathered(held, begins, counts), counts

    def _masks(self, walk: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Which candidates of its walk each occurrence skips, one bit each."""
        counts = self.met.counts[walk]
        met = self.met.of(walk).astype(np.int64)
        row = np.repeat(np.arange(len(walk)), counts)
        skipped = np.flatnonzero(
            _skipped(
                keys[row], met >> 12 << 16 | met & 63, met >> 6 & 63, _limit(self.dropout)
            )
        )
        masks = np.zeros(len(walk), np.int64)
        if len(skipped):
            row = row[skipped]
            bits = np.int64(1) << skipped - (np.cumsum(counts) - counts)[row]
            new = np.flatnonzero(np.diff(row, prepend=-1))
            masks[row[new]] = np.add.reduceat(bits, new)
        return masks

    def _next(
        self, walk: np.ndarray, masks: np.ndarray, words: pa.Array, at: np.ndarray
    ) -> np.ndarray:
        """The walks of words that skip the masked candidates as well."""
        wanted, one, where = np.unique(
            walk << MOST_CANDIDATES | masks, return_index=True, return_inverse=True
        )
        place = np.searchsorted(self.nexts, wanted)
        known = np.zeros(len(wanted), bool)
        if len(self.nexts):
            known = self.nexts[np.minimum(place, len(self.nexts) - 1)] == wanted
        new = np.flatnonzero(~known)
        if len(new):
            before = walk[one[new]]
            own = [" " + w for w in words.take(pa.array(at[one[new]])).to_pylist()]
            counts = self.met.counts[before]
            step = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
            chosen = np.repeat(masks[one[new]], counts) >> step & 1 > 0
            row = np.repeat(np.arange(len(new)), counts)[chosen]
            older = self.skips.counts[before]
            rows = np.concatenate([np.repeat(np.arange(len(new)), older), row])
            skips = np.concatenate([self.skips.of(before), self.met.of(before)[chosen]])
            order = np.argsort(rows, kind="stable")
            numbers = self._walk(own, skips[order], np.bincount(rows, minlength=len(new)))
            self.nexts = np.insert(self.nexts, place[new], wanted[new])
            self.walks = np.insert(self.walks, place[new], numbers)
            place = np.searchsorted(self.nexts, wanted)
        return self.walks[place][where]


def _marked(words: list[str]) -> list[str]:
    """A literal U+2581 must not look like a space."""
    return [w.replace(SPACE, "\0").replace(" ", SPACE) for w in words]


def decode(vocabulary: Vocabulary, ids: np.ndarray) -> bytes:
    """The text of one document's ids."""
    return _joined(vocabulary, ids)[0][1:]


def _joined(vocabulary: Vocabulary, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    taken = vocabulary.pieces.take(pa.array(ids.astype(np.int64)))
    bounds = np.frombuffer(taken.buffers()[1], np.int64, len(ids) + 1)
    return (taken.buffers()[2] or pa.py_buffer(b"")).to_pybytes()[: bounds[-1]], bounds


@cache
def vocabulary(path: str) -> Vocabulary:
    """One per worker process."""
    return Vocabulary(path)


@cache
def encoder(path: str, seed: int, dropout: float) -> DropoutEncoder:
    return DropoutEncoder(path, seed, dropout)


def encode(
    docs: DataFrame, model: str, seed: int, dropout: float, digest: bool = False
) -> DataFrame:
    """(doc_id, n_ids, ids) per row; ids are little-endian unsigned 32-bit integers.

    With ``digest`` the ids stay in the task: it returns their crc32 and the SHA-256 of
    the text that they decode to. A null text counts as empty and has no ids. The
    text stands for the id of a document without a doc_id. Other columns are ignored.
    """
    kinds = [("doc_id", pa.int64()), ("n_ids", pa.int64())]
    kinds += (
        [("ids_crc32", pa.int64()), ("decoded_sha256", pa.string())]
        if digest
        else [("ids", pa.binary())]
    )
    schema = pa.schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model, seed, dropout)
        for batch in batches:
            flat, bounds = own.encode(batch.column("text"), longs(batch, "key"))
            edges = bounds.tolist()
            values = []
            if digest:
                data = memoryview(flat).cast("B")
                text, places = _joined(own.vocabulary, flat)
                text = memoryview(text)
                for a, b in zip(edges, edges[1:]):
                    plain = text[places[a] + (b > a) : places[b]]
                    crc = zlib.crc32(data[4 * a : 4 * b])
                    values.append((crc, hashlib.sha256(plain).hexdigest()))
            else:
                values = [(flat[a:b].tobytes(),) for a, b in zip(edges, edges[1:])]
            columns = zip(*values) if values else [()] * (len(kinds) - 2)
            yield table(schema, batch.column("doc_id"), np.diff(bounds), *columns)

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)).alias("key"),
        text.alias("text"),
    )
    last = "ids_crc32 long, decoded_sha256 string" if digest else "ids binary"
    return rows.mapInArrow(run, f"doc_id long, n_ids long, {last}")
