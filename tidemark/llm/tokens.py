"""Encoding of whole texts with a tokenizer file, with a bounded memory of words.

Most words of a corpus come again and again. Both kinds of tokenizer used here cut a text
before they merge, and never merge across certain spaces: a text is cut there, every new
piece is encoded by the tokenizers library, and its ids are remembered until the memory
is full. The ids of a text are those that the library gives for the whole text.
"""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Callable
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# words, and beginnings and ends of words, that a worker remembers, about 45 bytes each;
# beyond that it starts afresh
REMEMBERED = 1 << 20
STEMS = 1 << 20
ENDS = 1 << 18

_BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")
# letters that every Unicode version and every normal form treats alike
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
# What follows them here begins with an ASCII character, so that no normal form joins the two.
_STEM_AND_END = r"^(?P<stem>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<end>[\x00-\x7f]*)$"


Learn = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def flattened(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint32, int(counts.sum())), counts


class WordMemory:
    """Ids of words under a 128-bit hash of the word, in flat arrays.

    ``learn`` gives the ids of new words one after the other, and how many each has.
    """

    def __init__(self, learn: Learn, limit: int | None = None):
        self.learn, self.limit = learn, limit
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.checks = np.zeros(0, np.uint64)
        self.begins = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``ids`` the ids of each word begin, and how many there are.

        Words should be distinct; one that comes twice is only learnt twice.
        """
        if len(self.keys) > (self.limit or REMEMBERED):
            self.clear()
        keys, checks = _names(words)
        found = self._find(keys, checks)
        new = np.flatnonzero(found < 0)
        if len(new):
            flat, counts = self.learn(words.take(pa.array(new)))
            begins = len(self.ids) + np.cumsum(counts) - counts
            self.ids = np.concatenate([self.ids, flat.astype(np.uint32)])
            keys_now = np.concatenate([self.keys, keys[new]])
            # two sorted runs: a merge
            order = np.argsort(keys_now, kind="stable")
            self.keys = keys_now[order]
            self.checks = np.concatenate([self.checks, checks[new]])[order]
            self.begins = np.concatenate([self.begins, begins])[order]
            self.counts = np.concatenate([self.counts, counts.astype(np.int32)])[order]
            found = self._find(keys, checks)
        return self.begins[found], self.counts[found].astype(np.int64)

    def _find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), -1)
        # in the order of the keys, so that neighbours are read together
        order = np.argsort(keys)
        at = np.empty(len(keys), np.int64)
        at[order] = np.minimum(np.searchsorted(self.keys, keys[order]), len(self.keys) - 1)
        same = (self.keys[at] == keys) & (self.checks[at] == checks)
        return np.where(same, at, -1)


def _names(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of each word's 128-bit hash (XXH3)."""
    words = words.cast(pa.large_string())
    bounds = np.frombuffer(words.buffers()[1], np.int64)[words.offset :][: len(words) + 1].tolist()
    data = memoryview(words.buffers()[2] or b"")
    digest = xxhash.xxh3_128_digest
    names = b"".join([digest(data[a:b]) for a, b in zip(bounds, bounds[1:])])
    halves = np.frombuffer(names, "<u8").reshape(-1, 2)
    return halves[:, 0].copy(), halves[:, 1].copy()


def gathered(ids: np.ndarray, begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs of ``ids`` one after the other."""
    ends = np.cumsum(counts)
    shift = np.repeat(begins - (ends - counts), counts)
    return ids[shift + np.arange(len(shift))]


class WordEncoder:
    """``spaces``: a word's piece holds the space before it (byte-level vocabularies).

    Otherwise the tokenizer drops white space, and every space is a border.
    """

    def __init__(self, path: str, spaces: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.spaces = spaces
        self.memory = WordMemory(self.learn)
        # beginnings and ends of words that other words have as well
        self.stems = WordMemory(self._learn_stems, STEMS)
        self.ends = WordMemory(lambda ends: flattened(self._ids(ends.to_pylist())), ENDS)
        # the characters that stand for the bytes of the letters above
        letters = [chr(c) for c in range(256) if _LETTERS.fullmatch(chr(c))] + [" "]
        signs = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.signs = {ord(c): "".join(s for s, _ in signs(c)) or None for c in letters}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's ids begin and end."""
        if not self.spaces:
            texts = pc.replace_substring(texts, "\n", " ")
        cut = pc.split_pattern(texts, " ")
        coded = cut.flatten().dictionary_encode()
        at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        begins, counts = self.memory.look_up(coded.dictionary)
        held = self.memory.ids
        sizes = cut.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        heads = ends - sizes
        begins, counts = begins[at], counts[at]
        if self.spaces:
            # the word that begins a text has no space before it; a space next to other white
            # space is no border
            odd = _edged(coded.dictionary)
            known = odd[at]
            starts = coded.dictionary.take(pa.array(at[heads])).to_pylist()
            known[heads] = [not w or w[-1].isspace() for w in starts]
            known[heads[sizes == 1]] = False
            own = self._ids(starts)
            for k in np.unique(np.searchsorted(ends, np.flatnonzero(known), "right")).tolist():
                own[k] = list(chain.from_iterable(self._whole(texts[k].as_py())))
                counts[heads[k] : ends[k]] = 0
            fresh, counts[heads] = flattened(own)
            begins[heads] = len(held) + np.cumsum(counts[heads]) - counts[heads]
            held = np.concatenate([held, fresh])
        flat = gathered(held, begins, counts)
        return flat, np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], ends])]

    def _whole(self, text: str) -> list[list[int]]:
        first, *words = _BETWEEN_WORDS.split(text)
        return self._ids([first] + [" " + w for w in words])

    def _ids(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def learn(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, and how many each has. Both patterns cut between a letter and a sign."""
        parts = pc.extract_regex(words, _STEM_AND_END)
        whole = parts.is_valid().to_numpy(zero_copy_only=False)
        pool, begins, counts = [], np.zeros((len(words), 2), np.int64), np.zeros((len(words), 2), int)
        cut = parts.filter(pa.array(whole))
        for side, memory in enumerate((self.stems, self.ends)):
            coded = pc.struct_field(cut, side).dictionary_encode()
            at = coded.indices.to_numpy(zero_copy_only=False)
            first, size = memory.look_up(coded.dictionary)
            begins[whole, side] = first[at] + sum(map(len, pool))
            counts[whole, side] = size[at]
            pool.append(memory.ids)
        rest = words.filter(pa.array(~whole)).to_pylist()
        flat, size = flattened(self._ids([" " * self.spaces + w for w in rest]))
        begins[~whole, 0] = np.cumsum(size) - size + sum(map(len, pool))
        counts[~whole, 0] = size
        ids = gathered(np.concatenate([*pool, flat]), begins.ravel(), counts.ravel())
        return ids, counts.sum(axis=1)

    def _learn_stems(self, stems: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Letters go straight to the merges of the library's model."""
        merge, signs = self.tokenizer.model.tokenize, self.signs
        # the normaliser of the vocabulary without spaces lower-cases
        texts = [" " + w if self.spaces else w.lower() for w in stems.to_pylist()]
        collecting = gc.isenabled()
        # millions of small lists without cycles
        gc.disable()
        found = flattened([[t.id for t in merge(x.translate(signs))] for x in texts])
        if collecting:
            gc.enable()
        return found


def _edged(words: pa.Array) -> np.ndarray:
    """Words that are empty, or begin or end with white space."""
    space = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
    found = pc.match_substring_regex(words, f"^$|^{space}|{space}$")
    return found.to_numpy(zero_copy_only=False)


@cache
def encoder(path: str, spaces: bool) -> WordEncoder:
    """One per worker process."""
    return WordEncoder(path, spaces)
