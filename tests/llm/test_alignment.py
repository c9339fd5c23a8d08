"""Alignment of two tokenizers against the libraries on whole texts and plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from functools import cache

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import tidemark.llm.queries as llm
from tidemark.llm import alignment

SF_DIR = "/root/testdata/sf0.001"
A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")


@cache
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


@cache
def byte_of():
    """The byte-level alphabet: printable Latin-1 stands for itself, the rest follows from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(other)}}


def tokens(text):
    """(id, bytes) of both tokenizers, or none."""
    a, b = libraries()
    found = a.encode(" " + text, add_special_tokens=False)
    left = [(i, bytes(byte_of()[c] for c in t)) for i, t in zip(found.ids, found.tokens)]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        if piece.startswith("<0x") and len(piece) == 6:
            right.append((i, bytes([int(piece[3:5], 16)])))
        else:
            right.append((i, piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if not text or any(b"".join(x for _, x in side) != whole for side in (left, right)):
        return [], []
    return left, right


def spans(side):
    out, at = [], 0
    for i, data in side:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def brute(rows):
    linked, documents = [], Counter()
    for doc_id, text in rows:
        a, b = map(spans, tokens(text or ""))
        links, k = [], 0
        for i, s, e in a:
            while k < len(b) and b[k][2] <= s:
                k += 1
            j = k
            while j < len(b) and b[j][1] < e:
                links.append((i, b[j][0]))
                j += 1
        documents.update(set(links))
        both = {e for *_, e in a} & {e for *_, e in b}
        groups, sides = [], (defaultdict(list), defaultdict(list))
        for side, into in zip((a, b), sides):
            stops = sorted(both)
            k = 0
            for i, _, e in side:
                into[stops[k]].append(str(i))
                k += e == stops[k]
        groups = [",".join(sides[0][e]) + "|" + ",".join(sides[1][e]) for e in sorted(both)]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        linked.append((doc_id, len(a), len(b), len(groups), links, digest))
    highest = defaultdict(int)
    for (i, _), n in documents.items():
        highest[i] = max(highest[i], n)
    return sorted(
        [
            (d, n_a, n_b, n, len(links), sum(documents[x] == highest[x[0]] for x in links),
             sum(documents[x] for x in links), digest)
            for d, n_a, n_b, n, links, digest in linked
        ],
        key=str,
    )


def rows_of(df):
    names = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)


def strange_texts():
    r = random.Random(8)
    fixed = [
        "<s> </s> <unk> <0x41> <|endoftext|>", "a▁b", "▁", "x ▁ y", "a  b   c", " lead", "trail ",
        "\n\n a\t\tb \r\n", "ﬁ Å Á ẍ", "日本語 テキスト 中文 字", "Привет мир как дела", "𝒳 𝒴 🙂🙂 🙂",
        "it's 'tis 's 'll", "nul \x00 byte", "   x 　 y", "á ́b", "1234567 89,01",
        "=====     =====", "word" * 300, "é" * 50 + " " + "ß" * 50,
    ]
    signs = ["a", "b", "th", "ing", " ", " ", "\n", "é", "世", "🙂", "'", ".", "1", "▁", " "]
    return fixed + ["".join(r.choices(signs, k=r.randrange(60))) for _ in range(150)]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 40])
def test_fragments_compose_to_the_document_in_any_order(size):
    """Every way to bracket the fragments closes the same bytes, which make up the document."""
    r = random.Random(size)
    for text in strange_texts():
        data = (" " + text).encode()
        cuts = range(0, len(data), size)
        parts = [
            (k, *alignment.fragment(data[k : k + size], k == 0, k + size >= len(data))) for k in cuts
        ]
        closed = {(2 * k, c) for k, _, c in parts if c}
        ends = [(k, k, o) for k, o, _ in parts]
        while len(ends) > 1:
            i = r.randrange(len(ends) - 1)
            (first, last, left), (start, stop, right) = ends[i : i + 2]
            both, made = alignment.compose(left, right)
            if made:
                closed.add((2 * last + 1, made))
            ends[i : i + 2] = [(first, stop, both)]
        assert ends[0][2] == (b"", b"")
        assert b"".join(c for _, c in sorted(closed)) == data
        assert all(c.startswith(b" ") for _, c in closed)


def test_alignment_of_strange_texts(make_docs):
    pairs = list(enumerate(strange_texts())) + [(3, "a▁b"), (5, " lead"), (None, "no id"), (900, None)]
    assert rows_of(alignment.align(make_docs(pairs), A, B)) == brute(pairs)


@pytest.mark.parametrize("chunk, fan, remembered, portion", [(8, 2, 10, 10), (50, 3, 10**6, 300)])
def test_long_documents_by_fragments(make_docs, chunk, fan, remembered, portion):
    """Many fragments per document, some of them without any cut, and small portions."""
    r = random.Random(2)
    pairs = list(enumerate(strange_texts()[::3]))
    words = ["and", "the", "straße", "日本", "run-time", "x" * 70, "of", "▁", "\n", "a  b"]
    for i in range(12):
        pairs.append((1000 + i, " ".join(r.choices(words[: 7 + i % 4], k=40))))
    docs = make_docs(pairs)
    got = rows_of(alignment.align(docs, A, B, chunk, fan, remembered, portion))
    assert got == brute(pairs)


def test_alignment_of_odd_documents(odd_docs, make_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert rows_of(alignment.align(odd_docs, A, B, chunk=5000)) == brute(rows)
    assert rows_of(alignment.align(make_docs([]), A, B)) == []


def test_steps_come_back():
    import numpy as np

    r = np.random.default_rng(5)
    for high, n in ((10, 5), (300_000, 40), (10**6, 3), (70_000, 1)):
        numbers = np.unique(r.integers(0, high, n))
        times = r.choice([1, 2, 255, 256, 700], len(numbers))
        x, y = alignment._stepped(numbers, times)
        at, often = np.cumsum(np.frombuffer(x, "<u2"), dtype=np.int64), np.frombuffer(y, np.uint8)
        got = Counter()
        for a, b in zip(at.tolist(), often.tolist()):
            got[a] += b
        assert {k: v for k, v in got.items() if v} == dict(zip(numbers.tolist(), times.tolist()))


def test_alignment_query_equals_the_libraries(spark):
    got = rows_of(llm.QUERIES["op13_tokenizer_alignment"](spark, SF_DIR))
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert got == brute([tuple(r) for r in rows])
