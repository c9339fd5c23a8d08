"""Token output, merge dropout, packing and the pipeline."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

import corpus_pipeline
import tidemark.llm.queries as llm
from tidemark.llm import merge_dropout, packing, token_output, tokens
from tidemark.session import shared_dir

SF_DIR = "/root/testdata/sf0.001"
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@cache
def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def library_ids(path, texts):
    tokenizer = library(path)
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def odd_texts():
    r = random.Random(3)
    fixed = ["", " ", "  ", " a", "a ", "a  b", "\n", " \n a", "a\n b \nc", "x\x1c y", "it's 's  'll"]
    fixed += ["<|endoftext|> x <|endoftext|>", "\t\tx  y\n\n z  ", "É é  ß", "a b  c", "á ́b"]
    signs = "ab \n\t'.,1é ́s梦"
    return fixed + ["".join(r.choices(signs, k=r.randrange(50))) for _ in range(400)]


@pytest.mark.parametrize("path, spaces", [(BYTES, True), (WORDS, False)])
def test_remembered_words_give_the_library_ids(monkeypatch, path, spaces):
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    encoder, texts = tokens.WordEncoder(path, spaces), odd_texts()
    for _ in range(2):
        flat, bounds = encoder.encode(pa.array(texts))
        assert [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == library_ids(path, texts)
    assert encoder.encode(pa.array([], pa.string()))[0].size == 0


@pytest.mark.parametrize("high", [1, 2, 300, 1 << 16, 1 << 32])
def test_segments_come_back(high):
    r = np.random.default_rng(high)
    for n in (0, 1, 1023, 1024, 5000):
        ids = r.integers(0, high, n, np.uint64).astype(np.uint32)
        ids[: n // 100] = r.integers(0, 1 << 32, n // 100, np.uint64).astype(np.uint32)
        ids = r.permutation(ids)
        docs, counts = np.array([-3, 2**60]), np.array([n // 3, n - n // 3])
        data = token_output.write_segment(docs, counts, ids)
        got = token_output.read_segment(data)
        assert all((a == b).all() for a, b in zip(got, (docs, counts, ids)))
    if high == 300:
        assert len(data) < 2 * n


def want_ids(rows, path, end):
    placed = sorted((i is None, i or 0, t or "") for i, t in rows)
    return placed, [x + [end] for x in library_ids(path, [t for *_, t in placed])]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check_output(got, rows):
    placed, ids = want_ids(rows, BYTES, 2)
    start, want = 0, []
    for (_, i, _), x in zip(placed, ids):
        want.append((i, start, len(x), crc(x)))
        start += len(x)
    assert sorted(got) == sorted(want)


def test_token_output_query(spark):
    got = llm.QUERIES["op4_token_output"](spark, SF_DIR).collect()
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    check_output([tuple(r) for r in got], [(r["doc_id"], r["text"]) for r in rows])


def test_token_output_of_odd_documents(spark, odd_docs, make_docs, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    path = shared_dir(spark, "odd-segments")
    token_output.write_ids(odd_docs, path, BYTES, 2)
    got = token_output.read_ids(spark, path).collect()
    assert sum(r["doc_id"] is None for r in got) == 1
    check_output(
        [(r["doc_id"] or 0, r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in got], rows
    )
    empty = shared_dir(spark, "no-segments")
    token_output.write_ids(make_docs([]), empty, BYTES, 2)
    assert token_output.read_ids(spark, empty).collect() == []


def test_long_cells_become_several_segments(spark, make_docs):
    docs = make_docs([(i, f"word{i} " * 40) for i in range(60)])
    path = shared_dir(spark, "small-segments")
    token_output.write_ids(docs, path, BYTES, 2, segment=500)
    assert spark.read.parquet(path).filter("piece > 0").count() > 3
    got = token_output.read_ids(spark, path, digest=True).collect()
    check_output([tuple(r) for r in got], [(r["doc_id"], r["text"]) for r in docs.collect()])


# --- merge dropout -------------------------------------------------------------------------


def encoded(encoder, texts, variant=0):
    flat, bounds = encoder.encode(pa.array(texts, pa.string()), variant)
    return [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])]


def test_no_dropout_is_the_library():
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = odd_texts() + ["e" * 300 + " f", "<0x0A> <s> </s>", "\x00"]
    got = encoded(merge_dropout.DropoutEncoder(PIECES, 7, 0.0), texts)
    assert got == model.encode(texts)


@pytest.mark.parametrize("dropout", [0.1, 0.5, 1.0])
def test_dropout_decodes_to_the_text_and_repeats(dropout):
    texts = odd_texts() + ["▁a ▁▁ b▁", "日本語 text " * 30, "x" * 500]
    one = merge_dropout.DropoutEncoder(PIECES, 7, dropout)
    got = encoded(one, texts)
    back = [merge_dropout.decode(one.vocabulary, np.array(ids, int)).decode() for ids in got]
    assert back == texts
    assert encoded(merge_dropout.DropoutEncoder(PIECES, 7, dropout), texts[::-1])[::-1] == got
    if dropout < 1:
        assert encoded(merge_dropout.DropoutEncoder(PIECES, 8, dropout), texts) != got
        assert encoded(one, texts, 1) != got
    else:
        plain = merge_dropout.DropoutEncoder(PIECES, 9, 1.0)
        assert encoded(plain, texts) == got


def test_side_by_side_equals_the_heap():
    r = random.Random(9)
    known = merge_dropout.vocabulary(PIECES)
    words = ["▁" + "".join(r.choices("aeinrstdhlo.,é梦", k=r.randrange(1, 47))) for _ in range(300)]
    keys = np.array([merge_dropout._word_key(w, 1, 2) for w in words], np.uint64)
    for p in (0.0, 0.2):
        want = [merge_dropout.agenda(known, w, int(k), p) for w, k in zip(words, keys)]
        flat, counts = merge_dropout.agendas(known, words, keys, p)
        assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == want


def test_merges_come_from_a_table_of_few_layers():
    r = random.Random(4)
    known = merge_dropout.vocabulary(PIECES)
    assert 1 < len(known.layers) < 9
    pairs = list(known.merges) + [
        (r.randrange(-50, len(known.scores)), r.randrange(-50, len(known.scores)))
        for _ in range(20_000)
    ]
    left, right = np.array(pairs, np.int64).T
    assert known.merge_of(left, right).tolist() == [known.merges.get(p, -1) for p in pairs]


def test_dropout_query_and_odd_documents(spark, odd_docs, make_docs):
    import hashlib

    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    got = llm.QUERIES["op6_sentencepiece_dropout"](spark, SF_DIR).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in rows}
    assert len(got) == len(rows)
    plain = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    lengths = {i: len(plain.encode(t)) for i, t in texts.items()}
    for r in got:
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    assert sum(r["n_ids"] for r in got) > 1.02 * sum(lengths.values())
    odd = merge_dropout.encode(odd_docs, PIECES, 1, 0.3).collect()
    known = merge_dropout.vocabulary(PIECES)
    back = sorted(merge_dropout.decode(known, np.frombuffer(r["ids"], "<u4")).decode() for r in odd)
    assert back == sorted(r["text"] or "" for r in odd_docs.collect())
    assert merge_dropout.encode(make_docs([]), PIECES, 1, 0.3).collect() == []

def test_every_occurrence_is_dropped_out_anew(make_docs):
    known = merge_dropout.vocabulary(PIECES)
    one = merge_dropout.DropoutEncoder(PIECES, 7, 0.1)
    within = encoded(one, ["international " * 2000 + "end"])[0]
    text = "".join(known.bytes_of[i].decode() for i in within)
    assert text == " international" * 2000 + " end"
    forms, form = set(), []
    for i in within:
        if known.bytes_of[i].startswith(b" ") and form:
            forms.add(tuple(form))
            form = []
        form.append(i)
    assert len(forms) > 20
    rows = merge_dropout.encode(
        make_docs([(i, "international") for i in range(2000)]), PIECES, 7, 0.1
    ).collect()
    assert len({bytes(r["ids"]) for r in rows}) > 20


@pytest.mark.parametrize("dropout", [0.1, 0.5])
def test_remembered_walks_equal_the_agenda_of_each_occurrence(monkeypatch, dropout):
    monkeypatch.setattr(merge_dropout, "REMEMBERED", 300)
    monkeypatch.setattr(merge_dropout, "DECIDED", 64)
    one = merge_dropout.DropoutEncoder(PIECES, 3, dropout)
    whole, decided = one._occurrences, []

    def check(words, at, keys):
        flat, counts = whole(words, at, keys)
        own = [" " + words[int(k)].as_py() for k in at]
        for w, k, got in zip(own, keys, np.split(flat, np.cumsum(counts)[:-1])):
            marked = merge_dropout._marked([w])[0]
            ids = merge_dropout.agenda(one.vocabulary, marked, int(k), dropout)
            assert got.tolist() == one._with_bytes(ids, w if merge_dropout.SPACE in w else marked)
            decided.append(w)
        return flat, counts

    monkeypatch.setattr(one, "_occurrences", check)
    for _ in range(2):
        encoded(one, odd_texts()[:60] + ["the international organisation " * 100, "y" * 60])
    assert len(decided) > 1000


# --- packing -------------------------------------------------------------------------------


def check_packed(got, rows):
    """Each id in one piece, gapless sequences within the capacity."""
    want = defaultdict(list)
    for i, t in rows:
        want[i].append(library_ids(WORDS, [t or ""])[0] + [1])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert pieces.keys() == want.keys()
    for i, texts in want.items():
        expected = []
        for ids in texts:
            for s in range(0, len(ids), 2048):
                part = ids[s : s + 2048]
                expected.append((s, len(part), crc(part), len(ids)))
        assert sorted(pieces[i]) == sorted(expected)
    for members in sequences.values():
        end = 0
        for offset, length in sorted(members):
            assert offset == end
            end += length
        assert end <= 2048
    assert sorted(sequences) == list(range(len(sequences)))
    return len(sequences)


def test_packing_query_pads_little(spark):
    got = llm.QUERIES["op8_packing"](spark, SF_DIR).collect()
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    used = check_packed(got, [(r["doc_id"], r["text"]) for r in rows])
    total = sum(r["length"] for r in got)
    assert used <= 1.02 * total / 2048 + 1


def test_packing_of_odd_documents(odd_docs, make_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    check_packed(packing.pack(odd_docs, WORDS, 1).collect(), rows)
    assert packing.pack(make_docs([]), WORDS, 1).collect() == []


def test_pieces_hold_their_ids(odd_docs):
    for r in packing.pieces(odd_docs, WORDS, 1, with_ids=True).collect():
        assert len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]


def test_knapsack_finds_the_best_pattern():
    r = np.random.default_rng(2)
    for _ in range(20):
        sizes = np.unique(r.integers(1, 12, 4))
        prices, room = r.random(len(sizes)), 24
        value, found = packing.best_patterns(prices, sizes, room, 0.0)
        grid = np.stack(np.meshgrid(*[np.arange(room // s + 1) for s in sizes]), -1)
        grid = grid.reshape(-1, len(sizes))
        grid = grid[grid @ sizes <= room]
        assert value == pytest.approx((grid @ prices).max())
        assert (found @ sizes <= room).all()
        best = [(grid @ prices)[grid[:, k] > 0].max() for k in range(len(sizes))]
        assert found @ prices == pytest.approx(best)


@pytest.mark.parametrize("sizes, most", [((1, 257), 256), ((1, 257), 40), ((20, 120), 60)])
def test_column_generation_is_optimal_and_the_plan_close_to_it(sizes, most):
    """The prices of the last basis are a bound from below, whatever the patterns are."""
    r = np.random.default_rng(most)
    for _ in range(3):
        classes = np.sort(r.choice(np.arange(*sizes), min(most, sizes[1] - sizes[0]), False))
        histogram = {int(c): int(r.integers(1, 5000)) for c in classes}
        demand = np.array([histogram[c] for c in classes.tolist()], float)
        basis = packing.column_generation(classes, demand, 256)
        total = sum(uses for uses, _ in basis)
        covered = sum(uses * counts for uses, counts in basis)
        assert covered == pytest.approx(demand)
        columns = np.array([counts for _, counts in basis], float)
        prices = np.linalg.solve(columns, np.ones(len(classes)))
        value, _ = packing.best_patterns(prices, classes, 256, np.inf)
        assert demand @ prices / value >= total * (1 - 2 * packing.TOLERANCE)
        held, bins = defaultdict(int), 0
        for times, pattern in packing.plan(histogram):
            assert sum(size * n for size, n in pattern) <= 256
            bins += times
            for size, n in pattern:
                held[size] += times * n
        assert held == histogram
        assert bins <= total + len(classes)
    assert packing.plan({}) == []


# --- pipeline ------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, names = docs.columns, [name for name, _ in corpus_pipeline.STAGES]
    assert names == [
        "quality classifier", "simhash near-dedup", "suffix-array dedup", "packing"
    ]
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(corpus_pipeline.keep(stage(spark, seen[-1], sf_dir), name.replace(" ", "-")))
    assert all(d.columns == columns for d in seen[:-1])
    whole, good, single, clean, packed = seen
    scored = {
        r["doc_id"]: r["predicted"]
        for r in llm.QUERIES["op3_quality_classifier"](spark, sf_dir).collect()
    }
    assert {r["doc_id"] for r in good.collect()} == {i for i, p in scored.items() if p}
    from tests.llm.test_near_duplicates import brute_simhash
    from tests.llm.test_texts import brute_removed

    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    want = {i for _, i, _, low in brute_simhash(rows) if i == low}
    left = [(r["doc_id"], r["text"]) for r in single.collect()]
    assert {i for i, _ in left} == want
    gone = {i: (n, cut) for i, n, cut, _, _ in brute_removed(left)}
    after = {r["doc_id"]: r for r in clean.collect()}
    assert after.keys() == gone.keys()
    before = dict(left)
    for i, (n, cut) in gone.items():
        if not cut:
            assert after[i]["text"] == before[i]
        assert after[i]["n_chars"] == len(after[i]["text"])
    check_packed(packed.collect(), [(i, r["text"]) for i, r in after.items()])


def test_near_dedup_of_repeated_ids_loses_no_group(spark, make_docs):
    """Document 5 repeats with two texts and stands for one of the groups."""
    a, b = ("one two three four five six seven", "some quite other words that are not alike")
    docs = make_docs([(5, a), (5, b), (7, a), (1, b), (9, a), (None, a)])
    kept = corpus_pipeline.near_dedup(spark, docs, SF_DIR)
    got = sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect())
    assert got == sorted([(0, a), (1, b), (5, a), (5, b)]) and kept.columns == docs.columns


def test_pipeline_of_odd_documents(spark, odd_docs, make_docs):
    for docs in (odd_docs, make_docs([])):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.keep(stage(spark, docs, SF_DIR), name.replace(" ", "-"))
            assert docs.columns == columns
        corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()


@pytest.mark.parametrize("path, spaces", [(BYTES, True), (WORDS, False)])
def test_words_that_polynomial_hashes_confuse_are_told_apart(path, spaces):
    """Thue-Morse words and their complements, and other long words."""
    word = "a"
    while len(word) < 4096:
        word += word.translate({97: "b", 98: "a"})
    texts = []
    for n in (1024, 4096):
        other = word[:n].translate({97: "b", 98: "a"})
        texts += [f"x {word[:n]} y", f"x {other} y", f"x {word[:n]} {other}. {word[:n]}1"]
    encoder = tokens.WordEncoder(path, spaces)
    flat, bounds = encoder.encode(pa.array(texts))
    assert [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == library_ids(path, texts)


def test_inverse_by_elimination():
    r = np.random.default_rng(1)
    for m in (1, 2, 40, 256):
        matrix = r.integers(-3, 4, (m, m)) + np.diag(r.integers(9, 20, m)) * m / 9
        matrix = matrix[r.permutation(m)]
        assert np.allclose(np.einsum("ij,jk->ik", packing.inverted(matrix), matrix), np.eye(m))
