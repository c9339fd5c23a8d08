"""Mixing of sources against plain Python with fractions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest

import tidemark.llm.queries as llm
from tests.compare import connect, differences
from tidemark.llm import mixing

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id LONG, text STRING, source STRING, key STRING, size INT, rest INT, hash STRING"


def brute_targets(sizes, weights, epochs):
    """Targets by source from {source: words}; None is the last source."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    clamped = set()
    while True:
        left = sum(sizes.values()) - sum(epochs * sizes[s] for s in clamped)
        open_ = [s for s in names if s not in clamped]
        open_weight = sum(weight[s] for s in open_)
        level = Fraction(left, open_weight) if open_weight else Fraction(0)
        over = {s for s in open_ if weight[s] * level > epochs * sizes[s]}
        if not over:
            break
        clamped |= over
    return {s: Fraction(epochs * sizes[s]) if s in clamped else weight[s] * level for s in names}


def brute_mix(rows, weights=(1, 2, 3), epochs=3, seed=12):
    """Rows (doc_id, text, source)."""
    members = defaultdict(list)
    for doc_id, text, source in rows:
        size = len(re.findall(r"[^\x20\x09-\x0d]+", text or ""))
        name = str(doc_id)
        if doc_id is None:
            name = "text " + hashlib.md5(text.encode()).hexdigest()
        order = hashlib.md5(f"{seed}:{name}".encode()).hexdigest()
        members[source].append((order, doc_id, size))
    sizes = {s: sum(m[2] for m in found) for s, found in members.items()}
    targets = brute_targets(sizes, weights, epochs)
    out = []
    for s, found in members.items():
        whole, rest = divmod(int(targets[s]), sizes[s]) if sizes[s] else (0, 0)
        for _, doc_id, size in sorted(found, key=lambda m: (m[0], m[1] or 0, m[2])):
            part = min(size, rest)
            rest -= part
            out.append((doc_id, size, sizes[s], float(targets[s]), whole * size + part, whole, part))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def table(spark, rows):
    extra = ("clash", 1, 2, "clash")
    return spark.createDataFrame([(*r, *extra) for r in rows], SCHEMA).repartition(3)


ODD = [
    (1, "one two three", "b"), (2, None, "b"), (3, "", None), (4, " \t\x0b\n ", "z"),
    (5, "a b" * 9000, "é"), (6, "x y z", None), (7, "x\x0cy\xa0z", "Z"), (7, "x\x0cy\xa0z", "Z"),
    (7, "other words of one id", "Z"), (None, "no id", "b"), (None, "neither has this", "b"),
    (2**62, "w " * 50, "a"), (-4, "w " * 51, "a"), (8, "lonely", "\U0001f600"), (9, "q", "￿"),
]


@pytest.mark.parametrize("run", [1, 3, 20_000])
def test_mix_of_odd_documents(spark, monkeypatch, run):
    monkeypatch.setattr(mixing, "RUN", run)
    assert rows_of(mixing.mix(table(spark, ODD))) == brute_mix(ODD)


def test_mix_of_nothing(spark):
    assert rows_of(mixing.mix(table(spark, []))) == []
    nothing = [(1, None, "a"), (2, "", None)]
    assert rows_of(mixing.mix(table(spark, nothing))) == brute_mix(nothing)


@pytest.mark.parametrize("weights, epochs", [((1, 2, 3), 3), ((5, 0, 1), 2), ((1,), 1)])
def test_mix_of_many_sources(spark, monkeypatch, weights, epochs):
    """A source with a third of all rows, tiny sources that are clamped one after the other."""
    monkeypatch.setattr(mixing, "RUN", 7)
    r = random.Random(4)
    rows = []
    for i in range(300):
        source = "hot" if i % 3 == 0 else f"s{int(60 * r.random() ** 3):02d}"
        rows.append((i, "w " * int(40 * r.random() ** 4 * (1 if source == "hot" else 20)), source))
    got = rows_of(mixing.mix(table(spark, rows), weights, epochs))
    assert got == brute_mix(rows, weights, epochs)
    taken = sum(g[4] for g in got)
    whole = sum(g[1] for g in got)
    assert all(g[4] <= epochs * g[1] for g in got)
    assert whole - 61 <= taken <= whole or 0 in weights


def test_mixed_texts_hold_the_words_taken(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(i)) + " \n", f"s{i % 4}") for i in range(25)]
    docs = table(spark, rows).withColumnRenamed("hash", "copy")
    mixed = mixing.mix(docs)
    out = mixing.mixed_texts(docs, mixed)
    assert out.columns == [*docs.columns, "copy_"]
    taken = defaultdict(int)
    for r in out.collect():
        taken[r["doc_id"]] += len((r["text"] or "").split())
        assert dict((i, t) for i, t, _ in rows)[r["doc_id"]].startswith(r["text"])
    want = {r["doc_id"]: r["taken"] for r in mixed.collect() if r["taken"]}
    assert {i: n for i, n in taken.items() if n} == want


def test_mixing_query_equals_its_sql(spark):
    _, _, problem = differences(
        llm.QUERIES["op12_source_mixing"](spark, SF_DIR), connect(SF_DIR), mixing.ORACLE
    )
    assert problem is None, problem
