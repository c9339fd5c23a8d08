"""Components, embedding and SimHash near-duplicates against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import tidemark.llm.queries as llm
from tidemark.llm import embedding_dedup, simhash_dedup
from tidemark.llm.common import merge_labels, sorted_groups
from tidemark.llm.components import connected_components

SF_DIR = "/root/testdata/sf0.001"


def components(n, links):
    a, b = (np.array(x, np.int64) for x in zip(*links)) if links else (np.zeros(0, int),) * 2
    return merge_labels(np.arange(n), a, b)


@pytest.mark.parametrize("kind", ["random", "path", "star", "none"])
def test_components(spark, kind):
    r = random.Random(4)
    n = 300
    shapes = {
        "random": [(r.randrange(n), r.randrange(n)) for _ in range(220)],
        "path": [(i, i + 1) for i in r.sample(range(n - 1), n - 1)],
        "star": [(7, i) for i in range(n)] + [(i, 7) for i in range(n)],
        "none": [],
    }
    links = shapes[kind]
    want = components(n, links)
    got = connected_components(spark.createDataFrame([*links, (None, 3)], "a LONG, b LONG"))
    found = {row["node"]: row["component"] for row in got.collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert found == {x: int(want[x]) for x in linked}


def brute_fingerprint(text):
    words = [w for w in text.encode().lower().split()]
    if not words:
        return 0
    k = min(3, len(words))
    grams = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_simhash(rows):
    ids = [i for i, _ in rows]
    prints = [brute_fingerprint(t or "") for _, t in rows]
    pairs = [
        (i, j)
        for i in range(len(ids))
        for j in range(i)
        if (prints[i] ^ prints[j]).bit_count() <= 3 and None not in (ids[i], ids[j])
    ]
    labels = components(len(ids), pairs)
    low = {}
    for i, label in zip(ids, labels.tolist()):
        low[label] = min(low.get(label, i), i) if i is not None else None
    return sorted(
        (i is None, i or 0, f"{p:016x}", low[label])
        for i, p, label in zip(ids, prints, labels.tolist())
    )


def simhash_rows(df):
    return sorted(
        (r["doc_id"] is None, r["doc_id"] or 0, r["fingerprint"], r["component_id"])
        for r in df.collect()
    )


def test_simhash_of_odd_documents(odd_docs):
    want = brute_simhash([(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    got = simhash_dedup.near_duplicates(odd_docs)
    assert simhash_rows(got) == want
    kept = {r["doc_id"] for r in got.filter("kept").collect()}
    assert {1, 4, 7, 9, None, -5, 2**62} <= kept and not {2, 5, 6, 12} & kept


def test_simhash_query(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    want = brute_simhash([(r["doc_id"], r["text"]) for r in rows])
    assert simhash_rows(llm.QUERIES["op2_simhash_near_dedup"](spark, SF_DIR)) == want


def test_simhash_of_no_documents(make_docs):
    assert simhash_dedup.near_duplicates(make_docs([])).collect() == []


@pytest.mark.parametrize("groups", [1, 2])
def test_anchors_meet_within_the_distance(groups):
    """Whatever three bits differ, the other fingerprint comes to the home of the first."""
    r = np.random.default_rng(5)
    prints = r.integers(0, 1 << 63, 60, np.uint64)
    row, anchor, used = simhash_dedup.anchors(prints, 3, groups)
    home = {int(i): int(c) for i, c, u in zip(row, anchor, used) if u == 0}
    assert sorted(home) == list(range(60))
    for _ in range(20):
        moved = prints.copy()
        for bit in r.integers(0, 64, (3, 60), np.uint64):
            moved ^= np.uint64(1) << bit
        row, anchor, _ = simhash_dedup.anchors(moved, 3, groups)
        visits = set(zip(row.tolist(), anchor.tolist()))
        assert all((i, c) in visits for i, c in home.items())


@pytest.mark.parametrize("homes", [4, 4096])
def test_near_links_of_a_crowd(spark, monkeypatch, homes):
    """Split groups and two bit groups find what comparing everything finds."""
    monkeypatch.setattr(simhash_dedup, "HOMES_PER_GROUP", homes)
    r = np.random.default_rng(6)
    centre = r.integers(0, 1 << 63, 3, np.uint64)
    near = centre[r.integers(0, 3, 400)].copy()
    for bit in r.integers(0, 64, (4, 400), np.uint64):
        near ^= np.where(r.random(400) < 0.5, np.uint64(1) << bit, np.uint64(0))
    prints = np.unique(np.concatenate([near, r.integers(0, 1 << 63, 200, np.uint64)]))
    x, y = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3)
    want = merge_labels(np.arange(len(prints)), x, y)
    classes = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp LONG")
    links = simhash_dedup.near_links(classes, 3).collect()
    at = {int(p): i for i, p in enumerate(prints.view(np.int64))}
    got = components(len(prints), [(at[r["a"]], at[r["b"]]) for r in links])
    assert (got == want).all()


def brute_links(rows, threshold=0.93):
    n = len(rows)
    links = []
    for i in range(n):
        for j in range(i):
            (_, a, u), (_, b, v) = rows[i], rows[j]
            if a is None or a != b or u is None or v is None or len(u) != len(v):
                continue
            if any(x is None or not np.isfinite(x) for x in (*u, *v)):
                continue
            u, v = np.array(u, float), np.array(v, float)
            size = np.linalg.norm(u) * np.linalg.norm(v)
            if size and u @ v / size >= threshold:
                links.append((i, j))
    labels = components(n, links)
    count = np.bincount(np.array(links, int).ravel(), minlength=n) if links else np.zeros(n, int)
    first = {}
    for (i, _, _), label in zip(rows, labels.tolist()):
        first[label] = min(first.get(label, i), i)
    return {r[0]: (int(c), first[x]) for r, c, x in zip(rows, count, labels.tolist())}


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id LONG, label INT, embedding ARRAY<FLOAT>")
    return df.withColumns({"id": F.lit(1), "weight": F.lit("x"), "n": F.lit(2)}).repartition(3)


def found(df):
    rows = df.collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)
    assert len({r["vec_id"] for r in rows}) == len(rows)
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rows}


@pytest.mark.parametrize("tile", [8, 1024])
def test_embedding_links_equal_brute_force(spark, make_docs, monkeypatch, tile):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    r = np.random.default_rng(3)
    centres = r.normal(size=(4, 16))
    rows = []
    for i in range(240):
        v = centres[i % 4] + r.normal(size=16) * r.choice([0.02, 0.05, 0.9])
        rows.append((i, i % 3, v.astype(np.float32).tolist()))
    rows += [(300 + i, 1, rows[1][2]) for i in range(30)]
    rows += [
        (400, None, rows[0][2]), (401, 0, None), (402, 0, [0.0] * 16), (403, 0, []),
        (404, 0, [None, *rows[0][2][1:]]), (405, 0, [float("nan"), *rows[0][2][1:]]),
        (406, 0, [float("inf"), *rows[0][2][1:]]), (407, 0, rows[0][2][:8]), (408, 0, rows[0][2][:8]),
    ]
    want = brute_links(rows)
    got = found(embedding_dedup.near_duplicates(vectors(spark, [*rows, rows[5]])))
    assert got == want


def test_embedding_components_stay_doubles(spark):
    """Pairs that only more than 24 bits of a component can tell apart; sizes beyond a float."""
    near, far = [1.0, math.tan(math.acos(0.93)) - 1e-12], [1.0, math.tan(math.acos(0.93)) + 1e-9]
    rows = [(1, 0, [1.0, 0.0]), (2, 0, near), (3, 1, [1.0, 0.0]), (4, 1, far)]
    rows += [(5, 2, [1e200, 2e200]), (6, 2, [1e-200, 2e-200]), (7, 2, [3e200, -1e200])]
    df = spark.createDataFrame(rows, "vec_id LONG, label INT, embedding ARRAY<DOUBLE>")
    assert found(embedding_dedup.near_duplicates(df)) == {
        1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (0, 4), 5: (1, 5), 6: (1, 5), 7: (0, 7),
    }


def test_tables_follow_the_bits():
    assert embedding_dedup.tables_for(8, 0.93) == 16
    for bits in (8, 12, 17, 24):
        p = 1 - math.acos(0.93) / math.pi
        tables = embedding_dedup.tables_for(bits, 0.93)
        assert (1 - p**bits) ** tables <= embedding_dedup.MISS < (1 - p**bits) ** (tables - 1)
    assert embedding_dedup.tables_for(30, 1.0) == 1


@pytest.mark.parametrize("n", [1_500, 15_000])
def test_large_labels_get_more_bits(spark, monkeypatch, n):
    """Pairs at exactly 0.93 and above, planted among unrelated vectors of a large label."""
    monkeypatch.setattr(embedding_dedup, "FULL", 2)
    r = np.random.default_rng(8)
    base = r.normal(size=(n, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = r.normal(size=(n // 5, 32))
    side -= (side * base[: n // 5]).sum(1, keepdims=True) * base[: n // 5]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosines = r.choice([0.9301, 0.95, 0.92], n // 5)[:, None]
    every = np.concatenate([base, cosines * base[: n // 5] + np.sqrt(1 - cosines**2) * side])
    rows = [(i, 0 if i % 10 else 1, v.tolist()) for i, v in enumerate(every)]
    pairs = [(i, n + i) for i in range(n // 5) if (i % 10 > 0) == ((n + i) % 10 > 0) and cosines[i, 0] > 0.93]
    df = spark.createDataFrame(rows, "vec_id LONG, label INT, embedding ARRAY<DOUBLE>").repartition(6)
    classes = df.withColumnsRenamed({"vec_id": "id"})
    bits = {row["bits"] for row in embedding_dedup.signatures(classes).select("bits").distinct().collect()}
    assert max(bits) == math.ceil(math.log2(0.9 * 1.2 * n / 2)) and len(bits) == 2
    got = found(embedding_dedup.near_duplicates(df))
    hit = sum(got[i][1] == got[j][1] for i, j in pairs)
    assert hit >= 0.99 * len(pairs) and sum(c for c, _ in got.values()) <= 2 * len(pairs)


def test_embedding_query(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    want = brute_links([(r["vec_id"], r["label"], r["embedding"]) for r in rows])
    assert found(llm.QUERIES["op1_embedding_near_dedup"](spark, SF_DIR)) == want


def test_no_embeddings(spark, make_docs):
    assert embedding_dedup.near_duplicates(vectors(spark, [])).collect() == []


def test_sorted_groups_never_cuts_a_group():
    import pyarrow as pa

    r = random.Random(2)
    keys = sorted(r.randrange(12) for _ in range(200))
    batches, at = [], 0
    while at < len(keys):
        n = r.randrange(0, 30)
        batches.append(pa.RecordBatch.from_pydict({"k": keys[at : at + n]}, pa.schema([("k", pa.int64())])))
        at += n
    parts = [b.column("k").to_pylist() for b in sorted_groups(iter(batches), ["k"])]
    assert [k for p in parts for k in p] == keys
    assert all(a[-1] != b[0] for a, b in zip(parts, parts[1:]))
