"""Vector codes against plain Python integers."""

from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

import tidemark.llm.queries as llm
from tests.compare import connect, differences
from tidemark.llm import vector_codes as vc
from tidemark.llm.common import ship

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id LONG, embedding ARRAY<{}>, label INT, code INT, error STRING, key INT, total INT"


def brute(rows):
    """Rows (vec_id, vector, label)."""
    kept = []
    for vec_id, vector, label in rows:
        if vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, label, [math.floor(4096 * x) for x in vector]))
    width = max(1, -(-max((len(v) for *_, v in kept), default=0) // 8))
    kept = [(i, label, v + [0] * (8 * width - len(v)), len(v)) for i, label, v in kept]
    first = sorted(kept, key=lambda k: (k[0] is None, k[0] or 0, k[2][: k[3]]))[:16]

    def part(v, p):
        return v[p * width : (p + 1) * width]

    book = [[part(v, p) for _, _, v, _ in first] for p in range(8)]

    def assign(v, p):
        gaps = [sum((a - b) ** 2 for a, b in zip(part(v, p), e)) for e in book[p]]
        return min(range(len(gaps)), key=gaps.__getitem__), min(gaps)

    for _ in range(6):
        members = defaultdict(list)
        for _, _, v, _ in kept:
            for p in range(8):
                members[p, assign(v, p)[0]].append(part(v, p))
        for (p, e), found in members.items():
            book[p][e] = [sum(column) // len(found) for column in zip(*found)]
    digest = hashlib.sha256(",".join(str(x) for p in book for e in p for x in e).encode()).hexdigest()
    out, per_label = [], defaultdict(int)
    for i, label, v, _ in kept:
        found = [assign(v, p) for p in range(8)]
        error = sum(gap for _, gap in found)
        per_label[label] += error
        out.append((i, "".join(f"{e:02x}" for e, _ in found), error, label))
    return sorted([(i, c, e, per_label[label], digest) for i, c, e, label in out], key=str)


def table(spark, rows, kind="FLOAT"):
    ship(spark)
    rows = [(*r, 1, "x", 2, 3) for r in rows]
    return spark.createDataFrame(rows, SCHEMA.format(kind)).repartition(3)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def single(x):
    return float(np.float32(x))


def vectors(n, dims, seed=1):
    """Vectors around a few centres, a label with a third of them, copies, labels missing."""
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    out = []
    for i in range(n):
        centre = centres[r.randrange(5)]
        vector = [single(c + r.gauss(0, 0.2)) for c in centre]
        label = None if i % 10 == 9 else 7 if i % 3 == 0 else r.randrange(4)
        out.append((i * 3 % n, vector, label))
    return out + out[:7]


@pytest.mark.parametrize("width", [1, 2, 4, 8, 32])
def test_sequency_order_counts_sign_changes(width):
    walsh = vc.transform(np.eye(width, dtype=np.int64)).T
    changes = (np.diff(np.sign(walsh), axis=1) != 0).sum(axis=1)
    assert changes.tolist() == list(range(width))
    assert (np.einsum("ij,kj->ik", walsh, walsh) == width * np.eye(width)).all()


@pytest.mark.parametrize("high", [3, 1000, 1 << 30])
def test_nearest_equals_a_full_search(high):
    """Small numbers have many ties, large ones need more than 64 bits on the way."""
    r = np.random.default_rng(high)
    for width in (1, 3, 8, 11):
        parts = r.integers(-high, high + 1, (200, 8, width))
        book = r.integers(-high, high + 1, (8, 16, width))
        book[:, 5] = book[:, 9]
        parts[:8, 0] = book[0, 5]
        gaps = ((parts.astype(object)[:, :, None] - book.astype(object)) ** 2).sum(axis=3)
        if gaps.max() >= 1 << 63:
            gaps = gaps.astype(object)
        code, error = vc.nearest(parts, book)
        want = np.array([[min(range(16), key=g.__getitem__) for g in row] for row in gaps])
        assert (code == want).all()
        assert (error == np.take_along_axis(gaps, want[..., None], 2)[..., 0]).all()


def test_codes_of_vectors(spark):
    rows = vectors(300, 16)
    assert rows_of(vc.compress(table(spark, rows))) == brute(rows)


def test_codes_of_doubles_are_those_of_the_doubles(spark):
    rows = [(i, [x + 1e-9 if i % 2 else x for x in v], label) for i, v, label in vectors(60, 8)]
    rows.append((1000, [-1 / 4096 - 1e-13] * 8, 1))
    assert rows_of(vc.compress(table(spark, rows, "DOUBLE"))) == brute(rows)


def test_codes_of_odd_vectors(spark):
    """Nulls, not-a-number, zero and short vectors, repeated ids, fewer than 16 rows."""
    rows = [
        (5, None, 1), (4, [1.0, None], 1), (3, [float("nan"), 1.0], None), (2, [float("inf")] * 9, 2),
        (1, [0.0] * 9, 2), (1, [0.5] * 9, 2), (1, [0.5] * 9, 2), (0, [], None), (None, [0.25] * 3, None),
        (-7, [-0.0001] * 9, 3), (2**62, [float(i) for i in range(9)], 3),
    ]
    assert rows_of(vc.compress(table(spark, rows))) == brute(rows)


def test_codes_of_nothing(spark):
    assert rows_of(vc.compress(table(spark, []))) == []
    assert rows_of(vc.compress(table(spark, [(1, None, 1)]))) == []


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="too large"):
        vc.compress(table(spark, [(1, [1e30], 1)])).collect()


def test_decoded_vectors_are_as_far_as_the_error_says(spark):
    rows = vc.keep(vc.whole_vectors(table(spark, vectors(80, 16))), "whole")
    books = vc.learn(rows)
    decoded = vc.decode(vc.encode(rows, books), books, 16).join(
        rows.select("vec_id", "values"), "vec_id"
    )
    for r in decoded.collect():
        gap = sum((round(a * 4096) - b) ** 2 for a, b in zip(r["approximation"], r["values"]))
        assert gap == r["error"] or r["vec_id"] < 21  # ids that repeat meet each other's vectors


def test_vector_codes_query_equals_its_sql(spark):
    _, _, problem = differences(
        llm.QUERIES["op11_vector_codes"](spark, SF_DIR), connect(SF_DIR), vc.ORACLE
    )
    assert problem is None, problem
