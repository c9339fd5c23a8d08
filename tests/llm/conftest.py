from __future__ import annotations

import pytest

from tidemark.llm.common import ship

# columns that operators use inside as well, and one with a dot-free odd name
CLASHING = (
    "cid LONG, fp LONG, cell INT, part INT, kept STRING, kept_text STRING, text_id STRING, "
    "component_id LONG, class INT, score DOUBLE, n BIGINT, a INT, b INT"
)
SCHEMA = f"doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, {CLASHING}"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with further columns under clashing names."""
    ship(spark)

    def make(pairs):
        extra = (1, 2, 3, 4, "x", "y", "z", 5, 6, 0.5, 7, 8, 9)
        rows = [
            (i, t, "en", "src0", None if t is None else len(t), *extra) for i, t in pairs
        ]
        return spark.createDataFrame(rows, SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and long texts, copies, repeated rows, a row without an id."""
    words = "the quick brown fox jumps over the lazy dog and runs far away from home".split()
    long_text = " ".join(words[(i * i) % len(words)] + str(i % 97) for i in range(4000))
    base = " ".join(f"{w}{k}" for k in range(12) for w in words)
    pairs = [
        (1, base), (2, base), (3, base + " tail"), (4, None), (5, ""), (6, " \n\t "), (7, "one"),
        (8, "Zwei Wörter"), (9, long_text), (10, long_text[:9000]), (11, "ñ́ 日本語 <s> ▁ x  y"),
        (12, "one"), (12, "one"), (None, "no id here at all"), (-5, "negative id"),
        (2**62, "a very large id"),
    ]
    return make_docs(pairs)


def texts_of(df):
    return {r["doc_id"]: r["text"] or "" for r in df.collect()}
