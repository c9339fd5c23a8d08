"""Quality, license, preference, passage and fingerprint operators against brute force."""

from __future__ import annotations

import hashlib
import random
import struct
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import tidemark.llm.queries as llm
from tests.compare import connect, differences
from tidemark.llm import licenses, preferences, quality_gam, sketches, suffix_dedup

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_query_equals_its_sql(spark, con, name):
    _, _, problem = differences(llm.QUERIES[name](spark, SF_DIR), con, llm.ORACLES[name])
    assert problem is None, problem


# --- quality -------------------------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = llm.QUERIES["op3_quality_classifier"](spark, sf_dir)
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = got.join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 80
    right = [r["predicted"] == r["quality"] for r in rows]
    assert sum(right) / len(right) > 0.95
    assert all((r["score"] >= 0.5) == (r["predicted"] == 1) for r in rows)
    for r in got.limit(50).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)


def test_quality_of_odd_documents(spark, odd_docs):
    labels = spark.createDataFrame(
        [(1, 1), (3, 0), (9, 1), (9, 0), (7, None), (None, 1), (5, 1), (4, 0)],
        "doc_id LONG, quality INT",
    )
    model = quality_gam.train(odd_docs, labels)
    rows = quality_gam.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    kept = quality_gam.keep_good(odd_docs, model)
    assert kept.columns == odd_docs.columns
    assert kept.count() == sum(r["predicted"] for r in rows)


def test_distinct_words_are_those_of_the_whole_text():
    place = [quality_gam.FEATURES.index(n) for n in ("distinct", "least_distinct")]
    fresh = [f"w{i}" for i in range(2000)]

    def shares(words):
        return [quality_gam.features(" ".join(words).encode())[k] for k in place]

    assert shares(fresh) == [1.0, 1.0] and shares([]) == [0.0, 0.0]
    assert shares(["a", "b", "a", "c"]) == [0.75, 0.75]
    assert shares(fresh[:500] + ["junk"] * 500) == [(1 + 1 / 500) / 2, 1 / 500]
    # the last words count as well, at every length
    assert shares(fresh[:501]) == [1.0, 1.0]
    assert shares(fresh[:501] + ["junk"] * 499) == [(1 + 2 / 500) / 2, 2 / 500]
    tail = shares(fresh[:1000] + ["junk"] * 100)
    assert tail[1] == 401 / 500 and tail[0] == pytest.approx((2 + 401 / 500) / 3)


def test_quality_without_labels_or_documents(spark, make_docs):
    none = spark.createDataFrame([], "doc_id LONG, quality INT")
    model = quality_gam.train(make_docs([(1, "x")]), none)
    assert [r["score"] for r in quality_gam.score(make_docs([(1, "x")]), model).collect()] == [0.5]
    assert quality_gam.score(make_docs([]), model).collect() == []


def test_model_learns_an_interaction():
    """Neither feature tells anything alone."""
    r = np.random.default_rng(1)
    x = r.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.9


def test_held_out_rows_never_teach(spark, make_docs):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 == 1]
    docs = make_docs([(i, f"text {i}") for i in ids])
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id LONG, quality INT")
    model = quality_gam.train(docs, labels)
    assert {r["score"] for r in quality_gam.score(docs, model).collect()} == {0.5}


# --- licenses ------------------------------------------------------------------------------


def test_licenses_are_found_in_any_spelling(make_docs):
    mit = licenses.KNOWN["MIT"]
    odd = "Copyright (c) 2020 Jane Doe\n" + mit.upper().replace(",", " ;").replace("LICENSE", "LICENCE")
    docs = make_docs([
        (1, odd), (2, mit + " extra"), (3, None), (4, ""), (5, "prose\nReleased under the MIT Licence!"),
        (6, "Licensed under CC BY 4.0"), (None, "Released under the MIT License."),
        (7, "Released under the MIT License."), (7, "Released under the MIT License."),
    ])
    rows = licenses.scan(docs).collect()
    assert len(rows) == 9
    got = {r["doc_id"]: (r["license_id"], r["notices"]) for r in rows}
    assert got[1] == ("MIT", "MIT-text") and got[2] == (None, "") and got[3] == got[4] == (None, "")
    assert got[5] == (None, "MIT-notice")
    assert got[6] == ("CC-BY-4.0-notice", "CC-BY-4.0-notice")
    assert got[7] == ("MIT-notice", "MIT-notice") and got[None] == ("MIT-notice", "")
    assert licenses.scan(make_docs([])).collect() == []


def test_license_texts_are_found_without_title_wrapped_and_inside(make_docs):
    import textwrap

    def untitled(name):
        return licenses.KNOWN[name].split("\n\n")[-1]

    bsd = untitled("BSD-3-Clause")
    at = bsd.index("COPYRIGHT HOLDER OR")
    zlib_ = "\n".join(textwrap.wrap(licenses.KNOWN["Zlib"], 60))
    docs = make_docs([
        (1, bsd[:at] + "\n" + bsd[at:]), (2, untitled("ISC")), (3, untitled("0BSD")),
        (4, "prose\n\n" + zlib_ + "\n\nmore prose"),
        (5, "Copyright (c) 2020 Jane Doe " + untitled("MIT")),
        (6, "Copyright 2019, 2020 The Authors\nAll rights reserved.\n\n" + untitled("BSD-2-Clause")),
        (7, "code\n" + "\n".join(textwrap.wrap(untitled("MIT"), 70)) + " extra"),
        (8, "Copyright (c) 2020 Jane Doe"), (9, ""), (10, "(c) You must keep all notices"),
    ])
    rows = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    got = {i: (r["license_id"], r["notices"]) for i, r in rows.items()}
    assert got[1] == ("BSD-3-Clause-text", "BSD-3-Clause-text")
    assert got[2] == ("ISC-text", "ISC-text") and got[3] == ("0BSD-text", "0BSD-text")
    assert got[4] == (None, "Zlib") and got[5][0] == "MIT-text"
    assert got[6] == ("BSD-2-Clause-text", "BSD-2-Clause-text")
    assert got[7] == got[8] == (None, "")
    assert rows[8]["digest"] != rows[9]["digest"] != rows[10]["digest"]


def test_licenses_with_many_holders_other_titles_and_typography(make_docs):
    grant = licenses.KNOWN["MIT-text"]
    holders = ", ".join(f"Holder Number {i} <h{i}@example.org>" for i in range(400))
    curly = grant.replace('"Software"', "\u201cSoftware\u201d").replace('"AS IS"', "\u201eAS IS\u201c")
    docs = make_docs([
        (1, "MIT License\n\nCopyright (c) 2020 " + holders + "\n" + grant),
        (2, curly.replace("to deal", "to\u00a0deal").replace(", free", " \u2013 free")),
        (3, "\ufeff\u2022 " + grant + " \u2026"),
        (4, "The MIT License\n\n" + grant), (5, "# The new BSD licence #\r\n" + licenses.ALL_KNOWN["BSD-3-Clause-text"]),
        (6, "Copyright by " + "x\U0001f600" * 100_000 + " 2020 and " + "y" * 300_000 + "\n" + grant),
        (7, "This is the license of a work that has far more words\n" + grant),
        (8, "License\nReleased under the MIT License."), (9, "license " * 50_000), (10, "License\n"),
        (11, "\u00a9 " + holders + " Permission is hereby granted" + grant[len("Permission is hereby granted"):]),
    ])
    got = {r["doc_id"]: r["license_id"] for r in licenses.scan(docs).collect()}
    assert got == {
        1: "MIT", 2: "MIT-text", 3: "MIT-text", 4: "MIT-text", 5: "BSD-3-Clause-text", 6: "MIT-text",
        7: None, 8: None, 9: None, 10: None, 11: "MIT-text",
    }


def test_license_lines_of_the_body_stay(make_docs):
    """Words of a license that begin a line with "copyright" are no copyright line."""
    bsd = licenses.ALL_KNOWN["BSD-2-Clause-text"]
    at = bsd.index("COPYRIGHT HOLDERS AND")
    docs = make_docs([(1, bsd[:at] + "\n" + bsd[at:]), (2, "copyright notice and all of its words")])
    got = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    assert got[1]["license_id"] == "BSD-2-Clause-text"
    assert got[2]["digest"] == hashlib.sha256(b"copyright notice and all of its words").hexdigest()


def test_licenses_stay_in_the_jvm(odd_docs):
    plan = licenses.scan(odd_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- preferences ---------------------------------------------------------------------------


def turns(spark, rows):
    df = spark.createDataFrame(rows, "pair_id LONG, turn INT, role STRING, text STRING")
    return df.withColumns({"place": F.lit(1), "a": F.lit(2), "side": F.lit("x")})


def brute_format(chosen, rejected):
    def order(rows):
        best = {}
        for p, t, r, x in rows:
            if p is not None and t is not None:
                said = (r or "", x or "")
                best[p, t] = min(best.get((p, t), said), said)
        out = {}
        for (p, _), said in sorted(best.items()):
            out.setdefault(p, []).append(said)
        return out

    def render(said):
        text, spans = "", []
        for role, words in said:
            head = f"<|{role}|>\n"
            if role == "assistant":
                at = len(text) + len(head)
                spans.append((at, at + len(words) + len("<|end|>")))
            text += f"{head}{words}<|end|>\n"
        return text, spans

    a, b = order(chosen), order(rejected)
    out = {}
    for p in a.keys() | b.keys():
        x, y = a.get(p, []), b.get(p, [])
        n = next((i for i, (u, v) in enumerate(zip(x, y)) if u != v), min(len(x), len(y)))
        left, right = render(x[n:]), render(y[n:])
        out[p] = (n, render(x[:n])[0], left[0], right[0], left[1], right[1])
    return out


def test_preferences_equal_brute_force(spark):
    r = random.Random(8)
    sides = []
    for _ in range(2):
        rows = [
            (p, t, r.choice(["user", "assistant", None]), r.choice(["hi", "ñó 日本", "", None, "bye"]))
            for p in range(40)
            for t in range(r.randrange(5))
        ]
        sides.append(rows + rows[:7] + [(None, 1, "user", "x"), (3, None, "user", "x")])
    sides[1] += [row for row in sides[0] if row[0] is not None and row[0] >= 20]
    got = {
        r["pair_id"]: (
            r["shared"], r["prompt"], r["chosen"], r["rejected"],
            [(s["begin"], s["end"]) for s in r["chosen_spans"]],
            [(s["begin"], s["end"]) for s in r["rejected_spans"]],
        )
        for r in preferences.format_pairs(*(turns(spark, rows) for rows in sides)).collect()
    }
    assert got == brute_format(*sides)


def test_preferences_of_nothing(spark):
    assert preferences.format_pairs(turns(spark, []), turns(spark, [])).collect() == []


# --- repeated passages ---------------------------------------------------------------------


def brute_removed(rows):
    raw = [(t or "").encode() for _, t in rows]
    # a window's first place, as one number: millions of small lists would be slow to collect
    seen = {}
    gone = [bytearray(len(x)) for x in raw]
    for k, x in enumerate(raw):
        for i in range(len(x) - 199):
            first = seen.setdefault(x[i : i + 200], k << 32 | i)
            if first != k << 32 | i:
                for k_, i_ in ((k, i), (first >> 32, first & (1 << 32) - 1)):
                    gone[k_][i_ : i_ + 200] = b"\1" * 200
    out = []
    for (doc_id, _), x, g in zip(rows, raw, gone):
        spans = sum(1 for i in range(len(g)) if g[i] and (i == 0 or not g[i - 1]))
        kept = bytes(c for c, flag in zip(x, g) if not flag)
        out.append((doc_id, len(x), sum(g), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def removed_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def passages():
    """Texts that share passages of many lengths, at edges, across each other and within."""
    r = random.Random(12)
    alphabet = "abcdefgh é\n"

    def prose(n):
        return "".join(r.choice(alphabet) for _ in range(n))

    shared = [prose(n) for n in (150, 199, 200, 201, 230, 300, 420, 700, 1500)]
    pairs = []
    for i in range(70):
        text = prose(r.randrange(400))
        for _ in range(r.randrange(3)):
            piece = r.choice(shared)
            cut = r.randrange(60)
            text += piece[cut : len(piece) - r.randrange(60)] + prose(r.randrange(300))
        pairs.append((i, text))
    pairs += [(100, "x" * 777), (101, "ab" * 300), (102, pairs[3][1]), (103, shared[8])]
    pairs += [(104, shared[8] + "!"), (105, "?" + shared[8]), (106, "Und " * 90)]
    return pairs


@pytest.mark.parametrize("crowd", [1, 4096])
def test_removed_bytes_equal_brute_force(spark, make_docs, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    pairs = passages()
    got = removed_rows(suffix_dedup.removed(make_docs(pairs)))
    assert got == brute_removed(pairs)
    assert sum(row[2] for row in got) > 10_000


def test_a_passage_of_many_texts_does_not_meet_in_one_group(make_docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CROWD", 20)
    most = {}
    for step, key in (("dictionary_order", "name"), ("settled", "code")):

        def counted(rows, step=step, key=key, whole=getattr(suffix_dedup, step)):
            sizes = rows.groupBy(key).count().agg(F.max("count")).first()
            most[step] = sizes[0] or 0
            return whole(rows)

        monkeypatch.setattr(suffix_dedup, step, counted)
    r = random.Random(5)

    def prose(n):
        return "".join(r.choices("abcdefgh é\n", k=n))

    shared = {230: prose(230), 600: prose(600)}
    pairs = [(i, prose(300) + shared[230 if i % 3 else 600] + prose(300)) for i in range(240)]
    pairs += [(500, prose(40) + shared[230]), (501, shared[600][:210] + prose(90))]
    got = removed_rows(suffix_dedup.removed(make_docs(pairs)))
    assert got == brute_removed(pairs)
    # a row per window and task, not one per text
    assert most["dictionary_order"] <= 20 and 0 < most["settled"] <= 20


def test_removed_from_odd_documents(odd_docs, make_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert removed_rows(suffix_dedup.removed(odd_docs)) == brute_removed(rows)
    assert suffix_dedup.removed(make_docs([])).collect() == []


def test_removed_query(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    got = removed_rows(llm.QUERIES["op9_suffix_array_dedup"](spark, SF_DIR))
    assert got == brute_removed([(r["doc_id"], r["text"]) for r in rows])


def test_cleaned_keeps_rows_and_columns(odd_docs):
    got = suffix_dedup.cleaned(odd_docs)
    assert got.columns == odd_docs.columns and got.count() == odd_docs.count()
    left = {r["doc_id"]: (r["text"], r["n_chars"], r["cid"], r["kept"]) for r in got.collect()}
    assert left[1] == ("", 0, 1, "x") and left[7] == ("one", 3, 1, "x")
    assert left[4] == (None, None, 1, "x")
    assert left[3][0].endswith("tail") and left[3][1] == len(left[3][0]) < 200


# --- fingerprints --------------------------------------------------------------------------


def brute_sketch(text):
    words = [xxhash.xxh64_intdigest(w, 42) for w in text.encode().lower().split()]
    hashes = set()
    for i in range(max(len(words) - 4, 1) if words else 0):
        h = 42
        for w in words[i : i + 5]:
            h = xxhash.xxh64_intdigest(struct.pack("<Q", w), h)
        hashes.add(h)
    return sorted(h for h in hashes if h < 1 << 61) or [min(hashes)] if hashes else []


def brute_fingerprints(rows):
    def like(a, b):
        return len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0

    def text(kept):
        return "".join(f"{h:016x}" for h in kept)

    placed = sorted((i, t or "") for i, t in rows if i is not None)
    out = []
    for k, (i, t) in enumerate(placed):
        after = placed[(k + 1) % len(placed)][1]
        tail = len(t) // 4
        edited = t[: len(t) - tail] + after[:tail]
        a, b, c = brute_sketch(t), brute_sketch(edited), brute_sketch(after)
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out.append((i, len(t), sha, text(a), text(b), like(a, b), like(a, c)))
    return sorted(out)


def test_fingerprints_equal_brute_force(odd_docs, make_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = [tuple(r) for r in sketches.fingerprints(odd_docs).collect()]
    assert sorted(r for r in got if r[0] is not None) == brute_fingerprints(rows)
    (alone,) = [r for r in got if r[0] is None]
    assert alone[1] == 17 and alone[6] is None
    assert sketches.fingerprints(make_docs([])).collect() == []
    (single,) = sketches.fingerprints(make_docs([(3, "a b c d e f g h")])).collect()
    assert tuple(single) == brute_fingerprints([(3, "a b c d e f g h")])[0]


def test_fingerprint_query_and_its_plan(spark):
    df = llm.QUERIES["op10_document_fingerprints"](spark, SF_DIR)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    want = brute_fingerprints([(r["doc_id"], r["text"]) for r in rows])
    assert sorted(tuple(r) for r in df.collect()) == want


def test_ids_in_far_clusters_keep_their_order(make_docs):
    """Ranges of ids follow the ids, however they are spread."""
    r = random.Random(5)
    ids = [r.randrange(-(2**63), 2**63) for _ in range(30)]
    ids += [5 + i for i in range(1500)] + [2**62 + i * 7 for i in range(40)]
    rows = [(i, f"text number {k} of many " * (k % 5)) for k, i in enumerate(ids)]
    got = sorted(tuple(x) for x in sketches.fingerprints(make_docs(rows)).collect())
    assert got == brute_fingerprints(rows)


def test_sketches_merge_and_contain(spark):
    words = [f"w{i}" for i in range(900)]
    rows = [(" ".join(words[:600]), " ".join(words[400:]), " ".join(words))]
    df = spark.createDataFrame(rows, "x STRING, y STRING, z STRING")
    kept = {c: sketches.sketch(F.col(c)) for c in "xyz"}
    got = df.select(
        sketches.merge(kept["x"], kept["y"]).alias("m"),
        kept["z"].alias("z"),
        sketches.containment(kept["x"], kept["z"]).alias("inside"),
        sketches.containment(kept["z"], kept["x"]).alias("around"),
    ).first()
    assert set(got["m"]) == set(got["z"]) and got["inside"] == 1.0
    assert 0.5 < got["around"] < 0.85


def test_a_short_text_in_a_long_one_is_contained_or_not_estimated(spark):
    r = random.Random(6)
    word = lambda: "".join(r.choices("abcdefgh", k=6))
    rows = []
    for _ in range(120):
        short = " ".join(word() for _ in range(r.randrange(5, 13)))
        around = [" ".join(word() for _ in range(500)) for _ in range(2)]
        rows.append((short, f"{around[0]} {short} {around[1]}"))
    texts = spark.createDataFrame(rows, "short STRING, long STRING")
    inside = sketches.containment(sketches.sketch(F.col("short")), sketches.sketch(F.col("long")))
    got = [row[0] for row in texts.select(inside).collect()]
    assert set(got) == {1.0, None} and 10 < got.count(None) < 110
