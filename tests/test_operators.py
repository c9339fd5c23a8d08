"""Operators against plain Python on small random tables."""

from __future__ import annotations

import datetime as dt
import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregates, joins, pointintime, topk, windows
from tidemark.operators import history as h
from tidemark.plans import reports


def money(cents):
    return None if cents is None else Decimal(cents).scaleb(-2)


@pytest.mark.parametrize("top", [9, 40_000, 10**11, 10**15])
def test_exact_median(spark, top):
    """One to three levels of cells; negative values; a group with NULL as its key."""
    rng = random.Random(top)
    rows = [
        (rng.choice(["a", "b", None]), money(rng.choice([None, rng.randint(-top, top)])))
        for _ in range(401)
    ]
    df = spark.createDataFrame(rows, "g STRING, v DECIMAL(18,2)")
    got = {r.g: r.m for r in aggregates.exact_median(df, ["g"], "v", "m").collect()}
    for group in ("a", "b", None):
        values = [v for g, v in rows if g == group and v is not None]
        assert got[group] == statistics.median(values)
    everything = aggregates.exact_median(df, [], "v", "m").first().m
    assert everything == statistics.median([v for _, v in rows if v is not None])


def test_exact_median_of_one_hot_value(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"))
    want = statistics.median([7 if i % 3 == 0 else i for i in range(3000)])
    assert float(aggregates.exact_median(df, [], "v", "m").first().m) == want


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("ties", ["min", "average"])
def test_global_rank(spark, descending, ties):
    rng = random.Random(5)
    values = [rng.choice([None, 5, rng.randint(-(10**13), 10**13), rng.randint(0, 9)]) for _ in range(300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id INT, v BIGINT")
    ranked = windows.global_rank(df, "v", "r", descending, ties, hot=[5])
    got = {r.id: r.r for r in ranked.collect()}
    known = [v for v in values if v is not None]
    assert len(got) == len(values)
    for i, v in enumerate(values):
        if v is None:
            assert got[i] is None
            continue
        before = sum(1 for w in known if (w > v if descending else w < v))
        first = before + 1
        assert got[i] == (first if ties == "min" else first + (known.count(v) - 1) / 2)


def test_global_rank_asks_for_exact_types(spark):
    with pytest.raises(TypeError, match="decimal"):
        windows.global_rank(spark.range(3).select(F.col("id").cast("double").alias("v")), "v")


def test_heavy_keys_finds_the_third(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert joins.heavy_keys(df, "k") == [-1]
    assert joins.heavy_keys(df.filter("k > 0"), "k") == []


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
@pytest.mark.parametrize("hot", [(), (1,), (1, 2, 99)])
def test_salted_join_equals_plain_join(spark, how, hot):
    rng = random.Random(1)
    rows = [(i, rng.choice([1, 1, 1, 2, 3, None])) for i in range(200)]
    left = spark.createDataFrame(rows, "id INT, k INT")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (7, "u")], "rk INT, v STRING")
    plain = left.join(right, F.col("k") == F.col("rk"), how).drop("rk")
    salted = joins.salted_join(left, right, "k", "rk", how, hot=hot)
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_salted_join_spreads_the_hot_key(spark):
    """Rows of the hot key end in several shuffle partitions."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(5000).select("id", F.lit(1).alias("k"))
        right = spark.createDataFrame([(1, "x")], "rk INT, v STRING")
        joined = joins.salted_join(left, right, "k", "rk", hot=[1])
        parts = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(parts) > 1 and sum(p["count"] for p in parts) == 5000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize(
    "listed, kept", [([], [1, 2, None]), ([2], [1]), ([2, None], []), ([9], [1, 2])]
)
def test_not_in(spark, listed, kept):
    df = spark.createDataFrame([(1,), (2,), (None,)], "a INT")
    other = spark.createDataFrame([(v,) for v in listed], "b INT")
    got = [r.a for r in joins.not_in(df, "a", other, "b").collect()]
    assert sorted(got, key=str) == sorted(kept, key=str)


def test_first_qualifying_key_is_known(spark, tmp_path):
    """The first customer with three states; orders without a customer come last."""
    from tidemark.catalogue import relational

    rows = [(k, who, s, 10.0, dt.datetime(2020, 1, 1)) for k, who, s in [
        (1, None, "F"), (2, None, "O"), (3, None, "P"), (4, 7, "F"), (5, 7, "O"), (6, 7, "P"),
        (6, 7, "P"), (7, 9, "F"), (8, 9, "O"), (9, 9, "P"), (10, 1, "F"),
    ]]
    schema = "o_orderkey INT, o_custkey INT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/orders.parquet")
    found = relational.filter_first_qualifying(spark, str(tmp_path))
    assert sorted(r.o_orderkey for r in found.collect()) == [4, 5, 6, 6]


def test_top_bottom_keeps_ties_and_tags_both_tails_as_top(spark):
    rows = [("a", 9), ("b", 9), ("c", 8), ("d", 8), ("e", 1), ("f", None)]
    df = spark.createDataFrame(rows, "g STRING, v INT")
    got = {r.g: r.revenue_group for r in topk.top_bottom(df, "v", 3).collect()}
    assert got == {"a": "Top 3", "b": "Top 3", "c": "Top 3", "d": "Top 3", "e": "Bottom 3"}
    few = topk.top_bottom(df.filter("v = 9"), "v", 3).collect()
    assert {r.revenue_group for r in few} == {"Top 3"}


def test_with_total_equals_the_global_aggregate(spark):
    rows = [("a", 1), ("a", 2), (None, 5), ("b", None)]
    df = spark.createDataFrame(rows, "g STRING, v INT")
    aggs = [F.sum("v").alias("s"), F.count("*").alias("n")]
    got = aggregates.with_total(df, ["g"], aggs, "ALL").collect()
    total = [r for r in got if r.is_total == 1]
    assert [(r.g, r.s, r.n) for r in total] == [("ALL", 8, 4)]
    # a NULL group is a group, not the total
    assert {(r.g, r.s) for r in got if r.is_total == 0} == {("a", 3), (None, 5), ("b", None)}


def test_pct_change_needs_the_month_before_and_a_base(spark):
    months = [(1, 4), (2, 5), (4, 6), (5, 0), (6, 3)]
    df = spark.createDataFrame(
        [("g", dt.date(2020, m, 1), n) for m, n in months], "g STRING, m DATE, n INT"
    )
    rows = windows.pct_change(df, ["g"], "m", {"change": "n"}).orderBy("m").collect()
    want = [None, Decimal("25.00"), None, Decimal("-100.00"), None]
    assert [r.change for r in rows] == want


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "g STRING, n INT")
    got = {r.g: r.p for r in windows.share_of_total(df, {"p": "n"}).collect()}
    assert got == {"a": Decimal("33.3"), "b": Decimal("66.7")}


@pytest.mark.parametrize(
    "n, label",
    [(2, "2 listings"), (3, "3 to 5 listings"), (5, "3 to 5 listings"),
     (6, "6 to 10 listings"), (10, "6 to 10 listings"), (11, "11 listings or more")],
)
def test_portfolio_buckets(spark, n, label):
    got, _ = aggregates.bucketize("n", reports.PORTFOLIO_BOUNDS, reports.PORTFOLIO_LABELS)
    assert spark.createDataFrame([(n,)], "n INT").select(got).first()[0] == label


def test_spearman_of_a_monotone_pair(spark):
    df = spark.range(100).select(F.col("id").alias("x"), (F.col("id") * F.col("id")).alias("y"))
    assert reports.spearman(df, "x", "y").first()[0] == pytest.approx(1.0)


def ranks_of(values, ties):
    """The rank of each value among all, ties at their first place or their middle."""
    below = {v: sum(w < v for w in values) for v in set(values)}
    same = {v: values.count(v) for v in set(values)}
    return [below[v] + (1 if ties == "min" else (same[v] + 1) / 2) for v in values]


@pytest.mark.parametrize("ties", ["min", "average"])
@pytest.mark.parametrize("hot", [False, True])
def test_spearman_counts_equal_pairs_once(spark, ties, hot):
    """Half of all rows share x, money on the other side, rows without a value are left out."""
    rng = random.Random(11)
    rows = []
    for _ in range(500):
        x = rng.choice([7, 7, rng.randint(-40, 40), None])
        rows.append((x, rng.choice([None, money((x or 0) * 50 + rng.randint(-900, 900))])))
    df = spark.createDataFrame(rows, "x INT, y DECIMAL(12,2)")
    full = [(x, y) for x, y in rows if x is not None and y is not None]
    want = statistics.correlation(*[ranks_of(list(side), ties) for side in zip(*full)])
    some = {"hot_x": (7,), "hot_y": (Decimal("3.50"),)} if hot else {}
    assert reports.spearman(df, "x", "y", ties, **some).first()[0] == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize("ties", ["min", "average"])
def test_spearman_without_spread_is_null(spark, ties):
    df = spark.range(30).select(F.lit(3).alias("x"), F.col("id").alias("y"))
    for rows in (df, df.limit(1), df.limit(0)):
        assert reports.spearman(rows, "x", "y", ties).first()[0] is None


def test_spearman_sends_pairs_and_not_rows(spark, plain_shuffles):
    """After the count of pairs, whose shuffle is partial already, no row meets a rank."""
    rows = spark.range(20_000).select((F.col("id") % 4).alias("x"), (F.col("id") % 3).alias("y"), "id")
    corr = reports.spearman(rows, "x", "y")
    text = corr._jdf.queryExecution().executedPlan().toString()
    # the rows are read for the counts alone; margins and pairs share one shuffle of them
    assert text.count("Range (") == 1 and text.count("ReusedExchange") >= 2
    assert corr.first()[0] == pytest.approx(0.0, abs=1e-3)


def test_portfolios_against_plain_python(spark, plain_shuffles):
    """Listings that move, repeat a month or have no id, hosts and months that are not known."""
    rng = random.Random(3)
    months = [dt.date(2020, m, 1) for m in (5, 6, 7)] + [None]
    rows = [
        (rng.choice([1, 1, 1, *range(2, 40), None]), rng.choice([*range(60), None]),
         rng.choice(months), rng.choice([10, 10, 10, 20, 30, None]))
        for _ in range(900)
    ]
    df = spark.createDataFrame(rows, "host_id INT, listing_id INT, month_date DATE, lga_code INT")
    hosts = reports.host_portfolios(df.repartition(7))
    want = {}
    for host in {h for h, _, _, a in rows if a is not None}:
        own = {(x, m, a) for h, x, m, a in rows if h == host and a is not None}
        in_month = [{(x, a) for x, k, a in own if k == m} for m in {m for _, m, _ in own}]
        listings = [len({x for x, _ in s} - {None}) for s in in_month]
        want[host] = (
            len({x for x, _, _ in own} - {None}),
            len({a for _, _, a in own}),
            max(listings),
            max(len({a for _, a in s}) for s in in_month),
            sum(listings),
        )
    assert {r[0]: tuple(r[1:]) for r in hosts.collect()} == want
    text = hosts._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in text and "Join" not in text and text.count("Exchange ") == 4
    assert hosts.filter("host_id IS NULL").count() == 1


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = windows.latest_per_key(df, ["k"], [F.col("id").desc()])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2
    assert {(r.k, r.id) for r in plan.collect()} == {(0, 99), (1, 97), (2, 98)}


# --- history -----------------------------------------------------------------


def random_observations(seed):
    """(key, month, attribute, order) with gaps and repeats inside a month."""
    rng = random.Random(seed)
    return [
        (rng.randint(1, 12), dt.date(2020, rng.randint(1, 12), 1), rng.choice("xyz"), i)
        for i in range(150)
    ]


SCHEMA = "k INT, m DATE, a STRING, o INT"


def stepwise(rows):
    """Row-at-a-time model: one snapshot per month in order."""
    versions = {}
    for month in sorted({r[1] for r in rows}):
        latest = {}
        for k, m, a, o in rows:
            if m == month and (k not in latest or o > latest[k][1]):
                latest[k] = (a, o)
        for k, (a, _) in latest.items():
            chain = versions.setdefault(k, [])
            if chain:
                chain[-1][2] = month
            chain.append([a, month, None])
    return {(k, *v) for k, chain in versions.items() for v in chain}


def as_set(df):
    return {(r.k, r.a, r.valid_from, r.valid_to) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_batch_history_equals_repeated_snapshots(spark, seed, tmp_path):
    rows = random_observations(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    batch = h.build_history(df, "k", "m", [F.col("o").desc()])
    assert as_set(batch) == stepwise(rows)
    table = h.HistoryTable(spark, str(tmp_path / "t"), "k", "m")
    for month in sorted({r[1] for r in rows})[:5]:
        latest = windows.latest_per_key(
            df.filter(F.col("m") == F.lit(month)), ["k"], [F.col("o").desc()]
        )
        table.apply(latest)
        table.apply(latest)  # the same again changes nothing
    first = [r for r in rows if r[1] <= sorted({r[1] for r in rows})[4]]
    assert as_set(table.read()) == stepwise(first)


@pytest.mark.parametrize("seed", [3, 4])
def test_several_snapshots_at_once_equal_one_after_the_other(spark, seed, tmp_path):
    """A backlog of months in two steps, the second of which repeats a month of the first."""
    rows = random_observations(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    table = h.HistoryTable(spark, str(tmp_path / "t"), "k", "m")
    order = [F.col("o").desc()]
    months = sorted({r[1] for r in rows})
    table.apply_all(df.filter(F.col("m") <= F.lit(months[6])), order)
    other = df.filter(F.col("m") == F.lit(months[6])).withColumn("a", F.lit("changed"))
    table.apply_all(df.filter(F.col("m") > F.lit(months[6])).unionByName(other), order)
    # a key not seen in that month before starts with it; no other version changes
    want = stepwise(rows)
    got = as_set(table.read())
    assert {v for v in got if v[1] != "changed"} <= want
    assert {(k, start, end) for k, _, start, end in got} == {(k, start, end) for k, _, start, end in want}


@pytest.mark.parametrize("hot", [(), (1, 2)])
def test_snapshots_with_known_hot_keys_share_one_shuffle(spark, hot, tmp_path):
    """As without them, with a column that only settles the order and is not kept."""
    rows = random_observations(5)
    months = sorted({r[1] for r in rows})
    df = spark.createDataFrame(rows, SCHEMA)
    order, kept = [F.col("o").desc()], [c for c in df.columns if c != "o"]
    table = h.HistoryTable(spark, str(tmp_path / "t"), "k", "m")
    for part in (F.col("m") <= F.lit(months[6]), F.col("m") > F.lit(months[6])):
        steps = h.scd2_apply_all(
            table.open_versions(), df.filter(part), "k", "m", order, hot, kept
        )
        plan = steps._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") == (2 if hot else 1)
        table.apply_all(df.filter(part), order, hot, kept)
    found = table.read()
    assert as_set(found) == stepwise(rows) and "o" not in found.columns
    ids = found.filter(F.col("version_id").eqNullSafe(h.version_id("k", "valid_from")))
    assert ids.count() == found.count()


@pytest.mark.parametrize("seed", [3, 6])
def test_a_cut_writes_open_versions_only(spark, seed, tmp_path):
    """As if the months since then had never come, over several cuts and the steps between them."""
    rows = random_observations(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    months = sorted({r[1] for r in rows})
    order = [F.col("o").desc()]
    table = h.HistoryTable(spark, str(tmp_path / "t"), "k", "m")
    table.apply_all(df.filter(F.col("m") <= F.lit(months[5])), order)
    table.apply_all(df.filter(F.col("m") > F.lit(months[5])), order)
    upto = lambda n: [r for r in rows if r[1] < months[n]]
    for n in (7, 4):
        batch = table.cut(months[n])
        assert as_set(table.read()) == stepwise(upto(n))
        states = {p.parent.name for p in (tmp_path / f"t/versions/batch={batch}").rglob("*.parquet")}
        assert states == {"state=open"}
        assert {r.valid_to for r in table.open_versions().collect()} == {None}
        table.vacuum()
        assert as_set(table.read()) == stepwise(upto(n))
        # a month comes again, then all
        table.apply_all(df.filter(F.col("m") == F.lit(months[n])), order)
        assert as_set(table.read()) == stepwise(upto(n + 1))
    table.apply_all(df.filter(F.col("m") > F.lit(months[4])), order)
    assert as_set(table.read()) == stepwise(rows)


def test_version_ids_are_made_by_readers(spark, tmp_path):
    """An id that follows from key and start is not stored, any other one is."""
    rows = [(1, dt.date(2020, 1, 1), "x", 1), (2, dt.date(2020, 1, 1), "y", 1)]
    table = h.HistoryTable(spark, str(tmp_path / "t"), "k", "m")
    history = h.build_history(spark.createDataFrame(rows, SCHEMA), "k", "m")
    own = F.when(F.col("k") == 2, "own").otherwise(F.col("version_id"))
    table.replace(history.withColumn("version_id", own))
    want = {r.k: r.version_id for r in history.collect()} | {2: "own"}
    assert {r.k: r.version_id for r in table.read().collect()} == want
    files = [str(p) for p in (tmp_path / "t/versions").rglob("*.parquet")]
    assert all(".zstd." in f for f in files)
    stored = spark.read.parquet(str(tmp_path / "t/versions")).collect()
    assert {r.k: r.version_id for r in stored} == {1: None, 2: "own"}
    table.apply_all(spark.createDataFrame([(k, dt.date(2020, 2, 1), "z", 1) for k in (1, 2)], SCHEMA))
    assert {r.k: r.version_id for r in table.read().filter("a <> 'z'").collect()} == want


def test_snapshot_step_rules(spark):
    day = lambda d: dt.date(2020, 1, d)
    first = spark.createDataFrame([(1, "x", day(5)), (2, "x", day(5))], "k INT, a STRING, u DATE")
    second = spark.createDataFrame(
        [(1, "x", day(6)), (2, "y", day(4)), (3, "z", day(6)), (None, "n", day(6))],
        "k INT, a STRING, u DATE",
    )
    history = h.scd2_apply(h.scd2_apply(None, first, "k", "u"), second, "k", "u")
    got = {(r.k, r.a, r.valid_from, r.valid_to) for r in history.collect()}
    assert got == {
        (1, "x", day(5), day(6)),  # closed although nothing changed
        (1, "x", day(6), None),
        (2, "x", day(5), None),  # the older row is ignored
        (3, "z", day(6), None),
    }


def test_unfinished_batch_is_invisible(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1), "x", 1)], SCHEMA)
    table = h.HistoryTable(spark, str(tmp_path / "t"), "k", "m")
    table.apply(df)
    before = as_set(table.read())
    # batch 2 died after its files and before its commit
    late = spark.createDataFrame([(1, "y")], "k INT, a STRING").withColumn("state", F.lit("open"))
    late.write.partitionBy("state").parquet(str(tmp_path / "t/versions/batch=2"))
    assert as_set(table.read()) == before
    newer = spark.createDataFrame([(1, dt.date(2020, 2, 1), "y", 1)], SCHEMA)
    assert table.apply(newer) == 2
    assert len(as_set(table.read())) == 2


def test_two_versions_in_one_month_give_an_empty_interval(spark):
    loads = [(1, "old", dt.datetime(2020, 3, 2)), (1, "typo", dt.datetime(2020, 7, 4)),
             (1, "new", dt.datetime(2020, 7, 9))]
    df = spark.createDataFrame(loads, "k INT, a STRING, u TIMESTAMP")
    dim = h.to_dimension(h.build_history(df, "k", "u"), "k", ["a"], "d")
    got = {(r.a, r.valid_from, r.valid_to, r.is_current) for r in dim.collect()}
    july = dt.date(2020, 7, 1)
    assert got == {
        ("old", dt.date(1900, 1, 1), july, False),
        ("typo", july, july, False),
        ("new", july, dt.date(9999, 12, 31), True),
    }
    facts = spark.createDataFrame([(1, dt.date(2020, m, 1)) for m in (1, 6, 7, 12)], "k INT, m DATE")
    seen = pointintime.pit_join(facts, dim.select("k", "a", "valid_from", "valid_to"), "k", at="m")
    assert [r.a for r in seen.orderBy("m").collect()] == ["old", "old", "new", "new"]


@pytest.mark.parametrize("seed", [3, 4])
def test_every_fact_row_meets_one_version(spark, seed):
    """Any history gives gap-free intervals; merging equal versions changes no answer."""
    rows = random_observations(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    dim = h.to_dimension(h.build_history(df, "k", "m", [F.col("o").desc()]), "k", ["a"], "d")
    dim = dim.select("k", "a", "valid_from", "valid_to").cache()
    facts = df.select("k", "o", F.add_months("m", F.col("o") % 5 - 2).alias("month_date")).cache()
    full = pointintime.pit_join(facts, dim, "k")
    assert full.count() == facts.count()
    merged = h.collapse_unchanged(dim, "k", ["a"])
    assert merged.count() < dim.count()
    pick = lambda d: sorted((r.o, r.a) for r in d.collect())
    assert pick(pointintime.pit_join(facts, merged, "k")) == pick(full)
    assert pick(pointintime.pit_join(facts, dim, "k", how="left", hot=[1, 2])) == pick(full)


def random_versions(seed):
    """Facts and versions of twelve keys; keys 1 and 2 have most of the facts."""
    rng = random.Random(seed)
    day = dt.date(2020, 1, 1)
    versions = []
    for k in range(12):
        cuts = sorted(rng.sample(range(400), rng.randint(1, 40)))
        for a, b in zip(cuts, [*cuts[1:], 10_000]):
            if rng.random() < 0.8:  # gaps
                versions.append((k, k * 1000 + a, day + dt.timedelta(a), day + dt.timedelta(b)))
        versions.append((k, -1, day + dt.timedelta(cuts[0]), day + dt.timedelta(cuts[0])))
    versions.append((None, -2, day, day + dt.timedelta(900)))
    facts = []
    for i in range(600):
        k = rng.choice([1, 1, 1, 2, 2, rng.randrange(14), None])
        at = 77 if k == 1 and i % 3 else rng.randrange(420)
        facts.append((i, k, None if i % 50 == 0 else day + dt.timedelta(at)))
    return facts, versions


def brute_matches(facts, versions):
    return {
        i: [v for key, v, a, b in versions if k is not None and key == k and at and a <= at < b]
        for i, k, at in facts
    }


@pytest.mark.parametrize("seed", [5, 6])
@pytest.mark.parametrize("hot", ["none", "keys", "slices"])
def test_point_in_time_join_by_timeline(spark, plain_shuffles, seed, hot):
    facts, versions = random_versions(seed)
    df = spark.createDataFrame(facts, "i INT, k INT, at DATE").repartition(5)
    dim = spark.createDataFrame(versions, "k INT, v INT, valid_from DATE, valid_to DATE")
    slices = pointintime.date_slices(df, "k", "at")
    # a date with many rows is dealt to several copies
    assert set(slices) >= {1, 2} and max(copies for _, copies in slices[1]) > 2
    assert len(slices[1]) > 2 and sum(len(s) for s in slices.values()) <= 16 + len(slices)
    spread = {"none": (), "keys": (1, 2, 99), "slices": slices}[hot]
    want = brute_matches(facts, versions)
    inner = pointintime.pit_join(df, dim, "k", "at", hot=spread)
    assert inner.columns == ["i", "k", "at", "v"]
    assert sorted((r.i, r.v) for r in inner.collect()) == sorted((i, v) for i, m in want.items() for v in m)
    left = pointintime.pit_join(df, dim, "k", "at", "left", spread)
    got = {r.i: r.v for r in left.collect()}
    assert got == {i: m[0] if m else None for i, m in want.items()}
    general = pointintime.pit_join(df, dim, "k", "at", "left", spread, overlapping=True)
    assert {r.i: r.v for r in general.collect()} == got


@pytest.mark.parametrize("seed", [5, 6])
def test_facts_and_versions_are_sent_apart(spark, plain_shuffles, seed):
    """The same rows; versions that a window has just made, and sums by key, are not sent again."""
    facts, versions = random_versions(seed)
    df = spark.createDataFrame(facts, "i INT, k INT, at DATE").repartition(5)
    dim = spark.createDataFrame(versions, "k INT, v INT, valid_from DATE, valid_to DATE")
    numbered = windows.version_number(dim, "k", "valid_from")
    for hot in ((), (1, 2)):
        for how in ("inner", "left"):
            want = pointintime.pit_join(df, numbered, "k", "at", how, hot)
            got = pointintime.pit_join(df, numbered, "k", "at", how, hot, apart=True)
            assert got.columns == want.columns
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    sums = [
        pointintime.pit_join(df, numbered, "k", "at", apart=apart).groupBy("k", "at", "v").count()
        for apart in (True, False)
    ]
    assert sorted(map(str, sums[0].collect())) == sorted(map(str, sums[1].collect()))
    plans = [s._jdf.queryExecution().executedPlan().toString() for s in sums]
    assert [p.count("Exchange hash") for p in plans] == [2, 3]


def test_point_in_time_join_makes_no_more_rows_than_it_reads(spark, plain_shuffles):
    """120 versions and 120 facts of each key; a hot key costs a row per slice more."""
    month = F.add_months(F.lit("2010-01-01").cast("date"), (F.col("id") % 120).cast("int"))
    facts = spark.range(4800).select((F.col("id") / 120).cast("int").alias("k"), month.alias("at"))
    dim = facts.select("k", F.col("at").alias("valid_from"), F.add_months("at", 1).alias("valid_to"))
    assert pointintime.timeline(facts, dim, "k", "at").count() == 2 * 4800
    joined = pointintime.pit_join(facts, dim.withColumn("v", F.lit(1)), "k", "at")
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 4800 and "Join" not in text and text.count("Exchange hash") == 1
    more = facts.unionByName(facts.filter("k = 7")).unionByName(facts.filter("k = 7").sample(1.0))
    hot = pointintime.date_slices(more.unionByName(more.filter("k = 7")), "k", "at")
    assert list(hot) == [7] and len(hot[7]) > 1
    line = pointintime.timeline(facts, dim, "k", "at", hot=hot)
    copies = sum(n for _, n in hot[7])
    assert line.count() <= 2 * 4800 + copies
    places = line.filter("_key = 7").groupBy("_place").count().collect()
    assert len(places) == copies


@pytest.mark.parametrize("hot", ["none", "slices"])
def test_versions_are_counted_by_a_sweep(spark, plain_shuffles, hot):
    """Overlaps and gaps, repeated row keys, and two dimensions in one pass."""
    facts, versions = random_versions(9)
    versions += [(k, -v, a, b) for k, v, a, b in versions[::3]]
    df = spark.createDataFrame([(*f, f[0] % 500) for f in facts], "i INT, k INT, at DATE, r INT")
    dim = spark.createDataFrame(versions, "k INT, v INT, valid_from DATE, valid_to DATE")
    other = dim.withColumnRenamed("k", "i")
    slices = {"a": pointintime.date_slices(df, "k", "at")} if hot == "slices" else {}
    counted = pointintime.count_versions(df, {"a": (dim, "k"), "b": (other, "i")}, ["r"], "at", slices)
    by_key = brute_matches(facts, versions)
    by_row = brute_matches([(i, i, at) for i, _, at in facts], versions)
    want = {(n, r): 0 for n in "ab" for r in range(500)}
    for i, _, _ in facts:
        want["a", i % 500] += len(by_key[i])
        want["b", i % 500] += len(by_row[i])
    assert {(r.dimension, r.r): r.nb_versions for r in counted.collect()} == want
    assert {0, 1, 2} <= set(want.values())
    text = counted._jdf.queryExecution().executedPlan().toString()
    assert text.count("Window ") == 1 and "SortMergeJoin" not in text


@pytest.mark.parametrize("hot", ["none", "slices"])
def test_versions_are_counted_apart(spark, plain_shuffles, hot):
    """The same counts, facts without a key included; versions of a window are not sent again."""
    facts, versions = random_versions(9)
    versions += [(k, -v, a, b) for k, v, a, b in versions[::3]]
    df = spark.createDataFrame([(*f, f[0] % 500) for f in facts], "i INT, k INT, at DATE, r INT")
    df = df.unionByName(df.limit(20).withColumn("k", F.lit(None).cast("int")))
    dim = spark.createDataFrame(versions, "k INT, v INT, valid_from DATE, valid_to DATE")
    dim = windows.version_number(dim, "k", "valid_from")
    other = windows.version_number(dim.withColumnRenamed("k", "i"), "i", "valid_from")
    slices = {"a": pointintime.date_slices(df, "k", "at")} if hot == "slices" else {}
    dims = {"a": (dim, "k"), "b": (other, "i")}
    want, got = (
        pointintime.count_versions(df, dims, ["r"], "at", slices, apart) for apart in (False, True)
    )
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    if hot == "none":
        plan = got._jdf.queryExecution().executedPlan().toString()
        # of each dimension the versions and the facts, then the sums
        assert plan.count("Exchange hash") - plan.count("ReusedExchange") <= 5


def test_declared_tests_read_each_table_once(spark, plain_shuffles):
    from tidemark.operators import quality

    spark.createDataFrame(
        [(1, "a", 1), (1, None, 2), (2, "a", 9), (None, None, None), (None, "b", 9)],
        "id INT, name STRING, fk LONG",
    ).write.mode("overwrite").parquet(f"{spark.conf.get('spark.checkpoint.dir')}/tested_a")
    spark.createDataFrame([(1, 5), (2, 5), (7, None)], "pk INT, other INT").write.mode(
        "overwrite"
    ).parquet(f"{spark.conf.get('spark.checkpoint.dir')}/tested_b")
    read = lambda n: spark.read.parquet(f"{spark.conf.get('spark.checkpoint.dir')}/tested_{n}")
    tables = {"a": read("a"), "b": read("b"), "none": read("b").limit(0)}
    found = quality.column_tests(
        tables,
        {"a": ["id", "name"], "b": ["pk", "other"], "none": ["pk"]},
        {"a": ["id", "name", "fk"], "b": ["pk"], "none": ["other"]},
        [("a", "fk", "b", "pk"), ("b", "other", "a", "id"), ("none", "pk", "a", "id"),
         ("b", "pk", "none", "pk")],
    )
    assert {(r.table_name, r.column_name, r.test, r.failures) for r in found.collect()} == {
        ("a", "id", "unique", 1), ("a", "name", "unique", 1), ("b", "pk", "unique", 0),
        ("b", "other", "unique", 1), ("none", "pk", "unique", 0), ("a", "id", "not_null", 2),
        ("a", "name", "not_null", 2), ("a", "fk", "not_null", 1), ("b", "pk", "not_null", 0),
        ("none", "other", "not_null", 0), ("a", "fk", "relationships", 2),
        ("b", "other", "relationships", 2), ("none", "pk", "relationships", 0),
        ("b", "pk", "relationships", 3),
    }
    two = {n: tables[n] for n in "ab"}
    plan = quality.column_tests(two, {"a": ["id", "name"], "b": ["pk"]}, {"a": ["fk"]}, [("a", "fk", "b", "pk")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 2 and "SortMergeJoin" not in text


def test_best_types_scan_the_fact_once(spark, plain_shuffles):
    from tidemark.catalogue import tables as t

    s = t.star(spark, "/root/testdata/sf0.001")
    for report in (reports.best_types, reports.best_types_by_occupancy):
        plan = report(s.fact, s.dim_property)._jdf.queryExecution().executedPlan().toString()
        # the fact and the dimension
        assert plan.count("FileScan") == 2


@pytest.fixture
def plain_shuffles(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_equal_rows_are_spread(spark, plain_shuffles, how):
    """Nothing tells the rows of the hot key, or those without a key, apart."""
    half = F.when(F.col("id") % 2 == 0, 7)
    left = spark.range(20_000, numPartitions=8).select(half.alias("k"))
    right = spark.createDataFrame([(7, "x") if how == "left" else (8, "x")], "rk INT, v STRING")
    joined = joins.salted_join(left, right, "k", "rk", how, hot=[7])
    parts = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(p["count"] for p in parts) == 20_000
    assert len(parts) >= 4 and max(p["count"] for p in parts) < 10_000


def test_a_hot_key_of_the_list_is_taken_once(spark, plain_shuffles):
    df = spark.range(100).select((F.col("id") % 10).alias("a"))
    listed = spark.range(30_000).select(F.lit(3).cast("long").alias("b"))
    for lost in (joins.unmatched(df, listed, ("a", "b")), joins.not_in(df, "a", listed, "b")):
        assert lost.count() == 90
        # partial and final, below the join
        assert lost._jdf.queryExecution().executedPlan().toString().count("HashAggregate(keys=[") >= 2


def test_heavy_keys_follow_the_number_of_partitions(spark, plain_shuffles):
    df = spark.range(1600).select(F.when(F.col("id") < 120, 5).otherwise(F.col("id")).alias("k"))
    assert joins.heavy_keys(df, "k") == [5]
    assert joins.heavy_keys(df, "k", share=0.1) == []


def test_latest_per_key_sorts_once_where_hot_keys_are_known(spark):
    """Rows of hot keys and without a key are limited before the shuffle, others only after it."""
    rows = [(i % 50 if i % 3 else 1, i % 4, i) for i in range(600)] + [(None, 0, i) for i in range(9)]
    df = spark.createDataFrame(rows, "k INT, m INT, v INT")
    order = [F.col("v").desc()]
    want = {tuple(r) for r in windows.latest_per_key(df, ["k", "m"], order).collect()}
    for hot in ([], [1], [1, 99]):
        for by in (None, ["k"]):
            got = windows.latest_per_key(df, ["k", "m"], order, hot, by)
            assert {tuple(r) for r in got.collect()} == want


def test_history_is_shuffled_once_where_hot_keys_are_known(spark):
    rows = [r for seed in range(3) for r in random_observations(seed)]
    df = spark.createDataFrame(rows, SCHEMA)
    order = [F.col("o").desc()]
    df = df.dropDuplicates(["k", "m", "o"])
    want = sorted(map(str, h.build_history(df, "k", "m", order).collect()))
    for hot in ((), (3, 4)):
        assert sorted(map(str, h.build_history(df, "k", "m", order, hot).collect())) == want
    plan = h.build_history(df.filter("k > 0"), "k", "m", order, ())
    # one on the key for all rows, one on key and month for the (absent) rows without a key
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 1


def test_a_star_on_demand_writes_what_is_read(spark, tmp_path):
    from tidemark.catalogue import tables as t
    from tidemark.plans.star import StarOnDemand

    sf_dir = "/root/testdata/sf0.001"
    built = t.star(spark, sf_dir)
    own = StarOnDemand(
        t.silver(spark, sf_dir), t.lga_loads(spark, sf_dir), t.suburb_loads(spark, sf_dir),
        None, None, str(tmp_path),
    )
    assert own.written() == []
    assert own.listings.count() == built.listings.count()
    assert [p.rsplit("/", 1)[1] for p in own.written()] == ["listings"]
    assert own.dim_host.count() == built.dim_host.count()
    assert [p.rsplit("/", 1)[1] for p in own.written()] == ["listings", "dim_host"]
    assert own.g01 is None and own.dim_host is own.dim_host
    assert set(own.write()) == set(own.TABLES) and own.fact.count() == built.fact.count()


def test_versions_are_counted_on_short_rows(spark):
    """Keys of one whole type are not made texts; mixed types still meet as texts."""
    day = dt.date(2020, 1, 1)
    fact = spark.createDataFrame([(1, day), (2, day), (None, day)], "k INT, m DATE")
    rows = [(1, day, dt.date(2021, 1, 1)), (1, day, dt.date(2021, 1, 1))]
    for kind in ("INT", "BIGINT"):
        dim = spark.createDataFrame(rows, f"k {kind}, valid_from DATE, valid_to DATE")
        for hot in ({}, {"a": [1]}):
            found = pointintime.count_versions(fact, {"a": (dim, "k"), "b": (dim, "k")}, ["k"], "m", hot)
            want = {(d, k, n) for d in "ab" for k, n in ((1, 2), (2, 0), (None, 0))}
            assert {tuple(r) for r in found.collect()} == want
            plan = found._jdf.queryExecution().optimizedPlan().toString()
            assert ("cast(k#" in plan and "as string" in plan) == (kind == "BIGINT")
