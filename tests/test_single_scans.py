"""Queries that scan a table once compute it on the way and write none."""

from __future__ import annotations

import datetime as dt

import pytest

from tidemark import catalogue
from tidemark.catalogue import tables as t
from tidemark.operators import quality
from tidemark.plans import marts

catalogue.load_all()


@pytest.fixture
def given(spark, tmp_path, monkeypatch):
    """A few line items, some of them without a key, and no star written yet."""
    monkeypatch.setattr(t, "_STARS", {})
    lines = [
        (
            None if i % 13 == 0 else i % 7, None if i % 11 == 0 else i % 5, i % 3, i % 4 + 1, float(i % 50 + 1),
            100.0 + i, (i % 11) / 100, (i % 9) / 100, "ANR"[i % 3], "OF"[i % 2],
            dt.datetime(1998, i % 5 + 1, i % 28 + 1),
        )
        for i in range(90)
    ]
    rows = {
        "lineitem": (
            lines,
            "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
            "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
            "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP",
        ),
        "supplier": (
            [(i, f"Town {i}", i % 2, 10.0 * i) for i in range(3)],
            "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
        ),
        "nation": (
            [(0, "HERE", 0), (1, "THERE", 1)],
            "n_nationkey INT, n_name STRING, n_regionkey INT",
        ),
        "customer": (
            [(i, f"C{i}", i % 2, 100.0 * i, "A") for i in range(6)],
            "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
        ),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize(
    "name, written",
    [
        ("filter_nulls", []),
        ("quality_resolution_rate", ["listings", "dim_suburb"]),
        ("mart_host_neighbourhood", ["listings", "dim_suburb"]),
        ("quality_mart_ranges", ["listings"]),
        ("window_version_number", []),
        ("quality_mart_row_counts", ["listings", "dim_suburb"]),
    ],
)
def test_a_single_scan_writes_no_table(spark, given, name, written):
    found = sorted(map(str, catalogue.QUERIES[name](spark, given).collect()))
    star = t.star(spark, given)
    assert [p.rsplit("/", 1)[1] for p in star.written()] == written
    assert found
    # a star written as a whole is read, with the same result
    star.write()
    again = catalogue.QUERIES[name](spark, given)
    files = {f.split("/gold/")[-1].split("/silver/")[-1].split("/")[0] for f in again.inputFiles()}
    assert files <= {"listings", *star.TABLES}
    assert sorted(map(str, again.collect())) == found


def test_marts_by_listing_and_by_type_share_their_joins(spark, given):
    """The same figures as one by one; facts and visits are sent to their key once for both."""
    s = t.star(spark, given).once("fact", "dim_property", "dim_host")
    gold = s.fact, s.dim_property, s.dim_host, s.host_slices
    shared = marts.shared_visits(*gold, apart=True)
    both = marts.dm_listing_neighbourhood, marts.dm_property_type
    for mart in both:
        for medians in (True, False):
            want = sorted(map(str, mart(*gold, medians=medians).collect()))
            got = mart(*gold, medians=medians, apart=True, rows=shared).collect()
            assert want and sorted(map(str, got)) == want
    homes = s.dim_host, s.dim_suburb, s.host_slices
    want = sorted(map(str, marts.dm_host_neighbourhood(s.fact, *homes).collect()))
    got = marts.dm_host_neighbourhood(s.fact, *homes, apart=True).collect()
    assert want and sorted(map(str, got)) == want
    # no hot hosts, as otherwise a third shuffle spreads theirs
    gold = *gold[:3], ()
    how = {"medians": False, "apart": True, "rows": marts.shared_visits(*gold, apart=True)}
    counts = quality.row_counts({mart.__name__: mart(*gold, **how) for mart in both})
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = counts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sent = [line for line in plan.splitlines() if "Exchange hashpartitioning(_key" in line]
    assert len([line for line in sent if "ReusedExchange" not in line]) == 2 < len(sent), plan
