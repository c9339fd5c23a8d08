"""A host with a third of all rows: found, spread, and without effect on any figure."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.operators.joins import heavy_keys
from tidemark.plans import marts, silver, star


def test_a_hot_host_changes_no_figure(spark):
    ids = spark.range(900)
    hot = F.col("id") % 3 == 0
    month = F.make_date(F.lit(2020), (F.col("id") % 4 + 1).cast("int"), F.lit(1))
    values = {
        "listing_id": F.col("id"),
        "host_id": F.when(hot, F.lit(-1)).otherwise(F.col("id") + 1),
        "scraped_date": month,
        "month_date": month,
        "host_since": month,
        "host_name": F.lit("h"),
        "host_is_superhost": F.col("id") % 5 == 0,
        "host_neighbourhood": F.when(F.col("id") % 2 == 0, "Bondi"),
        "listing_neighbourhood": F.when(F.col("id") % 7 > 0, "Sydney"),
        "property_type": F.lit("Flat"),
        "room_type": F.lit("Entire"),
        "accommodates": F.lit(2),
        "price": (F.col("id") % 50 + 1).cast("decimal(10,2)"),
        "has_availability": F.col("id") % 11 > 0,
        "availability_30": (F.col("id") % 30).cast("int"),
        "number_of_reviews": F.lit(1),
        "source_file": F.lit("05_2020.csv"),
        "loaded_at": F.lit(dt.datetime(2020, 5, 1)),
    }
    scores = {
        c: F.lit(Decimal("4.50")).cast("decimal(5,2)")
        for c in silver.LISTING_COLUMNS
        if c.startswith("review_scores_")
    }
    listings = ids.select(*[v.alias(k) for k, v in {**values, **scores}.items()])
    loaded = F.lit("2020-01-01").cast("timestamp")
    lga = spark.createDataFrame(
        [(1, "Sydney", "SYDNEY")], "lga_code INT, lga_name STRING, lga_name_key STRING"
    ).withColumn("loaded_at", loaded)
    suburbs = spark.createDataFrame(
        [("BONDI", "Bondi", 1, "Sydney")],
        "suburb_name_key STRING, suburb_name STRING, lga_code INT, lga_name STRING",
    ).withColumn("loaded_at", loaded)
    gold = star.build_star(listings.cache(), lga, suburbs)
    assert gold.hot_hosts == (-1,) == tuple(heavy_keys(gold.fact, "host_id"))

    def figures(df):
        return sorted(map(str, df.collect()))

    for mart in (
        lambda hosts: marts.dm_listing_neighbourhood(
            gold.fact, gold.dim_property, gold.dim_host, hosts
        ),
        lambda hosts: marts.dm_host_neighbourhood(
            gold.fact, gold.dim_host, gold.dim_suburb, hosts
        ),
    ):
        assert figures(mart(gold.host_slices)) == figures(mart(()))
        assert figures(mart(gold.hot_hosts)) == figures(mart(()))
    groups = marts.dm_listing_neighbourhood(
        gold.fact, gold.dim_property, gold.dim_host, gold.hot_hosts
    )
    # listings without a neighbourhood are a group of their own, medians included
    lost = groups.filter("listing_neighbourhood IS NULL")
    assert lost.count() == 4 and lost.filter("median_price IS NULL").isEmpty()


def test_marts_join_once_and_leave_unwanted_medians_out(spark):
    """Two point-in-time joins in the plan that runs, whether medians are asked for or not."""
    from tidemark.catalogue import tables as t
    from tidemark.plans import marts

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    s = t.star(spark, "/root/testdata/sf0.001")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for medians in (True, False):
            kpis = marts.dm_listing_neighbourhood(
                s.fact, s.dim_property, s.dim_host, s.hot_hosts, medians
            )
            plan = kpis._jdf.queryExecution().executedPlan().toString()
            joins = plan.count("lastvalue(_version") + plan.count("last(_version")
            reused = plan.count("ReusedExchange")
            assert ("median_price" in kpis.columns) == medians
            assert "SortMergeJoin" not in plan and joins == 2, plan
            assert (reused > 0) == medians
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_month_of_the_fact_is_one_partition(spark):
    from tidemark.catalogue import tables as t
    from tidemark.operators import quality

    fact = t.star(spark, "/root/testdata/sf0.001").fact
    total = quality.period_total(fact, "1997-05-01")
    plan = total._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_date" in plan
