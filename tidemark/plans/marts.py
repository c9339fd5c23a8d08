"""Monthly KPI marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.numbers import COUNT, half_up, percent, ratio
from tidemark.operators.aggregates import exact_median
from tidemark.operators.pointintime import Hot, pit_join
from tidemark.operators.windows import pct_change

PERIOD = "month_date"
LISTING_KEYS = ("listing_neighbourhood",)
TYPE_KEYS = ("property_type", "room_type", "accommodates")


def visits(
    fact: DataFrame,
    dim_property: DataFrame,
    dim_host: DataFrame,
    keys: Sequence[str],
    hot_hosts: Hot = (),
    apart: bool = False,
) -> DataFrame:
    """Fact rows with the property and host version valid in their month."""
    wanted = fact.select(
        "listing_id",
        "host_id",
        PERIOD,
        "has_availability",
        "price",
        "review_scores_rating",
        "number_of_stays",
        "estimated_revenue",
    )
    properties = dim_property.select("listing_id", "valid_from", "valid_to", *keys)
    hosts = dim_host.select("host_id", "valid_from", "valid_to", "host_is_superhost")
    placed = pit_join(wanted, properties, "listing_id", apart=apart).drop("listing_id")
    return pit_join(placed, hosts, "host_id", hot=hot_hosts, apart=apart)


def shared_visits(
    fact: DataFrame,
    dim_property: DataFrame,
    dim_host: DataFrame,
    hot_hosts: Hot = (),
    apart: bool = False,
) -> DataFrame:
    """:func:`visits` for the marts of listings and of types, which a query then joins once."""
    keys = [*LISTING_KEYS, *TYPE_KEYS]
    rows = visits(fact, dim_property, dim_host, keys, hot_hosts, apart)
    # always true: every mart reads all keys, so that all have the same exchange below them
    return rows.filter(F.hash(*keys) <= 2**31 - 1)


def monthly_kpis(
    fact: DataFrame,
    dim_property: DataFrame,
    dim_host: DataFrame,
    keys: Sequence[str],
    hot_hosts: Hot = (),
    medians: bool = True,
    apart: bool = False,
    rows: DataFrame | None = None,
) -> DataFrame:
    """Measures per group and month, with the change against the month before.

    The joined rows are first summed per host and price, which is all that both the
    host counts and the medians need, so the joins run once. Hosts are counted by
    aggregating per host, without a row expansion for the two distinct counts; medians come
    from value counts. ``medians=False`` leaves that column out, and its work.

    ``apart`` is that of :func:`~tidemark.operators.pointintime.timeline`, for versions that a window
    makes on the way; ``rows`` are the :func:`shared_visits` of several marts, made with the
    same ``hot_hosts`` and ``apart``.
    """
    keys = list(keys)
    if rows is None:
        rows = visits(fact, dim_property, dim_host, keys, hot_hosts, apart)
    active = F.col("has_availability")
    at = [*keys, PERIOD]
    if not hot_hosts and (medians or not apart):
        # rows of a host and price are few, so nothing is summed before the shuffle, and both sums
        # below share this one; a hot host is spread over its prices first. Rows joined apart are
        # with their host, and only a median would have them joined again
        rows = rows.repartition(*at, "host_id")
    narrow = rows.groupBy(*at, "host_id", F.when(active, F.col("price")).alias("price")).agg(
        F.count("*").alias("total"),
        F.count_if(active).alias("active"),
        F.count_if(~active).alias("inactive"),
        F.max("host_is_superhost").alias("superhost"),
        F.sum(F.when(active, F.col("review_scores_rating"))).alias("rating_sum"),
        F.count(F.when(active, F.col("review_scores_rating"))).alias("rating_n"),
        F.sum(F.when(active, F.col("number_of_stays"))).alias("stays"),
        F.sum(F.when(active, F.col("estimated_revenue"))).alias("revenue"),
        F.count(F.when(active, F.col("estimated_revenue"))).alias("revenue_n"),
    )
    sums = ["total", "active", "inactive", "rating_sum", "rating_n", "stays", "revenue"]
    parts = narrow.groupBy(*at, "host_id").agg(
        *[F.sum(c).alias(c) for c in (*sums, "revenue_n")],
        F.max("superhost").alias("superhost"),
        F.min("price").alias("low"),
        F.max("price").alias("high"),
        F.sum(F.col("price") * F.col("active")).alias("price_sum"),
        F.sum(F.when(F.col("price").isNotNull(), F.col("active"))).alias("price_n"),
    )

    def average(name: str):
        kept = F.sum(f"{name}_sum") if name != "revenue" else F.sum("revenue")
        return ratio(kept.cast("decimal(28,2)"), F.sum(f"{name}_n").cast(COUNT))

    if medians:
        # always true: it reads every column, so that both branches have the same exchange
        # below them and Spark computes it once
        whole = F.hash(*narrow.columns) <= 2**31 - 1
        middle = exact_median(narrow.filter(whole), at, "price", "median_price", "active")
        # a median row has no host, so it adds to none of the counts and sums
        parts = parts.unionByName(middle, allowMissingColumns=True)
    monthly = parts.groupBy(*at).agg(
        F.sum("total").alias("total_listings"),
        F.sum("active").alias("active_listings"),
        F.sum("inactive").alias("inactive_listings"),
        F.min("low").alias("min_price"),
        F.max("high").alias("max_price"),
        *([F.max("median_price").alias("median_price")] if medians else []),
        average("price").alias("avg_price"),
        F.count("host_id").alias("distinct_hosts"),
        F.count_if(F.col("superhost")).alias("distinct_superhosts"),
        average("rating").alias("avg_rating"),
        F.sum("stays").alias("total_stays"),
        average("revenue").alias("avg_revenue"),
    )
    changed = pct_change(
        monthly,
        keys,
        PERIOD,
        {
            "active_listings_pct_change": "active_listings",
            "inactive_listings_pct_change": "inactive_listings",
        },
    )
    return changed.select(
        *keys,
        F.col(PERIOD).alias("month_year"),
        percent(F.col("active_listings"), F.col("total_listings"), 2).alias(
            "active_listings_rate"
        ),
        "min_price",
        "max_price",
        *([half_up("median_price", 2).alias("median_price")] if medians else []),
        half_up("avg_price", 2).alias("avg_price"),
        "distinct_hosts",
        percent(F.col("distinct_superhosts"), F.col("distinct_hosts"), 2).alias("superhost_rate"),
        half_up("avg_rating", 2).alias("avg_review_scores_rating"),
        "active_listings_pct_change",
        "inactive_listings_pct_change",
        "total_stays",
        half_up("avg_revenue", 2).alias("avg_estimated_revenue_per_active_listing"),
    )


def dm_listing_neighbourhood(
    fact: DataFrame,
    dim_property: DataFrame,
    dim_host: DataFrame,
    hot_hosts: Hot = (),
    medians: bool = True,
    apart: bool = False,
    rows: DataFrame | None = None,
) -> DataFrame:
    return monthly_kpis(
        fact, dim_property, dim_host, LISTING_KEYS, hot_hosts, medians, apart, rows
    )


def dm_property_type(
    fact: DataFrame,
    dim_property: DataFrame,
    dim_host: DataFrame,
    hot_hosts: Hot = (),
    medians: bool = True,
    apart: bool = False,
    rows: DataFrame | None = None,
) -> DataFrame:
    return monthly_kpis(fact, dim_property, dim_host, TYPE_KEYS, hot_hosts, medians, apart, rows)


def dm_host_neighbourhood(
    fact: DataFrame,
    dim_host: DataFrame,
    dim_suburb: DataFrame,
    hot_hosts: Hot = (),
    unknown: str = "Unknown",
    hot_suburbs: Hot = (),
    apart: bool = False,
) -> DataFrame:
    """Revenue by the area the host lives in; hosts without one form their own group.

    The fact is first summed per host, month and suburb, so the second hop joins
    aggregates instead of rows. ``hot_suburbs`` lists upper-case names to spread. ``apart`` as
    in :func:`monthly_kpis`.
    """
    wanted = fact.select("host_id", PERIOD, "has_availability", "estimated_revenue")
    homes = dim_host.select("host_id", "valid_from", "valid_to", "host_neighbourhood")
    lived = pit_join(wanted, homes, "host_id", hot=hot_hosts, apart=apart)
    earned = F.when(F.col("has_availability"), F.col("estimated_revenue"))
    sums = lived.groupBy("host_neighbourhood", PERIOD, "host_id").agg(
        F.sum(earned).alias("revenue"), F.count(earned).alias("revenue_n")
    )
    suburbs = dim_suburb.select("suburb_name_key", "lga_name", "valid_from", "valid_to")
    placed = pit_join(
        sums,
        suburbs,
        (F.upper("host_neighbourhood"), "suburb_name_key"),
        how="left",
        hot=hot_suburbs,
    )
    area = F.coalesce("lga_name", F.lit(unknown)).alias("host_neighbourhood_lga")
    per_host = placed.groupBy(area, PERIOD, "host_id").agg(
        F.sum("revenue").alias("revenue"), F.sum("revenue_n").alias("revenue_n")
    )
    revenue = F.sum("revenue").cast("decimal(28,2)")
    return per_host.groupBy("host_neighbourhood_lga", F.col(PERIOD).alias("month_year")).agg(
        F.count("host_id").alias("distinct_hosts"),
        half_up(ratio(revenue, F.sum("revenue_n").cast(COUNT)), 2).alias(
            "avg_estimated_revenue_per_active_listing"
        ),
        half_up(ratio(revenue, F.count("host_id").cast(COUNT)), 2).alias(
            "estimated_revenue_per_host"
        ),
    )
