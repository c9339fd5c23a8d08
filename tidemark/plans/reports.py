"""Analytical reports over the star schema and the marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.numbers import (
    COUNT,
    half_up,
    half_up_double,
    mean,
    pearson,
    percent,
    ratio,
    ratio_of_sums,
    weighted_mean,
)
from tidemark.operators.aggregates import bucketize, composition, exact_median, with_total
from tidemark.operators.joins import current_join, null_safe_join, salted_join
from tidemark.operators.pointintime import pit_join
from tidemark.operators.topk import top_bottom, top_k
from tidemark.operators.windows import (
    group_rank,
    group_spread,
    scaled_units,
    share_of_total,
    top_k_per_group,
    value_ranks,
)

ACTIVE = "has_availability"

# The narrow age columns that make up each reported band.
AGE_BANDS = {
    "0_19": ("age_0_4_yr_p", "age_5_14_yr_p", "age_15_19_yr_p"),
    "20_34": ("age_20_24_yr_p", "age_25_34_yr_p"),
    "35_54": ("age_35_44_yr_p", "age_45_54_yr_p"),
    "55_74": ("age_55_64_yr_p", "age_65_74_yr_p"),
    "75_plus": ("age_75_84_yr_p", "age_85ov_p"),
}

# Portfolio sizes, as upper bounds and labels.
PORTFOLIO_BOUNDS = (2, 5, 10)
PORTFOLIO_LABELS = ("2 listings", "3 to 5 listings", "6 to 10 listings", "11 listings or more")


def revenue_per_lga(fact: DataFrame) -> DataFrame:
    """Period-weighted revenue of one active listing-month, per area."""
    return (
        fact.filter("lga_code IS NOT NULL")
        .groupBy("lga_code")
        .agg(
            F.sum("estimated_revenue").alias("total_revenue"),
            F.count_if(F.col(ACTIVE)).alias("active_listing_months"),
            ratio_of_sums("estimated_revenue", F.col(ACTIVE))
            .cast("decimal(18,6)")
            .alias("revenue_per_active_listing"),
        )
    )


def _named(per_lga: DataFrame, dim_lga: DataFrame) -> DataFrame:
    names = dim_lga.select("lga_code", "lga_name", "is_current")
    return current_join(per_lga, names, "lga_code")


def _sum_of(columns: Sequence[str]) -> Column:
    total = F.col(columns[0])
    for name in columns[1:]:
        total = total + F.col(name)
    return total


def demographics_top_bottom(
    fact: DataFrame, dim_lga: DataFrame, g01: DataFrame, g02: DataFrame, n: int = 3
) -> DataFrame:
    """Population of the n best and n worst areas by revenue, with a weighted row per group."""
    chosen = top_bottom(
        _named(revenue_per_lga(fact), dim_lga), "revenue_per_active_listing", n
    )
    needed = sorted({"tot_p_p", *[c for cols in AGE_BANDS.values() for c in cols]})
    people = chosen.join(g01.select("lga_code", *needed), "lga_code").join(
        g02.select("lga_code", "median_age_persons", "average_household_size"), "lga_code"
    )
    people = people.withColumns({b: _sum_of(cols) for b, cols in AGE_BANDS.items()})
    bands = list(AGE_BANDS)
    measures = [
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("active_listing_months").alias("active_listing_months"),
        F.sum("tot_p_p").alias("population"),
        half_up(weighted_mean("median_age_persons", "tot_p_p"), 1).alias("median_age"),
        half_up(weighted_mean("average_household_size", "tot_p_p"), 2).alias("avg_household_size"),
        *[F.sum(b).alias(b) for b in bands],
    ]
    detail = people.groupBy("revenue_group", "lga_name").agg(*measures)
    detail = detail.withColumn("sort_in_group", F.lit(1))
    whole = people.groupBy("revenue_group").agg(*measures)
    whole = whole.withColumns(
        {"lga_name": F.lit(f"ALL {n} (weighted)"), "sort_in_group": F.lit(2)}
    )
    shares = composition(detail.unionByName(whole), bands)
    revenue = ratio(
        F.col("total_revenue").cast("decimal(28,2)"), F.col("active_listing_months").cast(COUNT)
    )
    return shares.select(
        "revenue_group",
        "sort_in_group",
        "lga_name",
        half_up(revenue, 2).alias("revenue_per_active_listing"),
        "population",
        "median_age",
        "avg_household_size",
        *[f"pct_{b}" for b in bands],
    ).orderBy(
        F.col("revenue_group").desc(),
        "sort_in_group",
        F.col("revenue_per_active_listing").desc_nulls_last(),
    )


def rank_method_check(fact: DataFrame, dim_lga: DataFrame, kpis: DataFrame) -> DataFrame:
    """Ranks of the areas by the weighted revenue and by the mean of monthly means."""
    weighted = _named(revenue_per_lga(fact), dim_lga).groupBy("lga_name").agg(
        ratio(
            F.sum("total_revenue").cast("decimal(28,2)"),
            F.sum("active_listing_months").cast(COUNT),
        )
        .cast("decimal(18,6)")
        .alias("weighted")
    )
    monthly = kpis.groupBy(F.upper("listing_neighbourhood").alias("_key")).agg(
        mean("avg_estimated_revenue_per_active_listing").cast("decimal(18,6)").alias("of_months")
    )
    both = weighted.join(monthly, F.upper("lga_name") == F.col("_key"))
    ranked = group_rank(both, "weighted", "rank_my_way", descending=True)
    ranked = group_rank(ranked, "of_months", "rank_avg_of_months", descending=True)
    return ranked.select(
        "lga_name",
        half_up("weighted", 2).alias("rev_my_way_weighted"),
        half_up("of_months", 2).alias("rev_avg_of_months"),
        "rank_my_way",
        "rank_avg_of_months",
    ).orderBy("rank_my_way", "lga_name")


def spearman(
    df: DataFrame, x: str, y: str, ties: str = "min", hot_x: tuple = (), hot_y: tuple = ()
) -> DataFrame:
    """Rank correlation as one row. ``ties='min'`` ranks ties at their first place,
    ``'average'`` at their middle. NULL when a side has one value only.

    Equal pairs (x, y) are counted once, and only those counts go on: each side's ranks come
    from its margin, and the correlation weighs a pair by its count. ``hot_x`` and ``hot_y``
    are values with many different partners.
    """
    sides = {"_x": (x, hot_x), "_y": (y, hot_y)}
    scales = {side: scaled_units(df, column) for side, (column, _) in sides.items()}
    pairs = (
        df.select(*[units.alias(side) for side, (units, _, _) in scales.items()])
        .filter("_x IS NOT NULL AND _y IS NOT NULL")
        .groupBy(*sides)
        .agg(F.count("*").alias("_n"))
    )
    weighed = pairs
    for side, (_, hot) in sides.items():
        _, precision, scale = scales[side]
        margin = pairs.select(F.col(side).alias("_units"), "_n")
        ranks = value_ranks(margin, precision, "_rank", ties)
        weight = F.col("_n") * F.col("_rank").cast("double")
        middle = ranks.agg((F.sum(weight) / F.sum("_n")).alias("_mean"))
        # the distance of each value from the mean rank, which is one row
        placed = ranks.crossJoin(F.broadcast(middle)).select(
            "_value", (F.col("_rank") - F.col("_mean")).alias(f"_from{side}")
        )
        spread_over = [int(value * 10**scale) for value in hot]
        weighed = salted_join(weighed, placed, side, "_value", hot=spread_over)

    def moment(a: str, b: str) -> Column:
        return F.sum(F.col("_n") * F.col(a) * F.col(b))

    deviations = F.sqrt(moment("_from_x", "_from_x")) * F.sqrt(moment("_from_y", "_from_y"))
    return weighed.agg(ratio(moment("_from_x", "_from_y"), deviations).alias("spearman_corr"))


def _attributes_and_revenue(fact: DataFrame, dim_lga: DataFrame, g02: DataFrame) -> DataFrame:
    return _named(revenue_per_lga(fact), dim_lga).join(
        g02.select(
            "lga_code",
            "median_age_persons",
            "average_household_size",
            "median_tot_hhd_inc_weekly",
        ),
        "lga_code",
    )


def correlation_report(
    fact: DataFrame, dim_lga: DataFrame, g02: DataFrame, ties: str = "min"
) -> DataFrame:
    """Pearson and Spearman between an area's median age and its revenue, with ranges."""
    per_lga = _attributes_and_revenue(fact, dim_lga, g02)
    ranked = group_rank(per_lga, "median_age_persons", "rank_age", ties=ties)
    ranked = group_rank(ranked, "revenue_per_active_listing", "rank_revenue", ties=ties)
    money = [
        half_up(f("revenue_per_active_listing"), 2).cast("string") for f in (F.min, F.max)
    ]
    ages = [f("median_age_persons").cast("string") for f in (F.min, F.max)]
    return ranked.agg(
        F.count("*").alias("nb_lga"),
        half_up_double(pearson("median_age_persons", "revenue_per_active_listing"), 3).alias(
            "pearson_corr"
        ),
        half_up_double(pearson("rank_age", "rank_revenue"), 3).alias("spearman_corr"),
        F.concat(ages[0], F.lit(" - "), ages[1]).alias("median_age_range"),
        F.concat(money[0], F.lit(" - "), money[1]).alias("revenue_range"),
    )


def correlation_detail(fact: DataFrame, dim_lga: DataFrame, g02: DataFrame) -> DataFrame:
    """The areas behind the correlation."""
    return (
        _attributes_and_revenue(fact, dim_lga, g02)
        .select(
            "lga_name",
            F.col("median_age_persons").alias("median_age"),
            half_up("revenue_per_active_listing", 2).alias("revenue_per_active_listing"),
            "active_listing_months",
            "average_household_size",
            F.col("median_tot_hhd_inc_weekly").alias("median_household_income_weekly"),
        )
        .orderBy(F.col("revenue_per_active_listing").desc_nulls_last(), "lga_name")
    )


def types_in_best_areas(fact: DataFrame, dim_property: DataFrame, areas: int = 5) -> DataFrame:
    """Listing types inside the best areas by revenue, one row per type.

    The point-in-time join runs once: the areas' revenue is the sum over their types, so both
    levels come from the same aggregate. A list holds the types of one area, not its rows.
    """
    wanted = fact.select(
        "listing_id", "month_date", ACTIVE, "number_of_stays", "price", "estimated_revenue"
    )
    type_keys = ["listing_neighbourhood", "property_type", "room_type", "accommodates"]
    properties = dim_property.select("listing_id", "valid_from", "valid_to", *type_keys)
    active = F.col(ACTIVE)
    by_type = pit_join(wanted, properties, "listing_id").groupBy(*type_keys).agg(
        F.count_if(active).alias("active_listing_months"),
        F.sum("number_of_stays").alias("total_stays"),
        half_up(mean("number_of_stays", active), 1).alias("avg_stays_per_month"),
        half_up(mean("price", active), 2).alias("avg_price"),
        half_up(mean("estimated_revenue", active), 2).alias("avg_revenue_per_active_listing"),
        F.sum("estimated_revenue").alias("_revenue"),
    )
    # an area's types travel with its revenue, so that the fact is read once
    types = [c for c in by_type.columns if c not in ("listing_neighbourhood", "_revenue")]
    per_area = by_type.groupBy("listing_neighbourhood").agg(
        ratio(
            F.sum("_revenue").cast("decimal(28,2)"),
            F.sum("active_listing_months").cast(COUNT),
        )
        .cast("decimal(18,6)")
        .alias("area_revenue"),
        F.collect_list(F.struct(*types)).alias("_types"),
    )
    best = top_k(
        per_area.filter("listing_neighbourhood IS NOT NULL"),
        F.col("area_revenue").desc_nulls_last(),
        areas,
        [F.col("listing_neighbourhood")],
    )
    return best.select("listing_neighbourhood", F.inline("_types"), "area_revenue")


def best_types(
    fact: DataFrame, dim_property: DataFrame, areas: int = 5, k: int = 3
) -> DataFrame:
    """The k types with the most stays in each of the best areas, ties kept."""
    ranked = top_k_per_group(
        types_in_best_areas(fact, dim_property, areas),
        ["listing_neighbourhood"],
        F.col("total_stays").desc_nulls_last(),
        k,
        "rank_by_total_stays",
    )
    return ranked.orderBy(
        F.col("area_revenue").desc_nulls_last(),
        "rank_by_total_stays",
        "property_type",
        "room_type",
        "accommodates",
    ).select(
        "listing_neighbourhood",
        "rank_by_total_stays",
        "property_type",
        "room_type",
        "accommodates",
        "total_stays",
        "active_listing_months",
        "avg_stays_per_month",
        "avg_price",
        "avg_revenue_per_active_listing",
    )


def best_types_by_occupancy(
    fact: DataFrame,
    dim_property: DataFrame,
    areas: int = 5,
    k: int = 3,
    min_volume: int = 120,
) -> DataFrame:
    """The k best filled types among those with enough volume, and the spread of their area.

    The rank is taken on the rounded average. The rank by stays is kept for
    every type, so it is computed before the top-k filter.
    """
    types = types_in_best_areas(fact, dim_property, areas)
    types = types.filter(F.col("active_listing_months") >= min_volume)
    by_stays = Window.partitionBy("listing_neighbourhood").orderBy(
        F.col("total_stays").desc_nulls_last()
    )
    types = types.withColumn("rank_by_total_stays", F.rank().over(by_stays))
    types = group_spread(types, ["listing_neighbourhood"], "avg_stays_per_month", "spread_in_the_area")
    ranked = top_k_per_group(
        types,
        ["listing_neighbourhood"],
        F.col("avg_stays_per_month").desc_nulls_last(),
        k,
        "rank_by_occupancy",
    )
    return ranked.orderBy(
        F.col("area_revenue").desc_nulls_last(),
        "rank_by_occupancy",
        "property_type",
        "room_type",
        "accommodates",
    ).select(
        "listing_neighbourhood",
        "rank_by_occupancy",
        "rank_by_total_stays",
        "property_type",
        "room_type",
        "accommodates",
        "avg_stays_per_month",
        "spread_in_the_area",
        "active_listing_months",
        "avg_price",
        "avg_revenue_per_active_listing",
    )


def host_portfolios(fact: DataFrame) -> DataFrame:
    """Per host: distinct listings and areas, over all months and in the busiest one.

    The first step gathers the months and areas of each (host, listing), so that a host with a
    third of all rows is spread over its listings. From there on a listing counts where it is
    first seen, overall and in each month, and counting needs neither a row expansion nor a
    join: sums per (host, month), then one row per host. Lists are bounded by the months of a
    listing and by the areas of the area table.
    """
    seen = F.array_sort(F.collect_set(F.struct("month_date", "lga_code")))
    places = (
        fact.filter("lga_code IS NOT NULL")
        .groupBy("host_id", "listing_id")
        .agg(seen.alias("_seen"))
        .select(
            "host_id",
            F.col("listing_id").isNotNull().alias("_named"),
            "_seen",
            F.posexplode("_seen").alias("_i", "_place"),
        )
    )
    first = F.col("_i") == 0
    new_month = first | ~F.col("_seen")[F.col("_i") - 1]["month_date"].eqNullSafe(
        F.col("_place.month_date")
    )
    per_month = (
        places.select(
            "host_id",
            "_place.*",
            (F.col("_named") & first).alias("_first"),
            (F.col("_named") & new_month).alias("_first_in_month"),
        )
        .groupBy("host_id", "month_date")
        .agg(
            F.count_if("_first").alias("fresh"),
            F.count_if("_first_in_month").alias("listings"),
            F.collect_set("lga_code").alias("lgas"),
        )
    )
    return per_month.groupBy("host_id").agg(
        F.sum("fresh").alias("nb_listings"),
        F.size(F.array_distinct(F.flatten(F.collect_list("lgas")))).cast("bigint").alias("nb_lga"),
        F.max("listings").alias("max_listings_in_one_month"),
        F.max(F.size("lgas")).cast("bigint").alias("max_lgas_in_one_month"),
        F.sum("listings").alias("listing_months"),
    )


def portfolio_scope(fact: DataFrame) -> DataFrame:
    """Hosts with one listing against hosts with several."""
    hosts = host_portfolios(fact)
    kind = F.when(F.col("nb_listings") == 1, "single listing").otherwise("multiple listings")
    per_kind = hosts.groupBy(kind.alias("host_type")).agg(
        F.count("*").alias("nb_hosts"),
        F.sum("nb_listings").alias("nb_listings"),
        F.count_if(F.col("max_listings_in_one_month") > 1).alias("hosts_with_2_at_once"),
    )
    shares = {"pct_of_hosts": "nb_hosts", "pct_of_listings": "nb_listings"}
    return (
        share_of_total(per_kind, shares)
        .select(
            "host_type",
            "nb_hosts",
            "pct_of_hosts",
            "nb_listings",
            "pct_of_listings",
            "hosts_with_2_at_once",
        )
        .orderBy("host_type")
    )


def portfolio_concentration(
    fact: DataFrame,
    bounds: Sequence[int] = PORTFOLIO_BOUNDS,
    labels: Sequence[str] = PORTFOLIO_LABELS,
) -> DataFrame:
    """How many hosts with several listings keep them in one area, by portfolio size."""
    hosts = host_portfolios(fact).filter("nb_listings >= 2")
    label, order = bucketize("nb_listings", bounds, labels)
    in_one = F.count_if(F.col("nb_lga") == 1)
    rows = with_total(
        hosts.withColumns({"portfolio_size": label, "_order": order}),
        ["portfolio_size"],
        [
            F.max("_order").alias("_order"),
            F.count("*").alias("nb_hosts"),
            F.sum("nb_listings").alias("nb_listings"),
            in_one.alias("hosts_in_one_lga"),
            percent(in_one, F.count("*"), 1).alias("pct_in_one_lga"),
            half_up(mean("nb_lga"), 2).alias("avg_nb_lga"),
            F.max("nb_lga").alias("max_nb_lga"),
            F.count_if(F.col("max_lgas_in_one_month") == 1).alias("hosts_in_one_lga_same_month"),
        ],
        "ALL multi-listing hosts",
    )
    rows = rows.filter("nb_hosts > 0")
    return rows.orderBy("is_total", "_order").drop("is_total", "_order")


def single_hosts(fact: DataFrame, dim_lga: DataFrame, g02: DataFrame) -> DataFrame:
    """Hosts with exactly one listing, their yearly revenue and their area's mortgage.

    A host has one listing exactly when its smallest and largest listing id
    agree, which is cheaper than a second distinct count.
    """
    per_host = (
        fact.filter("lga_code IS NOT NULL")
        .groupBy("host_id")
        .agg(
            F.min("listing_id").alias("_low"),
            F.max("listing_id").alias("_high"),
            F.count_distinct("month_date").alias("months_present"),
            F.min("lga_code").alias("lga_code"),
            F.sum("estimated_revenue").cast("decimal(18,2)").alias("revenue"),
        )
        .filter("_low = _high")
        .drop("_low", "_high")
    )
    yearly = (F.col("median_mortgage_repay_monthly") * 12).alias("annual_mortgage")
    return _named(per_host, dim_lga).join(g02.select("lga_code", yearly), "lga_code")


def mortgage_coverage(
    fact: DataFrame, dim_lga: DataFrame, g02: DataFrame, periods: int = 12
) -> DataFrame:
    """Share of single-listing hosts whose revenue covers the yearly mortgage, by area and
    overall; once for all of them and once for those present in all ``periods``."""
    hosts = single_hosts(fact, dim_lga, g02)
    covers = F.col("revenue") >= F.col("annual_mortgage")
    whole = F.col("months_present") == periods
    total_label = "ALL LGAs"
    rows = with_total(
        hosts,
        ["lga_name"],
        [
            F.count("*").alias("nb_single_hosts"),
            F.max("annual_mortgage").alias("annual_mortgage"),
            F.count_if(covers).alias("hosts_covering"),
            percent(F.count_if(covers), F.count("*"), 1).alias("pct_covering"),
            F.count_if(whole).alias("hosts_all_year"),
            percent(F.count_if(whole & covers), F.count_if(whole), 1).alias(
                "pct_covering_all_year"
            ),
        ],
        total_label,
    )
    # revenues are counted once per area and once for all, and both medians found together
    levels = F.array(
        F.struct(F.col("lga_name"), F.lit(0).alias("is_total")),
        F.struct(F.lit(total_label).alias("lga_name"), F.lit(1).alias("is_total")),
    )
    counted = hosts.groupBy("lga_name", "revenue").agg(F.count("*").alias("n"))
    counted = counted.select("revenue", "n", F.inline(levels))
    medians = exact_median(counted, ["lga_name", "is_total"], "revenue", "median", "n")
    rows = null_safe_join(rows, medians, ["lga_name", "is_total"], "left")
    return (
        rows.withColumn(
            "annual_mortgage", F.when(F.col("is_total") == 0, F.col("annual_mortgage"))
        )
        .orderBy("is_total", F.col("pct_covering").desc_nulls_last(), "lga_name")
        .select(
            "lga_name",
            "nb_single_hosts",
            "annual_mortgage",
            half_up("median", 2).alias("median_revenue_12m"),
            "hosts_covering",
            "pct_covering",
            "hosts_all_year",
            "pct_covering_all_year",
        )
    )


def series(kpis: DataFrame, group: str, key: str = "listing_neighbourhood") -> DataFrame:
    """One group's months in order."""
    return (
        kpis.filter(F.col(key) == group)
        .select(
            key,
            "month_year",
            "active_listings_rate",
            "median_price",
            "superhost_rate",
            "active_listings_pct_change",
            "inactive_listings_pct_change",
            "total_stays",
            "avg_estimated_revenue_per_active_listing",
        )
        .orderBy("month_year")
    )


__all__ = [
    "best_types",
    "best_types_by_occupancy",
    "correlation_detail",
    "correlation_report",
    "demographics_top_bottom",
    "host_portfolios",
    "mortgage_coverage",
    "portfolio_concentration",
    "portfolio_scope",
    "rank_method_check",
    "revenue_per_lga",
    "series",
    "spearman",
]
