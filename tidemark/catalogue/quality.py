"""Data-quality checks over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalogue import query
from tidemark.catalogue import tables as t
from tidemark.catalogue.sql import dbl, rounded, with_tables
from tidemark.catalogue.tables import plain
from tidemark.operators import quality as q
from tidemark.plans import marts, star


def _kpis(s):
    """No check reads the medians."""
    return marts.dm_listing_neighbourhood(
        s.fact, s.dim_property, s.dim_host, s.host_slices, medians=False
    )


def _host_areas(s):
    return marts.dm_host_neighbourhood(
        s.fact, s.dim_host, s.dim_suburb, s.host_slices, hot_suburbs=s.hot_suburbs
    )


# --- declared tests ----------------------------------------------------------

_UNIQUE = {
    "silver_hosts": ["host_id"],
    "silver_properties": ["listing_id"],
    "silver_lga": ["lga_code"],
    "silver_suburb": ["suburb_name_key"],
    "dim_host": ["host_version_id"],
    "dim_property": ["property_version_id"],
    "dim_lga": ["lga_version_id"],
    "dim_suburb": ["suburb_version_id"],
    "census_g01": ["lga_code"],
    "census_g02": ["lga_code"],
}
_REQUIRED = {
    **_UNIQUE,
    "fact_listings": ["listing_id", "month_date", "host_id", "lga_code"],
}
_REFERENCES = [
    ("fact_listings", "host_id", "dim_host", "host_id"),
    ("fact_listings", "lga_code", "dim_lga", "lga_code"),
]


def _tables(spark, sf_dir):
    from tidemark.plans import silver

    s = t.star(spark, sf_dir)
    return {
        "silver_hosts": silver.latest_hosts(s.listings),
        "silver_properties": silver.latest_properties(s.listings),
        "silver_lga": t.lga_load(spark, sf_dir, 1),
        "silver_suburb": t.suburb_load(spark, sf_dir, 1),
        "dim_host": s.dim_host,
        "dim_property": s.dim_property,
        "dim_lga": s.dim_lga,
        "dim_suburb": s.dim_suburb,
        "census_g01": s.g01,
        "census_g02": s.g02,
        "fact_listings": s.fact,
    }


_TEST_ROWS = [
    *[(table, c, "unique", "0") for table, cols in _UNIQUE.items() for c in cols],
    *[
        (table, c, "not_null",
         "(select count(*) from fact where lga_code is null)" if c == "lga_code"
         and table == "fact_listings" else "0")
        for table, cols in _REQUIRED.items()
        for c in cols
    ],
    *[(table, fk, "relationships", "0") for table, fk, _, _ in _REFERENCES],
]


@query(
    "quality_column_tests",
    with_tables(
        "fact",
        " union all ".join(
            f"select '{a}' as table_name, '{b}' as column_name, '{c}' as test, "
            f"cast({n} as bigint) as failures"
            for a, b, c, n in _TEST_ROWS
        ),
    ),
)
def column_tests(spark, sf_dir):
    return q.column_tests(_tables(spark, sf_dir), _UNIQUE, _REQUIRED, _REFERENCES)


@query(
    "quality_unique",
    "select l_orderkey, count(*) as n from lineitem group by 1 having count(*) > 1",
)
def unique(spark, sf_dir):
    return q.unique(t.table(spark, sf_dir, "lineitem"), "l_orderkey")


@query(
    "quality_not_null",
    with_tables(
        "silver",
        ", ".join(
            ["select count(*) filter (where host_neighbourhood is null) as host_neighbourhood"]
            + [f"count(*) filter (where {c} is null) as {c}" for c in
               ("host_is_superhost", "has_availability", "availability_30")]
        )
        + " from silver",
    ),
)
def not_null(spark, sf_dir):
    columns = ("host_neighbourhood", "host_is_superhost", "has_availability", "availability_30")
    return q.not_null(t.star(spark, sf_dir).once("listings").listings, *columns)


@query(
    "quality_relationships",
    "select c_custkey, c_mktsegment from customer where c_custkey not in "
    "(select user_id from events)",
)
def relationships(spark, sf_dir):
    """Customers that no event refers to."""
    customer = t.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    events = t.table(spark, sf_dir, "events")
    return q.relationships(customer, "c_custkey", events, "user_id")


# --- versions ----------------------------------------------------------------

_HITS = """select '{name}' as dimension, f.listing_id, f.month_date, count(d.{key}) as nb_versions
  from {fact} f left join {dim} d on f.{key} = d.{key}
    and f.month_date >= d.valid_from and f.month_date < d.valid_to
  group by f.listing_id, f.month_date having count(d.{key}) <> 1"""


@query(
    "quality_one_version",
    with_tables(
        "fact dim_host dim_property",
        _HITS.format(name="host", key="host_id", fact="fact", dim="dim_host")
        + " union all "
        + _HITS.format(name="property", key="listing_id", fact="fact", dim="dim_property"),
    ),
)
def one_version(spark, sf_dir):
    """No row: every fact row has exactly one host and one property version."""
    s = t.star(spark, sf_dir)
    dims = {"host": (s.dim_host, "host_id"), "property": (s.dim_property, "listing_id")}
    return q.one_version(s.fact, dims, {"host": s.host_slices})


@query(
    "quality_one_version_broken",
    with_tables(
        "fact dim_host dim_property",
        ", bad as (select * from dim_host where not host_is_superhost) "
        + _HITS.format(name="host", key="host_id", fact="fact", dim="bad"),
    ),
)
def one_version_broken(spark, sf_dir):
    """The same check against a dimension that lost versions, which must report them."""
    s = t.star(spark, sf_dir)
    broken = s.dim_host.filter("NOT host_is_superhost")
    return q.one_version(s.fact, {"host": (broken, "host_id")}, {"host": s.host_slices})


@query(
    "quality_one_version_overlaps",
    with_tables(
        "fact dim_host dim_property",
        """, hosts as (select * from dim_host where host_is_superhost is not null
            union all select * from dim_host where host_is_superhost),
          homes as (select * from dim_property
            union all select * from dim_property where accommodates = 3) """
        + _HITS.format(name="host", key="host_id", fact="fact", dim="hosts")
        + " union all "
        + _HITS.format(name="property", key="listing_id", fact="fact", dim="homes"),
    ),
)
def one_version_overlaps(spark, sf_dir):
    """Both dimensions in one pass, with facts that match no version, one, and two."""
    s = t.star(spark, sf_dir)
    hosts = s.dim_host.filter("host_is_superhost IS NOT NULL")
    hosts = hosts.unionByName(hosts.filter("host_is_superhost"))
    homes = s.dim_property.unionByName(s.dim_property.filter("accommodates = 3"))
    dims = {"host": (hosts, "host_id"), "property": (homes, "listing_id")}
    return q.one_version(s.fact, dims, {"host": s.host_slices})


@query(
    "quality_version_histogram",
    with_tables(
        "fact dim_host",
        """select count(*) filter (where n = 0) as none, count(*) filter (where n = 1) as one,
          count(*) filter (where n > 1) as many
        from (select f.listing_id, f.scraped_date, count(d.host_id) as n from fact f
              left join (select * from dim_host where not host_is_superhost) d
                on f.host_id = d.host_id
                and f.month_date >= d.valid_from and f.month_date < d.valid_to
              group by 1, 2)""",
    ),
)
def version_histogram(spark, sf_dir):
    s = t.star(spark, sf_dir)
    broken = s.dim_host.filter("NOT host_is_superhost")
    return q.version_histogram(s.fact, broken, "host_id", hot=s.host_slices)


@query(
    "quality_version_counts",
    with_tables(
        "host_versions property_versions",
        " union all ".join(
            f"""select '{d}' as dimension, count(*) as versions,
              count(distinct {k}) as entities, count(*) filter (where next_month is null) as current
            from {d}_versions"""
            for d, k in (("host", "host_id"), ("property", "listing_id"))
        ),
    ),
)
def version_counts(spark, sf_dir):
    s = t.star(spark, sf_dir)
    parts = [
        q.version_counts(history, key).withColumn("dimension", F.lit(name))
        for name, history, key in (
            ("host", star.host_history(s.listings, s.hot_hosts), "host_id"),
            ("property", star.property_history(s.listings, ()), "listing_id"),
        )
    ]
    return q.union_checks(*parts)


@query(
    "quality_changed_count",
    with_tables(
        "host_versions",
        "select count(*) as changed from (select host_id from host_versions group by 1 "
        "having count(distinct host_is_superhost) > 1)",
    ),
)
def changed_count(spark, sf_dir):
    s = t.star(spark, sf_dir)
    history = star.host_history(s.listings, s.hot_hosts)
    return q.changed_count(history, "host_id", "host_is_superhost")


@query(
    "quality_multi_current",
    with_tables(
        "dim_host dim_property",
        " + ".join(
            f"(select count(*) from (select {k} from {d} where is_current group by 1 "
            "having count(*) > 1))"
            for d, k in (("dim_host", "host_id"), ("dim_property", "listing_id"))
        ).join(["select ", " as entities"]),
    ),
)
def multi_current(spark, sf_dir):
    s = t.star(spark, sf_dir)
    dims = {"host": (s.dim_host, "host_id"), "property": (s.dim_property, "listing_id")}
    return q.multi_current(dims)


@query(
    "quality_rebuild_counts",
    with_tables(
        "silver host_versions property_versions",
        """select (select count(distinct month_date) from silver) as months,
          (select count(*) from host_versions) as versions_1,
          (select count(*) from property_versions) as versions_2""",
    ),
)
def rebuild_counts(spark, sf_dir):
    s = t.star(spark, sf_dir)
    histories = (
        star.host_history(s.listings, s.hot_hosts), star.property_history(s.listings, ())
    )
    return q.rebuild_counts(_kpis(s), *histories)


# --- tables and files --------------------------------------------------------

_GIVEN = ("customer", "lineitem", "nation", "orders", "part", "region", "supplier")


@query(
    "quality_tables_present",
    " union all ".join(f"select 'given_{n}' as table_name, true as present" for n in _GIVEN)
    + " union all select 'given_missing', false",
)
def tables_present(spark, sf_dir):
    for name in _GIVEN:
        t.table(spark, sf_dir, name).createOrReplaceTempView(f"given_{name}")
    return q.tables_present(spark, [*[f"given_{n}" for n in _GIVEN], "given_missing"])


@query(
    "quality_row_counts",
    " union all ".join(
        f"select '{n}' as table_name, count(*) as nb_rows from {n}" for n in _GIVEN
    ),
)
def row_counts(spark, sf_dir):
    return q.row_counts({n: t.table(spark, sf_dir, n) for n in _GIVEN})


@query(
    "quality_mart_row_counts",
    with_tables(
        "area_kpis host_area_kpis",
        """select 'dm_listing_neighbourhood' as table_name, count(*) as nb_rows from area_kpis
        union all select 'dm_property_type', count(*) from (select distinct property_type,
          room_type, accommodates, month_date from visits)
        union all select 'dm_host_neighbourhood', count(*) from host_area_kpis""",
    ),
)
def mart_row_counts(spark, sf_dir):
    """The marts by listing and by type share their joins."""
    s = t.star(spark, sf_dir).once("fact", "dim_property", "dim_host")
    gold = s.fact, s.dim_property, s.dim_host, s.host_slices
    how = {"medians": False, "apart": True, "rows": marts.shared_visits(*gold, apart=True)}
    return q.row_counts(
        {
            "dm_listing_neighbourhood": marts.dm_listing_neighbourhood(*gold, **how),
            "dm_property_type": marts.dm_property_type(*gold, **how),
            "dm_host_neighbourhood": marts.dm_host_neighbourhood(
                s.fact,
                s.dim_host,
                s.dim_suburb,
                s.host_slices,
                hot_suburbs=s.hot_suburbs,
                apart=True,
            ),
        }
    )


@query(
    "quality_compare_counts",
    with_tables(
        "fact silver",
        """select *, left_rows = right_rows as passed from
          (select (select count(*) from fact) as left_rows,
             (select count(*) from silver) as right_rows)""",
    ),
)
def compare_counts(spark, sf_dir):
    s = t.star(spark, sf_dir)
    return q.compare_counts(s.fact, s.listings)


@query(
    "quality_rows_per_file",
    with_tables(
        "listing_rows",
        """select source_file, count(*) as nb_rows, cast(min(loaded_at) as date) as first_load,
          cast(max(loaded_at) as date) as last_load from listing_rows group by 1""",
    ),
)
def rows_per_file(spark, sf_dir):
    files = q.rows_per_file(t.raw_listings(spark, sf_dir))
    return files.withColumns({c: F.to_date(c) for c in ("first_load", "last_load")})


@query(
    "quality_date_span_per_file",
    with_tables(
        "listing_rows",
        """select source_file, cast(min(scraped_date) as varchar) as first_scrape,
          cast(max(scraped_date) as varchar) as last_scrape,
          count(distinct left(cast(scraped_date as varchar), 7)) as nb_months_inside,
          count(*) as nb_rows from listing_rows group by 1""",
    ),
)
def date_span_per_file(spark, sf_dir):
    return q.date_span_per_file(t.raw_listings(spark, sf_dir))


@query("quality_preview", "select * from nation order by n_nationkey limit 10")
def preview(spark, sf_dir):
    nation = t.table(spark, sf_dir, "nation").orderBy("n_nationkey")
    return q.preview(nation, 10)


@query(
    "quality_load_calendar",
    with_tables(
        "listing_rows",
        """select string_agg(source_file || ' = ' || n, ', ' order by m) as rows_per_file,
          string_agg(strftime(m, '%Y-%m'), ', ' order by m) as silver_months,
          string_agg(strftime(m, '%Y-%m'), ', ' order by m) as mart_months
        from (select source_file, month_date as m, count(*) as n from listing_rows group by 1, 2)""",
    ),
)
def load_calendar(spark, sf_dir):
    s = t.star(spark, sf_dir)
    return q.load_calendar(t.raw_listings(spark, sf_dir), s.listings, _kpis(s))


# --- values ------------------------------------------------------------------


@query(
    "quality_duplicate_count",
    """select (select count(*) - count(distinct l_orderkey) from lineitem) as one_column,
      (select count(*) from lineitem) - (select count(*) from
        (select distinct l_orderkey, l_linenumber from lineitem)) as two_columns""",
)
def duplicate_count(spark, sf_dir):
    line = t.table(spark, sf_dir, "lineitem")
    one = q.duplicate_count(line, "l_orderkey").withColumnRenamed("duplicates", "one_column")
    two = q.duplicate_count(line, "l_orderkey", "l_linenumber")
    return q.side_by_side(one, two.withColumnRenamed("duplicates", "two_columns"))


@query(
    "quality_null_drift",
    with_tables(
        "listing_rows silver",
        ", ".join(
            f"(select count(*) from {tab} where {c} is null) as {c}_{side}"
            for tab, side in (("listing_rows", "before"), ("silver", "after"))
            for c in ("price", "host_since", "review_scores_rating")
        ).join(["select ", ""]),
    ),
)
def null_drift(spark, sf_dir):
    columns = ["price", "host_since", "review_scores_rating"]
    return q.null_drift(t.raw_listings(spark, sf_dir), t.star(spark, sf_dir).listings, columns)


@query(
    "quality_null_counts",
    with_tables(
        "silver",
        """select count(*) filter (where host_id is null) as host_id,
          count(*) filter (where listing_id is null) as listing_id,
          count(*) filter (where scraped_date is null) as scraped_date from silver""",
    ),
)
def null_counts(spark, sf_dir):
    return q.null_counts(
        t.star(spark, sf_dir).listings, ["host_id", "listing_id", "scraped_date"]
    )


@query(
    "quality_ranges",
    with_tables(
        "silver",
        ", ".join(
            f"cast(min({c}) as {k}) as {c}_min, cast(max({c}) as {k}) as {c}_max"
            for c, k in (
                ("price", "double"),
                ("availability_30", "bigint"),
                ("review_scores_rating", "double"),
            )
        ).join(["select ", " from silver"]),
    ),
)
def ranges(spark, sf_dir):
    columns = ["price", "availability_30", "review_scores_rating"]
    return plain(q.ranges(t.star(spark, sf_dir).once("listings").listings, columns))


@query(
    "quality_mart_ranges",
    with_tables(
        "area_kpis",
        ", ".join(
            f"min({c}) as {c}_min, max({c}) as {c}_max"
            for c in ("active_listings_rate", "superhost_rate")
        ).join(["select ", " from area_kpis"]),
    ),
)
def mart_ranges(spark, sf_dir):
    s = t.star(spark, sf_dir).once("fact", "dim_property", "dim_host")
    return plain(q.ranges(_kpis(s), ["active_listings_rate", "superhost_rate"]))


@query(
    "quality_flag_distribution",
    with_tables(
        "silver",
        """select count(*) filter (where has_availability) as true_rows,
          count(*) filter (where not has_availability) as false_rows,
          count(*) filter (where has_availability is null) as null_rows from silver""",
    ),
)
def flag_distribution(spark, sf_dir):
    return q.flag_distribution(t.star(spark, sf_dir).once("listings").listings, "has_availability")


@query(
    "quality_outliers",
    with_tables(
        "silver",
        """select count(*) filter (where price = 0) as price_zero,
          count(*) filter (where price > 100000) as "price_over_100000" from silver""",
    ),
)
def outliers(spark, sf_dir):
    return q.outliers(t.star(spark, sf_dir).once("listings").listings, "price", 100000)


@query(
    "quality_missing_keys",
    "select c_custkey from customer where c_custkey not in (select user_id from events)",
)
def missing_keys(spark, sf_dir):
    customer, events = (t.table(spark, sf_dir, n) for n in ("customer", "events"))
    return q.missing_keys(customer, "c_custkey", events, "user_id")


# --- keys between tables -----------------------------------------------------


@query(
    "quality_unmatched_names",
    with_tables(
        "silver lga_loads",
        """select distinct listing_neighbourhood from silver where upper(listing_neighbourhood)
          not in (select lga_name_key from lga_loads)""",
    ),
)
def unmatched_names(spark, sf_dir):
    s = t.star(spark, sf_dir)
    loads = t.lga_loads(spark, sf_dir)
    return q.unmatched_names(s.listings, "listing_neighbourhood", loads, "lga_name_key")


@query(
    "quality_unmatched_rate",
    with_tables(
        "dim_host dim_suburb",
        """select count(*) filter (where host_neighbourhood is not null and
            upper(host_neighbourhood) not in (select suburb_name_key from dim_suburb)) as unmatched,
          count(*) filter (where host_neighbourhood is null) as nameless,
          count(*) as all_rows from dim_host""",
    ),
)
def unmatched_rate(spark, sf_dir):
    s = t.star(spark, sf_dir).once("dim_host")
    return q.unmatched_rate(s.dim_host, "host_neighbourhood", s.dim_suburb, "suburb_name_key")


@query(
    "quality_unmatched_top",
    """select s_name, count(*) as nb_rows from lineitem join supplier on l_suppkey = s_suppkey
    where upper(s_name) not in (select upper(s_name) from supplier where s_acctbal > 0)
    group by 1 order by nb_rows desc, s_name limit 15""",
)
def unmatched_top(spark, sf_dir):
    supplier = t.table(spark, sf_dir, "supplier")
    line = t.table(spark, sf_dir, "lineitem").select("l_suppkey")
    named = line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select("s_name")
    known = supplier.filter("s_acctbal > 0").select(F.upper("s_name").alias("key"))
    return q.unmatched_top(named, "s_name", known, "key")


@query(
    "quality_key_difference",
    with_tables(
        "g01",
        """, a as (select distinct s_nationkey as k from supplier where s_acctbal > 5000),
          b as (select n_nationkey as k from nation where n_regionkey <> 1)
        select cast(k as bigint) as key, 'left' as side from a where k not in (select k from b)
        union all select cast(k as bigint), 'right' from b where k not in (select k from a)""",
    ),
)
def key_difference(spark, sf_dir):
    rich = t.table(spark, sf_dir, "supplier").filter("s_acctbal > 5000")
    rich = rich.select("s_nationkey").distinct()
    nation = t.table(spark, sf_dir, "nation").filter("n_regionkey <> 1")
    return plain(q.key_difference(rich, "s_nationkey", nation, "n_nationkey"))


@query(
    "quality_resolution_rate",
    with_tables(
        "dim_host dim_suburb",
        """select count(s.lga_code) as resolved, count(*) as all_rows from dim_host h
        left join dim_suburb s on upper(h.host_neighbourhood) = s.suburb_name_key
          and s.is_current""",
    ),
)
def resolution_rate(spark, sf_dir):
    s = t.star(spark, sf_dir).once("dim_host")
    return q.resolution_rate(
        s.dim_host, "host_neighbourhood", s.dim_suburb, "suburb_name_key", "lga_code"
    )


@query(
    "quality_fact_coverage",
    with_tables(
        "fact g02",
        """select count(*) as fact_rows, count(*) filter (where lga_code is null) as without_key,
          count(*) filter (where lga_code in (select lga_code from g02)) as with_reference
        from fact""",
    ),
)
def fact_coverage(spark, sf_dir):
    s = t.star(spark, sf_dir)
    return q.fact_coverage(s.fact, s.g02, "lga_code")


# --- reconciliation ----------------------------------------------------------


@query(
    "quality_period_total",
    with_tables(
        "fact",
        f"""select {dbl("sum(estimated_revenue)")} as total,
          format('{{:,}}', cast(round(sum(estimated_revenue), 0) as bigint)) as total_text
        from fact where month_date = date '1997-05-01'""",
    ),
)
def period_total(spark, sf_dir):
    return plain(q.period_total(t.star(spark, sf_dir).fact, "1997-05-01"))


@query(
    "quality_reconcile_stays",
    with_tables(
        "fact area_kpis",
        """select *, left_total = right_total as passed from (select
          (select cast(sum(number_of_stays) as bigint) from fact) as left_total,
          (select cast(sum(total_stays) as bigint) from area_kpis) as right_total)""",
    ),
)
def reconcile_stays(spark, sf_dir):
    s = t.star(spark, sf_dir)
    return q.reconcile(s.fact, F.sum("number_of_stays"), _kpis(s), F.sum("total_stays"))


@query(
    "quality_reconcile_revenue",
    with_tables(
        "fact host_area_kpis",
        f"""select {dbl("l")} as left_total, {rounded("r", 2)} as right_total,
          abs(l - r) <= l * 0.0001 as passed
        from (select (select sum(estimated_revenue) from fact) as l,
          (select sum(cast(estimated_revenue_per_host as decimal(18,2)) * distinct_hosts)
             from host_area_kpis) as r)""",
    ),
)
def reconcile_revenue(spark, sf_dir):
    """Per-host revenue is rounded, so the totals agree only within a tolerance."""
    s = t.star(spark, sf_dir)
    back = F.sum(F.col("estimated_revenue_per_host") * F.col("distinct_hosts"))
    return plain(
        q.reconcile(s.fact, F.sum("estimated_revenue"), _host_areas(s), back, tolerance=0.0001)
    )


@query(
    "quality_reconcile_distinct",
    with_tables(
        "fact host_area_kpis",
        """select
          (select count(distinct host_id) from fact where month_date = date '1997-05-01')
            as fact_hosts,
          cast(sum(distinct_hosts) as bigint) as mart_hosts,
          cast(sum(distinct_hosts) filter (where host_neighbourhood_lga = 'Unknown') as bigint)
            as unknown_hosts
        from host_area_kpis where month_year = date '1997-05-01'""",
    ),
)
def reconcile_distinct(spark, sf_dir):
    s = t.star(spark, sf_dir)
    return q.reconcile_distinct(s.fact, _host_areas(s), "1997-05-01")


@query(
    "quality_top_groups_text",
    with_tables(
        "area_kpis",
        """select string_agg(g || ' ($' || cast(m as decimal(18,2)) || ')', ', '
            order by m desc nulls last, g, month_year) as top
        from (select listing_neighbourhood as g, month_year,
                avg_estimated_revenue_per_active_listing as m from area_kpis
              order by m desc nulls last, g, month_year limit 3)""",
    ),
)
def top_groups_text(spark, sf_dir):
    s = t.star(spark, sf_dir).once("fact", "dim_property", "dim_host")
    return q.top_groups_text(_kpis(s))


@query(
    "quality_filled_count",
    with_tables("area_kpis", "select count(active_listings_pct_change) as filled from area_kpis"),
)
def filled_count(spark, sf_dir):
    s = t.star(spark, sf_dir).once("fact", "dim_property", "dim_host")
    return q.filled_count(_kpis(s), "active_listings_pct_change")


@query(
    "quality_text_lines",
    with_tables(
        "fact silver",
        """select 'rows fact / silver' as check_name, (select count(*) from fact) || ' / '
          || (select count(*) from silver) as result
        union all select 'availability true / false / null',
          count(*) filter (where has_availability) || ' / '
          || count(*) filter (where not has_availability) || ' / '
          || count(*) filter (where has_availability is null) from silver""",
    ),
)
def text_lines(spark, sf_dir):
    """Figures rendered as the text lines of a check report."""
    s = t.star(spark, sf_dir)
    counts = q.compare_counts(s.fact, s.listings).drop("passed")
    return q.union_checks(
        q.as_text(counts, "rows fact / silver"),
        q.as_text(
            q.flag_distribution(s.listings, "has_availability"), "availability true / false / null"
        ),
    )
