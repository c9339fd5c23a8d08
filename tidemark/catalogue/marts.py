"""Silver, history, star, marts and reports over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalogue import query
from tidemark.catalogue import tables as t
from tidemark.catalogue.sql import dbl, kpis, rounded, with_tables
from tidemark.catalogue.tables import AGE_COLUMNS, MEDIAN_DIVISORS, plain
from tidemark.operators import history as h
from tidemark.operators.joins import partitions
from tidemark.operators.pointintime import pit_join
from tidemark.plans import marts, reports, silver, star
from tidemark.plans.silver import LISTING_COLUMNS
from tidemark.session import shared_dir
from tidemark.sources.load import write_table

SCORES_OUT = ", ".join(
    f"cast({c} as double) as {c}" for c in LISTING_COLUMNS if c.startswith("review_scores_")
)

SILVER_OUT = """listing_id, host_id, scraped_date, month_date, host_since, host_name,
  host_is_superhost, host_neighbourhood, listing_neighbourhood, property_type, room_type,
  cast(accommodates as bigint) as accommodates, cast(price as double) as price,
  has_availability, cast(availability_30 as bigint) as availability_30,
  cast(number_of_reviews as bigint) as number_of_reviews,
  """ + SCORES_OUT + ", source_file, cast(loaded_at as date) as loaded_at"


# --- silver ------------------------------------------------------------------


@query("silver_clean_listings", with_tables("silver", f"select {SILVER_OUT} from silver"))
def clean_listings(spark, sf_dir):
    raw = t.raw_listings(spark, sf_dir)
    hot = t.hot_listings(spark, sf_dir)
    cleaned = silver.clean_listings(raw, tie_break=t.TIE_BREAK, hot=hot)
    return plain(cleaned.withColumn("loaded_at", F.to_date("loaded_at")))


@query(
    "silver_latest_hosts",
    with_tables(
        "silver",
        """select host_id, host_name, host_since, host_is_superhost, host_neighbourhood, month_date
        from (select *, row_number() over (partition by host_id order by
                month_date desc nulls first, scraped_date desc nulls first,
                listing_id desc nulls first) as k from silver where host_id is not null)
        where k = 1""",
    ),
)
def latest_hosts(spark, sf_dir):
    return silver.latest_hosts(t.silver(spark, sf_dir))


@query(
    "silver_latest_properties",
    with_tables(
        "silver",
        """select listing_id, listing_neighbourhood, property_type, room_type,
          cast(accommodates as bigint) as accommodates, month_date
        from (select *, row_number() over (partition by listing_id order by
                month_date desc nulls first) as k from silver) where k = 1""",
    ),
)
def latest_properties(spark, sf_dir):
    return plain(silver.latest_properties(t.silver(spark, sf_dir)))


@query(
    "silver_clean_lga",
    with_tables(
        "lga_loads",
        "select cast(lga_code as bigint) as lga_code, lga_name, lga_name_key, "
        "loaded_on as loaded_at from lga_loads",
    ),
)
def clean_lga(spark, sf_dir):
    loads = t.lga_loads(spark, sf_dir)
    return plain(loads.withColumn("loaded_at", F.to_date("loaded_at")))


@query(
    "silver_clean_suburb",
    with_tables(
        "suburb_loads",
        "select suburb_name_key, suburb_name, cast(lga_code as bigint) as lga_code, lga_name, "
        "loaded_on as loaded_at from suburb_loads",
    ),
)
def clean_suburb(spark, sf_dir):
    loads = t.suburb_loads(spark, sf_dir)
    return plain(loads.withColumn("loaded_at", F.to_date("loaded_at")))


_G01_OUT = ", ".join(f"cast({c} as bigint) as {c}" for c in ("lga_code", "tot_p_p", *AGE_COLUMNS))
_G02_OUT = "cast(lga_code as bigint) as lga_code, " + ", ".join(
    f"cast({c} as {'double' if c.startswith('average_') else 'bigint'}) as {c}"
    for c in MEDIAN_DIVISORS
)


@query("silver_clean_counts", with_tables("g01", f"select {_G01_OUT} from g01"))
def clean_counts(spark, sf_dir):
    return plain(t.g01(spark, sf_dir).drop("loaded_at"))


@query("silver_clean_medians", with_tables("g02", f"select {_G02_OUT} from g02"))
def clean_medians(spark, sf_dir):
    return plain(t.g02(spark, sf_dir).drop("loaded_at"))


# --- history -----------------------------------------------------------------

HOST_HISTORY = """select version_id, host_id, host_name, host_since, host_is_superhost, host_neighbourhood,
  month_date as valid_from, next_month as valid_to from host_versions"""


def _bounds(df):
    return plain(df.drop("month_date", "loaded_at"))


@query("history_hosts", with_tables("host_versions", HOST_HISTORY))
def host_history(spark, sf_dir):
    return _bounds(star.host_history(t.silver(spark, sf_dir), t.hot_hosts(spark, sf_dir)))


@query(
    "history_properties",
    with_tables(
        "property_versions",
        """select version_id, listing_id, listing_neighbourhood, property_type, room_type,
          cast(accommodates as bigint) as accommodates, month_date as valid_from,
          next_month as valid_to from property_versions""",
    ),
)
def property_history(spark, sf_dir):
    return _bounds(star.property_history(t.silver(spark, sf_dir), ()))


def _dated(df):
    return _bounds(
        df.withColumns({c: F.to_date(c) for c in ("valid_from", "valid_to")})
    )


@query(
    "history_lga",
    with_tables(
        "lga_loads",
        """select md5(lga_code || '|' || loaded_on || ' 00:00:00') as version_id,
          cast(lga_code as bigint) as lga_code, lga_name, lga_name_key,
          loaded_on as valid_from, lead(loaded_on) over (partition by lga_code
          order by loaded_on) as valid_to from lga_loads""",
    ),
)
def lga_history(spark, sf_dir):
    return _dated(star.lga_history(t.lga_loads(spark, sf_dir)))


@query(
    "history_suburb",
    with_tables(
        "suburb_loads",
        """select md5(suburb_name_key || '|' || loaded_on || ' 00:00:00') as version_id,
          suburb_name_key, suburb_name, cast(lga_code as bigint) as lga_code, lga_name,
          loaded_on as valid_from, lead(loaded_on) over (partition by suburb_name_key
          order by loaded_on) as valid_to from suburb_loads""",
    ),
)
def suburb_history(spark, sf_dir):
    return _dated(star.suburb_history(t.suburb_loads(spark, sf_dir)))


@query(
    "history_snapshot_step",
    with_tables(
        "lga_loads",
        """select md5(lga_code || '|' || loaded_on || ' 00:00:00') as version_id,
          cast(lga_code as bigint) as lga_code, lga_name, lga_name_key,
          loaded_on as valid_from, lead(loaded_on) over (partition by lga_code
          order by loaded_on) as valid_to from lga_loads""",
    ),
)
def snapshot_step(spark, sf_dir):
    """Two loads applied one after the other, then the first again, which changes nothing."""
    first, second = (t.lga_load(spark, sf_dir, i) for i in (0, 1))
    versions = None
    for batch in (first, second, first):
        versions = h.scd2_apply(versions, batch, "lga_code", "loaded_at")
    return _dated(versions)


@query(
    "history_snapshot_step_hosts",
    with_tables(
        "silver",
        """select md5(host_id || '|' || month_date) as version_id, host_id, host_is_superhost,
          month_date as valid_from,
          lead(month_date) over (partition by host_id order by month_date) as valid_to
        from (select *, row_number() over (partition by host_id, year(month_date) order by
                month_date desc, scraped_date desc nulls first, listing_id desc) as k
              from silver where host_id is not null)
        where k = 1""",
    ),
)
def snapshot_step_hosts(spark, sf_dir):
    """One snapshot per year, each fed with that year's months only."""
    path = shared_dir(spark, "host-history")
    needed = t.silver(spark, sf_dir).select(
        "host_id", "host_is_superhost", "month_date", "scraped_date", "listing_id"
    )
    seen = write_table(needed, path, "silver", "listings", "month_date")
    versions = h.HistoryTable(spark, f"{path}/history", "host_id", "month_date")
    order = [F.col("month_date").desc(), *silver.host_order()]
    years = seen.agg(F.min(F.year("month_date")), F.max(F.year("month_date"))).first()
    for year in range(years[0], years[1] + 1):
        first, after = (F.make_date(F.lit(y), F.lit(1), F.lit(1)) for y in (year, year + 1))
        rows = seen.filter((F.col("month_date") >= first) & (F.col("month_date") < after))
        state = silver.latest_per_key(rows, ["host_id"], order)
        versions.apply(state.select("host_id", "host_is_superhost", "month_date"))
    return versions.read().drop("month_date")


@query(
    "history_collapse_unchanged",
    with_tables(
        "host_versions",
        """select host_id, host_is_superhost, month_date as valid_from,
          lead(month_date) over (partition by host_id order by month_date) as valid_to
        from (select *, lag(1) over w is not null
                and lag(host_is_superhost) over w is not distinct from host_is_superhost as same
              from host_versions window w as (partition by host_id order by month_date))
        where not same""",
    ),
)
def collapse_unchanged(spark, sf_dir):
    versions = star.host_history(t.silver(spark, sf_dir), t.hot_hosts(spark, sf_dir)).select(
        "host_id", "host_is_superhost", "valid_from", "valid_to"
    )
    return h.collapse_unchanged(versions, "host_id", ["host_is_superhost"])


@query(
    "history_changed_entities",
    with_tables(
        "host_versions",
        "select host_id from host_versions group by host_id "
        "having count(distinct host_is_superhost) > 1",
    ),
)
def changed_entities(spark, sf_dir):
    versions = star.host_history(t.silver(spark, sf_dir), t.hot_hosts(spark, sf_dir))
    return h.changed_entities(versions, "host_id", "host_is_superhost")


@query(
    "history_timeline",
    with_tables(
        "host_versions",
        HOST_HISTORY
        + """ where host_id = (select min(host_id) from (select host_id from host_versions
          group by host_id having count(distinct host_is_superhost) > 1))""",
    ),
)
def timeline(spark, sf_dir):
    versions = star.host_history(t.silver(spark, sf_dir), t.hot_hosts(spark, sf_dir))
    return _bounds(h.timeline(versions, "host_id", "host_is_superhost"))


# --- star --------------------------------------------------------------------

HOST_DIM = """host_version_id, host_id, host_name, host_since, host_is_superhost, host_neighbourhood,
  valid_from, valid_to, is_current"""
PROPERTY_DIM = """property_version_id, listing_id, listing_neighbourhood, property_type, room_type,
  cast(accommodates as bigint) as accommodates, valid_from, valid_to, is_current"""


@query("star_dim_host", with_tables("dim_host", f"select {HOST_DIM} from dim_host"))
def dim_host(spark, sf_dir):
    dim = star.dim_host(star.host_history(t.silver(spark, sf_dir), t.hot_hosts(spark, sf_dir)))
    return plain(dim)


@query("star_dim_property", with_tables("dim_property", f"select {PROPERTY_DIM} from dim_property"))
def dim_property(spark, sf_dir):
    dim = star.dim_property(star.property_history(t.silver(spark, sf_dir), ()))
    return plain(dim)


@query(
    "star_dim_lga",
    with_tables(
        "dim_lga",
        "select lga_version_id, cast(lga_code as bigint) as lga_code, lga_name, lga_name_key, "
        "valid_from, "
        "valid_to, is_current from dim_lga",
    ),
)
def dim_lga(spark, sf_dir):
    return plain(t.areas(spark, sf_dir))


@query(
    "star_dim_suburb",
    with_tables(
        "dim_suburb",
        "select suburb_version_id, suburb_name_key, suburb_name, "
        "cast(lga_code as bigint) as lga_code, lga_name, valid_from, valid_to, is_current from dim_suburb",
    ),
)
def dim_suburb(spark, sf_dir):
    return plain(t.suburbs(spark, sf_dir))


@query(
    "star_fact_listings",
    with_tables(
        "fact",
        f"""select listing_id, host_id, cast(lga_code as bigint) as lga_code, scraped_date,
          month_date, {dbl("price")} as price, has_availability,
          cast(availability_30 as bigint) as availability_30,
          cast(number_of_reviews as bigint) as number_of_reviews,
          {SCORES_OUT},
          cast(number_of_stays as bigint) as number_of_stays,
          {dbl("estimated_revenue")} as estimated_revenue from fact""",
    ),
)
def fact_listings(spark, sf_dir):
    fact = star.fact_listings(t.silver(spark, sf_dir), t.areas(spark, sf_dir))
    return plain(fact)


@query("star_census_g01", with_tables("g01", f"select {_G01_OUT} from g01"))
def census_g01(spark, sf_dir):
    return plain(star.census_g01(t.raw_g01(spark, sf_dir)).drop("loaded_at"))


@query("star_census_g02", with_tables("g02", f"select {_G02_OUT} from g02"))
def census_g02(spark, sf_dir):
    return plain(star.census_g02(t.g02(spark, sf_dir)).drop("loaded_at"))


# --- marts -------------------------------------------------------------------


@query("mart_listing_neighbourhood", with_tables("area_kpis", "select * from area_kpis"))
def mart_listing_neighbourhood(spark, sf_dir):
    s = t.star(spark, sf_dir).once("fact", "dim_property", "dim_host")
    return plain(
        marts.dm_listing_neighbourhood(s.fact, s.dim_property, s.dim_host, s.host_slices)
    )


@query("mart_copartitioned_gold", with_tables("area_kpis", "select * from area_kpis"))
def mart_copartitioned_gold(spark, sf_dir):
    """The same mart from a fact and properties in equal buckets within the months."""
    built = t.star(spark, sf_dir)
    s = star.co_partitioned(built, shared_dir(spark, "buckets"), partitions(built.listings))
    return plain(
        marts.dm_listing_neighbourhood(s.fact, s.dim_property, s.dim_host, s.host_slices)
    )


@query(
    "mart_property_type",
    with_tables(
        "visits",
        "select * replace (cast(accommodates as bigint) as accommodates) from ("
        + kpis("property_type, room_type, accommodates")
        + ")",
    ),
)
def mart_property_type(spark, sf_dir):
    s = t.star(spark, sf_dir).once("fact", "dim_property", "dim_host")
    return plain(marts.dm_property_type(s.fact, s.dim_property, s.dim_host, s.host_slices))


@query("mart_host_neighbourhood", with_tables("host_area_kpis", "select * from host_area_kpis"))
def mart_host_neighbourhood(spark, sf_dir):
    s = t.star(spark, sf_dir).once("fact", "dim_host")
    areas = marts.dm_host_neighbourhood(
        s.fact, s.dim_host, s.dim_suburb, s.host_slices, hot_suburbs=s.hot_suburbs
    )
    return plain(areas)


@query(
    "mart_from_collapsed_history",
    with_tables("area_kpis", "select * from area_kpis"),
)
def mart_from_collapsed_history(spark, sf_dir):
    """The same mart from histories without unchanged versions."""
    s = t.star(spark, sf_dir)
    listings = s.listings
    hosts = star.host_history(listings, s.hot_hosts).drop("month_date", "version_id")
    homes = star.property_history(listings, ()).drop("month_date", "version_id")
    hosts = h.collapse_unchanged(
        hosts.select("host_id", "host_is_superhost", "valid_from", "valid_to"),
        "host_id",
        ["host_is_superhost"],
    ).withColumn("version_id", F.lit("-"))
    homes = h.collapse_unchanged(
        homes.select("listing_id", "listing_neighbourhood", "valid_from", "valid_to"),
        "listing_id",
        ["listing_neighbourhood"],
    ).withColumn("version_id", F.lit("-"))
    return plain(
        marts.dm_listing_neighbourhood(
            s.fact,
            h.to_dimension(homes, "listing_id", ["listing_neighbourhood"], "property"),
            h.to_dimension(hosts, "host_id", ["host_is_superhost"], "host"),
            s.host_slices,
        )
    )


@query(
    "mart_salted_hosts",
    with_tables(
        "fact dim_host",
        """select f.listing_id, f.month_date, f.host_id, h.host_is_superhost
        from fact f left join dim_host h on f.host_id = h.host_id
          and f.month_date >= h.valid_from and f.month_date < h.valid_to""",
    ),
)
def salted_hosts(spark, sf_dir):
    """The point-in-time join with the three largest hosts spread over many tasks."""
    s = t.star(spark, sf_dir)
    line = t.table(spark, sf_dir, "lineitem")
    top = line.groupBy("l_orderkey").count().orderBy(F.desc("count"), "l_orderkey").limit(3)
    hot = [row[0] for row in top.collect()]
    fact = s.fact.select("listing_id", "month_date", "host_id")
    hosts = s.dim_host.select("host_id", "valid_from", "valid_to", "host_is_superhost")
    return pit_join(fact, hosts, "host_id", how="left", hot=hot)


# --- reports -----------------------------------------------------------------

_BAND_SQL = {name: " + ".join(cols) for name, cols in reports.AGE_BANDS.items()}
_ALL_BANDS = " + ".join(f"b_{n}" for n in _BAND_SQL)


@query(
    "report_demographics_top_bottom",
    with_tables(
        "lga_rates g01 g02",
        f"""
        select revenue_group, cast(k as bigint) as sort_in_group, lga_name,
          {rounded("tr / nullif(am, 0)", 2)} as revenue_per_active_listing, pop as population,
          {rounded("wa / nullif(pop, 0)", 1)} as median_age,
          {rounded("wh / nullif(pop, 0)", 2)} as avg_household_size,
          {", ".join(
              f"{rounded(f'100.0 * b_{n} / nullif({_ALL_BANDS}, 0)', 1)} as pct_{n}"
              for n in _BAND_SQL
          )}
        from (
          select revenue_group, case when lga_name is null then 2 else 1 end as k,
            coalesce(lga_name, 'ALL 3 (weighted)') as lga_name, sum(total_revenue) as tr,
            sum(months) as am, cast(sum(tot_p_p) as bigint) as pop,
            sum(cast(median_age_persons as decimal(12,4)) * tot_p_p) as wa,
            sum(cast(average_household_size as decimal(12,4)) * tot_p_p) as wh,
            {", ".join(f"sum({e}) as b_{n}" for n, e in _BAND_SQL.items())}
          from (select *, case when up <= 3 then 'Top 3' else 'Bottom 3' end as revenue_group
                from (select *, rank() over (order by rate desc) as up,
                        rank() over (order by rate asc) as down
                      from lga_rates where rate is not null)
                where up <= 3 or down <= 3) c
          join g01 on c.lga_code = g01.lga_code join g02 on c.lga_code = g02.lga_code
          group by grouping sets ((revenue_group, lga_name), (revenue_group)))""",
    ),
)
def demographics_top_bottom(spark, sf_dir):
    s = t.star(spark, sf_dir)
    return plain(reports.demographics_top_bottom(s.fact, s.dim_lga, s.g01, s.g02))


@query(
    "report_rank_method_check",
    with_tables(
        "lga_rates area_kpis",
        f"""select lga_name, {rounded("rate", 2)} as rev_my_way_weighted,
          {rounded("av", 2)} as rev_avg_of_months,
          rank() over (order by rate desc) as rank_my_way,
          rank() over (order by av desc) as rank_avg_of_months
        from lga_rates join (select upper(listing_neighbourhood) as k,
            cast(sum(cast(avg_estimated_revenue_per_active_listing as decimal(18,2)))
              / count(avg_estimated_revenue_per_active_listing) as decimal(18,6)) as av
          from area_kpis group by 1) on upper(lga_name) = k""",
    ),
)
def rank_method_check(spark, sf_dir):
    s = t.star(spark, sf_dir)
    kpi = marts.dm_listing_neighbourhood(
        s.fact, s.dim_property, s.dim_host, s.host_slices, medians=False
    )
    return plain(reports.rank_method_check(s.fact, s.dim_lga, kpi))


def _correlation(rank_sql: str) -> str:
    return with_tables(
        "lga_rates g02",
        f"""select count(*) as nb_lga, {rounded("corr(age, rate)", 3)} as pearson_corr,
          {rounded("corr(ra, rr)", 3)} as spearman_corr,
          min(age) || ' - ' || max(age) as median_age_range,
          cast(round(min(rate), 2) as decimal(18,2)) || ' - '
            || cast(round(max(rate), 2) as decimal(18,2)) as revenue_range
        from (select age, rate, {rank_sql.format("age")} as ra, {rank_sql.format("rate")} as rr
              from (select median_age_persons as age, rate from lga_rates r
                    join g02 on r.lga_code = g02.lga_code))""",
    )


@query("report_correlation", _correlation("rank() over (order by {0})"))
def correlation_report(spark, sf_dir):
    s = t.star(spark, sf_dir)
    return plain(reports.correlation_report(s.fact, s.dim_lga, s.g02))


@query(
    "report_correlation_average_ties",
    _correlation("rank() over (order by {0}) + (count(*) over (partition by {0}) - 1) / 2.0"),
)
def correlation_average_ties(spark, sf_dir):
    s = t.star(spark, sf_dir)
    return plain(reports.correlation_report(s.fact, s.dim_lga, s.g02, ties="average"))


@query(
    "report_correlation_detail",
    with_tables(
        "lga_rates g02",
        f"""select lga_name, cast(median_age_persons as bigint) as median_age,
          {rounded("rate", 2)} as revenue_per_active_listing, months as active_listing_months,
          {dbl("average_household_size")} as average_household_size,
          cast(median_tot_hhd_inc_weekly as bigint) as median_household_income_weekly
        from lga_rates r join g02 on r.lga_code = g02.lga_code""",
    ),
)
def correlation_detail(spark, sf_dir):
    s = t.star(spark, sf_dir)
    return plain(reports.correlation_detail(s.fact, s.dim_lga, s.g02))


_TYPES = f"""
  select listing_neighbourhood as nb, property_type, room_type, accommodates,
    count(*) filter (where has_availability) as active_listing_months,
    cast(sum(number_of_stays) as bigint) as total_stays,
    {rounded('''sum(number_of_stays) filter (where has_availability)
       / nullif(count(number_of_stays) filter (where has_availability), 0)''', 1)}
      as avg_stays_per_month,
    {rounded('''sum(price) filter (where has_availability)
       / nullif(count(price) filter (where has_availability), 0)''', 2)} as avg_price,
    {rounded('''sum(estimated_revenue) filter (where has_availability)
       / nullif(count(estimated_revenue) filter (where has_availability), 0)''', 2)}
      as avg_revenue_per_active_listing
  from placed group by 1, 2, 3, 4"""
_PLACED = """
  select p.listing_neighbourhood, p.property_type, p.room_type, p.accommodates,
    f.has_availability, f.number_of_stays, f.price, f.estimated_revenue
  from fact f join dim_property p on f.listing_id = p.listing_id
    and f.month_date >= p.valid_from and f.month_date < p.valid_to"""
_BEST = """
  select listing_neighbourhood as nb, cast(sum(estimated_revenue)
      / nullif(count(*) filter (where has_availability), 0) as decimal(18,6)) as rate
  from placed where listing_neighbourhood is not null
  group by 1 order by rate desc nulls last, 1 limit 5"""


def _in_best(body: str) -> str:
    return with_tables(
        "fact dim_property",
        f", placed as ({_PLACED}), best as ({_BEST}), types as ({_TYPES})\n{body}",
    )


@query(
    "report_best_types",
    _in_best(
        """select nb as listing_neighbourhood, rank_by_total_stays, property_type, room_type,
          cast(accommodates as bigint) as accommodates, total_stays, active_listing_months,
          avg_stays_per_month, avg_price, avg_revenue_per_active_listing
        from (select types.*, rank() over (partition by nb order by total_stays desc nulls last)
                as rank_by_total_stays from types join best using (nb))
        where rank_by_total_stays <= 3"""
    ),
)
def best_types(spark, sf_dir):
    s = t.star(spark, sf_dir)
    return plain(reports.best_types(s.fact, s.dim_property))


@query(
    "report_best_types_by_occupancy",
    _in_best(
        f"""select nb as listing_neighbourhood, rank_by_occupancy, rank_by_total_stays,
          property_type, room_type, cast(accommodates as bigint) as accommodates,
          avg_stays_per_month, {rounded("spread", 1)} as spread_in_the_area,
          active_listing_months, avg_price, avg_revenue_per_active_listing
        from (select types.*,
                rank() over (partition by nb order by avg_stays_per_month desc nulls last)
                  as rank_by_occupancy,
                rank() over (partition by nb order by total_stays desc nulls last)
                  as rank_by_total_stays,
                max(avg_stays_per_month) over (partition by nb)
                  - min(avg_stays_per_month) over (partition by nb) as spread
              from types join best using (nb) where active_listing_months >= 15)
        where rank_by_occupancy <= 3"""
    ),
)
def best_types_by_occupancy(spark, sf_dir):
    s = t.star(spark, sf_dir)
    return plain(reports.best_types_by_occupancy(s.fact, s.dim_property, min_volume=15))


@query(
    "report_portfolio_scope",
    with_tables(
        "portfolios",
        f"""select host_type, nb_hosts, {rounded("100.0 * nb_hosts / sum(nb_hosts) over ()", 1)}
            as pct_of_hosts, nb_listings,
          {rounded("100.0 * nb_listings / sum(nb_listings) over ()", 1)} as pct_of_listings,
          hosts_with_2_at_once
        from (select case when nb_listings = 1 then 'single listing' else 'multiple listings' end
                as host_type, count(*) as nb_hosts, cast(sum(nb_listings) as bigint) as nb_listings,
                count(*) filter (where at_once > 1) as hosts_with_2_at_once
              from portfolios group by 1)""",
    ),
)
def portfolio_scope(spark, sf_dir):
    return plain(reports.portfolio_scope(t.star(spark, sf_dir).fact))


@query(
    "report_portfolio_concentration",
    with_tables(
        "portfolios",
        f"""select coalesce(size, 'ALL multi-listing hosts') as portfolio_size,
          count(*) as nb_hosts, cast(sum(nb_listings) as bigint) as nb_listings,
          count(*) filter (where nb_lga = 1) as hosts_in_one_lga,
          {rounded("100.0 * count(*) filter (where nb_lga = 1) / count(*)", 1)} as pct_in_one_lga,
          {rounded("sum(nb_lga) / count(*)", 2)} as avg_nb_lga, max(nb_lga) as max_nb_lga,
          count(*) filter (where lgas_at_once = 1) as hosts_in_one_lga_same_month
        from (select *, case when nb_listings = 2 then '2 listings'
                when nb_listings <= 5 then '3 to 5 listings'
                when nb_listings <= 10 then '6 to 10 listings'
                else '11 listings or more' end as size
              from portfolios where nb_listings >= 2)
        group by grouping sets ((size), ())""",
    ),
)
def portfolio_concentration(spark, sf_dir):
    return plain(reports.portfolio_concentration(t.star(spark, sf_dir).fact))


@query(
    "report_mortgage_coverage",
    with_tables(
        "fact dim_lga g02",
        f"""select coalesce(lga_name, 'ALL LGAs') as lga_name, count(*) as nb_single_hosts,
          cast(case when lga_name is not null then max(due) end as bigint) as annual_mortgage,
          {rounded('''percentile_cont(0.5) within group (order by cast(revenue as double))''', 2)}
            as median_revenue_12m,
          count(*) filter (where revenue >= due) as hosts_covering,
          {rounded("100.0 * count(*) filter (where revenue >= due) / count(*)", 1)} as pct_covering,
          count(*) filter (where present = 1) as hosts_all_year,
          {rounded('''100.0 * count(*) filter (where present = 1 and revenue >= due)
             / nullif(count(*) filter (where present = 1), 0)''', 1)} as pct_covering_all_year
        from (select l.lga_name, h.revenue, h.present,
                g2.median_mortgage_repay_monthly * 12 as due
              from (select host_id, count(distinct month_date) as present, min(lga_code) as lga_code,
                      sum(estimated_revenue) as revenue
                    from fact where lga_code is not null group by host_id
                    having count(distinct listing_id) = 1) h
              join dim_lga l on h.lga_code = l.lga_code and l.is_current
              join g02 g2 on h.lga_code = g2.lga_code)
        group by grouping sets ((lga_name), ())""",
    ),
)
def mortgage_coverage(spark, sf_dir):
    s = t.star(spark, sf_dir)
    return plain(reports.mortgage_coverage(s.fact, s.dim_lga, s.g02, periods=1))


# every host a customer with orders in up to twelve calendar months; one in seven has a listing
# per order, the others one listing
_CUSTOMER_FACT = """ cust as (
    select o_custkey as host_id,
      case when o_custkey % 7 = 0 then o_orderkey else o_custkey end as listing_id,
      month(o_orderdate) as present_in, c_nationkey as lga_code,
      cast(o_totalprice as decimal(13,2)) as revenue
    from orders join customer on o_custkey = c_custkey)"""


@query(
    "report_mortgage_coverage_twelve_months",
    with_tables(
        "dim_lga g02",
        f""", {_CUSTOMER_FACT}, hosts as (
          select l.lga_name, h.revenue, h.present, g2.median_mortgage_repay_monthly * 36 as due
          from (select host_id, count(distinct present_in) as present, min(lga_code) as lga_code,
                  sum(revenue) as revenue
                from cust group by host_id having count(distinct listing_id) = 1) h
          join dim_lga l on h.lga_code = l.lga_code and l.is_current
          join g02 g2 on h.lga_code = g2.lga_code)
        select coalesce(lga_name, 'ALL LGAs') as lga_name, count(*) as nb_single_hosts,
          cast(case when lga_name is not null then max(due) end as bigint) as annual_mortgage,
          {rounded("percentile_cont(0.5) within group (order by cast(revenue as double))", 2)}
            as median_revenue_12m,
          count(*) filter (where revenue >= due) as hosts_covering,
          {rounded("100.0 * count(*) filter (where revenue >= due) / count(*)", 1)} as pct_covering,
          count(*) filter (where present = 12) as hosts_all_year,
          {rounded('''100.0 * count(*) filter (where present = 12 and revenue >= due)
             / nullif(count(*) filter (where present = 12), 0)''', 1)} as pct_covering_all_year
        from hosts group by grouping sets ((lga_name), ())""",
    ),
)
def mortgage_coverage_twelve_months(spark, sf_dir):
    """Customers as hosts, so that some are present in all twelve months and some are not."""
    orders = t.table(spark, sf_dir, "orders")
    customer = t.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    listing = F.when(F.col("o_custkey") % 7 == 0, F.col("o_orderkey")).otherwise(F.col("o_custkey"))
    fact = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_custkey").alias("host_id"),
        listing.alias("listing_id"),
        F.make_date(F.lit(2020), F.month("o_orderdate"), F.lit(1)).alias("month_date"),
        F.col("c_nationkey").cast("int").alias("lga_code"),
        F.col("o_totalprice").cast("decimal(13,2)").alias("estimated_revenue"),
    )
    s = t.star(spark, sf_dir)
    # figures of three years, which is about what the orders of a customer add up to
    repay = (F.col("median_mortgage_repay_monthly") * 3).alias("median_mortgage_repay_monthly")
    g02 = s.g02.select("lga_code", repay)
    return plain(reports.mortgage_coverage(fact, s.dim_lga, g02, periods=12))


@query(
    "report_series",
    with_tables(
        "area_kpis",
        """select listing_neighbourhood, month_year, active_listings_rate, median_price,
          superhost_rate, active_listings_pct_change, inactive_listings_pct_change, total_stays,
          avg_estimated_revenue_per_active_listing
        from area_kpis where listing_neighbourhood = 'nation_7'""",
    ),
)
def series(spark, sf_dir):
    s = t.star(spark, sf_dir)
    kpi = marts.dm_listing_neighbourhood(s.fact, s.dim_property, s.dim_host, s.host_slices)
    return plain(reports.series(kpi, "nation_7"))


@query(
    "spearman_rows",
    """select cast(round(cast(corr(rx, ry) as decimal(30,6)), 6) as double) as spearman_corr
    from (select rank() over (order by cast(l_extendedprice as decimal(12,2))) as rx,
            rank() over (order by cast(l_quantity as int)) as ry from lineitem)""",
)
def spearman_rows(spark, sf_dir):
    """Rank correlation over all rows, with heavily tied values on one side."""
    line = t.table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").cast("decimal(12,2)").alias("x"),
        F.col("l_quantity").cast("int").alias("y"),
    )
    from tidemark.operators.joins import heavy_keys

    corr = reports.spearman(line, "x", "y", hot_y=tuple(heavy_keys(line, "y")))
    return corr.select(
        F.round(F.col("spearman_corr").cast("decimal(30,6)"), 6).cast("double").alias(
            "spearman_corr"
        )
    )
