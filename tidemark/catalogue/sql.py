"""Shared SQL for the checks: the same tables as ``catalogue.tables``, in plain SQL."""

from __future__ import annotations

from tidemark.catalogue.tables import AGE_COLUMNS, LOADS, MEDIAN_DIVISORS


def rounded(expression: str, digits: int) -> str:
    return f"cast(round(cast({expression} as decimal(30,6)), {digits}) as double)"


def half_up(numerator: str, denominator: str, digits: int) -> str:
    """A quotient of two whole numbers from 0 on, rounded half up by whole-number arithmetic."""
    whole = f"cast({2 * 10**digits} as hugeint) * {numerator} + {denominator}"
    return f"cast(({whole}) // (2 * {denominator}) as double) / {10**digits}"


def dbl(expression: str) -> str:
    return f"cast({expression} as double)"


_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, needs: str, body: str) -> None:
    _CTES[name] = (tuple(needs.split()), body)


def with_tables(needs: str, body: str) -> str:
    """``body`` preceded by the named CTEs and everything they need."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for other in _CTES[name][0]:
            visit(other)
        order.append(name)

    for name in needs.split():
        visit(name)
    parts = [f"{name} as ({_CTES[name][1]})" for name in order]
    return "with " + ",\n".join(parts) + "\n" + body


_cte(
    "listing_rows",
    "",
    """
    select l_partkey as listing_id, cast(l_suppkey as varchar) as scrape_id,
      cast(l_shipdate as date) as scraped_date, l_orderkey as host_id,
      cast(date_trunc('month', l_shipdate) as date) as month_date,
      'Host ' || l_orderkey as host_name,
      cast(l_shipdate as date) - 30 * l_linenumber as host_since,
      case when l_tax <> 0 then l_returnflag = 'A' end as host_is_superhost,
      case when l_discount > 0.085 then null when l_discount < 0.005 then 'Overseas'
           else s_name end as host_neighbourhood,
      case when l_tax > 0.075 and l_linenumber = 7 then 'nowhere'
           else lower(n_name) end as listing_neighbourhood,
      l_returnflag as property_type, l_linestatus as room_type, l_linenumber as accommodates,
      cast(l_extendedprice as decimal(10,2)) as price,
      case when not (l_tax between 0.005 and 0.015) then l_discount > 0.025 end
        as has_availability,
      case when l_quantity < 50 then least(30, cast(l_quantity as int)) end as availability_30,
      cast(l_quantity as int) as number_of_reviews,
      case when l_quantity <= 45 then cast(100 - l_quantity as decimal(5,2)) end
        as review_scores_rating,
      cast(l_linenumber as decimal(5,2)) as review_scores_accuracy,
      cast(l_linenumber + 1 as decimal(5,2)) as review_scores_cleanliness,
      cast(l_linenumber + 2 as decimal(5,2)) as review_scores_checkin,
      cast(l_linenumber + 3 as decimal(5,2)) as review_scores_communication,
      cast(l_linenumber + 4 as decimal(5,2)) as review_scores_value,
      strftime(l_shipdate, '%m_%Y') || '.csv' as source_file,
      cast(date_trunc('month', l_shipdate) as date) + interval 1 month as loaded_at
    from lineitem join supplier on l_suppkey = s_suppkey
    join nation on s_nationkey = n_nationkey""",
)
_cte(
    "silver",
    "listing_rows",
    """
    select * exclude (rn) from (
      select *, row_number() over (partition by listing_id, month_date
        order by scraped_date desc nulls first, loaded_at desc nulls first,
          host_id desc nulls last, accommodates desc nulls last, scrape_id desc nulls last) as rn
      from listing_rows) where rn = 1""",
)
_cte(
    "host_versions",
    "silver",
    """
    select host_id, host_name, host_since, host_is_superhost, host_neighbourhood, month_date,
      md5(host_id || '|' || month_date) as version_id,
      lead(month_date) over (partition by host_id order by month_date) as next_month,
      row_number() over (partition by host_id order by month_date) as n
    from (select *, row_number() over (partition by host_id, month_date
            order by scraped_date desc nulls first, listing_id desc nulls first) as pick
          from silver) where pick = 1""",
)
_cte(
    "dim_host",
    "host_versions",
    """
    select version_id as host_version_id, host_id, host_name, host_since, host_is_superhost,
      host_neighbourhood,
      case when n = 1 then date '1900-01-01' else month_date end as valid_from,
      coalesce(next_month, date '9999-12-31') as valid_to, next_month is null as is_current
    from host_versions""",
)
_cte(
    "property_versions",
    "silver",
    """
    select listing_id, listing_neighbourhood, property_type, room_type, accommodates, month_date,
      md5(listing_id || '|' || month_date) as version_id,
      lead(month_date) over (partition by listing_id order by month_date) as next_month,
      row_number() over (partition by listing_id order by month_date) as n
    from silver""",
)
_cte(
    "dim_property",
    "property_versions",
    """
    select version_id as property_version_id, listing_id, listing_neighbourhood, property_type,
      room_type, accommodates,
      case when n = 1 then date '1900-01-01' else month_date end as valid_from,
      coalesce(next_month, date '9999-12-31') as valid_to, next_month is null as is_current
    from property_versions""",
)
_cte(
    "lga_loads",
    "",
    f"""
    select cast(n_nationkey as int) as lga_code,
      case when n_regionkey = 0 then 'Old ' || n_name else n_name end as lga_name,
      upper(case when n_regionkey = 0 then 'Old ' || n_name else n_name end) as lga_name_key,
      date '{LOADS[0]}' as loaded_on from nation
    union all
    select cast(n_nationkey as int), n_name, upper(n_name), date '{LOADS[1]}' from nation""",
)
_cte(
    "dim_lga",
    "lga_loads",
    """
    select md5(lga_code || '|' || loaded_on || ' 00:00:00') as lga_version_id,
      lga_code, lga_name, lga_name_key,
      case when row_number() over w = 1 then date '1900-01-01'
           else cast(date_trunc('month', loaded_on) as date) end as valid_from,
      coalesce(cast(date_trunc('month', lead(loaded_on) over w) as date), date '9999-12-31')
        as valid_to,
      lead(loaded_on) over w is null as is_current
    from lga_loads window w as (partition by lga_code order by loaded_on)""",
)
_cte(
    "suburb_pairs",
    "",
    f"""
    select s_name, a.n_name as area, date '{LOADS[0]}' as loaded_on
    from supplier join nation a on s_nationkey = a.n_nationkey
    union all
    select s_name, h.n_name, date '{LOADS[0]}'
    from supplier join nation a on s_nationkey = a.n_nationkey
    join nation h on a.n_regionkey = h.n_nationkey
    union all
    select s_name, a.n_name, date '{LOADS[1]}'
    from supplier join nation a on s_nationkey = a.n_nationkey""",
)
_cte(
    "suburb_loads",
    "suburb_pairs lga_loads",
    """
    select upper(s_name) as suburb_name_key,
      upper(substr(s_name, 1, 1)) || lower(substr(s_name, 2)) as suburb_name,
      lga_code, lga_name, p.loaded_on
    from (select s_name, loaded_on, min(upper(area)) as area_key from suburb_pairs
          group by s_name, loaded_on) p
    left join lga_loads l on p.area_key = l.lga_name_key and p.loaded_on = l.loaded_on""",
)
_cte(
    "dim_suburb",
    "suburb_loads",
    """
    select md5(suburb_name_key || '|' || loaded_on || ' 00:00:00') as suburb_version_id,
      suburb_name_key, suburb_name, lga_code, lga_name,
      case when row_number() over w = 1 then date '1900-01-01'
           else cast(date_trunc('month', loaded_on) as date) end as valid_from,
      coalesce(cast(date_trunc('month', lead(loaded_on) over w) as date), date '9999-12-31')
        as valid_to,
      lead(loaded_on) over w is null as is_current
    from suburb_loads window w as (partition by suburb_name_key order by loaded_on)""",
)
_cte(
    "fact",
    "silver dim_lga",
    """
    select s.listing_id, s.host_id, g.lga_code, s.scraped_date, s.month_date, s.price,
      s.has_availability, s.availability_30, s.number_of_reviews, s.review_scores_rating,
      s.review_scores_accuracy, s.review_scores_cleanliness, s.review_scores_checkin,
      s.review_scores_communication, s.review_scores_value,
      case when s.has_availability then 30 - s.availability_30 else 0 end as number_of_stays,
      case when s.has_availability then (30 - s.availability_30) * s.price else 0 end
        as estimated_revenue
    from silver s left join dim_lga g on upper(s.listing_neighbourhood) = g.lga_name_key
      and s.month_date >= g.valid_from and s.month_date < g.valid_to""",
)
_bands = ",\n".join(
    f"count(*) filter (where least(greatest(cast(floor(c_acctbal / 1000) as int) + 1, 0), 10)"
    f" = {i}) as {name}"
    for i, name in enumerate(AGE_COLUMNS)
)
_cte(
    "g01",
    "",
    f"select cast(c_nationkey as int) as lga_code, count(*) as tot_p_p,\n{_bands}\n"
    "from customer group by c_nationkey",
)
_figures = ",\n".join(
    f"cast(round(cast(a / {divisor} as decimal(30,6)), 2) as decimal(4,2)) as {name}"
    if name.startswith("average_")
    else f"cast(round(cast(a / {divisor} as decimal(30,6)), 0) as int) as {name}"
    for name, divisor in MEDIAN_DIVISORS.items()
)
_cte(
    "g02",
    "",
    f"select lga_code, {_figures} from (select cast(c_nationkey as int) as lga_code, "
    "cast(sum(cast(c_acctbal as decimal(12,2))) / count(*) as decimal(30,6)) as a "
    "from customer group by c_nationkey)",
)
_cte(
    "visits",
    "fact dim_property dim_host",
    """
    select p.listing_neighbourhood, p.property_type, p.room_type, p.accommodates, f.month_date,
      f.host_id, f.has_availability as act, f.price, f.review_scores_rating as rating,
      f.number_of_stays as stays, f.estimated_revenue as rev, h.host_is_superhost as sup
    from fact f
    join dim_property p on f.listing_id = p.listing_id
      and f.month_date >= p.valid_from and f.month_date < p.valid_to
    join dim_host h on f.host_id = h.host_id
      and f.month_date >= h.valid_from and f.month_date < h.valid_to""",
)


def kpis(keys: str) -> str:
    """The monthly KPI mart for a comma-separated list of group columns (needs ``visits``)."""
    change = "case when pm = cast(month_date - interval 1 month as date) then {} end"
    return f"""
    select {keys}, month_date as month_year,
      {rounded("100.0 * active / n", 2)} as active_listings_rate,
      {dbl("low")} as min_price, {dbl("high")} as max_price,
      {rounded("med", 2)} as median_price, {rounded("ps / nullif(pn, 0)", 2)} as avg_price,
      hosts as distinct_hosts, {rounded("100.0 * sups / nullif(hosts, 0)", 2)} as superhost_rate,
      {rounded("rs / nullif(rn, 0)", 2)} as avg_review_scores_rating,
      {change.format(rounded("100.0 * (active - pa) / nullif(pa, 0)", 2))}
        as active_listings_pct_change,
      {change.format(rounded("100.0 * (inactive - pi) / nullif(pi, 0)", 2))}
        as inactive_listings_pct_change,
      cast(stays as bigint) as total_stays,
      {rounded("vs / nullif(vn, 0)", 2)} as avg_estimated_revenue_per_active_listing
    from (
      select *, lag(month_date) over w as pm, lag(active) over w as pa, lag(inactive) over w as pi
      from (
        select {keys}, month_date, count(*) as n, count(*) filter (where act) as active,
          count(*) filter (where not act) as inactive, min(price) filter (where act) as low,
          max(price) filter (where act) as high,
          percentile_cont(0.5) within group (order by cast(price as double))
            filter (where act) as med,
          sum(price) filter (where act) as ps, count(price) filter (where act) as pn,
          count(distinct host_id) as hosts, count(distinct host_id) filter (where sup) as sups,
          sum(rating) filter (where act) as rs, count(rating) filter (where act) as rn,
          sum(stays) filter (where act) as stays, sum(rev) filter (where act) as vs,
          count(rev) filter (where act) as vn
        from visits group by {keys}, month_date)
      window w as (partition by {keys} order by month_date))"""


_cte("area_kpis", "visits", kpis("listing_neighbourhood"))
_cte(
    "host_area_kpis",
    "fact dim_host dim_suburb",
    f"""
    select area as host_neighbourhood_lga, month_date as month_year,
      count(distinct host_id) as distinct_hosts,
      {rounded("sum(rev) filter (where act) / nullif(count(rev) filter (where act), 0)", 2)}
        as avg_estimated_revenue_per_active_listing,
      {rounded("sum(rev) filter (where act) / count(distinct host_id)", 2)}
        as estimated_revenue_per_host
    from (select coalesce(s.lga_name, 'Unknown') as area, f.month_date, f.host_id,
            f.has_availability as act, f.estimated_revenue as rev
          from fact f join dim_host h on f.host_id = h.host_id
            and f.month_date >= h.valid_from and f.month_date < h.valid_to
          left join dim_suburb s on upper(h.host_neighbourhood) = s.suburb_name_key
            and f.month_date >= s.valid_from and f.month_date < s.valid_to)
    group by area, month_date""",
)
_cte(
    "lga_revenue",
    "fact",
    """
    select lga_code, sum(estimated_revenue) as total_revenue,
      count(*) filter (where has_availability) as months,
      cast(sum(estimated_revenue) / nullif(count(*) filter (where has_availability), 0)
        as decimal(18,6)) as rate
    from fact where lga_code is not null group by lga_code""",
)
_cte(
    "lga_rates",
    "lga_revenue dim_lga",
    "select r.*, l.lga_name from lga_revenue r join dim_lga l "
    "on r.lga_code = l.lga_code and l.is_current",
)
_cte(
    "portfolios",
    "fact",
    """
    select o.host_id, nb_listings, nb_lga, at_once, lgas_at_once from
      (select host_id, count(distinct listing_id) as nb_listings,
         count(distinct lga_code) as nb_lga from fact where lga_code is not null
       group by host_id) o
    join (select host_id, max(l) as at_once, max(g) as lgas_at_once from
           (select host_id, month_date, count(distinct listing_id) as l,
              count(distinct lga_code) as g from fact where lga_code is not null
            group by host_id, month_date) group by host_id) m on o.host_id = m.host_id""",
)
