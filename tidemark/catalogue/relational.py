"""Single operators over the given tables: filters, joins, aggregates, windows, top-k."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tidemark.catalogue import query
from tidemark.catalogue import tables as t
from tidemark.catalogue.sql import dbl, rounded, with_tables
from tidemark.catalogue.tables import plain
from tidemark.functions.dates import month_floor
from tidemark.functions.numbers import (
    half_up,
    half_up_double,
    mean,
    only,
    pearson,
    percent,
    ratio_of_sums,
    small_median,
    total,
    weighted_mean,
)
from tidemark.functions.text import string_list
from tidemark.operators import aggregates as agg
from tidemark.operators import joins, topk, windows
from tidemark.operators.history import collapse_unchanged, to_dimension
from tidemark.operators.pointintime import date_slices, pit_join
from tidemark.plans import star


def _orders(spark, sf_dir):
    """Orders with an exact price and their month."""
    return t.table(spark, sf_dir, "orders").withColumns(
        {"price": F.col("o_totalprice").cast("decimal(12,2)"), "month": month_floor("o_orderdate")}
    )


def _lines(spark, sf_dir):
    return t.table(spark, sf_dir, "lineitem").withColumns(
        {
            "price": F.col("l_extendedprice").cast("decimal(12,2)"),
            "qty": F.col("l_quantity").cast("int"),
        }
    )


PRICE = "cast(o_totalprice as decimal(12,2))"
LINE_PRICE = "cast(l_extendedprice as decimal(12,2))"
MONTH = "cast(date_trunc('month', o_orderdate) as date)"

# --- projections and filters -------------------------------------------------


@query(
    "project_columns",
    f"""select o_orderkey as order_id, o_custkey, 'order' as kind, 1 as sort_key,
      cast(null as bigint) as nothing, {dbl(f"{PRICE} * 12")} as yearly,
      o_orderstatus = 'F' as is_final, o_orderpriority is null as no_priority
    from orders""",
)
def project_columns(spark, sf_dir):
    """Renamed, literal, computed and boolean columns."""
    return plain(
        _orders(spark, sf_dir).select(
            F.col("o_orderkey").alias("order_id"),
            "o_custkey",
            F.lit("order").alias("kind"),
            F.lit(1).alias("sort_key"),
            F.lit(None).cast("bigint").alias("nothing"),
            (F.col("price") * 12).alias("yearly"),
            (F.col("o_orderstatus") == "F").alias("is_final"),
            F.col("o_orderpriority").isNull().alias("no_priority"),
        )
    )


@query(
    "project_cast_all_except",
    "select c_name, c_mktsegment, cast(c_custkey as bigint) as c_custkey, "
    "cast(c_nationkey as bigint) as c_nationkey, "
    "cast(round(cast(c_acctbal as decimal(12,2)), 0) as bigint) as c_acctbal from customer",
)
def project_cast_all_except(spark, sf_dir):
    from tidemark.plans.silver import cast_all_except

    customer = t.table(spark, sf_dir, "customer")
    texts = customer.select([F.col(c).cast("string").alias(c) for c in customer.columns])
    keep = ("c_name", "c_mktsegment")
    return plain(texts.select(*keep, *cast_all_except(texts, keep)))


@query(
    "filter_nulls",
    with_tables(
        "silver",
        "select listing_id, month_date, has_availability from silver "
        "where host_neighbourhood is null and availability_30 is not null",
    ),
)
def filter_nulls(spark, sf_dir):
    rows = t.star(spark, sf_dir).once("listings").listings
    kept = rows.filter("host_neighbourhood IS NULL AND availability_30 IS NOT NULL")
    return kept.select("listing_id", "month_date", "has_availability")


@query(
    "filter_comparisons",
    """select o_orderkey from orders where (o_totalprice between 100000 and 200000
      or o_orderpriority in ('1-URGENT', '2-HIGH')) and o_orderstatus <> 'P'""",
)
def filter_comparisons(spark, sf_dir):
    orders = t.table(spark, sf_dir, "orders")
    priced = F.col("o_totalprice").between(100000, 200000)
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return orders.filter((priced | urgent) & (F.col("o_orderstatus") != "P")).select("o_orderkey")


@query(
    "filter_flags",
    with_tables(
        "silver",
        """select listing_id, month_date, 'active' as kind from silver where has_availability
        union all select listing_id, month_date, 'inactive' from silver
          where not has_availability""",
    ),
)
def filter_flags(spark, sf_dir):
    """A flag and its negation; rows with an unknown flag are in neither."""
    rows = t.star(spark, sf_dir).listings.select("listing_id", "month_date", "has_availability")
    on = rows.filter("has_availability").withColumn("kind", F.lit("active"))
    off = rows.filter("NOT has_availability").withColumn("kind", F.lit("inactive"))
    return on.unionByName(off).drop("has_availability")


@query(
    "filter_rank",
    f"""select o_orderkey, rank from (select o_orderkey,
        rank() over (partition by o_custkey order by {PRICE} desc) as rank from orders)
    where rank <= 2""",
)
def filter_rank(spark, sf_dir):
    best = Window.partitionBy("o_custkey").orderBy(F.col("price").desc())
    ranked = _orders(spark, sf_dir).withColumn("rank", F.rank().over(best))
    return plain(windows.keep_rank(ranked, "rank", 2).select("o_orderkey", "rank"))


@query(
    "filter_having",
    """select o_custkey, count(*) as n, count(distinct o_orderpriority) as kinds,
      count(*) filter (where o_orderstatus = 'F') as finals
    from orders group by 1
    having count(*) > 1 and count(distinct o_orderpriority) > 1
      and count(*) filter (where o_orderstatus = 'F') >= 5""",
)
def filter_having(spark, sf_dir):
    return agg.having(
        _orders(spark, sf_dir),
        ["o_custkey"],
        [
            F.count("*").alias("n"),
            F.count_distinct("o_orderpriority").alias("kinds"),
            F.count_if(F.col("o_orderstatus") == "F").alias("finals"),
        ],
        "n > 1 AND kinds > 1 AND finals >= 5",
    )


@query(
    "filter_not_in",
    "select c_custkey from customer where c_custkey not in (select user_id from events)",
)
def filter_not_in(spark, sf_dir):
    customer, events = (t.table(spark, sf_dir, n) for n in ("customer", "events"))
    return joins.not_in(customer.select("c_custkey"), "c_custkey", events, "user_id")


@query(
    "filter_not_in_with_null",
    "select c_custkey from customer where c_custkey not in "
    "(select case when event_type <> 'error' then user_id end from events)",
)
def filter_not_in_with_null(spark, sf_dir):
    """One NULL in the list rejects every row."""
    customer, events = (t.table(spark, sf_dir, n) for n in ("customer", "events"))
    listed = events.select(F.when(F.col("event_type") != "error", F.col("user_id")).alias("u"))
    return joins.not_in(customer.select("c_custkey"), "c_custkey", listed, "u")


@query(
    "filter_first_qualifying",
    f"""select o_orderkey, {dbl(PRICE)} as price from orders where o_custkey =
      (select o_custkey from orders group by 1 having count(distinct o_orderstatus) > 2
       order by 1 limit 1)""",
)
def filter_first_qualifying(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    varied = agg.having(
        orders, ["o_custkey"], [F.count_distinct("o_orderstatus").alias("k")], "k > 2"
    )
    first = joins.pick_first(varied.select("o_custkey"), [F.col("o_custkey").asc_nulls_last()])
    chosen = joins.restrict_to(orders, first, "o_custkey")
    return plain(chosen.select("o_orderkey", "price"))


@query(
    "scalar_subqueries",
    f"""select (select count(*) from orders) as orders, (select count(*) from lineitem) as lines,
      {dbl(f"(select max({PRICE}) from orders)")} as top_price""",
)
def scalar_subqueries(spark, sf_dir):
    orders, lines = _orders(spark, sf_dir), _lines(spark, sf_dir)
    return plain(
        joins.side_by_side(
            orders.agg(F.count("*").alias("orders")),
            lines.agg(F.count("*").alias("lines")),
            orders.agg(F.max("price").alias("top_price")),
        )
    )


# --- joins -------------------------------------------------------------------


@query(
    "join_inner",
    "select o_orderkey, c_mktsegment from orders join customer on o_custkey = c_custkey",
)
def join_inner(spark, sf_dir):
    orders, customer = (t.table(spark, sf_dir, n) for n in ("orders", "customer"))
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("o_orderkey", "c_mktsegment")


@query(
    "join_left",
    """select c_custkey, n_name, count(event_id) as events from customer
    left join events on user_id = c_custkey left join nation on c_nationkey = n_nationkey
      and n_regionkey <> 2 group by 1, 2""",
)
def join_left(spark, sf_dir):
    customer, events = (t.table(spark, sf_dir, n) for n in ("customer", "events"))
    nation = t.table(spark, sf_dir, "nation").filter("n_regionkey <> 2")
    # events are counted per user before the join, so no customer's rows are repeated
    counts = events.groupBy("user_id").agg(F.count("event_id").alias("events"))
    named = joins.salted_join(customer, counts, "c_custkey", "user_id", "left")
    named = named.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return named.select(
        "c_custkey", "n_name", F.coalesce("events", F.lit(0).cast("bigint")).alias("events")
    )


@query(
    "join_on_name",
    with_tables(
        "silver lga_loads",
        """select listing_id, month_date, lga_code from (select s.listing_id, s.month_date,
            cast(l.lga_code as bigint) as lga_code from silver s
          left join lga_loads l on upper(trim(listing_neighbourhood)) = lga_name_key
            and loaded_on = date '1998-06-10')""",
    ),
)
def join_on_name(spark, sf_dir):
    rows = t.star(spark, sf_dir).listings
    areas = t.lga_load(spark, sf_dir, 1).select("lga_code", "lga_name_key")
    joined = joins.name_join(rows, areas, "listing_neighbourhood", "lga_name_key", "left")
    return plain(joined.select("listing_id", "month_date", "lga_code"))


@query(
    "join_point_in_time_inner",
    with_tables(
        "fact dim_property",
        """select f.listing_id, f.month_date, p.listing_neighbourhood, p.property_type
        from fact f join dim_property p on f.listing_id = p.listing_id
          and f.month_date >= p.valid_from and f.month_date < p.valid_to""",
    ),
)
def join_point_in_time_inner(spark, sf_dir):
    s = t.star(spark, sf_dir)
    fact = s.fact.select("listing_id", "month_date")
    homes = s.dim_property.select(
        "listing_id", "listing_neighbourhood", "property_type", "valid_from", "valid_to"
    )
    return pit_join(fact, homes, "listing_id")


@query(
    "join_point_in_time_left",
    with_tables(
        "fact dim_host",
        """select f.listing_id, f.month_date, h.host_name, h.host_is_superhost
        from fact f left join (select * from dim_host where host_is_superhost) h
          on f.host_id = h.host_id and f.month_date >= h.valid_from and f.month_date < h.valid_to""",
    ),
)
def join_point_in_time_left(spark, sf_dir):
    """Superhost versions only: fact rows in other months stay, without a match."""
    s = t.star(spark, sf_dir)
    fact = s.fact.select("listing_id", "month_date", "host_id")
    hosts = s.dim_host.filter("host_is_superhost").select(
        "host_id", "host_name", "host_is_superhost", "valid_from", "valid_to"
    )
    joined = pit_join(fact, hosts, "host_id", how="left", hot=s.host_slices)
    return joined.drop("host_id")


@query(
    "join_point_in_time_other_table",
    with_tables(
        "dim_property",
        f"""select o_orderkey, p.property_type, p.listing_neighbourhood
        from orders join dim_property p on o_custkey = p.listing_id
          and {MONTH} >= p.valid_from and {MONTH} < p.valid_to""",
    ),
)
def join_point_in_time_other_table(spark, sf_dir):
    """Dates that are not version starts: orders against the history of equal part numbers."""
    homes = t.star(spark, sf_dir).dim_property.select(
        "listing_id", "property_type", "listing_neighbourhood", "valid_from", "valid_to"
    )
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "month")
    hot = date_slices(orders, "o_custkey", "month")
    joined = pit_join(orders, homes, ("o_custkey", "listing_id"), at="month", hot=hot)
    return joined.drop("o_custkey", "month")


@query(
    "join_point_in_time_chain",
    with_tables(
        "fact dim_host dim_suburb",
        """select f.listing_id, f.month_date, h.host_neighbourhood, s.lga_name
        from fact f join dim_host h on f.host_id = h.host_id
          and f.month_date >= h.valid_from and f.month_date < h.valid_to
        left join dim_suburb s on upper(h.host_neighbourhood) = s.suburb_name_key
          and f.month_date >= s.valid_from and f.month_date < s.valid_to""",
    ),
)
def join_point_in_time_chain(spark, sf_dir):
    s = t.star(spark, sf_dir)
    hosts = s.dim_host.select("host_id", "host_neighbourhood", "valid_from", "valid_to")
    suburbs = s.dim_suburb.select("suburb_name_key", "lga_name", "valid_from", "valid_to")
    fact = s.fact.select("listing_id", "month_date", "host_id")
    lived = pit_join(fact, hosts, "host_id", hot=s.host_slices)
    key = (F.upper("host_neighbourhood"), "suburb_name_key")
    return pit_join(lived, suburbs, key, how="left", hot=s.hot_suburbs).drop("host_id")


@query(
    "join_point_in_time_hot_names",
    with_tables(
        "silver dim_lga",
        """select l.listing_id, l.month_date, l.listing_neighbourhood, g.lga_name
        from silver l left join dim_lga g on upper(l.listing_neighbourhood) = g.lga_name_key
          and l.month_date >= g.valid_from and l.month_date < g.valid_to""",
    ),
)
def join_point_in_time_hot_names(spark, sf_dir):
    """A join on a few names, each with a large share of the rows, which are found and spread."""
    s = t.star(spark, sf_dir)
    listings = s.listings.select("listing_id", "month_date", "listing_neighbourhood")
    areas = s.dim_lga.select("lga_name_key", "lga_name", "valid_from", "valid_to")
    name = F.upper("listing_neighbourhood")
    hot = joins.heavy_keys(listings, name, share=1 / 64)
    return pit_join(
        listings, areas, (name, "lga_name_key"), how="left", hot=hot, overlapping=True
    )


@query(
    "join_current",
    with_tables(
        "fact dim_lga",
        """select f.listing_id, f.month_date, l.lga_name from fact f
        join dim_lga l on f.lga_code = l.lga_code and l.is_current""",
    ),
)
def join_current(spark, sf_dir):
    s = t.star(spark, sf_dir)
    fact = s.fact.select("listing_id", "month_date", "lga_code")
    names = s.dim_lga.select("lga_code", "lga_name", "is_current")
    return joins.current_join(fact, names, "lga_code").drop("lga_code")


@query(
    "join_unmatched_both_ways",
    """select 'customer' as side, c_custkey as key from customer
      where not exists (select 1 from events where user_id = c_custkey)
    union all select 'event', user_id from events
      where not exists (select 1 from customer where user_id = c_custkey)""",
)
def join_unmatched_both_ways(spark, sf_dir):
    customer = t.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    events = t.table(spark, sf_dir, "events").select(F.col("user_id").alias("key"))
    return (
        joins.unmatched(customer, events, ("key", "key"))
        .withColumn("side", F.lit("customer"))
        .unionByName(
            joins.unmatched(events, customer, ("key", "key")).withColumn("side", F.lit("event"))
        )
    )


@query(
    "join_restrict_to_top",
    f"""with best as (select o_custkey, sum({PRICE}) as spent from orders group by 1
      order by spent desc, o_custkey limit 5)
    select o_orderkey, {dbl("spent")} as spent from orders join best using (o_custkey)""",
)
def join_restrict_to_top(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    spent = orders.groupBy("o_custkey").agg(F.sum("price").alias("spent"))
    best = topk.top_k(spent, F.col("spent").desc(), 5, [F.col("o_custkey")])
    chosen = joins.restrict_to(orders.select("o_orderkey", "o_custkey"), best, "o_custkey")
    return plain(chosen.drop("o_custkey"))


@query(
    "join_two_aggregates",
    f"""select o_custkey, n, busiest from (select o_custkey, count(*) as n from orders group by 1)
    join (select o_custkey, max(k) as busiest from (select o_custkey, {MONTH} as m, count(*) as k
          from orders group by 1, 2) group by 1) using (o_custkey)""",
)
def join_two_aggregates(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    whole = orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    monthly = orders.groupBy("o_custkey", "month").agg(F.count("*").alias("k"))
    busiest = monthly.groupBy("o_custkey").agg(F.max("k").alias("busiest"))
    return joins.join_aggregates(whole, busiest, "o_custkey")


# --- aggregates --------------------------------------------------------------


@query(
    "aggregate_by_keys",
    f"""select o_orderstatus, o_orderpriority, {MONTH} as month, count(*) as n,
      count(o_custkey) as with_customer, {dbl(f"min({PRICE})")} as low,
      {dbl(f"max({PRICE})")} as high, {dbl(f"sum({PRICE})")} as total_price,
      {rounded(f"sum({PRICE}) / count(*)", 2)} as average
    from orders group by 1, 2, 3""",
)
def aggregate_by_keys(spark, sf_dir):
    return plain(
        _orders(spark, sf_dir)
        .groupBy("o_orderstatus", "o_orderpriority", "month")
        .agg(
            F.count("*").alias("n"),
            F.count("o_custkey").alias("with_customer"),
            F.min("price").alias("low"),
            F.max("price").alias("high"),
            F.sum("price").alias("total_price"),
            half_up(mean("price"), 2).alias("average"),
        )
    )


@query(
    "aggregate_global",
    f"""select count(*) as n, {dbl(f"sum({LINE_PRICE})")} as total_price,
      count(distinct l_orderkey) as orders,
      count(distinct l_partkey) filter (where l_returnflag = 'R') as returned_parts from lineitem""",
)
def aggregate_global(spark, sf_dir):
    returned = F.col("l_returnflag") == "R"
    return plain(
        _lines(spark, sf_dir).agg(
            F.count("*").alias("n"),
            F.sum("price").alias("total_price"),
            F.count_distinct("l_orderkey").alias("orders"),
            F.count_distinct(only("l_partkey", returned)).alias("returned_parts"),
        )
    )


_F = "filter (where l_returnflag = 'A')"


@query(
    "aggregate_filtered",
    f"""select l_suppkey, count(*) {_F} as n, {dbl(f"min({LINE_PRICE}) {_F}")} as low,
      {dbl(f"max({LINE_PRICE}) {_F}")} as high, {dbl(f"sum({LINE_PRICE}) {_F}")} as total_price,
      {rounded(f"sum({LINE_PRICE}) {_F} / nullif(count(*) {_F}, 0)", 2)} as average
    from lineitem group by 1""",
)
def aggregate_filtered(spark, sf_dir):
    hit = F.col("l_returnflag") == "A"
    return plain(
        _lines(spark, sf_dir)
        .groupBy("l_suppkey")
        .agg(
            F.count_if(hit).alias("n"),
            F.min(only("price", hit)).alias("low"),
            F.max(only("price", hit)).alias("high"),
            total("price", hit).alias("total_price"),
            half_up(mean("price", hit), 2).alias("average"),
        )
    )


@query(
    "aggregate_distinct",
    """select l_suppkey, count(distinct l_partkey) as parts,
      count(distinct l_partkey) filter (where l_linestatus = 'F') as final_parts
    from lineitem group by 1""",
)
def aggregate_distinct(spark, sf_dir):
    """Plain and filtered distinct count, from one aggregation per (supplier, part)."""
    final = F.col("l_linestatus") == "F"
    return agg.two_level(
        t.table(spark, sf_dir, "lineitem"),
        ["l_suppkey", "l_partkey"],
        [F.max(final).alias("final")],
        ["l_suppkey"],
        [F.count("l_partkey").alias("parts"), F.count_if(F.col("final")).alias("final_parts")],
    )


@query(
    "aggregate_distinct_one_column",
    "select l_returnflag, count(distinct l_orderkey) as orders from lineitem group by 1",
)
def aggregate_distinct_one_column(spark, sf_dir):
    line = t.table(spark, sf_dir, "lineitem")
    return agg.distinct_count(line, ["l_returnflag"], "l_orderkey", "orders")


@query(
    "aggregate_distinct_composite",
    """select count(*) as pairs from (select distinct host_id, host_neighbourhood from (
      select l_orderkey as host_id, case when l_discount <= 0.085 then s_name end
        as host_neighbourhood from lineitem join supplier on l_suppkey = s_suppkey))""",
)
def aggregate_distinct_composite(spark, sf_dir):
    """Pairs with a NULL part count as well."""
    rows = t.table(spark, sf_dir, "lineitem").join(
        t.table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    name = F.when(F.col("l_discount") <= 0.085, F.col("s_name"))
    return rows.agg(F.count_distinct(F.struct(F.col("l_orderkey"), name)).alias("pairs"))


@query(
    "aggregate_median",
    f"""select l_returnflag, l_linenumber, {rounded(
      f"percentile_cont(0.5) within group (order by cast({LINE_PRICE} as double))", 3)} as middle
    from lineitem group by 1, 2""",
)
def aggregate_median(spark, sf_dir):
    middles = agg.exact_median(
        _lines(spark, sf_dir), ["l_returnflag", "l_linenumber"], "price", "middle"
    )
    return plain(middles)


@query(
    "aggregate_median_global",
    f"""select {rounded(f"percentile_cont(0.5) within group "
      f"(order by cast({LINE_PRICE} as double))", 3)} as middle from lineitem""",
)
def aggregate_median_global(spark, sf_dir):
    """The median of everything, without gathering everything in one task."""
    return plain(agg.exact_median(_lines(spark, sf_dir), [], "price", "middle"))


@query(
    "aggregate_median_filtered",
    f"""select l_returnflag, {rounded(
      "percentile_cont(0.5) within group (order by l_quantity)", 2)} as middle,
      {rounded("percentile_cont(0.5) within group (order by l_quantity) "
               "filter (where l_linestatus = 'F')", 2)} as final_middle
    from lineitem group by 1""",
)
def aggregate_median_filtered(spark, sf_dir):
    """Plain and filtered median of a column with few distinct values, in one aggregate."""
    final = F.col("l_linestatus") == "F"
    return (
        _lines(spark, sf_dir)
        .groupBy("l_returnflag")
        .agg(
            F.round(small_median("qty"), 2).alias("middle"),
            F.round(small_median("qty", final), 2).alias("final_middle"),
        )
    )


@query(
    "aggregate_correlation",
    f"""select l_returnflag, {rounded("corr(l_quantity, l_extendedprice)", 6)} as r,
      cast(null as double) as flat from lineitem group by 1""",
)
def aggregate_correlation(spark, sf_dir):
    """Correlation per group, and NULL against a constant."""
    return (
        _lines(spark, sf_dir)
        .groupBy("l_returnflag")
        .agg(
            half_up_double(pearson("l_quantity", "l_extendedprice"), 6).cast("double").alias("r"),
            pearson("l_quantity", F.lit(7.0)).alias("flat"),
        )
    )


@query(
    "aggregate_ratio_of_sums",
    f"""select o_orderpriority, {rounded(
      f"sum({PRICE}) / nullif(count(*) filter (where o_orderstatus = 'F'), 0)", 2)} as rate
    from orders group by 1""",
)
def aggregate_ratio_of_sums(spark, sf_dir):
    rate = ratio_of_sums("price", F.col("o_orderstatus") == "F")
    grouped = _orders(spark, sf_dir).groupBy("o_orderpriority")
    return plain(grouped.agg(half_up(rate, 2).alias("rate")))


@query(
    "aggregate_mean_of_means",
    f"""select o_orderpriority, {rounded("sum(cast(a as decimal(18,4))) / count(*)", 2)} as average
    from (select o_orderpriority, {MONTH} as m,
            cast(sum({PRICE}) / count(*) as decimal(18,4)) as a
          from orders group by 1, 2) group by 1""",
)
def aggregate_mean_of_means(spark, sf_dir):
    means = agg.mean_of_means(
        _orders(spark, sf_dir), ["o_orderpriority"], "month", mean("price"), "average"
    )
    return plain(means.withColumn("average", half_up("average", 2)))


@query(
    "aggregate_weighted_mean",
    f"""select l_returnflag, {rounded(
      f"sum({LINE_PRICE} * cast(l_quantity as int)) / sum(cast(l_quantity as int))", 2)} as average
    from lineitem group by 1""",
)
def aggregate_weighted_mean(spark, sf_dir):
    grouped = _lines(spark, sf_dir).groupBy("l_returnflag")
    return plain(grouped.agg(half_up(weighted_mean("price", "qty"), 2).alias("average")))


@query(
    "aggregate_composition",
    f"""select c_nationkey, {", ".join(
      f"{rounded(f'100.0 * {b} / (low + middle + high)', 1)} as pct_{b}"
      for b in ("low", "middle", "high"))}
    from (select cast(c_nationkey as bigint) as c_nationkey,
            count(*) filter (where c_acctbal < 2000) as low,
            count(*) filter (where c_acctbal >= 2000 and c_acctbal < 6000) as middle,
            count(*) filter (where c_acctbal >= 6000) as high from customer group by 1)""",
)
def aggregate_composition(spark, sf_dir):
    balance = F.col("c_acctbal")
    bands = (
        t.table(spark, sf_dir, "customer")
        .groupBy("c_nationkey")
        .agg(
            F.count_if(balance < 2000).alias("low"),
            F.count_if((balance >= 2000) & (balance < 6000)).alias("middle"),
            F.count_if(balance >= 6000).alias("high"),
        )
    )
    shares = agg.composition(bands, ["low", "middle", "high"])
    return plain(shares.drop("low", "middle", "high"))


@query(
    "aggregate_string_list",
    """select r_name, string_agg(n_name, ', ' order by n_name) as names,
      string_agg(n_name, ', ' order by n_nationkey desc) as by_key
    from nation join region on n_regionkey = r_regionkey group by 1""",
)
def aggregate_string_list(spark, sf_dir):
    nation, region = (t.table(spark, sf_dir, n) for n in ("nation", "region"))
    joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy("r_name").agg(
        string_list("n_name", distinct=True).alias("names"),
        string_list("n_name", order="n_nationkey DESC").alias("by_key"),
    )


@query(
    "aggregate_two_level",
    f"""select orders, count(*) as customers, {dbl("max(spent)")} as most from (
      select o_custkey, count(*) as orders, sum({PRICE}) as spent from orders group by 1)
    group by 1""",
)
def aggregate_two_level(spark, sf_dir):
    return plain(
        agg.two_level(
            _orders(spark, sf_dir),
            ["o_custkey"],
            [F.count("*").alias("orders"), F.sum("price").alias("spent")],
            ["orders"],
            [F.count("*").alias("customers"), F.max("spent").alias("most")],
        )
    )


@query(
    "aggregate_constant_of_group",
    "select l_suppkey, max(s_nationkey + 0) as nation, min(s_name) as name, count(*) as n "
    "from lineitem join supplier on l_suppkey = s_suppkey group by 1",
)
def aggregate_constant_of_group(spark, sf_dir):
    """A value that is the same in the whole group, picked by min or max."""
    line, supplier = (t.table(spark, sf_dir, n) for n in ("lineitem", "supplier"))
    joined = line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return plain(
        joined.groupBy("l_suppkey").agg(
            F.max("s_nationkey").alias("nation"),
            F.min("s_name").alias("name"),
            F.count("*").alias("n"),
        )
    )


@query("distinct_rows", f"select distinct o_custkey, {MONTH} as month from orders")
def distinct_rows(spark, sf_dir):
    return _orders(spark, sf_dir).select("o_custkey", "month").distinct()


@query(
    "aggregate_with_total",
    f"""select coalesce(o_orderpriority, 'ALL') as o_orderpriority, count(*) as n,
      {dbl(f"sum({PRICE})")} as total_price,
      {rounded("100.0 * count(*) filter (where o_orderstatus = 'F') / count(*)", 1)} as pct_final,
      cast(grouping(o_orderpriority) as bigint) as is_total
    from orders group by grouping sets ((o_orderpriority), ())""",
)
def aggregate_with_total(spark, sf_dir):
    final = F.count_if(F.col("o_orderstatus") == "F")
    return plain(
        agg.with_total(
            _orders(spark, sf_dir),
            ["o_orderpriority"],
            [
                F.count("*").alias("n"),
                F.sum("price").alias("total_price"),
                percent(final, F.count("*"), 1).alias("pct_final"),
            ],
            "ALL",
        )
    )


@query(
    "aggregate_coverage_rate",
    f"""select o_orderpriority,
      {rounded(f"100.0 * count(*) filter (where {PRICE} >= 250000) / count(*)", 1)} as pct_all,
      {rounded(f'''100.0 * count(*) filter (where {PRICE} >= 250000 and o_orderstatus = 'X')
        / nullif(count(*) filter (where o_orderstatus = 'X'), 0)''', 1)} as pct_within
    from orders group by 1""",
)
def aggregate_coverage_rate(spark, sf_dir):
    """Share that qualifies, over all rows and over a subset that may be empty."""
    covers, within = F.col("price") >= 250000, F.col("o_orderstatus") == "X"
    return plain(
        _orders(spark, sf_dir)
        .groupBy("o_orderpriority")
        .agg(
            percent(F.count_if(covers), F.count("*"), 1).alias("pct_all"),
            percent(F.count_if(covers & within), F.count_if(within), 1).alias("pct_within"),
        )
    )


# --- windows -----------------------------------------------------------------


@query(
    "window_latest_per_key",
    """select o_custkey, o_orderkey, o_orderstatus from (select *, row_number() over (
        partition by o_custkey order by o_orderdate desc nulls first, o_orderkey desc) as k
      from orders) where k = 1""",
)
def window_latest_per_key(spark, sf_dir):
    order = [F.col("o_orderdate").desc_nulls_first(), F.col("o_orderkey").desc()]
    latest = windows.latest_per_key(t.table(spark, sf_dir, "orders"), ["o_custkey"], order)
    return latest.select("o_custkey", "o_orderkey", "o_orderstatus")


@query(
    "window_version_number",
    with_tables("host_versions", "select host_id, month_date, n as version_num from host_versions"),
)
def window_version_number(spark, sf_dir):
    s = t.star(spark, sf_dir).once("listings")
    # the line items' hot hosts: silver is scanned once
    hot = t.hot_hosts(spark, sf_dir)
    history = star.host_history(s.listings, hot).select("host_id", "month_date")
    return plain(windows.version_number(history, "host_id", "month_date"))


@query(
    "window_lag",
    f"""select o_orderpriority, m as month, n, lag(m) over w as prev_month,
      lag(n) over w as prev_n
    from (select o_orderpriority, {MONTH} as m, count(*) as n from orders group by 1, 2)
    window w as (partition by o_orderpriority order by m)""",
)
def window_lag(spark, sf_dir):
    monthly = _orders(spark, sf_dir).groupBy("o_orderpriority", "month")
    return windows.lag_by(
        monthly.agg(F.count("*").alias("n")),
        ["o_orderpriority"],
        "month",
        {"prev_month": "month", "prev_n": "n"},
    )


@query(
    "window_global_rank",
    f"""select o_custkey, rank() over (order by spent desc) as best,
      rank() over (order by spent asc) as worst
    from (select o_custkey, sum({PRICE}) as spent from orders group by 1)""",
)
def window_global_rank(spark, sf_dir):
    """Both ranks of every customer; no task sees all of them."""
    spent = _orders(spark, sf_dir).groupBy("o_custkey").agg(
        F.sum("price").cast("decimal(18,2)").alias("spent")
    )
    ranked = windows.global_rank(spent, "spent", "best", descending=True)
    return windows.global_rank(ranked, "spent", "worst").drop("spent")


@query(
    "window_global_rank_ties",
    """select l_orderkey, l_linenumber, l_suppkey, l_partkey, rank() over (order by q) as first_place,
      cast(rank() over (order by q) + (count(*) over (partition by q) - 1) / 2.0 as double) as middle
    from (select *, cast(l_quantity as int) as q from lineitem)""",
)
def window_global_rank_ties(spark, sf_dir):
    """Fifty values shared by all rows: ties at their first and at their middle place."""
    line = _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "qty")
    hot = joins.heavy_keys(line, "qty")
    ranked = windows.global_rank(line, "qty", "first_place", hot=hot)
    return windows.global_rank(ranked, "qty", "middle", ties="average", hot=hot).drop("qty")


@query(
    "window_top_k_per_group",
    """select l_suppkey, l_partkey, n, rank from (select *, rank() over (partition by l_suppkey
        order by n desc) as rank from (select l_suppkey, l_partkey, count(*) as n
        from lineitem group by 1, 2)) where rank <= 3""",
)
def window_top_k_per_group(spark, sf_dir):
    counted = t.table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_partkey")
    return plain(
        windows.top_k_per_group(
            counted.agg(F.count("*").alias("n")), ["l_suppkey"], F.col("n").desc(), 3
        )
    )


@query(
    "window_spread",
    f"""select o_orderpriority, o_orderstatus, {dbl("a")} as average, {dbl(
      "max(a) over (partition by o_orderpriority) - min(a) over (partition by o_orderpriority)")}
      as gap
    from (select o_orderpriority, o_orderstatus,
            cast(round(cast(sum({PRICE}) / count(*) as decimal(30,6)), 2) as decimal(18,2)) as a
          from orders group by 1, 2)""",
)
def window_spread(spark, sf_dir):
    averages = _orders(spark, sf_dir).groupBy("o_orderpriority", "o_orderstatus").agg(
        half_up(mean("price"), 2).alias("average")
    )
    return plain(windows.spread(averages, ["o_orderpriority"], "average", "gap"))


@query(
    "window_share_of_total",
    f"""select o_orderpriority, n, {rounded("100.0 * n / sum(n) over ()", 1)} as pct_n,
      {rounded("100.0 * units / sum(units) over ()", 1)} as pct_units, cast(units as bigint) as units
    from (select o_orderpriority, count(*) as n, sum(cast({PRICE} as bigint)) as units
          from (select o_orderpriority, floor(o_totalprice) as o_totalprice from orders) group by 1)""",
)
def window_share_of_total(spark, sf_dir):
    sums = _orders(spark, sf_dir).groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.sum(F.floor("o_totalprice")).alias("units")
    )
    return plain(windows.share_of_total(sums, {"pct_n": "n", "pct_units": "units"}))


@query(
    "window_pct_change",
    f"""select o_custkey, m as month, n, case when lag(m) over w = cast(m - interval 1 month as date)
      then {rounded("100.0 * (n - lag(n) over w) / nullif(lag(n) over w, 0)", 2)} end as change
    from (select o_custkey, {MONTH} as m, count(*) filter (where o_orderstatus <> 'P') as n
          from orders group by 1, 2)
    window w as (partition by o_custkey order by m)""",
)
def window_pct_change(spark, sf_dir):
    """Customers miss months and have zero months, so many changes are unknown."""
    monthly = _orders(spark, sf_dir).groupBy("o_custkey", "month").agg(
        F.count_if(F.col("o_orderstatus") != "P").alias("n")
    )
    return plain(windows.pct_change(monthly, ["o_custkey"], "month", {"change": "n"}))


# --- sort, top-k, sets -------------------------------------------------------


@query(
    "sort_mixed",
    """select c_custkey, c_mktsegment, substr(c_name, 10) as digits from customer
    order by c_mktsegment desc, substr(c_name, 10), c_custkey""",
)
def sort_mixed(spark, sf_dir):
    digits = F.substr("c_name", F.lit(10))
    rows = t.table(spark, sf_dir, "customer")
    return rows.orderBy(F.col("c_mktsegment").desc_nulls_last(), digits, "c_custkey").select(
        "c_custkey", "c_mktsegment", digits.alias("digits")
    )


@query(
    "top_k_rows",
    f"select o_orderkey, {dbl(PRICE)} as price from orders order by {PRICE} desc, o_orderkey limit 15",
)
def top_k_rows(spark, sf_dir):
    best = topk.top_k(_orders(spark, sf_dir), F.col("price").desc(), 15, [F.col("o_orderkey")])
    return plain(best.select("o_orderkey", "price"))


@query(
    "top_and_bottom",
    """select c_custkey, n, case when up <= 3 then 'Top 3' else 'Bottom 3' end as revenue_group
    from (select *, rank() over (order by n desc) as up, rank() over (order by n) as down
          from (select o_custkey as c_custkey, count(*) as n from orders group by 1))
    where up <= 3 or down <= 3""",
)
def top_and_bottom(spark, sf_dir):
    """Customers with the most and the fewest orders; ties make the tails longer than three."""
    counted = t.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
    return topk.top_bottom(counted.agg(F.count("*").alias("n")), "n", 3)


@query(
    "sort_totals_last",
    """select coalesce(n_name, 'ALL') as n_name, count(*) as n,
      case when n_name is null then 1 else 0 end as is_total
    from customer join nation on c_nationkey = n_nationkey group by grouping sets ((n_name), ())
    order by is_total, n desc, n_name""",
)
def sort_totals_last(spark, sf_dir):
    customer, nation = (t.table(spark, sf_dir, n) for n in ("customer", "nation"))
    named = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = agg.with_total(named, ["n_name"], [F.count("*").alias("n")], "ALL")
    return plain(rows.orderBy("is_total", F.col("n").desc(), "n_name"))


@query(
    "union_all_rows",
    "select c_custkey as key, 'customer' as kind from customer "
    "union all select s_suppkey, 'supplier' from supplier",
)
def union_all_rows(spark, sf_dir):
    customer, supplier = (t.table(spark, sf_dir, n) for n in ("customer", "supplier"))
    left = customer.select(F.col("c_custkey").alias("key"), F.lit("customer").alias("kind"))
    right = supplier.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("key"))
    return left.unionByName(right)


# --- intervals ---------------------------------------------------------------


@query(
    "history_same_month_interval",
    f"""select o_custkey, o_orderkey, case when k = 1 then date '1900-01-01' else {MONTH} end
        as valid_from,
      coalesce(cast(date_trunc('month', nxt) as date), date '9999-12-31') as valid_to,
      nxt is null as is_current
    from (select *, row_number() over w as k, lead(o_orderdate) over w as nxt
          from (select *, row_number() over (partition by o_custkey, o_orderdate
                  order by o_orderkey desc) as p from orders) where p = 1
          window w as (partition by o_custkey order by o_orderdate))""",
)
def history_same_month_interval(spark, sf_dir):
    """Day-grained versions truncated to months: the earlier of two in a month is empty."""
    from tidemark.operators.history import build_history

    orders = t.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    history = build_history(orders, "o_custkey", "o_orderdate", [F.col("o_orderkey").desc()])
    return to_dimension(history, "o_custkey", ["o_orderkey"], "customer").drop(
        "customer_version_id"
    )


@query(
    "history_collapse_then_point_in_time",
    with_tables(
        "fact dim_property",
        """select f.listing_id, f.month_date, p.room_type from fact f
        join dim_property p on f.listing_id = p.listing_id
          and f.month_date >= p.valid_from and f.month_date < p.valid_to""",
    ),
)
def history_collapse_then_point_in_time(spark, sf_dir):
    """Merging unchanged versions does not change what a fact row sees."""
    s = t.star(spark, sf_dir)
    versions = s.dim_property.select("listing_id", "room_type", "valid_from", "valid_to")
    merged = collapse_unchanged(versions, "listing_id", ["room_type"])
    return pit_join(s.fact.select("listing_id", "month_date"), merged, "listing_id")
