"""Column expressions over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalogue import query
from tidemark.catalogue import tables as t
from tidemark.catalogue.sql import dbl, half_up
from tidemark.catalogue.tables import plain
from tidemark.functions import dates, numbers, text
from tidemark.operators.aggregates import bucketize
from tidemark.operators.history import version_id


@query(
    "expression_text",
    """select c_custkey, trim('  ' || c_name || ' ') as trimmed,
      upper(trim(' ' || c_name || ' ')) as key,
      upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) || '-'
        || upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) as title,
      replace(c_name, 'Customer#', '') as stripped, substr(c_name, 4, 4) as middle,
      left(c_name, 7) as head, c_name || ' ' || c_custkey as joined,
      case when c_mktsegment = 'BUILDING' then null else c_mktsegment end || '!' as null_joined
    from customer""",
)
def expression_text(spark, sf_dir):
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    gap = F.when(segment != "BUILDING", segment)
    return t.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        text.join_key(F.concat(F.lit(" "), name, F.lit(" "))).alias("key"),
        text.title_case(F.concat(segment, F.lit("-"), F.lower(segment))).alias("title"),
        text.strip_prefix("c_name", "Customer#").alias("stripped"),
        F.substr(name, F.lit(4), F.lit(4)).alias("middle"),
        F.left(name, F.lit(7)).alias("head"),
        F.concat(name, F.lit(" "), F.col("c_custkey").cast("string")).alias("joined"),
        F.concat(gap, F.lit("!")).alias("null_joined"),
    )


@query(
    "expression_casts",
    f"""select l_orderkey, l_partkey, l_suppkey, l_linenumber,
      cast(round(l_quantity / 2, 0) as bigint) as half_whole,
      cast(l_extendedprice as bigint) as whole_price,
      {dbl("cast(l_extendedprice as decimal(12,2))")} as price,
      cast(l_shipdate as date) as iso_day, cast(l_shipdate as date) as dmy_day
    from (select * replace (floor(l_extendedprice) as l_extendedprice) from lineitem)""",
)
def expression_casts(spark, sf_dir):
    """Numbers and dates from text; halves round away from zero."""
    line = t.table(spark, sf_dir, "lineitem")
    half = (F.col("l_quantity") / 2).cast("string")
    whole = F.floor("l_extendedprice").cast("string")
    day = F.col("l_shipdate").cast("date")
    return plain(
        line.select(
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            numbers.to_whole(half).alias("half_whole"),
            numbers.to_whole(F.concat(whole, F.lit("E+0")), "bigint").alias("whole_price"),
            numbers.to_decimal(whole, 12, 2).alias("price"),
            dates.parse_iso(day.cast("string")).alias("iso_day"),
            dates.parse_dmy(F.date_format(day, "d/M/yyyy")).alias("dmy_day"),
        )
    )


@query(
    "expression_lenient_casts",
    """select p_partkey, cast(null as bigint) as bad_number, cast(null as date) as bad_day,
      cast(p_size as bigint) as good_number from part""",
)
def expression_lenient_casts(spark, sf_dir):
    """Cells that do not parse read as NULL instead of failing the job."""
    return plain(
        t.table(spark, sf_dir, "part").select(
            "p_partkey",
            numbers.to_whole("p_name", strict=False).alias("bad_number"),
            dates.parse_dmy("p_name", strict=False).alias("bad_day"),
            numbers.to_whole(F.col("p_size").cast("string"), strict=False).alias("good_number"),
        )
    )


@query(
    "expression_dates",
    """select o_orderkey, cast(date_trunc('month', o_orderdate) as date) as month_from_name,
      cast(date_trunc('month', o_orderdate) as date) as month_start,
      cast(date_trunc('month', o_orderdate) - interval 1 month as date) as month_before,
      strftime(o_orderdate, '%Y-%m') as label from orders""",
)
def expression_dates(spark, sf_dir):
    day = F.col("o_orderdate")
    return t.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.period_of(t.source_file(day)).alias("month_from_name"),
        dates.month_floor("o_orderdate").alias("month_start"),
        dates.previous_month(dates.month_floor("o_orderdate")).alias("month_before"),
        dates.year_month("o_orderdate").alias("label"),
    )


_CENTS = "cast(cast(o_totalprice as decimal(12,2)) * 100 as bigint)"


@query(
    "expression_numbers",
    f"""select o_orderkey, {half_up(_CENTS, "700", 1)} as one_digit,
      {half_up(_CENTS, "700", 3)} as three_digits,
      format('{{:,}}', cast(round(cast(o_totalprice as decimal(12,2)), 0) as bigint)) as grouped,
      {half_up("100 * o_orderkey", "nullif(o_custkey, 0)", 2)} as guarded,
      coalesce(nullif(o_orderstatus, 'P'), 'none') as filled
    from orders""",
)
def expression_numbers(spark, sf_dir):
    price = F.col("o_totalprice").cast("decimal(12,2)")
    return plain(
        t.table(spark, sf_dir, "orders").select(
            "o_orderkey",
            numbers.half_up(price / 7, 1).alias("one_digit"),
            numbers.half_up(price / 7, 3).alias("three_digits"),
            numbers.thousands(price).alias("grouped"),
            numbers.percent(F.col("o_orderkey"), F.col("o_custkey"), 2).alias("guarded"),
            F.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("P")), F.lit("none")).alias("filled"),
        )
    )


@query(
    "expression_case",
    """select l_orderkey, l_partkey, l_suppkey, l_linenumber,
      case when l_quantity <= 10 then 'small' when l_quantity <= 30 then 'medium'
        else 'large' end as size,
      case when l_quantity <= 10 then 1 when l_quantity <= 30 then 2 else 3 end as size_order,
      case when l_tax > 0.04 then 1 end as without_else, l_returnflag = 'R' as flag
    from lineitem""",
)
def expression_case(spark, sf_dir):
    label, order = bucketize("l_quantity", (10, 30), ("small", "medium", "large"))
    return plain(
        t.table(spark, sf_dir, "lineitem").select(
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            label.alias("size"),
            order.alias("size_order"),
            F.when(F.col("l_tax") > 0.04, 1).alias("without_else"),
            text.is_true("l_returnflag", "R").alias("flag"),
        )
    )


@query(
    "expression_version_id",
    """select o_custkey, m, md5(o_custkey || '|' || m) as version_id from (
      select distinct o_custkey, cast(date_trunc('month', o_orderdate) as date) as m from orders)""",
)
def expression_version_id(spark, sf_dir):
    months = t.table(spark, sf_dir, "orders").select(
        "o_custkey", dates.month_floor("o_orderdate").alias("m")
    )
    return months.distinct().withColumn("version_id", version_id("o_custkey", "m"))


@query(
    "expression_null_tokens",
    """select event_id, case when event_type in ('error', 'view') then null else event_type end
      as cell from events""",
)
def expression_null_tokens(spark, sf_dir):
    """Cells that spell a missing value, here injected for two event types, read as NULL."""
    cell = (
        F.when(F.col("event_type") == "error", "N/A")
        .when(F.col("event_type") == "view", "")
        .otherwise(F.col("event_type"))
    )
    return t.table(spark, sf_dir, "events").select("event_id", text.null_tokens(cell).alias("cell"))
