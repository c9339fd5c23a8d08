"""The given tables read as listings, areas, suburbs and census figures.

A line item is one observation of a listing (the part) by a host (the order) in
the month it shipped; its supplier gives the neighbourhood. Flags, capacity and
availability are taken from the line item, so that listings and hosts change
over time. Nations are the areas, suppliers the suburbs, and customers per
nation the census.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.joins import heavy_keys
from tidemark.operators.windows import latest_per_key
from tidemark.plans.silver import (
    LISTING_COLUMNS,
    clean_counts,
    clean_lga,
    clean_medians,
    clean_suburb,
)
from tidemark.plans.star import StarOnDemand, dim_lga, dim_suburb, lga_history, suburb_history
from tidemark.session import shared_dir
from tidemark.sources.load import one_writer_per
from tidemark.sources.paths import read_if_present

TIE_BREAK = ("host_id", "accommodates", "scrape_id")
LOADS = ("1995-03-15", "1998-06-10")

# narrow age columns, one per thousand of the account balance from -1000 up
AGE_COLUMNS = (
    "age_0_4_yr_p", "age_5_14_yr_p", "age_15_19_yr_p", "age_20_24_yr_p", "age_25_34_yr_p",
    "age_35_44_yr_p", "age_45_54_yr_p", "age_55_64_yr_p", "age_65_74_yr_p", "age_75_84_yr_p",
    "age_85ov_p",
)

# census figure and the divisor that turns a mean balance into it
MEDIAN_DIVISORS = {
    "median_age_persons": "100",
    "median_mortgage_repay_monthly": "0.1",
    "median_tot_prsnl_inc_weekly": "5",
    "median_rent_weekly": "10",
    "median_tot_fam_inc_weekly": "3",
    "median_tot_hhd_inc_weekly": "2",
    "average_num_psns_per_bedroom": "4000",
    "average_household_size": "2000",
}


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def source_file(month: Column) -> Column:
    number = F.lpad(F.month(month).cast("string"), 2, "0")
    return F.concat(number, F.lit("_"), F.year(month).cast("string"), F.lit(".csv"))


def listing_rows(
    spark: SparkSession, sf_dir: str, line: DataFrame | None = None, gathered: bool = False
) -> DataFrame:
    """Typed observations, several per listing and month; ``line`` defaults to all line items.

    ``gathered`` brings those of a month together, before the wide rows are made.
    """
    if line is None:
        line = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(
        nation, F.col("s_nationkey") == F.col("n_nationkey")
    )
    day = F.col("l_shipdate").cast("date")
    month = F.trunc("l_shipdate", "MM")
    if gathered:
        rows = one_writer_per(rows.withColumn("_month", month), "_month")
    quantity = F.col("l_quantity").cast("int")
    scores = {
        f"review_scores_{part}": (F.col("l_linenumber") + i).cast("decimal(5,2)")
        for i, part in enumerate(("accuracy", "cleanliness", "checkin", "communication", "value"))
    }
    columns = {
        "listing_id": F.col("l_partkey"),
        "scrape_id": F.col("l_suppkey").cast("string"),
        "scraped_date": day,
        "host_id": F.col("l_orderkey"),
        "month_date": month,
        "host_name": F.concat(F.lit("Host "), F.col("l_orderkey").cast("string")),
        "host_since": F.date_sub(day, F.col("l_linenumber") * 30),
        "host_is_superhost": F.when(F.col("l_tax") != 0, F.col("l_returnflag") == "A"),
        "host_neighbourhood": F.when(F.col("l_discount") > 0.085, F.lit(None))
        .when(F.col("l_discount") < 0.005, F.lit("Overseas"))
        .otherwise(F.col("s_name")),
        "listing_neighbourhood": F.when(
            (F.col("l_tax") > 0.075) & (F.col("l_linenumber") == 7), F.lit("nowhere")
        ).otherwise(F.lower("n_name")),
        "property_type": F.col("l_returnflag"),
        "room_type": F.col("l_linestatus"),
        "accommodates": F.col("l_linenumber"),
        "price": F.col("l_extendedprice").cast("decimal(10,2)"),
        "has_availability": F.when(
            ~F.col("l_tax").between(0.005, 0.015), F.col("l_discount") > 0.025
        ),
        "availability_30": F.when(quantity < 50, F.least(F.lit(30), quantity)),
        "number_of_reviews": quantity,
        "review_scores_rating": F.when(quantity <= 45, (F.lit(100) - quantity)).cast(
            "decimal(5,2)"
        ),
        **scores,
        "source_file": source_file(month),
        "loaded_at": F.add_months(month, 1).cast("timestamp"),
    }
    return rows.select(*[c.alias(name) for name, c in columns.items()])


def raw_listings(
    spark: SparkSession, sf_dir: str, line: DataFrame | None = None, gathered: bool = False
) -> DataFrame:
    """The observations the way files hold them: every column but ``loaded_at`` as text.

    ``line`` and ``gathered`` as in :func:`listing_rows`.
    """
    rows = listing_rows(spark, sf_dir, line, gathered).drop("month_date")
    cells = {}
    for field in rows.schema.fields:
        value = F.col(field.name)
        if field.name == "host_since":
            value = F.date_format(value, "d/M/yyyy")
        elif isinstance(field.dataType, T.BooleanType):
            value = F.when(value, "t").when(~value, "f")
        elif field.name == "number_of_reviews":
            value = value.cast("decimal(10,1)").cast("string")
        elif field.name != "loaded_at":
            value = value.cast("string")
        cells[field.name] = value
    return rows.select(*[c.alias(name) for name, c in cells.items()])


def hot_listings(spark: SparkSession, sf_dir: str) -> list:
    """Listings with more observations than a shuffle partition's share."""
    return heavy_keys(table(spark, sf_dir, "lineitem"), "l_partkey")


def hot_hosts(spark: SparkSession, sf_dir: str) -> list:
    return heavy_keys(table(spark, sf_dir, "lineitem"), "l_orderkey")


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation per listing and month: :func:`one_per_month` on the narrow line items.

    All columns that decide are the line item's own, so the duplicates go before
    the names are joined and the wide row is built.
    """
    line = table(spark, sf_dir, "lineitem").withColumn("_month", F.trunc("l_shipdate", "MM"))
    order = [
        F.to_date("l_shipdate").desc_nulls_first(),
        F.col("l_orderkey").desc_nulls_last(),
        F.col("l_linenumber").desc_nulls_last(),
        F.col("l_suppkey").cast("string").desc_nulls_last(),
    ]
    hot = hot_listings(spark, sf_dir)
    latest = latest_per_key(line, ["l_partkey", "_month"], order, hot)
    return listing_rows(spark, sf_dir, latest).select(*LISTING_COLUMNS)


def raw_lga(spark: SparkSession, sf_dir: str, load: int) -> DataFrame:
    """Area codes and names as text; the first load has old names for one region."""
    nation = table(spark, sf_dir, "nation")
    name = F.col("n_name")
    if load == 0:
        name = F.when(F.col("n_regionkey") == 0, F.concat(F.lit("Old "), name)).otherwise(name)
    return nation.select(
        F.col("n_nationkey").cast("string").alias("lga_code"),
        F.concat(F.lit(" "), name, F.lit(" ")).alias("lga_name"),
        F.lit(LOADS[load]).cast("timestamp").alias("loaded_at"),
    )


def lga_load(spark: SparkSession, sf_dir: str, load: int) -> DataFrame:
    return clean_lga(raw_lga(spark, sf_dir, load))


def lga_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lga_load(spark, sf_dir, 0).unionByName(lga_load(spark, sf_dir, 1))


def raw_suburb(spark: SparkSession, sf_dir: str, load: int) -> DataFrame:
    """Suburbs as text; in the first load a supplier lies in two areas."""
    supplier = table(spark, sf_dir, "supplier").select("s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation")
    own = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    pairs = own.select("s_name", "n_name")
    if load == 0:
        heads = nation.select(F.col("n_nationkey").alias("h_key"), F.col("n_name").alias("h_name"))
        second = own.join(heads, F.col("n_regionkey") == F.col("h_key"))
        pairs = pairs.unionByName(second.select("s_name", F.col("h_name").alias("n_name")))
    return pairs.select(
        F.upper("n_name").alias("lga_name"),
        F.concat(F.upper("s_name"), F.lit(" ")).alias("suburb_name"),
        F.lit(LOADS[load]).cast("timestamp").alias("loaded_at"),
    )


def suburb_load(spark: SparkSession, sf_dir: str, load: int) -> DataFrame:
    return clean_suburb(raw_suburb(spark, sf_dir, load), lga_load(spark, sf_dir, load))


def suburb_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suburb_load(spark, sf_dir, 0).unionByName(suburb_load(spark, sf_dir, 1))


def _area_text() -> Column:
    return F.concat(F.lit("LGA"), F.col("c_nationkey").cast("string")).alias("lga_code_2016")


def _loaded() -> Column:
    return F.lit(LOADS[0]).cast("timestamp").alias("loaded_at")


def raw_g01(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per nation and thousand of balance, as text."""
    customer = table(spark, sf_dir, "customer")
    band = F.least(F.greatest(F.floor(F.col("c_acctbal") / 1000) + 1, F.lit(0)), F.lit(10))
    counts = customer.groupBy("c_nationkey").agg(
        F.count("*").alias("tot_p_p"),
        *[F.count_if(band == i).alias(name) for i, name in enumerate(AGE_COLUMNS)],
    )
    texts = [F.col(c).cast("string").alias(c) for c in ("tot_p_p", *AGE_COLUMNS)]
    return counts.select(_area_text(), *texts, _loaded())


def raw_g02(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures per nation from the mean customer balance, as text."""
    customer = table(spark, sf_dir, "customer")
    balance = F.sum(F.col("c_acctbal").cast("decimal(12,2)"))
    average = (balance / F.count("*")).cast("decimal(30,6)").alias("average")
    figures = [
        (F.col("average") / F.lit(divisor).cast("decimal(6,1)"))
        .cast("decimal(30,6)")
        .cast("string")
        .alias(name)
        for name, divisor in MEDIAN_DIVISORS.items()
    ]
    per_nation = customer.groupBy("c_nationkey").agg(average)
    return per_nation.select(_area_text(), *figures, _loaded())


def g01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_counts(raw_g01(spark, sf_dir))


def g02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_medians(raw_g02(spark, sf_dir))


_STARS: dict[tuple[str, str], StarOnDemand] = {}


def star(spark: SparkSession, sf_dir: str) -> StarOnDemand:
    """The silver and gold tables, each written once per application to the shared folder, when
    a query first asks for it.

    Marts and reports are views over them, as in any layered warehouse. Tables
    that were removed in the meantime are written again.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _STARS:
        # any schema will do to see whether the files are there
        there = (read_if_present(spark, path, "x INT") for path in _STARS[key].written())
        if all(df is not None for df in there):
            return _STARS[key]
    _STARS[key] = StarOnDemand(
        silver(spark, sf_dir),
        lga_loads(spark, sf_dir),
        suburb_loads(spark, sf_dir),
        g01(spark, sf_dir),
        g02(spark, sf_dir),
        shared_dir(spark, "star"),
    )
    return _STARS[key]


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_lga(lga_history(lga_loads(spark, sf_dir)))


def suburbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_suburb(suburb_history(suburb_loads(spark, sf_dir)))


def plain(df: DataFrame) -> DataFrame:
    """Counts as BIGINT and decimals as DOUBLE, the types a SQL check compares."""
    kinds = []
    for field in df.schema.fields:
        value = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            value = value.cast("bigint")
        kinds.append(value.alias(field.name))
    return df.select(*kinds)
