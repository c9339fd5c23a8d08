"""Typed, deduplicated tables from raw text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import parse_dmy, parse_iso, period_of
from tidemark.functions.numbers import to_decimal, to_whole
from tidemark.functions.text import is_true, join_key, strip_prefix, title_case
from tidemark.operators.windows import latest_per_key

LISTING_COLUMNS = (
    "listing_id", "host_id", "scraped_date", "month_date", "host_since", "host_name",
    "host_is_superhost", "host_neighbourhood", "listing_neighbourhood", "property_type",
    "room_type", "accommodates", "price", "has_availability", "availability_30",
    "number_of_reviews", "review_scores_rating", "review_scores_accuracy",
    "review_scores_cleanliness", "review_scores_checkin", "review_scores_communication",
    "review_scores_value", "source_file", "loaded_at",
)

HOST_ATTRIBUTES = ("host_name", "host_since", "host_is_superhost", "host_neighbourhood")
PROPERTY_ATTRIBUTES = ("listing_neighbourhood", "property_type", "room_type", "accommodates")


def type_listings(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Raw text rows to typed ones; the month comes from the file's name.

    ``strict`` fails on a cell that does not parse, otherwise it reads as NULL.
    """
    kinds: dict[str, Column] = {
        "listing_id": to_whole("listing_id", "bigint", strict),
        "host_id": to_whole("host_id", "bigint", strict),
        "scraped_date": parse_iso("scraped_date", strict),
        "host_since": parse_dmy("host_since", strict),
        "month_date": period_of("source_file"),
        "price": to_decimal("price", 10, 2, strict),
    }
    for name in ("host_is_superhost", "has_availability"):
        kinds[name] = is_true(name)
    for name in (
        "host_name",
        "host_neighbourhood",
        "listing_neighbourhood",
        "property_type",
        "room_type",
    ):
        kinds[name] = F.trim(name)
    for name in ("accommodates", "availability_30", "number_of_reviews"):
        kinds[name] = to_whole(name, "int", strict)
    for name in (c for c in LISTING_COLUMNS if c.startswith("review_scores_")):
        kinds[name] = to_decimal(name, 5, 2, strict)
    return raw.withColumns(kinds)


def one_per_month(
    listings: DataFrame,
    tie_break: Sequence[str] | None = None,
    hot: Sequence | None = None,
    parts: int | None = None,
) -> DataFrame:
    """One row per listing and month: the latest scrape, then the latest load.

    Rows equal in both are settled by ``tie_break``, or by every other column
    when none is named, so that the choice does not change between runs. ``hot`` are the
    listings with many rows, where they are known. ``parts`` deals the listings of a month to that
    many tasks at most, so that a table by month is written without another shuffle.
    """
    order = [F.col("scraped_date").desc_nulls_first(), F.col("loaded_at").desc_nulls_first()]
    if tie_break is None:
        settled = {"listing_id", "month_date", "scraped_date", "loaded_at"}
        tie_break = [c for c in LISTING_COLUMNS if c not in settled]
    order += [F.col(c).desc_nulls_last() for c in tie_break]
    keys, by = ["listing_id", "month_date"], None
    if parts is not None:
        listings = listings.withColumn("_part", F.pmod(F.xxhash64("listing_id"), F.lit(parts)))
        keys, by, hot = [*keys, "_part"], ["month_date", "_part"], hot or ()
    kept = latest_per_key(listings, keys, order, hot, by)
    return kept.select(*LISTING_COLUMNS)


def clean_listings(
    raw: DataFrame,
    strict: bool = True,
    tie_break: Sequence[str] | None = None,
    hot: Sequence | None = None,
    parts: int | None = None,
) -> DataFrame:
    return one_per_month(type_listings(raw, strict), tie_break, hot, parts)


def host_order() -> list[Column]:
    return [F.col(c).desc_nulls_first() for c in ("scraped_date", "listing_id")]


def property_order() -> list[Column]:
    return [F.col("scraped_date").desc_nulls_first()]


def latest_hosts(listings: DataFrame) -> DataFrame:
    """One row per host: what the latest month says about them."""
    known = listings.filter("host_id IS NOT NULL")
    order = [F.col("month_date").desc_nulls_first(), *host_order()]
    return latest_per_key(known, ["host_id"], order).select(
        "host_id", *HOST_ATTRIBUTES, "month_date"
    )


def latest_properties(listings: DataFrame) -> DataFrame:
    """One row per listing: what the latest month says about it."""
    known = listings.filter("listing_id IS NOT NULL")
    order = [F.col("month_date").desc_nulls_first(), *property_order()]
    return latest_per_key(known, ["listing_id"], order).select(
        "listing_id", *PROPERTY_ATTRIBUTES, "month_date"
    )


def clean_lga(raw: DataFrame) -> DataFrame:
    return raw.filter("lga_code IS NOT NULL").select(
        F.col("lga_code").cast("int").alias("lga_code"),
        F.trim("lga_name").alias("lga_name"),
        join_key("lga_name").alias("lga_name_key"),
        F.col("loaded_at").cast("timestamp").alias("loaded_at"),
    )


def clean_suburb(raw: DataFrame, lga: DataFrame) -> DataFrame:
    """One row per suburb: its alphabetically first area, with the area's code."""
    named = raw.filter("suburb_name IS NOT NULL").select(
        join_key("suburb_name").alias("suburb_name_key"),
        title_case(F.trim("suburb_name")).alias("suburb_name"),
        join_key("lga_name").alias("_area_key"),
        F.col("loaded_at").cast("timestamp").alias("loaded_at"),
    )
    order = [F.col("_area_key").asc_nulls_last(), F.col("loaded_at").desc_nulls_last()]
    first = latest_per_key(named, ["suburb_name_key"], order)
    areas = lga.select(F.col("lga_name_key").alias("_lga_key"), "lga_code", "lga_name")
    return first.join(areas, F.col("_area_key") == F.col("_lga_key"), "left").select(
        "suburb_name_key", "suburb_name", "lga_code", "lga_name", "loaded_at"
    )


def _area_code() -> Column:
    return strip_prefix("lga_code_2016", "LGA").cast("int").alias("lga_code")


def cast_all_except(df: DataFrame, skip: Sequence[str], kind: str = "int") -> list[Column]:
    """Rounded casts of every column that is not listed."""
    return [to_whole(c, kind).alias(c) for c in df.columns if c not in skip]


def clean_counts(raw: DataFrame) -> DataFrame:
    """The wide table of counts per area; the columns are read off the input."""
    skip = ("lga_code_2016", "source_file", "loaded_at")
    loaded = F.col("loaded_at").cast("timestamp").alias("loaded_at")
    return raw.select(_area_code(), *cast_all_except(raw, skip), loaded)


def clean_medians(raw: DataFrame) -> DataFrame:
    """Medians are whole numbers; the two averages keep two decimals."""
    typed = [
        to_decimal(c, 4, 2).alias(c) if c.startswith("average_") else to_whole(c).alias(c)
        for c in raw.columns
        if c not in ("lga_code_2016", "source_file", "loaded_at")
    ]
    return raw.select(
        _area_code(), *typed, F.col("loaded_at").cast("timestamp").alias("loaded_at")
    )
