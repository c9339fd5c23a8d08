"""Star schema: dimensions with history, reference tables, the monthly fact."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import cached_property
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.history import build_history, to_dimension
from tidemark.operators.joins import heavy_keys
from tidemark.operators.pointintime import Slices, date_slices, pit_join
from tidemark.plans.silver import (
    HOST_ATTRIBUTES,
    PROPERTY_ATTRIBUTES,
    clean_counts,
    host_order,
    property_order,
)
from tidemark.sources.load import write_table

LGA_ATTRIBUTES = ("lga_name", "lga_name_key")
SUBURB_ATTRIBUTES = ("suburb_name", "lga_code", "lga_name")
NIGHTS = 30
# the tables that the marts join by listing
BUCKETED = ("fact", "dim_property")


def host_history(listings: DataFrame, hot: Sequence | None = None) -> DataFrame:
    """``hot`` are the hosts with many rows, where they are known."""
    seen = listings.select("host_id", "month_date", "scraped_date", "listing_id", *HOST_ATTRIBUTES)
    return build_history(seen, "host_id", "month_date", host_order(), hot).drop(
        "scraped_date", "listing_id"
    )


def property_history(listings: DataFrame, hot: Sequence | None = None) -> DataFrame:
    """``hot`` is empty for silver listings, which have one row a month."""
    seen = listings.select("listing_id", "month_date", "scraped_date", *PROPERTY_ATTRIBUTES)
    return build_history(seen, "listing_id", "month_date", property_order(), hot).drop(
        "scraped_date"
    )


def lga_history(loads: DataFrame) -> DataFrame:
    """From every load of the area file; a reload starts a version."""
    return build_history(loads, "lga_code", "loaded_at")


def suburb_history(loads: DataFrame) -> DataFrame:
    return build_history(loads, "suburb_name_key", "loaded_at")


def dim_host(history: DataFrame) -> DataFrame:
    return to_dimension(history, "host_id", HOST_ATTRIBUTES, "host")


def dim_property(history: DataFrame) -> DataFrame:
    return to_dimension(history, "listing_id", PROPERTY_ATTRIBUTES, "property")


def dim_lga(history: DataFrame) -> DataFrame:
    return to_dimension(history, "lga_code", LGA_ATTRIBUTES, "lga")


def dim_suburb(history: DataFrame) -> DataFrame:
    return to_dimension(history, "suburb_name_key", SUBURB_ATTRIBUTES, "suburb")


def census_g01(raw: DataFrame) -> DataFrame:
    """Counts per area, no history; one code path with the silver table."""
    return clean_counts(raw)


def census_g02(silver: DataFrame) -> DataFrame:
    """Medians per area, no history: the silver table as it is."""
    return silver


def fact_listings(listings: DataFrame, lga: DataFrame, hot: tuple = ()) -> DataFrame:
    """One row per listing and month with the area valid in that month.

    ``hot`` lists upper-case neighbourhoods to spread; it matters only for an
    area table too large for Spark to broadcast by itself.
    """
    areas = lga.select("lga_code", "lga_name_key", "valid_from", "valid_to")
    placed = pit_join(
        listings,
        areas,
        (F.upper("listing_neighbourhood"), "lga_name_key"),
        how="left",
        hot=hot,
        # two areas may bear one name
        overlapping=True,
    )
    nights = F.lit(NIGHTS) - F.col("availability_30")
    active = F.col("has_availability")
    revenue = (nights.cast("decimal(3,0)") * F.col("price")).cast("decimal(13,2)")
    return placed.select(
        "listing_id",
        "host_id",
        "lga_code",
        "scraped_date",
        "month_date",
        "price",
        "has_availability",
        "availability_30",
        "number_of_reviews",
        *[c for c in listings.columns if c.startswith("review_scores_")],
        F.when(active, nights).otherwise(0).alias("number_of_stays"),
        F.when(active, revenue)
        .otherwise(F.lit(0).cast("decimal(13,2)"))
        .alias("estimated_revenue"),
    )


@dataclass(frozen=True)
class Star:
    """The gold layer. ``hot_hosts`` and ``hot_suburbs`` are the keys that joins should spread;
    ``host_slices`` cuts the hot hosts by date as well."""

    listings: DataFrame
    fact: DataFrame
    dim_host: DataFrame
    dim_property: DataFrame
    dim_lga: DataFrame
    dim_suburb: DataFrame
    g01: DataFrame | None = None
    g02: DataFrame | None = None
    hot_hosts: tuple = field(default=())
    hot_suburbs: tuple = field(default=())
    host_slices: Slices = field(default_factory=dict)


def build_star(
    listings: DataFrame,
    lga_loads: DataFrame,
    suburb_loads: DataFrame,
    g01: DataFrame | None = None,
    g02: DataFrame | None = None,
    root: str | None = None,
    buckets: int = 0,
) -> Star:
    """All of gold from silver.

    With ``root`` the listings, the fact and the dimensions are written below it
    and read back, as marts and reports use each of them several times; without
    it everything stays lazy. ``buckets`` writes the fact and the properties in equal buckets
    (see :func:`co_partitioned`).
    """
    if root is not None:
        star = StarOnDemand(listings, lga_loads, suburb_loads, g01, g02, root)
        tables = star.write(buckets)
        return Star(
            listings=star.listings,
            hot_hosts=star.hot_hosts,
            host_slices=star.host_slices,
            hot_suburbs=star.hot_suburbs,
            **tables,
        )
    areas = dim_lga(lga_history(lga_loads))
    fact = fact_listings(listings, areas)
    hosts = dim_host(host_history(listings))
    slices = date_slices(fact, "host_id", "month_date")
    return Star(
        listings=listings,
        fact=fact,
        dim_host=hosts,
        dim_property=dim_property(property_history(listings)),
        dim_lga=areas,
        dim_suburb=dim_suburb(suburb_history(suburb_loads)),
        g01=g01,
        g02=g02,
        hot_hosts=tuple(slices),
        host_slices=slices,
        hot_suburbs=tuple(heavy_keys(hosts, F.upper("host_neighbourhood"))),
    )


class StarOnDemand:
    """The gold layer below ``root`` with the tables of :class:`Star`, each of them written when
    it is first asked for, so that a reader of one table does not pay for all."""

    TABLES = ("dim_host", "dim_property", "dim_suburb", "dim_lga", "fact", "g01", "g02")

    def __init__(
        self,
        listings: DataFrame,
        lga_loads: DataFrame,
        suburb_loads: DataFrame,
        g01: DataFrame | None,
        g02: DataFrame | None,
        root: str,
    ):
        self._silver, self._root = listings, root
        self._frames = {
            "dim_host": lambda: dim_host(host_history(self.listings, self.hot_hosts)),
            "dim_property": lambda: dim_property(property_history(self.listings, ())),
            "dim_suburb": lambda: dim_suburb(suburb_history(suburb_loads)),
            "dim_lga": lambda: areas,
            "fact": lambda: fact_listings(self.listings, areas, self.hot_areas),
            "g01": lambda: g01,
            "g02": lambda: g02,
            "listings": lambda: self._silver,
        }
        self._whole = False
        areas = dim_lga(lga_history(lga_loads))

    def __getattr__(self, name: str) -> DataFrame | None:
        if name not in self.TABLES:
            raise AttributeError(name)
        return self.write(names=(name,))[name]

    def write(self, buckets: int = 0, names: Sequence[str] = TABLES) -> dict[str, DataFrame | None]:
        """Write the tables that are not there yet, by default all."""
        missing = {name: self._frames[name] for name in names if name not in vars(self)}
        # what several tables need, before they are written side by side
        for needed, of in (("hot_hosts", "dim_host"), ("hot_areas", "fact"), ("listings", "dim_property")):
            if of in missing:
                getattr(self, needed)
        vars(self).update(_write_all(missing, self._root, buckets))
        self._whole = self._whole or set(names) == set(self.TABLES)
        return {name: vars(self)[name] for name in names}

    def frame(self, name: str) -> DataFrame | None:
        """A table as it is written, or as it would be."""
        return vars(self)[name] if name in vars(self) else self._frames[name]()

    def once(self, *names: str) -> StarOnDemand | _Changed:
        """The star for a query that scans each of the named tables a single time.

        They are computed on the way to it, with the columns that it needs, as a table that nobody
        reads again is not worth writing. What the query does then does not depend on the
        tables that others have asked for; only a star that was written as a whole is read.
        """
        if self._whole:
            return self
        return _Changed(self, {name: self._frames[name]() for name in names})

    def written(self) -> list[str]:
        """Paths of the tables written so far."""
        silver = [f"{self._root}/silver/listings"] if "listings" in vars(self) else []
        names = [n for n in self.TABLES if vars(self).get(n) is not None]
        return silver + [f"{self._root}/gold/{n}" for n in names]

    @cached_property
    def listings(self) -> DataFrame:
        return write_table(self._silver, self._root, "silver", "listings")

    @cached_property
    def host_slices(self) -> Slices:
        # a fact has the host and the month of its listing
        return date_slices(self.listings, "host_id", "month_date")

    @property
    def hot_hosts(self) -> tuple:
        return tuple(self.host_slices)

    @cached_property
    def hot_areas(self) -> tuple:
        return tuple(heavy_keys(self.listings, F.upper("listing_neighbourhood")))

    @cached_property
    def hot_suburbs(self) -> tuple:
        # hosts have a version for each month of their listings; no table is made for the names
        return tuple(heavy_keys(self.listings, F.upper("host_neighbourhood")))


class _Changed:
    """A star on demand with other tables in the place of some."""

    def __init__(self, star: StarOnDemand, tables: Mapping[str, DataFrame | None]):
        self._star = star
        vars(self).update(tables)

    def __getattr__(self, name: str) -> Any:
        return getattr(self._star, name)


def co_partitioned(star: Star | StarOnDemand, root: str, buckets: int) -> Star | _Changed:
    """The star with its fact and properties written again in equal buckets of the listing.

    Joins of the two by listing then need no shuffle, in whichever mart or check. A bucket
    is read by one task in each scan, so ``buckets`` should be a multiple of the cores, and so
    many that a bucket of all months fits a task's memory. Listings are never hot: they have
    one row a month. Hosts may be, so the second join of the marts keeps its shuffle.
    """
    if isinstance(star, StarOnDemand):
        # tables that are not written yet go into their buckets at once
        frames = {name: (lambda df=star.frame(name): df) for name in BUCKETED}
        return _Changed(star, _write_all(frames, root, buckets))
    frames = {name: (lambda df=getattr(star, name): df) for name in BUCKETED}
    return replace(star, **_write_all(frames, root, buckets))


def _write_all(
    frames: Mapping[str, Callable[[], DataFrame | None]], root: str, buckets: int = 0
) -> dict[str, DataFrame | None]:
    """Write independent tables at the same time; their jobs share the cluster."""

    def write(name: str) -> DataFrame | None:
        df = frames[name]()
        if df is None:
            return None
        # readers of one month open one partition
        by = "month_date" if name == "fact" else None
        if not buckets or name not in BUCKETED:
            return write_table(df, root, "gold", name, by)
        # several warehouses may share a catalog
        own = f"gold_{name}_{zlib.crc32(root.encode()):08x}"
        return write_table(df, root, "gold", name, by, "listing_id", buckets, own)

    if not frames:
        return {}
    spark = SparkSession.active()
    with ThreadPoolExecutor(len(frames)) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(write), name) for name in frames}
        return {name: future.result() for name, future in running.items()}
