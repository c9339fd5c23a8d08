"""Data-quality checks and reconciliation.

A check returns a small DataFrame: offending rows, or one row of figures. Checks
on one table share one scan where they can. ``as_text`` renders figures as the
familiar ``a / b`` lines.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.dates import period_of, year_month
from tidemark.functions.numbers import thousands
from tidemark.functions.text import string_list
from tidemark.operators.joins import (
    current_join,
    not_in,
    salted_join,
    side_by_side,
    unmatched,
)
from tidemark.operators.pointintime import Hot, count_versions
from tidemark.operators.topk import top_k



def union_checks(*checks: DataFrame) -> DataFrame:
    """Single-row checks as rows of one table."""
    return reduce(DataFrame.unionByName, checks)


def as_text(check: DataFrame, name: str) -> DataFrame:
    """One row of figures as ``check_name`` and ``result`` (``a / b / c``)."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("none")) for c in check.columns]
    return check.select(F.lit(name).alias("check_name"), F.concat_ws(" / ", *parts).alias("result"))


# --- declared column tests ---------------------------------------------------


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs do not count."""
    known = df.filter(F.col(column).isNotNull())
    return known.groupBy(column).agg(F.count("*").alias("n")).filter("n > 1")


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """NULLs per column, in one scan."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def relationships(
    df: DataFrame, fk: str, dim: DataFrame, pk: str, hot: Sequence = ()
) -> DataFrame:
    """Rows whose key is set but missing in the other table."""
    return unmatched(df.filter(F.col(fk).isNotNull()), dim.select(pk).distinct(), (fk, pk), hot)


def column_tests(
    tables: Mapping[str, DataFrame],
    unique_keys: Mapping[str, Sequence[str]],
    required: Mapping[str, Sequence[str]],
    references: Sequence[tuple[str, str, str, str]] = (),
) -> DataFrame:
    """All declared tests as rows (table, column, test, failures), from one scan per table.

    The tested columns of a row become (column, value) pairs, which are counted; columns that are
    only tested for NULL have one value for all that is known. A value that comes twice is no
    unique one, the pair without a value counts the NULLs, and a key and the keys it refers to
    meet by their value.
    """
    tests: list[tuple[str, str, str]] = []
    roles: dict[tuple[str, str], list[tuple[int, str]]] = {}

    def declare(test: str, *columns: tuple[str, str, str]) -> None:
        for table, column, role in columns:
            roles.setdefault((table, column), []).append((len(tests), role))
        tests.append((*columns[0][:2], test))

    for test, declared, role in (
        ("unique", unique_keys, "unique"), ("not_null", required, "known")
    ):
        for table, columns in declared.items():
            for c in columns:
                declare(test, (table, c, role))
    for table, fk, target, pk in references:
        declare("relationships", (table, fk, "key"), (target, pk, "listed"))

    numbers = {column: i for i, column in enumerate(roles)}
    pairs = []
    for name, df in tables.items():
        values = []
        for (table, c), uses in roles.items():
            if table == name:
                value = F.col(c).cast("string")
                if all(role == "known" for _, role in uses):
                    value = F.when(F.col(c).isNotNull(), F.lit(""))
                values.append(F.struct(F.lit(numbers[table, c]).alias("column"), value.alias("value")))
        if values:
            pairs.append(df.select(F.inline(F.array(*values))))
    spec = F.create_map(*[
        x
        for column, uses in roles.items()
        for x in (
            F.lit(numbers[column]),
            F.array(*[F.struct(F.lit(t).alias("test"), F.lit(r).alias("role")) for t, r in uses]),
        )
    ])
    counted = reduce(DataFrame.unionAll, pairs).groupBy("column", "value").agg(
        F.count("*").alias("n")
    )
    used = counted.select("value", "n", F.inline(F.element_at(spec, F.col("column"))))
    known, role, n = F.col("value").isNotNull(), F.col("role"), F.col("n")
    by_value = F.when(role.isin("key", "listed"), F.col("value"))
    met = used.groupBy("test", by_value.alias("by_value")).agg(
        F.sum(
            F.when((role == "unique") & known & (n > 1), 1)
            .when((role == "known") & ~known, n)
            .otherwise(0)
        ).alias("failures"),
        F.sum(F.when((role == "key") & known, n).otherwise(0)).alias("referring"),
        F.max((role == "listed") & known).alias("listed"),
    )
    lost = F.when(F.col("listed"), 0).otherwise(F.col("referring"))
    per_test = met.groupBy("test").agg(F.sum(F.col("failures") + lost).alias("failures"))
    names = counted.sparkSession.createDataFrame(
        [(i, *test) for i, test in enumerate(tests)],
        "number INT, table_name STRING, column_name STRING, test_name STRING",
    )
    # as many rows as there are tests; those of empty tables fail nowhere
    return names.join(F.broadcast(per_test), F.col("number") == F.col("test"), "left").select(
        "table_name",
        "column_name",
        F.col("test_name").alias("test"),
        F.coalesce("failures", F.lit(0)).alias("failures"),
    )


# --- versions ----------------------------------------------------------------


def one_version(
    fact: DataFrame,
    dims: Mapping[str, tuple[DataFrame, str]],
    hot: Mapping[str, Hot] = {},
    rows: Sequence[str] = ("listing_id", "month_date"),
    at: str = "month_date",
    apart: bool = False,
) -> DataFrame:
    """Fact rows that do not match exactly one version; empty when all is well."""
    return count_versions(fact, dims, rows, at, hot, apart).filter("nb_versions <> 1")


def version_histogram(
    fact: DataFrame,
    dim: DataFrame,
    on: str,
    rows: Sequence[str] = ("listing_id", "scraped_date"),
    hot: Hot = (),
    at: str = "month_date",
) -> DataFrame:
    """How many fact rows match 0, 1, or more versions."""
    n = F.col("nb_versions")
    return count_versions(fact, {on: (dim, on)}, rows, at, {on: hot}).agg(
        F.count_if(n == 0).alias("none"),
        F.count_if(n == 1).alias("one"),
        F.count_if(n > 1).alias("many"),
    )


def version_counts(history: DataFrame, key: str) -> DataFrame:
    """Versions, entities and open versions; the last two must agree."""
    return history.agg(
        F.count("*").alias("versions"),
        F.count_distinct(key).alias("entities"),
        F.count_if(F.col("valid_to").isNull()).alias("current"),
    )


def changed_count(history: DataFrame, key: str, attribute: str) -> DataFrame:
    """Entities whose attribute took more than one value."""
    per_key = history.groupBy(key).agg(F.min(attribute).alias("a"), F.max(attribute).alias("b"))
    return per_key.agg(F.count_if(F.col("a") != F.col("b")).alias("changed"))


def multi_current(dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Entities with more than one current version, over all dimensions."""
    counts = [
        dim.filter("is_current").groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
        .select(F.lit(name).alias("dimension"))
        for name, (dim, key) in dims.items()
    ]
    return union_checks(*counts).agg(F.count("*").alias("entities"))


def rebuild_counts(mart: DataFrame, *histories: DataFrame) -> DataFrame:
    """Months in the mart and versions in each history, side by side."""
    months = mart.agg(F.count_distinct("month_year").alias("months"))
    counts = [h.agg(F.count("*").alias(f"versions_{i}")) for i, h in enumerate(histories, 1)]
    return side_by_side(months, *counts)


# --- tables and files --------------------------------------------------------


def tables_present(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Each expected table or view and whether the catalog knows it."""
    known = [(n, spark.catalog.tableExists(n)) for n in sorted(names)]
    return spark.createDataFrame(known, "table_name STRING, present BOOLEAN")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_checks(
        *[
            df.agg(F.count("*").alias("nb_rows")).select(F.lit(n).alias("table_name"), "nb_rows")
            for n, df in tables.items()
        ]
    )


def compare_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    return side_by_side(
        a.agg(F.count("*").alias("left_rows")), b.agg(F.count("*").alias("right_rows"))
    ).withColumn("passed", F.col("left_rows") == F.col("right_rows"))


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows per file and when they were loaded; a file loaded once has one load time."""
    return df.groupBy("source_file").agg(
        F.count("*").alias("nb_rows"),
        F.min("loaded_at").alias("first_load"),
        F.max("loaded_at").alias("last_load"),
    )


def date_span_per_file(raw: DataFrame, column: str = "scraped_date") -> DataFrame:
    """First and last date inside each file and the number of months it touches."""
    return (
        raw.groupBy("source_file")
        .agg(
            F.min(column).alias("first_scrape"),
            F.max(column).alias("last_scrape"),
            F.count_distinct(F.left(F.col(column).cast("string"), F.lit(7))).alias(
                "nb_months_inside"
            ),
            F.count("*").alias("nb_rows"),
        )
        .orderBy(period_of("source_file"))
    )


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)


def load_calendar(raw: DataFrame, silver: DataFrame, mart: DataFrame) -> DataFrame:
    """Rows per file in calendar order, and the months of silver and mart.

    The lists have one entry per month, so they stay short whatever the rows.
    """
    files = raw.groupBy("source_file").agg(F.count("*").alias("n"))
    files = files.select(
        F.concat("source_file", F.lit(" = "), F.col("n").cast("string")).alias("entry"),
        period_of("source_file").alias("period"),
    ).agg(string_list("entry", order="period").alias("rows_per_file"))
    months = [
        df.select(year_month(c).alias("m")).distinct().agg(string_list("m").alias(name))
        for df, c, name in (
            (silver, "month_date", "silver_months"),
            (mart, "month_year", "mart_months"),
        )
    ]
    return side_by_side(files, *months)


# --- values ------------------------------------------------------------------


def duplicate_count(df: DataFrame, *key: str) -> DataFrame:
    """``rows - distinct keys``; a composite key counts even with NULL parts."""
    column = F.col(key[0]) if len(key) == 1 else F.struct(*key)
    return df.agg((F.count("*") - F.count_distinct(column)).alias("duplicates"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return not_null(df, *columns)


def null_drift(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column before and after cleaning; more after means a failed cast."""
    sides = []
    for df, side in ((before, "before"), (after, "after")):
        sides.append(
            df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_{side}") for c in columns])
        )
    return side_by_side(*sides)


def ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    wanted: list[Column] = []
    for c in columns:
        wanted += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.agg(*wanted)


def flag_distribution(df: DataFrame, column: str) -> DataFrame:
    flag = F.col(column)
    return df.agg(
        F.count_if(flag).alias("true_rows"),
        F.count_if(~flag).alias("false_rows"),
        F.count_if(flag.isNull()).alias("null_rows"),
    )


def outliers(df: DataFrame, column: str, high: float) -> DataFrame:
    value = F.col(column)
    return df.agg(
        F.count_if(value == 0).alias(f"{column}_zero"),
        F.count_if(value > high).alias(f"{column}_over_{high:g}"),
    )


def missing_keys(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """Keys that are not in the other table, with SQL NOT IN's treatment of NULL."""
    return not_in(df.select(column), column, other, other_column)


# --- keys between tables -----------------------------------------------------


def unmatched_names(df: DataFrame, name: str, dim: DataFrame, key: str) -> DataFrame:
    """Distinct names without a match, one per row.

    Names are made distinct before the join, so its size is the number of names.
    """
    names = df.select(name).distinct()
    return unmatched(names, dim, (F.upper(name), key))


def unmatched_top(
    df: DataFrame, name: str, dim: DataFrame, key: str, n: int = 15
) -> DataFrame:
    """The n most frequent names without a match."""
    counted = df.filter(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("nb_rows"))
    lost = unmatched(counted, dim, (F.upper(name), key))
    return top_k(lost, F.col("nb_rows").desc(), n, [F.col(name)])


def unmatched_rate(df: DataFrame, name: str, dim: DataFrame, key: str) -> DataFrame:
    """Rows with a name that finds no match, rows without a name, all rows."""
    counted = df.groupBy(F.upper(name).alias("_name")).agg(F.count("*").alias("_n"))
    keys = dim.select(F.col(key).alias("_dim_key")).distinct()
    keys = keys.withColumn("_hit", F.lit(1))
    joined = salted_join(counted, keys, "_name", "_dim_key", "left")
    rows = F.col("_n")
    zero = F.lit(0)
    return joined.agg(
        F.coalesce(
            F.sum(F.when(F.col("_hit").isNull() & F.col("_name").isNotNull(), rows)), zero
        ).alias("unmatched"),
        F.coalesce(F.sum(F.when(F.col("_name").isNull(), rows)), zero).alias("nameless"),
        F.coalesce(F.sum(rows), zero).alias("all_rows"),
    )


def key_difference(a: DataFrame, key_a: str, b: DataFrame, key_b: str) -> DataFrame:
    """Keys of either table that the other one lacks, with the side they are on."""
    only_a = unmatched(a.select(F.col(key_a).alias("key")), b, ("key", key_b))
    only_b = unmatched(b.select(F.col(key_b).alias("key")), a, ("key", key_a))
    return union_checks(
        only_a.withColumn("side", F.lit("left")), only_b.withColumn("side", F.lit("right"))
    )


def resolution_rate(dim: DataFrame, name: str, ref: DataFrame, key: str, code: str) -> DataFrame:
    """Versions whose name resolves to a code through the current reference rows."""
    wanted = ref.select(key, code, "is_current")
    joined = current_join(dim.select(name), wanted, (F.upper(name), key), "left")
    return joined.agg(F.count(code).alias("resolved"), F.count("*").alias("all_rows"))


def fact_coverage(fact: DataFrame, ref: DataFrame, key: str) -> DataFrame:
    """Fact rows, rows without the key, rows whose key has reference data."""
    per_key = fact.groupBy(key).agg(F.count("*").alias("_n"))
    known = ref.groupBy(F.col(key).alias("_ref")).agg(F.count("*").alias("_copies"))
    joined = salted_join(per_key, known, key, "_ref", "left")
    return joined.agg(
        F.sum("_n").alias("fact_rows"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), F.lit(0)).alias("without_key"),
        F.coalesce(F.sum(F.col("_n") * F.col("_copies")), F.lit(0)).alias("with_reference"),
    )


# --- reconciliation ----------------------------------------------------------


def period_total(fact: DataFrame, period: str, column: str = "estimated_revenue") -> DataFrame:
    """One month's total as a number and as text with thousands separators."""
    month = fact.filter(F.col("month_date") == F.lit(period).cast("date"))
    return month.agg(F.sum(column).alias("total")).withColumn("total_text", thousands("total"))


def reconcile(
    left: DataFrame, left_sum: Column, right: DataFrame, right_sum: Column, tolerance: float = 0
) -> DataFrame:
    """A total in two tables; ``tolerance`` is relative, for totals of rounded values."""
    both = side_by_side(
        left.agg(left_sum.alias("left_total")), right.agg(right_sum.alias("right_total"))
    )
    gap = F.abs(F.col("left_total") - F.col("right_total")).cast("double")
    limit = F.abs(F.col("left_total")).cast("double") * tolerance
    return both.withColumn("passed", gap <= limit)


def reconcile_distinct(
    fact: DataFrame, mart: DataFrame, period: str, unknown: str = "Unknown"
) -> DataFrame:
    """Hosts of one month in the fact, summed over the mart's groups, and in the unknown group."""
    day = F.lit(period).cast("date")
    hosts = fact.filter(F.col("month_date") == day).agg(
        F.count_distinct("host_id").alias("fact_hosts")
    )
    here = mart.filter(F.col("month_year") == day)
    lost = F.col("host_neighbourhood_lga") == unknown
    groups = here.agg(
        F.sum("distinct_hosts").alias("mart_hosts"),
        F.sum(F.when(lost, F.col("distinct_hosts"))).alias("unknown_hosts"),
    )
    return side_by_side(hosts, groups)


def top_groups_text(mart: DataFrame, k: int = 3) -> DataFrame:
    """The k best rows of the mart as one text."""
    metric = "avg_estimated_revenue_per_active_listing"
    group = "listing_neighbourhood"
    best = top_k(
        mart.select(group, "month_year", metric),
        F.col(metric).desc_nulls_last(),
        k,
        [F.col(group), F.col("month_year")],
    )
    text = f"concat({group}, ' ($', cast({metric} as string), ')')"
    return best.agg(
        string_list(text, order=f"{metric} DESC NULLS LAST, {group}, month_year").alias("top")
    )


def filled_count(mart: DataFrame, column: str) -> DataFrame:
    """Rows in which a column has a value."""
    return mart.agg(F.count(column).alias("filled"))
