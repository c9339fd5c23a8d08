"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The cell texts a default pandas ``read_csv`` reads as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# runs of letters and digits, or runs of anything else
_WORD_RUNS = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def join_key(c: Column | str) -> Column:
    """Trimmed upper case, the form names are matched in."""
    return F.upper(F.trim(col(c)))


def title_case(c: Column | str) -> Column:
    """Upper-case the first letter after any character that is no letter or digit.

    ``F.initcap`` starts a word only after white space, which would leave
    ``BLACK-TOWN`` as ``Black-town``.
    """
    runs = F.regexp_extract_all(F.lower(col(c)), F.lit(_WORD_RUNS), F.lit(0))
    capital = F.transform(
        runs, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))
    )
    return F.array_join(capital, "")


def strip_prefix(c: Column | str, prefix: str) -> Column:
    """Remove every occurrence of ``prefix`` (``LGA10050`` -> ``10050``)."""
    return F.replace(col(c), F.lit(prefix), F.lit(""))


def is_true(c: Column | str, mark: str = "t") -> Column:
    """Text flag to a three-valued boolean; NULL stays NULL."""
    return col(c) == F.lit(mark)


def null_tokens(c: Column | str, tokens: tuple[str, ...] = NA_TOKENS) -> Column:
    """NULL for any of the missing-value texts, the cell itself otherwise."""
    return F.when(~col(c).isin(*tokens), col(c))


def string_list(
    value: str, sep: str = ", ", order: str | None = None, distinct: bool = False
) -> Column:
    """Aggregate texts of a *bounded* group (months, files, top-k rows) into one.

    ``value`` and ``order`` are SQL expressions; DISTINCT lists sort by value.
    """
    order = value if distinct or order is None else order
    kind = "DISTINCT " if distinct else ""
    return F.expr(f"listagg({kind}{value}, '{sep}') WITHIN GROUP (ORDER BY {order})")
