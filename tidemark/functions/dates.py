"""Month arithmetic and date parsing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.text import col

# Bounds of an interval without a known start or end.
FIRST_DAY = "1900-01-01"
LAST_DAY = "9999-12-31"


def period_of(file_name: Column | str) -> Column:
    """``MM_YYYY.csv`` -> first day of that month; also the calendar sort key."""
    name = col(file_name)
    year = F.substring(name, 4, 4).cast("int")
    month = F.substring(name, 1, 2).cast("int")
    return F.make_date(year, month, F.lit(1))


def month_floor(c: Column | str) -> Column:
    return F.trunc(col(c), "MM")


def previous_month(c: Column | str) -> Column:
    return F.add_months(col(c), -1)


def year_month(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM")


def parse_dmy(c: Column | str, strict: bool = True) -> Column:
    """``D/M/YYYY``, padded or not."""
    parse = F.to_date if strict else F.try_to_date
    return parse(col(c), "d/M/yyyy")


def parse_iso(c: Column | str, strict: bool = True) -> Column:
    return col(c).cast("date") if strict else col(c).try_cast("date")
