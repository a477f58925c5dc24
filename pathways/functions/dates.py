"""Date text of the operational extracts. Malformed text becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import as_col


def day_month_year(value: Column | str) -> Column:
    """``06-AUG-14`` style text to a date."""
    return F.try_to_date(F.initcap(F.lower(as_col(value))), "dd-MMM-yy")


def year_month_day(value: Column | str) -> Column:
    return F.try_to_date(as_col(value), "yyyy-MM-dd")


def year_month_day_time(value: Column | str) -> Column:
    return F.try_to_timestamp(as_col(value), F.lit("yyyy-MM-dd HH:mm:ss"))
