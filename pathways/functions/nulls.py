"""Missing-value rules of the indicator, written as Column expressions.

The business rules were defined in a language whose missing values behave
differently from SQL nulls. Each helper states one of those rules.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Key = str | tuple[str, str]


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def n_distinct(value: Column | str) -> Column:
    """Aggregate: distinct values, a missing value counting as one more."""
    c = as_col(value)
    return F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))


def sum0(value: Column | str) -> Column:
    """Aggregate: sum of the present values, 0 when there is none."""
    c = as_col(value)
    return F.coalesce(F.sum(c), F.lit(0))


def pmax_na(a: Column | str, b: Column | str) -> Column:
    """Larger of two values, missing when either is missing."""
    a, b = as_col(a), as_col(b)
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def share_at_least(part: Column | str, whole: Column | str, share: float) -> Column:
    """``part / whole >= share`` without dividing.

    A positive part of an empty whole passes, nothing of nothing does not.
    """
    part, whole = as_col(part), as_col(whole)
    return (part > 0) & (part >= F.lit(share) * whole)


def not_in_keep_null(value: Column | str, excluded) -> Column:
    """Exclusion list that lets missing values through."""
    c = as_col(value)
    return c.isNull() | ~c.isin(*excluded)


def to_number(value: Column | str) -> Column:
    return as_col(value).try_cast("double")


def to_whole(value: Column | str) -> Column:
    """Text or number to a whole number, truncating; missing if not numeric."""
    return as_col(value).try_cast("double").try_cast("int")


def total_of(columns, null_as_zero: bool) -> Column:
    """Row-wise sum; missing addends count 0 or make the total missing."""
    parts = [F.coalesce(F.col(c), F.lit(0)) if null_as_zero else F.col(c) for c in columns]
    return reduce(lambda a, b: a + b, parts)


def join_na(left: DataFrame, right: DataFrame, on: list[Key], how: str = "left") -> DataFrame:
    """Equi join in which a missing key matches a missing key.

    ``on`` holds column names or (left, right) pairs. The result keeps the left
    names of the keys; on a full join they are filled from the right side.
    """
    pairs = [(k, k) if isinstance(k, str) else k for k in on]
    mark = {r: f"__right_{r}" for _, r in pairs}
    marked = right.withColumnsRenamed(mark)
    condition = reduce(
        lambda a, b: a & b,
        [F.col(l).eqNullSafe(F.col(mark[r])) for l, r in pairs],
    )
    joined = left.join(marked, condition, how)
    if how in ("full", "right"):
        joined = joined.withColumns(
            {l: F.coalesce(F.col(l), F.col(mark[r])) for l, r in pairs}
        )
    return joined.drop(*mark.values())
