"""Counts per student and opportunity type."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import n_distinct
from ..rules import EPSO_TYPES


def count_courses(df: DataFrame, domain: str | None = None, value: str = "course_code") -> DataFrame:
    """Distinct courses per student, tagged with the opportunity type."""
    counts = df.groupBy("student_key").agg(n_distinct(value).alias("n_courses"))
    if domain is None:
        return counts
    return counts.select("student_key", F.lit(domain).alias("epso_type"), "n_courses")


def count_exams(df: DataFrame, domain: str | None = None) -> DataFrame:
    """Distinct exams per student."""
    return count_courses(df, domain, "test_longname")


def count_rows(df: DataFrame, key: str = "student_key", name: str = "n_courses") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias(name))


def merge_counts(a: DataFrame, b: DataFrame, how: str = "max") -> DataFrame:
    """Two count sources of one type: the larger count, or their sum.

    A student absent from one source counts 0 there. Both sources hold one row
    per student, so stacking and aggregating equals a full join with one
    shuffle less.
    """
    if how not in ("max", "sum"):
        raise ValueError(f"unknown merge rule: {how}")
    columns = ["student_key", "n_courses"]
    zero = F.lit(0).cast("bigint")
    stacked = a.select(columns).unionByName(b.select(columns)).withColumn(
        "n_courses", F.coalesce(F.col("n_courses"), zero)
    )
    merged = F.max("n_courses") if how == "max" else F.sum("n_courses")
    return stacked.groupBy("student_key").agg(merged.alias("n_courses"))


def stack(*frames: DataFrame) -> DataFrame:
    """Rows of differently shaped inputs; absent columns are missing."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def max_per_type(counts: DataFrame) -> DataFrame:
    """Best count per student and type."""
    return counts.groupBy("student_key", "epso_type").agg(F.max("n_courses").alias("n_courses"))


def pivot_types(counts: DataFrame, types: tuple[str, ...] = EPSO_TYPES) -> DataFrame:
    """One row per student, one column per type, holding the best count.

    Conditional maxima over the fixed types: the best count per type and the
    pivot take a single shuffle, and the column order is fixed.
    """
    return counts.groupBy("student_key").agg(
        *[F.max(F.when(F.col("epso_type") == t, F.col("n_courses"))).alias(t) for t in types]
    )


def zero_fill(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.fillna(0, columns)
