"""Course catalogs and the tables that map courses to types, exams and credit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nulls import as_col, join_na
from ..functions.text import first_match, has
from ..rules import CONVERSION_CREDIT, TITLE_PATTERNS, exam_rules


def courses_matching(catalog: DataFrame, pattern: str) -> DataFrame:
    """Catalog rows whose title contains the pattern, case-sensitively."""
    return catalog.where(has("course_title", pattern))


def unique_catalog(catalog: DataFrame) -> DataFrame:
    """One title per course code."""
    return catalog.groupBy("course_code").agg(F.min("course_title").alias("course_title"))


def add_title(df: DataFrame, catalog: DataFrame) -> DataFrame:
    return join_na(df, unique_catalog(catalog), ["course_code"])


def title_type(title: Column | str, patterns: dict[str, str] = TITLE_PATTERNS) -> Column:
    """Opportunity type by the first pattern the title contains."""
    title = as_col(title)
    return first_match([(has(title, p), F.lit(t)) for t, p in patterns.items()])


def exam_name_table(
    spark: SparkSession, listed: list[tuple[int, str, int]] | None = None
) -> DataFrame:
    """Course code -> exam name; of several lines with a code the first applies."""
    rows = spark.createDataFrame(
        listed or exam_rules(), "line int, exam_name string, course_code int"
    )
    return rows.groupBy("course_code").agg(F.min_by("exam_name", "line").alias("exam_name"))


def epso_crosswalk(
    catalog: DataFrame,
    exam_names: DataFrame | None = None,
    patterns: dict[str, str] = TITLE_PATTERNS,
) -> DataFrame:
    """Catalog courses of an opportunity type with their exam name, if any."""
    # The built-in table holds one row per listed code, a few hundred in all;
    # a table given by the caller is broadcast only if Spark finds it small.
    names = exam_names
    if names is None:
        names = F.broadcast(exam_name_table(catalog.sparkSession))
    typed = catalog.select(
        title_type("course_title", patterns).alias("epso_type"),
        F.col("course_code").cast("int").alias("course_code"),
        "course_title",
    ).where(F.col("epso_type").isNotNull())
    return typed.join(names, "course_code", "left").select(
        "epso_type", "course_code", "course_title", "exam_name"
    )


def crosswalk_for(crosswalk: DataFrame, epso_type: str) -> DataFrame:
    return crosswalk.where(F.col("epso_type") == epso_type)


def exam_groups(crosswalk: DataFrame) -> DataFrame:
    """Course -> the set of exam names it is listed under, as one text.

    Courses of a group are credited by the same exams, so they can be counted
    by group instead of being listed one by one. A set holds at most the names
    of the crosswalk for one code.
    """
    name = F.coalesce(F.col("exam_name"), F.lit("\0"))
    return (
        crosswalk.where(F.col("course_code").isNotNull())
        .groupBy("course_code")
        .agg(F.array_join(F.sort_array(F.collect_set(name)), "\1").alias("exam_group"))
    )


def reconcile_catalogs(catalogs: dict[str, DataFrame], pattern: str) -> DataFrame:
    """Titles of matching courses by catalog year, one row per code.

    Stacked and aggregated: one shuffle however many years are compared.
    """
    years = list(catalogs)
    tagged = [
        courses_matching(df, pattern).select(
            "course_code", "course_title", F.lit(year).alias("catalog_year")
        )
        for year, df in catalogs.items()
    ]
    return (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("course_code")
        .agg(
            *[
                F.min(F.when(F.col("catalog_year") == y, F.col("course_title"))).alias(
                    f"course_title{y}"
                )
                for y in years
            ]
        )
    )


def conversion_credit(text: Column | str) -> Column:
    """Credit stated in the conversion text."""
    text = as_col(text)
    return first_match([(has(text, p), F.lit(n)) for p, n in CONVERSION_CREDIT])


def best_conversion(df: DataFrame, text: str = "conversion") -> DataFrame:
    """Best stated credit per certification; missing when none is stated."""
    return df.groupBy("cert_name").agg(F.max(conversion_credit(text)).alias("n_epso"))
