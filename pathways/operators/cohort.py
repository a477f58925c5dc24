"""Cohort rows: who is counted, and which row of a student is used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.skew import join_unique
from ..rules import GRADUATE_TYPES


def is_counted(mode: str) -> Column:
    """*graduates*: included and completed; *whole*: included."""
    included = F.col("included_in_cohort") == "Y"
    if mode == "whole":
        return included
    if mode == "graduates":
        return included & F.col("completion_type").isin(*GRADUATE_TYPES)
    raise ValueError(f"unknown cohort mode: {mode}")


def filter_cohort(cohort: DataFrame, mode: str = "graduates") -> DataFrame:
    return cohort.where(is_counted(mode))


def counted_students(cohort: DataFrame, mode: str = "graduates") -> DataFrame:
    """Keys of the counted students, each once."""
    return filter_cohort(cohort, mode).select("student_key").distinct()


def cohort_students(history: DataFrame, cohort_year: int | None, mode: str = "graduates") -> DataFrame:
    """Distinct students of one cohort year for the database pull.

    The graduates' pull looks at the completion type only.
    """
    kept = (
        history.where(F.col("completion_type").isin(*GRADUATE_TYPES))
        if mode == "graduates"
        else history.where(is_counted(mode))
    )
    if cohort_year is not None:
        kept = kept.where(F.col("cohortyear") == cohort_year)
    return kept.select("student_key").distinct()


def _best_row(df: DataFrame, key: str, order: Column) -> DataFrame:
    """One row per key, the one with the largest ``order``, as an aggregate.

    Partial aggregation keeps one candidate per task, so a key with very many
    rows never has to be sorted in one place as a row_number would.
    """
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return best.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def dedupe_cohort(cohort: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """One row per student: included first, then the lowest completion type."""
    ties = tie_break or [c for c in cohort.columns if c != "student_key"]
    order = F.struct(
        F.col("included_in_cohort"), (-F.col("completion_type")).alias("_type"), *ties
    )
    return _best_row(cohort, "student_key", order)


def best_scores(act: DataFrame) -> DataFrame:
    """Best sitting per student.

    Composite, math, reading and English descending, science ascending; a
    missing score ranks last. Remaining ties go to the larger SAT total.
    """
    have = set(act.columns)
    down = [
        f"act_{s}_highest"
        for s in ("composite", "math", "reading", "english")
        if f"act_{s}_highest" in have
    ]
    order = [F.col(c) for c in down]
    if "act_science_highest" in have:
        order.append((-F.col("act_science_highest")).alias("_science"))
    order.append(F.col("sat_total"))
    kept = [c for c in act.columns if c.endswith("_highest") or c == "sat_total"]
    return _best_row(act.select("student_key", *kept), "student_key", F.struct(*order))


def for_district(df: DataFrame, number: int, column: str = "district_no") -> DataFrame:
    return df.where(F.col(column) == number)


def trace_student(df: DataFrame, key: int) -> DataFrame:
    return df.where(F.col("student_key") == key)


def only_students(df: DataFrame, ids: DataFrame, join=join_unique) -> DataFrame:
    """Rows of students found in another list."""
    return join(df, ids.select("student_key"), ["student_key"], "left_semi")


def select_cols(
    df: DataFrame,
    *,
    first: str | None = None,
    last: str | None = None,
    prefix: tuple[str, ...] = (),
    suffix: tuple[str, ...] = (),
    without: tuple[str, ...] = (),
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Columns by position range, prefix or suffix, after the named ones."""
    names = df.columns
    picked = set()
    if first or last:
        lo = names.index(first) if first else 0
        hi = names.index(last) if last else len(names) - 1
        picked |= set(names[lo : hi + 1])
    picked |= {n for n in names if prefix and n.startswith(prefix)}
    picked |= {n for n in names if suffix and n.endswith(suffix)}
    picked -= {n for n in names if any(w in n for w in without)}
    return df.select(*keep, *[n for n in names if n in picked and n not in keep])
