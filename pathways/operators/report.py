"""Compiled student file: attach, classify, project, merge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import pmax_na
from ..rules import ACT_READY, EPSO_READY, EPSO_TYPES, REPORT_NAMES, SAT_READY
from .cohort import is_counted


def attach_cohort(wide: DataFrame, cohort: DataFrame) -> DataFrame:
    """Every cohort student with the counts, if any."""
    return cohort.join(wide, "student_key", "left")


def attach_scores(df: DataFrame, scores: DataFrame) -> DataFrame:
    """Best admission-test scores, one row per student in ``scores``."""
    return df.join(scores, "student_key", "left")


def ready_status() -> Column:
    epso = reduce(lambda a, b: a + b, [F.col(t) for t in EPSO_TYPES])
    reached = (
        (F.col("act_composite_highest") >= ACT_READY)
        | (F.col("sat_total") >= SAT_READY)
        | (epso >= EPSO_READY)
    )
    return F.when(is_counted("graduates") & reached, F.lit("Y")).otherwise(F.lit("N"))


def classify_ready(df: DataFrame) -> DataFrame:
    """Ready by test score or by four opportunities; otherwise, or unknown, not."""
    return df.withColumn("readiness", ready_status())


# (report column, source column, type); no source means a typed placeholder.
REPORT_COLUMNS = (
    ("student_key", "student_key", "bigint"),
    ("first_name", "first_name", "string"),
    ("middle_name", "middle_name", "string"),
    ("last_name", "last_name", "string"),
    ("race_ethnicity", "race_ethnicity", "string"),
    ("cohortyear", "cohortyear", "int"),
    ("el", "el", "string"),
    ("swd", "swd", "string"),
    ("ed", "ed", "string"),
    ("district_no", "system", "int"),
    ("school_no", "school", "int"),
    ("included_in_cohort", "included_in_cohort", "string"),
    ("completion_type", "completion_type", "int"),
    ("sat_math", None, "int"),
    ("sat_critical_reading", None, "int"),
    ("sat_total", "sat_total", "int"),
    ("act_english", "act_english_highest", "int"),
    ("act_math", "act_math_highest", "int"),
    ("act_reading", "act_reading_highest", "int"),
    ("act_science", "act_science_highest", "int"),
    ("act_composite", "act_composite_highest", "int"),
    ("industry_cert", "ic", "bigint"),
    ("asvab", None, "int"),
    ("ncrc_work_keys", None, "string"),
    ("n_cambridge", "cie", "bigint"),
    ("n_ap", "ap", "bigint"),
    ("n_ib", "ib", "bigint"),
    ("n_sdc", "sdc", "bigint"),
    ("n_ldc", "ldc", "bigint"),
    ("n_de", "de", "bigint"),
    ("clep", "clep", "bigint"),
    ("readiness", "readiness", "string"),
)


def student_report(df: DataFrame) -> DataFrame:
    """Report columns in order; columns the inputs lack are typed nulls."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(source) if source in have else F.lit(None)).cast(kind).alias(name)
            for name, source, kind in REPORT_COLUMNS
        ]
    )


def report_names(student_table: DataFrame) -> DataFrame:
    """Student table under the report's column names."""
    return student_table.withColumnsRenamed(
        {k: v for k, v in REPORT_NAMES.items() if k in student_table.columns}
    )


MERGED = ("n_cambridge", "n_ap", "n_ib", "n_sdc", "n_ldc", "n_de", "readiness")


def merge_final(student_table: DataFrame, recalculated: DataFrame) -> DataFrame:
    """Student table and recalculation side by side, keeping the higher value.

    A value missing on either side stays missing, except the table's count of
    baccalaureate courses, which counts 0.
    """
    current = report_names(student_table).withColumn("n_ib", F.coalesce(F.col("n_ib"), F.lit(0)))
    fresh = recalculated.select("student_key", *[F.col(c).alias(f"new_{c}") for c in MERGED])
    both = current.join(fresh, "student_key", "full")
    return both.withColumns({c: pmax_na(c, f"new_{c}") for c in MERGED}).drop(
        *[f"new_{c}" for c in MERGED], "is_approved"
    )


FINAL_COLUMNS = tuple(
    name for name, _, _ in REPORT_COLUMNS if name != "completion_type"
)


def final_columns(merged: DataFrame) -> DataFrame:
    return merged.select(*[c for c in FINAL_COLUMNS if c in merged.columns])
