"""Sort orders of the files. A missing value is last unless it means "still open"."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_first(df: DataFrame) -> DataFrame:
    """By student and course, latest segment first; an open end is the latest."""
    order = [F.asc_nulls_last("student_key"), F.asc_nulls_last("course_code")]
    for kind in ("", "sca_", "cs_"):
        order += [F.desc_nulls_first(f"{kind}end_date"), F.desc_nulls_last(f"{kind}begin_date")]
    return df.orderBy(*order)


def missing_last(df: DataFrame, *columns: str, descending: tuple[str, ...] = ()) -> DataFrame:
    return df.orderBy(
        *[F.desc_nulls_last(c) if c in descending else F.asc_nulls_last(c) for c in columns]
    )
