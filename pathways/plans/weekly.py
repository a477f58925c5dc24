"""Weekly status of appeals by district."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from ..functions.nulls import to_number
from ..operators import monitor as M
from ..rules import SCORE_COLUMNS
from ..sources.readers import snapshot_of
from ..sources.writers import write_snapshot


def score_columns(df: DataFrame) -> DataFrame:
    """Key, untouched, and the score columns as numbers."""
    have = [c for c in SCORE_COLUMNS if c in df.columns]
    return df.select("student_key", *[to_number(c).alias(c) for c in have])


def weekly_appeals(
    current: DataFrame, previous: DataFrame, original: DataFrame, documents: DataFrame
) -> DataFrame:
    """Changed students and uploaded documents with review flags."""
    changes = M.changed_rows(*[score_columns(df) for df in (current, previous, original)])
    places = [c for c in ("district_no", "school_no") if c in current.columns]
    status = M.appeal_status(changes, documents, current.select("student_key", *places))
    return M.appeal_flags(status)


def weekly_status(
    current: DataFrame,
    previous: DataFrame,
    original: DataFrame,
    documents: DataFrame,
    names: DataFrame,
) -> DataFrame:
    """District totals of the review flags."""
    appeals = weekly_appeals(current, previous, original, documents)
    return M.status_by_district(M.with_district_name(appeals, names))


def weekly_run(
    current: DataFrame, folder: str, day: dt.date | str, original: DataFrame, documents: DataFrame, names: DataFrame
) -> DataFrame:
    """One week's run: keep this week's table, compare it with the newest earlier one.

    Writes ``current`` as the snapshot of ``day``, so that a rerun replaces its
    own week only, and returns the district totals of what changed since the
    newest snapshot before ``day``. The first run compares with ``original``.
    """
    write_snapshot(current, folder, str(day))
    previous = snapshot_of(current.sparkSession, folder, day)
    return weekly_status(current, original if previous is None else previous, original, documents, names)
