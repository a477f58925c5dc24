"""Spells: stretches of overlapping intervals, swept in order of their begin.

An interval opens a new spell when it begins after every earlier interval of its
group has ended. The sweep keeps a running maximum of the ends; it never pairs
intervals. A group is swept in time slices, each on its own, and what a slice hands
to the next ones (the largest end, the number of spells) is carried over in a second
step that has one row for each group and slice. A group with a third of all rows is
thus dealt to as many tasks as it has slices, and intervals that begin on the same
day are combined before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.nulls import join_na, share_at_least
from ..functions.skew import join_unique
from ..rules import HALF
from ..session import reuse
from .enrollment import COURSE_DAYS, ENROLLED_DAYS, active_enrollments, ends_within_assignment

SLICE_DAYS = 366
# An open end, later than any date a table holds.
OPEN = "9999-12-31"


def _earlier(value: Column, keys: list[str], order: str) -> Column:
    """Largest value of the rows before this one."""
    return F.max(value).over(W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1))


def spell_of_days(
    df: DataFrame, keys: list[str], begin: str, end: str, slice_days: int = SLICE_DAYS
) -> DataFrame:
    """Keys, begin and number of the spell, once for each day an interval of the group begins.

    Both ends belong to an interval; a missing end never comes, an end before the
    begin counts as the begin. Intervals without a begin are left out.
    """
    reach = F.greatest(F.coalesce(F.col(end).cast("date"), F.lit(OPEN).cast("date")), F.col(begin).cast("date"))
    days = df.where(F.col(begin).isNotNull()).groupBy(*keys, begin).agg(F.max(reach).alias("_reach"))
    slices = [*keys, "_slice"]
    days = days.withColumn("_slice", F.floor(F.datediff(begin, F.lit("1970-01-01").cast("date")) / slice_days))
    days = days.withColumn("_before", _earlier(F.col("_reach"), slices, begin))
    # What earlier slices reach. One row for each group and slice.
    reached = days.groupBy(*slices).agg(F.max("_reach").alias("_reach"))
    reached = reached.select(*slices, _earlier(F.col("_reach"), keys, "_slice").alias("_carried"))
    days = join_na(days, reached.where("_carried is not null"), slices)
    opens = F.coalesce(F.col(begin) > F.greatest("_before", "_carried"), F.lit(True))
    days = days.withColumn("_opens", opens.cast("bigint"))
    so_far = W.partitionBy(*slices).orderBy(begin).rowsBetween(W.unboundedPreceding, 0)
    days = days.withColumn("_number", F.sum("_opens").over(so_far))
    opened = days.groupBy(*slices).agg(F.sum("_opens").alias("_n"))
    all_before = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    opened = opened.select(*slices, F.sum("_n").over(all_before).alias("_earlier"))
    days = join_na(days, opened.where("_earlier is not null"), slices)
    return days.select(*keys, begin, (F.col("_number") + F.coalesce("_earlier", F.lit(0))).alias("spell"))


def with_spells(
    df: DataFrame, keys: list[str], begin: str, end: str, slice_days: int = SLICE_DAYS
) -> DataFrame:
    """Rows with the number of their spell, from 1 in order of time; null without a begin."""
    return join_na(df, spell_of_days(df, keys, begin, end, slice_days), [*keys, begin])


def spells(df: DataFrame, keys: list[str], begin: str, end: str, slice_days: int = SLICE_DAYS) -> DataFrame:
    """One row per spell: its first begin, last end (null where open) and number of intervals."""
    # One row per group and day of beginning, read for the sweep and for the totals; no interval is shuffled by itself.
    days = reuse(
        df.where(F.col(begin).isNotNull())
        .groupBy(*keys, begin)
        .agg(F.count(F.lit(1)).alias("_n"), F.count(end).alias("_ended"), F.max(F.greatest(end, begin)).alias("_last"))
    )
    days = days.withColumn(end, F.when(F.col("_n") == F.col("_ended"), F.col("_last")))
    rows = with_spells(days, keys, begin, end, slice_days)
    closes = F.when(F.sum("_n") == F.sum("_ended"), F.max("_last"))
    return rows.groupBy(*keys, "spell").agg(
        F.min(begin).alias(begin), closes.alias(end), F.sum("_n").alias("n_intervals")
    )


def repeated_apart(
    segments: DataFrame, students: DataFrame, keys: tuple[str, str] = ("student_key", "course_code")
) -> DataFrame:
    """Segments of courses that a student attended by half or more in spells apart from each other.

    ``segments`` are open-ended day totals. Unlike ``repeated_segments`` this looks at
    the dates of the assignments: a course counts as repeated only where a segment
    begins after all earlier ones have ended.
    """
    kept = ends_within_assignment(
        active_enrollments(join_unique(segments, students, ["student_key"], "left_semi"))
    )
    # Each is read twice: for the sweep and its rows, for the numbers of spells and their rows.
    attended = reuse(kept.where(share_at_least(ENROLLED_DAYS, COURSE_DAYS, HALF)))
    numbered = reuse(with_spells(attended, list(keys), "sca_begin_date", "sca_end_date"))
    n_spells = numbered.groupBy(*keys).agg(F.max("spell").alias("n_spells")).where("n_spells > 1")
    return join_na(numbered, n_spells, list(keys), "inner")
