"""Course enrollments: joins, instructional days, segments and roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.nulls import as_col, join_na, not_in_keep_null, share_at_least, sum0
from ..functions.nulls import n_distinct as count_values
from ..functions.skew import join_unique
from ..rules import HALF, NON_CREDIT_COURSES
from ..session import reuse

SECTION_KEYS = ["instructional_program_num", "local_class_number", "school_bu_id", "school_year"]
SEGMENT_KEYS = [
    "isp_id", "student_key", "course_code", "begin_date", "end_date",
    "sca_begin_date", "sca_end_date", "cs_begin_date", "cs_end_date",
]
COURSE_DAYS = "course_instructional_days"
ENROLLED_DAYS = "enrolled_instructional_days"


# -- joins ------------------------------------------------------------------


def course_enrollments(isp: DataFrame, sca: DataFrame, cs: DataFrame, join=join_unique) -> DataFrame:
    """Service period x class assignment x class section.

    Filter the sides before calling: sections by course, periods by student.
    Assignments meet the sections first since that join is the more selective.
    Both joins keep the many side on the left, where a hot section or a hot
    service period can be split; ``join_measured`` as ``join`` splits them by
    their own counts, without adaptive execution.
    """
    periods = isp.withColumnRenamed("school_year", "isp_school_year")
    return join(assigned_sections(sca, cs, join), periods, ["isp_id"], "inner")


def enrollments_of_periods(isp: DataFrame, sca: DataFrame, cs: DataFrame, join=join_unique) -> DataFrame:
    """The rows of ``course_enrollments`` for some of the periods only.

    The assignments meet the periods first, so that those of other periods go at the
    first join and need no shuffle of their own to be filtered.
    """
    periods = isp.withColumnsRenamed({"school_year": "isp_school_year", "school_bu_id": "isp_school_bu_id"})
    taken = join(sca, periods, ["isp_id"], "inner")
    return assigned_sections(taken, cs, join).withColumnRenamed("isp_school_bu_id", "school_bu_id")


def assigned_sections(sca: DataFrame, cs: DataFrame, join=join_unique) -> DataFrame:
    """Class assignments with their section, years and numbers told apart by side."""
    return (
        join(sca, cs, SECTION_KEYS, "inner")
        .withColumn("cs_school_year", F.col("school_year"))
        .withColumnsRenamed(
            {"school_year": "sca_school_year", "local_class_number": "sca_local_class_number"}
        )
        .drop("school_bu_id", "instructional_program_num")
    )


def with_institution(cs: DataFrame, colleges: DataFrame) -> DataFrame:
    """Sections taught with a listed college, with its name."""
    names = colleges.withColumnRenamed("school_code", "post_secondary_institution")
    return cs.join(names, "post_secondary_institution", "inner")


def instructional_calendar(
    days: DataFrame, school: DataFrame, min_year: int | None = None
) -> DataFrame:
    """Instructional days with district and school numbers, from ``min_year`` on."""
    if min_year is not None:
        days = days.where(F.col("school_year") >= min_year)
    return days.join(school, "school_bu_id", "inner").select(
        "school_year", "school_bu_id", "district_no", "school_no", "id_date"
    )


def calendar_index(calendar: DataFrame) -> DataFrame:
    """One row per (school, year) with the running number of days by month and day.

    ``months`` lists the months that have calendar rows and ``running`` holds 31
    values for each: the number of calendar rows dated up to that day of the
    month, repeated rows counting each time. The days in any range are then the
    difference of two values, so no enrollment is ever multiplied by the days of
    its school year. Months without rows are not filled in: a misdated row adds
    one month, wherever it lies. Repeats collapse to a count per date first. The index
    is written, so that its size is known when a join with it is planned: a small one is
    broadcast at once and the enrollments are not shuffled for it.
    """
    key = ["school_bu_id", "school_year"]
    by_date = W.partitionBy(*key).orderBy("id_date")
    dates = (
        calendar.where(F.col("id_date").isNotNull())
        .groupBy(*key, "id_date")
        .agg(F.count("*").alias("n"))
        .select(*key, "id_date", month_number("id_date").alias("month"), "n", F.sum("n").over(by_date).alias("so_far"))
    )
    day = F.struct(F.dayofmonth("id_date").alias("day"), "so_far")
    months = dates.groupBy(*key, "month").agg(
        F.min("id_date").alias("first_day"),
        F.max("id_date").alias("last_day"),
        F.max("so_far").alias("n_days"),
        F.min(F.col("so_far") - F.col("n")).alias("before"),
        F.collect_list(day).alias("days"),
    )
    # The days of a month: at most 31 rows, each value holding until the next.
    values = F.transform(
        F.sequence(F.lit(1), F.lit(31)),
        lambda d: F.coalesce(
            F.array_max(F.transform(F.filter("days", lambda x: x["day"] <= d), lambda x: x["so_far"])), F.col("before")
        ),
    )
    in_order = F.sort_array(F.collect_list(F.struct("month", values.alias("values"))))
    return reuse(
        months.groupBy(*key)
        .agg(
            F.min("first_day").alias("first_day"),
            F.max("last_day").alias("last_day"),
            F.max("n_days").alias("n_days"),
            in_order.alias("by_month"),
        )
        .select(
            *key,
            "first_day",
            "last_day",
            "n_days",
            F.col("by_month.month").alias("months"),
            F.flatten("by_month.values").alias("running"),
        )
    )


def month_number(day: Column | str) -> Column:
    return F.year(day) * 12 + F.month(day)


def attach_calendar(enrollments: DataFrame, index: DataFrame, how: str = "left", join=join_unique) -> DataFrame:
    """Enrollments with the calendar of their school and school year."""
    return join(
        enrollments,
        index.withColumnRenamed("school_year", "isp_school_year"),
        ["school_bu_id", "isp_school_year"],
        how,
    )


def enrollment_days(students: DataFrame, courses: DataFrame, index: DataFrame, join=join_unique) -> DataFrame:
    """Cohort students, their courses if any, and the calendar of each course."""
    # The courses, the many side, stay on the left; students without one are added.
    courses = reuse(courses)
    taken = join(courses, students, ["student_key"], "inner")
    without = students.join(courses.select("student_key").distinct(), "student_key", "left_anti")
    columns = [*students.columns, *[c for c in courses.columns if c != "student_key"]]
    return attach_calendar(taken.unionByName(without, allowMissingColumns=True).select(*columns), index, join=join)


def days_between(begin: Column | str, end: Column | str) -> Column:
    """Instructional days in [begin, end]; 0 when a date or the calendar is missing."""
    begin, end = as_col(begin), as_col(end)

    def up_to(day: Column) -> Column:
        month = month_number(day)
        at = F.array_position("months", month).cast("int")
        # No row in that month: the earlier months count whole. Built-in functions without a
        # lambda only, so that the arrays stay out of the rows of a fused stage.
        earlier = F.size(F.array_except("months", F.sequence(month, F.element_at("months", -1))))
        absent = (
            F.when(month < F.get("months", F.lit(0)), F.lit(0))
            .when(month > F.element_at("months", -1), F.col("n_days"))
            .otherwise(F.get("running", earlier * 31 - 1))
        )
        return F.when(at > 0, F.get("running", at * 31 - 32 + F.dayofmonth(day))).otherwise(absent)

    inside = up_to(end) - up_to(F.date_sub(begin, 1))
    return F.coalesce(F.when(begin <= end, inside), F.lit(0)).cast("bigint")


def count_days(enrollments: DataFrame, open_ends: bool = True) -> DataFrame:
    """Days of the class section and of the student's assignment.

    A missing section end falls back to the assignment end. With ``open_ends``
    a still missing end runs to the end of the school's calendar. That gives
    the same count as any later fill date, so the days are counted before the
    dates are filled and the arrays leave the row at once. Without it a missing
    end counts no days.
    """
    last = F.col("last_day") if open_ends else F.lit(None).cast("date")
    section_end = F.coalesce("cs_end_date", "sca_end_date", last)
    own_end = F.coalesce(F.col("sca_end_date"), last)
    return enrollments.withColumns(
        {
            COURSE_DAYS: days_between("cs_begin_date", section_end),
            ENROLLED_DAYS: days_between("sca_begin_date", own_end),
        }
    ).drop("running", "months", "first_day", "n_days")


def fill_end_dates(
    enrollments: DataFrame, scope: str = "global", within: tuple[str, ...] = ()
) -> DataFrame:
    """Fill missing end dates.

    *global*: the last day of any calendar the rows touch; *by_year_course*: the
    last one of the same school year and course; *class_only* and *open_ended*:
    only the section end, from the assignment end. ``within`` names columns that
    separate independent sets of rows handled together. The last days come from
    an aggregate, never from a window over the whole set.
    """
    section_end = [F.col("cs_end_date"), F.col("sca_end_date")]
    if scope in ("class_only", "open_ended"):
        return enrollments.withColumn("cs_end_date", F.coalesce(*section_end))
    keys = list(within)
    if scope == "by_year_course":
        keys += ["isp_school_year", "course_code"]
    elif scope != "global":
        raise ValueError(f"unknown fill scope: {scope}")
    if keys:
        last = enrollments.groupBy(*keys).agg(F.max("last_day").alias("fill_date"))
        # An assignment that has its end needs no date: only the others are dealt out by scope.
        ended = enrollments.where(F.col("sca_end_date").isNotNull())
        opened = enrollments.where(F.col("sca_end_date").isNull())
        filled = join_na(opened, last, keys).unionByName(ended.withColumn("fill_date", F.lit(None).cast("date")))
    else:
        last = enrollments.agg(F.max("last_day").alias("fill_date"))
        filled = enrollments.withColumn("fill_date", last.scalar())
    return filled.withColumns(
        {
            "cs_end_date": F.coalesce(*section_end, "fill_date"),
            "sca_end_date": F.coalesce("sca_end_date", "fill_date"),
        }
    ).drop("fill_date")


# -- course lists -----------------------------------------------------------


def courses_in(df: DataFrame, codes) -> DataFrame:
    """Rows of a fixed list of course codes."""
    return df.where(F.col("course_code").isin(*codes))


def with_courses(df: DataFrame, listed: DataFrame) -> DataFrame:
    """Rows whose course is in a list held as a table."""
    return df.join(listed.select("course_code"), "course_code", "left_semi")


def without_courses(df: DataFrame, listed: DataFrame, keep_null: bool = False) -> DataFrame:
    """Rows whose course is not listed; a missing code is dropped as SQL does."""
    if not keep_null:
        df = df.where(F.col("course_code").isNotNull())
    return df.join(listed.select("course_code"), "course_code", "left_anti")


def exclude_courses(df: DataFrame, codes=NON_CREDIT_COURSES) -> DataFrame:
    """Drop courses that carry no credit; a missing code stays."""
    return df.where(not_in_keep_null("course_code", codes))


def flagged(df: DataFrame, flag: str) -> DataFrame:
    return df.where(F.col(flag) == "Y")


def students_at(enrollments: DataFrame, like: str = "%COMMUNITY COLLEGE%") -> DataFrame:
    """Number of students in courses of colleges with such a name."""
    return enrollments.where(F.col("school_name").like(like)).agg(
        F.count_distinct("student_key").alias("n_students")
    )


# -- row rules --------------------------------------------------------------


def active_enrollments(df: DataFrame) -> DataFrame:
    """Rows with an enrollment that was not withdrawn."""
    return df.where(F.col("isp_id").isNotNull() & F.col("withdrawal_reason").isNull())


def ends_within_assignment(df: DataFrame) -> DataFrame:
    """Enrollment still open, or ended no later than the class assignment."""
    return df.where(F.col("end_date").isNull() | (F.col("end_date") <= F.col("sca_end_date")))


def min_share(df: DataFrame, share: float = HALF) -> DataFrame:
    """Enrolled for at least this share of the course."""
    return df.where(share_at_least(ENROLLED_DAYS, COURSE_DAYS, share))


# -- aggregation ------------------------------------------------------------


def segment_days(df: DataFrame) -> DataFrame:
    """Day totals of rows with the same student, course and dates.

    The other columns come from the row with the smallest values, so the choice
    does not depend on row order. Unused ones are pruned from the plan.
    """
    others = [
        c for c in df.columns if c not in {*SEGMENT_KEYS, COURSE_DAYS, ENROLLED_DAYS, "last_day"}
    ]
    sums = [sum0(COURSE_DAYS).alias(COURSE_DAYS), sum0(ENROLLED_DAYS).alias(ENROLLED_DAYS)]
    if not others:
        return df.groupBy(*SEGMENT_KEYS).agg(*sums)
    out = df.groupBy(*SEGMENT_KEYS).agg(F.min(F.struct(*others)).alias("_first"), *sums)
    return out.select(
        *SEGMENT_KEYS, *[F.col(f"_first.{c}").alias(c) for c in others], COURSE_DAYS, ENROLLED_DAYS
    )


def _latest_order() -> Column:
    """Largest for the latest segment; an open end is later than any date."""
    parts = []
    for kind in ("", "sca_", "cs_"):
        end, begin = f"{kind}end_date", f"{kind}begin_date"
        parts += [F.col(end).isNull().alias(f"{end}_open"), F.col(end), F.col(begin)]
    return F.struct(*parts, F.col("isp_id"))


def _earliest_order() -> Column:
    """Smallest for the earliest segment; a missing date comes last."""
    parts = []
    for kind in ("", "sca_", "cs_"):
        for name in (f"{kind}begin_date", f"{kind}end_date"):
            parts += [F.col(name).isNull().alias(f"{name}_missing"), F.col(name)]
    return F.struct(*parts, F.col("isp_id"))


def course_rollup(
    df: DataFrame, within: tuple[str, ...] = (), describe: str = "latest"
) -> DataFrame:
    """Segments to one row per student and course.

    Enrolled days add up, course days take the largest segment. Names and year
    come from the latest segment (or the earliest), chosen inside the aggregate.
    """
    keys = [*within, "student_key", "course_code"]
    wanted = [
        c for c in ("first_name", "middle_name", "last_name", "isp_school_year") if c in df.columns
    ]
    sums = [
        sum0(ENROLLED_DAYS).alias(ENROLLED_DAYS),
        F.max(COURSE_DAYS).alias(COURSE_DAYS),
    ]
    if not wanted:
        return df.groupBy(*keys).agg(*sums)
    chosen = (
        F.max_by(F.struct(*wanted), _latest_order())
        if describe == "latest"
        else F.min_by(F.struct(*wanted), _earliest_order())
    )
    out = df.groupBy(*keys).agg(chosen.alias("_row"), *sums)
    return out.select(
        *keys, *[F.col(f"_row.{c}").alias(c) for c in wanted], ENROLLED_DAYS, COURSE_DAYS
    )


def with_group_counts(
    df: DataFrame, keys: list[str], distinct: str, n: str = "n", n_distinct: str = "n_distinct"
) -> DataFrame:
    """Rows with the size and the distinct count of their group.

    The counts are aggregated and joined back: a hot group is combined before
    the shuffle and its rows stay spread, unlike under a window.
    """
    counts = df.groupBy(*keys).agg(
        F.count("*").alias(n),
        count_values(distinct).alias(n_distinct),
    )
    return join_na(df, counts, list(keys))


def repeated_segments(segments: DataFrame, cohort: DataFrame, students: DataFrame) -> DataFrame:
    """Segments of courses a student took more than once, attended by half or more.

    ``segments`` are open-ended day totals; every row of a group has the same
    course, so the group repeats when it holds more than one row.
    """
    kept = ends_within_assignment(
        active_enrollments(join_unique(segments, students, ["student_key"], "left_semi"))
    )
    kept = reuse(kept)  # read for the counts and for the rows
    counted = with_group_counts(kept, ["student_key", "course_code"], "course_code")
    repeated = min_share(counted.where(F.col("n_distinct") != F.col("n")))
    place = [c for c in ("system", "school") if c in cohort.columns]
    return join_unique(repeated, cohort.select("student_key", *place), ["student_key"])


def by_district(df: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Students and rows per district, with its name when names are given."""
    counts = df.groupBy("system").agg(
        F.count_distinct("student_key").alias("n_students"), F.count("*").alias("n_rows")
    )
    return counts if names is None else join_na(counts, names, ["system"])


def flagged_course_counts(enrollments: DataFrame, catalog: DataFrame) -> DataFrame:
    """Segments per flagged course, with the course title."""
    counts = (
        enrollments.where(F.col("course_code").isNotNull())
        .groupBy("course_code")
        .agg(F.count("*").alias("n_students"))
    )
    return counts.join(catalog, "course_code", "left").select(
        "course_code", "course_title", "n_students"
    )
