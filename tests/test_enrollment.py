import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import d, rows
from pathways.operators import cohort as H
from pathways.operators import enrollment as E
from workload.tables import Bound

CALENDAR = "school_bu_id long, school_year int, id_date date"
ENROLLMENT = (
    "isp_id long, student_key long, isp_school_year int, school_bu_id long, "
    "withdrawal_reason int, begin_date date, end_date date, course_code int, "
    "sca_begin_date date, sca_end_date date, cs_begin_date date, cs_end_date date"
)


def calendar(spark):
    days = [d(1, n) for n in (2, 3, 3, 6, 7)] + [d(2, 3)]
    rows_ = [(1, 2014, x) for x in days] + [(2, 2014, d(3, 10)), (2, 2014, None), (3, 2013, d(5, 1, 2013))]
    return spark.createDataFrame(rows_, CALENDAR)


def enrollment(spark, *changes):
    base = {
        "isp_id": 1, "student_key": 10, "isp_school_year": 2014, "school_bu_id": 1,
        "withdrawal_reason": None, "begin_date": d(1, 1), "end_date": None, "course_code": 100,
        "sca_begin_date": d(1, 3), "sca_end_date": d(1, 6), "cs_begin_date": d(1, 1), "cs_end_date": d(1, 31),
    }
    names = list(base)
    return spark.createDataFrame([tuple({**base, **c}[n] for n in names) for c in changes], ENROLLMENT)


def by_join(enr, cal):
    """Day counts by multiplying every enrollment by its calendar."""
    k = cal.withColumnRenamed("school_year", "isp_school_year")
    joined = enr.join(k, ["school_bu_id", "isp_school_year"], "left")
    inside = lambda a, b: F.coalesce(F.sum(F.when(F.col("id_date").between(F.col(a), F.col(b)), 1)), F.lit(0))
    return joined.groupBy(*[c for c in enr.columns]).agg(
        inside("cs_begin_date", "cs_end_date").alias(E.COURSE_DAYS),
        inside("sca_begin_date", "sca_end_date").alias(E.ENROLLED_DAYS),
    )


def counted(spark, *changes, open_ends=True):
    enr = enrollment(spark, *changes)
    return E.count_days(E.attach_calendar(enr, E.calendar_index(calendar(spark))), open_ends)


def test_index_counts_repeated_days(spark):
    index = E.calendar_index(calendar(spark)).where("school_bu_id = 1").first()
    assert (index.first_day, index.last_day, index.n_days) == (d(1, 2), d(2, 3), 6)
    assert index.months == [2014 * 12 + 1, 2014 * 12 + 2] and len(index.running) == 2 * 31
    assert index.running[:7] == [0, 1, 3, 3, 3, 4, 5]


def test_a_misdated_day_adds_one_month(spark):
    far = calendar(spark).unionByName(spark.createDataFrame([(1, 2014, d(12, 31, 9999))], CALENDAR))
    plain, more = (E.calendar_index(c).where("school_bu_id = 1").first() for c in (calendar(spark), far))
    assert len(more.months) == len(plain.months) + 1 and len(more.running) == len(plain.running) + 31
    assert more.n_days == plain.n_days + 1


def test_days_match_the_exploded_join(spark):
    span = [d(1, 1) + dt.timedelta(days=n) for n in range(0, 40, 3)]
    changes = [
        {"isp_id": i * 100 + j, "cs_begin_date": a, "cs_end_date": b, "sca_begin_date": b, "sca_end_date": a}
        for i, a in enumerate(span)
        for j, b in enumerate(span)
    ]
    changes.append({"isp_id": 1, "school_bu_id": 9})
    changes.append({"isp_id": 2, "cs_begin_date": None, "sca_begin_date": None})
    enr = enrollment(spark, *changes)
    keep = ["isp_id", E.COURSE_DAYS, E.ENROLLED_DAYS]
    assert rows(counted(spark, *changes), *keep) == rows(by_join(enr, calendar(spark)), *keep)


def test_open_end_runs_to_the_last_day(spark):
    change = {"sca_end_date": None, "cs_end_date": None}
    assert rows(counted(spark, change), E.COURSE_DAYS, E.ENROLLED_DAYS) == [(6, 5)]
    assert rows(counted(spark, change, open_ends=False), E.COURSE_DAYS, E.ENROLLED_DAYS) == [(0, 0)]


def test_section_end_falls_back_to_assignment(spark):
    out = counted(spark, {"cs_end_date": None}, open_ends=False)
    assert rows(out, E.COURSE_DAYS, E.ENROLLED_DAYS) == [(4, 3)]


def test_fill_scopes(spark):
    changes = (
        {"isp_id": 1, "cs_end_date": None, "sca_end_date": None},
        {"isp_id": 2, "cs_end_date": None},
        {"isp_id": 3, "school_bu_id": 2, "course_code": 200, "cs_end_date": None, "sca_end_date": None},
    )
    keep = ["isp_id", "cs_end_date", "sca_end_date"]
    counts = counted(spark, *changes)
    top, own = d(3, 10), d(2, 3)
    assert rows(E.fill_end_dates(counts, "global"), *keep) == [(1, top, top), (2, d(1, 6), d(1, 6)), (3, top, top)]
    assert rows(E.fill_end_dates(counts, "by_year_course"), *keep) == [(1, own, own), (2, d(1, 6), d(1, 6)), (3, top, top)]
    assert rows(E.fill_end_dates(counts, "class_only"), *keep) == [(1, None, None), (2, d(1, 6), d(1, 6)), (3, None, None)]
    with pytest.raises(ValueError):
        E.fill_end_dates(counts, "other")


def test_count_before_fill_equals_count_after_fill(spark):
    changes = (
        {"isp_id": 1, "cs_end_date": None, "sca_end_date": None},
        {"isp_id": 2, "school_bu_id": 2, "sca_end_date": None},
        {"isp_id": 3, "sca_end_date": None},
    )
    ours = E.fill_end_dates(counted(spark, *changes), "global")
    filled = ours.drop(E.COURSE_DAYS, E.ENROLLED_DAYS, "last_day")
    keep = ["isp_id", E.COURSE_DAYS, E.ENROLLED_DAYS]
    assert rows(ours, *keep) == rows(by_join(filled, calendar(spark)), *keep)


def test_equal_dates_merge_into_one_segment(spark):
    filled = E.fill_end_dates(counted(spark, {}, {}, {"cs_end_date": d(2, 1)}), "class_only")
    assert rows(E.segment_days(filled), E.COURSE_DAYS, E.ENROLLED_DAYS) == [(10, 6), (5, 3)]


def test_rollup_adds_enrolled_and_takes_largest_course(spark):
    changes = (
        {"isp_id": 1, "end_date": d(2, 1)},
        {"isp_id": 2, "isp_school_year": 2013, "school_bu_id": 3, "cs_begin_date": d(4, 1, 2013),
         "cs_end_date": d(6, 1, 2013), "sca_begin_date": d(4, 1, 2013), "sca_end_date": d(6, 1, 2013)},
    )
    segments = E.segment_days(E.fill_end_dates(counted(spark, *changes), "class_only"))
    latest = E.course_rollup(segments)
    assert rows(latest, "student_key", "course_code", "isp_school_year", E.ENROLLED_DAYS, E.COURSE_DAYS) == [(10, 100, 2013, 4, 5)]
    earliest = E.course_rollup(segments, describe="earliest")
    assert rows(earliest, "isp_school_year") == [(2014,)]


def test_half_share_edges(spark):
    df = spark.createDataFrame([(1, 2), (0, 0), (4, 0), (1, 3)], f"{E.ENROLLED_DAYS} int, {E.COURSE_DAYS} int")
    assert rows(E.min_share(df)) == [(1, 2), (4, 0)]


def test_row_rules(spark):
    df = enrollment(
        spark,
        {"isp_id": 1}, {"isp_id": None}, {"isp_id": 3, "withdrawal_reason": 1},
        {"isp_id": 4, "end_date": d(1, 6)}, {"isp_id": 5, "end_date": d(1, 7)},
        {"isp_id": 6, "end_date": d(1, 7), "sca_end_date": None},
    )
    assert rows(E.active_enrollments(df), "isp_id") == [(1,), (4,), (5,), (6,)]
    assert rows(E.ends_within_assignment(E.active_enrollments(df)), "isp_id") == [(1,), (4,)]


def test_course_lists_and_missing_codes(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "course_code int")
    listed = spark.createDataFrame([(1,)], "course_code int")
    assert rows(E.with_courses(df, listed)) == [(1,)]
    assert rows(E.without_courses(df, listed)) == [(2,)]
    assert rows(E.without_courses(df, listed, keep_null=True)) == [(2,), (None,)]
    assert rows(E.exclude_courses(df, (1,))) == [(2,), (None,)]
    assert rows(E.courses_in(df, (1, 9))) == [(1,)]


def test_repeated_course_needs_two_segments(spark):
    changes = ({"isp_id": 1}, {"isp_id": 2, "course_code": 200}, {"isp_id": 3, "course_code": 200, "begin_date": d(1, 2)})
    segments = E.segment_days(E.fill_end_dates(counted(spark, *changes), "open_ended"))
    cohort = spark.createDataFrame([(10, 5, 6)], "student_key long, system int, school int")
    out = E.repeated_segments(segments, cohort, cohort.select("student_key"))
    assert rows(out, "isp_id", "n", "system") == [(2, 2, 5), (3, 2, 5)]


def test_known_totals_of_the_supplied_tables(spark, small):
    """Recorded totals, on a calendar of the first ten suppliers only."""
    b = Bound(spark, small)
    cal = b.days.where("school_bu_id < 10").distinct()
    periods = b.isp.join(H.counted_students(b.cohort), "student_key", "left_semi")
    enr = E.count_days(E.attach_calendar(E.course_enrollments(periods, b.sca, b.cs), E.calendar_index(cal)))
    segments = E.segment_days(E.fill_end_dates(enr, "global"))
    courses = E.course_rollup(E.ends_within_assignment(E.active_enrollments(segments)))
    attended = E.min_share(courses)
    students = attended.select("student_key").distinct()
    assert (courses.count(), attended.count(), students.count()) == (3307, 2394, 118)
