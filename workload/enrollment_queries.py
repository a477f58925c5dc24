"""Cohort, course and enrollment operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathways.operators import cohort as H
from pathways.operators import counts as N
from pathways.operators import crosswalk as K
from pathways.operators import enrollment as E
from pathways.operators import sorting as S
from pathways.rules import AP_PULL_COURSES, DE_PULL_COURSES
from pathways.session import reuse

from .names import PATTERNS
from .registry import query
from .tables import Bound
from .views import exam_name_sql

SEGMENT = ", ".join(E.SEGMENT_KEYS)
DAYS = "course_instructional_days, enrolled_instructional_days"
AP_CODES, DE_CODES = list(AP_PULL_COURSES), list(DE_PULL_COURSES)
LATEST = """end_date IS NULL DESC, end_date DESC NULLS LAST, begin_date DESC NULLS LAST,
  sca_end_date IS NULL DESC, sca_end_date DESC NULLS LAST, sca_begin_date DESC NULLS LAST,
  cs_end_date IS NULL DESC, cs_end_date DESC NULLS LAST, cs_begin_date DESC NULLS LAST, isp_id DESC"""
EARLIEST = """begin_date ASC NULLS LAST, end_date ASC NULLS LAST, sca_begin_date ASC NULLS LAST,
  sca_end_date ASC NULLS LAST, cs_begin_date ASC NULLS LAST, cs_end_date ASC NULLS LAST, isp_id ASC"""


def enrollments(b: Bound) -> DataFrame:
    return E.course_enrollments(b.isp, b.sca, b.cs)


def counted(b: Bound, open_ends: bool = True) -> DataFrame:
    return E.count_days(E.attach_calendar(enrollments(b), E.calendar_index(b.calendar)), open_ends)


# Day totals need the keys and the service period of an enrollment. A section's other columns
# would only add to what is shuffled: every row of a period meets the same assignments and
# sections, so they never decide which of two rows of a period describes a segment.
PERIOD = ["type_of_service", "first_name", "isp_school_year", "school_bu_id", "withdrawal_reason"]


def period_days(b: Bound) -> DataFrame:
    rows = enrollments(b).select(*E.SEGMENT_KEYS, *PERIOD)
    return E.count_days(E.attach_calendar(rows, E.calendar_index(b.calendar)))


def segments(b: Bound) -> DataFrame:
    return E.segment_days(E.fill_end_dates(reuse(period_days(b)), "global"))


def usable(b: Bound) -> DataFrame:
    return E.ends_within_assignment(E.active_enrollments(segments(b)))


def rollup(b: Bound, describe: str = "latest") -> DataFrame:
    return E.course_rollup(usable(b), describe=describe)


def attended(b: Bound) -> DataFrame:
    return E.min_share(rollup(b))


def rollup_sql(order: str, having: str = "") -> str:
    return f"""
      WITH ok AS (SELECT * FROM segments WHERE withdrawal_reason IS NULL AND (end_date IS NULL OR end_date <= sca_end_date)),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY student_key, course_code ORDER BY {order}) AS rn FROM ok)
      SELECT student_key, course_code,
        max(CASE WHEN rn = 1 THEN first_name END) AS first_name,
        max(CASE WHEN rn = 1 THEN isp_school_year END) AS isp_school_year,
        CAST(sum(enrolled_instructional_days) AS BIGINT) AS enrolled_instructional_days,
        max(course_instructional_days) AS course_instructional_days
      FROM ranked GROUP BY 1, 2 {having}"""


HALF_SQL = "HAVING sum(enrolled_instructional_days) > 0 AND sum(enrolled_instructional_days) >= 0.5 * max(course_instructional_days)"

# -- cohort -----------------------------------------------------------------

query(
    "cohort_graduates", "F1",
    "SELECT * FROM cohort WHERE included_in_cohort = 'Y' AND completion_type IN (1, 11, 12, 13)",
    lambda b: H.filter_cohort(b.cohort, "graduates"),
)
query(
    "cohort_whole", "F1", "SELECT * FROM cohort WHERE included_in_cohort = 'Y'",
    lambda b: H.filter_cohort(b.cohort, "whole"),
)
query(
    "cohort_students_of_year", "F2 U4",
    "SELECT DISTINCT student_key FROM cohort WHERE cohortyear = 2014 AND completion_type IN (1, 11, 12, 13)",
    lambda b: H.cohort_students(b.cohort, 2014, "graduates"),
)
query(
    "cohort_students_of_year_whole", "F2 U4",
    "SELECT DISTINCT student_key FROM cohort WHERE cohortyear = 2014 AND included_in_cohort = 'Y'",
    lambda b: H.cohort_students(b.cohort, 2014, "whole"),
)
query(
    "cohort_one_row_per_student", "W4",
    """SELECT * EXCLUDE (rn) FROM (
      SELECT o_custkey AS student_key, CASE WHEN o_orderpriority <> '5-LOW' THEN 'Y' ELSE 'N' END AS included_in_cohort,
        CAST(CASE WHEN o_orderstatus <> 'O' THEN 1 + o_orderkey % 13 END AS INT) AS completion_type, o_orderkey AS source_row,
        row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderpriority <> '5-LOW' THEN 'Y' ELSE 'N' END DESC,
          CASE WHEN o_orderstatus <> 'O' THEN 1 + o_orderkey % 13 END ASC NULLS LAST, o_orderkey DESC) AS rn
      FROM orders) WHERE rn = 1""",
    lambda b: H.dedupe_cohort(
        b.raw("orders").select(
            F.col("o_custkey").alias("student_key"),
            F.when(F.col("o_orderpriority") != "5-LOW", "Y").otherwise("N").alias("included_in_cohort"),
            F.when(F.col("o_orderstatus") != "O", 1 + F.col("o_orderkey") % 13).cast("int").alias("completion_type"),
            F.col("o_orderkey").alias("source_row"),
        ),
        ["source_row"],
    ),
)
query(
    "best_act_scores", "W3", "SELECT * FROM best_act", lambda b: H.best_scores(b.act),
)
query(
    "district_students", "F19", "SELECT * FROM snapshot_cur WHERE district_no = 10",
    lambda b: H.for_district(b.snapshot_cur, 10),
)
query(
    "score_columns_by_range", "F20",
    """SELECT student_key, act_composite, act_english, act_math, act_reading, act_science, asvab,
      industry_cert_earned, sat_critical_reading, sat_math, sat_total, n_cambridge, n_adv_placement,
      n_inter_baccalaureate, n_statewide_dual_credit, n_local_dual_credit, n_dual_enrollment FROM snapshot_cur""",
    lambda b: H.select_cols(
        b.snapshot_cur, first="sat_math", last="asvab", prefix=("n_",), keep=("student_key",)
    ),
)
query(
    "student_trace", "F25", "SELECT * FROM enr WHERE student_key = 7",
    lambda b: H.trace_student(enrollments(b), 7).drop("dual_enrollment"),
)
query(
    "enrollments_of_exam_takers", "J19",
    "SELECT * FROM isp WHERE student_key IN (SELECT student_id FROM exams)",
    lambda b: H.only_students(b.isp, b.exams.select(F.col("student_id").alias("student_key"))),
)

# -- catalogs and crosswalk --------------------------------------------------

query(
    "courses_by_title", "F3", "SELECT * FROM catalog WHERE regexp_matches(course_title, 'ring')",
    lambda b: K.courses_matching(b.catalog, "ring"),
)
query(
    "courses_in_ap_list", "F4", f"SELECT * FROM coded_catalog WHERE course_code IN ({', '.join(map(str, AP_CODES))})",
    lambda b: E.courses_in(b.coded_catalog, AP_CODES),
)
query(
    "courses_in_de_list", "F4", f"SELECT * FROM coded_catalog WHERE course_code IN ({', '.join(map(str, DE_CODES))})",
    lambda b: E.courses_in(b.coded_catalog, DE_CODES),
)
query(
    "courses_with_credit", "F9", "SELECT * FROM coded_catalog WHERE course_code IS NULL OR course_code NOT IN (9305, 3121)",
    lambda b: E.exclude_courses(b.coded_catalog),
)
query(
    "sections_with_listed_courses", "J6",
    "SELECT * FROM cs WHERE course_code IN (SELECT course_code FROM crosswalk)",
    lambda b: E.with_courses(b.cs, b.crosswalk),
)
query(
    "sections_without_listed_courses", "J6",
    "SELECT * FROM cs WHERE course_code NOT IN (SELECT course_code FROM crosswalk)",
    lambda b: E.without_courses(b.cs, b.crosswalk),
)
query(
    "local_dual_credit_sections", "F21", "SELECT * FROM cs WHERE local_dual_credit = 'Y'",
    lambda b: E.flagged(b.cs, "local_dual_credit"),
)
query(
    "state_dual_credit_sections", "F21", "SELECT * FROM cs WHERE state_dual_credit = 'Y'",
    lambda b: E.flagged(b.cs, "state_dual_credit"),
)
query(
    "course_titles", "J7",
    """SELECT c.*, t.course_title FROM cs c LEFT JOIN
      (SELECT course_code, min(course_title) AS course_title FROM catalog GROUP BY 1) t USING (course_code)""",
    lambda b: K.add_title(b.cs, b.catalog),
)
query(
    "epso_crosswalk", "X1",
    f"""SELECT CASE WHEN contains(course_title, 'AP') THEN 'AP' WHEN contains(course_title, 'CIE') THEN 'CIE'
        WHEN contains(course_title, 'Dual Enrollment') THEN 'DE' WHEN contains(course_title, 'IB') THEN 'IB'
        ELSE 'SDC' END AS epso_type, course_code, course_title, {exam_name_sql('course_code')} AS exam_name
      FROM coded_catalog WHERE regexp_matches(course_title, 'AP|CIE|Dual Enrollment|IB|SDC')""",
    lambda b: K.epso_crosswalk(b.coded_catalog),
)
query(
    "crosswalk_of_type", "F24", "SELECT * FROM crosswalk WHERE epso_type = 'CIE'",
    lambda b: K.crosswalk_for(b.crosswalk, "CIE"),
)
query(
    "reconciled_catalogs", "J13",
    """SELECT course_code, max(CASE WHEN y = 2019 THEN t END) AS course_title2019,
      max(CASE WHEN y = 2018 THEN t END) AS course_title2018, max(CASE WHEN y = 2017 THEN t END) AS course_title2017
    FROM (SELECT course_code, y, min(course_title) AS t
      FROM coded_catalog, (VALUES (2019, 10), (2018, 18), (2017, 26)) v(y, left_out)
      WHERE size <> left_out AND contains(course_title, 'Dual Enrollment') GROUP BY ALL)
    GROUP BY course_code""",
    lambda b: K.reconcile_catalogs(
        {
            year: b.coded_catalog.where(F.col("size") != size)
            for year, size in (("2019", 10), ("2018", 18), ("2017", 26))
        },
        "Dual Enrollment",
    ),
)
query(
    "conversion_credit", "X3",
    """SELECT cert_name, credit_text, CAST(CASE WHEN contains(credit_text, 'ONLY') THEN 2
      WHEN contains(credit_text, '1 EPSO') THEN 3 WHEN regexp_matches(credit_text, '[234] EPSO') THEN 4 END AS INT) AS credit
      FROM conversion_text""",
    lambda b: b.conversion_text.withColumn("credit", K.conversion_credit("credit_text")),
)
query("best_conversion", "A10", "SELECT * FROM conversion", lambda b: b.conversion)

# -- enrollment joins --------------------------------------------------------

query(
    "course_enrollments", "J1", "SELECT * FROM enr", enrollments,
)
query(
    "sections_with_institution", "J2",
    "SELECT cs.*, school_name FROM cs JOIN colleges ON post_secondary_institution = school_code",
    lambda b: E.with_institution(b.cs, b.colleges),
)
query(
    "instructional_calendar", "J3",
    """SELECT school_year, school_bu_id, district_no, school_no, id_date
      FROM days JOIN school USING (school_bu_id) WHERE school_year >= 1998""",
    lambda b: E.instructional_calendar(b.days, b.school, 1998),
)
query(
    "enrollment_calendar", "J4",
    """SELECT g.student_key, e.isp_id, e.course_code, e.isp_school_year, first_day, last_day, n_days
      FROM graduates g LEFT JOIN enr e USING (student_key) LEFT JOIN last_days USING (school_bu_id, isp_school_year)""",
    lambda b: E.enrollment_days(
        H.cohort_students(b.cohort, None).join(
            H.filter_cohort(b.cohort).select("student_key"), "student_key", "left_semi"
        ),
        enrollments(b),
        E.calendar_index(b.calendar),
    ).select("student_key", "isp_id", "course_code", "isp_school_year", "first_day", "last_day", "n_days"),
)
query(
    "instructional_day_counts", "J5",
    f"""SELECT isp_id, student_key, course_code, sca_begin_date, cs_begin_date, {DAYS}, n_rows FROM (
      SELECT isp_id, student_key, course_code, sca_begin_date, cs_begin_date,
        CAST(sum(n * CASE WHEN id_date BETWEEN cs_begin_date AND coalesce(cs_end_date, sca_end_date) THEN 1 ELSE 0 END) AS BIGINT) AS course_instructional_days,
        CAST(sum(n * CASE WHEN id_date BETWEEN sca_begin_date AND sca_end_date THEN 1 ELSE 0 END) AS BIGINT) AS enrolled_instructional_days,
        max(n) AS n_rows
      FROM (SELECT isp_id, student_key, school_bu_id, isp_school_year, course_code, sca_begin_date, sca_end_date, cs_begin_date, cs_end_date, count(*) AS n
        FROM enr GROUP BY ALL) e LEFT JOIN calendar k ON e.school_bu_id = k.school_bu_id AND e.isp_school_year = k.school_year
      GROUP BY isp_id, student_key, course_code, sca_begin_date, sca_end_date, cs_begin_date, cs_end_date)""",
    lambda b: counted(b, open_ends=False)
    .groupBy("isp_id", "student_key", "course_code", "sca_begin_date", "sca_end_date", "cs_begin_date", "cs_end_date")
    .agg(
        F.sum(E.COURSE_DAYS).alias(E.COURSE_DAYS),
        F.sum(E.ENROLLED_DAYS).alias(E.ENROLLED_DAYS),
        F.count("*").alias("n_rows"),
    )
    .drop("sca_end_date", "cs_end_date"),
)
query(
    "end_dates_filled_globally", "W1",
    f"SELECT {SEGMENT} FROM filled",
    lambda b: E.fill_end_dates(counted(b), "global").select(*E.SEGMENT_KEYS),
)
query(
    "end_dates_filled_by_year_and_course", "W1",
    f"""SELECT {SEGMENT} FROM (
      SELECT e.* REPLACE (coalesce(cs_end_date, sca_end_date, top) AS cs_end_date, coalesce(sca_end_date, top) AS sca_end_date)
      FROM (SELECT e.*, max(last_day) OVER (PARTITION BY isp_school_year, course_code) AS top
        FROM enr e LEFT JOIN last_days USING (school_bu_id, isp_school_year)) e)""",
    lambda b: E.fill_end_dates(
        reuse(counted(b).select(*E.SEGMENT_KEYS, "isp_school_year", "last_day")), "by_year_course"
    ).select(*E.SEGMENT_KEYS),
)
query(
    "end_dates_filled_for_class_only", "W1",
    f"SELECT {SEGMENT} FROM (SELECT e.* REPLACE (coalesce(cs_end_date, sca_end_date) AS cs_end_date) FROM enr e)",
    lambda b: E.fill_end_dates(enrollments(b), "class_only").select(*E.SEGMENT_KEYS),
)
query(
    "segment_days", "A1",
    f"SELECT {SEGMENT}, isp_school_year, withdrawal_reason, first_name, {DAYS} FROM segments",
    lambda b: segments(b).select(*E.SEGMENT_KEYS, "isp_school_year", "withdrawal_reason", "first_name", E.COURSE_DAYS, E.ENROLLED_DAYS),
)
query(
    "active_enrollments", "F6",
    "SELECT * FROM enr WHERE isp_id IS NOT NULL AND withdrawal_reason IS NULL",
    lambda b: E.active_enrollments(enrollments(b)),
)
query(
    "ended_within_assignment", "F7",
    f"SELECT {SEGMENT} FROM filled WHERE end_date IS NULL OR end_date <= sca_end_date",
    lambda b: E.ends_within_assignment(E.fill_end_dates(counted(b), "global")).select(*E.SEGMENT_KEYS),
)
query("course_rollup_latest", "A2 O1", rollup_sql(LATEST), rollup)
query("course_rollup_earliest", "A2", rollup_sql(EARLIEST), lambda b: rollup(b, "earliest"))
query("attended_half", "F8", rollup_sql(LATEST, HALF_SQL), attended)
query(
    "courses_per_student", "A3",
    f"SELECT student_key, 'ldc' AS epso_type, count(DISTINCT course_code) AS n_courses FROM ({rollup_sql(LATEST, HALF_SQL)}) GROUP BY 1",
    lambda b: N.count_courses(attended(b), "ldc"),
)
query(
    "segments_latest_first", "O1", f"SELECT {SEGMENT} FROM segments",
    lambda b: S.latest_first(segments(b).select(*E.SEGMENT_KEYS)),
)
query(
    "crosswalk_sorted", "O2", "SELECT * FROM crosswalk",
    lambda b: S.missing_last(b.crosswalk, "epso_type", "exam_name", "course_code", descending=("exam_name",)),
)
query(
    "students_at_community_colleges", "F22",
    """SELECT count(DISTINCT student_key) AS n_students FROM enr
      JOIN colleges ON post_secondary_institution = school_code WHERE school_name LIKE '%COMMUNITY COLLEGE%'""",
    lambda b: E.students_at(E.course_enrollments(b.isp, b.sca, E.with_institution(b.cs, b.colleges))),
)
query(
    "group_sizes_on_rows", "W5",
    """SELECT e.isp_id, e.student_key, e.course_code, e.sca_local_class_number, g.n, g.n_distinct FROM enr e
      JOIN (SELECT student_key, course_code, count(*) AS n, count(DISTINCT isp_id) AS n_distinct FROM enr GROUP BY 1, 2) g
      USING (student_key, course_code)""",
    lambda b: E.with_group_counts(enrollments(b), ["student_key", "course_code"], "isp_id").select(
        "isp_id", "student_key", "course_code", "sca_local_class_number", "n", "n_distinct"
    ),
)

OPEN_SEGMENTS = f"""
  SELECT isp_id, student_key, course_code, begin_date, end_date, sca_begin_date, sca_end_date, cs_begin_date,
    coalesce(cs_end_date, sca_end_date) AS cs_end_date, min(withdrawal_reason) AS withdrawal_reason,
    CAST(sum(CASE WHEN id_date >= cs_begin_date AND (id_date <= coalesce(cs_end_date, sca_end_date) OR coalesce(cs_end_date, sca_end_date) IS NULL) THEN 1 ELSE 0 END) AS BIGINT) AS course_instructional_days,
    CAST(sum(CASE WHEN id_date >= sca_begin_date AND (id_date <= sca_end_date OR sca_end_date IS NULL) THEN 1 ELSE 0 END) AS BIGINT) AS enrolled_instructional_days
  FROM enr e LEFT JOIN calendar k ON e.school_bu_id = k.school_bu_id AND e.isp_school_year = k.school_year
  GROUP BY isp_id, student_key, course_code, begin_date, end_date, sca_begin_date, sca_end_date, cs_begin_date, coalesce(cs_end_date, sca_end_date)"""
REPEATED = f"""
  SELECT s.*, c."system", c.school FROM (
    SELECT *, count(*) OVER (PARTITION BY student_key, course_code) AS n FROM ({OPEN_SEGMENTS})
    WHERE withdrawal_reason IS NULL AND (end_date IS NULL OR end_date <= sca_end_date)
      AND student_key IN (SELECT student_key FROM graduates)) s
  LEFT JOIN cohort c USING (student_key)
  WHERE n > 1 AND enrolled_instructional_days > 0 AND enrolled_instructional_days >= 0.5 * course_instructional_days"""


def repeated(b: Bound) -> DataFrame:
    opened = E.segment_days(E.fill_end_dates(period_days(b), "open_ended"))
    return E.repeated_segments(opened, b.cohort, H.counted_students(b.cohort))


query(
    "repeated_course_segments", "R12",
    f"""SELECT {SEGMENT}, n, {DAYS}, "system", school FROM ({REPEATED})""",
    lambda b: repeated(b).select(*E.SEGMENT_KEYS, "n", E.COURSE_DAYS, E.ENROLLED_DAYS, "system", "school"),
)
query(
    "repeated_courses_by_district", "A19",
    f"""SELECT "system", system_name, count(DISTINCT student_key) AS n_students, count(*) AS n_rows
      FROM ({REPEATED}) LEFT JOIN system_names USING ("system") GROUP BY 1, 2""",
    lambda b: E.by_district(repeated(b), b.system_names),
)
query(
    "flagged_course_counts", "A20",
    f"""SELECT course_code, course_title, n_students FROM (
      SELECT course_code, count(*) AS n_students FROM (
        SELECT {SEGMENT} FROM (SELECT e.* REPLACE (coalesce(cs_end_date, sca_end_date) AS cs_end_date) FROM enr e WHERE state_dual_credit = 'Y') GROUP BY ALL)
      GROUP BY 1) LEFT JOIN catalog USING (course_code)""",
    lambda b: E.flagged_course_counts(
        E.segment_days(
            E.fill_end_dates(
                E.count_days(
                    E.attach_calendar(
                        E.course_enrollments(b.isp, b.sca, E.flagged(b.cs, "state_dual_credit")),
                        E.calendar_index(b.calendar),
                    ),
                    open_ends=False,
                ),
                "class_only",
            )
        ),
        b.catalog,
    ),
)
