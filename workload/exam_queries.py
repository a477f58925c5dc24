"""Exam, certification and counting operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from pathways.operators import certs as C
from pathways.operators import cohort as H
from pathways.operators import compare as Q
from pathways.operators import counts as N
from pathways.operators import exams as X
from pathways.operators.crosswalk import crosswalk_for
from pathways.plans import domains as D

from .course_sql import accepted_ctes, cert_counts_sql
from .registry import query
from .tables import Bound
from .views import standard_name_sql

AP_SQL = "test_administration_cd LIKE 'AP%'"
LEVEL = "assessment_result_number_score"


def ap_exams(b: Bound):
    return X.exams_for(b.exams, "ap")


def students(b: Bound):
    return H.counted_students(b.cohort)


# -- exams --------------------------------------------------------------------

query("exams_of_vendor", "F5", f"SELECT * FROM exams WHERE {AP_SQL}", ap_exams)
query(
    "exams_passed_ap", "F10", f"SELECT * FROM exams WHERE {AP_SQL} AND {LEVEL} IN ('3', '4', '5')",
    lambda b: X.passing(ap_exams(b), "ap", X.SCORE),
)
query(
    "exams_passed_clep", "F10",
    f"SELECT * FROM exams WHERE test_administration_cd LIKE 'CLEP%' AND TRY_CAST({LEVEL} AS DOUBLE) >= 50",
    lambda b: X.passing(X.exams_for(b.exams, "clep"), "clep", X.SCORE),
)
query(
    "exams_with_score", "F10", f"SELECT * FROM exams WHERE {LEVEL} IS NOT NULL",
    lambda b: X.passing(b.exams, "present", X.SCORE),
)
query(
    "exams_without_diploma", "F11",
    "SELECT * FROM crosswalk WHERE exam_name IS NOT NULL AND exam_name NOT LIKE '%DIPLOMA%'",
    lambda b: X.drop_diploma(b.crosswalk),
)
query(
    "exam_names_normalized", "F23",
    """SELECT * REPLACE (regexp_replace(test_administration_desc, '[-2015678]', '', 'g') AS test_administration_desc) FROM exams""",
    lambda b: X.normalize_exam_name(b.exams),
)
query(
    "exams_mapped_to_courses", "F12",
    "SELECT * FROM (SELECT * REPLACE (CASE WHEN exam_result = 'P' THEN course_code END AS course_code) FROM sdc) WHERE course_code IS NOT NULL",
    lambda b: X.mapped_only(
        b.sdc.withColumn("course_code", F.when(F.col("exam_result") == "P", F.col("course_code")))
    ),
)
query(
    "section_exam_names", "J8",
    "SELECT c.*, x.exam_name FROM cs c LEFT JOIN crosswalk x USING (course_code)",
    lambda b: X.add_exam_name(b.cs, b.crosswalk),
)


def _evidence_sql(vendor: str, name: str) -> str:
    return f"""SELECT c.student_key, c.course_code, c.exam_name, e.performance_level, e.n_exams FROM (
        SELECT DISTINCT i.student_key, s.course_code, x.exam_name FROM isp i
        JOIN (SELECT isp_id, CAST(instructional_program_num AS INT) AS course_code FROM sca) s USING (isp_id)
        LEFT JOIN crosswalk x USING (course_code)) c
      LEFT JOIN (SELECT student_id, {name} AS exam_name, {LEVEL} AS performance_level, count(*) AS n_exams
        FROM exams WHERE test_administration_cd LIKE '{vendor}%' GROUP BY 1, 2, 3) e
      ON c.student_key = e.student_id AND c.exam_name IS NOT DISTINCT FROM e.exam_name"""


def _taken(b: Bound):
    taken = b.isp.select("isp_id", "student_key").join(
        b.sca.select("isp_id", F.col("instructional_program_num").cast("int").alias("course_code")),
        "isp_id",
    )
    return X.add_exam_name(taken.select("student_key", "course_code").distinct(), b.crosswalk)


query(
    "course_exam_scores_ap", "J9", _evidence_sql("AP", "sublevel1_shortname"),
    lambda b: X.add_exam_score(_taken(b), ap_exams(b), D.AP_NAME),
)
query(
    "course_exam_scores_ib", "J9", _evidence_sql("IB", "sublevel2_shortname"),
    lambda b: X.add_exam_score(_taken(b), X.exams_for(b.exams, "ib"), D.IB_NAME),
)
query(
    "exam_only_credit", "J10",
    f"""SELECT e.student_key, count(DISTINCT x.course_code) AS n_courses FROM (
        SELECT DISTINCT student_id AS student_key, sublevel1_shortname AS exam_name FROM exams
        WHERE {AP_SQL} AND {LEVEL} IN ('3', '4', '5') AND student_id IN (SELECT student_key FROM graduates)) e
      JOIN (SELECT * FROM crosswalk WHERE epso_type = 'AP') x ON e.exam_name IS NOT DISTINCT FROM x.exam_name GROUP BY 1""",
    lambda b: X.exam_only_credit(students(b), ap_exams(b), crosswalk_for(b.crosswalk, "AP"), D.AP_NAME)
    .groupBy("student_key")
    .agg(F.sum("n_courses").alias("n_courses")),
)
query(
    "cohort_exams_inner", "J11",
    "SELECT student_id AS student_key, * EXCLUDE (student_id) FROM exams WHERE student_id IN (SELECT student_key FROM graduates)",
    lambda b: X.cohort_exams(students(b), b.exams),
)
query(
    "cohort_exams_left", "J11",
    "SELECT g.student_key, s.* EXCLUDE (student_id) FROM graduates g LEFT JOIN sdc s ON s.student_id = g.student_key",
    lambda b: X.cohort_exams(students(b), b.sdc, "left"),
)
query(
    "exams_per_student", "A4",
    "SELECT student_id AS student_key, 'clep' AS epso_type, count(DISTINCT test_longname) AS n_courses FROM exams GROUP BY 1",
    lambda b: N.count_exams(b.exams.withColumnRenamed("student_id", "student_key"), "clep"),
)
query(
    "sdc_exam_files", "U2", "SELECT * FROM sdc", lambda b: b.sdc,
)
query(
    "district_record_match", "J21",
    """SELECT r.student_key, r.first_name, e.* EXCLUDE (student_id) FROM snapshot_cur r
      LEFT JOIN exams e ON e.student_id = r.student_key WHERE r.district_no = 3""",
    lambda b: X.match_records(H.for_district(b.snapshot_cur, 3).select("student_key", "first_name"), b.exams),
)
query(
    "courses_against_exams", "A18",
    """SELECT coalesce(student_key, student_id) AS student_key, n_courses, n_exams FROM
      (SELECT student_key, count(DISTINCT course_code) AS n_courses FROM enr GROUP BY 1) c
      FULL JOIN (SELECT student_id, count(DISTINCT sublevel1_shortname) + max(CASE WHEN sublevel1_shortname IS NULL THEN 1 ELSE 0 END) AS n_exams
        FROM exams GROUP BY 1) e ON student_key = student_id""",
    lambda b: X.courses_vs_exams(
        b.isp.select("isp_id", "student_key").join(
            b.sca.select("isp_id", F.col("instructional_program_num").alias("course_code")), "isp_id"
        ),
        b.exams,
        D.AP_NAME,
    ),
)

# -- counts -------------------------------------------------------------------

REPORTED = "SELECT student_id AS student_key, count(*) AS n_courses FROM college_reported GROUP BY 1"
PERIODS = "SELECT student_key, count(*) AS n_courses FROM isp GROUP BY 1"


def _reported(b: Bound):
    return N.count_rows(b.college_reported.withColumnRenamed("student_id", "student_key"))


def _merged_sql(rule: str) -> str:
    return f"""SELECT coalesce(a.student_key, b.student_key) AS student_key,
      {rule.format(a='coalesce(a.n_courses, 0)', b='coalesce(b.n_courses, 0)')} AS n_courses
      FROM ({PERIODS}) a FULL JOIN ({REPORTED}) b ON a.student_key = b.student_key"""


query("rows_per_student", "A5", REPORTED, _reported)
query(
    "merged_counts_max", "J12", _merged_sql("greatest({a}, {b})"),
    lambda b: N.merge_counts(N.count_rows(b.isp), _reported(b), "max"),
)
query(
    "merged_counts_sum", "J12", _merged_sql("{a} + {b}"),
    lambda b: N.merge_counts(N.count_rows(b.isp), _reported(b), "sum"),
)

VENDOR_TYPE = "CASE WHEN test_administration_cd LIKE 'AP%' THEN 'ap' WHEN test_administration_cd LIKE 'IB%' THEN 'ib' ELSE 'clep' END"
STACKED = f"""SELECT student_id AS student_key, {VENDOR_TYPE} AS epso_type, {LEVEL} AS detail, count(*) AS n_courses FROM exams GROUP BY ALL
  UNION ALL SELECT student_key, 'de', NULL, count(*) FROM isp GROUP BY 1"""


def _stacked(b: Bound):
    vendor = F.lower(F.regexp_extract("test_administration_cd", "^([A-Z]+)_", 1))
    by_level = b.exams.groupBy(
        F.col("student_id").alias("student_key"), vendor.alias("epso_type"), F.col(X.SCORE).alias("detail")
    ).agg(F.count("*").alias("n_courses"))
    return N.stack(by_level, N.count_rows(b.isp).withColumn("epso_type", F.lit("de")))


TYPES = ("ap", "cie", "clep", "de", "ib", "ic", "ldc", "sdc")
PIVOT = ", ".join(f"max(CASE WHEN epso_type = '{t}' THEN n_courses END) AS {t}" for t in TYPES)
query("stacked_counts", "U1", STACKED, _stacked)
query(
    "best_count_per_type", "A6",
    f"SELECT student_key, epso_type, max(n_courses) AS n_courses FROM ({STACKED}) GROUP BY 1, 2",
    lambda b: N.max_per_type(_stacked(b)),
)
query(
    "counts_pivoted", "A7", f"SELECT student_key, {PIVOT} FROM ({STACKED}) GROUP BY 1",
    lambda b: N.pivot_types(_stacked(b)),
)
query(
    "counts_zero_filled", "F15",
    f"SELECT student_key, {', '.join(f'coalesce({t}, 0) AS {t}' for t in TYPES)} FROM (SELECT student_key, {PIVOT} FROM ({STACKED}) GROUP BY 1)",
    lambda b: N.zero_fill(N.pivot_types(_stacked(b)), list(TYPES)),
)

# -- certifications -----------------------------------------------------------

query(
    "certs_not_failed", "F13",
    "SELECT * FROM certs WHERE pass_fail IS NULL OR pass_fail NOT IN ('Fail', 'FAIL', 'No', '--')",
    lambda b: C.drop_failed(b.certs),
)
query(
    "cert_standard_names", "X2",
    f"SELECT *, {standard_name_sql('cert_name')} AS standard_name FROM certs",
    lambda b: C.standardize_cert(b.certs),
)
query(
    "cert_standard_names_whole", "X2",
    f"SELECT *, {standard_name_sql('cert_name', 'whole')} AS standard_name FROM certs",
    lambda b: C.standardize_cert(b.certs, "whole"),
)


def _named(b: Bound):
    return C.standardize_cert(C.drop_failed(C.numeric_student(b.certs)))


LOOKED_UP = f"""SELECT n.*, a.new_cert, a.pass_fail AS pass_rule, coalesce(v.n_epso, w.n_epso) AS n_epso FROM (
    SELECT *, CAST(TRY_CAST(student_id AS DOUBLE) AS BIGINT) AS student_key, {standard_name_sql('cert_name')} AS standard_name FROM certs
    WHERE TRY_CAST(student_id AS DOUBLE) IS NOT NULL AND (pass_fail IS NULL OR pass_fail NOT IN ('Fail', 'FAIL', 'No', '--'))) n
  LEFT JOIN (SELECT * FROM approved WHERE promoted = 'x') a ON n.cert_name IS NOT DISTINCT FROM a.cert_name AND n.source_file = a.source_file
  LEFT JOIN conversion v ON n.standard_name IS NOT DISTINCT FROM v.cert_name
  LEFT JOIN conversion w ON a.new_cert IS NOT DISTINCT FROM w.cert_name"""


def _looked_up(b: Bound):
    return C.lookup_credit(_named(b), b.approved, b.conversion)


query("cert_credit_lookup", "J14", LOOKED_UP, _looked_up)
query(
    "certs_accepted", "F14",
    f"""SELECT * FROM ({LOOKED_UP}) WHERE pass_rule IS NULL OR pass_rule = 'Pass'
      OR (CAST(trunc(TRY_CAST(test_score AS DOUBLE)) AS INT) >= 70 AND contains(pass_rule, '70'))""",
    lambda b: C.accept_certs(_looked_up(b)),
)
query(
    "cert_bundle_credit", "A8",
    f"""SELECT student_key, 'ic' AS epso_type, CAST(4 AS BIGINT) AS n_courses FROM ({LOOKED_UP})
      WHERE contains(standard_name, 'CPT') GROUP BY 1 HAVING count(DISTINCT cert_name) = 4""",
    lambda b: C.bundle_credit(_looked_up(b)),
)
query(
    "cert_credit", "A9", f"WITH {accepted_ctes('graduates')} {cert_counts_sql('graduates')}",
    lambda b: C.cert_credit(D.accepted_certs(b.inputs)),
)
query(
    "cert_credit_legacy_bundle", "A9", f"WITH {accepted_ctes('graduates')} {cert_counts_sql('graduates', True)}",
    lambda b: C.cert_credit(D.accepted_certs(b.inputs), legacy_bundle=True),
)
RECORD = "student_key, order_no, line_no, cert_name, max(n_epso) AS n_epso"
query(
    "cert_credit_by_record", "W2",
    f"""SELECT student_key, order_no, line_no, cert_name,
        CASE WHEN row_number() OVER (PARTITION BY student_key ORDER BY n_epso DESC NULLS LAST, order_no DESC, line_no DESC, cert_name DESC) = 1
          THEN n_epso ELSE n_epso - 1 END AS n_epso
      FROM (SELECT {RECORD} FROM ({LOOKED_UP}) WHERE cert_name IS NOT NULL GROUP BY 1, 2, 3, 4)""",
    lambda b: C.decrement_after_first(
        _looked_up(b)
        .where(F.col("cert_name").isNotNull())
        .groupBy("student_key", "order_no", "line_no", "cert_name")
        .agg(F.max("n_epso").alias("n_epso")),
        "n_epso",
        ["order_no", "line_no", "cert_name"],
    ),
)

TEXT_CREDIT = "CASE o_orderstatus WHEN 'F' THEN '1 credit' WHEN 'P' THEN '2 credits' ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'Industry Certification' END END"
RECODED = f"""SELECT coalesce(t.student_key, c.student_key) AS student_key, t.n_recoded, c.n_courses,
    c.n_courses <> t.n_recoded AS mismatch
  FROM (SELECT student_key, CAST(coalesce(sum(CASE WHEN contains(epso_ic, '1') THEN 3 WHEN contains(epso_ic, '2') THEN 2
      WHEN epso_ic = 'Industry Certification' THEN 4 END), 0) AS BIGINT) AS n_recoded
    FROM (SELECT o_custkey AS student_key, {TEXT_CREDIT} AS epso_ic FROM orders) GROUP BY 1) t
  FULL JOIN ic c ON t.student_key = c.student_key"""
IC = f"WITH {accepted_ctes('graduates')}, ic AS MATERIALIZED ({cert_counts_sql('graduates')})"


def _recoded(b: Bound):
    status = F.col("o_orderstatus")
    text = (
        F.when(status == "F", "1 credit")
        .when(status == "P", "2 credits")
        .when(F.col("o_orderkey") % 2 == 0, "Industry Certification")
    )
    records = b.raw("orders").select(F.col("o_custkey").alias("student_key"), text.alias("epso_ic"))
    return C.recode_and_compare(records, D.ic_counts(b.inputs))


query("cert_credit_recoded", "A21", f"{IC} {RECODED}", _recoded)
query(
    "records_of_first_mismatches", "O3",
    f"""{IC} SELECT * FROM isp WHERE student_key IN (
      SELECT student_key FROM ({RECODED}) WHERE mismatch ORDER BY student_key LIMIT 5)""",
    lambda b: Q.first_mismatches(_recoded(b), b.isp),
)
