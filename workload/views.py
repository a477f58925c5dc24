"""The bound tables in SQL, for the reference engine. Mirrors ``tables.py``."""

from __future__ import annotations

import re

from pathways.rules import CERT_NAMES, CERT_NAMES_GRADUATES, EXAM_COURSES

from .names import SNAPSHOT_SCORES, VENDOR_CERTS
from .tables import STANDARD_CERTS


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def pick(values: tuple[str, ...], at: str) -> str:
    listed = ", ".join(quoted(v) for v in values)
    return f"([{listed}])[CAST({at} % {len(values)} AS INT) + 1]"


def _cert_test(column: str, kind: str, texts: tuple[str, ...], without: str | None) -> str:
    if kind == "is":
        return f"{column} = {quoted(texts[0])}"
    tests = [f"regexp_matches({column}, {quoted(p)})" for p in texts]
    if without:
        tests.append(f"NOT regexp_matches({column}, {quoted(without)})")
    return f"({' AND '.join(tests)})"


def standard_name_sql(column: str, mode: str = "graduates") -> str:
    rules = CERT_NAMES + (CERT_NAMES_GRADUATES if mode == "graduates" else ())
    whens = " ".join(f"WHEN {_cert_test(column, *rule)} THEN {quoted(name)}" for name, *rule in rules)
    return f"CASE {whens} ELSE {column} END"


def exam_name_sql(column: str) -> str:
    whens = [f"WHEN {column} IN ({', '.join(map(str, codes))}) THEN {quoted(name)}" for name, codes in EXAM_COURSES]
    return f"CASE {' '.join(whens)} END"


def jan10(year: str, days: str) -> str:
    return f"make_date({year}, 1, 10) + CAST({days} AS INT)"


_YEAR = "CAST(year(o_orderdate) AS INT)"
_STUDENT_OF_EVENT = "user_id * 10 + event_id % 10"
_VENDOR = pick(VENDOR_CERTS + ("",), "p_partkey")
_SCORES = ", ".join(
    f"CASE WHEN c_custkey % {gap} <> 0 THEN CAST({base} + (c_custkey * {step}) % {span} AS INT) END AS {name}"
    for name, (gap, span, step, base) in SNAPSHOT_SCORES.items()
)


def _sdc(where: str) -> str:
    return f"""SELECT CAST(event_id % 400 AS INT) AS course_code, {_STUDENT_OF_EVENT} AS student_id,
      CASE WHEN value >= 20 THEN value END AS exam_score, CAST(50.0 AS DOUBLE) AS exam_cut_score,
      CASE WHEN value >= 50 THEN 'P' ELSE 'F' END AS exam_result, CAST(user_id % 25 AS INT) AS "system"
    FROM events WHERE {where}"""


def _history(view: str, day: str) -> str:
    return f"""SELECT student_key, district_no, n_cambridge, n_adv_placement, readiness,
      DATE '{day}' AS file_time FROM {view}"""


VIEWS: dict[str, str] = {
    "cohort": """
        SELECT c_custkey AS student_key, c_name AS first_name, 2013 + c_nationkey % 3 AS cohortyear,
          c_nationkey AS "system", CAST(c_custkey % 10 AS INT) AS school,
          CASE WHEN c_acctbal < 0 THEN 'N' ELSE 'Y' END AS included_in_cohort,
          CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 11
            WHEN 'HOUSEHOLD' THEN 12 WHEN 'FURNITURE' THEN 13 ELSE 3 END AS INT) AS completion_type
        FROM customer""",
    "graduates": """
        SELECT DISTINCT student_key FROM cohort
        WHERE included_in_cohort = 'Y' AND completion_type IN (1, 11, 12, 13)""",
    "included": "SELECT DISTINCT student_key FROM cohort WHERE included_in_cohort = 'Y'",
    "isp": f"""
        SELECT o_orderkey AS isp_id, o_custkey AS student_key, o_orderstatus AS type_of_service,
          o_orderpriority AS first_name, {_YEAR} AS school_year, o_custkey % 10 AS school_bu_id,
          CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END AS INT) AS withdrawal_reason,
          make_date({_YEAR}, 1, 5) AS begin_date,
          CASE WHEN o_orderstatus = 'F' THEN {jan10(_YEAR, '130')} END AS end_date
        FROM orders""",
    "sca": f"""
        SELECT o_orderkey AS isp_id, l_partkey AS instructional_program_num,
          l_linenumber AS local_class_number, o_custkey % 10 AS school_bu_id, {_YEAR} AS school_year,
          {jan10(_YEAR, 'l_linenumber * 7 + 2 * l_quantity')} AS sca_begin_date,
          CASE WHEN l_returnflag <> 'N' THEN {jan10(_YEAR, 'l_linenumber * 7 + 110')} END AS sca_end_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "cs": f"""
        SELECT DISTINCT instructional_program_num, local_class_number, school_bu_id, school_year,
          CAST(instructional_program_num AS INT) AS course_code,
          {jan10('school_year', 'local_class_number * 7')} AS cs_begin_date,
          CASE WHEN instructional_program_num % 4 <> 0
            THEN {jan10('school_year', 'local_class_number * 7 + 120')} END AS cs_end_date,
          CASE WHEN instructional_program_num % 7 = 0 THEN 'Y' ELSE 'N' END AS state_dual_credit,
          CASE WHEN instructional_program_num % 5 = 0 THEN 'Y' ELSE 'N' END AS local_dual_credit,
          CAST(instructional_program_num % 40 AS VARCHAR) AS post_secondary_institution
        FROM sca""",
    "days": """
        SELECT l_suppkey AS school_bu_id, CAST(year(l_shipdate) AS INT) AS school_year,
          CAST(l_shipdate AS DATE) AS id_date FROM lineitem""",
    "school": """
        SELECT s_suppkey AS school_bu_id, s_nationkey AS district_no,
          CAST(s_suppkey % 7 AS INT) AS school_no FROM supplier""",
    "calendar": "SELECT DISTINCT school_bu_id % 10 AS school_bu_id, school_year, id_date FROM days",
    "colleges": """
        SELECT CAST(n_nationkey AS VARCHAR) AS school_code,
          n_name || CASE WHEN n_nationkey % 3 = 0 THEN ' COMMUNITY COLLEGE' ELSE ' UNIVERSITY' END AS school_name
        FROM nation""",
    "system_names": 'SELECT n_nationkey AS "system", n_name AS system_name FROM nation',
    "catalog": "SELECT CAST(p_partkey AS INT) AS course_code, p_name AS course_title FROM part",
    "coded_catalog": """
        SELECT CAST(CASE WHEN p_partkey % 23 = 1 THEN 9305 WHEN p_partkey % 23 = 2 THEN 3121
            WHEN p_partkey % 23 <> 3 THEN 3000 + (p_partkey * 7) % 3500 END AS INT) AS course_code,
          CASE p_size % 8 WHEN 0 THEN 'AP ' WHEN 1 THEN 'CIE ' WHEN 2 THEN 'Dual Enrollment '
            WHEN 3 THEN 'IB ' WHEN 4 THEN 'SDC ' WHEN 5 THEN 'IB MAP ' ELSE '' END || p_name AS course_title,
          p_size AS size FROM part""",
    "crosswalk": """
        SELECT CAST(p_partkey AS INT) AS course_code,
          CASE WHEN p_name LIKE '%ring%' THEN 'AP' WHEN p_name LIKE '%bolt%' THEN 'CIE'
            WHEN p_name LIKE '%gear%' THEN 'IB' WHEN p_name LIKE '%rod%' THEN 'SDC' END AS epso_type,
          CASE p_partkey % 6 WHEN 0 THEN 'CLICK' WHEN 1 THEN 'VIEW' WHEN 2 THEN 'PURCHASE'
            WHEN 3 THEN 'SIGNUP DIPLOMA' WHEN 4 THEN 'ERROR' END AS exam_name
        FROM part
        WHERE p_name LIKE '%ring%' OR p_name LIKE '%bolt%' OR p_name LIKE '%gear%' OR p_name LIKE '%rod%'""",
    "exams": f"""
        SELECT {_STUDENT_OF_EVENT} AS student_id,
          CASE event_id % 3 WHEN 0 THEN 'AP_2018' WHEN 1 THEN 'IB_2018' ELSE 'CLEP_2018' END AS test_administration_cd,
          CAST(2010 + event_id % 10 AS VARCHAR) || '-06 ' ||
            CASE WHEN event_id % 11 <> 0 THEN upper(event_type) ELSE 'OTHER' END ||
            CASE WHEN event_id % 7 = 0 THEN ' DIPLOMA' ELSE '' END AS test_administration_desc,
          props AS test_longname,
          CASE WHEN event_id % 11 <> 0 THEN upper(event_type) END AS sublevel1_shortname,
          CASE WHEN event_id % 13 <> 0 THEN upper(event_type) END AS sublevel2_shortname,
          CASE WHEN value >= 1 THEN CAST(CASE WHEN event_id % 3 = 2 THEN CAST(floor(value * 2) AS BIGINT)
            ELSE CAST(floor(value) AS BIGINT) % 6 END AS VARCHAR) END AS assessment_result_number_score
        FROM events""",
    "sdc": " UNION ALL ".join(
        _sdc(w)
        for w in (
            "event_type IN ('click', 'view')",
            "event_type IN ('purchase', 'signup')",
            "event_type NOT IN ('click', 'view', 'purchase', 'signup')",
        )
    ),
    "college_reported": f"SELECT {_STUDENT_OF_EVENT} AS student_id FROM events",
    "certs": f"""
        SELECT CASE WHEN l_tax = 0.08 THEN 'X' || CAST(o_custkey AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) END AS student_id,
          CASE WHEN p_partkey % 29 <> 0 THEN CASE WHEN {_VENDOR} = '' THEN p_name ELSE {_VENDOR} END END AS cert_name,
          p_brand AS source_file,
          CASE WHEN l_returnflag = 'R' THEN 'Fail' WHEN l_returnflag = 'A' THEN 'Pass' END AS pass_fail,
          CAST(CAST(2 * l_quantity AS INT) AS VARCHAR) || CASE WHEN l_linenumber % 2 = 0 THEN '.9' ELSE '' END AS test_score,
          l_orderkey AS order_no, l_linenumber AS line_no
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "conversion_text": f"""
        SELECT CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE {pick(STANDARD_CERTS, 'p_partkey')} END AS cert_name,
          CASE p_size % 6 WHEN 0 THEN 'ONLY' WHEN 1 THEN '1 EPSO' WHEN 2 THEN '2 EPSO'
            WHEN 3 THEN '3 EPSO' WHEN 4 THEN '4 EPSO' END AS credit_text
        FROM part""",
    "conversion": """
        SELECT cert_name, max(CAST(CASE WHEN contains(credit_text, 'ONLY') THEN 2 WHEN contains(credit_text, '1 EPSO') THEN 3
          WHEN regexp_matches(credit_text, '[234] EPSO') THEN 4 END AS INT)) AS n_epso
        FROM conversion_text GROUP BY cert_name""",
    "approved": f"""
        SELECT cert_name, source_file, min(new_cert) AS new_cert, min(pass_fail) AS pass_fail, max(promoted) AS promoted
        FROM (
          SELECT CASE WHEN {_VENDOR} = '' THEN p_name ELSE {_VENDOR} END AS cert_name, p_brand AS source_file,
            CASE WHEN p_size % 7 <> 0 THEN {pick(STANDARD_CERTS, 'p_size')} END AS new_cert,
            CASE p_size % 4 WHEN 1 THEN 'Pass' WHEN 2 THEN 'Score of 70' WHEN 3 THEN 'Other' END AS pass_fail,
            CASE WHEN p_size % 5 = 0 THEN 'n' ELSE 'x' END AS promoted
          FROM part)
        GROUP BY cert_name, source_file""",
    "act": """
        SELECT o_custkey AS student_key,
          CASE WHEN o_orderpriority <> '3-MEDIUM' THEN CAST(o_orderkey % 23 AS INT) END AS act_composite_highest,
          CAST(o_orderkey % 5 AS INT) AS act_math_highest, CAST(o_orderkey % 7 AS INT) AS act_reading_highest,
          CAST(o_orderkey % 3 AS INT) AS act_english_highest,
          CASE WHEN o_orderpriority <> '2-HIGH' THEN CAST(o_orderkey % 11 AS INT) END AS act_science_highest,
          CASE WHEN o_orderstatus <> 'P' THEN CAST(400 + o_orderkey % 700 AS INT) END AS sat_total
        FROM orders""",
    "best_act": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY student_key ORDER BY
            act_composite_highest DESC NULLS LAST, act_math_highest DESC NULLS LAST,
            act_reading_highest DESC NULLS LAST, act_english_highest DESC NULLS LAST,
            act_science_highest ASC NULLS LAST, sat_total DESC NULLS LAST) AS rn
          FROM act) WHERE rn = 1""",
    "snapshot_prev": f"""
        SELECT c_custkey AS student_key, c_name AS first_name, c_nationkey AS district_no,
          CAST(c_custkey % 10 AS INT) AS school_no,
          CASE WHEN c_acctbal < 0 THEN 'N' ELSE 'Y' END AS included_in_cohort, {_SCORES},
          CASE WHEN c_custkey % 7 = 0 THEN 'Y' ELSE 'N' END AS readiness,
          CASE WHEN c_custkey % 13 <> 0 THEN 'N' END AS is_approved
        FROM customer""",
    "snapshot_cur": """
        SELECT * REPLACE (
          CASE WHEN student_key % 10 = 0 THEN 30 ELSE act_composite END AS act_composite,
          CASE WHEN student_key % 15 <> 0 THEN n_adv_placement END AS n_adv_placement,
          CASE WHEN student_key % 10 = 0 THEN 'Y' WHEN student_key % 21 = 0 THEN 'N' ELSE readiness END AS readiness,
          CASE WHEN student_key % 17 = 3 THEN student_key + 10000000 ELSE student_key END AS student_key)
        FROM snapshot_prev""",
    "snapshot_orig": """
        SELECT * REPLACE (
          CASE WHEN student_key % 20 = 0 THEN 30 ELSE act_composite END AS act_composite,
          CASE WHEN student_key % 30 <> 0 THEN n_adv_placement END AS n_adv_placement)
        FROM snapshot_prev""",
    "docs": """
        SELECT o_custkey AS student_key,
          CASE WHEN o_orderpriority <> '5-LOW' THEN 'doc-' || CAST(o_orderkey AS VARCHAR) END AS save_as_filename,
          CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 0 END AS INT) AS status,
          CASE WHEN o_orderkey % 5 = 0 THEN 'seen' END AS comments
        FROM orders""",
    "file_history": " UNION ALL ".join(
        _history(v, d)
        for v, d in (
            ("snapshot_orig", "2019-01-01"),
            ("snapshot_prev", "2019-02-01"),
            ("snapshot_cur", "2019-03-01"),
        )
    ),
    # Enrollments of all courses, for the single operators.
    "enr": """
        SELECT i.isp_id, i.student_key, i.type_of_service, i.first_name, i.school_year AS isp_school_year,
          i.school_bu_id, i.withdrawal_reason, i.begin_date, i.end_date,
          a.sca_begin_date, a.sca_end_date, a.school_year AS sca_school_year,
          a.local_class_number AS sca_local_class_number, c.school_year AS cs_school_year,
          c.course_code, c.cs_begin_date, c.cs_end_date, c.state_dual_credit, c.local_dual_credit,
          c.post_secondary_institution
        FROM isp i JOIN sca a ON a.isp_id = i.isp_id
        JOIN cs c ON a.instructional_program_num = c.instructional_program_num
          AND a.local_class_number = c.local_class_number AND a.school_bu_id = c.school_bu_id
          AND a.school_year = c.school_year""",
    "last_days": """
        SELECT school_bu_id, school_year AS isp_school_year, min(id_date) AS first_day,
          max(id_date) AS last_day, count(*) AS n_days FROM calendar GROUP BY 1, 2""",
    "filled": """
        SELECT e.* REPLACE (
          coalesce(cs_end_date, sca_end_date, m.top) AS cs_end_date,
          coalesce(sca_end_date, m.top) AS sca_end_date)
        FROM enr e, (SELECT max(last_day) AS top FROM enr JOIN last_days USING (school_bu_id, isp_school_year)) m""",
    "segments": """
        SELECT isp_id, student_key, course_code, begin_date, end_date, sca_begin_date, sca_end_date,
          cs_begin_date, cs_end_date, min(f.first_name) AS first_name, min(isp_school_year) AS isp_school_year,
          min(withdrawal_reason) AS withdrawal_reason, min(sca_local_class_number) AS sca_local_class_number,
          CAST(sum(CASE WHEN id_date BETWEEN cs_begin_date AND cs_end_date THEN 1 ELSE 0 END) AS BIGINT) AS course_instructional_days,
          CAST(sum(CASE WHEN id_date BETWEEN sca_begin_date AND sca_end_date THEN 1 ELSE 0 END) AS BIGINT) AS enrolled_instructional_days
        FROM filled f LEFT JOIN calendar k ON f.school_bu_id = k.school_bu_id AND f.isp_school_year = k.school_year
        GROUP BY ALL""",
}


def with_views(body: str, views: dict[str, str] = VIEWS) -> str:
    """The query preceded by the views it needs, in order of dependence."""
    needed: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name in views:
            if name not in seen and re.search(rf"(?<![\w.'\"]){name}(?![\w'\"])", text):
                seen.add(name)
                visit(views[name])
                needed.append(name)

    visit(body)
    if not needed:
        return body
    listed = ",\n".join(f"{name} AS MATERIALIZED ({views[name]})" for name in needed)
    if re.match(r"\s*WITH\b", body):
        return f"WITH {listed},\n" + re.sub(r"^\s*WITH\b", "", body)
    return f"WITH {listed}\n{body}"
