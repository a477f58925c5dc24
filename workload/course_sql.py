"""Reference SQL of the course-based counts, in the exploded by-join form."""

from __future__ import annotations

from .names import PATTERNS
from .views import standard_name_sql

SEGMENT = (
    "isp_id, student_key, course_code, begin_date, end_date, sca_begin_date, sca_end_date, "
    "cs_begin_date, cs_end_date"
)


def course_ctes(mode: str, extra: str = "") -> str:
    """CTEs up to ``course_counts(student_key, epso_type, n_courses)``."""
    whole = mode == "whole"
    pulled = "included_in_cohort = 'Y'" if whole else "completion_type IN (1, 11, 12, 13)"
    counted = "included" if whole else "graduates"
    titles = " UNION ALL ".join(
        f"SELECT course_code, '{d.lower()}' AS domain FROM catalog WHERE regexp_matches(course_title, '{p}')"
        for d, p in PATTERNS.items()
        if d != "SDC"
    )
    fill = (
        """SELECT e.* REPLACE (coalesce(cs_end_date, sca_end_date) AS cs_end_date) FROM pull e"""
        if whole
        else """SELECT e.* REPLACE (
            coalesce(cs_end_date, sca_end_date, CASE WHEN domain IN ('ib', 'de') THEN y.top ELSE g.top END) AS cs_end_date,
            coalesce(sca_end_date, CASE WHEN domain IN ('ib', 'de') THEN y.top ELSE g.top END) AS sca_end_date)
          FROM pull e
          LEFT JOIN (SELECT domain, max(last_day) AS top FROM pull JOIN last_days USING (school_bu_id, isp_school_year)
            GROUP BY domain) g USING (domain)
          LEFT JOIN (SELECT domain, isp_school_year, course_code, max(last_day) AS top
            FROM pull JOIN last_days USING (school_bu_id, isp_school_year) GROUP BY ALL) y USING (domain, isp_school_year, course_code)"""
    )
    cie = "" if whole else "AND x.epso_type = 'CIE'"
    merge = "n + p" if whole else "greatest(n, p)"
    return f"""WITH tagged AS MATERIALIZED (
      SELECT cs.*, d.domain FROM cs JOIN (SELECT DISTINCT * FROM ({titles})) d USING (course_code)
      UNION ALL
      SELECT cs.*, 'ldc' FROM cs WHERE local_dual_credit = 'Y'
        AND course_code NOT IN (SELECT course_code FROM crosswalk)),
    pull AS MATERIALIZED (
      SELECT c.domain, i.isp_id, i.student_key, i.school_year AS isp_school_year, i.school_bu_id,
        i.withdrawal_reason, i.begin_date, i.end_date, a.sca_begin_date, a.sca_end_date,
        c.course_code, c.cs_begin_date, c.cs_end_date
      FROM isp i JOIN sca a ON a.isp_id = i.isp_id
      JOIN tagged c ON a.instructional_program_num = c.instructional_program_num
        AND a.local_class_number = c.local_class_number AND a.school_bu_id = c.school_bu_id
        AND a.school_year = c.school_year
      WHERE i.student_key IN (SELECT student_key FROM cohort WHERE {pulled})),
    fill AS MATERIALIZED ({fill}),
    seg AS MATERIALIZED (
      SELECT domain, {SEGMENT}, min(withdrawal_reason) AS withdrawal_reason,
        sum(CASE WHEN id_date BETWEEN cs_begin_date AND cs_end_date THEN 1 ELSE 0 END) AS cd,
        sum(CASE WHEN id_date BETWEEN sca_begin_date AND sca_end_date THEN 1 ELSE 0 END) AS ed
      FROM fill f LEFT JOIN calendar k ON f.school_bu_id = k.school_bu_id AND f.isp_school_year = k.school_year
      GROUP BY domain, {SEGMENT}),
    attended AS MATERIALIZED (
      SELECT domain, student_key, course_code FROM seg
      WHERE student_key IN (SELECT student_key FROM {counted}) AND withdrawal_reason IS NULL
        AND (end_date IS NULL OR end_date <= sca_end_date)
        AND NOT (domain IN ('de', 'ldc') AND course_code IN (9305, 3121))
      GROUP BY ALL HAVING sum(ed) > 0 AND sum(ed) >= 0.5 * max(cd)),
    credited AS MATERIALIZED (
      SELECT domain, student_key, course_code FROM attended WHERE domain IN ('de', 'ldc')
      UNION ALL
      SELECT a.* FROM attended a JOIN crosswalk x USING (course_code)
        WHERE domain = 'cie' AND x.exam_name NOT LIKE '%DIPLOMA%' {cie}
      UNION ALL
      SELECT a.* FROM attended a LEFT JOIN crosswalk x USING (course_code)
        JOIN exams e ON e.student_id = a.student_key AND e.sublevel1_shortname IS NOT DISTINCT FROM x.exam_name
        WHERE domain = 'ap' AND test_administration_cd LIKE '%AP\\_%' ESCAPE '\\'
          AND assessment_result_number_score IS NOT NULL
      UNION ALL
      SELECT 'ap', e.student_id, x.course_code FROM exams e
        JOIN crosswalk x ON x.epso_type = 'AP' AND x.exam_name IS NOT DISTINCT FROM e.sublevel1_shortname
        WHERE e.test_administration_cd LIKE '%AP\\_%' ESCAPE '\\'
          AND e.assessment_result_number_score IN ('3', '4', '5')
          AND e.student_id IN (SELECT student_key FROM {counted})
      UNION ALL
      SELECT a.* FROM attended a JOIN crosswalk x USING (course_code)
        JOIN exams e ON e.student_id = a.student_key AND e.sublevel2_shortname = x.exam_name
        WHERE domain = 'ib' AND test_administration_cd LIKE '%IB\\_%' ESCAPE '\\'
          AND assessment_result_number_score IS NOT NULL),
    enrolled_counts AS MATERIALIZED (
      SELECT student_key, domain AS epso_type, count(DISTINCT course_code) AS n_courses FROM credited GROUP BY ALL),
    course_counts AS MATERIALIZED (
      SELECT * FROM enrolled_counts WHERE epso_type <> 'de'
      UNION ALL
      SELECT student_key, 'de', {merge} FROM (
        SELECT coalesce(a.student_key, b.student_id) AS student_key, coalesce(a.n_courses, 0) AS n, coalesce(b.n, 0) AS p
        FROM (SELECT * FROM enrolled_counts WHERE epso_type = 'de') a
        FULL JOIN (SELECT student_id, count(*) AS n FROM college_reported GROUP BY 1) b ON a.student_key = b.student_id)){extra}"""


def accepted_ctes(mode: str) -> str:
    """CTE ``accepted``: one row per accepted certification record."""
    failed = "'Fail', 'FAIL', 'No'" + ("" if mode == "whole" else ", '--'")
    counted = "included" if mode == "whole" else "graduates"
    return f"""named AS MATERIALIZED (
      SELECT *, {standard_name_sql('cert_name', mode)} AS standard_name FROM (
        SELECT CAST(TRY_CAST(student_id AS DOUBLE) AS BIGINT) AS student_key, * EXCLUDE (student_id) FROM certs
        WHERE TRY_CAST(student_id AS DOUBLE) IS NOT NULL AND (pass_fail IS NULL OR pass_fail NOT IN ({failed})))
      WHERE student_key IN (SELECT student_key FROM {counted})),
    accepted AS MATERIALIZED (
      SELECT n.*, a.new_cert, a.pass_fail AS pass_rule, coalesce(v.n_epso, w.n_epso) AS n_epso
      FROM named n
      LEFT JOIN (SELECT * FROM approved WHERE promoted = 'x') a
        ON n.cert_name IS NOT DISTINCT FROM a.cert_name AND n.source_file IS NOT DISTINCT FROM a.source_file
      LEFT JOIN conversion v ON n.standard_name IS NOT DISTINCT FROM v.cert_name
      LEFT JOIN conversion w ON a.new_cert IS NOT DISTINCT FROM w.cert_name
      WHERE a.pass_fail IS NULL OR a.pass_fail = 'Pass'
        OR (CAST(trunc(TRY_CAST(test_score AS DOUBLE)) AS INT) >= 70 AND contains(a.pass_fail, '70')))"""


def cert_counts_sql(mode: str, legacy: bool = False) -> str:
    """Ranked form of the certification credit, over CTE ``accepted``."""
    if mode == "whole":
        return """SELECT student_key, 'ic' AS epso_type, CAST(coalesce(sum(n_epso), 0) AS BIGINT) AS n_courses
          FROM accepted GROUP BY 1"""
    credit = "NULL" if legacy else "4"
    return f"""SELECT student_key, 'ic' AS epso_type,
        CAST(coalesce(sum(CASE WHEN rn = 1 THEN n_epso ELSE n_epso - 1 END), 0) AS BIGINT) AS n_courses
      FROM (SELECT student_key, n_epso,
          row_number() OVER (PARTITION BY student_key ORDER BY n_epso DESC NULLS LAST) AS rn
        FROM (
          SELECT student_key, n_epso FROM accepted WHERE NOT contains(standard_name, 'CPT')
          UNION ALL
          SELECT student_key, {credit} FROM accepted WHERE contains(standard_name, 'CPT')
          GROUP BY student_key HAVING count(DISTINCT cert_name) = 4))
      GROUP BY 1"""


def all_counts_ctes(mode: str, legacy: bool = False) -> str:
    """CTEs up to ``all_counts`` with the eight types stacked."""
    counted = "included" if mode == "whole" else "graduates"
    return course_ctes(
        mode,
        f""",
    {accepted_ctes(mode)},
    all_counts AS MATERIALIZED (
      SELECT * FROM course_counts
      UNION ALL
      SELECT student_id, 'clep', count(DISTINCT test_longname) FROM exams
        WHERE test_administration_cd LIKE 'CLEP%' AND TRY_CAST(assessment_result_number_score AS DOUBLE) >= 50
          AND student_id IN (SELECT student_key FROM {counted}) GROUP BY 1
      UNION ALL
      SELECT student_id, 'sdc', count(DISTINCT course_code) FROM sdc
        WHERE exam_score IS NOT NULL AND student_id IN (SELECT student_key FROM {counted}) GROUP BY 1
      UNION ALL ({cert_counts_sql(mode, legacy)})),
    wide AS MATERIALIZED (
      SELECT student_key, {', '.join(f"max(CASE WHEN epso_type = '{t}' THEN n_courses END) AS {t}" for t in ('ap', 'cie', 'clep', 'de', 'ib', 'ic', 'ldc', 'sdc'))}
      FROM all_counts GROUP BY 1)""",
    )
