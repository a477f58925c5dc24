"""Whole pipelines, the compiled files, comparisons, audits and monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathways.operators import audit as A
from pathways.operators import certs as C
from pathways.operators import cohort as H
from pathways.operators import compare as Q
from pathways.operators import counts as N
from pathways.operators import monitor as M
from pathways.operators import report as R
from pathways.plans import compiled as P
from pathways.plans import domains as D
from pathways.plans import weekly as WK
from pathways.session import reuse, scratch_path
from pathways.sources.writers import write_snapshot, write_versioned
from pathways.plans.inputs import graduates, whole_cohort
from pathways.rules import EPSO_TYPES, SCORE_COLUMNS

from .course_sql import all_counts_ctes, course_ctes
from .names import PATTERNS
from .registry import query
from .tables import Bound

GRADUATES = graduates(patterns=PATTERNS)
WHOLE = whole_cohort(patterns=PATTERNS)

# -- domains ------------------------------------------------------------------

COUNTS_OF = {
    "ap": ("D1", D.ap_counts), "cie": ("D2", D.cie_counts), "clep": ("D3", D.clep_counts),
    "de": ("D4", D.de_counts), "ib": ("D5", D.ib_counts), "ic": ("D6", D.ic_counts),
    "ldc": ("D7", D.ldc_counts), "sdc": ("D8", D.sdc_counts),
}


def _register_domain(domain: str, covers: str, counts) -> None:
    for suffix, mode, rules in (("", "graduates", GRADUATES), ("_whole", "whole", WHOLE)):
        source = "course_counts" if domain in PATTERNS_AND_LOCAL else "all_counts"
        ctes = course_ctes(mode) if source == "course_counts" else all_counts_ctes(mode)
        query(
            f"{domain}_counts{suffix}", covers,
            f"{ctes} SELECT student_key, epso_type, n_courses FROM {source} WHERE epso_type = '{domain}'",
            lambda b, counts=counts, rules=rules: counts(b.inputs, rules),
        )


PATTERNS_AND_LOCAL = ("ap", "cie", "de", "ib", "ldc")
for _domain, (_covers, _counts) in COUNTS_OF.items():
    _register_domain(_domain, _covers, _counts)

# -- compiled files -----------------------------------------------------------

WIDE = ", ".join(f"w.{t}" for t in EPSO_TYPES)
ZEROED = ", ".join(f"coalesce(w.{t}, 0) AS {t}" for t in EPSO_TYPES)
SCORES = ", ".join(
    f"a.{c}" for c in (
        "act_composite_highest", "act_math_highest", "act_reading_highest",
        "act_english_highest", "act_science_highest", "sat_total",
    )
)
JOINED = "FROM cohort c LEFT JOIN wide w USING (student_key) LEFT JOIN best_act a USING (student_key)"
CLASSIFIED = f"""SELECT *, CASE WHEN included_in_cohort = 'Y' AND completion_type IN (1, 11, 12, 13)
    AND (act_composite_highest >= 21 OR sat_total >= 1060 OR ap + cie + clep + de + ib + ic + ldc + sdc >= 4)
    THEN 'Y' ELSE 'N' END AS readiness FROM (SELECT c.*, {ZEROED}, {SCORES} {JOINED})"""
REPORT = f"""SELECT student_key, first_name, CAST(NULL AS VARCHAR) AS middle_name, CAST(NULL AS VARCHAR) AS last_name,
    CAST(NULL AS VARCHAR) AS race_ethnicity, cohortyear, CAST(NULL AS VARCHAR) AS el, CAST(NULL AS VARCHAR) AS swd,
    CAST(NULL AS VARCHAR) AS ed, "system" AS district_no, school AS school_no, included_in_cohort, completion_type,
    CAST(NULL AS INT) AS sat_math, CAST(NULL AS INT) AS sat_critical_reading, sat_total,
    act_english_highest AS act_english, act_math_highest AS act_math, act_reading_highest AS act_reading,
    act_science_highest AS act_science, act_composite_highest AS act_composite, ic AS industry_cert,
    CAST(NULL AS INT) AS asvab, CAST(NULL AS VARCHAR) AS ncrc_work_keys, cie AS n_cambridge, ap AS n_ap, ib AS n_ib,
    sdc AS n_sdc, ldc AS n_ldc, de AS n_de, clep, readiness FROM ({CLASSIFIED})"""
G, W = all_counts_ctes("graduates"), all_counts_ctes("whole")

query("all_counts", "D9 U1", f"{G} SELECT * FROM all_counts", lambda b: D.all_counts(b.inputs, GRADUATES))
query(
    "cohort_with_counts", "J15", f"{G} SELECT c.*, {WIDE} FROM cohort c LEFT JOIN wide w USING (student_key)",
    lambda b: R.attach_cohort(N.pivot_types(D.all_counts(b.inputs, GRADUATES)), b.cohort),
)
query(
    "cohort_with_scores", "J16", f"SELECT c.*, {SCORES} FROM cohort c LEFT JOIN best_act a USING (student_key)",
    lambda b: R.attach_scores(b.cohort, H.best_scores(b.act)),
)
query(
    "ready_classification", "F17", f"{G} {CLASSIFIED}",
    lambda b: P.classified(D.all_counts(b.inputs, GRADUATES), b.inputs, GRADUATES),
)
query("student_report", "F18 D9", f"{G} {REPORT}", lambda b: P.compile_report(b.inputs, GRADUATES))


def _stored_report(b: Bound) -> DataFrame:
    """Two runs of the counts are stored; the report is compiled from the newest."""
    folder = scratch_path(b.spark, "counts")
    counts = reuse(D.all_counts(b.inputs, GRADUATES))
    write_versioned(counts.withColumn("n_courses", F.col("n_courses") + 1), folder, "2019a")
    write_versioned(counts, folder, "2019b")
    return P.compile_stored(b.spark, folder, b.inputs, GRADUATES)


query("student_report_from_stored_counts", "D9 S7", f"{G} {REPORT}", _stored_report)
query(
    "whole_cohort_file", "D10", f"{W} SELECT c.*, {WIDE}, {SCORES} {JOINED}",
    lambda b: P.compile_cohort(b.inputs, WHOLE),
)

# The student table and a recalculation, from two snapshots.
FRESH_NAMES = {
    "n_adv_placement": "n_ap", "n_inter_baccalaureate": "n_ib", "n_statewide_dual_credit": "n_sdc",
    "n_local_dual_credit": "n_ldc", "n_dual_enrollment": "n_de",
}
FRESH = "n_cambridge, n_adv_placement AS n_ap, n_inter_baccalaureate AS n_ib, n_statewide_dual_credit AS n_sdc, n_local_dual_credit AS n_ldc, n_dual_enrollment AS n_de"


def _fresh(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(FRESH_NAMES).select(
        "student_key", "n_cambridge", *FRESH_NAMES.values(), "readiness"
    )


def _pmax(name: str, current: str | None = None) -> str:
    c = current or f"s.{name}"
    return f"CASE WHEN {c} IS NULL OR f.{name} IS NULL THEN NULL ELSE greatest({c}, f.{name}) END AS {name}"


MERGED = f"""SELECT coalesce(s.student_key, f.student_key) AS student_key, s.first_name, s.district_no, s.school_no, s.included_in_cohort,
    s.sat_math, s.sat_critical_reading, s.sat_total, s.act_english, s.act_math, s.act_reading, s.act_science,
    s.act_composite, s.industry_cert_earned AS industry_cert, s.asvab, {_pmax('n_cambridge')}, {_pmax('n_ap')},
    {_pmax('n_ib')}, {_pmax('n_sdc')}, {_pmax('n_ldc')}, {_pmax('n_de')},
    s.participate_clg_lvl_pgm AS clep, {_pmax('readiness')}
  FROM (SELECT * REPLACE (n_cambridge AS n_cambridge), n_adv_placement AS n_ap, coalesce(n_inter_baccalaureate, 0) AS n_ib, n_statewide_dual_credit AS n_sdc,
      n_local_dual_credit AS n_ldc, n_dual_enrollment AS n_de FROM snapshot_cur) s
  FULL JOIN (SELECT student_key, {FRESH}, readiness FROM snapshot_prev) f ON s.student_key = f.student_key"""
query(
    "merged_final_values", "J22", MERGED,
    lambda b: R.merge_final(b.snapshot_cur, _fresh(b.snapshot_prev)),
)
query(
    "final_report", "D12", MERGED, lambda b: P.final_report(b.snapshot_cur, _fresh(b.snapshot_prev)),
)

# -- comparisons --------------------------------------------------------------

query(
    "snapshots_compared", "J20",
    """SELECT coalesce(p.student_key, c.student_key) AS student_key, p.act_composite AS act_composite_x, p.n_adv_placement AS n_adv_placement_x,
      p.readiness AS readiness_x, c.act_composite AS act_composite_y, c.n_adv_placement AS n_adv_placement_y, c.readiness AS readiness_y
      FROM snapshot_prev p FULL JOIN snapshot_cur c ON p.student_key = c.student_key""",
    lambda b: Q.compare(
        *[
            df.select("student_key", "act_composite", "n_adv_placement", "readiness")
            for df in (b.snapshot_prev, b.snapshot_cur)
        ],
        ["student_key"],
    ),
)
query(
    "status_frequency", "A13", "SELECT status, comments, count(*) AS n FROM docs GROUP BY 1, 2",
    lambda b: Q.freq(b.docs, "status", "comments"),
)
PROFILED = ("student_key", "first_name", "district_no", *SCORE_COLUMNS, "readiness", "is_approved")
query(
    "missing_values_by_column", "A14",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_missing FROM snapshot_cur" for c in PROFILED
    ),
    lambda b: Q.null_profile(b.snapshot_cur.select(*PROFILED)),
)

OLD = "SELECT student_key, 'ap' AS epso_type, CAST(n_adv_placement AS BIGINT) AS n_courses FROM snapshot_prev WHERE n_adv_placement IS NOT NULL"
NEW = "SELECT student_key, 'ap' AS epso_type, CAST(act_science % 6 AS BIGINT) AS n_courses FROM snapshot_cur WHERE act_science IS NOT NULL"
SIDE_BY_SIDE = f"(SELECT o.n_courses AS x, n.n_courses AS y, coalesce(o.student_key, n.student_key) AS student_key FROM ({OLD}) o FULL JOIN ({NEW}) n USING (student_key, epso_type))"
KEYS = ["student_key", "epso_type"]


def _old(b: Bound) -> DataFrame:
    kept = b.snapshot_prev.where(F.col("n_adv_placement").isNotNull())
    return kept.select("student_key", F.lit("ap").alias("epso_type"), F.col("n_adv_placement").cast("bigint").alias("n_courses"))


def _new(b: Bound) -> DataFrame:
    kept = b.snapshot_cur.where(F.col("act_science").isNotNull())
    return kept.select("student_key", F.lit("ap").alias("epso_type"), (F.col("act_science") % 6).cast("bigint").alias("n_courses"))


query(
    "count_difference_distribution", "A15 W6",
    f"""SELECT diff, n, round_even(100.0 * n / (sum(n) OVER ()), 1) AS pct FROM (
      SELECT coalesce(x, 0) - coalesce(y, 0) AS diff, count(*) AS n FROM {SIDE_BY_SIDE} GROUP BY 1)""",
    lambda b: Q.diff_distribution(_old(b), _new(b), KEYS),
)
query(
    "count_change_summary", "A16",
    f"""SELECT count(*) FILTER (y > x) AS n_higher, count(*) FILTER (x > y) AS n_lower,
      count(*) FILTER (x IS NULL AND y IS NOT NULL) AS n_no_longer_missing,
      count(*) FILTER (y IS NULL AND x IS NOT NULL) AS n_now_missing FROM {SIDE_BY_SIDE}""",
    lambda b: Q.change_summary(_old(b), _new(b), KEYS),
)
query(
    "count_change_matrix", "A17",
    f"""SELECT x AS n_courses_x, y AS n_courses_y, count(DISTINCT student_key) AS n FROM {SIDE_BY_SIDE}
      WHERE x IS DISTINCT FROM y GROUP BY 1, 2""",
    lambda b: Q.change_matrix(_old(b), _new(b), KEYS),
)
CHANGE_PAIRS = {
    "updated_act_english": ("act_english", "act_english"),
    "updated_act_math": ("act_math", "act_math"),
    "updated_act_reading": ("act_reading", "act_reading"),
    "updated_act_science": ("act_science", "act_science"),
    "updated_act_composite": ("act_composite", "act_composite"),
    "updated_industry_cert": ("industry_cert_earned", "industry_cert"),
    "updated_asvab": ("asvab", "asvab"),
    "updated_clep": ("participate_clg_lvl_pgm", "clep"),
    "updated_cambridge": ("n_cambridge", "n_cambridge"),
    "updated_ap": ("n_adv_placement", "n_ap"),
    "updated_ib": ("n_inter_baccalaureate", "n_ib"),
    "updated_sdc": ("n_statewide_dual_credit", "n_sdc"),
    "updated_ldc": ("n_local_dual_credit", "n_ldc"),
    "updated_de": ("n_dual_enrollment", "n_de"),
}
query(
    "changed_values", "R8",
    f"""SELECT s.student_key, s.first_name, s.district_no, {', '.join(f'coalesce(f.{t}, 0) <> coalesce(s.{t}, 0) AS {flag}' for flag, (t, _) in CHANGE_PAIRS.items())}
      FROM snapshot_cur s LEFT JOIN snapshot_prev f USING (student_key)
      WHERE s.is_approved IS NOT NULL AND ({' OR '.join(f'coalesce(f.{t}, 0) <> coalesce(s.{t}, 0)' for t, _ in CHANGE_PAIRS.values())})""",
    lambda b: Q.changed_values(
        b.snapshot_cur, R.report_names(b.snapshot_prev), CHANGE_PAIRS, ("first_name", "district_no")
    ),
)
COMPARED = ["n_cambridge", "act_composite", "n_adv_placement", "readiness"]
query(
    "mismatches_by_column", "R9",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER (p.{c} IS DISTINCT FROM c.{c}) AS n_different
          FROM snapshot_prev p FULL JOIN snapshot_cur c ON p.student_key = c.student_key"""
        for c in COMPARED
    ),
    lambda b: Q.mismatch_counts(b.snapshot_prev, b.snapshot_cur, COMPARED),
)
query(
    "students_who_lost_status", "R10",
    """SELECT p.student_key, p.readiness AS readiness_x, c.readiness AS readiness_y
      FROM snapshot_prev p JOIN snapshot_cur c USING (student_key) WHERE p.readiness = 'Y' AND c.readiness = 'N'""",
    lambda b: Q.lost_status(b.snapshot_prev, b.snapshot_cur),
)
query(
    "numeric_columns", "F16",
    "SELECT TRY_CAST(student_id AS DOUBLE) AS student_id, TRY_CAST(test_score AS DOUBLE) AS test_score, TRY_CAST(pass_fail AS DOUBLE) AS pass_fail FROM certs",
    lambda b: Q.numeric_all(b.certs.select("student_id", "test_score", "pass_fail")),
)
query(
    "credit_change_impact", "A22",
    f"""{G} SELECT coalesce(o.n_new + n_cambridge + n_ap + n_ib + n_sdc + n_ldc + n_de >= 4 OR act_composite >= 21 OR coalesce(sat_total, 0) >= 1060, NULL) AS still_ready, count(*) AS n
      FROM (SELECT student_key, ic AS n_old, ic % 4 AS n_new FROM wide WHERE ic >= 4) o
      LEFT JOIN ({REPORT}) r USING (student_key) GROUP BY 1""",
    lambda b: C.credit_impact(
        D.ic_counts(b.inputs, GRADUATES),
        D.ic_counts(b.inputs, GRADUATES).withColumn("n_courses", F.col("n_courses") % 4),
        P.compile_report(b.inputs, GRADUATES),
    ),
)

# -- audits -------------------------------------------------------------------

EIGHT = (
    "industry_cert_earned", "n_cambridge", "n_adv_placement", "n_inter_baccalaureate",
    "n_statewide_dual_credit", "n_local_dual_credit", "n_dual_enrollment", "participate_clg_lvl_pgm",
)
TOTAL_ZERO = " + ".join(f"coalesce({c}, 0)" for c in EIGHT)
TOTAL_NULL = " + ".join(EIGHT)
AUDIT = "SELECT * FROM snapshot_prev WHERE readiness = 'N' AND "
query("audit_act", "R1", AUDIT + "act_composite >= 21", lambda b: A.audit_act(b.snapshot_prev))
query("audit_sat", "R2", AUDIT + "sat_total >= 1060", lambda b: A.audit_sat(b.snapshot_prev))
query("audit_epso", "R3", AUDIT + f"{TOTAL_ZERO} >= 4", lambda b: A.audit_epso(b.snapshot_prev))
query("audit_epso_strict", "R3", AUDIT + f"{TOTAL_NULL} >= 4", lambda b: A.audit_epso(b.snapshot_prev, False))
query("audit_asvab", "R4", AUDIT + f"asvab >= 31 AND {TOTAL_ZERO} >= 2", lambda b: A.audit_asvab(b.snapshot_prev))
query("audit_asvab_strict", "R4", AUDIT + f"asvab >= 31 AND {TOTAL_NULL} >= 2", lambda b: A.audit_asvab(b.snapshot_prev, False))
query(
    "corrections_applied", "R6",
    f"""SELECT * REPLACE (CASE WHEN correction IS NOT NULL THEN 'Y' ELSE readiness END AS readiness) FROM (
      SELECT *, CASE WHEN readiness <> 'N' THEN NULL WHEN sat_total >= 1060 OR act_composite >= 21 THEN 'scores'
        WHEN {TOTAL_NULL} >= 4 THEN 'epso' WHEN {TOTAL_NULL} >= 2 AND asvab >= 31 THEN 'asvab' END AS correction
      FROM snapshot_prev)""",
    lambda b: A.apply_corrections(b.snapshot_prev),
)
SEVEN = "n_cambridge + n_ap + n_ib + n_sdc + n_ldc + n_de + clep"
query(
    "pathway_breakdown", "A12",
    f"""SELECT act_composite >= 21 OR sat_total >= 1060 AS pathway_act_sat, {SEVEN} >= 4 AS pathway_epso,
      industry_cert + {SEVEN} >= 4 AS pathway_ic, count(DISTINCT student_key) AS n
      FROM (SELECT student_key, act_composite, sat_total, industry_cert_earned AS industry_cert, {FRESH},
        participate_clg_lvl_pgm AS clep FROM snapshot_cur WHERE readiness = 'Y') GROUP BY 1, 2, 3""",
    lambda b: A.pathway_breakdown(R.report_names(b.snapshot_cur)),
)

# -- monitoring ---------------------------------------------------------------

DOUBLES = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in SCORE_COLUMNS)
CHANGED = f"""SELECT student_key, {DOUBLES} FROM (
    SELECT student_key, {', '.join(SCORE_COLUMNS)} FROM snapshot_cur
    EXCEPT SELECT student_key, {', '.join(SCORE_COLUMNS)} FROM snapshot_prev
    EXCEPT SELECT student_key, {', '.join(SCORE_COLUMNS)} FROM snapshot_orig)"""
STATUS = f"""SELECT coalesce(d.student_key, u.student_key) AS student_key, save_as_filename, status, comments,
    {', '.join(SCORE_COLUMNS)}, c.district_no, c.school_no
  FROM ({CHANGED}) u FULL JOIN docs d ON u.student_key = d.student_key
  LEFT JOIN (SELECT student_key, district_no, school_no FROM snapshot_cur) c ON c.student_key = coalesce(d.student_key, u.student_key)"""
ANY_SCORE = "coalesce(" + ", ".join(SCORE_COLUMNS) + ") IS NOT NULL"
FLAGGED = f"""SELECT *, save_as_filename IS NOT NULL AND NOT has_score AS n_doc_no_data,
    save_as_filename IS NOT NULL AND status IS NULL AND has_score AS n_docs_to_review,
    save_as_filename IS NULL AND status IS NULL AS n_data_no_doc, has_score AS n_new_data
  FROM (SELECT *, {ANY_SCORE} AS has_score FROM ({STATUS}))"""


def _changes(b: Bound) -> DataFrame:
    three = (b.snapshot_cur, b.snapshot_prev, b.snapshot_orig)
    return M.changed_rows(*[WK.score_columns(df) for df in three])


def _status(b: Bound) -> DataFrame:
    places = b.snapshot_cur.select("student_key", "district_no", "school_no")
    return M.appeal_status(_changes(b), b.docs, places)


query("changed_rows", "U3", CHANGED, _changes)
query("appeal_status", "J17", STATUS, _status)
query("appeal_flags", "R5", f"SELECT * EXCLUDE (has_score) FROM ({FLAGGED})", lambda b: M.appeal_flags(_status(b)))
query(
    "appeals_with_district_name", "J18",
    f"""SELECT f.* EXCLUDE (district_no, has_score), district_no AS "system", system_name FROM ({FLAGGED}) f
      LEFT JOIN system_names n ON n."system" = f.district_no""",
    lambda b: M.with_district_name(M.appeal_flags(_status(b)), b.system_names),
)
BY_DISTRICT = f"""SELECT district_no AS "system", system_name,
    {', '.join(f'count(*) FILTER ({c}) AS {c}' for c in M.FLAGS)}
  FROM ({FLAGGED}) f LEFT JOIN system_names n ON n."system" = f.district_no GROUP BY 1, 2"""
query(
    "status_by_district", "A11", BY_DISTRICT,
    lambda b: M.status_by_district(M.with_district_name(M.appeal_flags(_status(b)), b.system_names)),
)
query(
    "weekly_status", "D11", BY_DISTRICT,
    lambda b: WK.weekly_status(b.snapshot_cur, b.snapshot_prev, b.snapshot_orig, b.docs, b.system_names),
)


def _weekly_run(b: Bound) -> DataFrame:
    """Two earlier weeks lie in the folder, and one after this run that it must not see."""
    folder = scratch_path(b.spark, "weeks")
    for day, df in (("2019-01-25", b.snapshot_orig), ("2019-02-01", b.snapshot_prev), ("2019-02-15", b.snapshot_cur)):
        write_snapshot(df, folder, day)
    return WK.weekly_run(b.snapshot_cur, folder, "2019-02-08", b.snapshot_orig, b.docs, b.system_names)


query("weekly_run", "S6 S8 D11", BY_DISTRICT, _weekly_run)
query(
    "proposed_comments", "R7",
    f"""SELECT student_key, save_as_filename, status, comments, n_data_no_doc, n_doc_no_data,
      CASE WHEN NOT ((status IS NULL OR status IN (0, 2)) AND CASE WHEN status IS NOT NULL THEN comments END IS NULL) THEN NULL
        WHEN n_data_no_doc THEN 'No documentation has been uploaded for this appeal. Please upload documentation by clicking the Attach link or using the Mass Upload feature.'
        WHEN n_doc_no_data THEN 'No data has been uploaded for this appeal. Please upload updated data using the Mass Upload feature.' END AS proposed_comment
      FROM ({FLAGGED})""",
    lambda b: M.propose_comments(M.appeal_flags(_status(b))).select(
        "student_key", "save_as_filename", "status", "comments", "n_data_no_doc", "n_doc_no_data", "proposed_comment"
    ),
)
query(
    "district_history", "R11", "SELECT * FROM file_history WHERE district_no = 10",
    lambda b: M.district_history(b.file_history, 10),
)
query(
    "status_flips", "A23",
    """SELECT * FROM file_history WHERE student_key IN (
      SELECT student_key FROM file_history GROUP BY 1 HAVING count(DISTINCT readiness) > 1)""",
    lambda b: M.status_flips(b.file_history),
)
