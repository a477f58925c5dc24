"""Incremental counts, spells, measured salts, stored joins, digests of snapshots, row numbers and bitmaps."""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathways.functions.skew import join_measured
from pathways.operators import cohort as H
from pathways.operators import enrollment as E
from pathways.operators import spells as S
from pathways.plans import incremental as I
from pathways.operators import asof as T
from pathways.operators import audit as A
from pathways.operators import bitmaps as M
from pathways.operators import digests as G
from pathways.operators import numbering as N
from pathways.operators import report as R
from pathways.plans import weekly as WK
from pathways.session import reuse, scratch_path, stored
from pathways.sources import bucketed as K

from .course_sql import all_counts_ctes
from .enrollment_queries import OPEN_SEGMENTS, SEGMENT, enrollments, period_days
from .registry import query
from .report_queries import CHANGED, COMPARED, FRESH, GRADUATES, SEVEN, WHOLE
from .tables import Bound
from .views import VIEWS

# -- incremental counts -------------------------------------------------------
# A week's changes of the supplied tables: the rules name the changed rows, old values
# and new ones; every table is read whole.

# SQL conditions that name the rows.
WITHDRAWN, DROPPED, COPIED = ("isp_id % 1499 = 3", "isp_id % 1499 = 4", "isp_id % 1499 = 5")
LATER_DAY = "school_bu_id = 2 AND school_year = 1994"
# Column of a table, the rows in which it changes, and its new value.
NEW_VALUES = {
    "isp": ("withdrawal_reason", WITHDRAWN, "1"),
    "cs": ("cs_end_date", "instructional_program_num % 1499 = 8", "date_add(cs_begin_date, 30)"),
    "exams": ("assessment_result_number_score", "student_id % 1499 = 9", "'4'"),
    "certs": ("pass_fail", "order_no % 1499 = 11", "'Fail'"),
    "cohort": ("completion_type", "student_key % 1499 = 13", "12"),
}


class Before(Bound):
    """The tables of the stored run; its sections are written, since both runs read them."""

    cs = cached_property(lambda self: reuse(super(Before, self).cs))


class Changed(Bound):
    """The tables a week later, and what changed in them."""

    @cached_property
    def before(self) -> Bound:
        return Before(self.spark, self.folder)

    def _after(self, name: str) -> DataFrame:
        column, where, value = NEW_VALUES[name]
        return getattr(self.before, name).withColumn(column, F.expr(f"if({where}, {value}, {column})"))

    isp = cached_property(lambda self: self._after("isp"))
    cs = cached_property(lambda self: self._after("cs"))
    exams = cached_property(lambda self: self._after("exams"))
    certs = cached_property(lambda self: self._after("certs"))
    cohort = cached_property(lambda self: self._after("cohort"))

    @cached_property
    def copies(self) -> DataFrame:
        """Assignments that came: those of some periods once more, in another class."""
        return self.before.sca.where(COPIED).withColumn("local_class_number", F.col("local_class_number") % 7 + 1)

    @cached_property
    def sca(self) -> DataFrame:
        return self.before.sca.where(f"NOT ({DROPPED})").unionByName(self.copies)

    @cached_property
    def later_day(self) -> DataFrame:
        """One more day in one calendar; it moves fill dates."""
        last = self.before.calendar.where(LATER_DAY).groupBy("school_bu_id", "school_year")
        return last.agg(F.date_add(F.max("id_date"), 1).alias("id_date"))

    @cached_property
    def calendar(self) -> DataFrame:
        return self.before.calendar.unionByName(self.later_day)

    @cached_property
    def changes(self) -> dict[str, I.Change]:
        found = {
            "sca": I.Change(self.before.sca.where(DROPPED), self.copies),
            "calendar": I.Change(added=self.later_day),
        }
        for name, (column, where, value) in NEW_VALUES.items():
            rows = getattr(self.before, name).where(where)
            found[name] = I.Change(rows, rows.withColumn(column, F.expr(value)))
        return found


def _old(name: str) -> str:
    """View of a table before the changes; the views it is made of are those before too."""
    return re.sub(r"(?<![\w.'\"])(isp|sca|cs|exams|certs|cohort|calendar)(?![\w'\"])", r"\1_before", VIEWS[name])


CHANGED_TABLES = ("isp", "sca", "cs", "exams", "certs", "cohort", "calendar")
CHANGED_VIEWS = {
    **{f"{n}_before": _old(n) for n in CHANGED_TABLES},
    **{n: v for n, v in VIEWS.items() if n not in CHANGED_TABLES},
    "isp": "SELECT * REPLACE (CAST(CASE WHEN isp_id % 1499 = 3 THEN 1 ELSE withdrawal_reason END AS INT) AS withdrawal_reason) FROM isp_before",
    "sca": """SELECT * FROM sca_before WHERE isp_id % 1499 <> 4
        UNION ALL SELECT * REPLACE (local_class_number % 7 + 1 AS local_class_number) FROM sca_before WHERE isp_id % 1499 = 5""",
    "cs": """SELECT * REPLACE (CASE WHEN instructional_program_num % 1499 = 8 THEN CAST(cs_begin_date + INTERVAL 30 DAY AS DATE)
        ELSE cs_end_date END AS cs_end_date) FROM cs_before""",
    "exams": """SELECT * REPLACE (CASE WHEN student_id % 1499 = 9 THEN '4' ELSE assessment_result_number_score END
        AS assessment_result_number_score) FROM exams_before""",
    "certs": "SELECT * REPLACE (CASE WHEN order_no % 1499 = 11 THEN 'Fail' ELSE pass_fail END AS pass_fail) FROM certs_before",
    "cohort": "SELECT * REPLACE (CAST(CASE WHEN student_key % 1499 = 13 THEN 12 ELSE completion_type END AS INT) AS completion_type) FROM cohort_before",
    "calendar": """SELECT * FROM calendar_before UNION ALL
        SELECT school_bu_id, school_year, CAST(max(id_date) + INTERVAL 1 DAY AS DATE) FROM calendar_before
        WHERE school_bu_id = 2 AND school_year = 1994 GROUP BY ALL""",
}


def refreshed(b: Bound, rules=GRADUATES) -> I.Refreshed:
    """The counts of last week, stored, brought up to this week's tables."""
    now = Changed(b.spark, b.folder)
    folder = scratch_path(b.spark, "state")
    I.full_state(now.before, rules).write(folder, "2019-02-01")
    return I.refresh(I.read_state(b.spark, folder, "2019-02-01"), now.before, now, now.changes, rules)


query(
    "incremental_counts", "D1 D2 D3 D4 D5 D6 D7 D8 U3", f"{all_counts_ctes('graduates')} SELECT * FROM all_counts",
    lambda b: refreshed(b).state.counts, CHANGED_VIEWS,
)
query(
    "incremental_counts_whole", "D1 D2 D3 D4 D5 D6 D7 D8 U3", f"{all_counts_ctes('whole')} SELECT * FROM all_counts",
    lambda b: refreshed(b, WHOLE).state.counts, CHANGED_VIEWS,
)

# -- spells -------------------------------------------------------------------

APART = f"""WITH kept AS (
      SELECT *, greatest(coalesce(sca_end_date, DATE '9999-12-31'), sca_begin_date) AS reach FROM ({OPEN_SEGMENTS})
      WHERE withdrawal_reason IS NULL AND (end_date IS NULL OR end_date <= sca_end_date)
        AND student_key IN (SELECT student_key FROM graduates)
        AND enrolled_instructional_days > 0 AND enrolled_instructional_days >= 0.5 * course_instructional_days),
    opening AS (
      SELECT *, CASE WHEN sca_begin_date > max(reach) OVER (PARTITION BY student_key, course_code ORDER BY sca_begin_date
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS opens FROM kept WHERE sca_begin_date IS NOT NULL),
    numbered AS (
      SELECT *, 1 + sum(opens) OVER (PARTITION BY student_key, course_code ORDER BY sca_begin_date) AS spell FROM opening)"""


def attended_apart(b: Bound) -> DataFrame:
    opened = E.segment_days(E.fill_end_dates(period_days(b), "open_ended"))
    return S.repeated_apart(opened, H.counted_students(b.cohort))


query(
    "courses_repeated_apart", "R12",
    f"""{APART} SELECT {SEGMENT}, CAST(spell AS BIGINT) AS spell, CAST(n_spells AS BIGINT) AS n_spells FROM (
      SELECT *, max(spell) OVER (PARTITION BY student_key, course_code) AS n_spells FROM numbered) WHERE n_spells > 1""",
    lambda b: attended_apart(b).select(*E.SEGMENT_KEYS, "spell", "n_spells"),
)
query(
    "enrollment_spells_by_school_year", "R12",
    """WITH e AS (
      SELECT school_bu_id, isp_school_year, sca_begin_date, sca_end_date,
        greatest(coalesce(sca_end_date, DATE '9999-12-31'), sca_begin_date) AS reach FROM enr WHERE sca_begin_date IS NOT NULL),
    opening AS (
      SELECT *, CASE WHEN sca_begin_date > max(reach) OVER (PARTITION BY school_bu_id, isp_school_year ORDER BY sca_begin_date
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS opens FROM e),
    numbered AS (SELECT *, 1 + sum(opens) OVER (PARTITION BY school_bu_id, isp_school_year ORDER BY sca_begin_date) AS spell FROM opening)
    SELECT school_bu_id, isp_school_year, CAST(spell AS BIGINT) AS spell, min(sca_begin_date) AS sca_begin_date,
      CASE WHEN count(*) = count(sca_end_date) THEN max(reach) END AS sca_end_date, count(*) AS n_intervals
    FROM numbered GROUP BY ALL""",
    lambda b: S.spells(enrollments(b), ["school_bu_id", "isp_school_year"], "sca_begin_date", "sca_end_date", slice_days=31),
)

# -- measured salts -----------------------------------------------------------

query(
    "course_enrollments_salted", "J1", "SELECT * FROM enr",
    lambda b: E.course_enrollments(b.isp, b.sca, b.cs, join=join_measured),
)
query(
    "enrollment_calendar_salted", "J4",
    """SELECT g.student_key, e.isp_id, e.course_code, e.isp_school_year, first_day, last_day, n_days
      FROM graduates g LEFT JOIN enr e USING (student_key) LEFT JOIN last_days USING (school_bu_id, isp_school_year)""",
    lambda b: E.enrollment_days(
        H.counted_students(b.cohort),
        enrollments(b).select("student_key", "isp_id", "course_code", "isp_school_year", "school_bu_id"),
        E.calendar_index(b.calendar).select("school_bu_id", "school_year", "first_day", "last_day", "n_days"),
        join=join_measured,
    ).select("student_key", "isp_id", "course_code", "isp_school_year", "first_day", "last_day", "n_days"),
)
query(
    "exams_of_enrolled_students_salted", "J19",
    "SELECT student_id AS student_key, test_longname FROM exams WHERE student_id IN (SELECT student_key FROM isp)",
    lambda b: H.only_students(
        b.exams.select(F.col("student_id").alias("student_key"), "test_longname"), b.isp.select("student_key"), join=join_measured
    ),
)

# -- stored joins ---------------------------------------------------------------


def stored_star(b: Bound) -> DataFrame:
    folder = scratch_path(b.spark, "star")
    K.store_star(b.isp, b.sca, b.cs, folder)
    return K.stored_enrollments(b.spark, folder)


query("course_enrollments_stored", "J1", "SELECT * FROM enr", stored_star)

# -- digests of snapshots -------------------------------------------------------


def digested(b: Bound, df: DataFrame) -> G.Digested:
    path = scratch_path(b.spark, "snapshot")
    G.write_digested(df, path, parts=64)
    return G.Digested(b.spark, path)


def changed_by_digest(b: Bound) -> DataFrame:
    three = (b.snapshot_cur, b.snapshot_prev, b.snapshot_orig)
    return G.changed_rows_digested(*[digested(b, WK.score_columns(df)) for df in three])


query("changed_rows_by_digest", "U3", CHANGED, changed_by_digest)
query(
    "mismatches_by_column_and_digest", "R9",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST(count(*) FILTER (p.{c} IS DISTINCT FROM c.{c}) AS BIGINT) AS n_different
        FROM snapshot_prev p FULL JOIN snapshot_cur c USING (student_key)""" for c in COMPARED
    ),
    lambda b: G.mismatch_counts_digested(
        *[digested(b, df.select("student_key", *COMPARED)) for df in (b.snapshot_prev, b.snapshot_cur)], COMPARED
    ),
)

# -- row numbers ----------------------------------------------------------------

query(
    "crosswalk_numbered", "O2",
    """SELECT *, row_number() OVER (ORDER BY epso_type NULLS LAST, exam_name DESC NULLS LAST, course_code NULLS LAST) AS line_no FROM crosswalk""",
    lambda b: N.numbered(
        b.crosswalk, [F.asc_nulls_last("epso_type"), F.desc_nulls_last("exam_name"), F.asc_nulls_last("course_code")], "line_no"
    ),
)
query(
    "service_periods_numbered", "O1",
    "SELECT isp_id, student_key, end_date, row_number() OVER (ORDER BY end_date IS NULL DESC, end_date DESC, isp_id) AS line_no FROM isp",
    lambda b: N.numbered(
        b.isp.select("isp_id", "student_key", "end_date"), [F.desc_nulls_first("end_date"), F.asc("isp_id")], "line_no"
    ),
)

# -- bitmaps --------------------------------------------------------------------


def weekly_maps(b: Bound) -> DataFrame:
    """Students by week, district and status."""
    numbers = stored(M.student_numbers(b.file_history))
    return stored(M.bitmaps(b.file_history, ["file_time", "district_no", "readiness"], numbers))


query(
    "students_by_week_from_bitmaps", "R11 A23",
    "SELECT file_time, readiness, count(DISTINCT student_key) AS n_students FROM file_history GROUP BY ALL",
    lambda b: M.students_in(weekly_maps(b), ["file_time", "readiness"]),
)
query(
    "status_moves_from_bitmaps", "A23 R10",
    """SELECT p.district_no, p.readiness AS readiness_before, c.readiness AS readiness_after, count(DISTINCT student_key) AS n_students
      FROM (SELECT * FROM file_history WHERE file_time = DATE '2019-02-01') p
      JOIN (SELECT * FROM file_history WHERE file_time = DATE '2019-03-01') c USING (student_key, district_no)
      GROUP BY ALL""",
    lambda b: M.moves(
        weekly_maps(b), "file_time", "readiness", F.lit("2019-02-01").cast("date"), F.lit("2019-03-01").cast("date"), ["Y", "N", None], ["district_no"]
    ),
)
PATHWAYS = ("pathway_act_sat", "pathway_epso", "pathway_ic")
PATHWAY_SETS = [PATHWAYS, PATHWAYS[:2], PATHWAYS[::2], PATHWAYS[1:], *[(p,) for p in PATHWAYS], ()]


def pathway_lattice(b: Bound) -> DataFrame:
    flags = A.pathway_flags(R.report_names(b.snapshot_cur))
    maps = stored(M.bitmaps(flags, list(PATHWAYS), stored(M.student_numbers(flags))))
    return M.breakdowns(maps, list(PATHWAYS), PATHWAY_SETS)


FLAGGED = f"""SELECT student_key, act_composite >= 21 OR sat_total >= 1060 AS pathway_act_sat, {SEVEN} >= 4 AS pathway_epso,
      industry_cert + {SEVEN} >= 4 AS pathway_ic
    FROM (SELECT student_key, act_composite, sat_total, industry_cert_earned AS industry_cert, {FRESH},
      participate_clg_lvl_pgm AS clep FROM snapshot_cur WHERE readiness = 'Y')"""
query(
    "pathway_lattice_from_bitmaps", "A12 A13",
    " UNION ALL ".join(
        f"""SELECT '{",".join(own)}' AS grouping, {", ".join(p if p in own else f"CAST(NULL AS BOOLEAN) AS {p}" for p in PATHWAYS)},
        count(DISTINCT student_key) AS n_students FROM ({FLAGGED}) {"GROUP BY " + ", ".join(own) if own else "HAVING count(*) > 0"}"""
        for own in PATHWAY_SETS
    ),
    pathway_lattice,
)

# -- rows in force --------------------------------------------------------------


def dated_appeals(b: Bound) -> DataFrame:
    """Appeals with the day they came in."""
    order = F.col("o_orderkey")
    return b.raw("orders").select(
        F.col("o_custkey").alias("student_key"), order.alias("appeal_id"),
        F.date_add(F.lit("2018-12-15").cast("date"), (order % 100).cast("int")).alias("appealed_on"),
    )


query(
    "appeals_with_status_in_force", "S6 J17 R11",
    """SELECT a.student_key, a.appeal_id, a.appealed_on, h.file_time, h.readiness, h.n_adv_placement
      FROM (SELECT o_custkey AS student_key, o_orderkey AS appeal_id, CAST(DATE '2018-12-15' + CAST(o_orderkey % 100 AS INT) AS DATE) AS appealed_on FROM orders) a
      ASOF LEFT JOIN file_history h ON a.student_key = h.student_key AND a.appealed_on >= h.file_time""",
    lambda b: T.in_force(dated_appeals(b), b.file_history, "student_key", "appealed_on", "file_time", ["readiness", "n_adv_placement"]),
)
