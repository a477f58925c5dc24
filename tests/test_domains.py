"""The eight counts and the compiled files on a small hand-written school."""

import pytest
from pyspark.sql import functions as F

from helpers import d, rows
from pathways.plans import compiled as P
from pathways.plans import domains as D
from pathways.plans.inputs import COURSE_DOMAINS, Inputs, graduates, whole_cohort
from pathways.sources import schemas as S
from workload.names import PATTERNS
from workload.tables import Bound

EXAM_COLUMNS = (
    "student_id double, test_administration_cd string, test_longname string, sublevel1_shortname string, "
    "sublevel2_shortname string, assessment_result_number_score string"
)
CODES = {"ap": 3217, "ap_unnamed": 3999, "cie": 4150, "cie_diploma": 4151, "ib": 3215, "de": 4000, "local": 7000, "study_hall": 9305}
TITLES = {
    "ap": "AP Biology", "ap_unnamed": "AP New Course", "cie": "CIE Biology", "cie_diploma": "CIE Chemistry",
    "ib": "IB Biology", "de": "Dual Enrollment Art", "local": "Welding", "study_hall": "Study Hall",
}


@pytest.fixture(scope="module")
def school(spark):
    """Students 1-3 graduate, 4 does not complete, 5 is not in the cohort.

    ``taken`` lists (student, course, begin, end of assignment, withdrawn).
    """
    cohort = spark.createDataFrame(
        [(1, "Y", 1, 2014), (2, "Y", 11, 2014), (3, "Y", 13, 2014), (4, "Y", 3, 2014), (5, "N", 1, 2014)],
        "student_key long, included_in_cohort string, completion_type int, cohortyear int",
    ).withColumns({"system": F.lit(1), "school": F.lit(2)})
    full, late = (d(1, 1), d(1, 10)), (d(1, 8), d(1, 10))
    taken = [
        (1, "ap", *full, None), (1, "ap_unnamed", *full, None), (1, "cie", *full, None), (1, "cie_diploma", *full, None),
        (1, "ib", *full, None), (1, "de", *full, None), (1, "local", *full, None), (1, "study_hall", *full, None),
        (2, "ap", *late, None), (2, "local", full[0], None, None), (2, "de", *full, 1),
        (3, "ib", *full, None), (4, "ap", *full, None), (4, "local", *full, None), (5, "local", *full, None),
    ]
    isp = spark.createDataFrame(
        [(n, s, "A", None, None, None, None, 2014, w, d(1, 1), None, 1) for n, (s, _, _, _, w) in enumerate(taken)], S.SERVICE_PERIOD
    )
    sca = spark.createDataFrame(
        [(n, CODES[c], 1, 1, 2014, b, e) for n, (_, c, b, e, _) in enumerate(taken)], S.CLASS_ASSIGNMENT
    )
    cs = spark.createDataFrame(
        [(code, 1, 1, 2014, code, d(1, 1), None if name == "local" else d(1, 10), "N", "Y" if name in ("local", "study_hall") else "N", "N", None)
         for name, code in CODES.items()],
        S.CLASS_SECTION,
    )
    calendar = spark.createDataFrame([(1, 2014, d(1, n)) for n in range(1, 11)], S.CALENDAR_DAY)
    catalog = spark.createDataFrame([(CODES[n], t) for n, t in TITLES.items()], S.COURSE_CATALOG)
    crosswalk = spark.createDataFrame(
        [("AP", 3217, "AP Biology", "BIOL"), ("AP", 3999, "AP New Course", None), ("CIE", 4150, "CIE Biology", "CAMBRIDGE BIOLOGY"),
         ("CIE", 4151, "CIE Chemistry", "CHEMISTRY DIPLOMA"), ("IB", 3215, "IB Biology", "BIO"), ("AP", 3444, "AP Economics", "ECONMA")],
        S.CROSSWALK,
    )
    exams = spark.createDataFrame(
        [(1.0, "AP_2018", None, "BIOL", None, "1"), (1.0, "AP_2018", None, "ECONMA", None, "4"), (1.0, "AP_2018", None, None, None, "2"),
         (2.0, "AP_2018", None, "ECONMA", None, "2"), (1.0, "IB_2018", None, None, "BIO", "6"), (3.0, "IB_2018", None, None, "BIO", None),
         (3.0, "CLEP_2018", "HIST", None, None, "50"), (3.0, "CLEP_2018", None, None, None, "60"), (3.0, "CLEP_2018", "MATH", None, None, "9"),
         (4.0, "AP_2018", None, "ECONMA", None, "5")],
        EXAM_COLUMNS,
    )
    sdc = spark.createDataFrame(
        [(1, 1, 55.0, 50.0, "P", 1), (1, 1, 20.0, 50.0, "F", 1), (2, 1, None, 50.0, None, 1), (None, 1, 1.0, 1.0, "F", 1), (3, 4, 1.0, 1.0, "F", 1)],
        S.SDC_EXAMS,
    )
    certs = spark.createDataFrame(
        [("1", "Electrical ER", "f", "Pass", "1"), ("1", "EMR", "f", None, "1"), ("2", "Safety", "f", None, "1"), ("2", "Quality", "f", None, "1"),
         ("2", "Maintenance Awareness", "f", None, "1"), ("2", "Processes and Production", "f", None, "1"), ("3", "EMR", "f", "Fail", "1"),
         ("4", "EMR", "f", "--", "1")],
        S.CERT_RECORDS,
    )
    return Inputs(
        cohort=cohort, isp=isp, sca=sca, cs=cs, calendar=calendar, catalog=catalog, crosswalk=crosswalk, exams=exams, sdc=sdc,
        college_reported=spark.createDataFrame([(1,), (1,), (2,), (99,)], S.COLLEGE_REPORTED),
        certs=certs,
        approved=spark.createDataFrame([], S.CERT_APPROVED),
        conversion=spark.createDataFrame([("Electrical", 3), ("Emergency Medical Responder (First Responder)", 4)], S.CERT_CONVERSION),
        act=spark.createDataFrame([(3, 30, 1, 1, 1, 1, 900), (2, 10, 1, 1, 1, 1, None)], S.ACT_SCORES),
    )


def counts(df):
    return {r.student_key: r.n_courses for r in df.collect()}


def test_ap_needs_any_score_or_a_passing_exam(school):
    # student 1: Biology with a score, the unnamed course by the unnamed exam, Economics by exam alone
    assert counts(D.ap_counts(school)) == {1: 3}
    # student 2 attended less than half and did not pass; whole cohort adds student 4 by exam alone
    assert counts(D.ap_counts(school, whole_cohort())) == {1: 3, 4: 1}


def test_cie_needs_no_score_but_no_diploma(school):
    assert counts(D.cie_counts(school)) == {1: 1}


def test_ib_needs_a_score(school):
    assert counts(D.ib_counts(school)) == {1: 1}


def test_de_takes_the_larger_count_or_the_sum(school):
    assert counts(D.de_counts(school)) == {1: 2, 2: 1, 99: 1}
    assert counts(D.de_counts(school, whole_cohort())) == {1: 3, 2: 1, 99: 1}
    listed = graduates(course_lists={"de": (4000, 7000)})
    assert counts(D.de_counts(school, listed)) == {1: 2, 2: 1, 99: 1}
    assert counts(D.de_counts(school, whole_cohort(course_lists={"de": (4000, 7000)}))) == {1: 4, 2: 1, 99: 1, 4: 1}


def test_ldc_flagged_outside_the_crosswalk(school):
    # student 2's open assignment counts to the last day; without filling it counts no days
    assert counts(D.ldc_counts(school)) == {1: 1, 2: 1}
    assert counts(D.ldc_counts(school, whole_cohort())) == {1: 1, 4: 1}


def test_exam_only_domains(school):
    assert counts(D.clep_counts(school)) == {3: 2}
    assert counts(D.sdc_counts(school)) == {1: 2}
    assert counts(D.sdc_counts(school, whole_cohort())) == {1: 2, 4: 1}


def test_certifications(school):
    assert counts(D.ic_counts(school)) == {1: 6, 2: 4}
    assert counts(D.ic_counts(school, graduates(legacy_bundle=True))) == {1: 6, 2: 0}
    assert counts(D.ic_counts(school, whole_cohort())) == {1: 7, 2: 0, 4: 4}


def test_domains_together_equal_domains_apart(school):
    for rules in (graduates(), whole_cohort()):
        together = rows(D.course_counts(school, rules), "student_key", "epso_type", "n_courses")
        apart = []
        for domain in COURSE_DOMAINS:
            apart += rows(D.course_counts(school, rules, (domain,)), "student_key", "epso_type", "n_courses")
        assert sorted(together) == sorted(apart)


def test_domains_together_equal_apart_on_supplied_tables(spark, small):
    b = Bound(spark, small)
    rules = graduates(patterns=PATTERNS)
    together = rows(D.course_counts(b, rules), "student_key", "epso_type", "n_courses")
    apart = [r for x in ("ap", "cie", "de", "ib", "ldc") for r in rows(D.course_counts(b, rules, (x,)), "student_key", "epso_type", "n_courses")]
    assert sorted(together) == sorted(apart)


def test_whole_cohort_covers_the_graduates(spark, small):
    b = Bound(spark, small)
    some = {r[0] for r in rows(D.sdc_counts(b), "student_key")}
    every = {r[0] for r in rows(D.sdc_counts(b, whole_cohort()), "student_key")}
    assert some < every


def test_row_order_and_partitions_do_not_matter(spark, small):
    b, shuffled = Bound(spark, small), Bound(spark, small)
    shuffled.sca = b.sca.repartition(7, "sca_begin_date").sortWithinPartitions(F.desc("isp_id"))
    shuffled.isp = b.isp.orderBy(F.desc("student_key"))
    rules = graduates(patterns=PATTERNS)
    assert rows(D.ldc_counts(b, rules)) == rows(D.ldc_counts(shuffled, rules))


def test_compiled_files(school):
    report = P.compile_report(school)
    assert rows(report, "student_key", "n_ap", "n_de", "industry_cert", "act_composite", "readiness") == [
        (1, 3, 2, 6, None, "Y"), (2, 0, 1, 4, 10, "Y"), (3, 0, 0, 0, 30, "Y"), (4, 0, 0, 0, None, "N"), (5, 0, 0, 0, None, "N"),
    ]
    cohort = P.compile_cohort(school)
    assert "readiness" not in cohort.columns
    assert rows(cohort, "student_key", "ap", "de", "ic", "sat_total") == [
        (1, 3, 3, 7, None), (2, None, 1, 0, None), (3, None, None, None, 900), (4, 1, None, 4, None), (5, None, None, None, None),
    ]
