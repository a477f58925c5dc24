import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows
from pathways.operators import audit as A
from pathways.operators import certs as C
from pathways.operators import cohort as H
from pathways.operators import compare as Q
from pathways.operators import monitor as M
from pathways.operators import report as R
from pathways.plans import compiled as P
from pathways.rules import EPSO_COUNT_COLUMNS, EPSO_TYPES


# -- cohort -------------------------------------------------------------------


def test_cohort_modes(spark):
    df = spark.createDataFrame([(1, "Y", 1), (2, "Y", 3), (3, "N", 1), (4, None, 11), (5, "Y", None)], "student_key long, included_in_cohort string, completion_type int")
    assert rows(H.filter_cohort(df), "student_key") == [(1,)]
    assert rows(H.filter_cohort(df, "whole"), "student_key") == [(1,), (2,), (5,)]
    with pytest.raises(ValueError):
        H.filter_cohort(df, "other")
    history = df.withColumn("cohortyear", F.lit(2014))
    assert rows(H.cohort_students(history.union(history), 2014)) == [(1,), (3,), (4,)]
    assert rows(H.cohort_students(history, 2015)) == []


def test_one_row_per_student(spark):
    df = spark.createDataFrame(
        [(1, "N", 1, "a"), (1, "Y", 12, "b"), (1, "Y", 11, "c"), (1, "Y", None, "d"), (2, None, None, "e")],
        "student_key long, included_in_cohort string, completion_type int, note string",
    )
    assert rows(H.dedupe_cohort(df, ["note"]), "student_key", "note") == [(1, "c"), (2, "e")]


def test_best_scores_order(spark):
    df = spark.createDataFrame(
        [(1, 20, 5, 1, 1, 9, 100), (1, 20, 5, 1, 1, 3, 200), (1, 20, 4, 9, 9, 1, 300), (1, None, 9, 9, 9, 9, 400), (2, None, None, None, None, None, 5), (3, 1, 1, 1, 1, None, 1), (3, 1, 1, 1, 1, 8, 2)],
        "student_key long, act_composite_highest int, act_math_highest int, act_reading_highest int, act_english_highest int, act_science_highest int, sat_total int",
    )
    assert rows(H.best_scores(df), "student_key", "act_science_highest", "sat_total") == [(1, 3, 200), (2, None, 5), (3, 8, 2)]


def test_column_selection(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "id int, a int, b int, n_x int, c_end int")
    assert H.select_cols(df, first="a", last="b", keep=("id",)).columns == ["id", "a", "b"]
    assert H.select_cols(df, prefix=("n_",), suffix=("_end",)).columns == ["n_x", "c_end"]
    assert H.select_cols(df, first="id", without=("n_",)).columns == ["id", "a", "b", "c_end"]


# -- classification and report ------------------------------------------------

SCORED = "student_key long, included_in_cohort string, completion_type int, act_composite_highest int, sat_total int, " + ", ".join(f"{t} long" for t in EPSO_TYPES)


def student(key, included="Y", kind=1, act=None, sat=None, epso=0):
    return (key, included, kind, act, sat, epso, *([0] * (len(EPSO_TYPES) - 1)))


def test_readiness(spark):
    df = spark.createDataFrame(
        [student(1, act=21), student(2, act=20), student(3, sat=1060), student(4, epso=4), student(5, epso=3),
         student(6, "N", act=36), student(7, kind=3, act=36), student(8, None, act=36), student(9)],
        SCORED,
    )
    ready = R.classify_ready(df).where("readiness = 'Y'")
    assert rows(ready, "student_key") == [(1,), (3,), (4,)]


def test_report_columns_and_placeholders(spark):
    report = R.student_report(R.classify_ready(spark.createDataFrame([student(1, act=21)], SCORED)))
    assert report.columns[:3] == ["student_key", "first_name", "middle_name"] and len(report.columns) == 32
    assert rows(report, "student_key", "act_composite", "asvab", "readiness") == [(1, 21, None, "Y")]
    assert dict(report.dtypes)["asvab"] == "int" and dict(report.dtypes)["ncrc_work_keys"] == "string"


def test_final_merge_keeps_the_higher_and_propagates_missing(spark):
    table = spark.createDataFrame(
        [(1, 2, 1, None, 3, 0, 1, "N", "A"), (2, None, 1, 1, 1, 1, 1, "Y", None)],
        "student_key long, n_cambridge int, n_adv_placement int, n_inter_baccalaureate int, n_statewide_dual_credit int, n_local_dual_credit int, n_dual_enrollment int, readiness string, is_approved string",
    )
    fresh = spark.createDataFrame(
        [(1, 1, 4, 2, 3, None, 0, "Y"), (3, 1, 1, 1, 1, 1, 1, "Y")],
        "student_key long, n_cambridge int, n_ap int, n_ib int, n_sdc int, n_ldc int, n_de int, readiness string",
    )
    out = P.final_report(table, fresh)
    assert "is_approved" not in out.columns
    assert rows(out, "student_key", "n_cambridge", "n_ap", "n_ib", "n_sdc", "n_ldc", "n_de", "readiness") == [
        (1, 2, 4, 2, 3, None, 1, "Y"), (2, None, None, None, None, None, None, None), (3, None, None, None, None, None, None, None),
    ]


# -- comparison ---------------------------------------------------------------


def counts(spark, *values):
    return spark.createDataFrame([(k, "ap", n) for k, n in values], "student_key long, epso_type string, n_courses long")


def test_change_tables(spark):
    old, new = counts(spark, (1, 2), (2, 2), (3, 1)), counts(spark, (1, 3), (2, 2), (4, 1))
    keys = ["student_key", "epso_type"]
    assert rows(Q.change_summary(old, new, keys)) == [(1, 0, 1, 1)]
    assert rows(Q.change_matrix(old, new, keys)) == [(1, None, 1), (2, 3, 1), (None, 1, 1)]
    assert rows(Q.diff_distribution(old, new, keys)) == [(-1, 2, 50.0), (0, 1, 25.0), (1, 1, 25.0)]


def test_percent_rounds_half_to_even(spark):
    old = counts(spark, *[(k, 1 if k == 0 else 0) for k in range(400)])
    new = counts(spark, *[(k, 0) for k in range(400)])
    assert (1, 1, 0.2) in rows(Q.diff_distribution(old, new, ["student_key", "epso_type"]))


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (None, "a")], "k int, v string")
    assert rows(Q.null_profile(df)) == [("k", 1), ("v", 1)]
    assert rows(Q.freq(df, "v")) == [("a", 2), (None, 1)]
    other = spark.createDataFrame([(1, None), (2, "b"), (4, "a")], "k int, v string")
    as_key = lambda x: x.withColumnRenamed("k", "student_key").where("student_key is not null")
    assert rows(Q.mismatch_counts(as_key(df), as_key(other), ["v"])) == [("v", 2)]
    assert rows(Q.numeric_all(spark.createDataFrame([("1", "x")], "a string, b string"))) == [(1.0, None)]


def test_changed_values_of_approved_students(spark):
    table = spark.createDataFrame([(1, 5, "N"), (2, 5, None), (3, None, "N")], "student_key long, act int, is_approved string")
    file = spark.createDataFrame([(1, 6), (2, 6), (3, 0)], "student_key long, act int")
    out = Q.changed_values(table, file, {"updated_act": ("act", "act")})
    assert rows(out) == [(1, True)]


def test_lost_status_and_first_mismatches(spark):
    old = spark.createDataFrame([(1, "Y"), (2, "Y"), (3, "N")], "student_key long, readiness string")
    new = spark.createDataFrame([(1, "N"), (3, "N")], "student_key long, readiness string")
    assert rows(Q.lost_status(old, new), "student_key") == [(1,)]
    flagged = spark.createDataFrame([(k, k % 2 == 0) for k in range(20)] + [(50, None)], "student_key long, mismatch boolean")
    records = spark.range(20).select(F.col("id").alias("student_key"))
    assert rows(Q.first_mismatches(flagged, records)) == [(0,), (2,), (4,), (6,), (8,)]


def test_impact_of_lower_credit(spark):
    report = spark.createDataFrame(
        [(1, 0, 0, 0, 0, 0, 0, 30, None), (2, 0, 0, 0, 0, 0, 0, 10, None), (3, 1, 0, 0, 0, 0, 0, None, 1100), (4, 0, 0, 0, 0, 0, 0, None, None)],
        "student_key long, n_cambridge int, n_ap int, n_ib int, n_sdc int, n_ldc int, n_de int, act_composite int, sat_total int",
    )
    old, new = counts(spark, (1, 4), (2, 5), (3, 4), (4, 4), (9, 2)), counts(spark, (1, 3), (2, 1), (3, 0), (4, 2), (9, 1))
    assert rows(C.credit_impact(old, new, report)) == [(False, 1), (True, 2), (None, 1)]


# -- audits -------------------------------------------------------------------


def table(spark, *students):
    names = ["student_key", "readiness", "act_composite", "sat_total", "asvab", *EPSO_COUNT_COLUMNS]
    schema = "student_key long, readiness string, act_composite int, sat_total int, asvab int, " + ", ".join(f"{c} int" for c in EPSO_COUNT_COLUMNS)
    base = dict.fromkeys(EPSO_COUNT_COLUMNS, 0) | {"readiness": "N", "act_composite": None, "sat_total": None, "asvab": None}
    return spark.createDataFrame([tuple((base | s)[n] for n in names) for s in students], schema)


def test_audits(spark):
    df = table(
        spark,
        {"student_key": 1, "act_composite": 21}, {"student_key": 2, "sat_total": 1060}, {"student_key": 3, "n_adv_placement": 4},
        {"student_key": 4, "n_adv_placement": 4, "n_cambridge": None}, {"student_key": 5, "asvab": 31, "n_cambridge": 2},
        {"student_key": 6, "asvab": 31, "n_cambridge": 2, "n_dual_enrollment": None}, {"student_key": 7, "act_composite": 36, "readiness": "Y"},
    )
    assert rows(A.audit_act(df), "student_key") == [(1,)]
    assert rows(A.audit_sat(df), "student_key") == [(2,)]
    assert rows(A.audit_epso(df), "student_key") == [(3,), (4,)]
    assert rows(A.audit_epso(df, null_as_zero=False), "student_key") == [(3,)]
    assert rows(A.audit_asvab(df), "student_key") == [(5,), (6,)]
    fixed = A.apply_corrections(df)
    assert rows(fixed.where("correction is not null"), "student_key", "readiness", "correction") == [
        (1, "Y", "scores"), (2, "Y", "scores"), (3, "Y", "epso"), (5, "Y", "asvab"),
    ]


def test_pathways_keep_unknown_apart(spark):
    names = ["n_cambridge", "n_ap", "n_ib", "n_sdc", "n_ldc", "n_de", "clep"]
    schema = "student_key long, readiness string, act_composite int, sat_total int, industry_cert int, " + ", ".join(f"{n} int" for n in names)
    zero = (0,) * 6
    df = spark.createDataFrame(
        [(1, "Y", 25, None, 0, 0, *zero), (2, "Y", 10, None, 0, 4, *zero), (3, "Y", 10, 900, 4, None, *zero), (4, "N", 30, 900, 0, 0, *zero)], schema
    )
    assert rows(A.pathway_breakdown(df)) == [(False, None, None, 1), (True, False, False, 1), (None, True, True, 1)]


# -- monitoring ---------------------------------------------------------------


def test_changed_rows_is_a_null_safe_difference(spark):
    schema = "k int, v int"
    current = spark.createDataFrame([(1, 1), (2, None), (3, 3), (4, 4), (4, 4), (5, 5)], schema)
    previous = spark.createDataFrame([(2, None), (3, 9), (1, None)], schema)
    original = spark.createDataFrame([(3, 3), (8, 8)], schema)
    assert rows(M.changed_rows(current, previous, original)) == [(1, 1), (4, 4), (5, 5)]
    assert rows(M.changed_rows(current, previous, original)) == rows(current.subtract(previous).subtract(original))


def test_appeal_flags_and_comments(spark):
    changes = spark.createDataFrame([(1, 5.0), (2, None), (5, 7.0)], "student_key long, sat_math double")
    docs = spark.createDataFrame(
        [(1, "f", None, None), (2, "g", None, None), (3, "h", 1, None), (4, None, 0, None), (4, None, None, "old")],
        "student_key long, save_as_filename string, status int, comments string",
    )
    ids = spark.createDataFrame([(k, 10) for k in range(1, 6)], "student_key long, district_no int")
    flagged = M.appeal_flags(M.appeal_status(changes, docs, ids))
    assert rows(flagged, "student_key", "status", *M.FLAGS) == [
        (1, None, False, True, False, True), (2, None, True, False, False, False), (3, 1, True, False, False, False),
        (4, 0, False, False, False, False), (4, None, False, False, True, False), (5, None, False, False, True, True),
    ]
    comments = M.propose_comments(flagged).where("proposed_comment is not null")
    starts = comments.select("student_key", "status", F.substring("proposed_comment", 1, 8).alias("c"))
    assert rows(starts) == [(2, None, "No data "), (4, None, "No docum"), (5, None, "No docum")]
    names = spark.createDataFrame([(10, "Ten")], "system int, system_name string")
    totals = M.status_by_district(M.with_district_name(flagged, names))
    assert rows(totals) == [(10, "Ten", 2, 1, 2, 2)]


def test_status_flips(spark):
    history = spark.createDataFrame(
        [(1, "Y"), (1, "N"), (2, "Y"), (2, "Y"), (3, None), (3, "Y")], "student_key long, readiness string"
    )
    assert {r[0] for r in rows(M.status_flips(history))} == {1, 3}
