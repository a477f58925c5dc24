from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helpers import rows
from pathways.operators import certs as C
from pathways.operators import counts as N
from pathways.operators import crosswalk as K
from pathways.operators import exams as X
from pathways.rules import exam_rules

EXAM = "student_id long, test_administration_cd string, sublevel1_shortname string, assessment_result_number_score string"


# -- crosswalk ----------------------------------------------------------------


def test_one_exam_name_per_code_first_line_wins(spark):
    table = {r.course_code: r.exam_name for r in K.exam_name_table(spark).collect()}
    assert len(table) == len({code for _, _, code in exam_rules()})
    assert {table[c] for c in (3163, 3164, 6362)} == {"GERMANA"}
    assert table[6396] == table[6397] == "SPANISHAB"
    assert table[3165] == table[6363] == "GERMANB"
    assert table[4270] == "IAGRIBUS"
    assert "GERMANALAL" not in table.values() and "GERMANAB" not in table.values()


def test_crosswalk_types_by_first_pattern(spark):
    catalog = spark.createDataFrame(
        [(3217, "AP Biology"), (1, "MAP IB"), (4150, "CIE Biology"), (2, "ap small"), (6434, "SDC History"), (3, "Dual Enrollment X")],
        "course_code int, course_title string",
    )
    assert rows(K.epso_crosswalk(catalog), "course_code", "epso_type", "exam_name") == [
        (1, "AP", None), (3, "DE", None), (3217, "AP", "BIOL"), (4150, "CIE", "CAMBRIDGE BIOLOGY"), (6434, "SDC", "AMHIST"),
    ]


def test_title_lookup_does_not_multiply(spark):
    df = spark.createDataFrame([(1,), (None,)], "course_code int")
    catalog = spark.createDataFrame([(1, "b"), (1, "a"), (None, "none")], "course_code int, course_title string")
    assert rows(K.add_title(df, catalog), "course_code", "course_title") == [(1, "a"), (None, "none")]


def test_conversion_credit_text(spark):
    df = spark.createDataFrame(
        [("a", "EPSO ONLY"), ("a", "1 EPSO"), ("b", "2 EPSO"), ("c", None), ("d", "none"), ("e", "ONLY 1 EPSO")],
        "cert_name string, conversion string",
    )
    assert rows(K.best_conversion(df)) == [("a", 3), ("b", 4), ("c", None), ("d", None), ("e", 2)]


def test_catalog_years_side_by_side(spark):
    one = spark.createDataFrame([(1, "Dual Enrollment A"), (2, "Other")], "course_code int, course_title string")
    two = spark.createDataFrame([(1, "Dual Enrollment B"), (3, "Dual Enrollment C")], "course_code int, course_title string")
    out = K.reconcile_catalogs({"2019": one, "2018": two}, "Dual Enrollment")
    assert rows(out) == [(1, "Dual Enrollment A", "Dual Enrollment B"), (3, None, "Dual Enrollment C")]


# -- exams --------------------------------------------------------------------


def test_score_rules(spark):
    df = spark.createDataFrame([("2",), ("3",), ("50",), ("9",), ("abc",), (None,)], "performance_level string")
    assert rows(X.passing(df, "ap")) == [("3",)]
    assert rows(X.passing(df, "clep")) == [("50",)]
    assert len(rows(X.passing(df, "present"))) == 5


def test_exam_name_normalisation(spark):
    df = spark.createDataFrame([("2018-06 BIO-3",), ("1934 A",)], "test_administration_desc string")
    assert rows(X.normalize_exam_name(df)) == [("934 A",), (" BIO3",)] or rows(X.normalize_exam_name(df)) == [(" BIO3",), ("934 A",)]


def test_evidence_matches_missing_names_and_counts_copies(spark):
    courses = spark.createDataFrame([(1, 100, None), (1, 200, "BIO"), (2, 200, "BIO")], "student_key long, course_code int, exam_name string")
    exams = spark.createDataFrame(
        [(1, "AP_18", None, "4"), (1, "AP_18", None, "4"), (1, "AP_18", "BIO", "2"), (1, "AP_18", "BIO", "5")], EXAM
    )
    out = X.add_exam_score(courses, exams, "sublevel1_shortname")
    assert rows(out, "student_key", "course_code", "performance_level", "n_exams") == [
        (1, 100, "4", 2), (1, 200, "2", 1), (1, 200, "5", 1), (2, 200, None, None),
    ]


def test_exam_alone_gives_credit(spark):
    students = spark.createDataFrame([(1,), (2,)], "student_key long")
    exams = spark.createDataFrame(
        [(1, "AP_18", "BIO", "3"), (1, "AP_18", "XX", "5"), (2, "AP_18", "BIO", "2"), (3, "AP_18", "BIO", "5"), (2, "AP_18", None, "4")], EXAM
    )
    xw = spark.createDataFrame([("BIO", 100), ("BIO", 101), (None, 102)], "exam_name string, course_code int")
    out = X.exam_only_courses(students, exams, xw, "sublevel1_shortname")
    assert rows(out, "student_key", "course_code") == [(1, 100), (1, 101), (1, None), (2, 102)]
    assert len(rows(X.mapped_only(out))) == 3
    credit = X.exam_only_credit(students, exams, xw, "sublevel1_shortname")
    assert rows(credit, "student_key", "n_courses") == [(1, 2), (2, 1)]


def test_exam_groups_count_a_course_once(spark):
    """A course under two names is credited once, whichever exams were passed."""
    students = spark.createDataFrame([(1,), (2,)], "student_key long")
    exams = spark.createDataFrame([(1, "AP_18", "BIO", "3"), (1, "AP_18", "CHEM", "3"), (2, "AP_18", "CHEM", "5")], EXAM)
    xw = spark.createDataFrame([("BIO", 100), ("CHEM", 100), ("CHEM", 101), ("BIO", 102), ("BIO", None)], "exam_name string, course_code int")
    listed = X.exam_only_courses(students, exams, xw, "sublevel1_shortname").where("course_code is not null")
    expected = rows(listed.groupBy("student_key").agg(F.count_distinct("course_code").alias("n")))
    credit = X.exam_only_credit(students, exams, xw, "sublevel1_shortname")
    assert rows(credit.groupBy("student_key").agg(F.sum("n_courses").alias("n"))) == expected == [(1, 3), (2, 2)]


def test_diploma_and_unnamed_are_dropped(spark):
    df = spark.createDataFrame([("BIO",), ("BIO DIPLOMA",), (None,)], "exam_name string")
    assert rows(X.drop_diploma(df)) == [("BIO",)]


def test_exam_files_of_three_years(spark):
    a = spark.createDataFrame([(1, 7, "55.5")], "code int, student_no long, exam_score string")
    a = a.withColumns({"exam_cut_score": F.lit(50.0), "exam_result": F.lit("P"), "system": F.lit(3)})
    b = spark.createDataFrame([(2, 8, 40.0, 50.0, "F", 4)], "course_code int, student_id long, exam_score double, exam_cut_score double, exam_result string, district int")
    out = X.sdc_exams((a, {"course_code": "code", "student_id": "student_no"}), (b, {"system": "district"}))
    assert rows(out) == [(1, 7, 55.5, 50.0, "P", 3), (2, 8, 40.0, 50.0, "F", 4)]


def test_courses_against_exams(spark):
    enr = spark.createDataFrame([(1, 10), (1, 10), (1, None), (2, 5)], "student_key long, course_code int")
    exams = spark.createDataFrame([(1, "AP_18", "BIO", "3"), (3, "AP_18", None, "3")], EXAM)
    assert rows(X.courses_vs_exams(enr, exams, "sublevel1_shortname")) == [(1, 2, 1), (2, 1, None), (3, None, 1)]


# -- counts -------------------------------------------------------------------


def test_merged_counts(spark):
    a = spark.createDataFrame([(1, 2), (2, 5)], "student_key long, n_courses long")
    b = spark.createDataFrame([(2, 3), (3, 1)], "student_key long, n_courses long")
    assert rows(N.merge_counts(a, b, "max")) == [(1, 2), (2, 5), (3, 1)]
    assert rows(N.merge_counts(a, b, "sum")) == [(1, 2), (2, 8), (3, 1)]


def test_pivot_takes_the_best_count(spark):
    df = spark.createDataFrame([(1, "ap", 2), (1, "ap", 3), (1, "sdc", 1), (2, "ic", 0)], "student_key long, epso_type string, n_courses long")
    wide = N.pivot_types(df)
    assert wide.columns == ["student_key", "ap", "cie", "clep", "de", "ib", "ic", "ldc", "sdc"]
    assert rows(wide, "student_key", "ap", "ic", "sdc") == [(1, 3, None, 1), (2, None, 0, None)]
    assert rows(N.zero_fill(wide, ["ap", "ic"]), "student_key", "ap", "ic", "sdc") == [(1, 3, 0, 1), (2, 0, 0, None)]
    assert rows(N.max_per_type(df)) == [(1, "ap", 3), (1, "sdc", 1), (2, "ic", 0)]


# -- certifications -----------------------------------------------------------


def named(spark, *names):
    df = spark.createDataFrame([(n,) for n in names], "cert_name string")
    return {r.cert_name: r.standard_name for r in C.standardize_cert(df).collect()}


def test_standard_names(spark):
    out = named(
        spark, "CompTIA Advanced", "CompTIA Network+ N10", "My Welding Level 1", "Welding Level Two", "Safety",
        "Microsoft Word", "Microsoft Word Expert", "Microsoft Excel Expert", "Unknown", None, "HXEXAXT",
        "Carpentry Level 2", "Foundational Knowledge", "EPA 608", "Heat Pump Gas Heat",
    )
    assert out["CompTIA Advanced"] == "CompTIA A+"
    assert out["CompTIA Network+ N10"] == "CompTIA Network+"
    assert out["My Welding Level 1"] == "American Welding Society SENSE Entry Level (1)"
    assert out["Welding Level Two"] == "American Welding Society SENSE Advanced Level (2)"
    assert out["Safety"] == "Certified Production Certification (CPT)"
    assert out["Microsoft Word"] == "Microsoft Office Specialist (Word Core)"
    assert out["Microsoft Word Expert"].startswith("Microsoft Office Expert")
    assert out["Microsoft Excel Expert"] == "Microsoft Excel Expert"
    assert out["Unknown"] == "Unknown" and out[None] is None
    assert out["HXEXAXT"].startswith("HVAC Excellence")
    assert out["Carpentry Level 2"] == "NCCER Carpentry Level Two"
    assert out["Foundational Knowledge"] == "Certified Logistics Technician"
    assert out["Heat Pump Gas Heat"] == "Gas"
    whole = spark.createDataFrame([("Foundational Knowledge",)], "cert_name string")
    assert rows(C.standardize_cert(whole, "whole"), "standard_name") == [("Foundational Knowledge",)]


def test_unmarked_records_are_not_failed(spark):
    df = spark.createDataFrame([("Fail",), ("FAIL",), ("No",), ("--",), ("Pass",), (None,)], "pass_fail string")
    assert rows(C.drop_failed(df)) == [("Pass",), (None,)]
    assert rows(C.drop_failed(df, "whole")) == [("--",), ("Pass",), (None,)]


def test_acceptance(spark):
    df = spark.createDataFrame(
        [(1, None, "10"), (2, "Pass", "10"), (3, "Score 70", "69.9"), (4, "Score 70", "70"), (5, "Other", "99"), (6, "Score 70", None)],
        "id int, pass_rule string, test_score string",
    )
    assert rows(C.accept_certs(df), "id") == [(1,), (2,), (4,)]


CERT = "student_key long, cert_name string, standard_name string, n_epso int"
CPT = "Certified Production Certification (CPT)"


def credit(spark, *certs, **options):
    return dict((r.student_key, r.n_courses) for r in C.cert_credit(spark.createDataFrame(list(certs), CERT), **options).collect())


def test_credit_and_bundle(spark):
    parts = [(1, p, CPT, 9) for p in ("a", "b", "c", "d")]
    certs = [
        *parts, (1, "x", "X", 3), *[(2, p, CPT, 9) for p in ("a", "b", "c")], (2, "x", "X", 3),
        (3, "x", "X", None), (4, "x", "X", 4), (4, "y", "Y", 3), (4, "z", "Z", None), (5, "a", CPT, 9), (6, "n", None, 4),
    ]
    assert credit(spark, *certs) == {1: 6, 2: 3, 3: 0, 4: 6}
    assert credit(spark, *certs, legacy_bundle=True) == {1: 3, 2: 3, 3: 0, 4: 6}
    frame = spark.createDataFrame(certs, CERT)
    assert rows(C.bundle_credit(frame), "student_key", "n_courses") == [(1, 4)]


def test_closed_form_equals_ranking(spark):
    certs = spark.range(3000).select(
        (F.col("id") % 97).alias("student_key"), F.col("id").cast("string").alias("cert_name"), F.lit("X").alias("standard_name"),
        F.when(F.col("id") % 5 != 0, F.col("id") % 4 + 1).cast("int").alias("n_epso"),
    )
    rank = F.row_number().over(W.partitionBy("student_key").orderBy(F.desc_nulls_last("n_epso")))
    ranked = certs.withColumn("v", F.when(rank == 1, F.col("n_epso")).otherwise(F.col("n_epso") - 1))
    by_rank = ranked.groupBy("student_key").agg(F.coalesce(F.sum("v"), F.lit(0)).alias("n_courses"))
    assert rows(C.cert_credit(certs), "student_key", "n_courses") == rows(by_rank)
    rowwise = C.decrement_after_first(certs, "n_epso", ["cert_name"]).groupBy("student_key").agg(F.sum("n_epso").alias("n"))
    assert rows(rowwise) == rows(by_rank)


def test_credit_lookup_falls_back(spark):
    certs = spark.createDataFrame([("a", "f", "A"), ("b", "f", "B"), ("c", "f", None)], "cert_name string, source_file string, standard_name string")
    approved = spark.createDataFrame(
        [("b", "f", "New", "Pass", "x"), ("a", "f", "New", "Pass", "n"), ("a", "g", "New", None, "x")],
        "cert_name string, source_file string, new_cert string, pass_fail string, promoted string",
    )
    conversion = spark.createDataFrame([("A", 2), ("New", 4)], "cert_name string, n_epso int")
    out = C.lookup_credit(certs, approved, conversion)
    assert rows(out, "cert_name", "new_cert", "pass_rule", "n_epso") == [("a", None, None, 2), ("b", "New", "Pass", 4), ("c", None, None, None)]


def test_non_numeric_students_are_dropped(spark):
    df = spark.createDataFrame([("12",), ("X3",), (None,), ("7.0",)], "student_id string")
    assert rows(C.numeric_student(df), "student_key") == [(12,), (7,)]


def test_recoded_credit(spark):
    records = spark.createDataFrame([(1, "1 credit"), (1, "2"), (2, "Industry Certification"), (3, "none")], "student_key long, epso_ic string")
    counts = spark.createDataFrame([(1, 5), (2, 3), (4, 1)], "student_key long, n_courses long")
    assert rows(C.recode_and_compare(records, counts), "student_key", "n_recoded", "n_courses", "mismatch") == [
        (1, 5, 5, False), (2, 4, 3, True), (3, 0, None, None), (4, None, 1, None),
    ]
