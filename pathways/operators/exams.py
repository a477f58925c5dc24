"""Exam records as evidence for courses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import as_col, join_na, to_number
from ..functions.skew import join_unique
from ..functions.text import has, replace_first
from ..rules import AP_PASSING, CLEP_PASSING
from .crosswalk import exam_groups

SCORE = "assessment_result_number_score"


def exams_for(exams: DataFrame, domain: str) -> DataFrame:
    """Exams of one vendor, by the prefix in the administration code."""
    return exams.where(has("test_administration_cd", f"{domain.upper()}_"))


def valid_score(rule: str, score: Column | str) -> Column:
    score = as_col(score)
    if rule == "ap":
        return score.isin(*AP_PASSING)
    if rule == "clep":
        return to_number(score) >= CLEP_PASSING
    if rule == "present":
        return score.isNotNull()
    raise ValueError(f"unknown score rule: {rule}")


def passing(df: DataFrame, rule: str, score: str = "performance_level") -> DataFrame:
    return df.where(valid_score(rule, score))


def normalize_exam_name(df: DataFrame, column: str = "test_administration_desc") -> DataFrame:
    """Drop session digits and hyphens from the exam administration text.

    The digits 3, 4 and 9 and all spaces stay.
    """
    cleared = F.regexp_replace(column, "[-2015678]", "")
    return df.withColumn(column, replace_first(cleared, "-"))


def not_diploma(name: Column | str) -> Column:
    return ~has(name, "DIPLOMA")


def drop_diploma(df: DataFrame, column: str = "exam_name") -> DataFrame:
    """Drop diploma exams and rows without an exam name."""
    return df.where(F.col(column).isNotNull() & not_diploma(column))


def mapped_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("course_code").isNotNull())


def add_exam_name(df: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Exam name(s) of each course; a course listed under two names gives two rows."""
    return join_na(df, crosswalk.select("course_code", "exam_name"), ["course_code"])


def evidence(exams: DataFrame, name_column: str) -> DataFrame:
    """Exam results by student, exam and level, with how often each occurs.

    Repeated records collapse before any join, so a student with very many
    copies of a result does not multiply the course rows.
    """
    return (
        exams.groupBy(
            F.col("student_id").cast("bigint").alias("student_key"),
            F.col(name_column).alias("exam_name"),
            F.col(SCORE).alias("performance_level"),
        )
        .agg(F.count("*").alias("n_exams"))
    )


def add_exam_score(df: DataFrame, exams: DataFrame, name_column: str) -> DataFrame:
    """Courses with the student's results in the course's exam.

    Missing exam names match each other. Equal results appear once, counted in
    ``n_exams``; courses without a result stay with a missing level.
    """
    return join_na(df, evidence(exams, name_column), ["student_key", "exam_name"])


def passed_exams(
    students: DataFrame, exams: DataFrame, name_column: str, rule: str = "ap"
) -> DataFrame:
    """(student, exam name) passed by counted students, each once."""
    passed = passing(evidence(exams, name_column), rule)
    named = passed.select("student_key", "exam_name").distinct()
    return join_unique(named, students.select("student_key"), ["student_key"], "left_semi")


def exam_only_courses(
    students: DataFrame, exams: DataFrame, crosswalk: DataFrame, name_column: str, rule: str = "ap"
) -> DataFrame:
    """The courses credited for a valid exam alone, one row per exam and course."""
    passed = passed_exams(students, exams, name_column, rule)
    return join_na(passed, crosswalk.select("exam_name", "course_code"), ["exam_name"])


def exam_only_credit(
    students: DataFrame, exams: DataFrame, crosswalk: DataFrame, name_column: str, rule: str = "ap"
) -> DataFrame:
    """Number of courses credited for valid exams alone, by group of courses.

    (student_key, exam_group, n_courses): groups hold each course once, so the
    numbers add up to the distinct courses without listing them.
    """
    groups = exam_groups(crosswalk)
    sizes = groups.groupBy("exam_group").agg(F.count("*").alias("n_courses"))
    names = (
        crosswalk.select("course_code", "exam_name")
        .join(groups, "course_code")
        .select("exam_name", "exam_group")
        .distinct()
    )
    passed = passed_exams(students, exams, name_column, rule)
    hit = join_na(passed, names, ["exam_name"], "inner").select("student_key", "exam_group")
    return join_unique(hit.distinct(), sizes, ["exam_group"], "inner")


def cohort_exams(students: DataFrame, exams: DataFrame, how: str = "inner") -> DataFrame:
    """Counted students, each once, with their exam records."""
    records = exams.withColumn("student_key", F.col("student_id").cast("bigint")).drop("student_id")
    mine = students.select("student_key")
    matched = join_unique(records, mine, ["student_key"], "inner")
    if how == "inner":
        return matched
    if how != "left":
        raise ValueError(f"exams cannot be joined with: {how}")
    # Students without a record are added, so that the many side stays on the left.
    without = mine.join(records.select("student_key").distinct(), "student_key", "left_anti")
    return matched.unionByName(without, allowMissingColumns=True)


def sdc_exams(*files: tuple[DataFrame, dict[str, str]]) -> DataFrame:
    """Exam files of several years under common names: ``(file, {common: own})``."""
    kinds = {
        "course_code": "int", "student_id": "bigint", "exam_score": "double",
        "exam_cut_score": "double", "exam_result": "string", "system": "int",
    }

    def common(df: DataFrame, own: dict[str, str]) -> DataFrame:
        return df.select(
            *[F.col(own.get(c, c)).try_cast(kind).alias(c) for c, kind in kinds.items()]
        )

    return reduce(DataFrame.unionByName, [common(df, own) for df, own in files])


def match_records(records: DataFrame, exams: DataFrame) -> DataFrame:
    """A district's own record list with the exam file's rows of those students."""
    mine = exams.withColumnRenamed("student_id", "student_key")
    matched = join_unique(mine, records, ["student_key"], "inner")
    without = records.join(mine.select("student_key").distinct(), "student_key", "left_anti")
    columns = [*records.columns, *[c for c in mine.columns if c != "student_key"]]
    return matched.unionByName(without, allowMissingColumns=True).select(*columns)


def courses_vs_exams(enrollments: DataFrame, exams: DataFrame, name_column: str) -> DataFrame:
    """Distinct courses against distinct exams per student.

    Both sides reduce to distinct pairs, then stack into one aggregation.
    """
    courses = enrollments.select(
        "student_key", F.lit("course").alias("kind"), F.col("course_code").cast("string").alias("item")
    )
    taken = exams.select(
        F.col("student_id").cast("bigint").alias("student_key"),
        F.lit("exam").alias("kind"),
        F.col(name_column).alias("item"),
    )
    pairs = courses.unionByName(taken).distinct()

    def number(kind: str) -> Column:
        n = F.count_if(F.col("kind") == kind)
        return F.when(n > 0, n)

    return pairs.groupBy("student_key").agg(
        number("course").alias("n_courses"), number("exam").alias("n_exams")
    )
