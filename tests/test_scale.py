"""Plan shapes and hot keys: what must hold when the tables are large."""

import re

import pytest
from pyspark.sql import functions as F

from helpers import d, rows
from pathways.functions.skew import join_unique
from pathways.operators import cohort as H
from pathways.operators import compare as Q
from pathways.operators import enrollment as E
from pathways.operators import monitor as M
from pathways.operators import counts as N
from pathways.operators import exams as X
from pathways.plans import domains as D
from pathways.plans.inputs import graduates
from workload.all_queries import QUERIES
from workload.names import PATTERNS
from workload.tables import Bound


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


PLANNED = [
    "course_enrollments", "segment_days", "attended_half", "end_dates_filled_by_year_and_course", "repeated_course_segments",
    "course_exam_scores_ap", "exam_only_credit", "cert_credit", "cert_credit_by_record", "student_report", "whole_cohort_file",
    "merged_final_values", "changed_rows", "weekly_status", "count_difference_distribution", "status_flips", "group_sizes_on_rows",
]


@pytest.mark.parametrize("name", PLANNED)
def test_no_pairwise_joins_or_single_task_windows(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "BatchEvalPython" not in text
    # The only window orders the distinct dates of one school year.
    for window in re.findall(r"Window \[.*", text):
        assert "id_date" in window
    # Nothing but one-row aggregates and the k of a top-k meets in one task.
    for line in text.splitlines():
        if "Exchange SinglePartition" in line:
            at = text[text.index(line) + len(line):]
            assert re.match(r"\s*[:+\-\s]*(\*\(\d+\) )?HashAggregate\(keys=\[\]", at), at[:200]


def test_scans_read_only_needed_columns(spark, small):
    b = Bound(spark, small)
    text = plan(N.count_rows(b.isp.where(F.col("withdrawal_reason").isNull())))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderpriority:string>" in text
    district = plan(H.for_district(b.snapshot_cur, 10).select("student_key"))
    assert "PushedFilters: [IsNotNull(c_nationkey), EqualTo(c_nationkey,10)]" in district
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in district


def test_unused_descriptions_are_pruned_from_counts(spark, small):
    b = Bound(spark, small)
    enr = E.course_enrollments(b.isp, b.sca, b.cs)
    days = E.count_days(E.attach_calendar(enr, E.calendar_index(b.calendar)))
    courses = E.course_rollup(E.segment_days(E.fill_end_dates(days, "class_only")))
    text = optimized(N.count_courses(E.min_share(courses)))
    assert "first_name" not in text and "max_by" not in text
    # The day arrays end at the join that brings them in: no later shuffle carries them.
    for line in plan(courses).splitlines():
        if "Exchange hashpartitioning(isp_id" in line or "Exchange hashpartitioning(student_key" in line:
            assert "running" not in line


@pytest.fixture()
def tight(spark):
    """Settings under which small data meets the skew and shuffle paths."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    run = df.select("*")
    run._jdf.queryExecution().executedPlan()
    run.collect()
    return run._jdf.queryExecution().executedPlan().toString()


def hot_enrollments(spark, n=60_000):
    """A third of all rows belong to one school year, one student and one course."""
    hot = F.col("id") % 3 == 0
    i = F.col("id")
    start = F.lit(d(1, 1))
    return spark.range(0, n, 1, 8).select(
        i.alias("isp_id"),
        F.when(hot, 1).otherwise(i % 5000).cast("bigint").alias("student_key"),
        F.lit(2014).alias("isp_school_year"),
        F.when(hot, 1).otherwise(2 + i % 200).cast("bigint").alias("school_bu_id"),
        F.lit(None).cast("int").alias("withdrawal_reason"),
        start.alias("begin_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.when(hot, 7).otherwise(i % 50).cast("int").alias("course_code"),
        F.date_add(start, (i % 20).cast("int")).alias("sca_begin_date"),
        F.when(i % 4 != 0, F.date_add(start, (30 + i % 30).cast("int"))).alias("sca_end_date"),
        F.date_add(start, (i % 9).cast("int")).alias("cs_begin_date"),
        F.lit(None).cast("date").alias("cs_end_date"),
        F.sha2(i.cast("string"), 256).alias("type_of_service"),
    )


def school_days(spark):
    return spark.range(202 * 90).select(
        (F.col("id") % 202).alias("school_bu_id"),
        F.lit(2014).alias("school_year"),
        F.date_add(F.lit(d(1, 1)), (F.col("id") / 202).cast("int")).alias("id_date"),
    ).where(F.dayofweek("id_date").between(2, 6))


def test_hot_school_year_is_split(tight):
    enr = hot_enrollments(tight)
    days = E.count_days(E.attach_calendar(enr, E.calendar_index(school_days(tight))))
    assert "skew=true" in final_plan(days)


def test_hot_course_fill_is_split_and_whole(tight):
    days = E.count_days(E.attach_calendar(hot_enrollments(tight), E.calendar_index(school_days(tight))))
    filled = E.fill_end_dates(days, "by_year_course")
    assert "skew=true" in final_plan(filled)
    assert filled.count() == 60_000
    assert filled.where("sca_end_date is null or cs_end_date is null").count() == 0


@pytest.mark.parametrize("salts", [1, 4])
@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_equals_plain_join(spark, how, salts):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c"), (3, None), (None, "d")], "k int, v string")
    lookup = spark.createDataFrame([(1, 10), (2, 20), (9, 90)], "k int, w int")
    assert rows(join_unique(df, lookup, ["k"], how, salts)) == rows(df.join(lookup, "k", how))


def test_salted_lookup_spreads_a_hot_key_without_adaptive_execution(spark):
    df = spark.range(9000).select(F.lit(1).alias("k"), "id")
    lookup = spark.range(10).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("w"))
    before = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_unique(df, lookup, ["k"], "inner", salts=16)
        used = joined.select(F.spark_partition_id().alias("p")).distinct().count()
        assert used > 1 and joined.count() == 9000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before[0])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[1])


def test_hot_student_exams_are_split(tight):
    exams = tight.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("student_id"), F.sha2(F.col("id").cast("string"), 256).alias("test_longname")
    )
    cohort = tight.range(0, 60_000).select(F.col("id").alias("student_key"), F.lit("Y").alias("included_in_cohort"), F.lit(1).alias("completion_type"))
    out = X.cohort_exams(H.counted_students(cohort), exams)
    assert "skew=true" in final_plan(out)
    assert out.count() == 60_000
    every = X.cohort_exams(H.counted_students(cohort), exams, "left")
    assert every.count() == cohort.join(exams, F.col("student_key") == F.col("student_id"), "left").count()


def test_hot_key_totals_equal_brute_force(spark):
    enr = hot_enrollments(spark, 6_000)
    cal = school_days(spark)
    days = E.count_days(E.attach_calendar(enr, E.calendar_index(cal)))
    courses = E.course_rollup(E.segment_days(E.fill_end_dates(days, "global")))
    dates = {}
    for r in cal.collect():
        dates.setdefault(r.school_bu_id, []).append(r.id_date)
    top = max(max(v) for v in dates.values())
    total, largest = {}, {}
    for r in enr.collect():
        end = r.sca_end_date or top
        n = sum(r.sca_begin_date <= x <= end for x in dates[r.school_bu_id])
        c = sum(r.cs_begin_date <= x <= end for x in dates[r.school_bu_id])
        key = (r.student_key, r.course_code)
        total[key] = total.get(key, 0) + n
        largest[key] = max(largest.get(key, 0), c)
    expected = sorted(((*k, total[k], largest[k]) for k in total), key=lambda t: tuple((False, str(v)) for v in t))
    assert rows(courses, "student_key", "course_code", E.ENROLLED_DAYS, E.COURSE_DAYS) == expected


def test_hot_student_documents_are_split(tight):
    docs = tight.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("student_key"),
        F.concat(F.lit("a long enough document name "), F.sha2(F.col("id").cast("string"), 256)).alias("save_as_filename"),
        F.lit(None).cast("int").alias("status"),
    )
    changes = tight.range(2000).select(F.col("id").alias("student_key"), F.lit(1.0).alias("sat_math"))
    ids = tight.range(90_000).select(F.col("id").alias("student_key"), F.lit(1).alias("district_no"))
    status = M.appeal_status(changes, docs, ids)
    assert "skew=true" in final_plan(status)
    whole = docs.join(changes, "student_key", "full").count()
    assert status.count() == whole


def test_copies_of_exam_records_do_not_multiply(spark):
    """One student with a third of all records: courses times levels, not times records."""
    exams = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") + 2).cast("double").alias("student_id"),
        F.lit("AP_2018").alias("test_administration_cd"),
        F.lit("BIOL").alias("sublevel1_shortname"),
        (F.col("id") % 5 + 1).cast("string").alias("assessment_result_number_score"),
    )
    courses = spark.range(1000).select(F.lit(1).cast("bigint").alias("student_key"), F.col("id").cast("int").alias("course_code"), F.lit("BIOL").alias("exam_name"))
    out = X.add_exam_score(courses, exams, "sublevel1_shortname")
    assert out.count() == 5000
    assert out.where("course_code = 0").agg(F.sum("n_exams")).first()[0] == 10_000


def test_group_counts_keep_every_row_of_a_hot_group(spark):
    df = hot_enrollments(spark, 9_000)
    out = E.with_group_counts(df, ["student_key"], "course_code")
    assert out.count() == 9_000
    hot = rows(out.where("student_key = 1").select("n").distinct())
    assert hot == [(df.where("student_key = 1").count(),)]


def test_results_do_not_depend_on_broadcasts(tight, small):
    b = Bound(tight, small)
    rules = graduates(patterns=PATTERNS)
    shuffled = rows(D.course_counts(b, rules), "student_key", "epso_type", "n_courses")
    tight.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert shuffled == rows(D.course_counts(Bound(tight, small), rules), "student_key", "epso_type", "n_courses")


def test_percentages_need_no_single_task_window(spark):
    a = spark.range(100).select(F.col("id").alias("student_key"), (F.col("id") % 3).alias("n_courses"))
    out = Q.diff_distribution(a, a.withColumn("n_courses", F.lit(1).cast("bigint")), ["student_key"])
    assert "Window" not in plan(out)
    assert rows(out) == [(-1, 34, 34.0), (0, 33, 33.0), (1, 33, 33.0)]
