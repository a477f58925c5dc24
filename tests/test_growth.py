"""What is shuffled as the tables grow: each row once for each join, in the columns that are needed."""

import pytest
from pyspark.sql import functions as F

from helpers import d
from pathways.functions.skew import join_measured
from pathways.operators import enrollment as E
from pathways.operators import spells as S
from workload.all_queries import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["end_dates_filled_by_year_and_course", "enrollment_spells_by_school_year", "courses_repeated_apart", "repeated_course_segments"]
)
def test_enrollments_are_joined_once(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "lineitem.parquet" not in text and "orders.parquet" not in text


def test_segments_carry_no_section_columns(spark, small):
    assert "post_secondary_institution" not in plan(QUERIES["attended_half"](spark, small))


def test_measured_join_computes_its_rows_once(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    lookup = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = join_measured(df.groupBy("k", "id").agg(F.count("*").alias("n")), lookup, ["k"], "inner", partitions=4)
    assert "HashAggregate" not in plan(joined)
    assert joined.agg(F.count("*"), F.sum("n"), F.sum("v")).first()[:] == (2000, 2000, 2 * sum(range(1, 2000, 2)))


def test_small_calendar_is_broadcast_without_a_shuffle(spark):
    school, year = (F.col("id") % 2).alias("school_bu_id"), (2014 + F.col("id") % 3).cast("int")
    days = spark.range(90).select(
        school, year.alias("school_year"), F.date_add(F.lit(d(1, 1)), F.col("id").cast("int")).alias("id_date")
    )
    rows = spark.range(1_000_000).select(school, year.alias("isp_school_year"), "id")
    text = plan(E.attach_calendar(rows, E.calendar_index(days)))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


ASSIGNED = "isp_id long, instructional_program_num long, local_class_number int, school_bu_id long, school_year int, sca_begin_date date"


def test_enrollments_of_periods_are_those_of_the_full_join(spark):
    sca = spark.createDataFrame(
        [(1, 7, 1, 3, 2014, d(1, 1)), (1, 7, 1, 3, 2014, d(1, 1)), (2, 7, 1, 4, 2014, d(1, 2)), (None, 7, 1, 3, 2014, None), (3, None, 1, 3, 2014, None)],
        ASSIGNED,
    )
    cs = spark.createDataFrame([(7, 1, 3, 2014, 70), (7, 1, 4, 2014, 71), (7, 1, 3, 2014, 72), (None, 1, 3, 2014, 73)],
        "instructional_program_num long, local_class_number int, school_bu_id long, school_year int, course_code int")
    isp = spark.createDataFrame([(1, 10, 2013, 9), (1, 11, 2014, None), (2, 12, 2014, 4), (None, 13, 2014, 3), (3, 14, 2014, 3)],
        "isp_id long, student_key long, school_year int, school_bu_id long")
    want = E.course_enrollments(isp, sca, cs)
    got = E.enrollments_of_periods(isp, sca, cs)
    assert sorted(got.columns) == sorted(want.columns)
    order = lambda df: sorted(map(str, df.select(*want.columns).collect()))
    assert order(got) == order(want) and len(order(want)) == 9


def test_spells_from_days(spark):
    rows = [("a", d(1, 1), d(1, 5)), ("a", d(1, 1), d(1, 2)), ("a", d(1, 6), d(1, 3)), ("a", d(2, 1), None), ("a", None, d(1, 1)), (None, d(1, 1), d(1, 1))]
    df = spark.createDataFrame(rows, "k string, b date, e date")
    got = {(r.k, r.spell): (r.b, r.e, r.n_intervals) for r in S.spells(df, ["k"], "b", "e").collect()}
    assert got == {
        ("a", 1): (d(1, 1), d(1, 5), 2), ("a", 2): (d(1, 6), d(1, 6), 1), ("a", 3): (d(2, 1), None, 1), (None, 1): (d(1, 1), d(1, 1), 1),
    }
