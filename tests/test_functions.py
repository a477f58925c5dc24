import datetime as dt

from pyspark.sql import functions as F

from helpers import rows
from pathways.functions import dates, nulls, text


def test_n_distinct_counts_missing_as_a_value(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), ("b", None), ("c", 2)], "k string, v int")
    out = df.groupBy("k").agg(nulls.n_distinct("v").alias("n"))
    assert rows(out, "k", "n") == [("a", 2), ("b", 1), ("c", 1)]


def test_sum_of_nothing_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("b", 2)], "k string, v int")
    assert rows(df.groupBy("k").agg(nulls.sum0("v").alias("s"))) == [("a", 0), ("b", 2)]


def test_larger_of_two_is_missing_when_either_is(spark):
    df = spark.createDataFrame([(1, 2), (3, None), (None, None)], "a int, b int")
    assert rows(df.select(nulls.pmax_na("a", "b").alias("m"))) == [(2,), (None,), (None,)]
    text_values = spark.createDataFrame([("N", "Y")], "a string, b string")
    assert rows(text_values.select(nulls.pmax_na("a", "b").alias("m"))) == [("Y",)]


def test_share_without_division(spark):
    df = spark.createDataFrame([(1, 2), (0, 0), (3, 0), (1, 3), (None, 2)], "part int, whole int")
    kept = df.where(nulls.share_at_least("part", "whole", 0.5))
    assert rows(kept) == [(1, 2), (3, 0)]


def test_join_matches_missing_with_missing(spark):
    left = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "id int, name string")
    right = spark.createDataFrame([(None, 10), ("x", 20), ("z", 30)], "name string, v int")
    assert rows(nulls.join_na(left, right, ["name"]), "id", "v") == [(1, 10), (2, 20), (3, None)]
    full = nulls.join_na(left, right, ["name"], "full")
    assert rows(full, "name", "id", "v") == [("x", 2, 20), ("y", 3, None), ("z", None, 30), (None, 1, 10)]
    renamed = right.withColumnRenamed("name", "other")
    assert rows(nulls.join_na(left, renamed, [("name", "other")]), "id", "v") == [(1, 10), (2, 20), (3, None)]


def test_exclusion_keeps_missing(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    assert rows(df.where(nulls.not_in_keep_null("v", (1,)))) == [(2,), (None,)]


def test_whole_number_truncates(spark):
    df = spark.createDataFrame([("69.9",), ("70",), ("x",), (None,)], "v string")
    assert rows(df.select(nulls.to_whole("v").alias("n"))) == [(69,), (70,), (None,), (None,)]


def test_names():
    assert text.snake_case("Course Code") == "course_code"
    assert text.snake_case("StudentKey") == "student_key"
    assert text.snake_case("2018 Brand (%)") == "x2018_brand"


def test_repeated_names_get_a_suffix(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` int, `a_B` int")
    assert text.clean_names(df).columns == ["a_b", "a_b_2"]


def test_replace_first_only(spark):
    df = spark.createDataFrame([("a-b-c",)], "v string")
    assert rows(df.select(text.replace_first("v", "-").alias("r"))) == [("ab-c",)]


def test_first_match_skips_missing_conditions(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "v int")
    out = df.select(
        text.first_match([(F.col("v") > 3, F.lit("big")), (F.lit(True), F.lit("rest"))]).alias("r")
    )
    assert rows(out) == [("big",), ("rest",), ("rest",)]


def test_date_text(spark):
    df = spark.createDataFrame([("06-AUG-14",), ("nonsense",), (None,)], "v string")
    assert rows(df.select(dates.day_month_year("v").alias("x"))) == [(dt.date(2014, 8, 6),), (None,), (None,)]
    iso = spark.createDataFrame([("2014-08-06", "2014-08-06 10:00:00")], "a string, b string")
    out = iso.select(dates.year_month_day("a").alias("a"), dates.year_month_day_time("b").alias("b"))
    assert rows(out) == [(dt.date(2014, 8, 6), dt.datetime(2014, 8, 6, 10))]
