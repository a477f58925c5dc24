import pytest
from pyspark.sql import functions as F

from helpers import rows
from pathways.session import reuse, scratch_path, shared_dir
from pathways.sources import readers, schemas, writers


def test_cohort_file_keeps_unknown_columns_as_text(spark, tmp_path):
    df = spark.createDataFrame([(1, None, 11, "x"), (2, "B", None, None)], "`Student Key` long, `First Name` string, `Completion Type` int, Other string")
    path = writers.write_csv(df, f"{tmp_path}/cohort")
    back = readers.read_cohort(spark, path)
    assert dict(back.dtypes) == {"student_key": "bigint", "first_name": "string", "completion_type": "int", "other": "string"}
    assert rows(back) == [(1, None, 11, "x"), (2, "B", None, None)]
    coded = readers.read_cohort(spark, path, "dcdc")
    assert dict(coded.dtypes)["completion_type"] == "double"


def test_type_codes_of_the_cohort_file():
    codes = schemas.COHORT_FILE_CODES
    schema = schemas.schema_from_codes([f"c{n}" for n in range(46)], codes)
    kinds = [f.dataType.simpleString() for f in schema]
    assert (kinds.count("string"), kinds.count("double"), kinds.count("timestamp")) == (30, 11, 5)
    with pytest.raises(ValueError):
        schemas.schema_from_codes(["a"], codes)


def test_tab_extract(spark, tmp_path):
    df = spark.createDataFrame([(5.0, "AP_2018", None), (6.0, "a,b", "4")], "`Student ID` double, `Test Administration CD` string, assessment_result_number_score string")
    path = writers.write_csv(df, f"{tmp_path}/extract", sep="\t")
    back = readers.read_extract(spark, path, schemas.EXAMS)
    assert rows(back) == [(5.0, "AP_2018", None), (6.0, "a,b", "4")]


def test_history_and_latest_snapshot(spark, tmp_path):
    schema = schemas.fields("student_key long, readiness string")
    for day in ("2019-01-04", "2019-01-11"):
        writers.write_csv(spark.createDataFrame([(1, day)], schema), f"{tmp_path}/snapshot_{day}.csv")
    history = readers.read_history(spark, str(tmp_path), schema)
    assert {"file_path", "file_time"} <= set(history.columns)
    assert rows(history, "student_key", "readiness") == [(1, "2019-01-04"), (1, "2019-01-11")]
    assert str(readers.latest_snapshot(history).first()[0]) == "2019-01-11"
    files = readers.list_files(spark, str(tmp_path))
    assert str(readers.latest_snapshot(files).first()[0]) == "2019-01-11"
    assert "content" not in files.columns
    assert str(readers.latest_snapshot(history, "2019-01-11").first()[0]) == "2019-01-04"


def test_versions_stay_and_snapshots_are_replaced(spark, tmp_path):
    one, two = spark.range(1), spark.range(2)
    writers.write_versioned(one, f"{tmp_path}/v", "a")
    writers.write_versioned(two, f"{tmp_path}/v", "b")
    assert rows(spark.read.parquet(f"{tmp_path}/v"), "id", "run_id") == [(0, "a"), (0, "b"), (1, "b")]
    with pytest.raises(Exception, match="already exists"):
        writers.write_versioned(two, f"{tmp_path}/v", "b")
    writers.write_snapshot(one, f"{tmp_path}/s", "2019-01-04")
    writers.write_snapshot(two, f"{tmp_path}/s", "2019-01-04")
    assert spark.read.parquet(f"{tmp_path}/s").count() == 2


def test_a_run_that_fails_leaves_the_snapshot(spark, tmp_path):
    folder, week = tmp_path / "s", "2019-01-04"
    writers.write_snapshot(spark.range(3), str(folder), week)
    with pytest.raises(Exception, match="cut off"):
        writers.write_snapshot(spark.range(9).selectExpr("if(id > 7, raise_error('cut off'), id) AS id"), str(folder), week)
    read = lambda: spark.read.parquet(str(folder)).where("snapshot_date = '2019-01-04'").count()
    assert read() == 3
    # Cut off between the renamings: the old snapshot is put back and then replaced.
    (folder / f"snapshot_date={week}").rename(folder / f"_replaced-{week}")
    writers.write_snapshot(spark.range(5), str(folder), week)
    assert read() == 5 and not (folder / f"_replaced-{week}").exists()
    # Cut off after the second: the new snapshot is there and the old one goes.
    (folder / f"_replaced-{week}").mkdir()
    writers.write_snapshot(spark.range(6), str(folder), week)
    assert read() == 6 and not (folder / f"_replaced-{week}").exists()


def test_table_sources(spark, tmp_path):
    spark.range(2).withColumnRenamed("id", "STUDENT_KEY").write.parquet(f"{tmp_path}/t")
    assert readers.read_table(spark, "t", str(tmp_path)).columns == ["student_key"]
    with pytest.raises(ValueError, match="split_on"):
        readers.read_table(spark, "t", "jdbc:none", kind="jdbc")
    with pytest.raises(ValueError, match="unknown"):
        readers.read_table(spark, "t", "x", kind="xlsx")


def test_staged_tables_go_to_the_named_folder(spark):
    folder = shared_dir(spark)
    staged = reuse(spark.range(5).withColumn("v", F.lit(None).cast("string")))
    assert staged.count() == 5 and staged.columns == ["id", "v"]
    assert scratch_path(spark, "x").startswith(folder)
    assert folder in staged.inputFiles()[0]


def layouts(spark, tmp_path):
    one = spark.createDataFrame([(1, 7, 5)], "student_key long, n_ib int, n_ap int")
    writers.write_csv(one, f"{tmp_path}/snapshot_2019-01-04.csv")
    writers.write_csv(one.select("n_ap", F.lit("x").alias("note"), "student_key", "n_ib"), f"{tmp_path}/snapshot_2019-01-11.csv")
    writers.write_csv(one.drop("n_ib"), f"{tmp_path}/snapshot_2019-01-18.csv")
    return schemas.fields("student_key long, n_ap int, n_ib int")


def test_columns_are_matched_by_name_in_every_file(spark, tmp_path):
    schema = layouts(spark, tmp_path)
    history = readers.read_history(spark, str(tmp_path), schema)
    assert history.columns == ["student_key", "n_ap", "n_ib", "file_path", "file_time"]
    assert rows(history, "student_key", "n_ap", "n_ib") == [(1, 5, 7), (1, 5, 7), (1, 5, None)]
    with pytest.raises(ValueError, match="n_ib"):
        readers.read_history(spark, str(tmp_path), schema, required=("student_key", "n_ib"))
    mixed = readers.read_by_name(spark, str(tmp_path), schema)
    assert rows(mixed, "n_ap", "n_ib", "note") == [(5, 7, "x"), (5, 7, None), (5, None, None)]
    with pytest.raises(ValueError, match="one layout"):
        readers.read_cohort(spark, str(tmp_path), "dddd")


def test_dates_of_extracts(spark):
    df = spark.createDataFrame([("06-AUG-14", "2014-08-06", "2014-08-06 01:02:03"), ("6/8/14", "x", "2014-13-01 00:00:00"), (None, None, None)], "a string, b string, c string")
    found = readers.with_dates(df, a="dmy", b="ymd", c="ymd_hms").collect()
    assert str(found[0].a) == str(found[0].b) == "2014-08-06" and str(found[0].c) == "2014-08-06 01:02:03"
    assert all(v is None for r in found[1:] for v in r)


def test_newest_version_and_snapshot(spark, tmp_path):
    for run, n in (("2019a", 1), ("2019b", 2)):
        writers.write_versioned(spark.range(n), f"{tmp_path}/v", run)
        writers.write_snapshot(spark.range(n), f"{tmp_path}/s", f"2019-01-0{n}")
    assert readers.newest_version(spark, f"{tmp_path}/v").count() == 2
    assert readers.snapshot_of(spark, f"{tmp_path}/s").count() == 2
    assert readers.snapshot_of(spark, f"{tmp_path}/s", "2019-01-02").count() == 1
    assert readers.snapshot_of(spark, f"{tmp_path}/s", "2019-01-01") is None
