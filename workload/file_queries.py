"""Readers and writers: the bound tables written, read back and returned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathways.functions.text import clean_names
from pathways.session import scratch_path
from pathways.sources import readers as RD
from pathways.sources import schemas
from pathways.sources import writers as WR

from .registry import query
from .tables import Bound


def _cohort_file(b: Bound) -> DataFrame:
    path = WR.write_csv(b.cohort, scratch_path(b.spark, "cohort"))
    return RD.read_cohort(b.spark, path)


def _extract(b: Bound) -> DataFrame:
    path = WR.write_csv(b.exams, scratch_path(b.spark, "extract"), sep="\t")
    return RD.read_extract(b.spark, path, schemas.EXAMS)


def _table(b: Bound) -> DataFrame:
    folder = scratch_path(b.spark, "tables")
    b.isp.withColumnRenamed("student_key", "STUDENT_KEY").write.parquet(f"{folder}/service_period")
    return RD.read_table(b.spark, "service_period", folder)


def _snapshot_columns(df: DataFrame) -> DataFrame:
    return df.select("student_key", "district_no", "n_adv_placement", "readiness")


SNAPSHOT_SCHEMA = schemas.fields(
    "student_key long, district_no int, n_adv_placement int, readiness string"
)


def _history(b: Bound) -> DataFrame:
    folder = scratch_path(b.spark, "history")
    for day, df in (("2019-02-01", b.snapshot_prev), ("2019-02-08", b.snapshot_cur)):
        WR.write_csv(_snapshot_columns(df), f"{folder}/snapshot_{day}.csv")
    return RD.read_history(b.spark, folder, SNAPSHOT_SCHEMA)


def _changed_layouts(b: Bound) -> DataFrame:
    """Earlier files with their columns in another order, one more column, and one less."""
    folder = scratch_path(b.spark, "layouts")
    prev, cur, orig = (_snapshot_columns(df) for df in (b.snapshot_prev, b.snapshot_cur, b.snapshot_orig))
    WR.write_csv(prev.select(*reversed(prev.columns)), f"{folder}/snapshot_2019-02-01.csv")
    WR.write_csv(cur.select("student_key", F.lit("x").alias("note"), *cur.columns[1:]), f"{folder}/snapshot_2019-02-08.csv")
    WR.write_csv(orig.drop("n_adv_placement"), f"{folder}/snapshot_2019-01-25.csv")
    return RD.read_history(b.spark, folder, SNAPSHOT_SCHEMA)


def _mixed_lookup(b: Bound) -> DataFrame:
    folder = scratch_path(b.spark, "catalogs")
    catalog = b.catalog
    WR.write_csv(catalog, f"{folder}/one")
    WR.write_csv(catalog.select(*reversed(catalog.columns)), f"{folder}/two")
    return RD.read_lookup(b.spark, "course_catalog", folder).select(*catalog.columns)


def _dates(b: Bound) -> DataFrame:
    """Dates as an extract writes them, every ninth row malformed."""
    day = F.col("o_orderdate").cast("date")
    text = lambda form: F.when(F.col("o_orderkey") % 9 == 0, "00-XXX-99").otherwise(F.upper(F.date_format(day, form)))
    extract = b.raw("orders").select(
        "o_orderkey", text("dd-MMM-yy").alias("begin_date"), text("yyyy-MM-dd").alias("end_date"),
        text("yyyy-MM-dd HH:mm:ss").alias("loaded_at"),
    )
    path = WR.write_csv(extract, scratch_path(b.spark, "dates"), sep="\t")
    read = RD.read_extract(b.spark, path, schemas.fields("o_orderkey long"))
    return RD.with_dates(read, begin_date="dmy", end_date="ymd", loaded_at="ymd_hms")


def _latest(b: Bound) -> DataFrame:
    folder = scratch_path(b.spark, "weeks")
    for day, df in (("2019-02-01", b.snapshot_prev), ("2019-02-08", b.snapshot_cur)):
        WR.write_snapshot(_snapshot_columns(df), folder, day)
    return RD.latest_snapshot(RD.list_files(b.spark, folder), "2019-02-08")


def _lookup(b: Bound) -> DataFrame:
    path = WR.write_csv(b.catalog, scratch_path(b.spark, "catalog"))
    return RD.read_lookup(b.spark, "course_catalog", path)


def _versions(b: Bound) -> DataFrame:
    folder = scratch_path(b.spark, "versions")
    WR.write_versioned(_snapshot_columns(b.snapshot_prev), folder, "2019a")
    WR.write_versioned(_snapshot_columns(b.snapshot_cur), folder, "2019b")
    return b.spark.read.parquet(folder)


def _weekly(b: Bound) -> DataFrame:
    folder = scratch_path(b.spark, "weekly")
    WR.write_snapshot(_snapshot_columns(b.snapshot_prev), folder, "2019-02-01")
    WR.write_snapshot(_snapshot_columns(b.snapshot_cur), folder, "2019-02-01")
    return b.spark.read.parquet(folder)


def _empty_as_null(b: Bound) -> DataFrame:
    path = WR.write_csv(b.certs, scratch_path(b.spark, "certs"))
    lines = b.spark.read.text(path)
    return lines.where(~F.col("value").startswith("student_id,")).agg(
        F.count("*").alias("n_lines"),
        F.count_if(F.col("value").contains("null") | F.col("value").contains('""')).alias("n_marked"),
        F.count_if(F.col("value").contains(",,")).alias("n_with_empty"),
    )


query("cohort_file_read", "S1", "SELECT * FROM cohort", _cohort_file)
query(
    "vendor_extract_read", "S2 S4",
    "SELECT * REPLACE (CAST(student_id AS DOUBLE) AS student_id) FROM exams", _extract,
)
query("operational_table_read", "S3", "SELECT * FROM isp", _table)
query(
    "column_names_cleaned", "S4",
    "SELECT p_partkey AS course_code, p_name AS course_title, p_brand AS x2018_brand FROM part",
    lambda b: clean_names(b.raw("part").select(
        F.col("p_partkey").alias("Course Code"), F.col("p_name").alias("courseTitle"), F.col("p_brand").alias("2018 Brand"),
    )),
)
SNAPSHOT = "student_key, district_no, n_adv_placement, readiness"
query(
    "snapshot_history_read", "S5",
    f"""SELECT {SNAPSHOT}, DATE '2019-02-01' AS snapshot_date, true AS has_file_time FROM snapshot_prev
      UNION ALL SELECT {SNAPSHOT}, DATE '2019-02-08', true FROM snapshot_cur""",
    lambda b: _history(b).select(
        *SNAPSHOT_SCHEMA.names,
        RD.snapshot_date(F.col("file_path")).alias("snapshot_date"),
        F.col("file_time").isNotNull().alias("has_file_time"),
    ),
)
query(
    "latest_snapshot_before_run", "S6", "SELECT max(DATE '2019-02-01') AS snapshot_date FROM snapshot_prev",
    _latest,
)
query(
    "versioned_output", "S7",
    f"SELECT {SNAPSHOT}, '2019a' AS run_id FROM snapshot_prev UNION ALL SELECT {SNAPSHOT}, '2019b' FROM snapshot_cur",
    _versions,
)
query(
    "weekly_snapshot_written", "S8", f"SELECT {SNAPSHOT}, DATE '2019-02-01' AS snapshot_date FROM snapshot_cur", _weekly,
)
query(
    "csv_nulls_empty", "S9",
    """SELECT count(*) AS n_lines, CAST(0 AS BIGINT) AS n_marked,
      count(*) FILTER (cert_name IS NULL OR pass_fail IS NULL) AS n_with_empty FROM certs""",
    _empty_as_null,
)
query("lookup_read", "S10", "SELECT * FROM catalog", _lookup)
query(
    "snapshot_history_of_changed_layouts", "S5",
    f"""SELECT {SNAPSHOT}, DATE '2019-02-01' AS snapshot_date FROM snapshot_prev
      UNION ALL SELECT {SNAPSHOT}, DATE '2019-02-08' FROM snapshot_cur
      UNION ALL SELECT student_key, district_no, NULL, readiness, DATE '2019-01-25' FROM snapshot_orig""",
    lambda b: _changed_layouts(b).select(
        *SNAPSHOT_SCHEMA.names, RD.snapshot_date(F.col("file_path")).alias("snapshot_date")
    ),
)
query("lookup_of_mixed_layouts", "S10", "SELECT * FROM catalog UNION ALL SELECT * FROM catalog", _mixed_lookup)
query(
    "extract_dates_read", "S2",
    # Two digits name a year from 2000 on.
    """SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN
        CAST(CAST(o_orderdate AS DATE) + to_years(CAST(100 * CAST(year(o_orderdate) < 2000 AS INT) AS INT)) AS DATE) END AS begin_date,
      CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) END AS end_date,
      CASE WHEN o_orderkey % 9 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS loaded_at FROM orders""",
    _dates,
)
