"""Enrollment tables kept dealt out by service period, so that later runs join them where they lie.

A run stores its class assignments with their sections, and its service periods, in
files bucketed by the period. Every further run over them (other students, courses,
domains) joins bucket with bucket and shuffles neither side. The files are plain
Parquet; the buckets are told to Spark's own catalog when they are read. A period
that holds a large share of all rows makes one large bucket, which no run can split:
join such tables with ``course_enrollments``.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.enrollment import assigned_sections

BUCKETS = 64


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """One file per bucket, sorted by the keys; a path that holds something is refused."""
    name = f"pathways_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("errorifexists").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")  # the files stay


def read_bucketed(spark: SparkSession, path: str, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """The files as a table that Spark knows the buckets of. Keys and buckets are those of the writing."""
    name = f"pathways_{hashlib.sha1(f'{path}|{keys}|{buckets}'.encode()).hexdigest()}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    listed = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({listed}) SORTED BY ({listed}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def store_star(isp: DataFrame, sca: DataFrame, cs: DataFrame, folder: str, buckets: int = BUCKETS) -> None:
    """The first run: assignments meet their sections, both sides are dealt out by period."""
    write_bucketed(assigned_sections(sca, cs), f"{folder}/assigned", ["isp_id"], buckets)
    write_bucketed(isp.withColumnRenamed("school_year", "isp_school_year"), f"{folder}/periods", ["isp_id"], buckets)


def stored_enrollments(
    spark: SparkSession, folder: str, students: DataFrame | None = None, courses: list[int] | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """Course enrollments of stored tables, of some students or courses where given; nothing is shuffled for the join."""
    assigned = read_bucketed(spark, f"{folder}/assigned", ["isp_id"], buckets)
    periods = read_bucketed(spark, f"{folder}/periods", ["isp_id"], buckets)
    if courses is not None:
        assigned = assigned.where(F.col("course_code").isin(*courses))
    joined = assigned.join(periods, "isp_id", "inner")
    return joined if students is None else joined.join(students.select("student_key"), "student_key", "left_semi")
