"""Inputs. Every reader applies a stated schema and stays lazy."""

from __future__ import annotations

import csv
import datetime as dt
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.dates import day_month_year, year_month_day, year_month_day_time
from ..functions.text import clean_names, snake_case
from . import schemas

SNAPSHOT_DATE = r"snapshot_(?:date=)?(\d{4}-\d{2}-\d{2})"


def _layouts(spark: SparkSession, path: str, sep: str) -> dict[tuple[str, ...], list[str]]:
    """Files under a path or glob by the column names of their own first line.

    One line of each file reaches the driver. Empty files are left out.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    first = lines.where("at = 0").withColumn("n", F.monotonically_increasing_id())
    found = defaultdict(list)
    for r in first.groupBy("file").agg(F.min_by("value", "n").alias("line")).collect():
        names = next(csv.reader([r["line"]], delimiter=sep), [])
        found[tuple(snake_case(n) for n in names)].append(r["file"])
    return {names: sorted(files) for names, files in sorted(found.items())}


def read_by_name(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    sep: str = ",",
    required: tuple[str, ...] = (),
    only: bool = False,
    more: tuple[Column, ...] = (),
) -> DataFrame:
    """Delimited files whose columns are matched by name, each file by its own header.

    Files of one layout are read together and the layouts are stacked; a column
    that a file lacks is null. Columns outside ``schema`` are text, or left out
    with ``only``. A file without a ``required`` column is an error. ``more``
    are columns added while the files are read, such as their path.
    """
    parts = []
    for names, files in _layouts(spark, path, sep).items():
        missing = [c for c in required if c not in names]
        if missing:
            raise ValueError(f"{files[0]} has no column {', '.join(missing)}")
        df = spark.read.schema(schemas.typed(list(names), schema)).csv(files, header=True, sep=sep, nullValue="")
        kept = [c for c in schema.names if c in names] if only else list(names)
        parts.append(df.select(*kept, *more))
    if not parts:
        raise ValueError(f"no file with a header under {path}")
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if only:
        absent = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in out.columns}
        out = out.withColumns(absent).select(*schema.names, *[c for c in out.columns if c not in schema.names])
    return out


def read_cohort(spark: SparkSession, path: str, codes: str | None = None) -> DataFrame:
    """Cohort CSV: known columns typed by name, or all of them by type codes.

    Type codes go by position, so with them every file has the same header.
    """
    if not codes:
        return read_by_name(spark, path, schemas.COHORT)
    layouts = list(_layouts(spark, path, ","))
    if len(layouts) != 1:
        raise ValueError(f"type codes need files of one layout, found {len(layouts)} under {path}")
    schema = schemas.schema_from_codes(list(layouts[0]), codes)
    return spark.read.schema(schema).csv(path, header=True, nullValue="")


def read_extract(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Tab-delimited vendor extract; columns outside the schema are text."""
    return read_by_name(spark, path, schema, sep="\t")


def read_table(
    spark: SparkSession,
    name: str,
    source: str,
    *,
    kind: str = "parquet",
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    parts: int = 64,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Operational table, from a Parquet folder or over JDBC.

    A JDBC read is split on ``split_on`` within ``bounds`` so that executors
    fetch ranges side by side instead of one task pulling the whole table.
    """
    if kind == "parquet":
        return clean_names(spark.read.parquet(f"{source.rstrip('/')}/{name}"))
    if kind == "jdbc":
        if not split_on or not bounds:
            raise ValueError("a JDBC read needs split_on and bounds")
        return clean_names(
            spark.read.jdbc(
                source,
                name,
                column=split_on,
                lowerBound=bounds[0],
                upperBound=bounds[1],
                numPartitions=parts,
                properties=properties or {},
            )
        )
    raise ValueError(f"unknown source kind: {kind}")


def read_lookup(spark: SparkSession, name: str, path: str, kind: str = "csv") -> DataFrame:
    """Reference lookup by name, from CSV or Parquet."""
    if kind == "parquet":
        return clean_names(spark.read.parquet(path))
    return read_by_name(spark, path, schemas.LOOKUPS[name])


def read_history(
    spark: SparkSession, path: str, schema: StructType, kind: str = "csv", required: tuple[str, ...] | None = None
) -> DataFrame:
    """All earlier files under a path or glob, each row with its file and file time.

    CSV columns are matched by name, whatever their order in a file; those that
    a file lacks are null, those outside the schema are left out. ``required``
    columns, the first of the schema unless named, must be in every file.
    """
    source = (
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("file_time"),
    )
    if kind == "csv":
        required = tuple(schema.names[:1]) if required is None else required
        return read_by_name(spark, path, schema, required=required, only=True, more=source)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path).select("*", *source)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Files under a path with their times; the contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(
        F.col("path").alias("file_path"), F.col("modificationTime").alias("file_time")
    )


def snapshot_date(path: Column) -> Column:
    return F.try_to_date(F.regexp_extract(path, SNAPSHOT_DATE, 1), "yyyy-MM-dd")


def latest_snapshot(files: DataFrame, before: dt.date | str | None = None) -> DataFrame:
    """Newest snapshot date named in the file paths, before this run's date."""
    dates = files.select(snapshot_date(F.col("file_path")).alias("snapshot_date"))
    if before is not None:
        dates = dates.where(F.col("snapshot_date") < F.lit(str(before)).cast("date"))
    return dates.agg(F.max("snapshot_date").alias("snapshot_date"))


def with_dates(df: DataFrame, **forms: str) -> DataFrame:
    """Date columns from the text of an extract; malformed text becomes null.

    Each name is given its form: ``dmy`` (06-AUG-14), ``ymd`` or ``ymd_hms``.
    """
    parse = {"dmy": day_month_year, "ymd": year_month_day, "ymd_hms": year_month_day_time}
    return df.withColumns({name: parse[form](name) for name, form in forms.items()})


def newest_version(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the newest run that a folder of versioned outputs holds, without its name."""
    runs = spark.read.parquet(folder)
    newest = runs.agg(F.max(F.col("run_id").cast("string")).alias("run_id"))
    return runs.where(F.col("run_id").cast("string") == newest.scalar()).drop("run_id")


def snapshot_of(spark: SparkSession, folder: str, before: dt.date | str | None = None) -> DataFrame | None:
    """The newest snapshot in a folder, of those before this run's date; None where there is none."""
    snapshots = spark.read.parquet(folder)
    dates = snapshots.select(F.col("snapshot_date").cast("date").alias("d"))
    if before is not None:
        dates = dates.where(F.col("d") < F.lit(str(before)).cast("date"))
    day = dates.agg(F.max("d")).first()[0]
    return None if day is None else snapshots.where(F.col("snapshot_date") == F.lit(day)).drop("snapshot_date")
