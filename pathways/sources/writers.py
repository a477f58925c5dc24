"""Outputs. Each run or week gets its own partition."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import exists, remove, rename


def write_versioned(df: DataFrame, path: str, run_id: str) -> str:
    """New partition for this run; earlier runs stay, the same run is refused."""
    target = f"{path.rstrip('/')}/run_id={run_id}"
    df.write.mode("errorifexists").parquet(target)
    return target


def write_snapshot(df: DataFrame, path: str, date: str) -> str:
    """Weekly snapshot; writing the same date again replaces it.

    The new files are written beside, in a folder that readers pass over, and take the
    place of the old ones by renaming when they are complete. A run that was cut off
    leaves the old snapshot: where it fell between the two renamings, the next writing of
    that date puts the old one back first.
    """
    spark, folder = df.sparkSession, path.rstrip("/")
    target = f"{folder}/snapshot_date={date}"
    fresh, old = f"{folder}/_writing-{date}-{uuid.uuid4().hex}", f"{folder}/_replaced-{date}"
    if exists(spark, old):
        if exists(spark, target):
            remove(spark, old)
        else:
            rename(spark, old, target)
    df.write.parquet(fresh)
    if exists(spark, target):
        rename(spark, target, old)
    rename(spark, fresh, target)
    remove(spark, old)
    return target


def write_csv(df: DataFrame, path: str, sep: str = ",") -> str:
    """CSV with a header line and missing values as empty fields."""
    df.write.mode("errorifexists").csv(path, header=True, sep=sep, nullValue="", emptyValue="")
    return path
