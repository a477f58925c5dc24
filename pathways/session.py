"""Session settings the pipelines are written for, and shared scratch space."""

from __future__ import annotations

import gc
import logging
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution splits the partition of a hot key on the many side of the
# lookups, and turns a lookup side into a broadcast only after measuring it.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Stages whose generated method the JVM would not compile run unfused.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names, else the warehouse, which is told."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    logging.getLogger(__name__).warning("spark.checkpoint.dir names no shared folder; scratch files go to the warehouse, %s", warehouse)
    return warehouse


def scratch_path(spark: SparkSession, name: str) -> str:
    """New folder for one run, in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of this run, in whichever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder within its store."""
    paths = spark._jvm.org.apache.hadoop.fs.Path
    done = paths(path).getFileSystem(spark._jsc.hadoopConfiguration()).rename(paths(path), paths(to))
    if not done:
        raise OSError(f"could not rename {path} to {to}")


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of plans that are no longer referred to."""
    gc.collect()
    spark._jvm.System.gc()


def stored(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back, so that it is the same at every reading.

    For values that depend on how rows were dealt out, such as positions in a task.
    """
    path = scratch_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reuse(df: DataFrame) -> DataFrame:
    """Compute a frame that is read more than once only once.

    Writes it as a table in the cluster's shared folder and reads that back:
    columnar, so each reader fetches only its columns, and safe when executors
    are lost. Where the cluster names no folder the frame stays lazy.
    """
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None):
        return df
    path = scratch_path(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
