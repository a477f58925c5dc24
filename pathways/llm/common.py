"""What the text operators share: input columns, written stages, small bounded tables."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathways.session import remove, scratch_path

# White space of the contracts: space and the controls from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the workers import this package, as Spark sends Python files to executors."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # Only the driver reads this file; it serves the executors from there.
    at = os.path.join(tempfile.mkdtemp(prefix="pathways-"), "pathways.zip")
    with zipfile.ZipFile(at, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    module = os.path.join(folder, name)
                    z.write(module, os.path.relpath(module, os.path.dirname(root)))
    context.addPyFile(at)
    _SHIPPED.add(context.applicationId)


def id_and_text(docs: DataFrame, *more: str) -> DataFrame:
    """Only the columns an operator reads, so that no other name can clash; null text is empty."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *more)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column | str) -> Column:
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that is read more than once to the shared folder and read it back.

    The files outlive lost executors, and values such as row ids that depend on
    the order of reading stay as they were written.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Stages:
    """Written stages of one run, by name; each is removed after its last reader."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        self.paths.setdefault(name, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            for path in self.paths.pop(name, ()):
                remove(self.spark, path)

    def clear(self) -> None:
        self.drop(*list(self.paths))


def parts_for(spark: SparkSession, rows: int, per_part: int) -> int:
    """Number of partitions for a count of rows; never under the session's own number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_part))
