"""Snapshots compared by digests first, so that only what differs is read.

A snapshot is kept in parts by a hash of its key, beside a small table of digests:
for every part and column the sum of a hash of key and value over the rows. A sum
does not depend on the order of rows and counts repeated ones. Two snapshots are
compared digest by digest; parts whose digests agree are not opened, nor are the
columns that agree in every part.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .compare import mismatch_counts
from .monitor import changed_rows

PARTS = 256  # bounds the digest table and the list of parts to read
PART = "part_no"


def part_of(key: str, parts: int = PARTS) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(parts)).cast("int")


def _digest(key: str, column: str) -> Column:
    """Hash of the column's value with its key; a missing value has one too."""
    value = F.struct(F.col(column).isNull(), F.coalesce(F.col(column).cast("string"), F.lit("")))
    return F.xxhash64(F.col(key).cast("string"), F.lit(column), value)


def digests(df: DataFrame, key: str, parts: int = PARTS) -> DataFrame:
    """part_no, n_rows and one digest for each column. One aggregate over the snapshot."""
    sums = [F.sum(_digest(key, c).cast("decimal(38,0)")).alias(c) for c in df.columns]
    return df.withColumn(PART, part_of(key, parts)).groupBy(PART).agg(F.count(F.lit(1)).alias("n_rows"), *sums)


def write_digested(df: DataFrame, path: str, key: str = "student_key", parts: int = PARTS) -> None:
    """Rows by part, then the digests; a path that holds something is refused."""
    rows = df.withColumn(PART, part_of(key, parts))
    rows.repartition(PART).write.mode("errorifexists").partitionBy(PART).parquet(f"{path}/rows")
    digests(df, key, parts).coalesce(1).write.mode("errorifexists").parquet(f"{path}/digests")


@dataclass(frozen=True)
class Digested:
    """A stored snapshot; its rows are opened by part."""

    spark: SparkSession
    path: str

    @property
    def digests(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/digests")

    def columns(self) -> list[str]:
        return [c for c in self.digests.columns if c not in (PART, "n_rows")]

    def rows(self, parts: list[int], columns: list[str]) -> DataFrame:
        """Rows of some parts: the others' files are left out before anything is read."""
        read = self.spark.read.parquet(f"{self.path}/rows")
        return read.where(F.col(PART).isin(*parts) if parts else F.lit(False)).select(*columns)


def differing(a: Digested, b: Digested) -> tuple[list[int], list[str]]:
    """Parts and columns in which two snapshots differ, from their digests alone.

    At most as many rows as there are parts are looked at here.
    """
    columns = [c for c in a.columns() if c in b.columns()]
    left, right = a.digests.alias("a"), b.digests.alias("b")
    marks = [(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))).alias(c) for c in [*columns, "n_rows"]]
    both = left.join(right, F.col(f"a.{PART}") == F.col(f"b.{PART}"), "full")
    told = both.select(F.coalesce(f"a.{PART}", f"b.{PART}").alias(PART), *marks)
    unlike = told.where(reduce(lambda x, y: x | y, [F.col(c) for c in [*columns, "n_rows"]])).collect()
    return sorted(r[PART] for r in unlike), [c for c in columns if any(r[c] or r["n_rows"] for r in unlike)]


def changed_rows_digested(current: Digested, previous: Digested, original: Digested, columns: list[str] | None = None) -> DataFrame:
    """``changed_rows`` that opens only the parts in which ``current`` differs from both others.

    In a part that equals the previous or the original one no row is new.
    """
    columns = columns or current.columns()
    parts = sorted(set(differing(current, previous)[0]) & set(differing(current, original)[0]))
    return changed_rows(*[s.rows(parts, columns) for s in (current, previous, original)])


def mismatch_counts_digested(old: Digested, new: Digested, columns: list[str]) -> DataFrame:
    """``mismatch_counts`` that opens only the parts and the columns that differ; the others count 0."""
    parts, unlike = differing(old, new)
    read = [c for c in columns if c in unlike]
    same = [c for c in columns if c not in unlike]
    none = old.spark.createDataFrame([(c, 0) for c in same], "column_name string, n_different long")
    if not read:
        return none
    counts = mismatch_counts(old.rows(parts, ["student_key", *read]), new.rows(parts, ["student_key", *read]), read)
    return counts.unionByName(none)
