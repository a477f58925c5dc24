"""Row numbers over a whole table, without a window that holds it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stored

# Spark numbers the rows of a task from its partition's number times this.
SPAN = 1 << 33


def numbered(df: DataFrame, order: list, name: str = "row_number") -> DataFrame:
    """Rows in the given order with their number, from 1.

    The table is dealt in ranges of the order and each range sorted and written; the
    sizes of the ranges, one row for each, are summed up to tell where a range begins.
    Rows that tie in the whole order are numbered as they come; name enough columns.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    rows = stored(ranged).withColumn("_range", F.floor(F.col("_id") / SPAN))
    sizes = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    begins = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_begin"))
    # One row for each range: as many as there are tasks.
    found = rows.join(F.broadcast(begins), "_range")
    return found.withColumn(name, F.col("_begin") + F.col("_id") % SPAN + 1).drop("_id", "_range", "_begin")
