"""Each event with the row that was in force at its time.

Events and the dated rows they look up are stacked and sorted by key and time; the
last dated row is carried on to the events behind it. Time is cut in slices that are
worked through on their own, and each slice takes over what the slices before it
carried, one row for each key and slice. No event is joined with a range of rows, and
a key with a third of all rows is dealt to as many tasks as it has slices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.nulls import join_na

SLICE_DAYS = 31


def in_force(
    events: DataFrame, dated: DataFrame, key: str, at: str, since: str, columns: list[str], slice_days: int = SLICE_DAYS
) -> DataFrame:
    """Events with ``since`` and ``columns`` of the last row of ``dated`` with the same key, no later than ``at``.

    A row counts from its own date on. Of rows with one key and date the largest counts,
    by the columns in their order. Events before any row, without a date or without a key
    have missing values; repeated events stay.
    """
    value = F.struct(F.col(since).cast("date").alias(since), *columns).alias("_value")
    asked = events.select(F.col(key).alias("_key"), F.col(at).cast("date").alias("_at"), F.struct(*events.columns).alias("_event"))
    rows = dated.where(F.col(since).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.col(since).cast("date").alias("_at"), value)
    rows = rows.groupBy("_key", "_at").agg(F.max("_value").alias("_value"))
    # Dated rows come before the events of their day.
    asked = asked.withColumns({"_kind": F.lit(1), "_value": F.lit(None).cast(rows.schema["_value"].dataType)})
    rows = rows.withColumns({"_kind": F.lit(0), "_event": F.lit(None).cast(asked.schema["_event"].dataType)})
    known = F.col("_key").isNotNull() & F.col("_at").isNotNull()
    both = rows.unionByName(asked.where(known)).withColumn("_slice", F.floor(F.datediff("_at", F.lit("1970-01-01").cast("date")) / slice_days))
    within = W.partitionBy("_key", "_slice").orderBy("_at", "_kind").rowsBetween(W.unboundedPreceding, 0)
    found = both.withColumn("_found", F.last("_value", ignorenulls=True).over(within)).where("_kind = 1")
    last = both.groupBy("_key", "_slice").agg(F.max("_value").alias("_value"))
    earlier = W.partitionBy("_key").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    carried = last.select("_key", "_slice", F.last("_value", ignorenulls=True).over(earlier).alias("_carried")).where("_carried is not null")
    found = join_na(found, carried, ["_key", "_slice"]).select("_event", F.coalesce("_found", "_carried").alias("_found"))
    found = found.unionByName(asked.where(~known).select("_event", F.col("_value").alias("_found")))
    return found.select("_event.*", *[F.col(f"_found.{c}").alias(c) for c in (since, *columns)])
