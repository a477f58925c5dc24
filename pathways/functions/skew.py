"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import reuse

PART = "_part"
HASH, SALTS = "_hash", "_salts"


def join_unique(
    df: DataFrame, lookup: DataFrame, on: list[str], how: str = "left", salts: int = 1
) -> DataFrame:
    """Join a side that holds each key once or a few times, such as an aggregate.

    Adaptive execution splits a hot partition of ``df``, but only where both
    sides come straight from a shuffle made for the join. An aggregate is
    already partitioned by its keys and would be joined in place, leaving the
    hot key to one task. Adding a part number to the join keys gives the lookup
    its own shuffle. With one part nothing is copied; with more ``salts`` the
    rows of a key spread over that many parts without adaptive execution, each
    with a copy of the lookup row. A lookup that turns out small is broadcast
    by Spark either way.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"a lookup cannot be joined with: {how}")
    spread = df.columns if salts > 1 else on
    left = df.withColumn(PART, F.pmod(F.xxhash64(*spread), F.lit(salts)))
    first, last = (F.lit(n).cast("bigint") for n in (0, salts - 1))
    part = F.explode(F.sequence(first, last)) if salts > 1 else F.pmod(F.xxhash64(*on), F.lit(1))
    right = lookup.withColumn(PART, part)
    return left.join(right, [*on, PART], how).drop(PART)


def _hash(on: list[str]) -> Column:
    """One number for the key, whatever the types of its columns on either side; a missing value has one too."""
    return F.xxhash64(*[F.col(c).cast("string") for c in on])


def hot_keys(df: DataFrame, on: list[str], partitions: int) -> DataFrame:
    """Keys with more rows than an even share of ``partitions`` parts, and how many such shares.

    Columns ``_hash`` and ``_salts``; at most ``partitions`` rows. The candidates come
    from one bounded counter sketch per task, merged: with 16 counters for each part no
    key above the share can fall out of it, and twice as many candidates as parts leave
    room for overestimates. A second pass counts the candidates exactly.
    """
    tracked = max(16 * partitions, 1024)
    hashed = df.select(_hash(on).alias(HASH))
    told = hashed.agg(
        F.expr(f"approx_top_k({HASH}, {2 * partitions}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n")
    ).first()
    share = max(-(-told["n"] // partitions), 1)
    candidates = df.sparkSession.createDataFrame([(r["item"],) for r in told["top"] or []], f"{HASH} long")
    exact = hashed.join(F.broadcast(candidates), HASH, "left_semi").groupBy(HASH).agg(F.count(F.lit(1)).alias("n"))
    return exact.where(F.col("n") > share).select(HASH, F.ceil(F.col("n") / share).alias(SALTS))


def join_measured(
    df: DataFrame, lookup: DataFrame, on: list[str], how: str = "left", partitions: int | None = None
) -> DataFrame:
    """``join_unique`` with the salts of each key chosen from how often ``df`` holds it.

    A key with more rows than an even share of the shuffle partitions is spread over
    as many parts as it has shares; its lookup row is copied to each of them, and no
    other lookup row is copied. Missing keys match nothing, but are spread too. Rows
    take their part by a hash of the whole row, so a rerun task deals them as before.
    The counting reads the key columns of ``df`` twice, before the join is planned; ``df``
    is written first, so that it is computed once and the counting reads its keys only.
    """
    df = reuse(df)
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written where a shared folder is named: read on both sides, at most ``partitions`` rows.
    hot = reuse(hot_keys(df, on, partitions))
    if not hot.take(1):
        return join_unique(df, lookup, on, how)
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"a lookup cannot be joined with: {how}")

    def marked(side: DataFrame) -> DataFrame:
        found = side.withColumn(HASH, _hash(on)).join(F.broadcast(hot), HASH, "left").drop(HASH)
        return found.withColumn(SALTS, F.coalesce(SALTS, F.lit(1).cast("bigint")))

    left = marked(df).withColumn(PART, F.pmod(F.xxhash64(*df.columns), F.col(SALTS))).drop(SALTS)
    right = marked(lookup).withColumn(PART, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(SALTS) - 1))).drop(SALTS)
    return left.join(right, [*on, PART], how).drop(PART)
