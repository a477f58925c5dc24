"""Exact counts of distinct students from bitmaps that can be combined.

Students are numbered densely once. For every week, district and status the numbers
of the students are kept as bitmaps, cut into buckets of 32,768 numbers. Counts for
any set of weeks or districts then come from the bitmaps alone: or for "in any",
and for "in both", never from the rows again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.skew import join_unique
from .numbering import numbered

BITS = "bits"
BUCKET = "bucket"


def student_numbers(*tables: DataFrame, key: str = "student_key") -> DataFrame:
    """key, number: every student of the tables once, numbered in order of the key from 1."""
    keys = reduce(DataFrame.unionByName, [t.select(key) for t in tables])
    return numbered(keys.where(F.col(key).isNotNull()).distinct(), [key], "number")


def bitmaps(df: DataFrame, keys: list[str], numbers: DataFrame, key: str = "student_key") -> DataFrame:
    """Keys, bucket, bits: the students of each combination of the keys. Missing keys are combinations too."""
    rows = join_unique(df.select(*keys, key), numbers, [key], "inner")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias(BITS)
    return rows.groupBy(*keys, F.bitmap_bucket_number("number").alias(BUCKET)).agg(bits)


def any_of(maps: DataFrame, keys: list[str]) -> DataFrame:
    """Coarser bitmaps: a student who is in any of the finer ones."""
    return maps.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def both(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Students who are in both of two sets of bitmaps with equal keys."""
    sides = left.select(*keys, BUCKET, BITS).unionByName(right.select(*keys, BUCKET, BITS))
    met = sides.groupBy(*keys, BUCKET).agg(F.bitmap_and_agg(BITS).alias(BITS), F.count(F.lit(1)).alias("_n"))
    return met.where("_n = 2").drop("_n")


def students_in(maps: DataFrame, keys: list[str], name: str = "n_students") -> DataFrame:
    """Distinct students of each combination of the keys; none where no bitmap has one."""
    finest = any_of(maps, keys)
    return finest.groupBy(*keys).agg(F.sum(F.bitmap_count(BITS)).alias(name)).where(F.col(name) > 0)


def moves(
    maps: DataFrame, week: str, status: str, first: Column, second: Column, statuses: list, keys: list[str] | None = None
) -> DataFrame:
    """Students by their status in one week and in another, from the bitmaps of both weeks.

    ``statuses`` lists the values to look at, None for a missing one.
    """
    keys = keys or []
    before, after = f"{status}_before", f"{status}_after"
    kind = maps.schema[status].dataType
    each = lambda name: F.explode(F.array(*[F.lit(s).cast(kind) for s in statuses])).alias(name)
    left = any_of(maps.where(F.col(week) == first), [*keys, status])
    right = any_of(maps.where(F.col(week) == second), [*keys, status])
    left = left.select(*keys, F.col(status).alias(before), each(after), BUCKET, BITS)
    right = right.select(*keys, each(before), F.col(status).alias(after), BUCKET, BITS)
    pair = [*keys, before, after]
    return students_in(both(left, right, pair), pair)


def breakdowns(maps: DataFrame, keys: list[str], sets: list[tuple[str, ...]]) -> DataFrame:
    """Distinct students for several groupings, each from the smallest one that holds its columns.

    ``grouping`` names the columns counted by; those left out are null. The rows are read
    by none of them, only the bitmaps of the finest grouping.
    """
    made: dict[tuple[str, ...], DataFrame] = {tuple(keys): maps}
    out = []
    for own in sorted(sets, key=len, reverse=True):
        finer = min((s for s in made if set(own) <= set(s)), key=len)
        made[own] = made[finer] if finer == own else any_of(made[finer], list(own))
        counted = students_in(made[own], list(own))
        blank = [F.lit(None).cast(maps.schema[k].dataType).alias(k) if k not in own else F.col(k) for k in keys]
        out.append(counted.select(F.lit(",".join(own)).alias("grouping"), *blank, "n_students"))
    return reduce(DataFrame.unionByName, out)
