"""Before/after comparison and simple profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import to_number


def compare(
    old: DataFrame, new: DataFrame, keys: list[str], suffixes: tuple[str, str] = ("_x", "_y")
) -> DataFrame:
    """Both versions side by side on keys that identify a row in each."""

    def marked(df: DataFrame, suffix: str) -> DataFrame:
        return df.withColumnsRenamed({c: c + suffix for c in df.columns if c not in keys})

    return marked(old, suffixes[0]).join(marked(new, suffixes[1]), keys, "full")


def differs(a: str, b: str) -> Column:
    return ~F.col(a).eqNullSafe(F.col(b))


def changed_values(
    student_table: DataFrame,
    file: DataFrame,
    pairs: dict[str, tuple[str, str]],
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Flag each changed value of approved students; keep rows with any change.

    ``pairs`` maps a flag to its (table, file) columns. Missing counts as 0.
    """
    table = student_table.where(F.col("is_approved").isNotNull()).select(
        "student_key", *carry, *{t: F.col(t).alias(f"{t}_x") for t, _ in pairs.values()}.values()
    )
    other = file.select(
        "student_key", *{f: F.col(f).alias(f"{f}_y") for _, f in pairs.values()}.values()
    )
    both = table.join(other, "student_key", "left")
    zero = F.lit(0)
    flags = {
        flag: F.coalesce(F.col(f"{f}_y"), zero) != F.coalesce(F.col(f"{t}_x"), zero)
        for flag, (t, f) in pairs.items()
    }
    flagged = both.select("student_key", *carry, *[c.alias(n) for n, c in flags.items()])
    return flagged.where(reduce(lambda a, b: a | b, [F.col(n) for n in flags]))


def _unpivot(df: DataFrame, name: str, value: str) -> DataFrame:
    return df.unpivot([], df.columns, name, value)


def mismatch_counts(old: DataFrame, new: DataFrame, columns: list[str]) -> DataFrame:
    """Differing values per column, all columns in one pass; missing equals missing."""
    both = compare(old.select("student_key", *columns), new.select("student_key", *columns), ["student_key"])
    counts = both.agg(*[F.count_if(differs(f"{c}_x", f"{c}_y")).alias(c) for c in columns])
    return _unpivot(counts, "column_name", "n_different")


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _unpivot(counts, "column_name", "n_missing")


def freq(df: DataFrame, *columns: str) -> DataFrame:
    """Frequency table with missing as a value of its own."""
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def count_changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return compare(old.select(*keys, "n_courses"), new.select(*keys, "n_courses"), keys)


def diff_distribution(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """How far counts moved: students per difference and percent of all.

    The percentage rounds half to even. The total is a one-row subquery.
    """
    zero = F.lit(0)
    diffs = count_changes(old, new, keys).select(
        (F.coalesce("n_courses_x", zero) - F.coalesce("n_courses_y", zero)).alias("diff")
    )
    table = freq(diffs, "diff")
    total = table.agg(F.sum("n")).scalar()
    return table.withColumn("pct", F.bround(100 * F.col("n") / total, 1))


def change_summary(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Counts higher, lower, newly present and newly missing."""
    x, y = F.col("n_courses_x"), F.col("n_courses_y")
    return count_changes(old, new, keys).agg(
        F.count_if(y > x).alias("n_higher"),
        F.count_if(x > y).alias("n_lower"),
        F.count_if(x.isNull() & y.isNotNull()).alias("n_no_longer_missing"),
        F.count_if(y.isNull() & x.isNotNull()).alias("n_now_missing"),
    )


def change_matrix(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Students per pair of old and new count, where they differ."""
    return (
        count_changes(old, new, keys)
        .where(differs("n_courses_x", "n_courses_y"))
        .groupBy("n_courses_x", "n_courses_y")
        .agg(F.count_distinct("student_key").alias("n"))
    )


def lost_status(old: DataFrame, new: DataFrame) -> DataFrame:
    """Students ready before and not any more."""
    both = compare(
        old.select("student_key", "readiness"),
        new.select("student_key", "readiness"),
        ["student_key"],
    )
    return both.where((F.col("readiness_x") == "Y") & (F.col("readiness_y") == "N"))


def first_mismatches(df: DataFrame, records: DataFrame, k: int = 5) -> DataFrame:
    """Records of the first ``k`` mismatching students."""
    ids = df.where("mismatch").select("student_key").orderBy(F.asc_nulls_last("student_key")).limit(k)
    return records.join(ids, "student_key", "left_semi")


def numeric_all(df: DataFrame) -> DataFrame:
    """Every column as a number; text that is none becomes missing."""
    return df.select(*[to_number(c).alias(c) for c in df.columns])
