"""Rule audits and corrections on the student table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import total_of
from ..rules import (
    ACT_READY,
    ASVAB_READY,
    EPSO_COUNT_COLUMNS,
    EPSO_READY,
    EPSO_WITH_ASVAB,
    SAT_READY,
)


def _not_ready() -> Column:
    return F.col("readiness") == "N"


def audit_act(df: DataFrame) -> DataFrame:
    return df.where(_not_ready() & (F.col("act_composite") >= ACT_READY))


def audit_sat(df: DataFrame) -> DataFrame:
    return df.where(_not_ready() & (F.col("sat_total") >= SAT_READY))


def audit_epso(df: DataFrame, null_as_zero: bool = True) -> DataFrame:
    """Four opportunities but not ready."""
    total = total_of(EPSO_COUNT_COLUMNS, null_as_zero)
    return df.where(_not_ready() & (total >= EPSO_READY))


def audit_asvab(df: DataFrame, null_as_zero: bool = True) -> DataFrame:
    """Two opportunities and the service test but not ready."""
    total = total_of(EPSO_COUNT_COLUMNS, null_as_zero)
    return df.where(
        _not_ready() & (F.col("asvab") >= ASVAB_READY) & (total >= EPSO_WITH_ASVAB)
    )


def apply_corrections(df: DataFrame, null_as_zero: bool = False) -> DataFrame:
    """Turn N into Y where a rule was missed; ``correction`` names the rule.

    By default a missing count leaves the total unknown and the row unchanged.
    """
    total = total_of(EPSO_COUNT_COLUMNS, null_as_zero)
    scores = (F.col("sat_total") >= SAT_READY) | (F.col("act_composite") >= ACT_READY)
    asvab = (total >= EPSO_WITH_ASVAB) & (F.col("asvab") >= ASVAB_READY)
    rule = F.when(
        _not_ready(),
        F.when(scores, F.lit("scores"))
        .when(total >= EPSO_READY, F.lit("epso"))
        .when(asvab, F.lit("asvab")),
    )
    return df.withColumn("correction", rule).withColumn(
        "readiness",
        F.when(F.col("correction").isNotNull(), F.lit("Y")).otherwise(F.col("readiness")),
    )


def pathway_flags(report: DataFrame) -> DataFrame:
    """Ready students with the pathways they met, unknown where a count or score is missing."""
    taken = ["n_cambridge", "n_ap", "n_ib", "n_sdc", "n_ldc", "n_de", "clep"]
    epso = total_of(taken, null_as_zero=False)
    scores = (F.col("act_composite") >= ACT_READY) | (F.col("sat_total") >= SAT_READY)
    return report.where(F.col("readiness") == "Y").select(
        "student_key",
        scores.alias("pathway_act_sat"),
        (epso >= EPSO_READY).alias("pathway_epso"),
        (F.col("industry_cert") + epso >= EPSO_READY).alias("pathway_ic"),
    )


def pathway_breakdown(report: DataFrame) -> DataFrame:
    """Ready students by the pathways they met; unknown is a group of its own."""
    flags = pathway_flags(report)
    return flags.groupBy("pathway_act_sat", "pathway_epso", "pathway_ic").agg(F.count_distinct("student_key").alias("n"))
