"""The compiled student files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import cohort as H
from ..operators import counts as N
from ..operators import report as R
from ..rules import EPSO_TYPES
from ..sources.readers import newest_version
from .domains import all_counts
from .inputs import Inputs, Rules, whole_cohort


def compile_counts(counts: DataFrame, t: Inputs, rules: Rules) -> DataFrame:
    """Cohort students with counts by type and best scores."""
    cohort = H.dedupe_cohort(t.cohort) if rules.mode == "graduates" else t.cohort
    attached = R.attach_cohort(N.pivot_types(counts), cohort)
    return R.attach_scores(attached, H.best_scores(t.act))


def classified(counts: DataFrame, t: Inputs, rules: Rules = Rules()) -> DataFrame:
    filled = N.zero_fill(compile_counts(counts, t, rules), list(EPSO_TYPES))
    return R.classify_ready(filled)


def compile_report(t: Inputs, rules: Rules = Rules()) -> DataFrame:
    """Graduates' file: counts, scores, readiness, report columns."""
    return R.student_report(classified(all_counts(t, rules), t, rules))


def compile_stored(spark: SparkSession, folder: str, t: Inputs, rules: Rules = Rules()) -> DataFrame:
    """Graduates' file from the counts that the newest run stored, without counting again."""
    return R.student_report(classified(newest_version(spark, folder), t, rules))


def compile_cohort(t: Inputs, rules: Rules | None = None) -> DataFrame:
    """Whole-cohort file: counts and scores for everyone, no classification."""
    rules = rules or whole_cohort()
    return compile_counts(all_counts(t, rules), t, rules)


def final_report(student_table: DataFrame, recalculated: DataFrame) -> DataFrame:
    """Student table merged with the recalculation, in final columns."""
    return R.final_columns(R.merge_final(student_table, recalculated))
