"""Weekly monitoring: changed rows, appeals and district history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import join_na, n_distinct
from ..functions.skew import join_unique
from ..rules import NO_DATA_COMMENT, NO_DOCUMENT_COMMENT, SCORE_COLUMNS

FLAGS = ("n_doc_no_data", "n_docs_to_review", "n_data_no_doc", "n_new_data")


def changed_rows(current: DataFrame, previous: DataFrame, original: DataFrame) -> DataFrame:
    """Distinct current rows that equal no previous and no original row.

    The three sets are stacked with a tag and grouped once by all columns:
    missing values compare equal as in EXCEPT, and copies of a row are combined
    before the shuffle.
    """
    columns = current.columns
    tagged = reduce(
        DataFrame.unionByName,
        [
            df.select(*columns, F.lit(tag).alias("_source"))
            for tag, df in enumerate((current, previous, original))
        ],
    )
    return (
        tagged.groupBy(*columns)
        .agg(F.min("_source").alias("_lowest"), F.max("_source").alias("_highest"))
        .where((F.col("_lowest") == 0) & (F.col("_highest") == 0))
        .select(*columns)
    )


def appeal_status(changes: DataFrame, documents: DataFrame, current: DataFrame) -> DataFrame:
    """Changes and uploaded documents of each student, with organisation ids.

    ``changes`` and ``current`` hold one row per student, documents any number.
    The full join is built from two joins whose hot side can be split.
    """
    with_document = join_unique(documents, changes, ["student_key"])
    # The keys are reduced to one each before the shuffle: a hot student is one row here.
    without = changes.join(documents.select("student_key").distinct(), "student_key", "left_anti")
    both = with_document.unionByName(without, allowMissingColumns=True)
    return join_unique(both, current, ["student_key"])


def _present(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in columns])


def appeal_flags(df: DataFrame, scores: tuple[str, ...] = SCORE_COLUMNS) -> DataFrame:
    """Four review flags: document without data, document to review, data
    without document, new data."""
    any_score = _present([c for c in scores if c in df.columns])
    has_file = F.col("save_as_filename").isNotNull()
    no_status = F.col("status").isNull()
    doc_no_data = has_file & ~any_score
    return df.withColumns(
        {
            "n_doc_no_data": doc_no_data,
            "n_docs_to_review": has_file & no_status & ~doc_no_data,
            "n_data_no_doc": ~has_file & no_status,
            "n_new_data": any_score,
        }
    )


def with_district_name(df: DataFrame, names: DataFrame) -> DataFrame:
    """Every row with its district's name, if listed."""
    return join_na(df.withColumnRenamed("district_no", "system"), names, ["system"])


def status_by_district(df: DataFrame) -> DataFrame:
    return df.groupBy("system", "system_name").agg(
        *[F.count_if(F.col(c)).alias(c) for c in FLAGS]
    )


def propose_comments(df: DataFrame) -> DataFrame:
    """Comment to send where an appeal lacks its document or its data.

    Only rows still open (no status, 0 or 2) without a comment get one; a
    comment left on a row without status is cleared first.
    """
    status = F.col("status")
    comment = F.when(status.isNotNull(), F.col("comments"))
    is_open = (status.isNull() | status.isin(0, 2)) & comment.isNull()
    return df.withColumn(
        "proposed_comment",
        F.when(is_open & F.col("n_data_no_doc"), F.lit(NO_DOCUMENT_COMMENT)).when(
            is_open & F.col("n_doc_no_data"), F.lit(NO_DATA_COMMENT)
        ),
    )


def district_history(history: DataFrame, number: int) -> DataFrame:
    """Counts and status of one district's students over all earlier files."""
    return history.where(F.col("district_no") == number).orderBy(
        F.asc_nulls_last("student_key"), F.desc_nulls_last("file_time")
    )


def status_flips(history: DataFrame) -> DataFrame:
    """All rows of students whose status differs between files."""
    flipped = (
        history.groupBy("student_key")
        .agg(n_distinct("readiness").alias("n"))
        .where(F.col("n") > 1)
    )
    return join_unique(history, flipped, ["student_key"], "left_semi")
