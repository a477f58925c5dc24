"""Industry certifications: standard names, acceptance and credit."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import as_col, join_na, not_in_keep_null, sum0, to_whole
from ..functions.text import first_match, has
from ..rules import (
    BUNDLE_CREDIT,
    BUNDLE_PARTS,
    BUNDLE_PATTERN,
    CERT_FAILED_GRADUATES,
    CERT_FAILED_WHOLE,
    CERT_NAMES,
    CERT_NAMES_GRADUATES,
    CERT_PASSING,
    EPSO_READY,
    ACT_READY,
    SAT_READY,
    RECODED_CREDIT,
    RECODED_FULL,
)


def _rules(mode: str):
    return CERT_NAMES + (CERT_NAMES_GRADUATES if mode == "graduates" else ())


def _listed_names(mode: str) -> dict[str, str]:
    """Standard name of every name that a rule lists exactly, by the first rule."""

    def holds(name: str, kind: str, texts: tuple[str, ...], without: str | None) -> bool:
        if kind == "is":
            return name in texts
        return all(re.search(p, name) for p in texts) and not (without and re.search(without, name))

    listed = [texts[0] for _, kind, texts, _ in _rules(mode) if kind == "is"]
    return {
        name: next(out for out, *rule in _rules(mode) if holds(name, *rule)) for name in listed
    }


def _matches(name: Column, patterns: tuple[str, ...], without: str | None) -> Column:
    """All patterns occur and the excluded one does not."""
    held = reduce(lambda a, b: a & b, [has(name, p) for p in patterns])
    return held & ~has(name, without) if without else held


def standard_name(name: Column | str, mode: str = "graduates") -> Column:
    """Standard certification name: the first rule that applies, else the name.

    Names listed exactly are looked up in one map; only the others go through
    the patterns. One branch per rule would make the generated method of the
    stage too large to be compiled by the JVM.
    """
    name = as_col(name)
    listed = F.create_map(*[F.lit(v) for pair in _listed_names(mode).items() for v in pair])
    by_pattern = first_match(
        [
            (_matches(name, patterns, without), F.lit(out))
            for out, kind, patterns, without in _rules(mode)
            if kind == "has"
        ],
        name,
    )
    return F.coalesce(F.try_element_at(listed, name), by_pattern)


def standardize_cert(df: DataFrame, mode: str = "graduates") -> DataFrame:
    """Add ``standard_name``.

    Evaluated row by row inside the scan stage: cheaper than a shuffle of the
    records to join a table of distinct names.
    """
    return df.withColumn("standard_name", standard_name("cert_name", mode))


def drop_failed(df: DataFrame, mode: str = "graduates") -> DataFrame:
    """Drop records marked as failed; an unmarked record stays."""
    failed = CERT_FAILED_GRADUATES if mode == "graduates" else CERT_FAILED_WHOLE
    return df.where(not_in_keep_null("pass_fail", failed))


def numeric_student(df: DataFrame) -> DataFrame:
    """Student key from the id text; records without a numeric id are dropped."""
    key = F.col("student_id").try_cast("double").try_cast("bigint")
    return df.withColumn("student_key", key).where(F.col("student_key").isNotNull())


def lookup_credit(certs: DataFrame, approved: DataFrame, conversion: DataFrame) -> DataFrame:
    """Approved name and credit of each record.

    The credit is that of the standard name, else that of the approved new name.
    """
    listed = approved.where(F.col("promoted") == "x").select(
        "cert_name", "source_file", "new_cert", F.col("pass_fail").alias("pass_rule")
    )
    found = join_na(certs, listed, ["cert_name", "source_file"])
    by_name = conversion.select("cert_name", F.col("n_epso").alias("credit_standard"))
    by_new = conversion.select("cert_name", F.col("n_epso").alias("credit_new"))
    found = join_na(found, by_name, [("standard_name", "cert_name")])
    found = join_na(found, by_new, [("new_cert", "cert_name")])
    return found.withColumn("n_epso", F.coalesce("credit_standard", "credit_new")).drop(
        "credit_standard", "credit_new"
    )


def accept_certs(df: DataFrame, rule: str = "pass_rule") -> DataFrame:
    """No pass rule, a plain pass, or a score of 70 where the rule asks for it."""
    rule_text = F.col(rule)
    return df.where(
        rule_text.isNull()
        | (rule_text == "Pass")
        | ((to_whole("test_score") >= CERT_PASSING) & has(rule_text, "70"))
    )


def in_bundle() -> Column:
    return F.col("standard_name").rlike(BUNDLE_PATTERN)


def bundle_credit(df: DataFrame, domain: str = "ic") -> DataFrame:
    """Students who hold all four parts of the production bundle."""
    return (
        df.where(in_bundle())
        .groupBy("student_key")
        .agg(F.count_distinct("cert_name").alias("n"))
        .where(F.col("n") == BUNDLE_PARTS)
        .select(
            "student_key",
            F.lit(domain).alias("epso_type"),
            F.lit(BUNDLE_CREDIT).cast("bigint").alias("n_courses"),
        )
    )


def cert_credit(df: DataFrame, domain: str = "ic", legacy_bundle: bool = False) -> DataFrame:
    """Credit per student: the first certification in full, each later one less 1.

    Ranking is not needed for the total: it is the sum less one for each record
    with credit beyond the first. A complete bundle counts as one certification
    of four credits (0 with ``legacy_bundle``); its parts count nothing.
    """
    single = ~in_bundle()
    part = F.when(in_bundle(), F.col("cert_name"))
    totals = df.groupBy("student_key").agg(
        F.count_distinct(part).alias("n_parts"),
        F.count_if(single).alias("n_single"),
        sum0(F.when(single, F.col("n_epso"))).alias("credit"),
        F.count(F.when(single, F.col("n_epso"))).alias("n_credited"),
    )
    complete = F.col("n_parts") == BUNDLE_PARTS
    extra = F.when(complete & F.lit(not legacy_bundle), F.lit(1)).otherwise(F.lit(0))
    credit = F.col("credit") + extra * BUNDLE_CREDIT
    later = F.greatest(F.col("n_credited") + extra - 1, F.lit(0))
    return totals.where(complete | (F.col("n_single") > 0)).select(
        "student_key",
        F.lit(domain).alias("epso_type"),
        (credit - later).cast("bigint").alias("n_courses"),
    )


def cert_total(df: DataFrame, domain: str = "ic") -> DataFrame:
    """Whole-cohort rule: the plain sum of credits."""
    return df.groupBy("student_key").agg(
        F.lit(domain).alias("epso_type"), sum0("n_epso").cast("bigint").alias("n_courses")
    )


def decrement_after_first(df: DataFrame, value: str, record: list[str]) -> DataFrame:
    """Rows with ``value`` less 1 on all but the student's highest-valued record.

    ``record`` names columns that identify a row within the student. The top
    record is found by an aggregate and joined on student and record, so even a
    student with very many rows is spread over tasks.
    """
    order = F.struct(F.col(value).isNotNull().alias("_has"), F.col(value), *record)
    top = (
        df.groupBy("student_key")
        .agg(F.max(order).alias("_top"))
        .select("student_key", *[F.col(f"_top.{c}").alias(c) for c in record], F.lit(True).alias("_first"))
    )
    joined = df.join(top, ["student_key", *record], "left")
    return joined.withColumn(
        value, F.when(F.col("_first"), F.col(value)).otherwise(F.col(value) - 1)
    ).drop("_first")


def credit_impact(old: DataFrame, new: DataFrame, report: DataFrame) -> DataFrame:
    """Students whose credit fell below four, by whether they are still ready."""
    others = ["n_cambridge", "n_ap", "n_ib", "n_sdc", "n_ldc", "n_de"]
    fell = (
        old.select("student_key", "epso_type", F.col("n_courses").alias("n_old"))
        .join(
            new.select("student_key", "epso_type", F.col("n_courses").alias("n_new")),
            ["student_key", "epso_type"],
            "inner",
        )
        .where((F.col("n_old") >= EPSO_READY) & (F.col("n_new") < EPSO_READY))
    )
    scored = fell.join(
        report.select("student_key", *others, "act_composite", "sat_total"), "student_key", "left"
    )
    total = reduce(lambda a, b: a + b, [F.col(c) for c in ["n_new", *others]])
    ready = (
        (total >= EPSO_READY)
        | (F.col("act_composite") >= ACT_READY)
        | (F.coalesce(F.col("sat_total"), F.lit(0)) >= SAT_READY)
    )
    return scored.groupBy(ready.alias("still_ready")).agg(F.count("*").alias("n"))


def recode_and_compare(records: DataFrame, counts: DataFrame, text: str = "epso_ic") -> DataFrame:
    """Credit recoded from text and totalled, against the calculated counts."""
    coded = first_match(
        [(has(text, p), F.lit(n)) for p, n in RECODED_CREDIT]
        + [(F.col(text) == RECODED_FULL[0], F.lit(RECODED_FULL[1]))]
    )
    totals = records.groupBy("student_key").agg(sum0(coded).cast("bigint").alias("n_recoded"))
    both = totals.join(counts.select("student_key", "n_courses"), "student_key", "full")
    return both.withColumn("mismatch", F.col("n_courses") != F.col("n_recoded"))
