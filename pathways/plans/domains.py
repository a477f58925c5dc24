"""Counts per student for the eight opportunity types.

The five course-based types share one pass: each class section is tagged with
the types it belongs to, then joined, day-counted, rolled up and matched with
exams once for all of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import join_na, not_in_keep_null, share_at_least
from ..functions.skew import join_unique
from ..functions.text import first_match, has
from ..operators import certs as C
from ..operators import cohort as H
from ..operators import counts as N
from ..operators import enrollment as E
from ..operators import exams as X
from ..operators.crosswalk import crosswalk_for, exam_groups
from ..rules import HALF, NON_CREDIT_COURSES
from ..session import reuse
from .inputs import COURSE_DOMAINS, Inputs, Rules

AP_NAME = "sublevel1_shortname"
IB_NAME = "sublevel2_shortname"
NEEDS_NO_EXAM = ("de", "ldc")


def tagged_sections(t: Inputs, rules: Rules, domains: tuple[str, ...]) -> DataFrame:
    """Class sections with the domain(s) they count for, one row per domain.

    A title may match several patterns. Local dual credit is every flagged
    section whose course is in no crosswalk row.
    """
    listed_domains = [d for d in domains if d in rules.course_lists]
    by_title = [d for d in domains if d != "ldc" and d not in rules.course_lists]
    sections = t.cs
    if by_title:
        title = F.col("course_title")
        titles = t.catalog.groupBy("course_code").agg(
            *[
                F.bool_or(has(title, rules.patterns[d.upper()])).alias(f"is_{d}")
                for d in by_title
            ]
        )
        sections = join_unique(sections, titles, ["course_code"])
    tags = [F.when(F.col(f"is_{d}"), F.lit(d)) for d in by_title]
    tags += [
        F.when(F.col("course_code").isin(*rules.course_lists[d]), F.lit(d)) for d in listed_domains
    ]
    if "ldc" in domains:
        listed = (
            t.crosswalk.where(F.col("course_code").isNotNull())
            .select("course_code", F.lit(True).alias("in_crosswalk"))
            .distinct()
        )
        sections = join_unique(sections, listed, ["course_code"])
        local = (
            (F.col("local_dual_credit") == "Y")
            & F.col("course_code").isNotNull()
            & F.col("in_crosswalk").isNull()
        )
        tags.append(F.when(local, F.lit("ldc")))
    return sections.select(
        *E.SECTION_KEYS,
        "course_code",
        "cs_begin_date",
        "cs_end_date",
        F.explode(F.array_compact(F.array(*tags))).alias("domain"),
    )


def pulled_students(t: Inputs, rules: Rules) -> DataFrame:
    source = t.cohort if t.history is None else t.history
    return H.cohort_students(source, rules.cohort_year, rules.mode)


def tagged_enrollments(
    t: Inputs, rules: Rules, domains: tuple[str, ...], sections: DataFrame | None = None, join=E.course_enrollments
) -> DataFrame:
    """Tagged course enrollments of the pulled students; ``sections`` are those tagged before."""
    if sections is None:
        sections = tagged_sections(t, rules, domains)
    periods = H.only_students(t.isp, pulled_students(t, rules)).select(
        "isp_id", "student_key", "school_year", "school_bu_id", "withdrawal_reason",
        "begin_date", "end_date",
    )
    return join(periods, t.sca, sections)


def filled_enrollments(
    t: Inputs, rules: Rules, domains: tuple[str, ...], fills: DataFrame | None = None, tagged: DataFrame | None = None
) -> DataFrame:
    """Tagged course enrollments of the pulled students with days and filled dates.

    ``fills`` holds fill dates worked out before, by domain and scope, for a run
    over some of the students only; ``tagged`` the tagged enrollments, where a run has them already.
    """
    if tagged is None:
        tagged = tagged_enrollments(t, rules, domains)
    enrollments = E.attach_calendar(tagged, E.calendar_index(t.calendar))
    wanted = {rules.fill[d] for d in domains}
    open_ended = [d for d in domains if rules.fill[d] != "class_only"]
    if len(wanted) == 1:
        (scope,) = wanted
        counted = E.count_days(enrollments, open_ends=scope != "class_only")
        if scope in ("class_only", "open_ended"):
            return E.fill_end_dates(counted, scope)
        if fills is not None:
            return fill_from(counted, fills, rules, domains)
        return E.fill_end_dates(reuse(counted), scope, within=("domain",) if len(domains) > 1 else ())
    if len(open_ended) != len(domains):
        raise ValueError("domains counted together must agree on open ends")
    if fills is not None:
        return fill_from(E.count_days(enrollments), fills, rules, domains)
    return _fill_mixed(reuse(E.count_days(enrollments)), rules, domains)


SCOPE = ("domain", "scope_year", "scope_course")


def with_scope(df: DataFrame, rules: Rules, domains: tuple[str, ...]) -> DataFrame:
    """Rows with the scope of their fill date: year and course are blank where it is the whole domain."""
    local = F.col("domain").isin(*[d for d in domains if rules.fill[d] == "by_year_course"])
    return df.withColumns(
        {
            "scope_year": F.when(local, F.col("isp_school_year")),
            "scope_course": F.when(local, F.col("course_code")),
        }
    )


def fill_from(counted: DataFrame, fills: DataFrame, rules: Rules, domains: tuple[str, ...]) -> DataFrame:
    """Fill missing end dates from a table of dates by scope."""
    filled = join_na(with_scope(counted, rules, domains), fills.select(*SCOPE, "fill_date"), list(SCOPE))
    return filled.withColumns(
        {
            "cs_end_date": F.coalesce("cs_end_date", "sca_end_date", "fill_date"),
            "sca_end_date": F.coalesce("sca_end_date", "fill_date"),
        }
    ).drop("fill_date", "scope_year", "scope_course")


def _fill_mixed(counted: DataFrame, rules: Rules, domains: tuple[str, ...]) -> DataFrame:
    """Fill dates when some domains use one date and others one per year and course.

    The scope becomes a grouping key: year and course are blanked for the
    domains that fill globally, so one aggregate and one join serve both.
    """
    scoped = with_scope(counted, rules, domains)
    return E.fill_end_dates(scoped, "global", within=SCOPE).drop("scope_year", "scope_course")


def attended_courses(
    t: Inputs, rules: Rules, domains: tuple[str, ...], fills: DataFrame | None = None, tagged: DataFrame | None = None
) -> DataFrame:
    """(domain, student, course) attended for at least half, counted students only."""
    students = H.counted_students(t.cohort, rules.mode)
    kept = E.ends_within_assignment(
        E.active_enrollments(
            H.only_students(filled_enrollments(t, rules, domains, fills, tagged), students)
        )
    )
    credit = not_in_keep_null("course_code", NON_CREDIT_COURSES) | ~F.col("domain").isin(
        *NEEDS_NO_EXAM
    )
    segments = kept.where(credit).groupBy("domain", *E.SEGMENT_KEYS).agg(
        F.sum(E.COURSE_DAYS).alias(E.COURSE_DAYS), F.sum(E.ENROLLED_DAYS).alias(E.ENROLLED_DAYS)
    )
    courses = segments.groupBy("domain", "student_key", "course_code").agg(
        F.sum(E.ENROLLED_DAYS).alias(E.ENROLLED_DAYS), F.max(E.COURSE_DAYS).alias(E.COURSE_DAYS)
    )
    return courses.where(share_at_least(E.ENROLLED_DAYS, E.COURSE_DAYS, HALF)).select(
        "domain", "student_key", "course_code"
    )


def _scored(t: Inputs, domains: tuple[str, ...]) -> DataFrame:
    """Exams with a score, one row per domain, student and exam name."""
    parts = [
        X.exams_for(t.exams, d)
        .where(F.col(X.SCORE).isNotNull())
        .select(
            F.lit(d).alias("domain"),
            F.col("student_id").cast("bigint").alias("student_key"),
            F.col(name).alias("exam_name"),
        )
        for d, name in (("ap", AP_NAME), ("ib", IB_NAME))
        if d in domains
    ]
    return reduce(DataFrame.unionByName, parts).distinct().withColumn("has_score", F.lit(True))


def _counts_by_exam(rules: Rules, domains: tuple[str, ...]) -> Column:
    """Does the exam side allow the course to count?"""
    named = F.col("exam_name").isNotNull()
    cie_type = F.col("name_type") == "CIE" if rules.limit_cie_names else F.lit(True)
    tests = {
        "de": F.lit(True),
        "ldc": F.lit(True),
        "cie": named & cie_type & X.not_diploma("exam_name"),
        "ap": F.col("has_score"),
        "ib": F.col("has_score") & named,
    }
    return first_match([(F.col("domain") == d, tests[d]) for d in domains])


def with_evidence(
    attended: DataFrame, t: Inputs, rules: Rules, domains: tuple[str, ...]
) -> DataFrame:
    """Attended courses the exam rules of their domain let count."""
    if not set(domains) - set(NEEDS_NO_EXAM):
        return attended
    names = t.crosswalk.select(
        "course_code", "exam_name", F.col("epso_type").alias("name_type")
    ).distinct()
    named = join_na(attended, names, ["course_code"])
    if {"ap", "ib"} & set(domains):
        named = join_na(named, _scored(t, domains), ["domain", "student_key", "exam_name"])
    return named.where(_counts_by_exam(rules, domains)).select("domain", "student_key", "course_code")


def _with_exam_only(courses: DataFrame, t: Inputs, rules: Rules) -> DataFrame:
    """Add courses credited by a passed exam alone, as numbers per course group.

    An attended course in a group already credited is not counted again.
    """
    crosswalk = crosswalk_for(t.crosswalk, "AP")
    ap = F.lit("ap").alias("domain")
    students = H.counted_students(t.cohort, rules.mode)
    by_exam = X.exam_only_credit(students, X.exams_for(t.exams, "ap"), crosswalk, AP_NAME).select(
        ap, "student_key", "exam_group", "n_courses"
    )
    grouped = join_unique(
        courses, exam_groups(crosswalk).select(ap, "course_code", "exam_group"), ["domain", "course_code"]
    )
    attended = grouped.join(by_exam, ["domain", "student_key", "exam_group"], "left_anti")
    columns = ["domain", "student_key", "n_courses"]
    return attended.withColumn("n_courses", F.lit(1).cast("bigint")).select(columns).unionByName(
        by_exam.select(columns)
    )


def course_counts(
    t: Inputs,
    rules: Rules,
    domains: tuple[str, ...] = COURSE_DOMAINS,
    fills: DataFrame | None = None,
    tagged: DataFrame | None = None,
) -> DataFrame:
    """(student_key, epso_type, n_courses) of the course-based domains."""
    courses = with_evidence(attended_courses(t, rules, domains, fills, tagged), t, rules, domains)
    if set(domains) - set(NEEDS_NO_EXAM):
        by_exam = ~F.col("domain").isin(*NEEDS_NO_EXAM)
        courses = courses.where(F.col("course_code").isNotNull() | ~by_exam).distinct()
    credit = courses.withColumn("n_courses", F.lit(1).cast("bigint"))
    if "ap" in domains:
        credit = _with_exam_only(courses, t, rules)
    counts = credit.groupBy("student_key", F.col("domain").alias("epso_type")).agg(
        F.sum("n_courses").alias("n_courses")
    )
    if "de" not in domains or t.college_reported is None:
        return counts
    return _merge_reported(counts, t, rules, domains)


def _merge_reported(
    counts: DataFrame, t: Inputs, rules: Rules, domains: tuple[str, ...]
) -> DataFrame:
    """Combine dual enrollment with the colleges' own count.

    Stacked and aggregated with the other domains' counts, whose single row per
    student either rule leaves as it is.
    """
    reported = t.college_reported.groupBy(
        F.col("student_id").cast("bigint").alias("student_key")
    ).agg(F.count("*").alias("n_courses"))
    stacked = counts.unionByName(reported.withColumn("epso_type", F.lit("de")))
    merged = F.max("n_courses") if rules.merge_de == "max" else F.sum("n_courses")
    return stacked.groupBy("student_key", "epso_type").agg(merged.alias("n_courses"))


def ap_counts(t: Inputs, rules: Rules = Rules()) -> DataFrame:
    """Attended courses with a score in their exam, plus courses of passed exams."""
    return course_counts(t, rules, ("ap",))


def cie_counts(t: Inputs, rules: Rules = Rules()) -> DataFrame:
    """Attended courses with a non-diploma exam name; a score is not required."""
    return course_counts(t, rules, ("cie",))


def ib_counts(t: Inputs, rules: Rules = Rules()) -> DataFrame:
    return course_counts(t, rules, ("ib",))


def de_counts(t: Inputs, rules: Rules = Rules()) -> DataFrame:
    return course_counts(t, rules, ("de",))


def ldc_counts(t: Inputs, rules: Rules = Rules()) -> DataFrame:
    return course_counts(t, rules, ("ldc",))


def clep_counts(t: Inputs, rules: Rules = Rules()) -> DataFrame:
    """Distinct exams passed."""
    students = H.counted_students(t.cohort, rules.mode)
    passed = X.passing(X.exams_for(t.exams, "clep"), "clep", X.SCORE)
    return N.count_exams(X.cohort_exams(students, passed), "clep")


def sdc_counts(t: Inputs, rules: Rules = Rules()) -> DataFrame:
    """Distinct courses with an exam score; being tested implies enrollment."""
    students = H.counted_students(t.cohort, rules.mode)
    scored = X.passing(t.sdc, "present", "exam_score")
    return N.count_courses(X.cohort_exams(students, scored), "sdc")


def accepted_certs(t: Inputs, rules: Rules = Rules()) -> DataFrame:
    """Earned, standardised and accepted certifications of counted students."""
    students = H.counted_students(t.cohort, rules.mode)
    earned = C.drop_failed(C.numeric_student(t.certs), rules.mode)
    mine = H.only_students(earned, students)
    named = C.standardize_cert(mine, rules.mode)
    return C.accept_certs(C.lookup_credit(named, t.approved, t.conversion))


def ic_counts(t: Inputs, rules: Rules = Rules()) -> DataFrame:
    accepted = accepted_certs(t, rules)
    if rules.mode == "whole":
        return C.cert_total(accepted)
    return C.cert_credit(accepted, legacy_bundle=rules.legacy_bundle)


def all_counts(
    t: Inputs, rules: Rules = Rules(), fills: DataFrame | None = None, tagged: DataFrame | None = None
) -> DataFrame:
    """Counts of all eight types, stacked."""
    return N.stack(
        course_counts(t, rules, fills=fills, tagged=tagged), clep_counts(t, rules), ic_counts(t, rules), sdc_counts(t, rules)
    )
