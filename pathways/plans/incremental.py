"""Counts kept up to date from the rows that changed.

A run leaves three tables: the counts; for every scope of a fill date (a domain, or
a domain, year and course) the number of enrollments by school and school year; and
the fill dates these give. The next run finds the students that a change can reach,
counts those anew and puts the others' stored counts beside them.

What reaches a student: rows with the student's key in the cohort, service periods,
exams, certifications and reports; changed class assignments of the student's
periods; changed sections that one of the assignments names; changed calendars of a
school and year the student was in; and a changed fill date of a scope in which the
student has an assignment without an end. Numbers of enrollments go up and down with
added and removed rows, so a fill date that only removed rows supported falls back.

The catalog, the crosswalk, the approved certifications, the conversion table and
the rules must be those of the stored run; after a change in them, run in full.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nulls import join_na
from ..functions.skew import join_unique
from ..operators import certs as C
from ..operators import cohort as H
from ..operators import enrollment as E
from ..session import reuse
from ..sources.writers import write_versioned
from .domains import SCOPE, all_counts, pulled_students, tagged_enrollments, tagged_sections, with_scope
from .inputs import COURSE_DOMAINS, Inputs, Rules

CALENDAR = ("school_bu_id", "isp_school_year")


@dataclass(frozen=True)
class Change:
    """Rows that left a table and rows that came; a changed row is one of each."""

    removed: DataFrame | None = None
    added: DataFrame | None = None

    @property
    def rows(self) -> DataFrame:
        """Both, in the columns that they share."""
        parts = [df for df in (self.removed, self.added) if df is not None]
        return reduce(lambda a, b: a.unionByName(b), parts)


@dataclass(frozen=True)
class State:
    """What a run leaves to the next one."""

    counts: DataFrame
    touched: DataFrame
    fills: DataFrame

    def write(self, folder: str, run_id: str) -> None:
        for name in ("touched", "fills", "counts"):  # the counts last: where they are, all is
            write_versioned(getattr(self, name), f"{folder.rstrip('/')}/{name}", run_id)


def read_state(spark: SparkSession, folder: str, run_id: str) -> State:
    return State(*[spark.read.parquet(f"{folder.rstrip('/')}/{name}/run_id={run_id}") for name in ("counts", "touched", "fills")])


def table_changes(old: DataFrame, new: DataFrame) -> Change:
    """What changed between two versions of a table, where its source does not tell.

    Repeated rows count: a row that was there twice and is there once was removed once.
    One shuffle of both versions, with equal rows combined before it.
    """
    columns = old.columns
    signed = old.withColumn("_n", F.lit(-1)).unionByName(new.select(*columns).withColumn("_n", F.lit(1)))
    net = reuse(signed.groupBy(*columns).agg(F.sum("_n").alias("_n")).where("_n <> 0"))
    copies = net.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("_n"))))
    return Change(copies.where("_n < 0").select(*columns), copies.where("_n > 0").select(*columns))


def _keys(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).cast("bigint").alias("student_key"))


def _students_of_periods(isp: DataFrame, ids: DataFrame, on: list[str]) -> DataFrame:
    return join_unique(isp, ids.distinct(), on, "left_semi").select("student_key")


def affected_students(new: Inputs, changes: dict[str, Change]) -> DataFrame:
    """Students whose counts a changed row can reach by itself, each once.

    An unchanged period, assignment or section is the same in both versions, and a
    changed one is found by its own change, so the new tables suffice to look up.
    """
    found = []
    for name, change in changes.items():
        if name in ("cohort", "history", "isp"):
            found.append(_keys(change.rows, "student_key"))
        elif name in ("exams", "sdc", "college_reported"):
            found.append(_keys(change.rows, "student_id"))
        elif name == "certs":
            found.append(C.numeric_student(change.rows).select("student_key"))
        elif name == "sca":
            found.append(_students_of_periods(new.isp, change.rows.select("isp_id"), ["isp_id"]))
        elif name == "cs":
            named = join_unique(new.sca, change.rows.select(*E.SECTION_KEYS).distinct(), E.SECTION_KEYS, "left_semi")
            found.append(_students_of_periods(new.isp, named.select("isp_id"), ["isp_id"]))
        elif name == "calendar":
            years = change.rows.select("school_bu_id", "school_year")
            found.append(_students_of_periods(new.isp, years, ["school_bu_id", "school_year"]))
        else:
            raise ValueError(f"a change in {name} needs a full run")
    if not found:
        return new.cohort.select(F.col("student_key").cast("bigint").alias("student_key")).limit(0)
    return reduce(DataFrame.unionByName, found).where("student_key is not null").distinct()


def of_students(t: Inputs, students: DataFrame, assignments: bool = True) -> Inputs:
    """The tables with the rows of some students only; lookups, which name no student, stay whole.

    So do the assignments without ``assignments``: for those who join them with the periods anyway.
    """

    def mine(df: DataFrame | None, column: str) -> DataFrame | None:
        if df is None:
            return None
        key = F.col(column).try_cast("double").try_cast("bigint") if column == "student_id" else F.col(column)
        kept = df.withColumn("_student", key)
        return join_unique(kept, students.select(F.col("student_key").alias("_student")), ["_student"], "left_semi").drop("_student")

    isp, sca = mine(t.isp, "student_key"), t.sca
    if assignments and sca is not None:
        sca = join_unique(sca, isp.select("isp_id").distinct(), ["isp_id"], "left_semi")
    return Inputs(
        cohort=mine(t.cohort, "student_key"), history=mine(t.history, "student_key"),
        isp=isp, sca=sca, cs=t.cs,
        calendar=t.calendar, catalog=t.catalog, crosswalk=t.crosswalk, exams=mine(t.exams, "student_id"),
        sdc=mine(t.sdc, "student_id"), college_reported=mine(t.college_reported, "student_id"),
        certs=mine(t.certs, "student_id"), approved=t.approved, conversion=t.conversion,
    )


def enrollments_of(t: Inputs, students: DataFrame, rules: Rules, sections: DataFrame | None = None) -> DataFrame:
    """Tagged course enrollments of some students."""
    return tagged_enrollments(of_students(t, students, assignments=False), rules, COURSE_DOMAINS, sections, E.enrollments_of_periods)


def filling(rules: Rules) -> tuple[str, ...]:
    """Domains whose missing ends are filled with a date that other students' rows decide."""
    return tuple(d for d in COURSE_DOMAINS if rules.fill[d] in ("global", "by_year_course"))


def touched_calendars(tagged: DataFrame, rules: Rules) -> DataFrame:
    """Tagged enrollments by scope of the fill date, school and school year."""
    domains = filling(rules)
    rows = with_scope(tagged.where(F.col("domain").isin(*domains)), rules, domains)
    return rows.groupBy(*SCOPE, *CALENDAR).agg(F.count(F.lit(1)).alias("n"))


def fill_dates(touched: DataFrame, calendar: DataFrame) -> DataFrame:
    """Fill date of each scope: the last day of any calendar that its enrollments touch."""
    last = calendar.groupBy("school_bu_id", F.col("school_year").alias("isp_school_year")).agg(F.max("id_date").alias("last_day"))
    met = join_unique(touched, last, list(CALENDAR))
    return met.groupBy(*SCOPE).agg(F.max("last_day").alias("fill_date"))


def full_state(t: Inputs, rules: Rules = Rules()) -> State:
    """State after a full run."""
    if not filling(rules):
        spark = t.cohort.sparkSession
        scope = "domain string, scope_year int, scope_course int"
        touched = spark.createDataFrame([], f"{scope}, school_bu_id long, isp_school_year int, n long")
        return State(reuse(all_counts(t, rules)), touched, spark.createDataFrame([], f"{scope}, fill_date date"))
    # Joined once, for the numbers of enrollments and for the counts.
    tagged = reuse(tagged_enrollments(t, rules, COURSE_DOMAINS))
    touched = reuse(touched_calendars(tagged, rules))
    fills = reuse(fill_dates(touched, t.calendar))
    return State(reuse(all_counts(t, rules, fills, tagged)), touched, fills)


def _students_with_open_ends(t: Inputs, rules: Rules, scopes: DataFrame, tagged: DataFrame) -> DataFrame:
    """Students with an assignment without an end in one of the scopes; ``tagged`` are the tagged sections."""
    domains = filling(rules)
    opened = t.sca.where("sca_end_date is null")
    sections = join_unique(tagged, scopes.select("domain").distinct(), ["domain"], "left_semi")
    periods = H.only_students(t.isp, pulled_students(t, rules)).select("isp_id", "student_key", "school_year", "school_bu_id")
    rows = with_scope(E.course_enrollments(periods, opened, sections), rules, domains).select("student_key", *SCOPE)
    marked = join_na(rows, scopes.select(*SCOPE).withColumn("changed", F.lit(True)), list(SCOPE))
    return marked.where("changed").select(F.col("student_key").cast("bigint").alias("student_key")).distinct()


@dataclass(frozen=True)
class Refreshed:
    """The new state and the students that were counted for it."""

    state: State
    recounted: DataFrame


def refresh(state: State, old: Inputs, new: Inputs, changes: dict[str, Change], rules: Rules = Rules()) -> Refreshed:
    """State after a change of the tables, equal to that of a full run over ``new``.

    ``changes`` tells by table what differs between ``old`` and ``new``. Only the
    affected students' periods, assignments, exams and certifications are joined,
    day-counted and matched.
    """
    students = reuse(affected_students(new, changes))
    touched, fills = state.touched, state.fills
    sections = reuse(tagged_sections(new, rules, COURSE_DOMAINS))
    tagged = reuse(enrollments_of(new, students, rules, sections))
    if filling(rules):
        before = touched_calendars(enrollments_of(old, students, rules), rules)
        after = touched_calendars(tagged, rules)
        moved = before.withColumn("n", -F.col("n")).unionByName(after)
        touched = state.touched.unionByName(moved).groupBy(*SCOPE, *CALENDAR).agg(F.sum("n").alias("n")).where("n <> 0")
        touched = reuse(touched)
        fills = reuse(fill_dates(touched, new.calendar))
        dates = state.fills.withColumn("_n", F.lit(1)).unionByName(fills.withColumn("_n", F.lit(-1)))
        # Scopes that came or went count too; their dates differ from none at all.
        scopes = dates.groupBy(*SCOPE, "fill_date").agg(F.sum("_n").alias("_n")).where("_n <> 0").select(*SCOPE).distinct()
        scopes = reuse(scopes)
        if scopes.take(1):
            # Only the students that come in by this are joined; the others' enrollments are there.
            opened = _students_with_open_ends(new, rules, scopes, sections)
            further = reuse(join_unique(opened, students, ["student_key"], "left_anti"))
            tagged = reuse(tagged.unionByName(enrollments_of(new, further, rules, sections)))
            students = reuse(students.unionByName(further))
    counted = all_counts(of_students(new, students, assignments=False), rules, fills, tagged)
    kept = join_unique(state.counts, students, ["student_key"], "left_anti")
    return Refreshed(State(reuse(kept.unionByName(counted)), touched, fills), students)
