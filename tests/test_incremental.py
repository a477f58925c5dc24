"""Counts brought up to date from changes, against full runs."""

from collections import Counter
from dataclasses import dataclass, replace

import pytest
from pyspark.sql import functions as F

from pathways.plans import domains as D
from pathways.plans import incremental as I
from pathways.plans.inputs import Inputs, graduates, whole_cohort
from workload.change_queries import Changed
from workload.names import PATTERNS
from workload.tables import Bound

RULES = {"graduates": graduates(patterns=PATTERNS), "whole": whole_cohort(patterns=PATTERNS)}
TABLES = ("cohort", "isp", "sca", "cs", "calendar", "catalog", "crosswalk", "exams", "sdc", "college_reported", "certs", "approved", "conversion")


def counts(df):
    return Counter(map(tuple, df.select("student_key", "epso_type", "n_courses").collect()))


def inputs(b):
    return Inputs(**{name: getattr(b, name) for name in TABLES})


@pytest.fixture(scope="module")
def stored(spark, small):
    """Inputs written as tables, so that every test reads the same rows, and their state."""
    b = Bound(spark, small)
    t = inputs(b)
    return t, {mode: I.full_state(t, rules) for mode, rules in RULES.items()}


@dataclass
class Week:
    """A table's new version with its change."""

    table: str
    removed: object = None
    added: object = None

    def apply(self, t):
        df = getattr(t, self.table)
        if self.removed is not None:
            df = df.exceptAll(self.removed)
        return replace(t, **{self.table: df if self.added is None else df.unionByName(self.added)})


def check(stored, mode, weeks):
    t, states = stored
    rules, new = RULES[mode], t
    for week in weeks:
        new = week.apply(new)
    changes = {w.table: I.Change(w.removed, w.added) for w in weeks}
    done = I.refresh(states[mode], t, new, changes, rules)
    want = I.full_state(new, rules)
    assert counts(done.state.counts) == counts(want.counts) == counts(D.all_counts(new, rules))
    assert Counter(map(tuple, done.state.fills.collect())) == Counter(map(tuple, want.fills.collect()))
    assert Counter(map(tuple, done.state.touched.collect())) == Counter(map(tuple, want.touched.collect()))
    return done


def test_nothing_changed(stored):
    done = check(stored, "graduates", [])
    assert done.recounted.count() == 0


@pytest.mark.parametrize("mode", ["graduates", "whole"])
def test_rows_of_every_table_change(stored, mode):
    t, _ = stored
    exams = t.exams.where("student_id % 40 = 3")
    weeks = [
        Week("isp", t.isp.where("isp_id % 150 = 3"), t.isp.where("isp_id % 150 = 3").withColumn("withdrawal_reason", F.lit(1))),
        Week("sca", t.sca.where("isp_id % 120 = 5"), t.sca.where("isp_id % 120 = 7").withColumn("sca_begin_date", F.date_add("sca_begin_date", 20))),
        Week("cs", t.cs.where("course_code % 90 = 8"), t.cs.where("course_code % 90 = 8").withColumn("cs_end_date", F.lit(None).cast("date"))),
        Week("exams", exams, exams.withColumn("assessment_result_number_score", F.lit("5"))),
        Week("certs", t.certs.where("order_no % 90 = 4")),
        Week("sdc", None, t.sdc.where("student_id % 50 = 1").withColumn("exam_score", F.lit("99"))),
        Week("college_reported", t.college_reported.where("student_id % 60 = 2"), t.college_reported.limit(1).withColumn("student_id", F.lit(987654321).cast("bigint"))),
        Week("cohort", t.cohort.where("student_key % 50 = 6"), t.cohort.where("student_key % 50 = 6").withColumn("completion_type", F.lit(12))),
    ]
    done = check(stored, mode, weeks)
    assert 0 < done.recounted.count()


def test_a_fill_date_moves_on_and_falls_back(stored):
    t, _ = stored
    # A day after every other: all open ends of the types that fill from the whole set move.
    late = t.calendar.where("school_bu_id = 3").groupBy("school_bu_id").agg(F.max("school_year").alias("school_year"))
    late = late.withColumn("id_date", F.lit("2031-06-01").cast("date")).select(*t.calendar.columns)
    done = check(stored, "graduates", [Week("calendar", None, late)])
    opened = done.recounted.count()
    assert opened > 20
    # Taking away every period of the latest calendars lets the fill dates fall back.
    last = t.isp.agg(F.max("school_year")).first()[0]
    gone = t.isp.where(F.col("school_year") == last)
    done = check(stored, "graduates", [Week("isp", gone)])
    old = {tuple(r)[:3]: r.fill_date for r in stored[1]["graduates"].fills.collect()}
    new = {tuple(r)[:3]: r.fill_date for r in done.state.fills.collect()}
    assert any(new[k] < old[k] for k in new if old.get(k) is not None and new[k] is not None)


def test_states_are_written_and_read_again(stored, tmp_path, spark):
    t, states = stored
    states["graduates"].write(str(tmp_path), "2019-02-01")
    with pytest.raises(Exception, match="exists"):
        states["graduates"].write(str(tmp_path), "2019-02-01")
    again = I.read_state(spark, str(tmp_path), "2019-02-01")
    assert counts(again.counts) == counts(states["graduates"].counts)


def test_changes_found_by_comparing_versions(spark):
    old = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k long, v string")
    new = spark.createDataFrame([(1, "a"), (2, None), (3, "d"), (4, "e"), (4, "e")], "k long, v string")
    change = I.table_changes(old, new)
    assert Counter(map(tuple, change.removed.collect())) == Counter([(1, "a"), (3, "c")])
    assert Counter(map(tuple, change.added.collect())) == Counter([(3, "d"), (4, "e"), (4, "e")])
    assert I.table_changes(old, old).rows.count() == 0


def test_changed_lookups_need_a_full_run(stored):
    t, states = stored
    with pytest.raises(ValueError, match="catalog"):
        I.refresh(states["graduates"], t, t, {"catalog": I.Change(t.catalog)}, RULES["graduates"])


def test_a_small_change_recounts_few(spark):
    """A hundredth of the students changes: only they are joined, day-counted and matched."""
    b = Bound(spark, "/root/testdata/sf0.01")
    rows = b.isp.where("student_key % 100 = 7")
    found = I.affected_students(b, {"isp": I.Change(rows, rows.withColumn("withdrawal_reason", F.lit(1)))})
    n = found.count()
    assert 0 < n <= b.cohort.count() / 100
    assert {r[0] % 100 for r in found.collect()} == {7}
    mine = I.of_students(b, found)
    for table in ("cohort", "isp", "sca", "exams", "certs", "college_reported"):
        assert 0 < getattr(mine, table).count() < getattr(b, table).count() / 50
    # The restriction reaches the joins: enrollments are joined for these students only.
    joined = D.tagged_enrollments(mine, RULES["graduates"], I.filling(RULES["graduates"]))
    assert joined.count() < D.tagged_enrollments(b, RULES["graduates"], I.filling(RULES["graduates"])).count() / 50


def test_the_registered_week_changes_every_kind_of_table(spark):
    b = Changed(spark, "/root/testdata/sf0.01")
    assert set(b.changes) == {"isp", "sca", "cs", "exams", "certs", "cohort", "calendar"}
    found = I.affected_students(b, {k: c for k, c in b.changes.items() if k != "calendar"})
    assert 0 < found.count() < b.cohort.count() / 10
