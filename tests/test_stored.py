"""Stored joins, digests of snapshots, row numbers and bitmaps."""

from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from pathways.operators import asof as T
from pathways.operators import bitmaps as M
from pathways.operators import compare as Q
from pathways.operators import digests as G
from pathways.operators import enrollment as E
from pathways.operators import monitor
from pathways.operators import numbering as N
from pathways.sources import bucketed as K
from workload.tables import Bound


def counted(df):
    return Counter(map(tuple, df.select(sorted(df.columns)).collect()))


def test_the_second_run_of_the_star_shuffles_nothing(spark, small, tmp_path):
    b = Bound(spark, small)
    K.store_star(b.isp, b.sca, b.cs, str(tmp_path), buckets=6)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = K.stored_enrollments(spark, str(tmp_path), buckets=6)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan and "Exchange" not in plan and "Bucketed: true" in plan
        assert counted(joined) == counted(E.course_enrollments(b.isp, b.sca, b.cs))
        some = K.stored_enrollments(spark, str(tmp_path), courses=[3, 5, 8], buckets=6)
        assert counted(some) == counted(joined.where("course_code in (3, 5, 8)"))
        few = b.cohort.where("student_key % 9 = 1")
        assert counted(K.stored_enrollments(spark, str(tmp_path), students=few, buckets=6)) == counted(joined.where("student_key % 9 = 1 and student_key <= 150"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    with pytest.raises(Exception, match="exist"):
        K.write_bucketed(b.isp, f"{tmp_path}/periods", ["isp_id"], 6)


@pytest.fixture
def snapshots(spark, tmp_path):
    def keep(name, df):
        G.write_digested(df, f"{tmp_path}/{name}", parts=16)
        return G.Digested(spark, f"{tmp_path}/{name}")

    base = spark.range(500).select(
        F.col("id").alias("student_key"), F.when(F.col("id") % 7 != 0, F.col("id") % 30).alias("act"), F.when(F.col("id") % 3 == 0, "Y").alias("readiness")
    )
    one = base.withColumn("act", F.when(F.col("student_key") == 77, 36).otherwise(F.col("act")))
    return keep, base, keep("base", base), keep("again", base.repartition(5).orderBy(F.desc("student_key"))), keep("one", one), one


def test_equal_snapshots_open_no_rows(spark, snapshots):
    keep, base, stored, again, *_ = snapshots
    assert G.differing(stored, again) == ([], [])
    found = G.changed_rows_digested(again, stored, stored)
    # Nothing is left to scan: the plan has no file to open.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation <empty>" in plan and "parquet" not in plan and found.count() == 0
    assert Counter(map(tuple, G.mismatch_counts_digested(stored, again, ["act", "readiness"]).collect())) == Counter([("act", 0), ("readiness", 0)])


def test_only_parts_and_columns_that_differ_are_read(spark, snapshots):
    keep, base, stored, _, changed, one = snapshots
    parts, columns = G.differing(stored, changed)
    assert len(parts) == 1 and columns == ["act"]
    found = G.changed_rows_digested(changed, stored, stored)
    assert [tuple(r) for r in found.collect()] == [(77, 36, None)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull(part_no" in plan and str(parts[0]) in plan
    counts = G.mismatch_counts_digested(stored, changed, ["act", "readiness"])
    assert "readiness" not in counts.where("column_name = 'act'")._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    assert counted(counts) == counted(Q.mismatch_counts(base, one, ["act", "readiness"]))


def test_digests_see_copies_missing_values_and_moved_values(spark, snapshots):
    keep, base, stored, *_ = snapshots
    twice = keep("twice", base.unionByName(base.where("student_key = 3")))
    assert G.differing(stored, twice)[1] == ["student_key", "act", "readiness"]
    swapped = base.withColumn("act", F.when(F.col("student_key") == 1, 2).when(F.col("student_key") == 2, 1).otherwise(F.col("act")))
    assert G.differing(stored, keep("swapped", swapped))[1] == ["act"]
    blank = base.withColumn("readiness", F.coalesce("readiness", F.lit("")))
    assert G.differing(stored, keep("blank", blank))[1] == ["readiness"]
    fewer = keep("fewer", base.where("student_key < 400"))
    new = G.changed_rows_digested(stored, fewer, fewer)
    assert counted(new) == counted(monitor.changed_rows(base, base.where("student_key < 400"), base.where("student_key < 400")))


def test_row_numbers_equal_a_window(spark):
    rows = [(i * 37 % 500, None if i % 9 == 0 else i % 13) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(7)
    order = [F.desc_nulls_last("v"), F.asc("k")]
    want = [r[0] for r in df.orderBy(*order).select("k").collect()]
    found = N.numbered(df, order)
    assert [r.k for r in sorted(found.collect(), key=lambda r: r.row_number)] == want
    assert sorted(r.row_number for r in found.collect()) == list(range(1, 501))
    assert N.numbered(df.limit(0), order).count() == 0
    # The only window over everything has one row for each range.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1


def test_bitmaps_count_like_count_distinct(spark):
    rows = [(w, d, s, k) for k in range(70_000) for w, d, s in [(k % 3, k % 2, "Y" if k % 5 else None)]] + [(0, 0, "Y", 6), (1, 0, "Y", 6), (1, None, "N", 6)]
    df = spark.createDataFrame(rows, "week int, district int, status string, student_key long")
    numbers = M.student_numbers(df)
    assert numbers.agg(F.min("number"), F.max("number"), F.count_distinct("number")).first()[:] == (1, 70_000, 70_000)
    maps = M.bitmaps(df, ["week", "district", "status"], numbers)
    for keys in (["week", "district", "status"], ["week"], ["district"], ["status"]):
        assert counted(M.students_in(maps, keys)) == counted(df.groupBy(*keys).agg(F.count_distinct("student_key").alias("n_students")))
    assert M.students_in(maps, []).first()[0] == 70_000
    moved = M.moves(maps, "week", "status", F.lit(0), F.lit(1), ["Y", "N", None])
    assert Counter(map(tuple, moved.collect())) == Counter([("Y", "Y", 1), ("Y", "N", 1)])
    lattice = M.breakdowns(maps, ["week", "district", "status"], [("week", "district"), ("week",), (), ("status",)])
    found = {(r.grouping, r.week, r.status): r.n_students for r in lattice.collect() if r.grouping in ("week", "status", "")}
    assert found == {("", None, None): 70_000, ("status", None, "Y"): 56_000, ("status", None, "N"): 1, ("status", None, None): 14_000,
                     ("week", 0, None): 23_334, ("week", 1, None): 23_334, ("week", 2, None): 23_333}


@pytest.mark.parametrize("days", [1, 31, 10_000])
def test_rows_in_force(spark, days):
    day = lambda n: date(2019, 1, 1) + timedelta(n)
    dated = [("a", day(0), 1), ("a", day(40), 2), ("a", day(40), 3), ("a", day(90), None), ("b", day(5), 9), (None, day(0), 7), ("c", None, 8)]
    events = [("a", day(n), n) for n in (-5, 0, 1, 39, 40, 41, 89, 90, 400)] + [("b", day(5), 0), ("b", day(5), 0), ("b", day(4), 1), ("c", day(9), 2), (None, day(3), 3), ("a", None, 4)]
    found = T.in_force(
        spark.createDataFrame(events, "k string, at date, n int"), spark.createDataFrame(dated, "k string, since date, v int"), "k", "at", "since", ["v"], days
    )
    want = Counter()
    for k, at, n in events:
        known = [(s, v is not None, v) for key, s, v in dated if key == k and k and s and at and s <= at]
        since, _, v = max(known, default=(None, None, None), key=lambda t: (t[0], t[1], t[2] or 0))
        want[(k, at, n, since, v)] += 1
    assert Counter(map(tuple, found.collect())) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
