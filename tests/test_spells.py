"""Spells swept in slices, and joins whose salts follow measured keys."""

import random
from collections import Counter, defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from pathways.functions.skew import HASH, PART, hot_keys, join_measured
from pathways.operators import spells as S

ROWS = "k string, c int, b date, e date"


def swept(rows):
    """Number of the spell of each row, in plain Python."""
    groups = defaultdict(list)
    for k, c, b, e in rows:
        if b is not None:
            groups[k, c].append((b, max(e or date.max, b)))
    found = {}
    for g, v in groups.items():
        n, reach = 0, None
        for b, e in sorted(v):
            if reach is None or b > reach:
                n, reach = n + 1, e
            found[g, b] = n
            reach = max(reach, e)
    return Counter((*r, found.get((r[:2], r[2]))) for r in rows)


def intervals(n, seed=4):
    r = random.Random(seed)
    start = date(2010, 1, 1)
    rows = []
    for _ in range(n):
        b = start + timedelta(r.randrange(6000))
        long_ = r.random()
        e = None if long_ < 0.002 else b + timedelta(r.randrange(-2, 5 if long_ < 0.97 else 900))
        rows.append((r.choice(["a", "a", "a", "b", None, f"s{r.randrange(40)}"]), r.choice([1, 2, None]), b if r.random() > 0.02 else None, e))
    return [*rows, *rows[:5], ("x", 1, date(1, 1, 1), None), ("x", 1, date(9999, 12, 31), date(9999, 12, 31)), ("y", 1, date(2020, 1, 1), date(2020, 1, 2)), ("y", 1, date(2020, 1, 2), date(2020, 1, 3))]


@pytest.mark.parametrize("days", [7, 366, 100_000])
def test_spells_against_a_plain_sweep(spark, days):
    rows = intervals(1500)
    df = spark.createDataFrame(rows, ROWS)
    assert Counter(map(tuple, S.with_spells(df, ["k", "c"], "b", "e", days).select("k", "c", "b", "e", "spell").collect())) == swept(rows)


def test_spell_summary(spark):
    rows = [("a", 1, date(2020, 1, 1), date(2020, 1, 5)), ("a", 1, date(2020, 1, 5), date(2020, 1, 4)), ("a", 1, date(2020, 1, 6), None), ("a", 1, None, None)]
    found = S.spells(spark.createDataFrame(rows, ROWS), ["k", "c"], "b", "e").collect()
    assert Counter(map(tuple, found)) == Counter([("a", 1, 1, date(2020, 1, 1), date(2020, 1, 5), 2), ("a", 1, 2, date(2020, 1, 6), None, 1)])
    assert S.spells(spark.createDataFrame([], ROWS), ["k", "c"], "b", "e").count() == 0


def test_a_hot_group_is_swept_by_many_tasks(spark):
    """A third of all rows is one student's course: no window partition holds more than a slice."""
    start = date(2000, 1, 1)
    rows = [("hot", 1, start + timedelta(2 * i), start + timedelta(2 * i)) for i in range(3000)]
    rows += [(f"s{i}", 1, start + timedelta(i), start + timedelta(i)) for i in range(6000)]
    df = spark.createDataFrame(rows, ROWS)
    plan = S.spell_of_days(df, ["k", "c"], "b", "e", 100)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # Either within a slice, or over the one row that each slice leaves.
    parts = [w.split("], [") for w in windows]
    assert len(parts) >= 4 and all("_slice" in p[1] or "_slice" in p[2] for p in parts)
    per_slice = df.groupBy("k", "c", F.floor(F.datediff("b", F.lit("1970-01-01").cast("date")) / 100)).count()
    assert per_slice.agg(F.max("count")).first()[0] <= 100
    assert S.with_spells(df, ["k", "c"], "b", "e", 100).where("k = 'hot'").agg(F.max("spell")).first()[0] == 3000


# measured salts


@pytest.fixture
def skewed(spark):
    rows = [(7 if i % 3 == 0 else i, None if i % 11 == 0 else "x", i) for i in range(30_000)]
    df = spark.createDataFrame(rows, "k long, kind string, v long")
    lookup = spark.createDataFrame([(i, "x", f"n{i}") for i in range(0, 30_000, 2)] + [(7, "x", "seven"), (None, "x", "none")], "k int, kind string, name string")
    return df, lookup


def test_only_hot_keys_are_measured_as_hot(spark, skewed):
    df, _ = skewed
    hot = hot_keys(df, ["k"], 16).collect()
    assert len(hot) == 1 and hot[0]["_salts"] == 6
    assert hot_keys(df.where("k <> 7"), ["k"], 16).count() == 0
    assert hot_keys(df.limit(0), ["k"], 16).count() == 0


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_joins_equal_plain_ones(skewed, how):
    df, lookup = skewed
    found = join_measured(df, lookup, ["k", "kind"], how, 16)
    plain = df.join(lookup, ["k", "kind"], how)
    assert found.columns == plain.columns
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, plain.collect()))


def test_a_hot_key_is_spread_without_adaptive_execution(spark, skewed):
    df, lookup = skewed
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "16")

        def largest(joined):
            return joined.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]

        salted, plain = join_measured(df, lookup, ["k"]), df.join(lookup, ["k"], "left")
        assert largest(plain) > 10_000 and largest(salted) < 6_500
        text = salted._jdf.queryExecution().executedPlan().toString()
        assert PART in text and "CartesianProduct" not in text
        # Lookup rows are copied for the hot key only.
        marked = lookup.count() + hot_keys(df, ["k"], 16).agg(F.sum("_salts") - 1).first()[0]
        assert marked == lookup.count() + 5
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_missing_keys_are_spread_and_match_nothing(spark):
    df = spark.createDataFrame([(None, i) for i in range(4000)] + [(1, -1)], "k long, v long")
    lookup = spark.createDataFrame([(None, "none"), (1, "one")], "k long, name string")
    found = join_measured(df, lookup, ["k"], "left", 8)
    assert hot_keys(df, ["k"], 8).count() == 1 and HASH not in found.columns
    assert Counter(r.name for r in found.collect()) == Counter({None: 4000, "one": 1})
