"""Repeated spans, suffix arrays, the Jaccard join and components against plain Python."""


import numpy as np
import pytest
from cases import BASE, SCHEMA, awkward, clashing, jaccard_components, repeated_spans
from hypothesis import given, settings
from hypothesis import strategies as st

from pathways.llm import components, hashing, ngram_join, suffixes
from pathways.llm import repeated_spans as spans

SMALL = st.lists(st.integers(1, 4), max_size=70)


@settings(max_examples=150, deadline=None)
@given(SMALL, st.sampled_from([2, 4096]))
def test_suffix_array_and_prefixes(body, buckets):
    old, suffixes.BUCKETS = suffixes.BUCKETS, buckets
    try:
        text = np.array([*body, 0], np.uint16)
        order = suffixes.suffix_array(text, 5)
    finally:
        suffixes.BUCKETS = old
    raw = text.tolist()
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    for k, (a, b) in zip(suffixes.common_prefixes(text.astype(np.uint8), order), zip(order[:-1], order[1:])):
        n = next((i for i in range(len(raw)) if max(a, b) + i >= len(raw) or raw[a + i] != raw[b + i]), 0)
        assert k == n


def test_long_runs_of_one_character():
    text = np.array([1] * 3000 + [2] * 500 + [1] * 40 + [0], np.uint16)
    raw = text.tolist()
    assert suffixes.suffix_array(text, 3).tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=5, max_size=80), st.integers(1, 5))
def test_window_minima(values, width):
    x = np.array(values, np.uint64)
    least, place = spans.window_minima(x, width)
    top = [v >> 8 for v in values]
    for i in range(len(values) - width + 1):
        window = top[i : i + width]
        assert least[i] == min(window) and place[i] == i + window.index(min(window))


def test_substring_hashes_do_not_depend_on_their_place():
    data = np.frombuffer(b"abcabcabd", np.uint8)
    sums = hashing.running(data)
    h = hashing.substrings(sums, np.arange(7), np.arange(7) + 3)
    assert h[0] == h[3] and len({int(x) for x in h}) == 4


def texts():
    shared = " ".join(f"passage{i}" for i in range(40))
    lines = [f"{i} start {shared} end {i * 7} and {'tail ' * (i % 4)}" for i in range(12)]
    return [*lines, shared, shared, "period " * 60, "ab" * 300, "x" * 199, "x" * 200, "é" * 150, "é" * 99 + "e", None, "", BASE, BASE + "x"]


@pytest.mark.parametrize("options", [{}, {"crowded": 1}, {"shard_bytes": 500}])
def test_repeated_spans_by_brute_force(spark, options):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts())]
    rows += [rows[3], (4, "another text with a used id " * 9, "en", "s", 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in spans.repeated_spans(clashing(df, "id", "runs", "sha", "times"), **options).collect())
    assert got == sorted(repeated_spans([r[:2] for r in rows], 200))


def test_a_common_passage_is_one_segment(spark):
    """A low bound of segments does not turn a shared passage into its single strings."""
    passage = " ".join(f"shared{i}" for i in range(110))
    rows = [(i, f"{i} opens here {'a' * (i % 7)} {passage} {'b' * (i % 5)} and {i} ends", "en", "s", 0) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    made = []
    emit = spans.occurrences

    def counted(candidates, length, with_bytes):
        made.append(emit(candidates, length, with_bytes).count())
        return emit(candidates, length, with_bytes)

    results = []
    spans.occurrences = counted
    try:
        for crowded in (20_000, 100):
            results.append(sorted(tuple(r) for r in spans.repeated_spans(df, crowded=crowded).collect()))
    finally:
        spans.occurrences = emit
    assert results[0] == results[1] == sorted(repeated_spans([r[:2] for r in rows], 200))
    assert max(made[2:]) < 12 * max(made[:2])  # once 114 times as many


def test_repeated_spans_of_awkward_rows(spark):
    rows = awkward()
    got = sorted(tuple(r) for r in spans.repeated_spans(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == sorted(repeated_spans([r[:2] for r in rows], 200))


# Jaccard join


def near_copies(n=60):
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(n):
        w = list(base)
        for k in range(i % 9):
            w[(i * 13 + k * 29) % 120] = f"new{i}x{k}"
        rows.append((1000 + i, " ".join(w)))
    return rows


def documents():
    rows = {r[0]: r[1] for r in awkward()}
    rows[4] = awkward()[4][1]
    return [*rows.items(), *near_copies(), (2000, "TWO words"), (2001, "ONE"), (2002, BASE.upper())]


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80)])
@pytest.mark.parametrize("options", [{}, {"most": 3, "pivots": 2, "last": 40}, {"most": 10, "pivots": 3}, {"most": 50, "most_bytes": 4_000}, {"most": 4, "most_bytes": 2_000}])
def test_jaccard_components_by_brute_force(spark, words, percent, options):
    docs = documents()
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], SCHEMA).repartition(4)
    found = ngram_join.jaccard_components(clashing(df, "n", "rep", "set_id", "cells"), words=words, percent=percent, **options)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()}
    want = jaccard_components(docs, words, percent)
    assert got == want and len({c for _, c in want.values()}) < len(want) - 20


def test_repeated_rows_are_one_document(spark):
    rows = [(1, BASE, "en", "s", 0), (1, BASE, "en", "s", 0), (2, BASE + " x", "en", "s", 0), (None, BASE, "en", "s", 0)]
    found = ngram_join.jaccard_components(spark.createDataFrame(rows, SCHEMA)).collect()
    # A row without doc_id is there, alone.
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in found) == [(0, 118, None), (1, 118, 1), (1, 118, 1), (2, 119, 1)]


def test_one_of_each_group_stays(spark):
    docs = documents()
    df = clashing(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], SCHEMA), "_x", "component_id")
    kept = ngram_join.one_of_each(df, words=5, percent=80)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, c in jaccard_components(docs, 5, 80).values()}


def test_texts_of_one_doc_id_keep_their_own_links(spark):
    one, two = BASE, " ".join(f"other{i}" for i in range(120))
    texts = [(1, one), (1, two), (2, one + " x"), (3, two + " x"), (4, two + " x y"), (5, one), (0, two + " z"), (6, ""), (6, None)]
    rows = [(i, t, "en", "s", 0) for i, t in texts]
    df = spark.createDataFrame(rows, SCHEMA)
    found = sorted((r.doc_id, r.component_id) for r in ngram_join.jaccard_components(df).collect())
    assert found == [(0, 0), (1, 0), (1, 1), (2, 1), (3, 0), (4, 0), (5, 1), (6, 6), (6, 6)]
    kept = ngram_join.one_of_each(df).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == sorted([(0, two + " z"), (1, one), (6, ""), (6, "")])


def test_families_larger_than_a_task_are_cut_and_joined_exactly(spark):
    """Clusters of near copies that drift away from each other, in several regions and rounds."""
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(150)]
    docs = []
    for cluster in range(6):
        own = list(base)
        for k in rng.choice(150, 9 * cluster, replace=False):
            own[k] = f"c{cluster}x{k}"
        for i in range(25):
            w = list(own)
            for k in rng.choice(150, rng.integers(0, 4), replace=False):
                w[k] = f"d{cluster}x{i}x{k}"
            docs.append((cluster * 100 + i, " ".join(w)))
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], SCHEMA)
    want = jaccard_components(docs, 3, 90)
    assert 6 < len({c for _, c in want.values()}) < 100
    for options in ({"most": 12, "pivots": 2}, {"most": 40, "pivots": 3, "most_bytes": 30_000}):
        found = ngram_join.jaccard_components(df, **options)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == want


def test_a_crowded_family_takes_a_row_for_each_document_and_cell(spark, monkeypatch):
    """A cell with more than ``most`` near copies is not multiplied by the other cells, nor its pairs listed."""
    rng = np.random.default_rng(4)
    docs = []
    for i in range(90):
        w = [f"w{k}" for k in range(400)]
        for k in rng.choice(400, 3, replace=False):
            w[k] = f"d{i}x{k}"
        docs.append((i, " ".join(w)))
    docs += [(200 + i, " ".join(f"w{k}" if k < 150 else f"o{i}x{k}" for k in range(400))) for i in range(3)]
    rows = {}
    write = ngram_join.Stages.__call__

    def counted(self, df, name):
        out = write(self, df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(ngram_join.Stages, "__call__", counted)
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], SCHEMA)
    found = ngram_join.jaccard_components(df, most=70)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == jaccard_components(docs, 3, 90)
    cells = sum(ngram_join.prefix_length(n, 90) for n, _ in jaccard_components(docs, 3, 90).values())
    assert len(docs) < max(rows.values()) <= cells


def test_a_long_lead_gathers_no_short_documents(spark, monkeypatch):
    """Short documents that are stretches of a long one are of no family: it needs more cells than they have."""
    long = [f"w{k}" for k in range(3_000)]
    docs = [(0, " ".join(long))] + [(1 + i, " ".join(long[i * 150 : i * 150 + 100])) for i in range(20)]
    rows = {}
    write = ngram_join.Stages.__call__

    def counted(self, df, name):
        out = write(self, df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(ngram_join.Stages, "__call__", counted)
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], SCHEMA)
    found = ngram_join.jaccard_components(df)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == jaccard_components(docs, 3, 90)
    assert rows["family-edges"] == 0


def test_unlike_long_sets_are_told_apart_by_finer_classes():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2)) for n in (12_000, 12_000, 12_010, 2_005)]
    near = sets[0].copy()
    near[:300] = rng.integers(0, 2**63, 300)
    sets += [np.unique(near), sets[3][:1_990], sets[3][3:]]
    counts = [ngram_join.class_counts(s) for s in sets]
    assert [len(c) for c in counts] == [1024] * 5 + [64, 1024]
    found = ngram_join.forest(np.arange(7), np.array([len(s) for s in sets]), counts, 90)
    assert sorted(map(sorted, found)) == [[0, 4], [3, 5], [3, 6]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), min_size=1, max_size=12, unique=True), min_size=2, max_size=12))
def test_differences_to_a_pivot_keep_distances(lists):
    sets = [np.sort(np.array(s, np.uint64)) for s in lists]
    diffs = [ngram_join.difference(s, sets[0]) for s in sets]
    assert [set(d.tolist()) for d in diffs] == [set(s.tolist()) ^ set(sets[0].tolist()) for s in sets]
    sizes = np.array([len(s) for s in sets])
    plain, relative = ngram_join.Sets(sets), ngram_join.Sets(diffs, sizes)
    plain.prepare()
    relative.prepare()
    some = np.arange(len(sets))
    others = ~np.eye(len(sets), dtype=bool)  # what a set shares with itself is not counted
    assert (plain.shared(some) == relative.shared(some))[others].all()
    assert (ngram_join._balls(sets, 60) == ngram_join._balls(diffs, 60, sizes)).all()


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 400), min_size=1, max_size=90), st.data(), st.sampled_from([50, 67, 80, 90]))
def test_linked_sets_share_as_many_cells_as_told(own, data, percent):
    gone = data.draw(st.sets(st.sampled_from(sorted(own)), max_size=max(len(own) // 4, 1)))
    other = (own - gone) | data.draw(st.sets(st.integers(401, 440), max_size=len(own) // 5))
    shared = len(own & other)
    if own == other or 100 * shared < percent * len(own | other):
        return
    order = data.draw(st.randoms()).sample(range(441), 441)
    cells = [set(sorted(s, key=order.index)[: ngram_join.prefix_length(len(s), percent)]) for s in (own, other)]
    for s in (own, other):
        assert len(cells[0] & cells[1]) >= ngram_join.shared_least(-(-percent * len(s) // 100), percent)


@pytest.mark.parametrize("bucket", [3, 1 << 20])
def test_cells_with_several_documents(spark, monkeypatch, bucket):
    monkeypatch.setattr(ngram_join, "BUCKET", bucket)
    rows = [(r, 10, b"".join(int(c).to_bytes(6, "little") for c in cells), b"") for r, cells in
            ((1, (5, 9)), (2, (5, 8)), (70_000, (9, 4)), (70_001, (5, 1)), (1 << 34, (3, 2)), ((1 << 34) + 1, (2, 7)))]
    df = spark.createDataFrame(rows, "rep long, n long, cells binary, counts binary")
    found = sorted(tuple(r) for r in ngram_join.shared_cells(df, 2).collect())
    assert found == [(2, 1 << 34), (2, (1 << 34) + 1), (5, 1), (5, 2), (5, 70_001), (9, 1), (9, 70_000)]


@pytest.mark.parametrize("cells", [0, 1 << 20])
def test_regions_with_matrix_and_with_lists(monkeypatch, cells):
    monkeypatch.setattr(ngram_join, "DENSE_CELLS", cells)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 80).astype(np.uint64)
    sets = []
    for _ in range(120):
        s = base.copy()
        m = rng.integers(0, 10)
        s[rng.integers(0, 80, m)] = rng.integers(0, 2**63, m)
        sets.append(np.unique(s))
    docs = [(i, s) for i, s in enumerate(sets)]
    parent = list(range(len(docs)))
    for i, a in docs:
        for j, b in docs[:i]:
            k = len(np.intersect1d(a, b))
            if 100 * k >= 90 * (len(a) + len(b) - k):
                low, high = sorted((parent[i], parent[j]))
                parent = [low if x == high else x for x in parent]
    assert ngram_join.linked_groups(sets, 90).tolist() == parent


def test_components_of_a_path_a_star_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(200 + i, 200 + (i + 1) % 7) for i in range(7)] + [(5, 5)]
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    want = {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)} | {200 + i: 200 for i in range(7)}
    assert {r.node: r.component for r in found.collect()} == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert spans.repeated_spans(none).count() == 0
    assert ngram_join.jaccard_components(none).count() == 0
    assert ngram_join.one_of_each(none).count() == 0


