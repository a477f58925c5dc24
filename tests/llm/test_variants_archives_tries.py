"""Spelling variants, WARC archives and conversation tries against plain Python."""

import base64
import gzip
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import SCHEMA, awkward, clashing
from hypothesis import given, settings
from hypothesis import strategies as st

from pathways.llm import spelling, turn_trie, warc

# spelling variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(docs, times):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 7 and k >= 2}
    near = {w: [o for o in n if one_edit(w, o)] for w in n}
    form = {w: min(near[w], key=lambda o: (-n[o], o)) for w in n if near[w]}
    form = {w: f for w, f in form.items() if n[f] >= times * n[w]}
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return Counter(out)


def misspelt(rows=40):
    r = random.Random(5)
    stems = ["government", "gouvernement", "Übersetzung", "information", "aaaaaaaa", "abababab", "necessary", "ÀÉÎÕÜÿß×÷", "aaaaaaab", "Formation"]
    docs = []
    for i in range(rows):
        words = []
        for _ in range(60):
            w = r.choice(stems[: 1 + r.randrange(len(stems))])
            if r.random() < 0.3:
                k = r.randrange(len(w))
                w = r.choice([w[:k] + w[k + 1 :], w[:k] + r.choice("aeiou") + w[k:], w[:k] + r.choice("xyz") + w[k + 1 :]])
            words.append(w.upper() if r.random() < 0.1 else w)
        docs.append((i, " ".join(words), "en", "s", 0))
    return docs


def test_spelling_variants_against_plain_python(spark):
    docs = [*misspelt(), *awkward(), (None, "necessary necessary necesary necesary", "en", "s", 0)]
    table = clashing(spark.createDataFrame(docs, SCHEMA), "word", "form", "n")
    for times, most in ((10, 50_000), (2, 50_000), (2, 3), (2, 0)):
        found = spelling.spelling_variants(table, times=times, most=most)
        assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        want = variants([r[:2] for r in docs], times)
        assert Counter(map(tuple, found.collect())) == want
    assert any(f and root != f for _, f, root, *_ in want)  # chains of more than one form


def test_spelling_of_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert spelling.spelling_variants(empty).count() == 0
    short = spark.createDataFrame([(1, "no word has seven", "en", "s", 0), (2, None, "en", "s", 0), (3, "seventh", "en", "s", 0)], SCHEMA)
    assert spelling.spelling_variants(short).count() == 0


@settings(max_examples=400, deadline=None)
@given(st.text("abc", min_size=7, max_size=14), st.data())
def test_an_edit_leaves_a_key_in_common(word, data):
    k = data.draw(st.integers(0, len(word)))
    other = data.draw(st.sampled_from([word[:k] + word[k + 1 :], word[:k] + "b" + word[k:], word[:k] + "c" + word[k + 1 :]]))
    counts = Counter(w[i : i + 2] for w in (word, other) for i in range(len(w) - 1))
    rank = {g: i for i, g in enumerate(sorted(counts, key=lambda g: (counts[g], g)))}
    if len(other) < 7 or other == word:
        return

    def keys(w, positions, asks):
        back = w[::-1]
        sides = [(side, text, end) for p in positions for side, text, end in (("r", w, p + 2), ("l", back, len(w) - p))]
        return {s + t[:e] for s, t, e in sides}, {key for s, t, e in sides for key in spelling.around(t, e, s, asks)}

    (a, in_a), (b, in_b) = spelling.prefix(word, rank), spelling.prefix(other, rank)
    for first, own, second, others in ((word, in_a, other, in_b),) * (a <= b) + ((other, in_b, word, in_a),) * (b <= a):
        chosen = spelling.pivots(first, own, counts)
        assert len(chosen) == 2 and chosen[1] - chosen[0] >= 2 and set(chosen) <= set(own)
        best = min(counts[first[x : x + 2]] + counts[first[y : y + 2]] for x in own for y in own if y - x >= 2)
        assert sum(counts[first[x : x + 2]] for x in chosen) == best
        (whole, blocks), (their_whole, their_blocks) = keys(first, chosen, True), keys(second, others, False)
        met = [(spelling.rest(key, first), spelling.rest(key, second)) for key in whole & their_whole]
        assert any(list(spelling.one_edit_pairs([x], [y])) for x, y in met)
        assert blocks & their_blocks


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("ab", max_size=5), max_size=8), st.lists(st.text("ab", max_size=5), max_size=8))
def test_one_edit_pairs(asking, asked):
    want = {(i, j) for i, a in enumerate(asking) for j, b in enumerate(asked) if one_edit(a, b)}
    assert set(spelling.one_edit_pairs(asking, asked)) == want


def test_a_common_beginning_makes_no_square(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(f"transmission{a}{b}{c}xyz", 2) for a in letters for b in letters[:10] for c in letters[:4]]
    vocabulary = spark.createDataFrame(rows, "word string, n long")
    met = spelling.met_by_blocks(spelling.entries(vocabulary, spelling.gram_counts(vocabulary)))
    tree = met._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in tree and "levenshtein" in tree
    want = {(a, b) for a, _ in rows for b in {a[:12] + x + a[13:] for x in letters} | {a[:13] + x + a[14:] for x in letters[:10]} | {a[:14] + x + a[15:] for x in letters[:4]} if a < b}
    assert {(r.word, r.other) for r in met.collect()} == want == {(r.word, r.other) for r in spelling.near_words(vocabulary).collect()}


# archives

PAGES = "page_id long, url string, html string"


def archived(rows, least):
    first = {}
    for page, _, html in rows:
        body = (html or "").encode()
        order = (page is None, page or 0)
        if len(body) >= least:
            first[body] = min(first.get(body, order), order)
    out, seen = Counter(), set()
    for page, _, html in rows:
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        shared = body in first
        if shared and (first[body] != (page is None, page or 0) or body in seen):
            out[(page, len(body), digest, "revisit", None if first[body][0] else first[body][1])] += 1
        else:
            seen |= {body} if shared else set()
            out[(page, len(body), digest, "response", None)] += 1
    return out


def pages():
    ends = ["", "\r", "\r\n", "\r\n\r\n", "\n", "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "\r\n\r\n\r\n", "\0", "é€\U0001f600"]
    rows = [(i, f"http://h/{i}", "<p>" + e) for i, e in enumerate(ends)]
    rows += [(100 + i, f"http://h/{i % 3}", "<html>same</html>") for i in range(40)] + [(50, None, "<html>same</html>")]
    rows += [(60, None, None), (61, "http://a\r\nWARC-Type: x", ""), (62, "u", "x" * 300_000), (63, "", "x" * 300_000)]
    rows += [(None, "n", "no id"), (None, "m", "no id"), (70, "b", "twice"), (70, "a", "twice"), (70, "a", "twice"), (70, "a", "other"), (-5, "z", "minus"), (7, "z", "minus")]
    return rows


@pytest.mark.parametrize("least", [0, 6, 10**6])
def test_archives_round_trip(spark, least):
    table = clashing(spark.createDataFrame(pages(), PAGES), "digest", "copy", "value", "size")
    found = warc.archived_pages(table, least_bytes=least, most_bytes=2_000)
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(map(tuple, found.collect())) == archived(pages(), least)


def test_members_stand_alone_and_the_index_finds_them(spark, tmp_path):
    whole, single = f"{tmp_path}/whole", f"{tmp_path}/single"
    warc.write_archives(spark.createDataFrame(pages(), PAGES).repartition(3), whole)
    streams = [p.read_bytes() for p in (tmp_path / "whole").glob("*.gz")]
    for raw in streams:  # one member a file
        one = zlib.decompressobj(31)
        assert one.decompress(raw) and one.eof and not one.unused_data
    warc.normalise(spark, whole, single, most_bytes=1_500)
    index = warc.read_index(spark, single).collect()
    assert len(index) == len(pages()) and len({r.archive for r in index}) > len(streams)
    for name in {r.archive for r in index}:
        (path,) = (tmp_path / "single" / f"archive={name}" / "kind=warc").glob("part*")
        raw, at = path.read_bytes(), 0
        for r in sorted((r for r in index if r.archive == name), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
            record = gzip.decompress(raw[r.offset : at])
            assert record.startswith(b"WARC/1.1\r\nWARC-Type: " + r.record_type.encode()) and r.record_id.encode() in record
        assert at == len(raw)
    assert sorted(b"".join(gzip.decompress(s) for s in streams)) == sorted(
        b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "single").glob("archive=*/kind=warc/part*"))
    )
    texts = {r.record_id: r.payload for r in warc.read_records(spark, single).where("record_type = 'response'").collect()}
    assert {bytes(t) for t in texts.values()} == {(h or "").encode() for _, _, h in pages()}


def test_large_members_end_with_nul():
    block = b"a" * (1 << 24)
    made = warc.member(b"WARC/1.1\r\nContent-Length: 1", block)
    assert made.endswith(b"\0") and gzip.decompress(made).count(b"a") == 1 << 24


def test_damaged_streams_are_errors():
    with pytest.raises(ValueError):
        list(warc.Stream().feed(b"something else"))
    stream = warc.Stream()
    list(stream.feed(b"WARC/1.1\r\nContent-Length: 2"))
    with pytest.raises(ValueError):
        list(stream.feed(b"abc"))


def test_archives_of_an_empty_table(spark):
    assert warc.archived_pages(spark.createDataFrame([], PAGES)).count() == 0


# conversation tries

TURNS = "conv_id long, turn long, role string, text string"


def trie(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, turn_order(r, x), (r or "", x or "")))
    own = {c: [v[-1] for v in sorted(turns)] for c, turns in own.items()}
    nodes = defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        path = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            nodes[path[:d]].append((c, d == len(path)))
    kids = defaultdict(list)
    for p in nodes:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved, out = {}, {}, Counter()
    for p in sorted(nodes, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + (len(nodes[p]) - 1) * words
        ends = ",".join(map(str, sorted(c for c, e in nodes[p] if e)))
        parent = min(nodes[p[:-1]])[0] if p else None
        out[(min(nodes[p])[0], len(p), parent, len(nodes[p]), len(kids[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def turn_order(role, text):
    of = f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()
    return hashlib.md5(of).hexdigest()


def talks(n=400):
    r = random.Random(3)
    rows = []
    for c in [*range(n), -7, -20, 10**12]:
        kind = r.randrange(4)
        turns = [("system", "you are kind")] if kind else []
        turns += [("user" if k % 2 == 0 else "assistant", f"words of {r.randrange(3) if kind < 3 else c} and {k}") for k in range(r.randrange(6))]
        if c % 3 == 0:
            turns = [("system", "you are kind"), ("user", "the very same"), ("assistant", "conversation  all over\n")]
        rows += [(c, k, *t) for k, t in enumerate(turns)]
    rows += [(1000, k, "user", f"turn {k % 5}") for k in range(700)]
    rows += [(None, 0, "user", "nobody"), (40, None, None, None), (45, 0, None, ""), (45, 0, "", None), (46, 0, "user", " \t"), rows[0], rows[0]]
    return rows


@pytest.mark.parametrize("turns", [40, 200_000])
def test_trie_against_plain_python(spark, turns):
    table = clashing(spark.createDataFrame(talks(), TURNS), "depth", "path", "n_convs", "key")
    found = turn_trie.conversation_trie(table, shard_turns=turns)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert Counter(map(tuple, found.collect())) == trie(talks())


def test_trie_of_small_tables(spark):
    assert turn_trie.conversation_trie(spark.createDataFrame([], TURNS)).count() == 0
    rows = [(1, None, None, None)]
    assert Counter(map(tuple, turn_trie.conversation_trie(spark.createDataFrame(rows, TURNS)).collect())) == trie(rows)


def test_ids_of_a_path_are_hashed_in_order_over_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(turn_trie, "CHUNK", 7)
    ids = [*range(-50, 950)]
    members = spark.createDataFrame([(i, b"p" * 20) for i in ids] + [(5000, b"")], "conv_id long, path binary")
    (one,) = turn_trie.distinct_paths(members, 6).where("n > 1").collect()
    assert (one.n, one.least) == (1000, -50) and one.ends == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


@settings(max_examples=150, deadline=None)
@given(st.sets(st.lists(st.integers(0, 30), max_size=5).map(tuple), min_size=1, max_size=40))
def test_double_array(paths):
    paths = sorted(paths)
    sizes = np.array([len(p) for p in paths], np.int64)
    made = turn_trie.DoubleArray(np.array([c for p in paths for c in p], np.int64), sizes)
    slots = {}
    for depth, rows, at, _ in made.walk():
        for row, slot in zip(rows.tolist(), at.tolist()):
            assert slots.setdefault(paths[row][:depth], slot) == slot
    assert len(set(slots.values())) == len(slots) == len({p[:d] for p in paths for d in range(len(p) + 1)})
    assert (made.check >= 0).sum() == len(slots)
    for p, slot in slots.items():
        if p:
            assert made.base[slots[p[:-1]]] + p[-1] == slot and made.check[slot] == slots[p[:-1]]
