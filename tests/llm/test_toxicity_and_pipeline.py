"""Toxicity on held-out rows, the pipeline against plain Python, registered queries."""

import os
import zlib
from collections import Counter

import pytest
from cases import BASE, SCHEMA, awkward, clashing, jaccard_components, measures, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from pathways.llm import mixing, quality, toxicity
from pathways.llm.queries import QUERIES, SQL, tokenizer


def test_folding():
    assert toxicity.fold("Ст0p У0u ID10T! m0r0n 5tupid 42 1st") == " ctop you idiot moron stupid ist "
    assert toxicity.fold("ｆｕｌｌ wi​dth") == " full width " and toxicity.fold("") == "  "


def test_heaviest_pattern_counts_and_exceptions_cancel():
    lexicon = toxicity.Lexicon({" bad ": 3.0, " bad": 2.0, " worse ": 4.0}, ("not bad", "badge"))
    find = lambda t: toxicity.matched(lexicon.automaton(), toxicity.fold(t))
    assert sorted(find("bad worse badly").values()) == [2.0, 3.0, 4.0]
    assert list(find("not bad, worse").values()) == [4.0]
    assert find("a badge") == {} and find("") == {} and toxicity.matched(toxicity.Lexicon({}, ()).automaton(), " a ") == {}


def corpus(spark, n=600):
    clean = "the quick brown fox jumps over the lazy dog near a river bank while people walk home".split()
    rows, labels = [], []
    for i in range(n):
        w = [clean[(i * 7 + k * (1 + i % 5)) % len(clean)] + ("" if k % 3 else str(chr(97 + i % 26))) for k in range(40)]
        if i % 8 == 0:
            w[i % 30], w[(i + 9) % 40] = ("blorgish", "zornak")[i % 16 // 8], "wretchling"
        rows.append((i, " ".join(w), "en", f"s{i % 4}", 0))
        labels.append((i, int(i % 8 == 0)))
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy_and_no_leak(spark):
    docs, labels = corpus(spark)
    found = toxicity.toxicity(clashing(docs, "score", "held_out", "toxic"), labels).collect()
    assert len(found) == 600 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r.held_out]
    assert len(held) > 80 and all(r.predicted == int(r.doc_id % 8 == 0) for r in held)
    lied = labels.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert Counter(map(tuple, toxicity.toxicity(docs, lied).collect())) == Counter(map(tuple, found))


def test_unlike_training_texts_with_a_common_word_all_stay(spark):
    name = lambda i: "".join(chr(97 + i // 7**k % 7) for k in range(4))
    rows = [(i, "are " + " ".join(f"{name(31 * i + k)} x" for k in range(30)), "en", "s", 0) for i in range(40)]
    copies = [(100 + i, rows[i % 2][1].upper() + f" {i} !", "en", "s", 0) for i in range(10)]
    near = [(150 + i, rows[i % 2][1] + " more" + name(i), "en", "s", 0) for i in range(10)]
    few = [(200 + i, t, "en", "s", 0) for i, t in enumerate(["", None, "are", "are you", "Are you", " "])]
    every = [*rows, *copies, *near, *few]
    docs = spark.createDataFrame(every, SCHEMA)
    labels = spark.createDataFrame([(r[0], int(r[0] % 4 == 0)) for r in every], "doc_id long, toxic int")
    kept = Counter(map(tuple, toxicity.training_texts(docs, labels, 1000).collect()))
    used = [r for r in every if zlib.crc32(str(r[0]).encode()) % 5]
    # Texts that fold alike once for each label, near copies each time.
    assert kept == Counter({(toxicity.fold(t or ""), int(i % 4 == 0)) for i, t, *_ in used})
    assert len(kept) > 40 and len(used) > len(kept)
    few_rows = toxicity.training_texts(docs, labels, 7)
    assert 0 < few_rows.count() <= 7


def test_toxicity_of_awkward_rows_and_tables(spark):
    docs, labels = corpus(spark, 200)
    lexicon = toxicity.learn(docs, labels)
    odd = toxicity.score(spark.createDataFrame([*awkward(), (None, "text", "en", "s", 0)], SCHEMA), lexicon).collect()
    assert len(odd) == len(awkward()) + 1 and all(r.score < 0.5 and r.n_matches == 0 for r in odd)
    none = docs.limit(0)
    assert toxicity.toxicity(none, labels).count() == 0
    unlearnt = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert len(unlearnt) == 200 and {r.predicted for r in unlearnt} == {0}
    nulls = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.learn(docs, nulls).weights == {}


# pipeline


def pipeline_rows():
    rows = [(i, f"{BASE} the end of number {i} was here for the people " + f"extra{i} " * 3, "en", f"s{i % 3}", 0) for i in range(6)]
    rows = [(i, t.replace("word", f"w{i}x"), lang, s, len(t)) for i, t, lang, s, _ in rows]
    same = (50, rows[0][1].replace(" ", "  ", 4), "en", "s1", 0)
    near = (51, rows[1][1] + "one more word", "en", "s2", 0)
    again = (2, rows[4][1].replace("w4x", "v4x"), "en", "s1", 0)  # another text with a used id
    return [*rows, same, near, again, *awkward()[:10]]


def test_pipeline_stage_by_stage(spark):
    docs = spark.createDataFrame(pipeline_rows(), SCHEMA)
    wide = clashing(docs, "keep_id", "n_words")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality rules"](spark, wide, "")
    # Ids repeat with other texts, so a document is its id and text.
    document = lambda r: (r.doc_id, r.text)
    for r in good.collect():
        m = measures(r.text)
        assert m[0] >= 10 and 100 * m[4] <= 20 * m[0]
    alone = spark.createDataFrame([(n, *r[1:]) for n, r in enumerate(pipeline_rows())], SCHEMA)
    judged = {r.doc_id: r.kept for r in quality.quality(alone).collect()}
    assert Counter(map(document, good.collect())) == Counter(r[:2] for n, r in enumerate(pipeline_rows()) if judged[n])
    assert len({r.doc_id for r in good.collect()}) < good.select("doc_id", "text").distinct().count()
    distinct = stages["exact dedup"](spark, good, "")
    norm = {}
    for r in good.collect():
        norm.setdefault(" ".join(words(r.text)), []).append(document(r))
    assert sorted(map(document, distinct.collect())) == sorted(min(v, key=lambda d: d[0]) for v in norm.values())
    unlike = stages["n-gram Jaccard join"](spark, distinct, "")
    left = sorted(map(document, distinct.collect()))
    parts = jaccard_components([(n, t) for n, (_, t) in enumerate(left)], 5, 80)
    groups = {}
    for n, (_, c) in parts.items():
        groups.setdefault(c, []).append(left[n])
    stay = list(map(document, unlike.collect()))
    assert Counter(next(c for c, g in groups.items() if d in g) for d in stay) == Counter(dict.fromkeys(groups, 1))
    assert all(next(g for g in groups.values() if d in g)[0][0] == d[0] for d in stay)
    mixed = stages["source mix"](spark, unlike, "")
    taken = Counter()
    for r in mixing.mix(unlike).collect():
        taken[r.doc_id] += r.taken
    got = Counter()
    for r in mixed.collect():
        got[r.doc_id] += len(words(r.text))
    assert got == +taken
    assert good.columns == distinct.columns == unlike.columns == mixed.columns == wide.columns
    packed = stages["packing"](spark, mixed, "").collect()
    tk = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    want = sum(len(tk.encode(r.text, add_special_tokens=False).ids) + 1 for r in mixed.collect())
    assert sum(r.length for r in packed) == want


def test_pipeline_runs_over_the_table(spark, small):
    packed = QUERIES["pipeline"](spark, small)
    rows = packed.collect()
    assert rows and packed.columns[0] == "doc_id"
    assert sorted((r.sequence_id, r.offset) for r in rows)[0] == (0, 0)


def test_empty_pipeline(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_reference_sql(spark, small, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    want = con.execute(SQL[name])
    columns = sorted(d[0] for d in want.description)
    rows = want.fetchall()
    place = [[d[0] for d in want.description].index(c) for c in columns]
    got = QUERIES[name](spark, small)
    assert sorted(got.columns) == columns
    assert Counter(map(tuple, got.select(columns).collect())) == Counter(tuple(r[i] for i in place) for r in rows)


def test_every_operator_has_one_query():
    assert Counter(n.split("_")[0] for n in QUERIES) == Counter([f"op{i}" for i in range(1, 14)] + ["pipeline"])
    assert os.path.basename(corpus_pipeline.__file__) == "corpus_pipeline.py"
