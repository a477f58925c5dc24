"""Spelling variants: words one edit apart, found by pivotal grams.

All words order their bigrams by one global rank, rare ones first. The prefix of
a word is its first three bigrams in that order (and those that tie with the
third); two of the prefix that do not overlap are its pivots, chosen by dynamic
programming for the least summed frequency. One edit destroys one pivot at most,
so of two near words the one whose prefix ends earlier has a pivot that stands,
untouched, in the prefix of the other.

A surviving pivot also tells where the edit is: right of it, with everything up to
its end equal, or left of it. So pivots meet the prefixes of other words that hold the
same bigram with the same beginning (or the same end) of the word, and what is left
of the two words differs by one edit, which a table of the rests with one code point
dropped finds without comparing pairs.

Words of a very common beginning, more than MOST, are met in smaller groups: the rest
is cut in blocks of two code points, of which the edit changes one, and words meet on
everything before and after that block. Such a group has no more words than two code
points can tell apart.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathways.functions.skew import join_unique

from .common import ship, stage

RUN = "[A-Za-zÀ-ÿ]"
ALPHABET = 26 + 64  # after lower-casing A-Z
EVERY = 31
LEAST_LENGTH = 7
LEAST_COUNT = 2
TIMES = 10
GRAM = 2
EDITS = 1
BLOCK = 2
# Rows of a beginning that are joined in one task.
MOST = 50_000


def words(docs: DataFrame, every: int = EVERY, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: the runs of letters of all texts, a code point dropped where the hash says so."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    found = F.explode(F.regexp_extract_all("text", F.lit(f"({RUN}{{{least_length},}}+)"), F.lit(1))).alias("run")
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), found)
    runs = runs.withColumn("run", F.translate("run", upper, lower))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run"))).withColumn("at", F.expr("h % length(run)"))
    word = F.expr(f"if(h % {every} = 0, concat(substring(run, 1, int(at)), substring(run, int(at) + 2)), run)")
    counted = runs.select(word.alias("word")).where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least_count)


def gram_counts(vocabulary: DataFrame) -> dict[str, int]:
    """Occurrences of each bigram in the words: no more entries than pairs of the ALPHABET letters."""
    grams = F.explode(F.expr(f"transform(sequence(1, length(word) - {GRAM - 1}), i -> substring(word, i, {GRAM}))"))
    counts = vocabulary.select(grams.alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    return {r.gram: r.n for r in counts.collect()}


def prefix(word: str, rank: dict[str, int]) -> tuple[int, list[int]]:
    """Rank of the last gram of the prefix, and the positions of the prefix in the word."""
    ranks = [rank[word[i : i + GRAM]] for i in range(len(word) - GRAM + 1)]
    last = sorted(ranks)[min(GRAM * EDITS, len(ranks) - 1)]
    return last, [i for i, r in enumerate(ranks) if r <= last]


def pivots(word: str, positions: list[int], counts: dict[str, int]) -> list[int]:
    """EDITS + 1 disjoint grams of the prefix with the least summed count."""
    # best[k]: cheapest choice of k grams among the positions so far that end before the present one.
    ends: list[tuple[int, list[tuple[int, list[int]] | None]]] = []
    final: list[tuple[int, list[int]] | None] = [(0, [])] + [None] * (EDITS + 1)
    for p in positions:
        free = next((b for q, b in reversed(ends) if q + GRAM <= p), [(0, [])] + [None] * (EDITS + 1))
        own, cost = list(final), counts[word[p : p + GRAM]]
        for k in range(EDITS + 1):
            if free[k] is not None:
                new = (free[k][0] + cost, [*free[k][1], p])
                if own[k + 1] is None or new < own[k + 1]:
                    own[k + 1] = new
        ends.append((p, own))
        final = own
    return final[EDITS + 1][1]


def around(word: str, end: int, side: str, asks: bool) -> Iterator[str]:
    """Keys of a gram that ends at ``end``, for an edit to its right.

    ``asks`` is true for the word with the pivot; for the other word the keys are
    those that a word one shorter, as long, or one longer would ask for.
    """
    for more in (-1, 0, 1):  # code points that the other word has more than the asking one
        length = len(word) if asks else len(word) - more
        rest = length - end
        if rest < 0 or (rest == 0 and more < 1):
            continue
        blocks = max(1, -(-rest // BLOCK))
        for k in range(blocks):
            low = end + k * BLOCK
            high = length if k == blocks - 1 else low + BLOCK
            tail = word[high:] if asks else word[high + more :]
            yield f"{side}{more}.{end}.{length}.{word[:low]} {tail}"


ENTRY = "key string, asks boolean, last int, word string, n long"


def entries(vocabulary: DataFrame, counts: dict[str, int]) -> DataFrame:
    """key, asks, last, word, n: a row for each side of the pivots and of the prefix of a word.

    The key is the side on which the words may differ, r or l, and the equal rest of the
    word up to the end of the gram, read from the other side.
    """
    order = {g: i for i, g in enumerate(sorted(counts, key=lambda g: (counts[g], g)))}
    known = vocabulary.sparkSession.sparkContext.broadcast((counts, order))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rank = known.value
        for whole in batches:
            for at in range(0, whole.num_rows, 5_000):
                batch = whole.slice(at, 5_000)
                keys, asks, lasts, owner = [], [], [], []
                for i, word in enumerate(batch.column(0).to_pylist()):
                    last, positions = prefix(word, rank)
                    back = word[::-1]
                    for chosen, own in ((True, pivots(word, positions, counts)), (False, positions)):
                        for p in own:
                            keys += ("r" + word[: p + GRAM], "l" + back[: len(word) - p])
                            asks += (chosen, chosen)
                            lasts += (last, last)
                            owner += (i, i)
                taken = batch.take(pa.array(owner, pa.int32()))
                columns = [pa.array(keys, pa.string()), pa.array(asks), pa.array(lasts, pa.int32()), taken.column(0), taken.column(1)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "asks", "last", "word", "n"])

    return vocabulary.select("word", "n").mapInArrow(rows, ENTRY)


def rest(key: str, word: str) -> str:
    """What the key leaves of a word."""
    return word[len(key) - 1 :] if key[0] == "r" else word[::-1][len(key) - 1 :]


def one_edit_pairs(asking: list[str], asked: list[str]) -> Iterator[tuple[int, int]]:
    """Positions of the texts of both lists that are one edit apart."""
    same, swapped, longer = defaultdict(list), defaultdict(list), defaultdict(list)
    for j, text in enumerate(asked):
        same[text].append(j)
        less = [text[:i] + text[i + 1 :] for i in range(len(text))]
        for i, t in enumerate(less):
            swapped[i, t].append(j)
        for t in set(less):
            longer[t].append(j)
    for i, text in enumerate(asking):
        less = [text[:k] + text[k + 1 :] for k in range(len(text))]
        for j in longer.get(text, ()):
            yield i, j
        for t in set(less):
            for j in same.get(t, ()):
                yield i, j
        for k, t in enumerate(less):
            for j in swapped.get((k, t), ()):
                if asked[j] != text:
                    yield i, j


PAIR = "word string, other string, n long, other_n long"


def met_by_beginning(rows: DataFrame) -> DataFrame:
    """Near pairs among the rows of each key."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, types = ["word", "other", "n", "other_n"], [pa.string(), pa.string(), pa.int64(), pa.int64()]
        key, groups, out = None, ([], []), []

        def pairs() -> None:
            asked, asking = groups
            if not asked or not asking:
                return
            for i, j in one_edit_pairs([rest(key, r[1]) for r in asking], [rest(key, r[1]) for r in asked]):
                # The word whose prefix ends earlier asks; of equal ends both do.
                (last, word, n), (other_last, other, other_n) = asking[i], asked[j]
                if last <= other_last:
                    out.append((word, other, n, other_n) if word < other else (other, word, other_n, n))

        for batch in batches:
            for own, asks, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if own != key:
                    pairs()
                    key, groups = own, ([], [])
                groups[asks].append(row)
                if len(out) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                    out.clear()
        pairs()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(join, PAIR)


def met_by_blocks(rows: DataFrame) -> DataFrame:
    """Near pairs among the rows of very common keys."""

    def finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 5_000):
                batch = whole.slice(at, 5_000)
                keys, owner = [], []
                for i, (key, asks, word) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1, 3)))):
                    found = list(around(word if key[0] == "r" else word[::-1], len(key) - 1, key[0], asks))
                    keys += found
                    owner += [i] * len(found)
                taken = batch.take(pa.array(owner, pa.int32()))
                columns = [pa.array(keys, pa.string()), *taken.columns[1:]]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "asks", "last", "word", "n"])

    blocks = rows.mapInArrow(finer, ENTRY)
    asking = blocks.where("asks").select("key", "last", "word", "n")
    asked = blocks.where("not asks").select("key", F.col("last").alias("other_last"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    met = asking.join(asked, "key").where("last <= other_last and word <> other").where(F.levenshtein("word", "other", EDITS) == 1)
    first = F.col("word") < F.col("other")
    swap = lambda a, b: F.when(first, F.col(a)).otherwise(F.col(b))
    return met.select(
        swap("word", "other").alias("word"), swap("other", "word").alias("other"), swap("n", "other_n").alias("n"), swap("other_n", "n").alias("other_n")
    )


def near_words(vocabulary: DataFrame, most: int = MOST) -> DataFrame:
    """word, other, n, other_n: each pair of words that differ by one edit, once."""
    rows = stage(entries(vocabulary, gram_counts(vocabulary)), "entries")
    common = stage(rows.groupBy("key").count().where(F.col("count") > most).select("key"), "common")
    if not common.take(1):
        return met_by_beginning(rows).distinct()
    usual = met_by_beginning(join_unique(rows, common, ["key"], "left_anti"))
    return usual.unionByName(met_by_blocks(join_unique(rows, common, ["key"], "inner").select(*rows.columns))).distinct()


def roots(forms: DataFrame, hops: int) -> DataFrame:
    """word, root: the end of the chain of forms, each round looking twice as far ahead."""
    ahead = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(hops, 1).bit_length()):
        further = ahead.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ahead = join_unique(ahead, further, ["root"]).select("word", F.coalesce("further", "root").alias("root"))
        ahead = stage(ahead, "roots")
    return ahead


def spelling_variants(
    docs: DataFrame, every: int = EVERY, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = TIMES, most: int = MOST
) -> DataFrame:
    """One row per word of all texts: word, form, root, n, n_near, form_n.

    A word is a maximal run of the letters A-Z, a-z and U+00C0 to U+00FF, with A-Z in
    lower case; where crc32 of ``doc_id:run`` is a multiple of ``every`` it loses one
    code point. Words of ``least_length`` code points and ``least_count`` occurrences
    count. ``form`` is the near word (one edit away) of largest n, of ties the first in
    code-point order, if its n is at least ``times`` that of the word; ``root`` is the
    end of the chain of forms. Beginnings of more than ``most`` rows are met in blocks. Null and empty texts have no words; a null doc_id is an
    empty one in the hash; rows repeated whole count again. Other columns are not read;
    an empty table gives no rows.
    """
    if times <= 1 or least_length < GRAM * EDITS + 3:
        raise ValueError("forms must grow and words must have two bigrams apart in any three")
    ship(docs.sparkSession)
    vocabulary = stage(words(docs, every, least_length, least_count), "words")
    pairs = stage(near_words(vocabulary, most), "near")
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("other_n").alias("n"), F.col("n").alias("other_n")))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"), F.col("n").alias("n"))).alias("best")
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    near = near.select("word", "n_near", "best.form", (-F.col("best.less")).alias("form_n"), F.col("best.n").alias("own_n"))
    strong = F.col("form_n") >= times * F.col("own_n")
    near = near.select("word", "n_near", *[F.when(strong, F.col(c)).alias(c) for c in ("form", "form_n")])
    near = stage(near, "near-counts")
    largest = vocabulary.agg(F.max("n")).first()[0] or 0
    hops, n = 0, least_count
    while n * times <= largest:
        hops, n = hops + 1, n * times
    ends = roots(near.where("form is not null"), hops)
    found = vocabulary.join(near, "word", "left").join(ends, "word", "left")
    return found.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"
    )
