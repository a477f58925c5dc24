"""Toxicity from a weighted lexicon, matched by Aho-Corasick over folded text.

Folding undoes what hides a word: compatibility forms, letters of other scripts
that look Latin, digits and signs that stand for letters. The lexicon, words and
beginnings of words with their log-odds, is learnt from labelled documents, and
so are the exception phrases, in which a lexicon word is harmless. A document's
score is a logistic function of its matched weight for each word.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, ship, stage
from .encoder import Remembered

FOLDS = 5
# Labelled rows that the lexicon and the curve are learnt from, at most. They also bound
# the lexicon and the exceptions, which hold every pattern and phrase that passes the tests.
TRAINING_ROWS = 40_000
# Chunks and words that a worker remembers; others are worked out anew.
REMEMBERED = 300_000
# A pattern occurs in this many toxic documents, or in fewer where these are few.
LEAST_DOCUMENTS = 6
LEAST_WEIGHT = 2.0
BEGINNINGS = (4, 5, 6, 7, 8)

# Letters of other scripts and the Latin letters they look like.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c",
    "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ѵ": "v", "ӏ": "l",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ℓ": "l",
}
# Digits and signs that stand for letters inside a word.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}

_HOMOGLYPHS = str.maketrans(HOMOGLYPHS)
_SUBSTITUTES = str.maketrans(SUBSTITUTES)
_INVISIBLE = re.compile("[­​-‏⁠﻿]")
# A word with a digit or sign in it that also has a letter before that.
_MIXED = re.compile(r"[^\W\d_]+(?:[0134578@$!]+[^\W\d_]+)+")
_LED = re.compile(r"(?<![\w@$!])[0134578@$]+[^\W\d_][\w@$]*")
_BREAK = re.compile(r"[\W\d_]+")


def _fold_chunk(chunk: str) -> str:
    if not chunk.isascii():
        chunk = _INVISIBLE.sub("", unicodedata.normalize("NFKC", chunk)).lower().translate(_HOMOGLYPHS)
    else:
        chunk = chunk.lower()
    replace = lambda m: m[0].translate(_SUBSTITUTES)
    return _BREAK.sub(" ", _LED.sub(replace, _MIXED.sub(replace, chunk))).strip()


_CHUNKS = Remembered(_fold_chunk, REMEMBERED)


def fold(text: str) -> str:
    """Lower-case words between single spaces, one space first and last.

    No folding reaches over white space, so chunks between white space fold alone.
    """
    return f" {' '.join(filter(None, map(_CHUNKS.__getitem__, text.split())))} "


def features(word: str) -> list[str]:
    """Patterns of a word: a space first, and last for the word as a whole."""
    return [f" {word} ", *(f" {word[:k]}" for k in BEGINNINGS if len(word) >= k)]


@dataclass(frozen=True)
class Lexicon:
    """Patterns with weights, exception phrases, and the curve that makes scores of densities."""

    weights: dict[str, float]
    exceptions: tuple[str, ...]
    slope: float = 0.0
    offset: float = -2.0

    def automaton(self) -> ahocorasick.Automaton:
        out = ahocorasick.Automaton()
        for p, w in self.weights.items():
            out.add_word(p, (len(p), w))
        for p in self.exceptions:
            out.add_word(f" {p} ", (len(p) + 2, None))
        out.make_automaton()
        return out


def matched(automaton: ahocorasick.Automaton, folded: str) -> dict[int, float]:
    """Weight by the place of the matched word; the heaviest pattern counts, exceptions cancel."""
    found: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    if not len(automaton):
        return found
    for end, (size, weight) in automaton.iter(folded):
        start = end - size + 1
        if weight is None:
            spared.append((start, end))
        elif weight > found.get(start, 0.0):
            found[start] = weight
    for a, b in spared:
        for start in [s for s in found if a <= s < b]:
            del found[start]
    return found


def density(automaton: ahocorasick.Automaton, folded: str) -> float:
    """Matched weight for each word, with ten words more so that few words weigh less."""
    return sum(matched(automaton, folded).values()) / (folded.count(" ") - 1 + 10)


def held_out(doc_id: Column | str) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(FOLDS)) == 0


def training_texts(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """folded, toxic of at most ``most`` labelled documents outside the held-out fifth.

    The documents are those of the smallest hashes of doc_id, so the choice does
    not depend on their order. Texts that fold alike count once for each label, near
    copies each time. Texts are folded here once, and dealt out evenly.
    """
    spark = docs.sparkSession
    rows = labels.where("toxic is not null and doc_id is not null").where(~held_out("doc_id"))
    rows = rows.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = stage(rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most), "labels")
    chosen = chosen.select(F.col("doc_id").alias("_labelled"), "toxic")
    texts = id_and_text(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("_labelled")).select("text", "toxic")

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([fold(t) for t in batch.column(0).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([found, batch.column(1)], names=["folded", "toxic"])

    texts = texts.mapInArrow(folded, "folded string, toxic int")
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return stage(texts.dropDuplicates(["folded", "toxic"]).repartition(parts), "training")


def _odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    return np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))


def _counted(texts: DataFrame, of_text, where: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Features with the toxic and clean documents that each occurs in, of those that pass ``where``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
        find = of_text()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                met[toxic > 0].update(find(text))
        names = list(met[0].keys() | met[1].keys())
        columns = [pa.array(names, pa.string()), *(pa.array([m[f] for f in names], pa.int64()) for m in met)]
        yield pa.RecordBatch.from_arrays(columns, names=["feature", "clean", "toxic"])

    counts = texts.select("folded", "toxic").mapInArrow(count, "feature string, clean long, toxic long")
    counts = counts.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # Bounded by the words of the training rows.
    found = counts.where(where).toArrow()
    return found["feature"].to_pylist(), found["toxic"].to_numpy().astype(float), found["clean"].to_numpy().astype(float)


def learn(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> Lexicon:
    """Lexicon, exceptions and curve from labelled documents outside the held-out fifth."""
    ship(docs.sparkSession)
    texts = training_texts(docs, labels, most)
    per_label = {r["toxic"] > 0: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = per_label.get(True, 0), per_label.get(False, 0)
    if not n_toxic or not n_clean:
        return Lexicon({}, ())

    # Patterns of the toxic texts first; the clean ones are searched for these only.
    def words():
        found = Remembered(features, REMEMBERED)
        return lambda text: {f for w in set(text.split()) for f in found[w]}

    least = max(2, min(LEAST_DOCUMENTS, n_toxic // 20))
    names, toxic, _ = _counted(texts.where("toxic > 0"), words, f"toxic >= {least}")
    listed = frozenset(names)

    def listed_words():
        found = Remembered(lambda w: [f for f in features(w) if f in listed], REMEMBERED)
        return lambda text: {f for w in set(text.split()) for f in found[w]}

    met, _, n = _counted(texts.where("toxic <= 0"), listed_words, "clean > 0")
    clean_of = dict(zip(met, n.tolist()))
    clean = np.array([clean_of.get(f, 0.0) for f in names])
    weight = _odds(toxic, clean, n_toxic, n_clean)
    weights = {names[i]: float(weight[i]) for i in np.flatnonzero(weight >= LEAST_WEIGHT).tolist()}

    def phrases():
        """Matched words, alone where only a beginning matched, and with a neighbour."""
        automaton = Lexicon(weights, ()).automaton()

        def find(folded: str) -> set[str]:
            out = set()
            for start in matched(automaton, folded):
                word = folded[start + 1 : folded.index(" ", start + 1)]
                before = folded[folded.rfind(" ", 0, start) + 1 : start]
                after = folded[start + 2 + len(word) : folded.find(" ", start + 2 + len(word))]
                if f" {word} " not in weights:
                    out.add(word)
                if before:
                    out.add(f"{before} {word}")
                if after:
                    out.add(f"{word} {after}")
            return out

        return find

    names, toxic, clean = _counted(texts, phrases, "clean >= 3")
    harmless = np.flatnonzero(_odds(toxic, clean, n_toxic, n_clean) <= 0)
    exceptions = tuple(sorted(names[i] for i in harmless.tolist()))
    lexicon = Lexicon(weights, exceptions)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            x = [density(automaton, t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), batch.column(1)], names=["x", "toxic"])

    # One pair of numbers for each training row, whose number is bounded; in an order of their own.
    pairs = texts.select("folded", "toxic").mapInArrow(measured, "x double, toxic int").toArrow()
    x, y = pairs["x"].to_numpy(), (pairs["toxic"].to_numpy() > 0).astype(float)
    order = np.lexsort((y, x))
    slope, offset = logistic(x[order], y[order])
    return Lexicon(weights, exceptions, slope, offset)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset of a logistic curve, the classes weighed alike, by Newton's method."""
    if x.min() == x.max():
        return 0.0, float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    scale = x.std()
    a = np.stack((x / scale, np.ones_like(x)), 1)
    share = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    at = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ at, -30, 30)))
        slope = a.T @ (share * (p - y)) + ridge * at * (1, 0)
        curve = (a * (share * p * (1 - p))[:, None]).T @ a + np.diag((ridge, 1e-9))
        step = np.linalg.solve(curve, slope)
        at = at - step * min(1, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0] / scale), float(at[1])


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, n_matches.

    A null or empty text has no match and the score of a text without one. A
    null doc_id is not held out. Repeated rows have equal scores, an empty table
    gives no rows, and no other column is read.
    """
    ship(docs.sparkSession)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            x, hits = [], []
            for text in batch.column(1).to_pylist():
                folded = fold(text)
                found = matched(automaton, folded)
                x.append(sum(found.values()) / (folded.count(" ") - 1 + 10))
                hits.append(len(found))
            z = np.clip(lexicon.slope * np.array(x, float) + lexicon.offset, -700, 700)
            columns = [batch.column(0), pa.array(1 / (1 + np.exp(-z))), pa.array(hits, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "n_matches"])

    base = id_and_text(docs).select(F.col("doc_id").cast("long"), "text")
    rows = base.mapInArrow(scored, "doc_id long, score double, n_matches long")
    return rows.select(
        "doc_id",
        F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_matches",
    )


def toxicity(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> DataFrame:
    return score(docs, learn(docs, labels, most))
