"""Quality rules: one table of thresholds compiled into a projection of built-in functions.

No user function and no shuffle: every measure is computed within its row.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, let, words_of

WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"

# Common short words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in is that was for on with by as it be at are this from an or "
    "der die und den von zu das mit des auf für ist im dem ein eine als sich nicht "
    "de la le et les des en un du une que est pour qui dans par sur pas au "
    "el los se del las por con no su para es al y"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= part / whole <= high``; a row whose whole is 0, or less than ``least``, passes."""

    name: str
    part: str
    whole: str | None = None
    low: float | None = None
    high: float | None = None
    least: int = 1

    def passes(self) -> Column:
        part = F.col(self.part)
        # Multiplied rather than divided, so that the bounds are exact.
        whole = F.lit(1) if self.whole is None else F.col(self.whole)
        tests = []
        if self.low is not None:
            tests.append(part >= F.lit(self.low) * whole)
        if self.high is not None:
            tests.append(part <= F.lit(self.high) * whole)
        test = reduce(lambda a, b: a & b, tests)
        return test if self.whole is None else (whole < self.least) | test


RULES = (
    Rule("words", "n_words", low=10, high=10_000_000),
    Rule("word_length", "word_chars", "n_words", low=2, high=15),
    Rule("symbols", "n_symbols", "n_words", high=0.25),
    # Fewer words than this may well have no common one among them.
    Rule("stop_words", "n_stop_words", "n_words", low=0.02, least=30),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("cut_lines", "n_cut_lines", "n_lines", high=0.5),
    Rule("capitals", "n_capital_runs", "n_words", high=0.4),
)


def measures(docs: DataFrame) -> DataFrame:
    """Base measures and those the rules read, one row per row of ``docs``."""
    text = F.col("text")
    df = id_and_text(docs).withColumn("words", words_of("text"))
    df = df.withColumn("n_words", F.size("words").cast("long"))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("lines", lines)
    # Arrays that a lambda looks into are bound first: if Spark moves the expression, into a
    # filter for one, they are still computed once per row.
    window = lambda w, i: F.xxhash64(*[F.get(w, i + F.lit(k)) for k in range(WINDOW)])
    starts = lambda w: F.sequence(F.lit(0), F.size(w) - WINDOW)
    windows = let(F.col("words"), lambda w: F.when(F.size(w) >= WINDOW, F.transform(starts(w), lambda i: window(w, i))))
    none = F.array().cast("array<bigint>")
    df = df.withColumn("windows", F.coalesce(windows, none))
    # Few texts repeat a window; only these are sorted.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    ranked = F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    same = lambda r, x, i: F.coalesce(F.get(r, i)["w"] == x["w"], F.lit(False))
    twice = lambda r: F.filter(r, lambda x, i: same(r, x, i - 1) | same(r, x, i + 1))
    places = let(ranked, lambda r: F.sort_array(F.transform(twice(r), lambda x: x["i"])))
    begin = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    total = F.aggregate(
        places,
        begin,
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    covered = F.when(repeats, total).otherwise(F.lit(0).cast("long"))
    stop = F.filter("words", lambda w: F.lower(w).isin(*STOP_WORDS))
    return df.select(
        "doc_id",
        "n_words",
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("lines", lambda x: x.rlike(r"(\||\.\.\.|…)[\x20\x09-\x0D]*$"))).cast("long").alias("n_cut_lines"),
        F.size(stop).cast("long").alias("n_stop_words"),
        F.regexp_count(text, F.lit(r"\p{Lu}{2,}")).cast("long").alias("n_capital_runs"),
        covered.alias("n_repeat_words"),
    )


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``docs``: its measures, base_failed, a column for each rule, kept.

    A null or empty text has no words, fails the base test and is not kept. A
    null doc_id, repeated rows and further columns change nothing; an empty
    table gives no rows. Windows are compared by their 64-bit hash.
    """
    df = measures(docs)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    df = df.withColumn("base_failed", failed)
    df = df.withColumns({f"passes_{r.name}": r.passes() for r in rules})
    passes = reduce(lambda a, b: a & b, [F.col(f"passes_{r.name}") for r in rules], F.lit(True))
    return df.withColumn("kept", ~F.col("base_failed") & passes)


def passing_rows(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, in all their columns; judged in place, nothing is joined."""
    everything = F.struct(*[docs[c] for c in docs.columns])
    packed = docs.select(everything.alias("doc_id"), docs["text"].alias("text"))
    # A filter would be moved below the measures and compute them once more for each rule.
    passed = F.explode(F.when(F.col("kept"), F.array("doc_id")))
    return quality(packed, rules).select(passed.alias("d")).select("d.*")
