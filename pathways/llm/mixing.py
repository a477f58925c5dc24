"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks.

Slots run through the golden-ratio sequence; a slot's point falls in one source's
share of the cumulative targets. The slots of a source are ranked, and rank r
takes block r of the source's shuffled stream of words, starting over when the
stream ends. Blocks hold ``block_words`` words each, but for the last of a
stream. Running sums are made in two passes, over totals of hash ranges first, so
no source is ever gathered in one task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_REPEATS = 2
# Sources that a schedule is made for.
MOST_SOURCES = 10_000
BLOCK_WORDS = 1024
# Golden ratio as a fraction of 2^31, odd so that a period visits every point once.
PERIOD, STEP = 1 << 31, 1327217885
SLOT_RANGE = 1 << 16
ROWS_PER_RANGE = 2_000


@dataclass(frozen=True)
class Quota:
    """What one source gives: ``epochs`` whole streams and ``rest`` words of another."""

    source: str | None
    size: int
    rows: int
    target: float
    block: int

    @property
    def words(self) -> int:
        return min(round(self.target), MOST_REPEATS * self.size)

    @property
    def blocks(self) -> int:
        return -(-self.size // self.block)

    @property
    def slots(self) -> int:
        if not self.size:
            return 0
        epochs, rest = divmod(self.words, self.size)
        return epochs * self.blocks + -(-rest // self.block)


def targets(sizes: list[int], weights=WEIGHTS, share: float = SHARE, most: float = MOST_REPEATS) -> list[float]:
    """Shares of the total by weight, in the given order; what exceeds a cap is shared anew."""
    caps = [most * s for s in sizes]
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    out = [0.0] * len(sizes)
    open_, left = set(range(len(sizes))), share * sum(sizes)
    while open_:
        per = left / sum(weight[i] for i in open_)
        over = {i for i in open_ if per * weight[i] > caps[i]}
        if not over:
            for i in open_:
                out[i] = per * weight[i]
            break
        for i in over:
            out[i] = float(caps[i])
        open_ -= over
        left -= sum(caps[i] for i in over)
    return out


def sized(docs: DataFrame) -> DataFrame:
    """Rows with an id of their own and their number of words, written once."""
    return stage(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "source",
            F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        ),
        "sizes",
    )


def quotas(sizes: DataFrame, block: int = BLOCK_WORDS) -> list[Quota]:
    """Targets of the sources by code point, null last.

    One row per source reaches the driver, MOST_SOURCES at most; more are an error.
    """
    found = sizes.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    want = targets([r["size"] for r in found])
    return [Quota(r["source"], r["size"], r["rows"], t, block) for r, t in zip(found, want)]


def quota_table(spark: SparkSession, plan: list[Quota]) -> DataFrame:
    rows = [(i, q.source, q.size, q.target, q.words, q.blocks, q.slots, q.block) for i, q in enumerate(plan)]
    schema = "ix int, source string, source_size long, target double, words long, blocks long, slots long, block_words long"
    return spark.createDataFrame(rows, schema)


def schedule(spark: SparkSession, plan: list[Quota]) -> DataFrame:
    """slot, ix (of the source), rank: which source fills each place of the mix.

    Points of a source beyond its number of blocks are dropped; where the
    sequence has brought a source too few, its last slots follow at the end.
    """
    n = sum(q.slots for q in plan)
    total = sum(q.words for q in plan) or 1
    edges, run = [], 0
    for q in plan:
        run += q.words
        edges.append(run / total)
    slots = spark.range(n).select(F.col("id").alias("slot"))
    point = F.pmod(F.pmod("slot", F.lit(PERIOD)) * F.lit(STEP), F.lit(PERIOD)) / F.lit(float(PERIOD))
    passed = F.filter(F.array(*[F.lit(e) for e in edges[:-1]]).cast("array<double>"), lambda e: e <= F.col("point"))
    slots = slots.withColumn("point", point).select("slot", F.size(passed).alias("ix"))
    slots = slots.withColumn("range", F.floor(F.col("slot") / SLOT_RANGE))
    counts = slots.groupBy("ix", "range").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("ix").orderBy("range")) - F.col("n")
    local = F.row_number().over(Window.partitionBy("ix", "range").orderBy("slot")) - 1
    ranked = slots.withColumn("local", local).join(counts.withColumn("before", before), ["ix", "range"])
    ranked = ranked.select("slot", "ix", (F.col("before") + F.col("local")).alias("rank"))
    want = quota_table(spark, plan).select("ix", F.col("slots").alias("want"))
    drawn = counts.groupBy("ix").agg(F.sum("n").alias("drawn"))
    short = want.join(drawn, "ix", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0))).where("drawn < want")
    late = short.select("ix", F.explode(F.sequence(F.col("drawn"), F.col("want") - 1)).alias("rank"))
    late = late.select((F.lit(n) + F.col("rank") * len(plan) + F.col("ix")).alias("slot"), "ix", "rank")
    return ranked.join(want, "ix").where("rank < want").drop("want").unionByName(late.select("slot", "ix", "rank"))


def streams(sizes: DataFrame, plan: list[Quota], seed: int = 7) -> DataFrame:
    """row, ix, start: place of each row that has words in its source's shuffled stream."""
    spark = sizes.sparkSession
    ranges = max(1, math.ceil(max((q.rows for q in plan), default=0) / ROWS_PER_RANGE))
    ix = quota_table(spark, plan).select("ix", F.col("source").alias("_source"))
    df = sizes.where("size > 0").join(ix, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "source")
    df = df.withColumn("h", F.xxhash64(F.lit(seed), "doc_id")).withColumn("range", F.pmod("h", F.lit(ranges)))
    totals = df.groupBy("ix", "range").agg(F.sum("size").alias("n"))
    before = F.sum("n").over(Window.partitionBy("ix").orderBy("range")) - F.col("n")
    inner = Window.partitionBy("ix", "range").orderBy("h", "doc_id", "row")
    df = df.withColumn("local", F.sum("size").over(inner) - F.col("size"))
    df = df.join(totals.select("ix", "range", before.alias("before")), ["ix", "range"])
    return df.select("row", "ix", "size", (F.col("before") + F.col("local")).alias("start"))


def taken_pieces(sizes: DataFrame, plan: list[Quota]) -> DataFrame:
    """slot, epoch, row, first, words: words of a document that a slot takes."""
    spark = sizes.sparkSession
    q = quota_table(spark, plan)
    block = plan[0].block if plan else BLOCK_WORDS
    first = F.floor(F.col("start") / block)
    last = F.floor((F.col("start") + F.col("size") - 1) / block)
    pieces = streams(sizes, plan).select("*", F.explode(F.sequence(first, last)).alias("block"))
    slots = schedule(spark, plan).join(q.select("ix", "blocks", "words", "source_size"), "ix")
    slots = slots.select(
        "slot",
        "ix",
        F.floor(F.col("rank") / F.col("blocks")).alias("epoch"),
        F.pmod("rank", "blocks").alias("block"),
        "words",
        "source_size",
    )
    # A slot stops where the source's words are used up.
    stop = F.least(
        (F.col("block") + 1) * block,
        F.col("source_size"),
        F.col("words") - F.col("epoch") * F.col("source_size"),
    )
    both = pieces.join(slots, ["ix", "block"])
    begin = F.greatest(F.col("start"), F.col("block") * block)
    end = F.least(F.col("start") + F.col("size"), stop)
    return both.select(
        "slot", "epoch", "row", (begin - F.col("start")).alias("first"), (end - begin).alias("words")
    ).where("words > 0")


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken, source.

    A null text has no words, and a document without words is never taken. A
    null source is a source of its own, after all others. Repeated rows are
    separate members of the stream. Equal doc_ids are ordered by their place in
    the input. An empty table gives no rows. Other columns are not read.
    """
    sizes = sized(docs)
    plan = quotas(sizes, block_words)
    per_source = quota_table(sizes.sparkSession, plan).select(F.col("source").alias("_source"), "source_size", "target")
    taken = taken_pieces(sizes, plan).groupBy("row").agg(F.sum("words").alias("taken"))
    df = sizes.join(taken, "row", "left").join(per_source, F.col("source").eqNullSafe(F.col("_source")))
    return df.select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source"
    )


def mixed_rows(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as rows of ``docs``: a document once for each epoch that takes words of it.

    A document taken in part keeps the words that were taken, joined by spaces.
    """
    doc = F.struct(*[docs[c] for c in docs.columns]).alias("doc")
    whole = stage(docs.select(F.monotonically_increasing_id().alias("row"), doc), "mixed")
    n_words = F.regexp_count(F.coalesce("doc.text", F.lit("")), F.lit(WORD)).cast("long")
    sizes = stage(whole.select("row", "doc.doc_id", "doc.source", n_words.alias("size")), "sizes")
    spans = taken_pieces(sizes, quotas(sizes, block_words)).groupBy("row", "epoch")
    spans = spans.agg(F.min("first").cast("int").alias("first"), F.sum("words").cast("int").alias("words"))
    found = F.regexp_extract_all("doc.text", F.lit(f"({WORD})"))
    rows = whole.join(spans, "row").withColumn("found", found)
    cut = F.array_join(F.slice("found", F.col("first") + 1, F.col("words")), " ")
    text = F.when(F.size("found") == F.col("words"), F.col("doc.text")).otherwise(cut)
    new = {"text": text, "n_chars": F.char_length(text)}
    return rows.select(
        *[(new[c].cast(docs.schema[c].dataType) if c in new else F.col("doc").getField(c)).alias(c) for c in docs.columns]
    )
