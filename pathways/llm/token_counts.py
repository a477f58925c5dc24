"""Token counts from distinct pre-tokens, without the ids of any document.

Each distinct pre-token of the corpus is counted once, in a table of its own. A
document needs only how often each pre-token occurs in it. The counts of the most
widespread pre-tokens, ``HEAD`` at most, go to all tasks, which add them up while
they read; the other pre-tokens of a document join the table by a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, ship, stage
from .encoder import MOST_CHUNKS, Remembered, encoder

HEAD = 1 << 18
LIMIT = 2048
FLUSH = 400_000


def distinct_pieces(docs: DataFrame, tokenizer: str) -> DataFrame:
    """piece, n_ids, tasks: every pre-token once, its ids counted by the library.

    ``tasks``, in how many tasks it was met, stands for how widespread it is.
    """

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        chunks: set[str] = set()

        def pieces():
            found: set[str] = set()
            for c in chunks:
                found.update(enc.pieces(c))
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string())], names=["piece"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                chunks.update(enc.parts(text)[1])
                if len(chunks) > FLUSH:
                    yield pieces()
                    chunks.clear()
        yield pieces()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            n = [enc.count(p) for p in batch.column(0).to_pylist()]
            columns = [batch.column(0), pa.array(n, pa.int32()), batch.column(1)]
            yield pa.RecordBatch.from_arrays(columns, names=["piece", "n_ids", "tasks"])

    pieces = id_and_text(docs).select("text").mapInArrow(met, "piece string")
    pieces = pieces.groupBy("piece").agg(F.count(F.lit(1)).alias("tasks"))
    return stage(pieces.mapInArrow(counted, "piece string, n_ids int, tasks long"), "pieces")


def widespread(pieces: DataFrame, most: int = HEAD) -> dict[str, int]:
    """Ids of the pre-tokens met in the most tasks: as many whole ranks as ``most`` holds."""
    ranks = pieces.groupBy("tasks").count().collect()
    held, least = 0, None
    for r in sorted(ranks, reverse=True):
        held += r["count"]
        if held > most:
            break
        least = r["tasks"]
    if least is None:
        return {}
    head = pieces.where(F.col("tasks") >= least).select("piece", "n_ids").toArrow()
    return dict(zip(head["piece"].to_pylist(), head["n_ids"].to_pylist()))


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT, head: int = HEAD) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    Null text is empty and has no tokens. Repeated rows and null doc_ids are
    rows like any other; an empty table gives none. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    pieces = distinct_pieces(docs, tokenizer)
    known = spark.sparkContext.broadcast(widespread(pieces, head))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, ids = encoder(tokenizer), known.value
        row = TaskContext.get().partitionId() << 33

        def split(chunk: str) -> tuple[int, tuple[str, ...]]:
            total, rare = 0, []
            for p in enc.pieces(chunk):
                n = ids.get(p)
                if n is None:
                    rare.append(p)
                else:
                    total += n
            return total, tuple(rare)

        chunks = Remembered(split, MOST_CHUNKS // 2)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("piece", pa.string()), ("n", pa.int32())]))]
        for batch in batches:
            totals, rares, sizes = [], [], []
            for text in batch.column(1).to_pylist():
                total, parts = enc.parts(text)
                rare: Counter[str] = Counter()
                for chunk, n in Counter(parts).items():
                    sure, rest = chunks[chunk]
                    total += n * sure
                    for p in rest:
                        rare[p] += n
                totals.append(total)
                rares.append([{"piece": p, "n": n} for p, n in rare.items()])
                sizes.append(len(text.encode()))
            n = len(totals)
            columns = [pa.array(range(row, row + n), kinds[0]), batch.column(0), pa.array(sizes, kinds[1]), pa.array(totals, kinds[2]), pa.array(rares, kinds[3])]
            row += n
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "n_bytes", "sure", "rare"])

    schema = "row long, doc_id long, n_bytes long, sure long, rare array<struct<piece:string,n:int>>"
    base = id_and_text(docs).select(F.col("doc_id").cast("long"), "text")
    rows = stage(base.mapInArrow(frequencies, schema), "frequencies")
    rare = rows.select("row", F.explode("rare").alias("r")).select("row", "r.piece", "r.n")
    joined = rare.join(pieces.select("piece", "n_ids"), "piece")
    sums = joined.groupBy("row").agg(F.sum(F.col("n").cast("long") * F.col("n_ids")).alias("more"))
    counted = rows.select("row", "doc_id", "n_bytes", "sure").join(sums, "row", "left")
    n = F.col("sure") + F.coalesce("more", F.lit(0))
    return counted.select("doc_id", "n_bytes", n.alias("n_tokens")).withColumn("over_limit", F.col("n_tokens") > limit)
