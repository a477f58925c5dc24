"""Documents as ids in ascending doc_id order, with their place among all ids.

First pass: range partitions of doc_id are encoded and written, each row with the
number of ids before it in its partition. Second pass: running totals of the
partitions, one row each, give every partition's base.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_and_text, ship
from .encoder import encoder

BATCH_ROWS = 1000


def encode_documents(docs: DataFrame, path: str, tokenizer: str, end_id: int, count: bool = False) -> DataFrame:
    """Write to ``path`` and read: part, doc_id, before, n_tokens, ids (little-endian, two or four bytes each), counts.

    With ``count``, the last row of a partition holds no document but how often
    each id occurs in it (64-bit integers). Null text is empty; rows of equal
    doc_id follow each other by text, null ids come first.
    """
    spark = docs.sparkSession
    ship(spark)
    schema = "part int, doc_id long, before long, n_tokens long, ids binary, counts binary"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        part, before = TaskContext.get().partitionId(), 0
        end = np.array([end_id], enc.dtype).tobytes()
        width = enc.dtype.itemsize
        total = np.zeros(enc.tokenizer.get_vocab_size(), np.int64) if count else None

        def rows(doc_ids, befores, lengths, ids, counts):
            n = len(lengths)
            columns = [pa.array([part] * n, pa.int32()), doc_ids, pa.array(befores, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["part", "doc_id", "before", "n_tokens", "ids", "counts"])

        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                ids = [enc.ids(t) + end for t in batch.column(1).to_pylist()]
                lengths = np.array([len(b) // width for b in ids], np.int64)
                starts = before + np.cumsum(lengths) - lengths
                before += int(lengths.sum())
                if count:
                    total += np.bincount(np.frombuffer(b"".join(ids), enc.dtype), minlength=len(total))
                yield rows(batch.column(0), starts, lengths, ids, [None] * len(ids))
        if count and before:
            yield rows(pa.array([None], pa.int64()), [before], [0], [None], [total.tobytes()])

    ordered = id_and_text(docs).select(F.col("doc_id").cast("long"), "text")
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(encode, schema).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def bases(rows: DataFrame, length: str = "n_tokens") -> DataFrame:
    """part, base: ids before each partition. One row per partition is ordered."""
    totals = rows.groupBy("part").agg(F.sum(length).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
