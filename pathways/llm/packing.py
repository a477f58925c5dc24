"""Packing by concatenating and cutting, with global offsets from two passes.

The first pass encodes the documents in doc_id order and sums each partition; the
running totals of the partitions then place every id among all ids. Windows of
``length`` ids are cut by arithmetic alone, and a document that crosses a window's
end becomes one record on each side of it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathways.session import scratch_path

from .encoder import encoder
from .token_table import bases, encode_documents

LENGTH = 4096
NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """Pieces of documents in sequences of ``length`` ids, gapless from 0.

    A document is the ids of its text and ``end_id``. Only the last sequence can
    be shorter than ``length``. Null text is empty; null doc_ids come first, rows
    of equal doc_id are ordered by text. An empty table gives no rows. Other
    columns are not read. With ``with_ids`` each piece also has its ids.
    """
    encoded = encode_documents(docs, scratch_path(docs.sparkSession, "ids"), tokenizer, end_id)
    dtype = encoder(tokenizer).dtype

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, ids = [], []
            for doc_id, begin, n, raw in zip(*(c.to_pylist() for c in batch.columns)):
                found = np.frombuffer(raw, dtype).astype("<u4")
                at = 0
                while at < n:
                    sequence, offset = divmod(begin + at, length)
                    size = min(n - at, length - offset)
                    piece = found[at : at + size]
                    out.append((doc_id, at, size, zlib.crc32(piece), n, sequence, offset))
                    if with_ids:
                        ids.append(piece.astype(np.int64))
                    at += size
            columns = [pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * len(NAMES))]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=[*NAMES, "ids"][: len(columns)])

    placed = encoded.join(F.broadcast(bases(encoded)), "part")
    placed = placed.select("doc_id", (F.col("base") + F.col("before")).alias("begin"), "n_tokens", "ids")
    return placed.mapInArrow(cut, SCHEMA + ", ids array<long>" * with_ids)
