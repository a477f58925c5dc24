"""Token files: frequency-ranked ids in byte-aligned variable-length code.

A file set is a folder with two Parquet tables. ``ranks`` maps the rank of each
id that occurs (0 is the most frequent) to the id. ``blocks`` holds one row for a
run of documents: their doc_ids and lengths, the place of the first id, and the
ranks of all their ids as two byte strings. ``control`` has two bits for each
rank, four ranks to a byte, first rank lowest: the number of its data bytes less
one. ``data`` has the ranks' bytes, lowest first. Spark's writer commits the
files, so a lost executor leaves no half-written block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathways.session import remove, scratch_path

from .common import ship
from .encoder import encoder
from .token_table import bases, encode_documents

BLOCK_TOKENS = 1 << 16
BLOCK_NAMES = ["part", "first", "doc_ids", "lengths", "control", "data"]
BLOCK_SCHEMA = "part int, first long, doc_ids array<long>, lengths array<long>, control binary, data binary"
# By control byte: data bytes of its four ranks.
LENGTHS = ((np.arange(256)[:, None] >> np.arange(0, 8, 2)) & 3).astype(np.uint8) + 1
# By number of data bytes: which of the four bytes read count.
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit ranks."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    more = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[: len(ranks)] = more
    control = (padded.reshape(-1, 4) << np.arange(0, 8, 2, dtype=np.uint8)).sum(1, dtype=np.uint8)
    used = np.arange(4, dtype=np.uint8) <= more[:, None]
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks, each by one table lookup of its length and one masked read."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    at = np.cumsum(lengths, dtype=np.int64) - lengths
    read = np.frombuffer(data + b"\0\0\0", np.uint8)
    four = read[at].astype(np.uint32)
    for k in range(1, 4):
        wide = np.flatnonzero(lengths > k)
        if not len(wide):
            break
        four[wide] |= read[at[wide] + k].astype(np.uint32) << np.uint32(8 * k)
    return four & MASKS[lengths]


def id_ranks(encoded: DataFrame) -> np.ndarray:
    """Ids that occur, most frequent first. At most one row per id of the vocabulary reaches the driver."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                counts = np.frombuffer(raw, np.int64)
                total = counts.copy() if total is None else total + counts
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["id", "n"])

    counts = encoded.where("counts is not null").select("counts").mapInArrow(summed, "id long, n long")
    found = counts.groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids, n = found["id"].to_numpy(), found["n"].to_numpy()
    return ids[np.lexsort((ids, -n))].astype("<u4")


def write_token_file(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, block_tokens: int = BLOCK_TOKENS) -> None:
    """Encode every text of ``docs``, append ``end_id``, write the file set in doc_id order."""
    spark = docs.sparkSession
    ids = scratch_path(spark, "ids")
    encoded = encode_documents(docs, ids, tokenizer, end_id, count=True)
    id_of = id_ranks(encoded)
    spark.createDataFrame(
        [(r, int(i)) for r, i in enumerate(id_of)], "rank long, id long"
    ).coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(int(id_of.max()) + 1 if len(id_of) else 1, "<u4")
    rank_of[id_of] = np.arange(len(id_of))
    dtype = encoder(tokenizer).dtype

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, doc_ids, lengths, ids, held = None, 0, [], [], [], 0

        def block():
            control, data = pack_ranks(rank_of[np.frombuffer(b"".join(ids), dtype)])
            columns = [[part], [first], [doc_ids], [lengths], [control], [data]]
            kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=BLOCK_NAMES)

        for batch in batches:
            for p, doc_id, before, n, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if lengths and (p != part or held >= block_tokens or before != first + held):
                    yield block()
                    doc_ids, lengths, ids, held = [], [], [], 0
                if not lengths:
                    part, first = p, before
                doc_ids.append(doc_id)
                lengths.append(n)
                ids.append(raw)
                held += n
        if lengths:
            yield block()

    rows = encoded.where("counts is null").select("part", "doc_id", "before", "n_tokens", "ids")
    written = rows.mapInArrow(blocks, BLOCK_SCHEMA)
    written.write.option("compression", "zstd").parquet(f"{path}/blocks")
    remove(spark, ids)


def read_token_file(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents decoded from the files: doc_id, start, n_tokens, ids_crc32 and, if asked, ids."""
    ship(spark)
    ranks = spark.read.parquet(f"{path}/ranks").toArrow()
    id_of = np.zeros(max(ranks.num_rows, 1), "<u4")
    id_of[ranks["rank"].to_numpy()] = ranks["id"].to_numpy()

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in range(batch.num_rows):
                part, first, doc_ids, lengths, control, data = (c[b] for c in batch.columns)
                n = lengths.values.to_numpy()
                ids = id_of[unpack_ranks(control.as_py(), data.as_py(), int(n.sum()))]
                ends = np.cumsum(n)
                raw = memoryview(ids).cast("B")
                crc = [zlib.crc32(raw[4 * (e - k) : 4 * e]) for e, k in zip(ends.tolist(), n.tolist())]
                columns = [pa.array([part.as_py()] * len(n), pa.int32()), doc_ids.values, pa.array(first.as_py() + ends - n, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.array([ids[e - k : e] for e, k in zip(ends, n)], pa.list_(pa.uint32())).cast(pa.list_(pa.int64())))
                names = ["part", "doc_id", "before", "n_tokens", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])

    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    schema = "part int, doc_id long, before long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    total = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)
    base = bases(blocks.select("part", total.alias("n_tokens")))
    found = blocks.mapInArrow(decoded, schema).join(F.broadcast(base), "part")
    start = (F.col("base") + F.col("before")).alias("start")
    return found.select("doc_id", start, "n_tokens", "ids_crc32", *["ids"] * with_ids)


def token_file(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write ``docs`` as a token file in the shared folder and read it back.

    One row per row of ``docs``. Null text is empty and leaves the end id alone;
    null doc_ids come first, rows of equal doc_id are ordered by their text. An
    empty table gives no rows. Other columns are not read.
    """
    path = scratch_path(docs.sparkSession, "tokens")
    write_token_file(docs, path, tokenizer, end_id)
    return read_token_file(docs.sparkSession, path)
