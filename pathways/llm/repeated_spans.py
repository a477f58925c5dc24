"""Bytes of texts that lie in a string of 200 bytes found anywhere else, removed exactly.

Every string of ``length`` bytes belongs to the least hash among the short
substrings in it, its anchor; equal strings have equal anchors, so strings need
to be compared within an anchor only. A run of neighbouring strings with one
anchor is a segment. Anchors met once are done with. The segments of the others
are counted, equal ones as one, and dealt into shards by anchor; in a shard the
suffix array of all strings whose hash is met twice is induced, and its common prefixes
tell which of them do occur twice. A passage that very many texts share makes equal segments, so one;
an anchor with very many different segments is cut again by longer anchors, at last by
the strings themselves.

A text that occurs twice goes whole, and its marks are made once by a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathways.functions.skew import join_unique
from pathways.session import release, remove, scratch_path

from .common import id_and_text, ship, stage
from .hashing import mix, running, slices, substrings
from .ngram_join import _groups
from .suffixes import common_prefixes, suffix_array

LENGTH = 200
ANCHOR = 32
SHARD_BYTES = 1 << 21
# Different segments of an anchor beyond which longer anchors cut them again.
CROWDED = 20_000
# Bytes of segments that are hashed together.
HASHED_BYTES = 1 << 18
# Texts that a task remembers to have marked.
REMEMBERED = 200_000
SEPARATOR = 0xFF  # in no UTF-8 text


def window_minima(x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least of every ``width`` neighbours and its leftmost place; the last eight bits of ``x`` are not compared."""
    n = len(x)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    # Places within a block in the low bits: of equal values the leftmost is the least.
    cells = (padded.reshape(-1, width) & ~np.uint64(255)) | np.arange(width, dtype=np.uint64)
    ahead = np.minimum.accumulate(cells, 1).ravel()[width - 1 : n]
    behind = np.minimum.accumulate(cells[:, ::-1], 1)[:, ::-1].ravel()[: n - width + 1]
    left = (behind >> np.uint64(8)) <= (ahead >> np.uint64(8))
    least = np.where(left, behind, ahead)
    start = np.arange(n - width + 1)
    block = np.where(left, start, start + width - 1) // width
    return least >> np.uint64(8), block * width + (least & np.uint64(255)).astype(np.int64)


def anchors(data: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of string starts with one anchor in one place: first start, number of starts, anchor.

    The leftmost of equal anchors counts, so equal strings, also within one
    run of a periodic text, never share a run. A window has at most 256 places.
    """
    n = len(data) - length + 1
    if n < 1:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    at = np.arange(len(data) - anchor + 1)
    least, place = window_minima(mix(substrings(running(data), at, at + anchor)), length - anchor + 1)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    return first, np.diff(np.append(first, n)), least[first].astype(np.int64)


def met_twice(segments: list[bytes], length: int) -> list[np.ndarray]:
    """For each segment, which of its strings may be met twice: those whose hash is."""
    hashes = []
    for a, b in slices([len(s) for s in segments], HASHED_BYTES):
        data = np.frombuffer(b"".join(segments[a:b]), np.uint8)
        sizes = np.array([len(s) for s in segments[a:b]], np.int64)
        ends = np.cumsum(sizes)
        strings = sizes - length + 1
        starts = np.arange(strings.sum()) + np.repeat(ends - sizes - np.cumsum(strings) + strings, strings)
        hashes.append(substrings(running(data), starts, starts + length))
    every = np.concatenate(hashes)
    order = np.argsort(every, kind="stable")
    equal = np.concatenate(([False], every[order[1:]] == every[order[:-1]], [False]))
    found = np.zeros(len(every), bool)
    found[order] = equal[1:] | equal[:-1]
    return np.split(found, np.cumsum([len(s) - length + 1 for s in segments])[:-1])


def repeated_in(segments: list[bytes], times: np.ndarray, length: int) -> list[np.ndarray]:
    """For each distinct segment, which of its strings of ``length`` occur twice or more.

    Strings whose hash is met once cannot; only the others' bytes come into the suffix array.
    """
    own: list[tuple[int, int, int]] = []  # segment, first and last start of a stretch
    for i, found in enumerate(met_twice(segments, length)):
        own += [(i, a, b) for a, b in runs_of(found)]
    out = [np.full(len(s) - length + 1, t > 1) for s, t in zip(segments, times.tolist())]
    if not own:
        return out
    parts = [segments[i][a : b + length] for i, a, b in own]
    sizes = np.array([len(s) + 1 for s in parts], np.int64)
    begins = np.cumsum(sizes) - sizes
    mark = bytes([SEPARATOR])
    data = np.frombuffer(mark.join(parts) + mark + b"\0", np.uint8)
    text = data.astype(np.uint16) + 1
    text[-1] = 0
    order = suffix_array(text, 257)
    shared = common_prefixes(data, order) >= length
    found = np.zeros(len(data), bool)
    found[order[1:][shared]] = True
    found[order[:-1][shared]] = True
    for (i, a, b), begin in zip(own, begins.tolist()):
        out[i][a : b + 1] |= found[begin : begin + b - a + 1]
    return out


def runs_of(found: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], found, [False])).astype(np.int8)))
    return list(zip(edges[0::2].tolist(), (edges[1::2] - 1).tolist()))


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


MARK = "id long, start long, n long, anchor long, digest long"


def marked(texts: DataFrame, length: int, anchor: int) -> DataFrame:
    """id, start, n, anchor, digest (of the segment) of every run of string starts.

    ``texts`` has id, text and within, the runs (start, n) to look at, null for the whole
    text. Equal ids have equal texts; a task marks them once.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "start", "n", "anchor", "digest"]
        done: set[int] = set()
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            held = 0
            for id_, text, within in zip(*(c.to_pylist() for c in batch.columns)):
                if id_ in done:
                    continue
                if len(done) < REMEMBERED:
                    done.add(id_)
                data = np.frombuffer(text.encode(), np.uint8)
                for begin, end in [(0, len(data))] if within is None else [(r["start"], r["start"] + r["n"] + length - 1) for r in within]:
                    own = data[begin:end]
                    first, n, least = anchors(own, length, anchor)
                    if not len(first):
                        continue
                    digest = mix(substrings(running(own), first, first + n + length - 1)).view(np.int64)
                    # Anchors of another length are other anchors.
                    least = mix(least.view(np.uint64) + np.uint64(anchor)).view(np.int64)
                    for column, values in zip(out, (np.full(len(first), id_, np.int64), first + begin, n, least, digest)):
                        column.append(values)
                    held += len(first)
                if held > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=names)
                    out, held = [[], [], [], [], []], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=names)

    return texts.select("id", "text", "within").mapInArrow(mark, MARK)


def shared_runs(marks: DataFrame, crowded: int) -> DataFrame:
    """id, runs: the runs whose anchor is met elsewhere too, and whether it has many different segments."""
    each = marks.groupBy("anchor", "digest").agg(F.count(F.lit(1)).alias("n"))
    met = each.groupBy("anchor").agg(F.sum("n").alias("met"), F.count(F.lit(1)).alias("kinds")).where("met > 1")
    run = F.struct("start", "n", "anchor", (F.col("kinds") > crowded).alias("crowded"))
    return join_unique(marks, met, ["anchor"], "inner").groupBy("id").agg(F.collect_set(run).alias("runs"))


def occurrences(candidates: DataFrame, length: int, with_bytes: bool) -> DataFrame:
    """Segments of candidates (id, times, text, runs): anchor, segment_id and either id, start or times, segment."""
    kinds = [pa.int64(), pa.binary(), *([pa.int64(), pa.binary()] if with_bytes else [pa.int64(), pa.int64()])]
    names = ["anchor", "segment_id", *(["times", "segment"] if with_bytes else ["id", "start"])]
    schema = "anchor long, segment_id binary, " + ("times long, segment binary" if with_bytes else "id long, start long")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for id_, times, text, runs in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode()
                for r in runs:
                    segment = data[r["start"] : r["start"] + r["n"] + length - 1]
                    out.append((r["anchor"], _digest(segment), *((times, segment) if with_bytes else (id_, r["start"]))))
                if len(out) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return candidates.select("id", "times", "text", "runs").mapInArrow(emit, schema)


def judged(segments: DataFrame, shards: int, length: int) -> DataFrame:
    """anchor, segment_id, runs: strings of each distinct segment that occur twice, if any."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, 1):
            times = g.column("times").to_numpy()
            found = repeated_in(g.column("segment").to_pylist(), times, length)
            some = [i for i, f in enumerate(found) if f.any()]
            if some:
                at = pa.array(some, pa.int64())
                runs = [[{"first": a, "last": b} for a, b in runs_of(found[i])] for i in some]
                kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
                columns = [g.column("anchor").take(at).combine_chunks(), g.column("segment_id").take(at).combine_chunks(), pa.array(runs, kind)]
                yield pa.RecordBatch.from_arrays(columns, names=["anchor", "segment_id", "runs"])

    distinct = segments.groupBy("anchor", "segment_id", "segment").agg(F.sum("times").alias("times"))
    dealt = distinct.select(F.pmod("anchor", F.lit(shards)).alias("shard"), "anchor", "segment_id", "segment", "times")
    dealt = dealt.repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(judge, "anchor long, segment_id binary, runs array<struct<first:long,last:long>>")


def cut_texts(candidates: DataFrame, length: int) -> DataFrame:
    """id, n_removed, n_spans, kept (the bytes that stay) from (id, text, starts)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for id_, text, runs in zip(*(c.to_pylist() for c in batch.columns)):
                data = np.frombuffer(text.encode(), np.uint8)
                edge = np.zeros(len(data) + 1, np.int32)
                np.add.at(edge, [r["first"] for r in runs], 1)
                np.add.at(edge, [r["last"] + length for r in runs], -1)
                gone = np.cumsum(edge[:-1]) > 0
                out.append((id_, int(gone.sum()), len(runs_of(gone)), data[~gone].tobytes()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 4, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_removed", "n_spans", "kept"])

    return candidates.mapInArrow(cut, "id long, n_removed long, n_spans long, kept binary")


RUNS = "array<struct<start:long,n:long,anchor:long,crowded:boolean>>"
WITHIN = "array<struct<start:long,n:long>>"


def candidate_texts(docs: DataFrame, base: DataFrame, texts: DataFrame, length: int, anchor: int, crowded: int) -> DataFrame:
    """id, times, text, runs: each text with runs whose anchor is met elsewhere too, written."""
    spark = docs.sparkSession
    path = scratch_path(spark, "marks")
    # Marks go by a hash of the text; equal texts give equal marks.
    long_ = id_and_text(docs).where(F.octet_length("text") >= length).select(F.xxhash64("text").alias("id"), "text", F.lit(None).cast(WITHIN).alias("within"))
    marked(long_, length, anchor).write.option("compression", "zstd").parquet(path)
    runs = shared_runs(spark.read.schema(MARK).parquet(path), crowded).withColumnRenamed("id", "tid")
    listed_path = scratch_path(spark, "runs")
    runs.join(texts, "tid").drop("tid").write.option("compression", "zstd").parquet(listed_path)
    del runs
    remove(spark, path)
    release(spark)
    listed = spark.read.schema(f"runs {RUNS}, sha string, id long, times long, rep long").parquet(listed_path)
    # Each text is fetched once, from the row of its least doc_id.
    own = base.withColumn("rep", F.coalesce("doc_id", F.lit(-(1 << 62))))
    listed = listed.withColumn("rep", F.coalesce("rep", F.lit(-(1 << 62))))
    found = own.join(listed, ["rep", "sha"]).dropDuplicates(["rep", "sha"]).select("id", "times", "text", "runs")
    path = scratch_path(spark, "candidates")
    found.write.option("compression", "zstd").parquet(path)
    remove(spark, listed_path)
    return spark.read.schema(f"id long, times long, text string, runs {RUNS}").parquet(path)


def cut_finer(candidates: DataFrame, length: int, anchor: int, crowded: int) -> DataFrame:
    """The candidates with longer anchors in the runs whose anchor is crowded, written."""
    many = candidates.where(F.exists("runs", lambda r: r["crowded"]))
    within = F.filter("runs", lambda r: r["crowded"])
    within = F.transform(within, lambda r: F.struct(r["start"].alias("start"), r["n"].alias("n")))
    marks = stage(marked(many.select("id", "text", within.alias("within")), length, anchor), "finer-marks")
    finer = shared_runs(marks, crowded).select("id", F.col("runs").alias("finer"))
    kept = F.filter("runs", lambda r: ~r["crowded"])
    runs = F.concat(kept, F.coalesce("finer", F.array().cast(RUNS)))
    return stage(candidates.join(finer, "id", "left").select("id", "times", "text", runs.alias("runs")), "candidates")


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, shard_bytes: int = SHARD_BYTES, crowded: int = CROWDED
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes when a string of ``length`` bytes that covers it starts at any
    other place too, in whichever text; strings do not cross texts. Null text is
    empty; a text shorter than ``length`` keeps all. Equal texts are judged once
    and count as often as they occur, repeated rows included. Null doc_ids are
    rows like any other, other columns are not read, an empty table gives no
    rows. Segments are matched across tasks by a 128-bit digest.
    """
    spark = docs.sparkSession
    ship(spark)
    base = id_and_text(docs).withColumn("sha", F.sha2("text", 256))
    tid = F.xxhash64("text").alias("tid")
    size = F.octet_length("text").cast("long").alias("n_bytes")
    rows = stage(base.select(F.monotonically_increasing_id().alias("row"), "doc_id", size, "sha", tid), "rows")
    # A text is known by the row that holds it first.
    first = (F.min("row").alias("id"), F.count(F.lit(1)).alias("times"), F.min("doc_id").alias("rep"))
    texts = stage(rows.groupBy("sha", "tid").agg(*first), "texts")
    candidates = candidate_texts(docs, base, texts, length, anchor, crowded)
    for longer in ((anchor + length) // 2, length):
        # At last every string is its own anchor, which has no two segments.
        if candidates.where(F.exists("runs", lambda r: r["crowded"])).take(1):
            candidates = cut_finer(candidates, length, longer, crowded)
    release(spark)
    total = F.sum(F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["n"] + F.lit(length)))
    shards = max(1, -(-(candidates.agg(total).first()[0] or 0) // shard_bytes))
    verdicts = stage(judged(occurrences(candidates, length, True), shards, length), "verdicts")
    release(spark)
    places = join_unique(occurrences(candidates, length, False), verdicts, ["anchor", "segment_id"], "inner")
    shifted = F.transform("runs", lambda r: F.struct((r["first"] + F.col("start")).alias("first"), (r["last"] + F.col("start")).alias("last")))
    spans = places.groupBy("id").agg(F.flatten(F.collect_list(shifted)).alias("spans"))
    cut = cut_texts(candidates.select("id", "text").join(spans, "id"), length)
    cut = cut.select("id", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    of_text = texts.join(cut, "id", "left").select("sha", "tid", "times", "n_removed", "n_spans", "kept_sha256")
    done = join_unique(rows, of_text, ["sha", "tid"], "inner")
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    whole = (F.col("times") > 1) & (F.col("n_bytes") >= length)
    return done.select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", none)).alias("n_removed"),
        F.when(whole, one).otherwise(F.coalesce("n_spans", none)).alias("n_spans"),
        F.when(whole, hashlib.sha256().hexdigest()).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
