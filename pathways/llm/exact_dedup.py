"""Exact duplicates by an extendible-hash index kept in shared files.

The key of a text is the 64-bit hash of its normalised form. The directory maps
the leading bits of a key to a bucket; it is doubled, one more bit at a time,
until no bucket holds more distinct keys than its capacity. Buckets belong in
ranges to owner tasks. A key that one row has needs no look at its text; the texts
of the others go to the owner of their bucket, which walks the chain of each key and
compares bytes. What it finds equal is one entry, with the smallest doc_id and the
number of rows. Copies are combined by the task that read them before they go to
their owner, so a text that makes up a third of all rows arrives as one row for each
task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathways.functions.skew import join_unique

from .common import SPACE, id_and_text, stage

KEY_BITS = 64
CAPACITY = 1 << 17


def normalised(text: Column | str) -> Column:
    return F.regexp_replace(text, f"{SPACE}+", " ")


def key_of(text: Column, bits: int) -> Column:
    """Leading ``bits`` of the hash; fewer than 64 only to test chains."""
    h = F.xxhash64(text)
    return h if bits == KEY_BITS else F.shiftleft(F.shiftrightunsigned(h, KEY_BITS - bits), KEY_BITS - bits)


def slot_of(key: Column | str, depth: int) -> Column:
    """The leading bits of a key, as many as the directory is deep."""
    return F.shiftrightunsigned(key, KEY_BITS - depth) if depth else F.lit(0).cast("bigint")


def directory(keys: DataFrame, capacity: int = CAPACITY, bits: int = KEY_BITS) -> tuple[DataFrame, int]:
    """Slots with their bucket and its local depth, and the directory's depth.

    ``keys`` has one column ``key``, each value once. Slots that no key uses are
    absent. A bucket whose keys cannot be told apart by more bits stays overfull.
    """
    total = keys.count()
    first = depth = max(0, math.ceil(math.log2(max(total, 1) / capacity)))
    while True:
        slots = keys.groupBy(slot_of("key", depth).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
        most = slots.agg(F.max("n")).first()[0] or 0
        if most <= capacity or depth >= min(bits, 40):
            break
        depth += 1
    local = F.lit(depth)
    for d in range(depth - 1, max(first - 3, 0) - 1, -1):
        # Buddies that fit together share a bucket of lesser depth.
        together = F.sum("n").over(Window.partitionBy(F.shiftright("slot", depth - d)))
        local = F.when(together <= capacity, d).otherwise(local)
    slots = slots.withColumn("local_depth", local)
    start = F.expr(f"shiftleft(shiftright(slot, {depth} - local_depth), {depth} - local_depth)")
    return slots.select("slot", "local_depth", start.alias("bucket")), depth


def same_text(a: Column, b: Column) -> Column:
    """Both are there and equal byte for byte."""
    return F.coalesce(a == b, F.lit(False))


def chained(entries: DataFrame) -> DataFrame:
    """bucket, key, chain, keep_id, group_size, sha of (owner, bucket, key, norm, keep_id, group_size).

    An owner has all entries of its buckets. It walks those of a key in the order of
    their texts; an entry that differs from the one before begins the next link of the
    chain, an equal one joins its link.
    """
    walk = Window.partitionBy("owner", "bucket", "key").orderBy("norm")
    differs = ~same_text(F.lag("norm").over(walk), F.col("norm"))
    links = entries.repartition("owner").withColumn("differs", differs.cast("bigint"))
    links = links.withColumn("chain", F.sum("differs").over(walk.rowsBetween(Window.unboundedPreceding, 0)))
    found = links.groupBy("owner", "bucket", "key", "chain").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.min(F.sha2("norm", 256)).alias("sha")
    )
    return found.drop("owner")


def exact_duplicates(docs: DataFrame, capacity: int = CAPACITY, bits: int = KEY_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, bucket, chain.

    Texts are equal when identical after each run of white space became one
    space; a null text is an empty one. The smallest doc_id of equal texts stays;
    rows that repeat that doc_id with that text are the same document and are
    all marked as kept. A null doc_id counts as larger than any other. Other
    columns of ``docs`` are not read. An empty table gives no rows.
    """
    text = normalised("text")
    base = id_and_text(docs)
    hashed = base.select("doc_id", text.alias("norm"), F.spark_partition_id().alias("task")).withColumn("key", key_of(F.col("norm"), bits))
    keys = stage(hashed.select("doc_id", "key", F.sha2("norm", 256).alias("sha")), "keys")
    held = keys.groupBy("key").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"), F.min("sha").alias("sha"))
    held = stage(held, "distinct-keys")
    slots, depth = directory(held.select("key"), capacity, bits)
    placed = stage(held.withColumn("slot", slot_of("key", depth)).join(slots, "slot").drop("slot", "local_depth"), "placed")
    alone = placed.where("group_size = 1").withColumn("chain", F.lit(1).cast("bigint"))
    owners = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    owner = F.shiftright(F.col("bucket") * owners, depth).alias("owner")
    several = placed.where("group_size > 1").select("key", "bucket", owner)
    met = join_unique(hashed, several, ["key"], "inner")
    copies = met.groupBy("owner", "bucket", "key", "norm", "task").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    index = stage(alone.unionByName(chained(copies).select(*alone.columns)), "index")
    found = keys.join(index, ["key", "sha"])
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "bucket",
        "chain",
    )


def without_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, in all their columns: one row of each text.

    Of rows that repeat the smallest doc_id with that text the least one stays,
    by text and the other columns that have an order.
    """
    found = exact_duplicates(docs, **options)
    keep = found.where("kept").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("_times"))
    sha = F.sha2(normalised(F.coalesce("text", F.lit(""))), 256)
    keep = keep.select(F.col("doc_id").alias("_keep_id"), F.col("text_sha256").alias("_keep_sha"), "_times")
    same = docs["doc_id"].eqNullSafe(keep["_keep_id"]) & (sha == keep["_keep_sha"])
    once = docs.join(keep.where("_times = 1"), same, "left_semi")
    row = F.struct(*[docs[c] for c in docs.columns])
    order = F.struct(docs["text"], *[docs[f.name] for f in docs.schema if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"])
    repeated = docs.join(keep.where("_times > 1"), same, "inner").groupBy("_keep_id", "_keep_sha").agg(F.min_by(row, order).alias("_row"))
    return once.unionByName(repeated.select("_row.*"))
