"""Conversations as paths of a prefix trie, held in double arrays.

A turn is a digest of its role and text with its number of words behind it, a
conversation the string of its turns: texts leave the plan at once. Equal paths
become one row. The paths are dealt in ranges of their order, so a shard holds
neighbouring prefixes however many conversations begin alike, and two shards share
only nodes above both: those on the last path of one and the first path of a later.

In a shard the turns get dense ids, and BASE and CHECK are packed level by level: the
child of node s by turn c lies at ``t = BASE[s] + c`` with ``CHECK[t] = s``. Walking the
paths through them counts members. Every sum that a node gathers is a sum over paths
or over nodes counted in one shard only, so shared nodes' sums are added up globally.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathways.functions.skew import join_unique

from .common import parts_for, ship, stage, words_of

# Bytes of a turn in a path: digest, number of words.
DIGEST = 16
TURN = DIGEST + 4
CHUNK = 4096
NOTHING = hashlib.sha256(b"").hexdigest()
# Turns of a shard, on average.
SHARD_TURNS = 200_000
TRIES = 64


def _turn(role: Column, text: Column) -> Column:
    """Hexadecimal digits of a turn."""
    of = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    return F.concat(of, F.lpad(F.hex(F.size(words_of(text)).cast("long")), 2 * (TURN - DIGEST), "0"))


def turn_paths(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: each conversation's turns in order, as hexadecimal digits."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select("conv_id", F.struct("turn", _turn(role, text).alias("is")).alias("at"))
    listed = rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list("at")).alias("at"))
    return listed.select("conv_id", F.col("at.is").alias("turns"))


def rebuilt(paths: DataFrame) -> DataFrame:
    """conv_id, path: the first h turns of conversation c - c % 20, then the own ones after the first h."""
    heads = paths.where("conv_id % 20 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 3).alias("head"))
    h = F.expr("int(crc32(cast(cast(conv_id as string) as binary)) % 4)")
    own = paths.withColumn("h", h).withColumn("base", F.expr("conv_id - conv_id % 20"))
    both = own.join(heads, "base", "left")
    head = F.coalesce(F.expr("slice(head, 1, h)"), F.array().cast("array<string>"))
    tail = F.expr("slice(turns, h + 1, greatest(size(turns) - h, 0))")
    return both.select("conv_id", F.unhex(F.array_join(F.concat(head, tail), "")).alias("path"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, pa.RecordBatch]]:
    """Stretches of rows with equal first column, each within a batch."""
    for batch in batches:
        path = batch.column(0).to_pylist()
        begin = 0
        for i in range(1, len(path) + 1):
            if i == len(path) or path[i] != path[begin]:
                yield path[begin], batch.slice(begin, i - begin)
                begin = i


def distinct_paths(members: DataFrame, parts: int) -> DataFrame:
    """path, n, least, ends: equal paths as one, with the digest of their ordered ids.

    The ids of a path are first written out in ranges, so a path of very many
    conversations is read by many tasks; the digest then takes its pieces in order.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path, rows in _runs([batch]):
                ids = rows.column(1).to_pylist()
                for a in range(0, len(ids), CHUNK):
                    own = ids[a : a + CHUNK]
                    out.append((path, own[0], len(own), ",".join(map(str, own))))
            if out:
                types = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["path", "first", "n", "ids"])

    ranges = members.select("path", "conv_id").repartitionByRange(parts, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    pieces = ranges.mapInArrow(packed, "path binary, first long, n long, ids string")

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, types = ["path", "n", "least", "ends"], [pa.binary(), pa.int64(), pa.int64(), pa.string()]
        now, n, least, digest, out = None, 0, 0, None, []
        for path, rows in _runs(batches):
            _, first, count, ids = (c.to_pylist() for c in rows.columns)
            if path != now:
                if now is not None:
                    out.append((now, n, least, digest.hexdigest()))
                if len(out) >= 5_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                    out = []
                now, n, least, digest = path, 0, first[0], hashlib.sha256()
            for k, text in zip(count, ids):
                digest.update((b"," if n else b"") + text.encode())
                n += k
        if now is not None:
            out.append((now, n, least, digest.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    dealt = pieces.repartition(parts, "path").sortWithinPartitions("path", "first")
    return dealt.mapInArrow(digested, "path binary, n long, least long, ends string")


class DoubleArray:
    """BASE and CHECK of the prefixes of sorted distinct sequences of dense ids.

    ``flat`` holds the sequences one after the other, ``sizes`` their lengths. Slot 0 is
    the root; a slot without a node has CHECK -1. BASE may be negative, so a single child
    fits any free slot.
    """

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.flat, self.sizes, self.begins = flat, sizes, np.cumsum(sizes) - sizes
        room = len(flat) + (int(flat.max()) + 2 if len(flat) else 1)
        self.base, self.check = np.zeros(room, np.int64), np.full(room, -1, np.int64)
        self.check[0], self.used = 0, 1  # used: all slots below are taken
        now, at = np.arange(len(sizes)), np.zeros(len(sizes), np.int64)
        depth = 0
        while True:
            deeper = sizes[now] > depth
            now, at = now[deeper], at[deeper]
            if not len(now):
                return
            code = flat[self.begins[now] + depth]
            new = np.ones(len(now), bool)
            new[1:] = (code[1:] != code[:-1]) | (at[1:] != at[:-1])
            heads = np.flatnonzero(new)
            slots = self._place(at[heads], code[heads])
            at, depth = slots[np.cumsum(new) - 1], depth + 1

    def _room(self, slots: int) -> None:
        if slots > len(self.check):
            more = max(slots, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate((self.base, np.zeros(more, np.int64)))
            self.check = np.concatenate((self.check, np.full(more, -1, np.int64)))

    def _free(self, many: int) -> np.ndarray:
        """The first free slots."""
        span = 2 * many
        while True:
            self._room(self.used + span)
            found = np.flatnonzero(self.check[self.used : self.used + span] < 0)
            if len(found) >= many:
                return self.used + found[:many]
            span *= 2

    def _place(self, parent: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Slots of new nodes, siblings side by side in ascending order of code."""
        edge = np.flatnonzero(np.concatenate(([True], parent[1:] != parent[:-1], [True])))
        slots = np.empty(len(parent), np.int64)
        alone = np.flatnonzero(np.diff(edge) == 1)
        for k in np.flatnonzero(np.diff(edge) > 1).tolist():
            own = slice(edge[k], edge[k + 1])
            slots[own] = self._fit(int(parent[edge[k]]), code[own])
        if len(alone):
            one = edge[alone]
            free = self._free(len(one))
            slots[one] = free
            self.base[parent[one]], self.check[free] = free - code[one], parent[one]
        free = np.flatnonzero(self.check[self.used :] < 0)
        self.used = self.used + int(free[0]) if len(free) else len(self.check)
        return slots

    def _fit(self, parent: int, codes: np.ndarray) -> np.ndarray:
        """Place siblings at the first base where all are free; after some tries behind everything."""
        shape = codes - codes[0]
        for start in self._free(TRIES).tolist():
            self._room(start + int(shape[-1]) + 1)
            if (self.check[start + shape] < 0).all():
                break
        else:
            start = int(np.flatnonzero(self.check >= 0)[-1]) + 1
            self._room(start + int(shape[-1]) + 1)
        self.base[parent], self.check[start + shape] = start - codes[0], parent
        return start + shape

    def child(self, at: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Slots reached from ``at`` by ``code``."""
        to = self.base[at] + code
        if (to < 0).any() or (to >= len(self.check)).any() or (self.check[to] != at).any():
            raise KeyError("no such path")
        return to

    def walk(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """depth, rows, their nodes there, and the positions of their last turns: level by level."""
        now, at, depth = np.arange(len(self.sizes)), np.zeros(len(self.sizes), np.int64), 0
        while len(now):
            yield depth, now, at, self.begins[now] + depth - 1
            deeper = self.sizes[now] > depth
            now, at = now[deeper], at[deeper]
            at, depth = self.child(at, self.flat[self.begins[now] + depth]), depth + 1


COLUMNS = [
    ("key", pa.binary()), ("parent_key", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
]
NODE = "key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def _key(path: bytes) -> bytes:
    return hashlib.blake2b(path, digest_size=16).digest()


def shard_nodes(paths: list[bytes], n: np.ndarray, least: np.ndarray, ends: list[str], before: int, after: int) -> dict[str, list | np.ndarray]:
    """Nodes of the sorted distinct ``paths``.

    ``before`` and ``after`` are the depths of the deepest nodes shared with the shard
    before and behind, -1 where there is none. Shared nodes have a key and partial
    sums; nodes under a shared parent have its key. Others have neither.
    """
    sizes = np.array([len(p) // TURN for p in paths], np.int64)
    turns = np.frombuffer(b"".join(paths), np.dtype((np.void, TURN)))
    alphabet, flat = np.unique(turns, return_inverse=True)
    words = alphabet.view(np.uint8).reshape(-1, TURN)[:, DIGEST:].astype(np.int64) @ (256 ** np.arange(TURN - DIGEST - 1, -1, -1, dtype=np.int64))
    trie = DoubleArray(flat.astype(np.int64), sizes)
    room = len(trie.check)
    count, small, level = np.zeros(room, np.int64), np.full(room, np.iinfo(np.int64).max), np.full(room, -1, np.int64)
    last, end = np.zeros(room, np.int64), np.full(room, -1, np.int64)
    edges = ([0], [0])  # nodes of the first and of the last path, by depth
    for depth, rows, at, place in trie.walk():
        np.add.at(count, at, n[rows])
        np.minimum.at(small, at, least[rows])
        level[at] = depth
        if depth:
            last[at] = words[trie.flat[place]]
            for row, nodes in zip((0, len(paths) - 1), edges):
                nodes += at[rows == row].tolist()
        stops = sizes[rows] == depth
        end[at[stops]] = rows[stops]
    # Nodes that an earlier shard has too are counted there.
    own = level >= 0
    own[edges[0][: before + 1]] = False
    children, leaves, saved = np.zeros(room, np.int64), np.zeros(room, np.int64), count * last - own * last
    order = np.flatnonzero(level >= 0)
    order = order[np.argsort(-level[order], kind="stable")]
    has_child = np.zeros(room, bool)
    has_child[trie.check[order[level[order] > 0]]] = True
    has_child[edges[1][: after + 1]] = True  # it goes on in the next shard
    leaves[own & ~has_child] = 1
    for nodes in np.split(order, np.flatnonzero(np.diff(level[order])) + 1):
        if level[nodes[0]]:
            np.add.at(children, trie.check[nodes], own[nodes].astype(np.int64))
            np.add.at(leaves, trie.check[nodes], leaves[nodes])
            np.add.at(saved, trie.check[nodes], saved[nodes])
    keys = {}
    for nodes, path, deepest in ((edges[0], paths[0], before), (edges[1], paths[-1], after)):
        for depth in range(deepest + 1):
            keys[nodes[depth]] = _key(path[: depth * TURN])
    order = order.tolist()
    parent = trie.check[order]
    under = [keys.get(p) if v else None for p, v in zip(parent.tolist(), order)]
    return {
        "key": [keys.get(v) for v in order],
        "parent_key": under,
        "conv_id": small[order],
        "depth": level[order],
        "parent_conv_id": [p if u is None and v else None for p, u, v in zip(small[parent].tolist(), under, order)],
        "n_convs": count[order],
        "n_children": children[order],
        "n_leaves": leaves[order],
        "saved_tokens": saved[order],
        "ends_sha256": [ends[e] if e >= 0 else NOTHING for e in end[order].tolist()],
    }


def _shared_depth(a: Column, b: Column) -> Column:
    """Turns that two paths, as hexadecimal digits, begin with in common; -1 without one of them."""
    n = F.least(F.length(a), F.length(b)) / (2 * TURN)
    same = F.filter(
        F.sequence(F.lit(0), F.greatest(n.cast("int") - 1, F.lit(0))),
        lambda i: F.substr(a, i * 2 * TURN + 1, F.lit(2 * TURN)) != F.substr(b, i * 2 * TURN + 1, F.lit(2 * TURN)),
    )
    return F.when(a.isNull() | b.isNull(), F.lit(-1)).otherwise(F.coalesce(F.get(same, F.lit(0)), n.cast("int")))


def _shards(paths: DataFrame, shard_turns: int) -> int:
    turns = paths.agg(F.sum(F.octet_length("path") / TURN + 1)).first()[0]
    return parts_for(paths.sparkSession, int(turns or 0), shard_turns)


def trie_nodes(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Nodes of the trie of (path, n, least, ends), whose paths are distinct."""
    parts = _shards(paths, shard_turns)
    ranged = paths.repartitionByRange(parts, "path").withColumn("shard", F.spark_partition_id())
    ranged = stage(ranged, "shards")
    # One row for each shard; their number is that of the tasks.
    ends = ranged.groupBy("shard").agg(F.hex(F.min("path")).alias("first"), F.hex(F.max("path")).alias("last"))
    order = Window.orderBy("shard")
    ends = ends.withColumn("earlier", F.lag("last").over(order)).withColumn("later", F.lead("first").over(order))
    before, after = _shared_depth(F.col("earlier"), F.col("first")), _shared_depth(F.col("last"), F.col("later"))
    ends = stage(ends.select("shard", before.alias("before"), after.alias("after")), "shard-ends")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def nodes() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held)
            held.clear()
            found = shard_nodes(
                t.column(1).to_pylist(), t.column(2).to_numpy(), t.column(3).to_numpy(), t.column(4).to_pylist(), t.column(5)[0].as_py(), t.column(6)[0].as_py()
            )
            whole = pa.RecordBatch.from_arrays([pa.array(found[c], t) for c, t in COLUMNS], names=[c for c, _ in COLUMNS])
            for a in range(0, whole.num_rows, 10_000):
                yield whole.slice(a, 10_000)

        for batch in batches:
            shard = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)] if len(shard) else []
            for a, b in zip(cuts[:-1], cuts[1:]):
                if held and held[0].column(0)[0].as_py() != shard[a]:
                    yield from nodes()
                held.append(batch.slice(a, b - a))
        if held:
            yield from nodes()

    dealt = ranged.join(ends, "shard").select("shard", "path", "n", "least", "ends", "before", "after")
    dealt = dealt.repartition(parts, "shard").sortWithinPartitions("shard", "path")
    made = stage(dealt.mapInArrow(build, NODE), "nodes")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    # A node ends the conversations of one path, which one shard has.
    some = F.max(F.when(F.col("ends_sha256") != NOTHING, F.col("ends_sha256"))).alias("ends_sha256")
    shared = made.where("key is not null").groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent_key").alias("parent_key"),
        F.max("parent_conv_id").alias("parent_conv_id"), *sums, some,
    )
    shared = stage(shared.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING))), "shared-nodes")
    every = made.where("key is null").unionByName(shared)
    parents = shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("shared_parent"))
    every = join_unique(every, parents, ["parent_key"])
    return every.select(
        "conv_id", "depth", F.coalesce("shared_parent", "parent_conv_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def conversation_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations.

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. A conversation c begins with the
    first crc32(c) % 4 turns of conversation c - c % 20 (% as in SQL) in place of as many
    of its own. Turns are ordered by turn, null first, those with equal turn by a digest
    of role and text; null role or text is empty. Turns are compared by 128-bit digest.
    Rows without conv_id belong to no conversation and are left out; rows repeated whole
    are turns of their own. Other columns are not read; without conversations there is
    no node. The turns of one conversation, 20 bytes each, have to fit a task, their
    texts do not.
    """
    ship(conversations.sparkSession)
    listed = stage(turn_paths(conversations), "turns")
    members = stage(rebuilt(listed), "paths")
    paths = distinct_paths(members, _shards(members, shard_turns))
    return trie_nodes(stage(paths, "distinct-paths"), shard_turns)
