"""Documents linked by the Jaccard similarity of their word shingles, exactly.

Jaccard distance is a metric, and the join partitions by nearest pivots. It has
three levels.

1. Pivots of one shingle. Every document is as near to each of its own shingles
   as to any; the tie goes to the first in a global order that puts widespread
   shingles last. The document at the boundary is copied to its next cells: a
   linked document can lack at most ``n - ceil(t n)`` of its shingles, so one more
   than that many cells bring any two linked documents together, and every cell more
   brings them together in one more. A twentieth of the shingles is added, so that a
   document with few cells that any other has can be linked with none and drops out:
   documents that share a shingle or two by chance, as long ones do, end here. A crowded
   cell is split by the second cell that linked documents share.
   Each cell has a lead, the first of its documents; who shares enough cells with a lead
   belongs to its family, and two such documents need no comparison with each other. So a
   family of near copies costs a row for each document and cell, not for each pair.
   The other pairs of a cell are counted where they are few, and documents that meet in
   enough of such cells belong to one family.
2. In the other cells, pivots that are 64 classes of all shingles, or 1024 for long sets. A document's counts per class give
   its distances to them, and by the triangle inequality the distances of linked
   documents differ by little. Documents of a cell within that window of each
   other belong to one family; a cell gives the edges of a spanning forest only.
   A cell that is crowded even after the split is one family.
3. Pivots that are documents. A family is joined exactly: the ball of a pivot is
   linked to it, and a member of the ball needs no search of its own once all
   within twice the radius are in its component. A family above ``MOST`` members
   or ``MOST_BYTES`` of shingles gets a pivot at once, and each member goes on as
   its difference to the pivot's set: what two differences do not share is what
   the two sets do not share, so distances stay exact and no text is sent again.
   Such a family is cut into the Voronoi regions of further pivots, each with the
   documents that the triangle inequality lets reach over the boundary, again and
   again; documents of a ball that nothing else comes near, and regions that are
   one component already, drop out between the rounds.

Equal sets are joined beforehand and stand for one document. Texts are read twice,
and dealt out once, those of families only. Stages are removed after their last
reader.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathways.functions.skew import join_unique
from pathways.session import release

from .common import Stages, id_and_text, parts_for, ship
from .components import components
from .hashing import mix, shingle_sets, slices

WORDS = 3
PERCENT = 90
CLASSES = 64
# Sets of so many shingles have their classes cut in sixteen: chance hides less of a distance.
LONG = 2_000
FINE = 16 * CLASSES
# Shingles that go last in the order: bounds what is sent to all tasks.
WIDESPREAD = 1 << 17
MOST = 8_000
PIVOT_BATCH = 64
# Largest matrix of a region, in cells of four bytes.
DENSE_CELLS = 1 << 22
MOST_BYTES = 4 << 20
PIVOTS = 8
PART_ROWS = 500
# Bytes of texts that are hashed together; each needs some fifty bytes of memory.
BATCH_BYTES = 1 << 19
# One cell more for so many shingles: linked documents have as many cells more in common.
SPARE = 20
# Bytes of a shingle's hash that name its cell.
CELL = 6
# Pairs of cell and document that are looked at together.
BUCKET = 1 << 20
ROUNDS = 6
MAP_BITS = 1 << 23
# Documents of a cell whose pairs are counted, or twice those that are not of its lead's family;
# of other cells the classes are compared.
LIGHT = 64
MET_PAIRS = 1 << 19


def shared_least(n: int, percent: int) -> int:
    """Cells that two linked sets of ``n`` shingles or more have in common, of those they go to."""
    return min(1 + max(1, n // SPARE), -(-percent * n // 100))


def prefix_length(n: int, percent: int) -> int:
    """Cells that a set of ``n`` shingles goes to."""
    return n - -(-percent * n // 100) + shared_least(n, percent) if n else 0


def class_counts(shingles: np.ndarray) -> bytes:
    """Counts per class modulo 256: around the circle they are never farther apart than the counts."""
    n = FINE if len(shingles) >= LONG else CLASSES
    counts = np.bincount((shingles >> np.uint64(65 - n.bit_length())).astype(np.int64), minlength=n)
    return counts.astype(np.uint8).tobytes()


def _parts(batches: Iterator[pa.RecordBatch], text: int, most: int) -> Iterator[pa.RecordBatch]:
    """Stretches of rows whose texts or bytes, in column ``text``, have ``most`` bytes together, or of one row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False).tolist()
        for a, b in slices(sizes, most):
            yield batch.slice(a, b - a)


def widespread(docs: DataFrame, words: int, most: int, stages: Stages) -> np.ndarray:
    """Sorted shingles met most often, ``most`` of them; the result does not depend on them.

    Only shingles found in three or more different texts of one stretch of rows are counted.
    """

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, 0, 16 * BATCH_BYTES):
            texts = list(dict.fromkeys(batch.column(0).to_pylist()))
            sets = [s for a, b in slices([len(t) for t in texts], BATCH_BYTES) for s in shingle_sets(texts[a:b], words)]
            all_ = np.sort(np.concatenate(sets)) if sets else np.empty(0, np.uint64)
            edge = np.flatnonzero(np.concatenate(([True], all_[1:] != all_[:-1], [True]))) if len(all_) else np.zeros(1, np.int64)
            n = np.diff(edge)
            often = n >= 3
            columns = [pa.array(all_[edge[:-1][often]].view(np.int64)), pa.array(n[often], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["shingle", "n"])

    counts = docs.select("text").mapInArrow(met, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    counts = stages(counts, "widespread")
    # The least count that keeps the number within the bound.
    held, least = 0, None
    for r in counts.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
        held += r["count"]
        if held > most:
            break
        least = r["n"]
    if least is None:
        stages.drop("widespread")
        return np.empty(0, np.uint64)
    found = counts.where(F.col("n") >= least).select("shingle").toArrow()["shingle"].to_numpy()
    stages.drop("widespread")
    return np.sort(found.astype(np.int64).view(np.uint64))


ROW = "doc_id long, hash long, n long, set_id binary, cells binary, counts binary"
# Digests that a task remembers, to send a set's cells once.
REMEMBERED = 200_000


def described(docs: DataFrame, words: int, percent: int, last: np.ndarray) -> DataFrame:
    """doc_id, hash, n, set_id (digest of the set), cells, counts, deal.

    Cells and counts are left out where a task has sent the same set before; such rows
    are dealt anywhere, the others by their set.
    """
    known = docs.sparkSession.sparkContext.broadcast(last)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late, sent, number = known.value, set(), 0
        for batch in _parts(batches, 1, BATCH_BYTES):
            sizes, digests, cells, counts, deal = [], [], [], [], []
            for doc_id, s in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1).to_pylist(), words)):
                digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                sizes.append(len(s))
                digests.append(digest)
                number += 1
                if not len(s) or doc_id is None or digest in sent:
                    cells.append(None)
                    counts.append(None)
                    deal.append(int.from_bytes(digest[:6], "little") + number)
                    continue
                if len(sent) < REMEMBERED:
                    sent.add(digest)
                deal.append(int.from_bytes(digest[:7], "little"))
                counts.append(class_counts(s))
                if len(late):
                    at = np.minimum(np.searchsorted(late, s), len(late) - 1)
                    common = late[at] == s
                    if common.any():
                        s = np.concatenate((s[~common], s[common]))
                own = s[: prefix_length(len(s), percent)]
                cells.append(own.view(np.uint8).reshape(-1, 8)[:, :CELL].tobytes())
            columns = [
                batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                pa.array(cells, pa.binary()), pa.array(counts, pa.binary()), pa.array(deal, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "hash", "n", "set_id", "cells", "counts", "deal"])

    return docs.mapInArrow(describe, f"{ROW}, deal long")


def distinct_sets(rows: DataFrame) -> DataFrame:
    """The described rows; of equal sets one row keeps its cells."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = None
        for batch in batches:
            keep = []
            for digest, full in zip(batch.column(3).to_pylist(), batch.column(4).is_valid().to_pylist()):
                keep.append(full and digest != done)
                if full:
                    done = digest
            mask = pa.array(keep)
            columns = [*batch.columns[:4], *[pc.if_else(mask, batch.column(k), pa.scalar(None, pa.binary())) for k in (4, 5)]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "hash", "n", "set_id", "cells", "counts"])

    return rows.repartition("deal").sortWithinPartitions("set_id", "doc_id", "hash").drop("deal").mapInArrow(first, ROW)


def cell_numbers(cells: bytes) -> np.ndarray:
    wide = np.zeros((len(cells) // CELL, 8), np.uint8)
    wide[:, :CELL] = np.frombuffer(cells, np.uint8).reshape(-1, CELL)
    return wide.view(np.uint64).reshape(-1)


def shared_cells(reps: DataFrame, parts: int, leads: bool = False) -> DataFrame:
    """cell, rep: documents of each cell that has more than one; with ``leads`` also one of them, lead.

    The pairs travel packed: the documents of a batch have neighbouring numbers, so a
    pair takes the bytes of its cell and two more.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep = batch.column(0).to_numpy()
            lists = [cell_numbers(c) for c in batch.column(1).to_pylist()]
            sizes = np.array([len(c) for c in lists])
            high = rep >> 16
            for a, b in slices(sizes.tolist(), BUCKET):
                cell, owner = np.concatenate(lists[a:b]), np.repeat(rep[a:b], sizes[a:b])
                group = (mix(cell.copy()) % np.uint64(parts)).astype(np.int64)
                order = np.lexsort((owner >> 16, group))
                cell, owner, group = cell[order], owner[order], group[order]
                top = owner >> 16
                edge = np.flatnonzero(np.concatenate(([True], (group[1:] != group[:-1]) | (top[1:] != top[:-1]), [True])))
                raw = cell.view(np.uint8).reshape(-1, 8)[:, :CELL]
                low = (owner & 0xFFFF).astype("<u2")
                spans = list(zip(edge[:-1].tolist(), edge[1:].tolist()))
                columns = [
                    pa.array(group[edge[:-1]]), pa.array(top[edge[:-1]]),
                    pa.array([raw[x:y].tobytes() for x, y in spans], pa.binary()), pa.array([low[x:y].tobytes() for x, y in spans], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "high", "cells", "low"])

    packed = reps.select("rep", "cells").mapInArrow(pack, "bucket long, high long, cells binary, low binary")

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of the cells met before, in this lot or an earlier one of the bucket."""
        bucket, lot, held = None, [], 0
        names = ["cell", "rep", "lead"] if leads else ["cell", "rep"]
        seen, first, told = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, bool)

        def emit() -> Iterator[pa.RecordBatch]:
            nonlocal seen, first, told, lot, held
            cell = np.concatenate([c for c, _ in lot])
            rep = np.concatenate([r for _, r in lot])
            lot, held = [], 0
            order = np.lexsort((rep, cell))
            cell, rep = cell[order], rep[order]
            edge = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1], [True])))
            own, count = cell[edge[:-1]], np.diff(edge)
            at = np.minimum(np.searchsorted(seen, own), max(len(seen) - 1, 0))
            old = (seen[at] == own) if len(seen) else np.zeros(len(own), bool)
            again = at[old & ~told[at]] if len(seen) else at[:0]
            many = old | (count > 1)
            take = np.repeat(many, count)
            lead = np.where(old, first[at], rep[edge[:-1]]) if len(seen) else rep[edge[:-1]]
            out_cell, out_rep = np.concatenate((seen[again], cell[take])), np.concatenate((first[again], rep[take]))
            out_lead = np.concatenate((first[again], np.repeat(lead, count)[take]))
            if len(again):
                told[again] = True
            fresh = ~old
            merged = np.concatenate((seen, own[fresh]))
            place = np.argsort(merged, kind="stable")
            seen = merged[place]
            first = np.concatenate((first, rep[edge[:-1]][fresh]))[place]
            told = np.concatenate((told, many[fresh]))[place]
            if len(out_cell):
                yield pa.RecordBatch.from_arrays([pa.array(out_cell.view(np.int64)), pa.array(out_rep), pa.array(out_lead)][: len(names)], names=names)

        for batch in batches:
            for own, high, cells, low in zip(*(c.to_pylist() for c in batch.columns)):
                if own != bucket:
                    if lot:
                        yield from emit()
                    bucket = own
                    seen, first, told = seen[:0], first[:0], told[:0]
                lot.append((cell_numbers(cells), np.frombuffer(low, "<u2").astype(np.int64) | (high << 16)))
                held += len(low) // 2
                if held >= 2 * BUCKET:
                    yield from emit()
        if lot:
            yield from emit()

    dealt = packed.repartition(parts, "bucket").sortWithinPartitions("bucket", "high")
    return dealt.mapInArrow(several, "cell long, rep long" + ", lead long" * leads)


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[list]]:
    """Columns of each run of rows with equal leading keys, of a sorted partition."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for c in range(keys):
            v = batch.column(c).to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            own = tuple(batch.column(c)[a].as_py() for c in range(keys))
            if own != key and held:
                yield pa.Table.from_batches(held)
                held = []
            key = own
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def forest(reps: np.ndarray, sizes: np.ndarray, counts: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Spanning forest of the documents whose sizes and class counts allow a link."""
    edges = []
    left = np.arange(len(reps))
    long = np.array([len(c) > CLASSES for c in counts], bool)
    fine_at = np.cumsum(long) - 1
    fine = np.frombuffer(b"".join(c for c in counts if len(c) > CLASSES), np.uint8).reshape(-1, FINE)
    coarse = np.empty((len(reps), CLASSES), np.int16)
    coarse[long] = fine.reshape(-1, CLASSES, FINE // CLASSES).sum(2) & 0xFF
    coarse[~long] = np.frombuffer(b"".join(c for c in counts if len(c) == CLASSES), np.uint8).reshape(-1, CLASSES)

    def near_enough(counts: np.ndarray, own: np.ndarray, total: np.ndarray) -> np.ndarray:
        """The symmetric difference of linked sets is a small part of their sizes."""
        apart = (counts.astype(np.int16) - own) & 0xFF
        return (100 + percent) * np.minimum(apart, 256 - apart).sum(1) <= (100 - percent) * total

    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            p = queue.pop()
            n, m = sizes[p], sizes[left]
            near = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
            at = np.flatnonzero(near)
            if len(at):
                at = at[near_enough(coarse[left[at]], coarse[p], n + m[at])]
            if len(at) and long[p]:
                both = np.flatnonzero(long[left[at]])
                far = ~near_enough(fine[fine_at[left[at[both]]]], fine[fine_at[p]].astype(np.int16), n + m[at[both]])
                at = np.delete(at, both[far])
            if len(at):
                edges += [(int(reps[p]), int(reps[q])) for q in left[at]]
                queue += left[at].tolist()
                left = np.delete(left, at)
    return edges


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of whole runs of rows with equal values in the first one, of a sorted partition."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        last = int(np.searchsorted(columns[0], columns[0][-1]))  # the last run may go on
        if held and (last or held[-1][0][-1] != columns[0][0]):
            ended = last if last else 0
            yield [np.concatenate(c) for c in zip(*held, [c[:ended] for c in columns])]
            held = []
        elif last:
            yield [c[:last] for c in columns]
        held.append([c[last:] for c in columns])
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def _edges_of_runs(key: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))


HELD = "cell long, rep long, need long, lead long, joined long, together long"
OPEN = "cell long, rep long, need long, lead long, joined long"


def with_enough(pairs: DataFrame) -> DataFrame:
    """The rows of HELD of the documents that have enough shared cells to be linked with any other.

    A document linked with another has ``need`` cells in common with it. Those with fewer
    go. ``together`` is the number of cells that the document has in common with the lead of
    the cell, as their lead; -1 for the lead itself. A row with a negative lead tells a
    document's need only.
    """
    names = [c.split()[0] for c in HELD.split(", ")]

    def enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rep, cell, need, lead, joined in _runs(batches):
            edge = _edges_of_runs(rep)
            least = np.repeat(np.maximum.reduceat(need, edge[:-1]), np.diff(edge))
            in_cell = lead >= 0
            held = np.repeat(np.add.reduceat(in_cell.astype(np.int64), edge[:-1]), np.diff(edge))
            keep = np.flatnonzero(in_cell & (held >= least) & (least > 0))
            if not len(keep):
                continue
            keep = keep[np.lexsort((lead[keep], rep[keep]))]
            rep, cell, need, lead, joined = rep[keep], cell[keep], least[keep], lead[keep], joined[keep]
            runs = np.flatnonzero(np.concatenate(([True], (rep[1:] != rep[:-1]) | (lead[1:] != lead[:-1]), [True])))
            together = np.where(rep == lead, -1, np.repeat(np.diff(runs), np.diff(runs)))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (cell, rep, need, lead, joined, together)], names=names)

    rows = pairs.select("rep", "cell", "need", "lead", "joined")
    return rows.repartition("rep").sortWithinPartitions("rep").mapInArrow(enough, HELD)


def still_open(held: DataFrame, bit: int) -> DataFrame:
    """The rows of the cells that have documents of more than their lead's family; the lead is the first of the others.

    ``bit`` is set in ``joined`` where a document has enough cells in common with the lead, or is
    it: two documents of a cell with the same bit are of one family.
    """
    names = [c.split()[0] for c in OPEN.split(", ")]

    def unlike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, rep, need, joined, together in _runs(batches):
            edge = _edges_of_runs(cell)
            size = np.diff(edge)
            # Without its lead no document of a cell is joined.
            of_lead = np.repeat(np.maximum.reduceat(np.where(together < 0, need, 0), edge[:-1]), size)
            own = (of_lead > 0) & ((together < 0) | (together >= np.maximum(need, of_lead)))
            joined = joined | np.where(own, bit, 0)
            one = np.bitwise_and.reduceat(joined, edge[:-1]) > 0
            lead = np.repeat(np.minimum.reduceat(np.where(own, np.iinfo(np.int64).max, rep), edge[:-1]), size)
            take = np.repeat((size > 1) & ~one, size)
            if take.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[take]) for c in (cell, rep, need, lead, joined)], names=names)

    rows = held.select("cell", "rep", "need", "joined", "together")
    return rows.repartition("cell").sortWithinPartitions("cell", "rep").mapInArrow(unlike, OPEN)


def candidates(pairs: DataFrame, reps: DataFrame, percent: int, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """Rows of OPEN that are to be compared yet, and a, b: documents that share enough cells with the lead of a cell.

    The need of a document is ``shared_least``, counted for the smallest set it can be linked with.
    """
    ceiling = lambda n: F.floor((percent * n + 99) / 100)
    smallest = ceiling(F.col("n"))
    need = F.least(1 + F.greatest(F.lit(1), F.floor(smallest / SPARE)), ceiling(smallest))
    none = F.lit(0).cast("long")
    sizes = reps.select("rep", need.cast("long").alias("need"))
    rows = pairs.select("cell", "rep", "lead", none.alias("need"), none.alias("joined"))
    rows = rows.unionByName(sizes.select(none.alias("cell"), "rep", F.lit(-1).cast("long").alias("lead"), "need", none.alias("joined")))
    of_leads = []
    for bit in (1, 2):  # a second time for what is left, with other leads
        held = stages(with_enough(rows), f"held-{bit}")
        stages.drop("cells", "open-1")
        found = held.where("together >= need").select("rep", F.col("lead").alias("a"), "together").distinct()
        found = join_unique(found, sizes.withColumnRenamed("rep", "a"), ["a"], "inner").where("together >= need")
        of_leads.append(stages(found.select("a", F.col("rep").alias("b")), f"lead-edges-{bit}"))
        rows = stages(still_open(held, bit), f"open-{bit}")
        stages.drop(f"held-{bit}")
        release(reps.sparkSession)
    return rows, of_leads[0].unionByName(of_leads[1])


def met_often(pairs: DataFrame) -> DataFrame:
    """a, b: documents that share enough cells in which the documents to be compared are few.

    Every two documents of such a cell that are not both of its lead's family are counted
    once; the counts of a pair are added up.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "k", "need"]

        def added(a: np.ndarray, b: np.ndarray, least: np.ndarray) -> pa.RecordBatch:
            order = np.lexsort((b, a))
            a, b, least = a[order], b[order], least[order]
            first = np.flatnonzero(np.concatenate((np.ones(min(len(a), 1), bool), (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
            k = np.diff(np.append(first, len(a)))
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (a[first], b[first], k, least[first])], names=names)

        for cell, rep, need, joined in _runs(batches):
            edge = _edges_of_runs(cell)
            begins, sizes = edge[:-1], np.diff(edge)
            for d in np.unique(sizes[(sizes > 1) & (sizes <= LIGHT)]).tolist():
                i, j = np.triu_indices(d, 1)
                every = begins[sizes == d]
                step = max(1, MET_PAIRS // len(i))
                for at in range(0, len(every), step):
                    place = every[at : at + step, None] + np.arange(d)
                    r, m, f = rep[place], need[place], joined[place]
                    apart = ((f[:, i] & f[:, j]) == 0).ravel()
                    if apart.any():
                        yield added(r[:, i].ravel()[apart], r[:, j].ravel()[apart], np.maximum(m[:, i], m[:, j]).ravel()[apart])
            for begin, d in zip(begins[sizes > LIGHT].tolist(), sizes[sizes > LIGHT].tolist()):
                r, m, f = (c[begin : begin + d] for c in (rep, need, joined))
                of_lead = max(((f & bit) > 0 for bit in (1, 2)), key=np.count_nonzero)
                others = np.flatnonzero(~of_lead)
                if len(others) > LIGHT // 2:
                    continue
                for x in others.tolist():
                    with_ = np.flatnonzero(((f & f[x]) == 0) & (of_lead | (np.arange(d) > x)))
                    yield added(np.minimum(r[x], r[with_]), np.maximum(r[x], r[with_]), np.maximum(m[x], m[with_]))

    dealt = pairs.select("cell", "rep", "need", "joined").repartition("cell").sortWithinPartitions("cell", "rep")
    met = dealt.mapInArrow(meet, "a long, b long, k long, need long")
    return met.groupBy("a", "b").agg(F.sum("k").alias("k"), F.max("need").alias("need")).where("k >= need").select("a", "b")


def family_edges(reps: DataFrame, pairs: DataFrame, most: int, percent: int, stages: Stages) -> DataFrame:
    """a, b: documents that share a cell and may be linked; families are the components."""
    pairs, of_leads = candidates(pairs, reps, percent, stages)

    def crowded(rows: DataFrame) -> DataFrame:
        return rows.groupBy("cell").agg(F.count(F.lit(1)).alias("members"), F.min("rep").alias("least"), F.min("need").alias("need")).where(F.col("members") > most)

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for g in _groups(batches, 1):
            if g.num_rows < 2:
                continue
            ids = g.column(1).to_numpy()
            new = [e for e in forest(ids, g.column(2).to_numpy(), g.column(3).to_pylist(), percent) if e not in seen]
            if len(seen) < 1_000_000:
                seen.update(new)
            if new:
                columns = [pa.array(c, pa.int64()) for c in zip(*new)]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    def of_cells(rows: DataFrame) -> DataFrame:
        rows = join_unique(rows.select("cell", "rep"), reps.select("rep", "n", "counts"), ["rep"], "inner")
        dealt = rows.select("cell", "rep", "n", "counts").repartition("cell").sortWithinPartitions("cell", "rep")
        return dealt.mapInArrow(edges, "a long, b long")

    # Linked documents have enough cells in common; those that have all few documents to compare are counted.
    often = stages(met_often(pairs).unionByName(of_leads), "met-edges")
    n, of_lead = F.count(F.lit(1)), [F.sum((F.col("joined").bitwiseAND(bit) > 0).cast("long")) for bit in (1, 2)]
    many = pairs.groupBy("cell").agg(n.alias("n"), F.greatest(*of_lead).alias("of_lead"))
    many = many.where((F.col("n") > LIGHT) & (F.col("n") - F.col("of_lead") > LIGHT // 2)).select("cell")
    release(reps.sparkSession)
    left = pairs
    pairs = stages(join_unique(pairs, stages(many, "many"), ["cell"], "left_semi"), "heavy-cells")
    hot = stages(crowded(pairs), "crowded")
    if not hot.take(1):
        return of_cells(pairs).unionByName(often).distinct()
    usual = of_cells(join_unique(pairs, hot.select("cell"), ["cell"], "left_anti"))

    rows = join_unique(pairs, hot.select("cell", "least", F.col("need").alias("least_need")), ["cell"], "inner")
    # A set so small that one cell may be all it shares: its cell is one family.
    alone = rows.where("least_need < 2 and rep <> least").select(F.col("rep").alias("a"), F.col("least").alias("b"))
    # Linked documents share a second one of the cells that are left; two crowded ones split each other once.
    others = left.select("cell", "rep").join(hot.select("cell", F.lit(True).alias("hot")), "cell", "left").select("rep", F.col("cell").alias("other"), "hot")
    rows = rows.where("least_need > 1").select("cell", "rep").join(others, "rep").where("hot is null and other <> cell or other > cell")
    finer = stages(rows.select(F.xxhash64("cell", "other").alias("cell"), "rep"), "split-cells")
    still = stages(crowded(finer.withColumn("need", F.lit(2))), "still-crowded")
    several = finer.groupBy("cell").agg(F.count(F.lit(1)).alias("members")).where(F.col("members").between(2, most)).select("cell")
    split_up = of_cells(join_unique(finer, several, ["cell"], "inner"))
    as_one = join_unique(finer, still.select("cell", "least"), ["cell"], "inner").where("rep <> least").select(F.col("rep").alias("a"), F.col("least").alias("b"))
    return often.unionByName(usual).unionByName(split_up).unionByName(as_one).unionByName(alone).distinct()


class Sets:
    """Sets of a region; counts how many shingles some of them share with all.

    With ``sizes`` the lists are the sets' differences to one other set, and what two of
    them share follows from the sizes. Shingles of one list only can be shared by none and are left out. Where the
    others are few, sets are rows of a matrix of zeros and ones, and a matrix
    product counts; else lists of the sets of each shingle are added up.
    """

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray | None = None):
        self.lengths = np.array([len(s) for s in sets], np.int64)
        self.sizes = self.lengths if sizes is None else sizes
        owner = np.repeat(np.arange(len(sets)), self.lengths)
        _, shingle, self.times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        self.owner, self.shingle, self.matrix = owner, shingle, None

    def prepare(self) -> None:
        often = self.times[self.shingle] > 1
        number = np.cumsum(self.times > 1) - 1
        owner, column = self.owner[often], number[self.shingle[often]]
        n, width = len(self.sizes), int((self.times > 1).sum())
        if n * width <= DENSE_CELLS:
            self.matrix = np.zeros((n, width), np.float32)
            self.matrix[owner, column] = 1
            return
        self.columns = np.split(column, np.cumsum(np.bincount(owner, minlength=n))[:-1])
        order = np.argsort(column, kind="stable")
        self.holders, self.held = owner[order], np.bincount(column, minlength=width)
        self.begins = np.cumsum(self.held) - self.held

    def shared(self, some: np.ndarray) -> np.ndarray:
        """Shingles that each of ``some`` shares with every set."""
        met = self._met(some)
        if self.sizes is self.lengths:
            return met
        apart = self.lengths[some][:, None] + self.lengths - 2 * met
        return (self.sizes[some][:, None] + self.sizes - apart) // 2

    def _met(self, some: np.ndarray) -> np.ndarray:
        if self.matrix is not None:
            return (self.matrix[some] @ self.matrix.T).astype(np.int64)
        out = np.zeros((len(some), len(self.sizes)), np.int64)
        for row, p in zip(out, some):
            held = self.held[self.columns[p]]
            jump = np.repeat(self.begins[self.columns[p]] - np.cumsum(held) + held, held)
            row[:] = np.bincount(self.holders[jump + np.arange(len(jump))], minlength=len(row))
        return out


def near_parts(all_: Sets, percent: int) -> np.ndarray:
    """For each set the first set of its part; linked sets are in one part.

    The shingles that are rarest in the region come first here, so near copies
    that differ in too many places share none of those that count.
    """
    n, shingle, times = len(all_.sizes), all_.shingle, all_.times
    owner = all_.owner
    order = np.lexsort((shingle, times[shingle], owner))
    place = np.arange(len(order)) - (np.cumsum(all_.sizes) - all_.sizes)[owner]
    cells = all_.sizes - -(-percent * all_.sizes // 100) + 1
    own = order[place < cells[owner]]
    own = own[times[shingle[own]] > 1]
    part = np.arange(n)
    if not len(own):
        return part
    own = own[np.argsort(shingle[own], kind="stable")]
    doc, cell = owner[own], shingle[own]
    heads = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    sizes = np.diff(np.append(heads, len(cell)))
    while True:
        least = np.repeat(np.minimum.reduceat(part[doc], heads), sizes)
        new = part.copy()
        np.minimum.at(new, doc, least)
        np.minimum.at(new, part[doc], least)
        new = new[new]
        if (new == part).all():
            return part
        part = new


def linked_groups(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set of a region the first set of its component. No set is empty."""
    part = near_parts(Sets(sets), percent)
    group = np.arange(len(sets))
    order = np.argsort(part, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
        if len(own) > 1:
            group[own] = own[_balls([sets[i] for i in own], percent)]
    return group


def _balls(sets: list[np.ndarray], percent: int, sizes: np.ndarray | None = None) -> np.ndarray:
    """Components by pivots: each search links a pivot's ball, a batch of pivots at a time."""
    all_ = Sets(sets, sizes)
    all_.prepare()
    n = len(sets)
    group = np.arange(n)
    radius = (100 - percent) / 100
    open_ = np.ones(n, bool)
    rings: list[tuple[np.ndarray, np.ndarray, int]] = []
    size = 1
    while True:
        # Whoever a member of a ball is linked to lies within twice the radius of its pivot.
        for ball, ring, p in rings:
            if (group[ring] == group[p]).all():
                open_[ball] = False
        rings = [r for r in rings if open_[r[0]].any()]
        left = np.flatnonzero(open_)
        if not len(left):
            return group
        batch = left[:size]
        size = min(4 * size, PIVOT_BATCH)
        shared = all_.shared(batch)
        union = all_.sizes + all_.sizes[batch][:, None] - shared
        linked = 100 * shared >= percent * union
        near = ((1 - shared / union) <= 2 * radius + 1e-9) & ~linked
        for p, own, around in zip(batch.tolist(), linked, near):
            ball = np.flatnonzero(own)
            roots = np.unique(group[ball])
            if len(roots) > 1:
                group[np.isin(group, roots)] = roots[0]
            if len(ball) > 1:
                rings.append((ball, np.flatnonzero(around), p))
        open_[batch] = False


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What only one of two sorted sets has, sorted."""
    both = np.sort(np.concatenate((a, b)), kind="stable")
    twice = np.concatenate(([False], both[1:] == both[:-1]))
    twice[:-1] |= twice[1:]
    return both[~twice]


def perhaps_in(base: DataFrame, members: DataFrame) -> DataFrame:
    """The rows of ``base`` but for most of those that are no members: fewer texts are dealt out.

    The members' hashes set bits of one map of MAP_BITS, a megabyte at any size of the
    tables, which is sent to all tasks.
    """
    bit = F.pmod(F.xxhash64("doc_id", "hash"), F.lit(MAP_BITS)) + 1
    maps = members.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("_bucket"))
    maps = maps.agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("_bits"))
    marked = base.withColumn("_bit", bit).withColumn("_bucket", F.bitmap_bucket_number("_bit"))
    at = F.bitmap_bit_position("_bit")
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.expr("shiftright(_byte, int(bitmap_bit_position(_bit) % 8)) % 2 = 1")
    return marked.join(F.broadcast(maps), "_bucket").withColumn("_byte", byte).where(is_set).select(*base.columns)


def family_rows(base: DataFrame, rows: DataFrame, families: DataFrame, most: int, most_bytes: int, stages: Stages) -> DataFrame:
    """region, part, kind, rep, whole, text: each text of a family once, that of a large one's pivot in every part."""
    members = families.join(rows.where("cells is not null").select("rep", "doc_id", "hash", "n"), "rep")
    members = stages(members.withColumn("h", F.xxhash64("rep")), "members")
    size = members.groupBy("region").agg(
        F.count(F.lit(1)).alias("members"), (8 * F.sum("n")).alias("bytes"), F.min(F.struct("h", "rep"))["rep"].alias("pivot")
    )
    whole = (F.col("members") <= most) & (F.col("bytes") <= most_bytes) | (F.col("members") <= 2)
    parts = F.when(whole, 1).otherwise(F.greatest(F.ceil(F.col("members") / PART_ROWS), F.ceil(2 * F.col("bytes") / most_bytes)))
    size = stages(size.select("region", "pivot", whole.alias("whole"), parts.alias("parts")), "family-sizes")
    placed = join_unique(members, size, ["region"], "inner")
    leads = ~F.col("whole") & (F.col("rep") == F.col("pivot"))
    each = F.when(leads, F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).otherwise(F.array(F.pmod("h", "parts")))
    kind = F.when(leads, 0).otherwise(1).alias("kind")
    # Written first: where the families are few they are sent to the texts, which stay in their tasks.
    placed = stages(placed.select("region", "rep", "whole", kind, each.alias("each"), "doc_id", "hash"), "placed")
    found = join_unique(perhaps_in(base, placed), placed, ["doc_id", "hash"], "inner")
    return found.select("region", F.explode("each").alias("part"), "kind", "rep", "whole", "text")


def _with_sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple]:
    """region, part, rep, whole and the set of each row; few texts at a time."""
    for batch in _parts(batches, 5, BATCH_BYTES):
        sets = shingle_sets(batch.column(5).to_pylist(), words)
        yield from zip(*(batch.column(k).to_pylist() for k in (0, 1, 3, 4)), sets)


def joined_families(dealt: DataFrame, words: int, percent: int) -> DataFrame:
    """region, a, b, n, diff: links of the small families; of large ones each document's difference to the pivot.

    Rows that repeat a document follow each other and count once.
    """
    names = ["region", "a", "b", "n", "diff"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pivot, ids, sets, out, held = None, None, [], [], [], 0

        def links() -> None:
            if len(ids) > 1:
                found = np.array(ids)
                group = linked_groups(sets, percent)
                out.extend((key[0], a, b, None, None) for a, b in zip(found.tolist(), found[group].tolist()) if a != b)
            ids.clear()
            sets.clear()

        for region, part, rep, whole, s in _with_sets(batches, words):
            if key != (region, part):
                links()
                key, pivot, before = (region, part), None, None
            if rep == before:
                continue
            before = rep
            if whole:
                ids.append(rep)
                sets.append(s)
                continue
            if pivot is None:  # the pivot leads every part; one of them sends it on
                pivot = s
                if part:
                    continue
            diff = difference(s, pivot).tobytes()
            out.append((region, rep, None, len(s), diff))
            held += len(diff)
            if held > 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                out.clear()
                held = 0
        links()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    order = ["region", "part", "kind", "rep"]
    dealt = dealt.repartition("region", "part").sortWithinPartitions(*order)
    return dealt.mapInArrow(join, "region long, a long, b long, n long, diff binary")


def regions_joined(members: DataFrame, percent: int) -> DataFrame:
    """a, b: links within each region of (region, rep, n, diff)."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, 1):
            ids = g.column(1).to_numpy()
            lists = [np.frombuffer(d, np.uint64) for d in g.column(3).to_pylist()]
            group = _balls(lists, percent, g.column(2).to_numpy())
            moved = group != np.arange(len(ids))
            columns = [pa.array(ids[moved], pa.int64()), pa.array(ids[group[moved]], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    dealt = members.select("region", "rep", "n", "diff").repartition("region").sortWithinPartitions("region", "rep")
    return dealt.mapInArrow(join, "a long, b long")


CUT = "parent long, k long, rep long, n long, diff binary, linked boolean, near boolean"


def voronoi(members: DataFrame, percent: int, pivots: int) -> DataFrame:
    """Cut regions (region, rep, n, diff, members) by some of their documents.

    A row appears for its nearest pivot ``k`` and for each that is no more than twice
    the radius farther; ``linked`` tells that it is linked to that pivot, ``near`` that
    it is not but lies within twice the radius. A large region is dealt in parts, each
    led by its pivots.
    """
    members = members.withColumn("h", F.xxhash64("rep"))
    own = F.struct("h", "rep")
    every = F.greatest(F.floor(F.col("members") / (8 * pivots)), F.lit(1))
    some = F.collect_set(F.when(F.pmod("h", every) == 0, own))  # about eight for each pivot
    ranked = members.groupBy("region").agg(some.alias("some"), F.min(own).alias("first"), F.ceil(F.max("members") / PART_ROWS).alias("parts"))
    pick = F.slice(F.sort_array(F.array_union("some", F.array("first"))), 1, pivots)
    each = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    chosen = ranked.select("region", F.explode(pick).alias("p"), each.alias("each")).select("region", F.col("p.rep").alias("rep"), "each")
    rows = members.select("region", F.pmod("h", F.ceil(F.col("members") / PART_ROWS)).alias("part"), F.lit(1).alias("kind"), "rep", "n", "diff")
    leaders = join_unique(members, chosen, ["region", "rep"], "inner").select("region", F.explode("each").alias("part"), F.lit(0).alias("kind"), "rep", "n", "diff")
    dealt = rows.unionByName(leaders).repartition("region", "part").sortWithinPartitions("region", "part", "kind", "rep")
    radius = (100 - percent) / 100

    names = [c.split()[0] for c in CUT.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_(), pa.bool_()]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, sizes, sets = None, [], [], []
        for batch in _parts(batches, 5, 1 << 20):
            out, held = [], 0
            for region, part, kind, rep, n, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (region, part):
                    key, ids, sizes, sets = (region, part), [], [], []
                diff = np.frombuffer(raw, np.uint64)
                if not kind:
                    ids.append(rep)
                    sizes.append(n)
                    sets.append(diff)
                    continue
                met = np.array([np.isin(diff, s, assume_unique=True).sum() for s in sets])
                apart = len(diff) + np.array([len(s) for s in sets]) - 2 * met
                total = n + np.array(sizes)
                shared, union = (total - apart) // 2, (total + apart) // 2
                far = 1 - shared / union
                linked = 100 * shared >= percent * union
                for k in np.flatnonzero(far <= far.min() + 2 * radius + 1e-9).tolist():
                    near = not linked[k] and far[k] <= 2 * radius + 1e-9
                    out.append((region, ids[k], rep, n, raw, bool(linked[k]), bool(near)))
                    held += len(raw)
                if held > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return dealt.mapInArrow(assign, CUT).withColumn("region", F.xxhash64("parent", "k"))


def large_components(members: DataFrame, percent: int, most: int, most_bytes: int, pivots: int, stages: Stages) -> DataFrame:
    """a, b: edges whose components are those of the links within the large families."""
    found = members.select(F.col("rep").alias("a"), F.col("rep").alias("b")).limit(0)
    for round_ in count():
        size = members.groupBy("region").agg(F.count(F.lit(1)).alias("members"), F.sum(F.octet_length("diff")).alias("bytes"))
        size = stages(size, f"sizes-{round_}")
        over = ((F.col("members") > most) | (F.col("bytes") > most_bytes)) & (F.col("members") > 2)
        small = join_unique(members, size.where(~over).select("region"), ["region"], "left_semi")
        found = stages(found.unionByName(regions_joined(small, percent)), f"found-{round_}a")
        rows = join_unique(members, size.where(over), ["region"], "inner")
        n_rows = size.where(over).agg(F.sum("members")).first()[0]
        if not n_rows:
            return found
        cut = stages(voronoi(rows.drop("bytes"), percent, pivots), f"cut-{round_}")
        found = stages(found.unionByName(cut.where("linked").select(F.col("rep").alias("a"), F.col("k").alias("b"))), f"found-{round_}b")
        # A ball that nothing outside it comes near is done, wherever its members lie.
        alone = cut.groupBy("region").agg(F.bool_or("near").alias("near")).where("not near").select("region")
        done = join_unique(cut.where("linked"), alone, ["region"], "left_semi").select("parent", "rep").distinct()
        left = join_unique(cut, done, ["parent", "rep"], "left_anti")
        # So is a region that is one component already.
        joined = components(found).select(F.col("node").alias("rep"), "component")
        known = join_unique(left.select("region", "rep"), joined, ["rep"]).withColumn("component", F.coalesce("component", "rep"))
        open_ = known.groupBy("region").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("region")
        members = stages(join_unique(left, open_, ["region"], "left_semi").select("region", "parent", "rep", "n", "diff"), f"open-{round_}")
        stages.drop(f"cut-{round_}", f"found-{round_}a", f"open-{round_ - 1}", f"found-{round_ - 1}b", f"sizes-{round_}")
        if round_ >= ROUNDS or members.count() > 1.5 * n_rows:
            # Regions too tight for the windows to cut: every pair of their blocks once.
            members = members.select(F.col("parent").alias("region"), "rep", "n", "diff").dropDuplicates(["region", "rep"])
            size = members.groupBy("region").agg(F.count(F.lit(1)).alias("members"), F.sum(F.octet_length("diff")).alias("bytes"))
            rows = join_unique(members, size, ["region"], "inner")
            blocks = F.greatest(F.ceil(2 * F.col("members") / most), F.ceil(2 * F.col("bytes") / most_bytes), F.lit(1))
            rows = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
            rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            region = F.xxhash64("region", F.least("block", "other"), F.greatest("block", "other"))
            return found.unionByName(regions_joined(rows.withColumn("region", region), percent))
        members = members.drop("parent")


def jaccard_components(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, most: int = MOST, most_bytes: int = MOST_BYTES,
    pivots: int = PIVOTS, last: int = WIDESPREAD,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Documents link when ``100 * |A & B| >= percent * |A | B|``; component_id is
    the smallest doc_id reachable by links. Shingles and sets are compared by their
    64-bit hash. A document without words, or a null text, is linked with nothing
    and is its own component; each of the rows that repeat a doc_id with other words
    belongs to the component of its own words. A row without doc_id is linked with
    nothing and has a null component_id. Other columns are not read; an empty table
    gives no rows.
    """
    found = _components(docs, words, percent, most, most_bytes, pivots, last)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _components(docs: DataFrame, words: int, percent: int, most: int, most_bytes: int, pivots: int, last: int) -> DataFrame:
    """doc_id, hash of the text, n, component (null without words or doc_id), component_id."""
    spark = docs.sparkSession
    ship(spark)
    stages = Stages(spark)
    base = id_and_text(docs).select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("hash"))
    rows = distinct_sets(described(base, words, percent, widespread(base, words, last, stages)))
    # The number of a set: that of the row that has its cells.
    rep = F.when(F.col("cells").isNotNull(), F.monotonically_increasing_id())
    rows = stages(rows.withColumn("rep", rep), "rows")
    reps = rows.where("cells is not null").select("rep", "n", "cells", "counts")
    pairs = reps.agg(F.sum(F.octet_length("cells") / CELL)).first()[0] or 0
    pairs = stages(shared_cells(reps, parts_for(spark, int(pairs), BUCKET), leads=True), "cells")
    release(spark)
    families = components(stages(family_edges(reps, pairs, most, percent, stages), "family-edges"))
    families = families.select(F.col("node").alias("rep"), F.col("component").alias("region"))
    stages.drop("lead-edges-1", "lead-edges-2", "open-2", "met-edges", "many", "heavy-cells", "crowded", "split-cells", "still-crowded", "family-edges")
    release(spark)
    dealt = family_rows(base, rows, families, most, most_bytes, stages)
    joined = stages(joined_families(dealt, words, percent), "joined")
    stages.drop("members", "family-sizes", "placed")
    release(spark)
    edges = joined.where("b is not null").select("a", "b")
    large = joined.where("b is null").select("region", F.col("a").alias("rep"), "n", "diff")
    if large.take(1):
        edges = edges.unionByName(large_components(large, percent, most, most_bytes, pivots, stages))
    linked = components(edges).select(F.col("node").alias("rep"), "component")
    sets = rows.where("cells is not null").select("set_id", "rep").join(linked, "rep", "left")
    sets = sets.select("set_id", F.coalesce("component", "rep").alias("component"))
    every = join_unique(rows.select("doc_id", "hash", "n", "set_id"), sets, ["set_id"], "left")
    every = every.withColumn("component", F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("component")))
    every = stages(every.drop("set_id"), "linked")
    least = every.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    found = join_unique(every, least, ["component"], "left")
    found = Stages(spark)(found.select("doc_id", "hash", "n", "component", F.coalesce("component_id", "doc_id").alias("component_id")), "jaccard")
    stages.clear()
    return found


def one_of_each(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, most: int = MOST, most_bytes: int = MOST_BYTES,
    pivots: int = PIVOTS, last: int = WIDESPREAD,
) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component stays.

    A document is a doc_id with one text; rows that repeat it whole stay together, and
    so do rows without doc_id.
    """
    found = _components(docs, words, percent, most, most_bytes, pivots, last)
    first = found.where("component is not null").groupBy("component").agg(F.min(F.struct("doc_id", "hash")).alias("d")).select("d.doc_id", "d.hash")
    keep = first.unionByName(found.where("component is null and doc_id is not null").select("doc_id", "hash").distinct())
    keep = keep.select(F.col("doc_id").alias("_keep"), F.col("hash").alias("_hash"))
    same = (docs["doc_id"] == keep["_keep"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == keep["_hash"])
    return docs.join(keep, same, "left_semi").unionByName(docs.where("doc_id is null"))
