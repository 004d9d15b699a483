"""Best-fit packing of documents into fixed-length token sequences by bin
completion.

1. Every document becomes its ids plus the end id.  A document longer than the
   capacity is cut into capacity-sized pieces whose first may be shorter.  One
   ``mapInArrow`` pass emits a row per piece (no ids leave the task, only their
   CRC); the rows are written once to the checkpoint folder.
2. The packing problem depends on the lengths alone, so it is solved on their
   histogram: at most ``capacity`` counts reach the driver, whatever the input.
   ``pack_lengths`` keeps a best-fit-decreasing packing as the incumbent and
   improves it by bin completion: take the largest remaining length, enumerate
   the undominated fillings of the rest of its bin, apply each as often as the
   counts allow, and prune where the waste already made exceeds what a better
   packing may waste.  It stops when the incumbent meets the lower bound or the
   node budget, which grows with the number of distinct lengths, is used up (the
   incumbent then stands: every piece is packed).
3. The solution is a list of patterns with multiplicities.  The pieces of one
   length are numbered by per-bucket counts and a running sum over them (a hot
   length is spread over all buckets), and each task turns (length, number)
   into (sequence, offset) by a range lookup in the slot list, which has at
   most ``4 * capacity`` patterns of at most ``sqrt(2 * capacity)`` lengths.

Nulls: a null text is an empty document (the end id alone); a null doc_id is
kept.  Repeated rows are packed as separate documents, ties in length are
broken by id and piece, an empty table gives an empty result, and extra columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import bpe
from tessera.llm.common import require, text_or_empty
from tessera.session import materialize

CAPACITY = 2048
END_ID = 0
NODES = 2000            # search nodes of bin completion at least
NODES_PER_LENGTH = 12   # and per distinct length: a full descent takes about one per length
FILLINGS = 6            # undominated fillings tried at a node
STEPS = 50              # steps per wanted filling that enumerate them
FOUND = 4               # fillings per wanted one that are compared
PIECES_PER_BUCKET = 1024

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    first = n % capacity or min(n, capacity)
    cuts = [0, *range(first, n + 1, capacity)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           end_id: int = END_ID, vocabulary: str | None = None) -> DataFrame:
    """One row per piece of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for doc, text in zip(b.column("id").to_pylist(), b.column("text")):
                ids = np.append(bpe.encode(text.as_py(), vocabulary, special=True), np.uint32(end_id)).astype("<u4")
                for k, (start, n) in enumerate(piece_bounds(len(ids), capacity)):
                    crc = zlib.crc32(ids[start:start + n].tobytes())
                    for col, v in zip(out, (doc, k, start, n, crc)):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    require(docs, id_col, text_col)
    return (docs.select(F.col(id_col).cast("bigint").alias("id"), text_or_empty(text_col).alias("text"))
            .mapInArrow(run, PIECE))


# ------------------------------------------------------------- the solver

def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Martello-Toth bound L2 (which includes the sum bound)."""
    best = -(-sum(n * c for n, c in counts.items()) // capacity)
    for alpha in sorted({0, *(n for n in counts if 2 * n <= capacity)}):
        big = sum(c for n, c in counts.items() if n > capacity - alpha)
        half = {n: c for n, c in counts.items() if capacity - alpha >= n and 2 * n > capacity}
        rest = sum(n * c for n, c in counts.items() if 2 * n <= capacity and n >= alpha)
        room = sum(half.values()) * capacity - sum(n * c for n, c in half.items())
        best = max(best, big + sum(half.values()) + max(0, -(-(rest - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best fit decreasing on a histogram: (pattern, multiplicity) list.  Bins
    filled alike move as one group, so the work follows the number of lengths."""
    groups: dict[int, list[list]] = defaultdict(list)  # room -> [pattern, multiplicity]
    for n in sorted(counts, reverse=True):
        left = counts[n]
        while left:
            room = min((r for r in groups if r >= n and groups[r]), default=None)
            if room is None:
                per = capacity // n  # new bins: filled one after the other
                full, part = divmod(left, per)
                if full:
                    groups[capacity - per * n].append([{n: per}, full])
                if part:
                    groups[capacity - part * n].append([{n: part}, 1])
                break
            pattern, mult = groups[room].pop()
            per = min(room // n, left)
            bins, rest = divmod(left, per)
            bins = min(bins, mult)
            if bins < mult:
                groups[room].append([pattern, mult - bins])
            groups[room - per * n].append([pattern | {n: per}, bins])
            left -= per * bins
    return [(p, m) for g in groups.values() for p, m in g if m]


def _fits(small: tuple[int, ...], into: tuple[int, ...]) -> bool:
    """Whether the items of ``small`` can be spread over bins of sizes ``into``
    (first fit decreasing: a sufficient test)."""
    room = sorted(into)
    for x in sorted(small, reverse=True):
        for i, r in enumerate(room):
            if r >= x:
                room[i] = r - x
                room.sort()
                break
        else:
            return False
    return True


def fillings(lengths: list[int], counts: dict[int, int], room: int, want: int) -> list[tuple[int, ...]]:
    """Up to ``want`` undominated maximal fillings of ``room``, least waste first.

    A filling is dominated when its items fit into the items of another one:
    the other leaves easier items for the rest."""
    found: list[tuple[int, ...]] = []
    steps = 0

    def grow(k: int, room: int, chosen: tuple[int, ...]) -> None:
        nonlocal steps
        placed = False
        for i in range(k, len(lengths)):
            steps += 1
            if steps > STEPS * want or len(found) >= FOUND * want:
                break
            n = lengths[i]
            if n <= room and chosen.count(n) < counts[n]:
                placed = True
                grow(i, room - n, (*chosen, n))
        if not placed and chosen:
            found.append(chosen)

    grow(0, room, ())
    found = sorted(set(found), key=lambda f: (room - sum(f), len(f)))
    kept: list[tuple[int, ...]] = []
    for f in found:
        if not any(_fits(f, g) for g in kept):
            kept.append(f)
    return kept[:want] or [()]


def bin_completion(counts: dict[int, int], capacity: int, bound: int, incumbent: list,
                   nodes: int | None = None) -> list[tuple[dict[int, int], int]]:
    """Depth-first search for a packing of fewer bins than ``incumbent``."""
    if nodes is None:
        nodes = max(NODES, NODES_PER_LENGTH * len(counts))
    total = sum(n * c for n, c in counts.items())
    best, best_bins = incumbent, sum(m for _, m in incumbent)
    stack = [(dict(counts), (), 0)]
    while stack and nodes and best_bins > bound:
        nodes -= 1
        left, chain, bins = stack.pop()
        if not left:
            if bins < best_bins:
                best_bins, best = bins, []
                while chain:
                    chain, step = chain
                    best.append(step)
            continue
        largest = max(left)
        rest = dict(left)
        rest[largest] -= 1
        order = sorted((n for n in rest if rest[n] and n <= capacity - largest), reverse=True)
        children = []
        for f in fillings(order, rest, capacity - largest, FILLINGS):
            pattern: dict[int, int] = defaultdict(int)
            for n in (largest, *f):
                pattern[n] += 1
            # as often as the counts allow; half of it keeps other fillings open further down
            mult = min(left[n] // c for n, c in pattern.items())
            after = {n: c - mult * pattern.get(n, 0) for n, c in left.items() if c > mult * pattern.get(n, 0)}
            used = bins + mult
            waste = used * capacity - (total - sum(n * c for n, c in after.items()))
            if waste <= (best_bins - 1) * capacity - total:  # what a better packing may waste
                children.append((after, (chain, (dict(pattern), mult)), used))
        stack += reversed(children)
    return best


def pack_lengths(counts: dict[int, int], capacity: int = CAPACITY,
                 nodes: int | None = None) -> list[tuple[dict[int, int], int]]:
    """Patterns ``{length: copies}`` with multiplicities that use up ``counts``."""
    if any(n < 1 or n > capacity for n in counts):
        raise ValueError("lengths must be from 1 to the capacity")
    counts = {n: c for n, c in counts.items() if c}
    incumbent = best_fit(counts, capacity)
    return bin_completion(counts, capacity, lower_bound(counts, capacity), incumbent, nodes)


def slots(patterns: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """Per length an array of rows (first number, first sequence, multiplicity,
    offset): the pieces of that length numbered from there fill that slot."""
    used: dict[int, int] = defaultdict(int)
    out: dict[int, list] = defaultdict(list)
    base = 0
    for pattern, mult in patterns:
        at = 0
        for n, copies in sorted(pattern.items(), reverse=True):
            out[n].append((used[n], base, mult, at))
            used[n] += copies * mult
            at += copies * n
        base += mult
    return {n: np.array(rows, np.int64) for n, rows in out.items()}


def assign(found: DataFrame, capacity: int = CAPACITY, nodes: int | None = None) -> DataFrame:
    """``found`` (rows of ``pieces``, already written) with ``sequence_id`` and
    ``offset``."""
    spark = found.sparkSession
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = spark.sparkContext.broadcast(slots(pack_lengths(counts, capacity, nodes)))
    buckets = -(-sum(counts.values()) // PIECES_PER_BUCKET) or 1
    key = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets))
    rows = found.withColumn("bucket", key)
    sizes = materialize(rows.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")), "pack-sizes")
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    firsts = sizes.select("length", "bucket", (F.sum("n").over(before) - F.col("n")).alias("first"))
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")
    numbered = (rows.join(firsts, ["length", "bucket"])
                .select("doc_id", "piece", "start", "length", "ids_crc32",
                        (F.col("first") + F.row_number().over(order) - 1).alias("number")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b.column("length").to_numpy(zero_copy_only=False)
            number = b.column("number").to_numpy(zero_copy_only=False)
            seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length).tolist():
                at, s = length == n, table.value[n]
                k = np.searchsorted(s[:, 0], number[at], side="right") - 1
                copy, which = np.divmod(number[at] - s[k, 0], s[k, 2])
                seq[at], off[at] = s[k, 1] + which, s[k, 3] + copy * n
            yield pa.RecordBatch.from_arrays(b.columns[:5] + [pa.array(seq), pa.array(off)],
                                             [*b.schema.names[:5], "sequence_id", "offset"])

    return numbered.mapInArrow(run, PIECE + ", sequence_id bigint, offset bigint")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID, vocabulary: str | None = None, nodes: int | None = None) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    found = materialize(pieces(docs, id_col, text_col, capacity, end_id, vocabulary), "pack-pieces")
    return assign(found, capacity, nodes)
