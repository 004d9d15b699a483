"""Approximate nearest neighbours: one hierarchical navigable small-world graph
per shard, stored as flat neighbour arrays, with the shards' results merged.

Index: vectors are dealt to shards of about ``SHARD_ROWS`` rows by a hash of
their id, so a group of equal vectors is spread over all shards.  One task
builds the graph of one shard (Malkov and Yashunin 2018): every node draws a
level, is linked to neighbours chosen by the pruning heuristic from a beam of
``EF_BUILD``, ``2 * M`` links on the lowest level and ``M`` above.  Equal vectors
of a shard are one node that lists its ids (smallest first).  The graph is
written to the checkpoint folder as one row per shard: ids, vectors, levels and
a (nodes x links) int32 array per level.

Search: queries are put into blocks of ``QUERY_BLOCK`` rows, written to the
checkpoint folder, and every block meets every shard once: a task reads some
files of the index and some of the blocks and pairs their rows, so no block or
shard is copied by a shuffle or passes the driver.  A task holds one shard and
the results of its queries so far.  Each query walks the shard's graph with a
beam of ``EF_SEARCH``; the candidates are scored exactly - cosine in double
precision on the original vectors - and the shard gives its ``k`` best (without
the query itself).  The ``k`` best over a task's shards leave the task, the ``k``
best over all tasks are kept, ties to the smaller id.

Vectors that are null, zero, of another dimension than most vectors, or that hold null or non-finite components take no part; neither do null ids.
Repeated rows of one id with the same vector count once; different vectors under
one id are separate candidates of that id.  Fewer than ``k`` candidates: all of
them.  An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import require
from tessera.session import materialize

M = 16
EF_BUILD = 80
EF_SEARCH = 120
SHARD_ROWS = 4096
QUERY_BLOCK = 512
K = 5


class Graph:
    """Flat-array graph over unit vectors (rows of ``unit``)."""

    def __init__(self, unit: np.ndarray, levels: np.ndarray, links: list[np.ndarray], entry: int):
        self.unit, self.levels, self.links, self.entry = unit, levels, links, entry

    @classmethod
    def build(cls, unit: np.ndarray, m: int = M, ef: int = EF_BUILD, seed: int = 0) -> Graph:
        n = len(unit)
        draw = np.random.default_rng(seed).random(n)
        levels = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(m)).astype(np.int64), 12)
        links = [np.full((n, 2 * m if k == 0 else m), -1, np.int32) for k in range(int(levels.max(initial=0)) + 1)]
        g = cls(unit, levels, links, 0)
        for x in range(1, n):
            g._insert(x, m, ef)
        return g

    def _insert(self, x: int, m: int, ef: int) -> None:
        top, level = int(self.levels[self.entry]), int(self.levels[x])
        q = self.unit[x]
        at = self.entry
        for k in range(top, level, -1):
            at = self._greedy(q, at, k)
        start = [at]
        for k in range(min(top, level), -1, -1):
            near = self._beam(q, start, ef, k)
            chosen = self._choose(near, m)
            self.links[k][x, :len(chosen)] = chosen
            for y in chosen:
                row = self.links[k][y]
                free = np.flatnonzero(row < 0)
                if len(free):
                    row[free[0]] = x
                else:  # full: choose anew among the old neighbours and x
                    cand = np.append(row, x)
                    d = 1 - self.unit[cand] @ self.unit[y]
                    kept = self._choose(sorted(zip(d.tolist(), cand.tolist())), len(row))
                    row[:] = -1
                    row[:len(kept)] = kept
            start = [y for _, y in near]
        if level > top:
            self.entry = x

    def _choose(self, near: list[tuple[float, int]], m: int) -> list[int]:
        """The pruning heuristic: a candidate is linked if it is nearer to the
        node than to every neighbour chosen so far; the rest fill up."""
        if len(near) <= m:
            return [y for _, y in near]
        ids = np.array([y for _, y in near])
        gram = 1 - self.unit[ids] @ self.unit[ids].T
        chosen: list[int] = []
        spare = []
        closest = np.full(len(ids), np.inf)
        for i, (d, _) in enumerate(near):
            if d < closest[i]:
                chosen.append(i)
                np.minimum(closest, gram[i], out=closest)
                if len(chosen) == m:
                    break
            else:
                spare.append(i)
        chosen += spare[:m - len(chosen)]
        return ids[chosen].tolist()

    def _greedy(self, q: np.ndarray, at: int, level: int) -> int:
        best = float(self.unit[at] @ q)
        while True:
            nb = self.links[level][at]
            nb = nb[nb >= 0]
            if not len(nb):
                return at
            s = self.unit[nb] @ q
            i = int(s.argmax())
            if s[i] <= best:
                return at
            best, at = float(s[i]), int(nb[i])

    def _beam(self, q: np.ndarray, start: list[int], ef: int, level: int) -> list[tuple[float, int]]:
        """The ``ef`` nearest found on a level: (distance, node), nearest first."""
        start = list(dict.fromkeys(start))
        seen = np.zeros(len(self.unit), bool)
        seen[start] = True
        d = 1 - self.unit[start] @ q
        front = list(zip(d.tolist(), start))
        heapq.heapify(front)
        best = [(-a, b) for a, b in front]
        heapq.heapify(best)
        while len(best) > ef:
            heapq.heappop(best)
        links = self.links[level]
        while front:
            a, x = heapq.heappop(front)
            if a > -best[0][0] and len(best) >= ef:
                break
            nb = links[x]
            nb = nb[nb >= 0]
            nb = nb[~seen[nb]]
            if not len(nb):
                continue
            seen[nb] = True
            dist = 1 - self.unit[nb] @ q
            worst = -best[0][0]
            for b, y in zip(dist.tolist(), nb.tolist()):
                if len(best) < ef or b < worst:
                    heapq.heappush(front, (b, y))
                    heapq.heappush(best, (-b, y))
                    if len(best) > ef:
                        heapq.heappop(best)
                    worst = -best[0][0]
        return sorted((-a, b) for a, b in best)

    def search(self, q: np.ndarray, ef: int = EF_SEARCH) -> list[int]:
        at = self.entry
        for k in range(int(self.levels[at]), 0, -1):
            at = self._greedy(q, at, k)
        return [y for _, y in self._beam(q, [at], ef, 0)]


def _valid(id_col: str, vec_col: str) -> tuple[Column, Column]:
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # a norm that overflows or vanishes in double precision has no cosine
    norm = F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)
    return v, F.col(id_col).isNotNull() & v.isNotNull() & fine & (norm > 0) & (norm < float("inf"))


def _vectors(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    require(table, id_col, vec_col)
    v, ok = _valid(id_col, vec_col)
    return table.where(ok).select(F.col(id_col).cast("bigint").alias("id"), v.alias("v"))


def _matrix(col) -> np.ndarray:
    flat = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return np.asarray(flat.flatten(), np.float64).reshape(len(flat), -1) if len(flat) else np.empty((0, 0))


_INDEX = ("shard int, n_nodes int, dim int, ids binary, id_starts binary, vectors binary, levels binary, "
          "links array<binary>, entry int")


def build_index(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", m: int = M,
                ef_build: int = EF_BUILD, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard (see module text), written to the checkpoint folder.

    The dimension is the most frequent one (ties: the smaller)."""
    rows = materialize(_vectors(table, id_col, vec_col), "hnsw-rows")
    size = (rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "dim").limit(1).collect())
    dim, n = (size[0]["dim"], size[0]["n"]) if size else (0, 0)
    shards = max(1, -(-n // shard_rows))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(shard: int, ids: np.ndarray, vec: np.ndarray) -> pa.RecordBatch:
            u, node = np.unique(vec, axis=0, return_inverse=True)
            order = np.lexsort((ids, node.ravel()))
            ids, node = ids[order], node.ravel()[order]
            keep = np.ones(len(ids), bool)
            keep[1:] = (ids[1:] != ids[:-1]) | (node[1:] != node[:-1])
            ids, node = ids[keep], node[keep]
            # nodes are inserted in a mixed order: neighbours in value are not neighbours in time
            mix = np.random.default_rng(1).permutation(len(u))
            rank = np.empty(len(u), np.int64)
            rank[mix] = np.arange(len(u))
            order = np.lexsort((ids, rank[node]))
            starts = np.searchsorted(rank[node][order], np.arange(len(u) + 1)).astype(np.int64)
            vec = u[mix]
            unit = (vec / np.linalg.norm(vec, axis=1, keepdims=True)).astype(np.float32)
            g = Graph.build(unit, m, ef_build)
            cols = [shard, len(u), dim, ids[order].tobytes(), starts.tobytes(), vec.tobytes(), g.levels.tobytes(),
                    [x.tobytes() for x in g.links], g.entry]
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cols, _INDEX_TYPES)], _INDEX_NAMES)

        now, ids, vecs = None, [], []
        for b in batches:
            shard = b.column("shard").to_numpy(zero_copy_only=False)
            i, v = b.column("id").to_numpy(zero_copy_only=False), _matrix(b.column("v"))
            for s in dict.fromkeys(shard.tolist()):
                if now is not None and s != now:
                    yield one(now, np.concatenate(ids), np.concatenate(vecs))
                    ids, vecs = [], []
                now = s
                ids.append(i[shard == s])
                vecs.append(v[shard == s])
        if now is not None:
            yield one(now, np.concatenate(ids), np.concatenate(vecs))

    dealt = (rows.where(F.size("v") == dim)
             .select(F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), "id", "v")
             .repartitionByRange(shards, "shard").sortWithinPartitions("shard"))
    return materialize(dealt.mapInArrow(build, _INDEX), "hnsw-index")


_INDEX_NAMES = ["shard", "n_nodes", "dim", "ids", "id_starts", "vectors", "levels", "links", "entry"]
_INDEX_TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(),
                pa.list_(pa.binary()), pa.int32()]


_Near = tuple[np.ndarray, np.ndarray, np.ndarray]


def _nothing(n: int, k: int) -> _Near:
    """Room for ``k`` candidates of each of ``n`` queries: ids, scores, and which places are taken."""
    return np.zeros((n, k), np.int64), np.zeros((n, k)), np.zeros((n, k), bool)


def _merged(a: _Near, b: _Near, k: int) -> _Near:
    """Each query's ``k`` best of two sets (ties to the smaller id), an id once with its better score."""
    x, s, has = (np.concatenate(c, axis=1) for c in zip(a, b))

    def ordered(*keys: np.ndarray) -> _Near:
        order = np.lexsort((*keys, ~has), axis=1)
        return tuple(np.take_along_axis(c, order, axis=1) for c in (x, s, has))

    x, s, has = ordered(-s, x)
    has[:, 1:] &= x[:, 1:] != x[:, :-1]
    x, s, has = ordered(x, -s)
    return x[:, :k], s[:, :k], has[:, :k]


def search(index: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
           ef: int = EF_SEARCH, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest of each query, the
    query's own id left out."""
    shape = index.agg(F.max("shard").alias("last"), F.max("dim").alias("dim")).collect()[0]
    dim = shape["dim"] or 0
    q = materialize(_vectors(queries, id_col, vec_col).where(F.size("v") == dim), "hnsw-queries")
    blocks = max(1, -(-q.count() // query_block))
    put = q.select(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(blocks)).alias("block"), "id", "v")
    packed = materialize(put.groupBy("block").agg(F.collect_list(F.struct("id", "v")).alias("q")), "hnsw-blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best = None, {}                                 # the shard at hand; by block: query ids, best so far
        for b in batches:
            for r in range(b.num_rows):
                get = lambda c: b.column(c)[r].as_py()  # noqa: E731, B023
                if get("shard") != now:                      # a shard's rows come one after the other
                    now = get("shard")
                    ids, starts = np.frombuffer(get("ids"), np.int64), np.frombuffer(get("id_starts"), np.int64)
                    vec = np.frombuffer(get("vectors"), np.float64).reshape(-1, dim)
                    n = len(vec)
                    norm = np.linalg.norm(vec, axis=1)
                    g = Graph((vec / norm[:, None]).astype(np.float32), np.frombuffer(get("levels"), np.int64),
                              [np.frombuffer(x, np.int32).reshape(n, -1) for x in get("links")], get("entry"))
                asked = b.column("q")[r].values
                qid = asked.field("id").to_numpy(zero_copy_only=False)
                near = _nothing(len(qid), k)
                for at, (i, v) in enumerate(zip(qid.tolist(), _matrix(asked.field("v")))):
                    length = np.linalg.norm(v)
                    found = np.array(g.search((v / length).astype(np.float32), ef))
                    score = (vec[found] @ v) / (norm[found] * length)
                    # a node lists its ids in ascending order: k + 1 of them suffice
                    for j, (s, x) in enumerate(sorted(
                            (-s, int(x)) for s, f in zip(score.tolist(), found.tolist())
                            for x in ids[starts[f]:starts[f + 1]][:k + 1] if x != i)[:k]):
                        for col, value in zip(near, (x, -s, True)):
                            col[at, j] = value
                block = get("block")
                best[block] = qid, _merged(best[block][1], near, k) if block in best else near
        for qid, (x, s, has) in best.values():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(qid, has.sum(axis=1)), pa.int64()), pa.array(x[has], pa.int64()),
                 pa.array(s[has], pa.float64())], ["query_id", "vec_id", "score"])

    # by name: broadcasting either side would send every block or every shard through the driver
    near = (index.hint("shuffle_replicate_nl").crossJoin(packed)
            .select("shard", "ids", "id_starts", "vectors", "levels", "links", "entry", "block", "q")
            .mapInArrow(run, "query_id bigint, vec_id bigint, score double"))
    # one row per (query, id): an id with several vectors, or a repeated query, counts once
    best = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
