"""Language-model scoring with a weighted backoff automaton.

Tokens of a text: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, then one end
token.  The model is an interpolated n-gram model with Dirichlet smoothing
(MacKay and Peto 1995):

    p1(w)   = (c(w) + 1) / (N + V + 1)
    pk(w|h) = (c(hw) + m * p(k-1)(w|h')) / (c(h) + m)

The states of the automaton are the histories h; the arc (h, w) of a seen
n-gram carries log10 pk(w|h), and the failure arc of h carries
log10 (m / (c(h) + m)) and leads to the shorter history h', where w is tried
again; the root's arcs are p1.  One left-to-right traversal carries the state
and adds up the weights of the arcs and failure arcs it takes.

The model is never held in one place.  The work runs in blocks of documents:

1. Each block (about ``BLOCK_TOKENS`` tokens, or one longer text) is tokenised
   once; its tokens are written as numbers to the checkpoint folder.
2. A block's distinct n-grams and their counts in training documents are cut into
   hash ranges; a hot n-gram is one entry per block.  A range's entries of all
   blocks meet in one task, are added up, and each
   block gets back the counts of its own n-grams, in its own order.  The number
   of ranges grows with the number of tokens, so a range stays of bounded size
   however long the documents are.
3. Each block builds the automaton of its n-grams (states, arcs and failure arcs
   as flat arrays) and traverses its tokens in lanes, side by side in numpy; each
   lane carries its state.  A history unseen in training is no state: its failure
   arc would weigh 0.

n-grams are told apart by 64-bit hashes (xxHash of a word, mixed over the
n-gram): among 10^12 n-grams about 3 * 10^4 are expected to share one.

Nulls: a null text is an empty one (its end token is scored), a null doc_id
belongs to the training side.  Repeated rows count and are scored as often as
they occur.  Without training documents every token has probability 1 (N = V =
0).  Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import array
import math
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import require, text_or_empty, words
from tessera.session import materialize

ORDER = 3
PRIOR = 20.0          # Dirichlet weight m of the lower order
BLOCK_TOKENS = 2_000_000
TOKENS_PER_RANGE = 1 << 20
MIN_RANGES = 32
LANE = 64             # least number of tokens a lane of the traversal reads
_END, _START = b" ", b"\n"  # no word holds white space


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hash of a pair of 64-bit hashes (splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = b >> np.uint64(29)
        x ^= b
        x *= np.uint64(0xD6E8FEB86659FD93)
        x += a * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        return x


def _pack(a: np.ndarray) -> bytes:
    """Compressed bytes of an unsigned array; equal byte places stand together."""
    import zstandard

    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpack(data: bytes, dtype) -> np.ndarray:
    import zstandard

    size = np.dtype(dtype).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel()


def _pack_sorted(a: np.ndarray) -> bytes:
    return _pack(np.diff(a, prepend=np.uint64(0)))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.uint64), dtype=np.uint64)


def _levels(tokens: np.ndarray, firsts: np.ndarray, hashes: np.ndarray, order: int):
    """n-grams of a block.  ``tokens``: word numbers, the last of ``hashes``
    being the start mark; ``firsts``: position of each document's first token.

    Returns per level k = 1.. (number of the k-gram ending at each position, or
    -1 where the history is too short; hash of each numbered k-gram).
    """
    tokens = tokens.astype(np.int32)
    place = np.arange(len(tokens), dtype=np.int32)
    place -= np.repeat(firsts, np.diff(np.append(firsts, len(tokens)))).astype(np.int32)
    out = [(tokens, hashes)]
    for k in range(2, order + 1):
        below, below_hash = out[-1]
        key = np.empty(len(tokens), np.int64)  # number of the history, then of the token
        key[1:] = below[:-1]
        if k == 2:
            key[firsts] = len(hashes) - 1
        key *= len(hashes)
        key += tokens
        ok = place >= k - 2
        u, inverse = np.unique(key[ok], return_inverse=True)
        del key
        number = np.full(len(tokens), -1, np.int32)
        number[ok] = inverse
        del inverse
        h = u // len(hashes)
        u -= h * len(hashes)
        out.append((number, _mix(below_hash[h], hashes[u])))
    return out


def _blocks(limit: int):
    """mapInArrow body of step 1: documents in, one row per block out."""
    import xxhash

    def flush(docs, held, sizes, ids, vocabulary):
        hashes = [xxhash.xxh64_intdigest(w) for w in (*vocabulary, _START)]
        row = (uuid.uuid4().hex, docs, np.packbits(np.array(held, bool)).tobytes(),
               _pack(np.array(sizes, np.uint32)), _pack(np.frombuffer(ids, np.uint32)),
               _pack(np.array(hashes, np.uint64)), len(ids), len(held) - sum(held))
        return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, _TYPES)], _NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fresh():
            number = defaultdict()
            number.default_factory = number.__len__
            return [], [], [], array.array("I"), number

        docs, held, sizes, ids, number = fresh()
        for b in batches:
            for k in range(b.num_rows):
                w = words(b.column("text")[k].as_py().encode("utf-8", "surrogatepass").lower())
                w.append(_END)
                ids.extend([number[x] for x in w])
                docs.append(b.column("id")[k].as_py())
                held.append(b.column("held_out")[k].as_py())
                sizes.append(len(w))
                if len(ids) >= limit:
                    yield flush(docs, held, sizes, ids, number)
                    docs, held, sizes, ids, number = fresh()
        if docs:
            yield flush(docs, held, sizes, ids, number)

    return run


def _open(row) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc ids, held out, sizes, tokens, word hashes) of a block's row."""
    get = lambda c: row.column(c)[0].as_py()
    docs = get("docs")
    held = np.unpackbits(np.frombuffer(get("held"), np.uint8), count=len(docs)).astype(bool)
    return (docs, held, _unpack(get("sizes"), np.uint32).astype(np.int64),
            _unpack(get("tokens"), np.uint32).astype(np.int64), _unpack(get("hashes"), np.uint64))


def _grams(order: int, ranges: int):
    """mapInArrow body of step 2's map side: a row per level and hash range."""
    shift = np.uint64(65 - ranges.bit_length())
    names = ["block", "level", "range", "a", "b"]
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                _, held, sizes, tokens, hashes = _open(row)
                trains = np.repeat(~held, sizes)
                for k, (number, gram_hash) in enumerate(
                        _levels(tokens, np.cumsum(sizes) - sizes, hashes, order), 1):
                    n = len(gram_hash) - (k == 1)  # the start mark is no token
                    counts = np.bincount(number[trains & (number >= 0)], minlength=len(gram_hash))[:n]
                    by = np.argsort(gram_hash[:n])
                    keys, counts = gram_hash[:n][by], counts[by].astype(np.uint32)
                    cut = np.searchsorted(keys >> shift, np.arange(ranges + 1, dtype=np.uint64))
                    out = [(row.column("block")[0].as_py(), k, r, _pack_sorted(keys[a:b]), _pack(counts[a:b]))
                           for r, (a, b) in enumerate(zip(cut, cut[1:])) if a < b]
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return run


_NAMES = ["block", "docs", "held", "sizes", "tokens", "hashes", "n_tokens", "n_train"]
_TYPES = [pa.string(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
_SCHEMA = ("block string, docs array<bigint>, held binary, sizes binary, tokens binary, hashes binary, "
           "n_tokens bigint, n_train bigint")


def _sum_range(key, table):
    """Step 2: add up one (level, range) and answer every block that asked."""
    block, a, b = (table.column(c).to_pylist() for c in ("block", "a", "b"))
    keys = [_unpack_sorted(x) for x in a]
    u, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.concatenate([_unpack(x, np.uint32) for x in b])
    total = np.bincount(inverse, counts, len(u)).astype(np.uint64)
    at, answers = 0, []
    for k in keys:
        answers.append(_pack(total[inverse[at:at + len(k)]]))
        at += len(k)
    n = len(block)
    return pa.Table.from_arrays(
        [pa.array(block, pa.string()), pa.array([key[0].as_py()] * n, pa.int32()),
         pa.array([key[1].as_py()] * n, pa.int32()), pa.array(answers, pa.binary()),
         pa.array([int(total.sum())] + [0] * (n - 1), pa.int64()),
         pa.array([int((total > 0).sum())] + [0] * (n - 1), pa.int64())],
        names=["block", "level", "range", "counts", "tokens", "types"])


class Automaton:
    """The weighted automaton of a block's n-grams, in flat arrays.

    State 0 is the root, the others are the seen histories of 1 to order - 1
    tokens.  ``arc`` holds the sorted keys (state * words + token) of the seen
    n-grams, ``weight`` and ``to`` their log-probability and next state;
    ``fail`` and ``fail_weight`` belong to a state; the root has an arc for
    every token (``root_weight``, ``root_to``)."""

    def __init__(self, levels: list, counts: list[np.ndarray], firsts: np.ndarray, train_docs: int, n: int, v: int,
                 prior: float):
        self.words = len(levels[0][1])
        self.order = len(counts)
        per = []  # training count of every numbered k-gram
        for k, ((_, gram_hash), c) in enumerate(zip(levels, counts), 1):
            m = len(gram_hash) - (k == 1)
            own = np.zeros(len(gram_hash))
            own[np.argsort(gram_hash[:m])] = c
            if k == 1:
                own[m] = train_docs  # the start mark as a history
            per.append(own)
        self.known = per[0] > 0
        base = 1 + np.cumsum([0, *map(len, per)])  # number of each level's first state
        p = (per[0] + 1) / (n + v + 1)
        self.root_weight = np.log10(p)
        self.root_to = np.where(self.known & (self.order > 1), base[0] + np.arange(self.words), 0)
        self.start = int(base[0]) + self.words - 1 if train_docs and self.order > 1 else 0
        fails, fail_weights = [np.zeros(1 + self.words, np.int32)], [np.zeros(1), np.log10(prior / (per[0] + prior))]
        arcs, weights, targets = [], [], []  # a level's states come after those of the shorter histories
        for k in range(2, self.order + 1):
            number = levels[k - 1][0]
            at = np.empty(len(per[k - 1]), np.int32)
            ends = np.flatnonzero(number >= 0)
            at[number[ends]] = ends  # one place of each n-gram
            del ends
            below = levels[k - 2][0]
            suffix, history = below[at], below[at - 1]
            if k == 2:
                first = np.zeros(len(below), bool)
                first[firsts] = True
                history[first[at]] = self.words - 1
            p = (per[k - 1] + prior * p[suffix]) / (per[k - 2][history] + prior)
            key = base[k - 2] + history.astype(np.int64)
            key *= self.words
            key += levels[0][0][at]
            del at, history
            seen = np.flatnonzero(per[k - 1])
            seen = seen[np.argsort(key[seen])]
            arcs.append(key[seen])
            del key
            weights.append(np.log10(p[seen]))
            targets.append((base[k - 1] + seen if k < self.order else base[k - 2] + suffix[seen]).astype(np.int32))
            if k < self.order:
                fails.append((base[k - 2] + suffix).astype(np.int32))
                fail_weights.append(np.log10(prior / (per[k - 1] + prior)))
        del per, p
        self.fail, self.fail_weight = np.concatenate(fails), np.concatenate(fail_weights)
        self.arc = np.concatenate([*arcs, np.full(1, -1)])  # the last entry stands for 'none'
        del arcs
        self.weight = np.concatenate([*weights, np.empty(0)])
        del weights
        self.to = np.concatenate([*targets, np.empty(0, np.int32)])

    def step(self, state: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(weight taken, next state) of each lane: its arc, or the failure arcs down to a state that has one."""
        taken, out = np.zeros(len(state)), np.zeros(len(state), np.int64)
        lane = np.arange(len(state))
        for _ in range(self.order - 1):
            inner = state > 0
            if not inner.any():
                break
            key = state * self.words + token
            i = np.searchsorted(self.arc[:-1], key)
            hit = inner & (self.arc[i] == key)
            taken[lane[hit]] += self.weight[i[hit]]
            out[lane[hit]] = self.to[i[hit]]
            lane, state, token = lane[~hit], state[~hit], token[~hit]
            taken[lane] += self.fail_weight[state]
            state = self.fail[state]
        taken[lane] += self.root_weight[token]
        out[lane] = self.root_to[token]
        return taken, out


def traverse(tokens: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, counts: list[np.ndarray],
             train_docs: int, n: int, v: int, prior: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Step 3: (known tokens, base score, score) of each document of a block.

    ``counts[k-1]`` are the training counts of the block's k-grams in hash
    order.  The block's tokens are read in lanes of equal length, side by side.
    Each lane carries its state from token to token; a document's first token
    sets it to the start mark's.  A lane that begins inside a document first
    reads the order - 1 tokens before it from the root, which lead to the state
    that the whole text before it leads to."""
    firsts = np.cumsum(sizes) - sizes
    order = len(counts)
    machine = Automaton(_levels(tokens, firsts, hashes, order), counts, firsts, train_docs, n, v, prior)
    length = max(LANE, math.isqrt(len(tokens)))
    begin = np.arange(0, len(tokens), length)
    is_first = np.zeros(len(tokens), bool)
    is_first[firsts] = True
    state, logp = np.zeros(len(begin), np.int64), np.empty(len(tokens))
    for i in range(1 - order, length):
        at = begin + i
        live = (at >= 0) & (at < len(tokens))
        at = at[live]
        taken, state[live] = machine.step(np.where(is_first[at], machine.start, state[live]), tokens[at])
        if i >= 0:
            logp[at] = taken
    add = np.add.reduceat
    return (add(machine.known[tokens].astype(np.int64), firsts), add(machine.root_weight[tokens], firsts),
            add(logp, firsts))


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
          prior: float = PRIOR, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Fit on the rows where ``held_out`` is not true and score every row:
    ``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``."""
    require(docs, id_col, text_col)
    src = docs.select(F.col(id_col).cast("bigint").alias("id"),
                      F.coalesce(held_out, F.lit(False)).alias("held_out"), text_or_empty(text_col).alias("text"))
    blocks = materialize(src.mapInArrow(_blocks(block_tokens), _SCHEMA), "lm-blocks")
    size = blocks.agg(F.sum("n_tokens").alias("n"), F.sum("n_train").alias("train")).collect()[0]
    ranges = max(MIN_RANGES, 1 << ((size["n"] or 0) // TOKENS_PER_RANGE).bit_length())
    blocks = blocks.drop("n_tokens", "n_train")
    grams = blocks.mapInArrow(_grams(order, ranges), "block string, level int, range int, a binary, b binary")
    counts = materialize(
        grams.groupBy("level", "range").applyInArrow(
            _sum_range, "block string, level int, range int, counts binary, tokens bigint, types bigint"),
        "lm-counts")
    total = counts.where(F.col("level") == 1).agg(F.sum("tokens"), F.sum("types")).collect()[0]
    n, v, train = int(total[0] or 0), int(total[1] or 0), int(size["train"] or 0)

    def run(key, left, right):
        docs_, held, sizes, tokens, hashes = _open(left)
        parts = sorted(zip(right.column("level").to_pylist(), right.column("range").to_pylist(),
                           right.column("counts").to_pylist()), key=lambda x: x[:2])
        per = [np.concatenate([np.empty(0, np.uint64), *(_unpack(c, np.uint64) for k, _, c in parts if k == level)])
               for level in range(1, order + 1)]
        known, base, total_ = traverse(tokens, sizes, hashes, per, train, n, v, prior)
        m = len(docs_)
        return pa.Table.from_arrays(
            [pa.array(docs_, pa.int64()), pa.array(held), pa.array(sizes), pa.array(known),
             pa.array(np.full(m, n, np.int64)), pa.array(base), pa.array(total_)],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return blocks.groupBy("block").cogroup(counts.select("block", "level", "range", "counts").groupBy("block")) \
        .applyInArrow(run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                           "base_score double, score double")
