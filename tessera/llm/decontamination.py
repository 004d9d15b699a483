"""Benchmark decontamination: a BM25 index of the test items, searched by every
training passage with block-max WAND, and a check of question and answer.

Words: lower-cased text, ASCII punctuation counts as space.

Index (Spark): one posting (term, item, weight) per distinct term of an item.
The weight is the BM25 term weight divided by the item's own total, so an
item's weights add up to 1 and the score of a passage is the share of the
item's BM25 weight that it holds.  Items are ordered and cut into blocks of
``BLOCK_ITEMS``; each term keeps its largest weight per block.  The index is cut
into shards of about ``SHARD_POSTINGS`` postings (a shard has at least one
item).  One shard is broadcast at a time - its size is bounded by that
parameter - and one scan of the documents searches it; the number of scans
follows the size of the benchmark, not of the documents.

Search (one task per input split, no shuffle of texts): a document is cut into
overlapping passages of ``2 * L`` words, stride ``L``, ``L`` being the longest
item of the shard, so every copy of an item lies whole in some passage.  For the
document first, then for each of its passages, the blocks whose summed maxima
stay below the threshold are skipped; in the others, cursors over the postings
advance by WAND (the pivot is the first item at which the term maxima reach the
threshold) and the pivot's score is added up in full.  No candidate is dropped
otherwise: all items at or above the threshold are returned.

Verification: the item's question (all but its last sentence) and answer (its
last sentence) must both occur in the passage.  A part's overlap is the share of
its distinct 5-word shingles there (a shorter part: the whole of it) or, where
that is larger, the share of its words that stay by word edit distance (words
changed, put in or taken out) at the best place; the answer's place is behind the
question's.  The mean of both overlaps, weighted by words, must reach
``MIN_OVERLAP`` and each of them ``PART_OVERLAP``, so that a part of one or two
words must be there whole.  An item of a single sentence is all question.

Nulls: null texts are empty; an item without words matches nothing; an empty
benchmark or document table gives no rows.  A null item id or doc_id is kept.
Repeated rows are searched each, and the best passage of a (doc_id, item) pair
is reported (ties: the earliest).  Extra columns are ignored by ``find_leaks``
and kept by ``drop_leaks``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import require, text_or_empty
from tessera.session import materialize

K1, B = 1.2, 0.75
THRESHOLD = 0.6       # share of the item's BM25 weight
MIN_OVERLAP = 0.8     # of the whole item
PART_OVERLAP = 0.6    # of its question and of its answer
SHINGLE = 5
BLOCK_ITEMS = 2
SHARD_POSTINGS = 500_000

_SPACES = bytes(32 if chr(i) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else i for i in range(256))


def passage_words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_SPACES).split()


def question_answer(text: str) -> tuple[str, str]:
    """All but the last sentence, and the last sentence (sentences end at a line
    break, or at . ! ? before white space)."""
    parts = [x for x in re.split(r"\n+|(?<=[.!?])\s+", text) if passage_words(x)]
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (" ".join(parts), "")


def shingles(w: list[bytes], n: int = SHINGLE) -> set[bytes]:
    if not w:
        return set()
    return {b" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))}


def part_overlap(part: list[bytes], passage: list[bytes]) -> float:
    """Share of the part's shingles that occur in the passage (1 for an empty part)."""
    want = shingles(part)
    if not want:
        return 1.0
    n = min(SHINGLE, len(part))
    have = {b" ".join(passage[i:i + n]) for i in range(len(passage) - n + 1)}
    return len(want & have) / len(want)


def word_edits(part: list[bytes], passage: list[bytes]) -> tuple[int, int]:
    """Least word edit distance of a part (not empty) to any run of the passage,
    and the end of the first such run (Myers' bit vectors)."""
    masks: dict[bytes, int] = {}
    for i, x in enumerate(part):
        masks[x] = masks.get(x, 0) | 1 << i
    full, top = (1 << len(part)) - 1, 1 << len(part) - 1
    up, down, now, best, end = full, 0, len(part), len(part), 0
    for at, x in enumerate(passage, 1):
        same = masks.get(x, 0)
        v = same | down
        h = (((same & up) + up) ^ up) | same
        more, less = down | ~(h | up) & full, up & h
        now += bool(more & top) - bool(less & top)
        more, less = more << 1 & full, less << 1 & full
        up, down = less | ~(v | more) & full, more & v
        if now < best:
            best, end = now, at
    return best, end


def item_overlap(question: list[bytes], answer: list[bytes], passage: list[bytes],
                 min_overlap: float) -> tuple[float, float] | None:
    """Overlaps of question and answer with the passage, or None where it does
    not hold the item (see module text)."""
    q, a = part_overlap(question, passage), part_overlap(answer, passage)
    if q < 1 or a < 1:
        end = 0
        if question:
            n, end = word_edits(question, passage)
            q = max(q, 1 - n / len(question))
        if answer:
            a = max(a, 1 - word_edits(answer, passage[end:])[0] / len(answer))
    low = min(PART_OVERLAP, min_overlap) - 1e-9
    whole = (q * len(question) + a * len(answer)) / max(1, len(question) + len(answer))
    return (q, a) if q >= low and a >= low and whole >= min_overlap - 1e-9 else None


# ------------------------------------------------------------------ index

def build_index(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                shard_postings: int = SHARD_POSTINGS) -> tuple[DataFrame, DataFrame]:
    """Postings ``(shard, item, term, weight)`` and items ``(shard, item, item_id,
    text, n_words)``, written to the checkpoint folder.  ``item`` numbers the
    rows, so repeated item ids stay apart."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], []]
            for item, text in zip(b.column("item").to_pylist(), b.column("text").to_pylist()):
                w = passage_words(text)
                for t, n in Counter(w).items():
                    for col, v in zip(out, (item, t, n, len(w))):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.binary(), pa.int64(), pa.int64()))],
                ["item", "term", "tf", "n_words"])

    require(items, id_col, text_col)
    rows = materialize(items.select(F.monotonically_increasing_id().alias("item"),
                                    F.col(id_col).cast("bigint").alias("item_id"),
                                    text_or_empty(text_col).alias("text")), "bm25-items")
    post = materialize(rows.mapInArrow(cut, "item bigint, term binary, tf bigint, n_words bigint"), "bm25-terms")
    n = rows.count()
    size = post.agg(F.count(F.lit(1)).alias("postings"), F.sum("tf").alias("words")).collect()[0]
    shards = max(1, -(-size["postings"] // shard_postings))
    shard = F.pmod(F.xxhash64("item"), F.lit(shards)).cast("int").alias("shard")
    df = post.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    avg = max(1.0, (size["words"] or 0) / max(1, n))
    w = (post.join(df, "term")
         .withColumn("raw", idf * F.col("tf") * (K1 + 1)
                     / (F.col("tf") + K1 * (1 - B + B * F.col("n_words") / F.lit(avg)))))
    own = w.groupBy("item").agg(F.sum("raw").alias("own"), F.first("n_words").alias("n_words"))
    scored = w.drop("n_words").join(own.drop("n_words"), "item").select(
        shard, "item", "term", (F.col("raw") / F.col("own")).alias("weight"))
    named = rows.join(own, "item").select(shard, "item", "item_id", "text", "n_words")
    return materialize(scored, "bm25-postings"), materialize(named, "bm25-named")


class Shard:
    """Postings of one shard as flat arrays, sorted by term, then item."""

    def __init__(self, items: list[tuple], postings: list[tuple], threshold: float, block_items: int = BLOCK_ITEMS):
        items = sorted(items)
        order = {x[0]: k for k, x in enumerate(items)}
        self.items = [x[1:] for x in items]  # (item_id, text, number of words)
        self.longest = max((x[2] for x in self.items), default=1)
        self.parts = [tuple(passage_words(p) for p in question_answer(x[1])) for x in self.items]
        terms = sorted({bytes(p[1]) for p in postings})
        self.terms = {t: k for k, t in enumerate(terms)}
        post = sorted((self.terms[bytes(term)], order[item], weight) for item, term, weight in postings)
        t = np.array([p[0] for p in post], np.int64)
        self.item = np.array([p[1] for p in post], np.int64)
        self.weight = np.array([p[2] for p in post])
        self.start = np.searchsorted(t, np.arange(len(terms) + 1))
        self.top = np.maximum.reduceat(self.weight, self.start[:-1]) if len(terms) else np.empty(0)
        # block maxima: (term, block) -> largest weight
        key = t * (1 << 32) + self.item // block_items
        u, first = np.unique(key, return_index=True)
        self.block_max = np.maximum.reduceat(self.weight, first) if len(u) else np.empty(0)
        self.block = u % (1 << 32)
        self.block_start = np.searchsorted(u // (1 << 32), np.arange(len(terms) + 1))
        self.n_blocks = -(-len(self.items) // block_items)
        self.block_items, self.threshold = block_items, threshold - 1e-9

    def live_blocks(self, terms: np.ndarray) -> np.ndarray:
        """Blocks whose summed maxima reach the threshold."""
        a, n = self.block_start[terms], self.block_start[terms + 1] - self.block_start[terms]
        at = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())
        bound = np.bincount(self.block[at], self.block_max[at], self.n_blocks)
        return np.flatnonzero(bound >= self.threshold)

    def search(self, terms: np.ndarray, blocks: np.ndarray) -> list[tuple[int, float]]:
        """WAND inside the given blocks: (item, score) of all items at or above
        the threshold."""
        found = []
        for b in blocks.tolist():
            lo, hi = b * self.block_items, (b + 1) * self.block_items
            cursors = []  # [item, position, end, term maximum]
            for t in terms.tolist():
                s, e = self.start[t], self.start[t + 1]
                p = s + int(np.searchsorted(self.item[s:e], lo))
                end = s + int(np.searchsorted(self.item[s:e], hi))
                if p < end:
                    cursors.append([int(self.item[p]), p, end, float(self.weight[p:end].max())])
            while cursors:
                cursors.sort(key=lambda c: c[0])
                bound, pivot = 0.0, None
                for c in cursors:
                    bound += c[3]
                    if bound >= self.threshold:
                        pivot = c[0]
                        break
                if pivot is None:
                    break
                if cursors[0][0] == pivot:
                    score = 0.0
                    for c in cursors:
                        if c[0] == pivot:
                            score += float(self.weight[c[1]])
                            c[1] += 1
                    if score >= self.threshold:
                        found.append((pivot, score))
                else:
                    for c in cursors:
                        while c[0] < pivot and c[1] < c[2]:
                            c[1] += 1
                            c[0] = int(self.item[c[1]]) if c[1] < c[2] else hi
                cursors = [c for c in cursors if c[1] < c[2]]
                for c in cursors:
                    c[0] = int(self.item[c[1]])
        return found

    def leaks(self, text: str, min_overlap: float) -> dict[int, tuple[float, int, float, float]]:
        """Verified items of a text: item -> (score, first word of the passage,
        question overlap, answer overlap) of its best passage."""
        w = passage_words(text)
        get = self.terms.get
        number = np.array([get(x, -1) for x in w], np.int64)
        all_terms = np.unique(number[number >= 0])
        if not len(all_terms) or not len(self.live_blocks(all_terms)):
            return {}
        out: dict[int, tuple[float, int, float, float]] = {}
        stride = self.longest
        for at in range(0, max(1, len(w) - stride), stride):
            part = number[at:at + 2 * stride]
            terms = np.unique(part[part >= 0])
            if not len(terms) or not len(blocks := self.live_blocks(terms)):
                continue
            passage = w[at:at + 2 * stride]
            for item, score in self.search(terms, blocks):
                if item in out and out[item][0] >= score:
                    continue
                if held := item_overlap(*self.parts[item], passage, min_overlap):
                    out[item] = (score, at, *held)
        return out


_CACHE: dict[int, Shard] = {}


def _shard(number: int, broadcast, threshold: float) -> Shard:
    """The arrays of a broadcast shard, built once per Python worker."""
    if number not in _CACHE:
        _CACHE.clear()
        _CACHE[number] = Shard(*broadcast.value, threshold)
    return _CACHE[number]


def _shards(index: tuple[DataFrame, DataFrame]):
    """(number, broadcast) of the shards of a written index, one at a time (each
    of bounded size)."""
    post, items = index
    sc = post.sparkSession.sparkContext
    for r in items.select("shard").distinct().orderBy("shard").toLocalIterator():
        mine = F.col("shard") == r["shard"]
        rows = [tuple(x) for x in items.where(mine).select("item", "item_id", "text", "n_words").collect()]
        b = sc.broadcast((rows, [tuple(x) for x in post.where(mine).select("item", "term", "weight").collect()]))
        yield b._jbroadcast.id(), b


_LEAK = "doc_id bigint, item_id bigint, score double, passage_start bigint, q_overlap double, a_overlap double"


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD,
               min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """One row per (doc_id, item) with a verified passage: its score, first word
    and overlaps."""
    require(docs, id_col, text_col)
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), text_or_empty(text_col).alias("text"))
    found = None
    for number, shared in _shards(build_index(items, item_col, item_text)):
        def run(batches: Iterator[pa.RecordBatch], number=number, shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                shard = _shard(number, shared, threshold)
                out = []
                for doc, text in zip(b.column("id").to_pylist(), b.column("text")):
                    for item, (s, at, q, a) in shard.leaks(text.as_py(), min_overlap).items():
                        out.append((doc, shard.items[item][0], s, at, q, a))
                cols = list(zip(*out)) or [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 2 + [pa.float64(), pa.int64()]
                                                    + [pa.float64()] * 2)],
                    ["doc_id", "item_id", "score", "passage_start", "q_overlap", "a_overlap"])

        part = src.mapInArrow(run, _LEAK)
        found = part if found is None else found.unionAll(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], _LEAK)
    best = F.max_by(F.struct("score", "passage_start", "q_overlap", "a_overlap"),
                    F.struct("score", -F.col("passage_start")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("x")).select("doc_id", "item_id", "x.*")


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text: str = "text", threshold: float = THRESHOLD, min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """``docs`` without the documents that hold a verified benchmark item; one
    filtering pass per shard, no shuffle."""
    require(docs, text_col)
    out = docs
    for number, shared in _shards(build_index(items, item_col, item_text)):
        def run(batches: Iterator[pa.RecordBatch], number=number, shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                shard = _shard(number, shared, threshold)
                yield b.filter(pa.array([not shard.leaks(t.as_py() or "", min_overlap) for t in b.column(text_col)],
                                        pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out
