"""Edit-aware token counts.

Per document a segment tree over pre-token segments: the text is cut at spaces
that follow a character other than white space - there the tokenizer's pattern
always starts a new pre-token, whatever stands around it - into leaves of about
``LEAF`` characters.  A leaf holds its number of characters and of tokens, an
inner node the sums of its subtree, so the root has the document's count and a
place is found in O(log leaves).

An edit (start, n_deleted, inserted) touches some leaves.  Their text after the
edit is re-encoded together with boundary context: while the region's first
character is not such a cut any more the leaf before joins it, and while the
character before the next leaf is white space the leaf after joins it.  The
result goes to the region's first leaf, the other leaves become empty, and the
subtree sums above them are updated.  A leaf that has grown beyond ``SPLIT``
times ``LEAF`` has its tree built anew from the known leaves and that leaf's own
text.

``start`` counts characters of the text as the edits before have left it; a
start or a length beyond the end is cut off at the end, negative ones count as
0, a null inserted text as empty.

Trees are rows: ``build_trees`` writes (doc_id, leaf_chars, leaf_tokens), and
``apply_edits`` takes texts, trees and each document's edits in order.  Both are
map-only passes over whole texts; ``edit_and_count`` does both in one.

Nulls: a null text is an empty one, a null edit list is no edit, a null edit is
skipped.  Repeated rows are counted each; very long texts have more leaves; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import bpe
from tessera.llm.common import require, text_or_empty

LEAF = 256
SPLIT = 8
EDITS = "array<struct<start:bigint,n_deleted:bigint,inserted:string>>"


def cut(text: str, leaf: int = LEAF) -> list[int]:
    """Starts of the leaves of a text: the first safe cut at or after every
    ``leaf`` characters."""
    starts, at = [0], leaf
    while (at := text.find(" ", at)) >= 0:
        if text[at - 1].isspace():
            at += 1
        else:
            starts.append(at)
            at += leaf
    return starts


class TokenTree:
    """Segment tree of one document.  ``text`` is the current text."""

    def __init__(self, text: str, chars: np.ndarray, tokens: np.ndarray, vocabulary: str | None = None,
                 leaf: int = LEAF):
        self.text, self.vocabulary, self.leaf = text, vocabulary, leaf
        self.encoded = 0  # characters encoded so far
        self._set(np.asarray(chars, np.int64), np.asarray(tokens, np.int64))

    @classmethod
    def build(cls, text: str, vocabulary: str | None = None, leaf: int = LEAF) -> TokenTree:
        starts = cut(text, leaf)
        ends = [*starts[1:], len(text)]
        t = cls(text, [b - a for a, b in zip(starts, ends)],
                [bpe.count(text[a:b], vocabulary) for a, b in zip(starts, ends)], vocabulary, leaf)
        t.encoded = len(text)
        return t

    def _set(self, chars: np.ndarray, tokens: np.ndarray) -> None:
        self.size = 1 << max(0, len(chars) - 1).bit_length()
        self.sums = np.zeros((2 * self.size, 2), np.int64)
        self.sums[self.size:self.size + len(chars), 0] = chars
        self.sums[self.size:self.size + len(chars), 1] = tokens
        level = self.size
        while level > 1:
            level //= 2
            self.sums[level:2 * level] = self.sums[2 * level:4 * level].reshape(level, 2, 2).sum(1)

    @property
    def count(self) -> int:
        return int(self.sums[1, 1])

    def leaves(self) -> np.ndarray:
        """(chars, tokens) of the leaves in use."""
        rows = self.sums[self.size:]
        used = np.flatnonzero(rows[:, 0])
        return rows[:used[-1] + 1] if len(used) else rows[:1]

    def find(self, at: int) -> tuple[int, int]:
        """(leaf, its first character) of the last leaf with text that starts at
        or before ``at``."""
        node, start = 1, 0
        at = min(at, len(self.text) - 1) if self.text else 0
        while node < self.size:
            node *= 2
            if (left := int(self.sums[node, 0])) <= at - start:
                start += left
                node += 1
        return node - self.size, start

    def _put(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.size
        step = np.array([chars, tokens]) - self.sums[node]
        while node:
            self.sums[node] += step
            node //= 2

    def edit(self, start: int, n_deleted: int, inserted: str) -> None:
        old = self.text
        start = max(0, min(start, len(old)))
        end = start + max(0, min(n_deleted, len(old) - start))
        first, a = self.find(start)
        if start == a and a:
            # the character before the edit is context: it may meet the inserted text
            first, a = self.find(a - 1)
        last, b = self.find(max(start, end - 1))
        b += int(self.sums[last + self.size, 0])
        new = old[:start] + inserted + old[end:]
        grown = len(new) - len(old)
        # a cut stays one if a space still stands there after a character that is not white space
        while a and not (a < len(new) and new[a] == " " and not new[a - 1].isspace()):
            first, a = self.find(a - 1)
        while b < len(old) and not (b + grown > a and old[b] == " " and not new[b + grown - 1].isspace()):
            last, b = self.find(b)
            b += int(self.sums[last + self.size, 0])
        region = new[a:b + grown]
        self.text = new
        if len(region) > SPLIT * self.leaf + int(self.sums[first + self.size:last + 1 + self.size, 0].sum()):
            part = TokenTree.build(region, self.vocabulary, self.leaf)
            rows = self.sums[self.size:]
            rows = np.concatenate((rows[:first], part.leaves(), rows[last + 1:]))
            rows = rows[rows[:, 0] > 0]
            self._set(rows[:, 0], rows[:, 1])
        else:
            self._put(first, len(region), bpe.count(region, self.vocabulary))
            for leaf in range(first + 1, last + 1):
                self._put(leaf, 0, 0)
        self.encoded += len(region)


def _edits(value) -> list[tuple[int, int, str]]:
    return [(e["start"] or 0, e["n_deleted"] or 0, e["inserted"] or "") for e in value or [] if e is not None]


def build_trees(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
                leaf: int = LEAF) -> DataFrame:
    """``(doc_id, leaf_chars, leaf_tokens)``: the leaves of every document's tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaves = [TokenTree.build(t.as_py(), vocabulary, leaf).leaves() for t in b.column("text")]
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([x[:, 0] for x in leaves], longs),
                 pa.array([x[:, 1] for x in leaves], longs)], ["doc_id", "leaf_chars", "leaf_tokens"])

    require(docs, id_col, text_col)
    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))
            .mapInArrow(run, "doc_id bigint, leaf_chars array<bigint>, leaf_tokens array<bigint>"))


_COUNTS = ("doc_id bigint, tokens_before bigint, tokens_after bigint, n_edits int, encoded_chars bigint, "
           "chars_after bigint")


def _counter(trees: bool, vocabulary: str | None, leaf: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for r in range(b.num_rows):
                get = lambda c: b.column(c)[r].as_py()  # noqa: B023,E731
                text, edits = get("text"), _edits(get("edits"))
                t = (TokenTree(text, get("leaf_chars"), get("leaf_tokens"), vocabulary, leaf) if trees
                     else TokenTree.build(text, vocabulary, leaf))
                before, t.encoded = t.count, 0
                for e in edits:
                    t.edit(*e)
                for col, v in zip(out, (get("doc_id"), before, t.count, len(edits), t.encoded, len(t.text), t.text)):
                    col.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
            names = ["doc_id", "tokens_before", "tokens_after", "n_edits", "encoded_chars", "chars_after", "text"]
            n = 7 if keep_text else 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out[:n], kinds)], names[:n])
    return run


def apply_edits(docs: DataFrame, trees: DataFrame, edits: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                vocabulary: str | None = None, leaf: int = LEAF, keep_text: bool = False) -> DataFrame:
    """Counts after the edits ``(doc_id, seq, start, n_deleted, inserted)``, from
    stored trees: ``encoded_chars`` tells how much was encoded again.  The ids
    must be unique.  Documents without edits keep their counts; edits of unknown
    documents are ignored.  The edits of one document depend on each other and
    are gathered in one row."""
    each = (edits.groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
            .agg(F.array_sort(F.collect_list(F.struct("seq", "start", "n_deleted", "inserted"))).alias("e"))
            .select("doc_id", F.transform("e", lambda x: F.struct(
                x["start"].cast("bigint").alias("start"), x["n_deleted"].cast("bigint").alias("n_deleted"),
                x["inserted"].alias("inserted"))).alias("edits")))
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return (texts.join(trees, "doc_id").join(each, "doc_id", "left")
            .mapInArrow(_counter(True, vocabulary, leaf, keep_text), _COUNTS + ", text string" * keep_text))


def edit_and_count(docs: DataFrame, edits: Column, id_col: str = "doc_id", text_col: str = "text",
                   vocabulary: str | None = None, leaf: int = LEAF, keep_text: bool = False) -> DataFrame:
    """Builds each document's tree and applies its edits (a column of type
    ``EDITS``) in one pass.  ``encoded_chars`` counts the edits' share alone."""
    require(docs, id_col, text_col)
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"),
                      edits.cast(EDITS).alias("edits"))
    return src.mapInArrow(_counter(False, vocabulary, leaf, keep_text), _COUNTS + ", text string" * keep_text)
