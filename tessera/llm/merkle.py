"""Document fingerprints: Merkle trees over sections, paragraphs and spans.

A text is cut without loss, so equal roots mean equal texts:

* paragraph: a line with the line breaks behind it;
* section: paragraphs up to one that blank lines follow, or whose digest ends a
  group of about ``SECTION`` paragraphs, so that an edit moves section borders only near it;
* span: words of a paragraph up to one that ends a clause or ends with one of
  ``CUT``, at most ``SPAN`` characters; every word where little is left to compare.

A paragraph's digest is that of its UTF-8 bytes, those of sections and the root cover their level
and their children's digests.  The fingerprint is the root.  Two trees are compared
from their roots: equal digests are equal texts, and only below nodes without an equal partner
the next level is looked at, down to the spans (64-bit hashes) inside differing paragraphs.  ``likeness`` is the share of characters in equal
nodes (Dice); ``differing`` gives the stretches of characters without a partner.

``edited_and_next`` needs each document's successor by id.  Texts are shuffled
once, range-partitioned and sorted by id; every task pairs neighbours as they
pass.  The first and the last document of each range are
written beside the results (two per task), and a small join over them closes the gaps and the circle.

Nulls: a null text is an empty one; a null doc_id sorts before all others.  Rows
with one doc_id are ordered by their texts' hashes.  An empty text has the
fingerprint of an empty root; two empty texts have likeness 1, an empty and a
non-empty one 0.  A single document is its own successor.  An empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import require, text_or_empty
from tessera.session import materialize

SECTION = 8             # paragraphs of a section, on average
SPAN = 160              # characters of a span at most
CUT = "dny"             # letters that end a span as word ends
SHORT = 1000            # where fewer characters are left to compare every word is a span
DIGEST = 16

_PARAGRAPH = re.compile(r"[^\n]*\n+|[^\n]+")
_SPANS = re.compile(r"(?s).{1,%d}?(?:[%s.,;:!?|]\s+|\Z)|.{1,%d}" % (SPAN, CUT, SPAN))
_WORDS = re.compile(r"\s*\S+\s*|\s+")
_CUT_BELOW = 256 // SECTION

#: (digest, characters, children); a paragraph has its ``Spans`` in their place
Node = tuple[bytes | int, int, object]


class Spans:
    """The spans of a paragraph, cut when a comparison gets that far: words, or
    longer pieces where much text is left to compare."""

    __slots__ = ("text", "cut")

    def __init__(self, text: str):
        self.text = text
        self.cut: dict[re.Pattern, list[Node]] = {}

    def of(self, pattern: re.Pattern) -> list[Node]:
        found = self.cut.get(pattern)
        if found is None:
            found = self.cut[pattern] = [(xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")), len(x), ())
                                         for x in pattern.findall(self.text)]
        return found


def _inner(level: bytes, children: list[Node]) -> Node:
    digest = hashlib.blake2b(b"".join([c[0] for c in children]), digest_size=DIGEST, person=level).digest()
    return digest, sum([c[1] for c in children]), tuple(children)


def _leaf(paragraph: str) -> Node:
    digest = hashlib.blake2b(paragraph.encode("utf-8", "surrogatepass"), digest_size=DIGEST, person=b"paragraph").digest()
    return digest, len(paragraph), Spans(paragraph)


def tree(text: str, known: dict[str, Node] | None = None) -> Node:
    """The Merkle tree of a text: root, sections, paragraphs.
    ``known``: leaves of paragraphs, which are used and added to."""
    known = {} if known is None else known
    sections, held = [], []
    for paragraph in _PARAGRAPH.findall(text):
        node = known.get(paragraph)
        if node is None:
            node = known[paragraph] = _leaf(paragraph)
        held.append(node)
        if node[0][0] < _CUT_BELOW or paragraph.endswith("\n\n"):
            sections.append(_inner(b"section", held))
            held = []
    if held:
        sections.append(_inner(b"section", held))
    return _inner(b"text", sections)


def _unmatched(a: list[tuple[int, Node]], b: list[tuple[int, Node]]):
    """The nodes of both lists (start, node) that have no equal one in the other;
    copies of a node match as often as both lists hold it."""
    in_a, in_b = [n[0] for _, n in a], [n[0] for _, n in b]
    if set(in_a).isdisjoint(in_b):
        return a, b
    shared = Counter(in_a) & Counter(in_b)

    def rest(nodes):
        left = dict(shared)
        out = []
        for x in nodes:
            k = left.get(x[1][0], 0)
            if k:
                left[x[1][0]] = k - 1
            else:
                out.append(x)
        return out

    return rest(a), rest(b)


def _below(nodes: list[tuple[int, Node]], pattern: re.Pattern | None = None) -> list[tuple[int, Node]]:
    out = []
    for start, n in nodes:
        for c in n[2].of(pattern) if pattern else n[2]:
            out.append((start, c))
            start += c[1]
    return out


def _differ(a: Node, b: Node) -> tuple[list[tuple[int, Node]], list[tuple[int, Node]]]:
    """Down from the roots: what is left without an equal node at the last level."""
    left, right = _unmatched([(0, a)], [(0, b)])
    for _ in range(2):
        left, right = _unmatched(_below(left), _below(right))
    short = min(sum([n[1] for _, n in left]), sum([n[1] for _, n in right])) < SHORT
    pattern = _WORDS if short else _SPANS
    return _unmatched(_below(left, pattern), _below(right, pattern))


def _joined(nodes: list[tuple[int, Node]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, n in nodes:
        if out and sum(out[-1]) == start:
            out[-1] = (out[-1][0], out[-1][1] + n[1])
        else:
            out.append((start, n[1]))
    return out


def differing(a: Node, b: Node) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """The stretches ``(start, characters)`` of each text without an equal one in
    the other: where it was edited."""
    left, right = _differ(a, b)
    return _joined(left), _joined(right)


def _like(a: Node, b: Node, left, right) -> float:
    if a[0] == b[0]:
        return 1.0
    return 1 - (sum([n[1] for _, n in left]) + sum([n[1] for _, n in right])) / (a[1] + b[1])


def likeness(a: Node, b: Node) -> float:
    """Share of both texts' characters in equal nodes, from 0 to 1."""
    return _like(a, b, *_differ(a, b))


# --------------------------------------------------------------- operators

_NODES = "array<struct<level: int, start: bigint, n_chars: bigint, digest: string>>"


def trees(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, nodes)``: every node of each document's tree (level
    0 the root, 1 sections, 2 paragraphs), in text order within its level."""
    require(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("level", pa.int32()), ("start", pa.int64()), ("n_chars", pa.int64()),
                                   ("digest", pa.string())]))
        for b in batches:
            roots, nodes = [], []
            for t in b.column("text"):
                level = [(0, tree(t.as_py()))]
                roots.append(level[0][1][0].hex())
                nodes.append([])
                for k in range(3):
                    nodes[-1] += [(k, start, n[1], n[0].hex()) for start, n in level]
                    level = _below(level) if k < 2 else []
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(roots, pa.string()), pa.array(nodes, kind)],
                                             ["doc_id", "fingerprint", "nodes"])

    return (docs.select(F.col(id_col).cast("bigint").alias("id"), text_or_empty(text_col).alias("text"))
            .mapInArrow(run, f"doc_id bigint, fingerprint string, nodes {_NODES}"))


_RESULT = [("doc_id", pa.int64(), "bigint"), ("n_chars", pa.int64(), "bigint"), ("edited_sha256", pa.string(), "string"),
           ("fingerprint", pa.string(), "string"), ("edited_fingerprint", pa.string(), "string"),
           ("near_edited", pa.float64(), "double"), ("near_next", pa.float64(), "double"),
           ("edit_start", pa.int64(), "bigint"), ("n_edits", pa.int32(), "int")]
RESULT = ", ".join(f"{c} {t}" for c, _, t in _RESULT)
_ENDS = [("partition", pa.int32()), ("end", pa.string()), ("text", pa.string())]


def half_replaced(text: str, other: str) -> str:
    """The last half of ``text`` replaced by the first as many characters of ``other``."""
    n = len(text) // 2
    return text[:len(text) - n] + other[:n]


def _compare(doc, text: str, of: Node, following: str, next_tree: Node, known: dict[str, Node] | None = None) -> tuple:
    edited = half_replaced(text, following)
    new = tree(edited, known)
    left, right = _differ(of, new)
    places = _joined(left)
    return (doc, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), of[0].hex(),
            new[0].hex(), _like(of, new, left, right), likeness(of, next_tree), places[0][0] if places else None,
            len(places))


def _batch(rows: list[tuple], ends: list[tuple] = ()) -> pa.RecordBatch:
    """Result rows (without an end) and rows of range ends (doc_id and text alone)."""
    rows = [(*r, None, None, None) for r in rows] + [(doc, *[None] * (len(_RESULT) - 1), *rest) for doc, *rest in ends]
    kinds = [t for _, t, _ in _RESULT] + [t for _, t in _ENDS]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                      [c for c, *_ in _RESULT] + [c for c, _ in _ENDS])


def edited_and_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited one (the last half replaced by
    the beginning of the next document), and their likenesses."""
    require(docs, id_col, text_col)
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), text_or_empty(text_col).alias("text"))
    key = F.xxhash64("text")
    # a range holds whole rows only; rows of one id may lie in several ranges
    ranged = (src.withColumn("_h", key).repartitionByRange("id", "_h").sortWithinPartitions("id", "_h")
              .select("id", "text", F.spark_partition_id().alias("part")))

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = part = None
        before: dict[str, Node] = {}    # leaves of the held document
        for b in batches:
            rows, ends = [], []
            for doc, text, p in zip(b.column("id").to_pylist(), b.column("text"), b.column("part").to_pylist()):
                text, part = text.as_py(), p
                leaves: dict[str, Node] = {}
                of = tree(text, leaves)
                if held is None:
                    ends.append((doc, part, "first", text))
                else:
                    rows.append(_compare(*held, text, of, before | leaves))
                held, before = (doc, text, of), leaves
            if rows or ends:
                yield _batch(rows, ends)
        if held is not None:
            yield _batch([], [(held[0], part, "last", held[1])])

    found = materialize(ranged.mapInArrow(neighbours, RESULT + ", partition int, end string, text string"),
                        "merkle-neighbours")
    ends = found.where(F.col("end").isNotNull())
    # one short row per range: the range after a range, and the first one after the last
    after = Window.orderBy("partition")
    numbers = ends.where(F.col("end") == "first").select("partition")
    following = numbers.select("partition", F.coalesce(F.lead("partition").over(after),
                                                       F.first("partition").over(after)).alias("next"))
    last = ends.where(F.col("end") == "last").select("partition", F.col("doc_id").alias("id"), "text")
    firsts = ends.where(F.col("end") == "first").select(F.col("partition").alias("next"), F.col("text").alias("following"))
    gaps = last.join(following, "partition").join(firsts, "next").select("id", "text", "following")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [_compare(doc, a.as_py(), tree(a.as_py()), f.as_py(), tree(f.as_py()))
                    for doc, a, f in zip(b.column("id").to_pylist(), b.column("text"), b.column("following"))]
            if rows:
                yield _batch(rows).select([c for c, *_ in _RESULT])

    columns = [c for c, *_ in _RESULT]
    return found.where(F.col("end").isNull()).select(*columns).unionByName(gaps.mapInArrow(close, RESULT))
