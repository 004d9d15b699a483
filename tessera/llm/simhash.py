"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: the text is lower-cased (A-Z only) and cut into words
``[^\\x20\\x09-\\x0D]+``; ``shingle`` consecutive words joined by one space form
a shingle (fewer words: the whole sequence; none: fingerprint zero).  Bit k is
set when it is set in over half of the shingles' XXH64 values (seed 42,
repeats included).

Links (at most ``radius`` differing bits) are found by covering masks: bit i
gets the (radius+1)-bit vector ``1 + i mod (2^(radius+1) - 1)``, and for each
non-zero vector v there is one table whose mask holds the bits whose vector has
an odd product with v.  Any ``radius`` differing bits span at most ``radius``
dimensions, so some v is orthogonal to all of them: that table's mask avoids
them and the pair meets in one of its buckets, always.

Work is done on distinct fingerprints (copies collapse in a map-side combined
aggregate):

* a bucket of two is compared from its minimum and maximum, straight from the
  bucket aggregate;
* a larger bucket of up to ``block`` fingerprints goes to one task, which
  compares it with numpy and emits a spanning forest, never its pairs;
* the members of a bucket beyond ``block`` are never brought together: each
  emits all values within ``radius // 2`` flips (``radius`` even; the other
  half comes from the partner), equal values are combined by ``min`` in an
  aggregate, and every member links to that minimum.  Two fingerprints that
  share such a value differ in at most ``radius`` bits, and any pair within
  ``radius`` shares one, so this is exact too.

Components come from ``connected_components`` over the links.

Nulls: a null text is an empty one; null ids are kept (they never become a
component id; a component of null ids only has component null).  Repeated rows
and ties change nothing; an empty table gives an empty result; extra columns
are ignored by the pair search and kept by ``drop_near_duplicates``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import connected_components, require, text_or_empty, words
from tessera.session import materialize

SHINGLE = 4
RADIUS = 4
SEED = 42
BLOCK = 4096
_CHUNK = 1 << 15  # shingles hashed at a time: memory stays bounded on any text


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    import xxhash

    w = words(text.encode("utf-8", "surrogatepass").lower())
    if not w:
        return 0
    joined = b" ".join(w)
    h = xxhash.xxh64_intdigest
    if len(w) <= shingle:
        return h(joined, SEED)
    cuts = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], cuts + 1))[:len(w) - shingle + 1]
    ends = np.concatenate((cuts, [len(joined)]))[shingle - 1:]
    ones = np.zeros(64, np.int64)
    for k in range(0, len(starts), _CHUNK):
        hashes = [h(joined[a:b], SEED) for a, b in
                  zip(starts[k:k + _CHUNK].tolist(), ends[k:k + _CHUNK].tolist())]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, th, fp)``: one row per input row; ``th`` is a hash of the text
    that tells rows apart which repeat an id, ``fp`` the fingerprint as a signed
    long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column("text")), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("th"), pa.array(fp.view(np.int64))],
                                             ["doc_id", "th", "fp"])

    require(docs, id_col, text_col)
    t = text_or_empty(text_col)
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(t).alias("th"), t.alias("text"))
    return src.mapInArrow(run, "doc_id bigint, th bigint, fp bigint")


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """The ``2^(radius+1) - 1`` masks (see module text), as unsigned numbers."""
    n = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(bits) if ((1 + i % n) & v).bit_count() % 2) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(v: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among distinct fingerprints ``v``."""
    todo, out = np.arange(len(v)), []
    while len(todo):
        front, todo = todo[:1], todo[1:]
        while len(front) and len(todo):
            nxt = []
            for u in front.tolist():
                near = np.bitwise_count(v[todo] ^ v[u]) <= radius
                if near.any():
                    hit = todo[near]
                    out += [(int(v[u]), int(v[x])) for x in hit.tolist()]
                    nxt.append(hit)
                    todo = todo[~near]
            front = np.concatenate(nxt) if nxt else np.empty(0, np.int64)
    return out


def _bucket_links(radius: int):
    """mapInArrow body over rows (t, k, fp) sorted by (t, k): links per bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

        def emit(t, k, fp, cuts):
            links = []
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                links += _forest(np.unique(fp[i:j]).view(np.uint64), radius)
            a = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], schema=schema)

        for b in batches:
            cols = [b.column(c).to_numpy(zero_copy_only=False) for c in ("t", "k", "fp")]
            if rest is not None:
                cols = [np.concatenate(x) for x in zip(rest, cols)]
            if not len(cols[0]):
                continue
            t, k, fp = cols
            new = np.flatnonzero((t[1:] != t[:-1]) | (k[1:] != k[:-1])) + 1
            cuts = np.concatenate(([0], new))
            last = cuts[-1]  # the last bucket may go on in the next batch
            if last:
                yield emit(t, k, fp, cuts)
            rest = [x[last:] for x in cols]
        if rest is not None and len(rest[0]):
            yield emit(*rest, np.array([0, len(rest[0])]))
    return run


def _ball(half: int, bits: int = 64):
    """mapInArrow body: fp -> (fp, v) for every v within ``half`` flips."""
    from itertools import combinations

    flips = np.array([sum(1 << i for i in c) for n in range(half + 1) for c in combinations(range(bits), n)],
                     np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for k in range(0, len(fp), 64):
                part = fp[k:k + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(part, len(flips)).view(np.int64)),
                     pa.array((part[:, None] ^ flips[None, :]).ravel().view(np.int64))], ["fp", "v"])
    return run


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)`` whose connected components are those of "at most
    ``radius`` differing bits" over the distinct values of ``fps.fp``."""
    if radius % 2:
        raise ValueError("the radius must be even")
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k"))
                       for i, m in enumerate(covering_masks(radius))])
    rows = fps.select("fp").select("fp", F.explode(tables).alias("x")).select("fp", "x.t", "x.k")
    buckets = materialize(
        rows.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi"))
        .where(F.col("n") > 1), "simhash-buckets")
    pairs = (buckets.where((F.col("n") == 2)
                           & (F.bit_count(F.col("lo").bitwiseXOR(F.col("hi"))) <= radius))
             .select(F.col("lo").alias("a"), F.col("hi").alias("b")))
    members = materialize(rows.join(buckets.where(F.col("n") > 2).select("t", "k", "n"), ["t", "k"]),
                          "simhash-members")
    small = (members.where(F.col("n") <= block).select("t", "k", "fp")
             .repartition("t", "k").sortWithinPartitions("t", "k")
             .mapInArrow(_bucket_links(radius), "a bigint, b bigint"))
    hot = members.where(F.col("n") > block).select("fp").distinct()
    ball = materialize(hot.mapInArrow(_ball(radius // 2), "fp bigint, v bigint"), "simhash-ball")
    least = materialize(ball.groupBy("v").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n"))
                        .where(F.col("n") > 1).select("v", "b"), "simhash-least")
    far = ball.join(least, "v").where(F.col("fp") != F.col("b")).select(F.col("fp").alias("a"), "b")
    return pairs.unionAll(small).unionAll(far)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``(doc_id, th, fp, component_id)``, one row per input row; the component
    id is the smallest doc_id reachable over links, itself included."""
    fps = materialize(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    comp = connected_components(fingerprint_links(distinct, radius, block))
    comp = comp.select(F.col("id").alias("fp"), "component")
    of = distinct.join(comp, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    of = materialize(of, "simhash-components")
    least = materialize(of.groupBy("component").agg(F.min("least").alias("component_id")), "simhash-ids")
    by_fp = materialize(of.join(least, "component").select("fp", "component_id", "component"), "simhash-by-fp")
    return fps.join(by_fp, "fp").select("doc_id", "th", "fp", "component_id", "component")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = SHINGLE, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``docs`` with one row of every near-duplicate group: the smallest doc_id
    (rows without an id come last; an exact repeat of the kept row goes)."""
    near = near_duplicates(docs, id_col, text_col, shingle, radius, block)
    kept = materialize(
        near.groupBy("component")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("k"))
        .select(F.col("k.doc_id").alias("_id"), F.col("k.th").alias("_th")), "simhash-kept")
    # the rows travel under names that no column of the caller can have
    tag = uuid.uuid4().hex
    rows = docs.select(F.struct(*docs.columns).alias(tag), F.col(id_col).cast("bigint").alias(f"{tag}_id"),
                       F.xxhash64(text_or_empty(text_col)).alias(f"{tag}_th"))
    joined = rows.join(kept, rows[f"{tag}_id"].eqNullSafe(kept["_id"]) & (rows[f"{tag}_th"] == kept["_th"]))
    one = Window.partitionBy(f"{tag}_id", f"{tag}_th").orderBy(F.lit(0))
    return joined.withColumn("_n", F.row_number().over(one)).where(F.col("_n") == 1).select(f"{tag}.*")
