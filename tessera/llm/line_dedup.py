"""Line deduplication by a deletion-neighbourhood join.

Lines are cut at line breaks and compared as word sequences (white space between
words does not count; blank lines take no part and stay).  Two lines are equal,
or near when one word is replaced, inserted or deleted and both have at least
``MIN_WORDS`` words (so at least 0.8 of the longer one agrees).  Occurrences are
ordered by (doc_id, line number).  A line stays at its first occurrence, unless
an earlier line that stays is near to it; then all its occurrences go.

1. One pass cuts the texts into lines: 128-bit hash, position, and four prefilter
   keys.  With one edit the first or the second half of a line is untouched; cut
   for the longer line's number of words m, a line of n words has the keys of
   m = n (as the longer or an equally long one) and of m = n + 1 (as the shorter
   one).  Lines that share no key with a different line have no near line, so
   they are not expanded.  Nothing is lost by this.
2. Equal lines: an aggregate over the hash gives the first occurrence.
3. The other lines emit their deletion variants as hashed keys: for each word p
   of the half that may differ, the line without p, once together with p and the
   length (two equally long lines that share it differ in word p alone) and once
   by itself, to meet a shorter line as it is.  The keys are cut from prefix
   hashes, so a deletion costs the same in lines of any length.  All members of such a key are
   within one edit by construction, so the earliest one is found by ``min`` in an
   aggregate - the members of a large group never meet as pairs.
4. Lines without an earlier near line stay.  A line goes if its earliest near line
   is one of these.  The others (in a chain A, B, C line B goes, so C is near to no
   line that stays) are decided in rounds, each written: a line goes once a near
   earlier line stays, and stays once all its near earlier lines go.  Their number
   is that of the longest chain of such lines; a round reads these lines' groups only.
5. Each line's earliest near line that stays is checked on the words of both (edit
   distance exactly one).

Joins read written tables, so AQE can split the rows of a frequent line.

Nulls: a null text has no line; a null doc_id comes last in the order.  Rows that
repeat a doc_id with the same text are one document; with another text they are
ordered by a hash of it.  An empty table gives an empty result; extra columns are
ignored by ``repeated_lines`` and kept by ``drop_repeated_lines``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import require, text_or_empty
from tessera.session import materialize

MIN_WORDS = 5
_LAST = (1 << 63) - 1  # the place of a null id in the order


def _doc(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LAST))


def within_one(a: list, b: list) -> bool:
    """Whether two word lists are exactly one edit apart."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _lines(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """(did, th, text) -> a row per line with words."""
    import xxhash

    h64, h128 = xxhash.xxh64_intdigest, xxhash.xxh3_128_intdigest
    low = (1 << 64) - 1
    for b in batches:
        for k in range(0, b.num_rows, 512):
            part = b.slice(k, 512)
            doc, at, h1, h2, keys = [], [], [], [], []
            for r, text in enumerate(part.column("text")):
                for i, line in enumerate(text.as_py().encode("utf-8", "surrogatepass").split(b"\n")):
                    w = line.split()
                    if not w:
                        continue
                    joined = b" ".join(w)
                    x = h128(joined)
                    doc.append(r)
                    at.append(i)
                    h1.append(x & low)
                    h2.append(x >> 64)
                    n = len(w)
                    if n < min_words:
                        keys.append(None)
                        continue
                    end = list(accumulate(map(len, w)))  # letters up to each word's end, spaces not counted
                    a, c = n // 2, (n + 1) // 2
                    cut = end[a - 1] + a          # first byte of word a
                    cut1 = cut if a == c else end[c - 1] + c
                    # the second half for m = n + 1 has m - m // 2 words: it starts at word n - (n + 1 - c)
                    s = c - 1
                    tail1 = cut if s == a else end[s - 1] + s
                    v = np.array([h64(joined[:cut - 1], 2 * n), h64(joined[cut:], 2 * n + 1),
                                  h64(joined[:cut1 - 1], 2 * n + 2), h64(joined[tail1:], 2 * n + 3)], np.uint64)
                    keys.append(v.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column("did").take(pa.array(doc, pa.int32())), part.column("th").take(pa.array(doc, pa.int32())),
                 pa.array(at, pa.int32()), _signed(h1), _signed(h2), pa.array(keys, pa.list_(pa.int64()))],
                ["did", "th", "line", "h1", "h2", "keys"])


_PRIME = (1 << 61) - 1
_BASE = 0x1A2B3C4D5E6F7081
_BACK = pow(_BASE, -1, _PRIME)


def prefix_hashes(words: list[bytes]) -> list[int]:
    """Polynomial hashes of the first 0, 1, .. words, modulo a Mersenne prime."""
    import xxhash

    out, value, power = [0], 0, 1
    for w in words:
        value = (value + (xxhash.xxh64_intdigest(w) % (_PRIME - 1) + 1) * power) % _PRIME
        power = power * _BASE % _PRIME
        out.append(value)
    return out


def without(prefix: list[int], p: int) -> int:
    """Hash of the words of ``prefix`` without word p."""
    return (prefix[p] + (prefix[-1] - prefix[p + 1]) * _BACK) % _PRIME


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h1, h2, n, halves, as_shorter, words) -> keyed rows of step 3.  A word's
    deletion costs the same whatever the length of the line."""
    import xxhash

    h64 = xxhash.xxh64_intdigest
    for b in batches:
        for k in range(0, b.num_rows, 256):
            part = b.slice(k, 256)
            row, role, key = [], [], []
            for r, (line, halves, shorter) in enumerate(zip(part.column("words").to_pylist(),
                                                            part.column("halves").to_pylist(),
                                                            part.column("as_shorter").to_pylist())):
                w = line.encode("utf-8", "surrogatepass").split(b" ")
                n = len(w)
                prefix = prefix_hashes(w)
                half = n // 2
                places = range(half if halves == 1 else 0, half if halves == 2 else n) if halves else ()
                got = set()
                for p in places:
                    v = without(prefix, p)
                    row.append(r)
                    role.append(0)
                    key.append(h64(v.to_bytes(8, "little") + n.to_bytes(8, "little") + p.to_bytes(8, "little"), 2))
                    if v not in got:
                        got.add(v)
                        row.append(r)
                        role.append(1)
                        key.append(h64(v.to_bytes(8, "little"), 1))
                if shorter:
                    row.append(r)
                    role.append(2)
                    key.append(h64(prefix[-1].to_bytes(8, "little"), 1))
            at = pa.array(row, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [_signed(key), pa.array(role, pa.int8()), part.column("h1").take(at), part.column("h2").take(at),
                 part.column("first").take(at)], ["key", "role", "h1", "h2", "first"])


_POS = "struct<did:bigint,th:bigint,line:int>"


def _least(rows: DataFrame, which: dict[str, Column]) -> DataFrame:
    """Per key its rows ``n`` and, for each named condition, the first position of a
    line of the same length, of a longer and of a shorter one."""
    roles = {"same": 0, "longer": 1, "shorter": 2}
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), *[
        F.min(F.when((F.col("role") == role) & cond, F.col("first"))).alias(name + tag)
        for tag, cond in which.items() for name, role in roles.items()])


def _partner(tag: str) -> Column:
    """Of a row's key, the first line that is near in the row's role."""
    return (F.when(F.col("role") == 0, F.col("same" + tag)).when(F.col("role") == 1, F.col("shorter" + tag))
            .otherwise(F.col("longer" + tag)))


def _against_kept(best: DataFrame, rows: DataFrame) -> DataFrame:
    """``(h1, h2, to)`` of the lines that go, ``to`` the earliest near line that stays
    (step 4).  ``best`` holds every line with an earlier near line and the earliest one."""
    line = ["h1", "h2"]
    going = best.select(F.col("first").alias("to"), F.lit(True).alias("goes"))
    best = materialize(best.join(going.hint("merge"), "to", "left")
                       .withColumn("open", F.coalesce("goes", F.lit(False))).drop("goes"), "lines-best-open")
    done = best.where(~F.col("open")).select(*line, "to")
    state = best.where("open").select(*line, F.lit("open").alias("state"))
    if state.isEmpty():
        return done
    # all rows that share a key with an open line; lines that are not in ``best`` stay
    keys = rows.join(state.hint("merge"), line).select("key").distinct()
    near = materialize(
        rows.join(keys.hint("merge"), "key")
        .join(best.select(*line, F.when(F.col("open"), "open").otherwise("goes").alias("was")).hint("merge"),
              line, "left").withColumn("was", F.coalesce("was", F.lit("stays"))), "lines-chains")
    mine = materialize(near.where("was = 'open'").drop("was"), "lines-open-rows")

    def partners(state: DataFrame) -> DataFrame:
        """Of each open line the first earlier near line that stays, and that is undecided."""
        now = (near.join(state.hint("merge"), line, "left")
               .withColumn("state", F.coalesce("state", "was")))
        least = materialize(_least(now, {"_kept": F.col("state") == "stays", "_open": F.col("state") == "open"}),
                            "lines-chain-groups")
        return (mine.join(least, "key")
                .select(*line, *[F.when(_partner(tag) < F.col("first"), _partner(tag)).alias(tag)
                                 for tag in ("_kept", "_open")])
                .groupBy(*line).agg(F.min("_kept").alias("kept"), F.min("_open").alias("undecided")))

    while not state.where("state = 'open'").isEmpty():
        new = (F.when(F.col("state") != "open", F.col("state")).when(F.col("kept").isNotNull(), "goes")
               .when(F.col("undecided").isNull(), "stays").otherwise("open"))
        state = materialize(state.join(partners(state), line).select(*line, new.alias("state")), "lines-state")
    ends = state.where("state = 'goes'").join(partners(state), line).select(*line, F.col("kept").alias("to"))
    return done.unionByName(ends)


def _near(lines: DataFrame, firsts: DataFrame, texts: DataFrame) -> DataFrame:
    """``(h1, h2, to)``: lines with an earlier near line that stays, and the earliest
    one's first position."""
    side = F.posexplode("keys").alias("side", "key")
    keyed = lines.where(F.col("keys").isNotNull())
    shared = materialize(keyed.select("h1", side).groupBy("key")
                         .agg(F.min("h1").alias("a"), F.max("h1").alias("b"))
                         .where(F.col("a") != F.col("b")).select("key"), "lines-shared")
    # the halves that may differ: a shared first half leaves the second one open, and the other way round.
    # h1 alone names the line here: a collision only makes one more candidate.  The hint keeps one plan at
    # every size: the keys grow with the input and must not be broadcast while they happen to be few
    open_ = materialize(
        keyed.select("h1", side).join(shared.hint("merge"), "key").groupBy("h1")
        .agg(F.bit_or(F.when(F.col("side") == 0, 1).when(F.col("side") == 1, 2).otherwise(0)).alias("halves"),
             F.max(F.col("side") >= 2).alias("as_shorter")), "lines-open")
    where = open_.join(firsts.select("h1", "h2", "first"), "h1")
    per_doc = materialize(where.groupBy("first.did", "first.th").agg(F.collect_list(F.struct(
        F.col("first.line").alias("line"), "h1", "h2", "halves", "as_shorter")).alias("l")), "lines-open-docs")
    # the texts of documents that hold such a line; a repeated row counts once
    found = texts.join(per_doc.hint("merge"), ["did", "th"]).select("did", "th", "l", F.split("text", "\n").alias("t"))
    blanks = "[ \\t\\n\\x0B\\f\\r]+"
    cand = materialize(
        found.select("did", "th", "t", F.explode("l").alias("x"))
        .select("x.h1", "x.h2", "x.halves", "x.as_shorter",
                F.struct("did", "th", "x.line").alias("first"),
                F.regexp_replace(F.get("t", F.col("x.line")), blanks, " ").alias("words"))
        .withColumn("words", F.trim("words")).dropDuplicates(["h1", "h2"]), "lines-candidates")
    rows = materialize(cand.mapInArrow(_variants, f"key bigint, role tinyint, h1 bigint, h2 bigint, first {_POS}"),
                       "lines-variants")

    groups = materialize(
        _least(rows, {"": F.lit(True)}).where(F.col("n") > 1).drop("n"), "lines-groups")
    best = materialize(rows.join(groups, "key").withColumn("to", _partner("")).where(F.col("to") < F.col("first"))
                       .groupBy("h1", "h2").agg(F.min("to").alias("to"), F.min("first").alias("first")), "lines-best")
    best = _against_kept(best, rows)
    both = (best.join(cand.select("h1", "h2", "words"), ["h1", "h2"])
            .join(cand.select(F.col("first").alias("to"), F.col("words").alias("other")), "to"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([within_one(x.split(" "), y.split(" ")) for x, y in
                                     zip(b.column("words").to_pylist(), b.column("other").to_pylist())], pa.bool_())) \
                .select(["h1", "h2", "to"])

    return both.select("h1", "h2", "to", "words", "other").mapInArrow(check, f"h1 bigint, h2 bigint, to {_POS}")


def _repeats(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(did, th, line, to, distance) of every occurrence that goes."""
    require(docs, id_col, text_col)
    t = text_or_empty(text_col)
    texts = docs.select(_doc(id_col).alias("did"), F.xxhash64(t).alias("th"), t.alias("text"))
    lines = materialize(
        texts.mapInArrow(lambda b: _lines(b, min_words),
                         "did bigint, th bigint, line int, h1 bigint, h2 bigint, keys array<bigint>"), "lines")
    pos = F.struct("did", "th", "line")
    firsts = materialize(lines.groupBy("h1", "h2").agg(F.min(pos).alias("first"), F.count(F.lit(1)).alias("n")),
                         "lines-first")
    near = materialize(_near(lines, firsts, texts), "lines-near")
    gone = materialize(
        firsts.join(near, ["h1", "h2"], "left").where((F.col("n") > 1) | F.col("to").isNotNull())
        .select("h1", "h2", "first", "to"), "lines-gone")
    return (lines.select("did", "th", "line", "h1", "h2").join(gone, ["h1", "h2"])
            .where(F.col("to").isNotNull() | (pos != F.col("first")))
            .select("did", "th", "line", F.coalesce("to", "first").alias("to"),
                    F.when(F.col("to").isNull(), 0).otherwise(1).alias("distance")))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, line, kept_doc_id, kept_line, distance)``: every line that goes
    (numbers from 0) and the first occurrence of the earliest line it repeats
    (distance 0 or 1 words)."""
    def back(c: str) -> Column:
        return F.when(F.col(c) != _LAST, F.col(c))

    return _repeats(docs, id_col, text_col, min_words).distinct().select(
        back("did").alias("doc_id"), "line", back("to.did").alias("kept_doc_id"), F.col("to.line").alias("kept_line"),
        "distance")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the repeated lines; a document all of whose lines with
    words go, goes too."""
    gone = _repeats(docs, id_col, text_col, min_words).groupBy("did", "th").agg(F.collect_set("line").alias("gone"))
    gone = materialize(gone, "lines-gone-docs")
    tag = uuid.uuid4().hex  # no column of the caller can have these names
    t = text_or_empty(text_col)
    rows = docs.select(F.struct(*docs.columns).alias(tag), _doc(id_col).alias("did"), F.xxhash64(t).alias("th"))
    text = F.col(tag)[text_col].cast("string")
    kept = F.filter(F.split(text, "\n"), lambda line, i: ~F.array_contains("gone", i))
    new = F.when(F.col("gone").isNull(), text).otherwise(F.array_join(kept, "\n"))
    out = rows.join(gone.hint("merge"), ["did", "th"], "left").select(tag, "gone", new.alias("new"))
    return (out.where(F.col("gone").isNull() | F.col("new").rlike(r"[^ \t\n\x0B\f\r]"))
            .select(*[(F.col("new") if c == text_col else F.col(tag)[c]).alias(c) for c in docs.columns]))
