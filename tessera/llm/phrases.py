"""Phrase collocation mining with stripes.

A stripe is the counter of the next words of one prefix.  The stripe of the empty
prefix of a language counts its words, that of a word its successors, and so on
up to ``MAX_WORDS`` words.  How often a prefix occurs is its own entry in the stripe
of the prefix one word shorter.

The counts are never held in one place, and every position is shuffled once for all levels:

1. Words and pairs of words are counted by hash bucket; one bit per bucket says
   whether it was filled ``min_count`` times (``frequent``, at most 64 MB).  Where no bit
   stands no phrase can, so most positions leave here; a bit too many only costs work.
   Texts become blocks of about ``BLOCK_WORDS`` words and marks, numbered within the block.
2. The blocks' stripes of the empty prefixes (their words) meet by hash range; words of at least
   ``min_count`` are numbered, and every block gets the numbers of its own words
   back, in its own order.  Prefixes and words are these numbers: there are no hash collisions.
3. Each block builds the stripes of all longer prefixes, one inside the other (one row per hash
   range: prefixes of two words, under each its next words, under each of those the next, with counts).
   An entry of two words is dealt out by both, a longer one by its first three, so that the
   stripe of a hot prefix is merged by several tasks, and every entry by one.
4. The rows of a range meet in one task and are merged elementwise, level by level, under the
   entries of at least ``min_count``.

A position is written once as a word and once as a phrase of up to ``MAX_WORDS`` words at most, so that the
bytes written stay within a multiple of the input however many phrases are frequent.  Files of a shuffle leave
as soon as the table made from it is written.

Scoring is a few joins over the phrases found (never over their occurrences):
a phrase's first words and its last words are phrases of the level below.
All products are taken as decimals of up to 38 digits.

Nulls: a null text has no words, a null language is ``und``; doc ids play no part,
so repeated rows count each.  Empty texts count nothing, a piece has any length, ties are broken by phrase, an empty table gives an
empty result, extra columns are ignored.
"""

from __future__ import annotations

import array
import contextlib
import itertools
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import require, text_or_empty
from tessera.llm.lm import _pack, _pack_sorted, _unpack, _unpack_sorted
from tessera.session import materialize

MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000
SCALE = 1000                # of a score
COVERED = 100               # a phrase goes where a longer one has this many per cent of its occurrences
UNKNOWN = "und"
BLOCK_WORDS = 3_000_000
WORDS_PER_RANGE = 1 << 22
MIN_RANGES = 32             # a power of 2
MIN_BITS, MAX_BITS = 16, 29     # log2 of the buckets of ``frequent``

_LOWER_CUT = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r",
                             b"abcdefghijklmnopqrstuvwxyz \n\n\n\n\n\n\n\n\n")
_NONE, _BREAK = 0, 1        # block numbers of an empty field and of a piece's end

STRIPES = "range int, width bigint, pairs binary, pair_counts binary, prefixes binary, " \
          "sizes array<binary>, nexts array<binary>, counts array<binary>"
ENTRIES = "words array<bigint>, n bigint"


# ------------------------------------------------------------------ blocks

def _blocks(batches: Iterator[pa.RecordBatch], limit: int):
    """The documents of a task in blocks of about ``limit`` words: the words as
    numbers (from 2; 1 ends a piece), and by number language and word."""
    def fresh():
        return array.array("I"), itertools.count(2), {}

    def block(ids, by_lang):
        tokens = np.frombuffer(ids, np.uint32).astype(np.int64)
        names = [None] * (2 + sum(len(d) - 2 for d in by_lang.values()))
        for lang, d in by_lang.items():
            mark = lang.encode("utf-8", "surrogatepass") + b"\n"    # no word holds a line break
            for w, k in d.items():
                if k > _BREAK:
                    names[k] = mark + w
        return tokens[tokens != _NONE], names

    ids, numbers, by_lang = fresh()
    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
            d = by_lang.get(lang)
            if d is None:
                d = by_lang[lang] = defaultdict(numbers.__next__, {b"": _NONE, b"\n": _BREAK})
            data = text.as_py().encode("utf-8", "surrogatepass").translate(_LOWER_CUT)
            ids.extend([d[w] for w in data.replace(b"\n", b" \n ").split(b" ")])
            ids.append(_BREAK)
            if len(ids) >= limit:
                yield block(ids, by_lang)
                ids, numbers, by_lang = fresh()
    if ids:
        yield block(ids, by_lang)


def _pack_positions(a: np.ndarray) -> bytes:
    """Like ``_pack``, for values by text position: passages that a block holds
    several times are found however far apart they are."""
    import zstandard

    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T
    how = zstandard.ZstdCompressionParameters.from_level(5, window_log=23, enable_ldm=True, ldm_min_match=16)
    return zstandard.ZstdCompressor(compression_params=how).compress(np.ascontiguousarray(planes).tobytes())


def _pack_names(names: list[bytes]) -> bytes:
    import zstandard

    sizes = np.array([len(names), *map(len, names)], np.uint32)
    return zstandard.ZstdCompressor(level=3).compress(sizes.tobytes() + b"".join(names))


def _unpack_names(data: bytes) -> list[bytes]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    cuts = (np.cumsum(np.frombuffer(raw, np.uint32, n + 1)[1:]) + 4 * (n + 1)).tolist()
    return [raw[a:b] for a, b in zip([4 * (n + 1), *cuts], cuts)]


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


def _of_range(key: np.ndarray, ranges: int) -> np.ndarray:
    """Hash range of 64-bit keys; ``ranges`` is a power of 2."""
    return (_mixed(key) & np.uint64(ranges - 1)).astype(np.int64)


def _hashes(tokens: np.ndarray, names: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash per word of the vocabulary; positions where a pair of words starts, and its hash."""
    word = np.array([0, 0, *[xxhash.xxh64_intdigest(w) for w in names[2:]]], np.uint64)
    at = np.flatnonzero((tokens[:-1] > _BREAK) & (tokens[1:] > _BREAK))
    with np.errstate(over="ignore"):
        pair = _mixed(word[tokens[at]] * np.uint64(3) + _mixed(word[tokens[at + 1]]))
    return word, at, pair


def _bucket_counts(limit: int, bits: int, ranges: int):
    """mapInArrow body: how often words and pairs fall into each of ``2^bits`` hash
    buckets; a row per range of buckets."""
    low = bits - ranges.bit_length() + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, names in _blocks(batches, limit):
            word, _, pair = _hashes(tokens, names)
            shift = np.uint64(64 - bits)
            buckets, counts = np.unique(np.concatenate([word[tokens[tokens > _BREAK]] >> shift, pair >> shift]),
                                        return_counts=True)
            cut = np.searchsorted(buckets, np.arange(ranges + 1, dtype=np.uint64) << np.uint64(low))
            rows = [(r, _pack(np.diff(buckets[a:b], prepend=np.uint64(r << low)).astype(np.uint32)),
                     _pack(counts[a:b].astype(np.uint32))) for r, (a, b) in enumerate(zip(cut, cut[1:])) if a < b]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))],
                    ["range", "buckets", "counts"])

    return run


def _frequent_buckets(min_count: int, bits: int, ranges: int):
    """Per range of buckets one bit each: filled often enough or not."""
    width = 1 << (bits - ranges.bit_length() + 1)

    def run(key, table):
        total = np.zeros(width, np.int64)
        for gaps, counts in zip(table.column("buckets").to_pylist(), table.column("counts").to_pylist()):
            at = np.cumsum(_unpack(gaps, np.uint32).astype(np.int64))
            total[at] += _unpack(counts, np.uint32)
        return pa.table({"range": pa.array([key[0].as_py()], pa.int32()),
                         "bits": pa.array([np.packbits(total >= min_count).tobytes()], pa.binary())})

    return run


def frequent(src: DataFrame, n_words: int, min_count: int, block_words: int) -> tuple[np.ndarray, int]:
    """A bitmap of hash buckets that may hold a word or pair counted ``min_count``
    times: every one that is sets its bit, so what finds none can be left out.

    Its size is bounded by ``MAX_BITS`` (64 MB); beyond that it leaves out less, and no phrase is ever lost."""
    bits = min(MAX_BITS, max(MIN_BITS, (n_words // 4).bit_length()))
    ranges = min(1 << (bits - 10), 1024)
    with _shuffles_leave(src.sparkSession):
        rows = (src.mapInArrow(_bucket_counts(block_words, bits, ranges), "range int, buckets binary, counts binary")
                .groupBy("range").applyInArrow(_frequent_buckets(min_count, bits, ranges), "range int, bits binary")
                .collect())
    out = np.zeros((ranges, (1 << bits) // 8 // ranges), np.uint8)
    for r in rows:
        out[r["range"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel(), bits


def _holds(bitmap: np.ndarray, bits: int, h: np.ndarray) -> np.ndarray:
    b = (h >> np.uint64(64 - bits)).astype(np.int64)
    return (bitmap[b >> 3] >> (7 - (b & 7)).astype(np.uint8) & 1).astype(bool)


def _stretches(tokens: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The tokens of the pairs at ``start``, with one empty position before each
    stretch of pairs that overlap."""
    pair = np.zeros(len(tokens) + 1, bool)
    pair[start + 1] = True                      # a pair at i stands at i + 1
    at = np.flatnonzero(pair[1:] | pair[:-1])
    first = np.flatnonzero(pair[1:] & ~pair[:-1])
    return np.insert(tokens[at], np.searchsorted(at, first), _NONE)


def _by_count(counts: np.ndarray) -> np.ndarray:
    return np.argsort(-counts.astype(np.int64), kind="stable")


def _first_stripes(limit: int, ranges: int, shared, bits: int):
    """Level 1, the stripes of the empty prefixes: per block and range the words
    (with their language) that may be frequent and their counts, the others under no word; and
    the block's stretches of pairs that may be frequent, numbered from the most frequent word there (few bytes each)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        for tokens, names in _blocks(batches, limit):
            block = uuid.uuid4().hex
            word, at, pair = _hashes(tokens, names)
            counts = np.bincount(tokens, minlength=len(names))
            known = np.flatnonzero(_holds(bitmap, bits, word) & (np.arange(len(names)) > _BREAK))
            where = _of_range(word[known], ranges)
            by = np.array(sorted(range(len(known)), key=lambda k: (where[k], names[known[k]])), np.int64)
            known, where = known[by], where[by]
            stretches = _stretches(tokens, at[_holds(bitmap, bits, pair)])
            held = np.bincount(stretches, minlength=len(names))[known]
            number = np.zeros(len(names), np.int64)     # place of a word by count, from 1
            number[known[_by_count(held)]] = np.arange(1, len(known) + 1)
            if held.any():
                yield _first_row(block, None, None, held, _pack_positions(number[stretches].astype(np.uint32)))
            others: dict[bytes, int] = defaultdict(int)
            for k in np.flatnonzero((number == 0) & (np.arange(len(names)) > _BREAK)).tolist():
                others[names[k].rpartition(b"\n")[0] + b"\n"] += int(counts[k])
            if others:
                yield _first_row(None, 0, list(others), list(others.values()))
            cut = np.searchsorted(where, np.arange(ranges + 1))
            for r in np.flatnonzero(np.diff(cut)).tolist():
                part = known[cut[r]:cut[r + 1]]
                yield _first_row(block, r, [names[k] for k in part.tolist()], counts[part].tolist())

    return run


_FIRST = "block string, last binary, range int, names binary, counts binary"


def _first_row(block, range_=None, names=None, counts=None, state=None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.string()), pa.array([state], pa.binary()), pa.array([range_], pa.int32()),
         pa.array([None if names is None else _pack_names(names)], pa.binary()),
         pa.array([None if counts is None else _pack(np.array(counts, np.uint64))], pa.binary())],
        ["block", "last", "range", "names", "counts"])


_WORDS = "block string, range int, ids binary, lang string, word string, id bigint, n bigint"


def _merge_first(min_count: int, ranges: int):
    """Merge one range of the empty prefixes' stripes: numbers (the smallest for the most
    frequent, below 2^32 over all ranges) for the words counted often enough, answers to the blocks, and per language the slice's sum (no word)."""
    def run(key, table):
        total: dict[bytes, int] = defaultdict(int)
        asked = [(block, _unpack_names(names), _unpack(counts, np.uint64).tolist()) for block, names, counts in
                 zip(*[table.column(c).to_pylist() for c in ("block", "names", "counts")])]
        for _, names, counts in asked:
            for w, c in zip(names, counts):
                total[w] += c
        r = key[0].as_py()
        kept = sorted((w for w, c in total.items() if c >= min_count and not w.endswith(b"\n")),
                      key=lambda w: (-total[w], w))
        number = {w: k * ranges + r for k, w in enumerate(kept, 1)}
        rows = [(block, r, _pack(np.array([number.get(w, 0) for w in names], np.uint64)), None, None, None, None)
                for block, names, _ in asked if block is not None]
        sums: dict[bytes, int] = defaultdict(int)
        for w, c in total.items():
            sums[w.rpartition(b"\n")[0]] += c
        text = lambda b: b.decode("utf-8", "replace")
        for w in kept:
            lang, _, word = w.rpartition(b"\n")
            rows.append((None, r, None, text(lang), text(word), number[w], total[w]))
        rows += [(None, r, None, text(lang), None, None, c) for lang, c in sums.items()]
        kinds = [pa.string(), pa.int32(), pa.binary(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                    [c.split()[0] for c in _WORDS.split(", ")])

    return run


# ------------------------------------------------------------------ levels

_WORD = np.uint64(32)                   # bits of a word's number
_LAST = np.uint64((1 << 32) - 1)


def _range_of_words(columns: list[np.ndarray], ranges: int) -> np.ndarray:
    """Hash range of phrases, given by the numbers of their first, second, ... words."""
    with np.errstate(over="ignore"):
        h = np.zeros(len(columns[0]), np.uint64)
        for c in columns:
            h = _mixed(h * np.uint64(3) + c)
    return _of_range(h, ranges)


def _changes(a: np.ndarray) -> np.ndarray:
    return np.append(True, a[1:] != a[:-1])


def _nested(columns: list[np.ndarray], width: np.uint64) -> tuple[bytes, list[bytes], list[bytes], list[bytes]]:
    """Stripes inside each other, from the sorted phrases of a block (word numbers, 0 behind
    the last one): the prefixes of two words; and per level how many next words each entry of the level
    before has, these words, and their counts."""
    new = _changes(columns[0]) | _changes(columns[1])
    prefixes, sizes, nexts, counts = _pack_sorted(columns[0][new] * width + columns[1][new]), [], [], []
    for c in columns[2:]:
        there = c > 0
        if not there.any():
            break
        prefix = np.cumsum(new) - 1
        new = (new | _changes(c)) & there
        sizes.append(_pack(np.bincount(prefix[new], minlength=prefix[-1] + 1).astype(np.uint32)))
        nexts.append(_pack(c[new].astype(np.uint32)))
        counts.append(_pack(np.bincount(np.cumsum(new)[there] - 1).astype(np.uint32)))
    return prefixes, sizes, nexts, counts


def _block_stripes(max_words: int, ranges: int):
    """cogroup body: a block's stretches and the numbers of its words; out come its stripes
    of prefixes of one word (``pairs``) and of all longer ones, one row per range."""
    names = [c.split()[0] for c in STRIPES.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), *[pa.list_(pa.binary())] * 3]

    def run(key, left, right):
        rows: dict[int, list] = {}
        if left.num_rows and right.num_rows:
            answers = sorted(zip(right.column("range").to_pylist(), right.column("ids").to_pylist()))
            numbers = np.concatenate([np.zeros(1, np.uint64), *[_unpack(x, np.uint64) for _, x in answers]])
            by_count = _by_count(_unpack(left.column("counts")[0].as_py(), np.uint64))
            numbers[1:] = numbers[1:][by_count]
            words = np.append(numbers[_unpack(left.column("last")[0].as_py(), np.uint32)],
                              np.zeros(max_words, np.uint64))
            width = words.max() + np.uint64(1)
            at = np.flatnonzero((words[:-1] > 0) & (words[1:] > 0))
            pairs, count = np.unique(words[at] * width + words[at + 1], return_counts=True)
            where = _range_of_words([pairs // width, pairs % width], ranges)
            by = np.argsort(where, kind="stable")
            cut = np.searchsorted(where[by], np.arange(ranges + 1))
            for r in np.flatnonzero(np.diff(cut)).tolist():
                mine = by[cut[r]:cut[r + 1]]
                rows[r] = [r, int(width), _pack_sorted(pairs[mine]), _pack(count[mine].astype(np.uint32)), *[None] * 4]
            at = at[words[at + 2] > 0] if max_words > 2 else at[:0]
            columns = [words[at + k] for k in range(max_words)]
            for k in range(3, max_words):
                columns[k][columns[k - 1] == 0] = 0
            where = _range_of_words(columns[:3], ranges)
            by = np.lexsort((*columns[::-1], where))
            columns = [c[by] for c in columns]
            cut = np.searchsorted(where[by], np.arange(ranges + 1))
            for r in np.flatnonzero(np.diff(cut)).tolist():
                row = rows.setdefault(r, [r, int(width), *[None] * 6])
                row[4:] = _nested([c[cut[r]:cut[r + 1]] for c in columns], width)
        return pa.Table.from_arrays([pa.array([row[k] for row in rows.values()], kind) for k, kind in enumerate(kinds)],
                                    names)

    return run


def _summed(keys: np.ndarray, counts: np.ndarray, min_count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys counted ``min_count`` times, their counts, and the place of every key among them (or -1)."""
    found, inverse = np.unique(keys, return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, inverse, counts)
    kept = total >= min_count
    return found[kept], total[kept], np.where(kept, np.cumsum(kept) - 1, -1)[inverse]


def _merge(min_count: int):
    """Merge one range of stripes elementwise: the phrases (their words' numbers) counted often enough."""
    def run(key, table):
        columns = {c: table.column(c).to_pylist() for c in table.column_names}
        out = []

        def pairs_of(data, width):
            k, width = _unpack_sorted(data), np.uint64(width)
            return (k // width) << _WORD | k % width

        def keep(words, total):
            flat = np.stack(words, 1).astype(np.int64).ravel()
            at = np.arange(0, len(flat) + 1, len(words), dtype=np.int32)
            out.append(pa.Table.from_arrays([pa.ListArray.from_arrays(pa.array(at), pa.array(flat)), pa.array(total)],
                                            ["words", "n"]))

        some = [(pairs_of(p, w), _unpack(c, np.uint32))
                for w, p, c in zip(columns["width"], columns["pairs"], columns["pair_counts"]) if p is not None]
        if some:
            pair, total, _ = _summed(*map(np.concatenate, zip(*some)), min_count)
            keep([pair >> _WORD, pair & _LAST], total)
        rows = [r for r in zip(*[columns[c] for c in ("width", "prefixes", "sizes", "nexts", "counts")]) if r[1] is not None]
        if rows:
            # the entries of a level behind one another: how many a row has, and their place among the merged ones
            held = [pairs_of(p, w) for w, p, *_ in rows]
            pair, place = np.unique(np.concatenate(held), return_inverse=True)
            words, entries = [pair >> _WORD, pair & _LAST], [len(x) for x in held]
            for level in range(max(len(sizes) for _, _, sizes, _, _ in rows)):
                start = np.cumsum([0, *entries])
                prefix, nexts, counts = [], [], []
                for k, (_, _, size, following, count) in enumerate(rows):
                    above, entries[k] = place[start[k]:start[k + 1]], 0
                    if level < len(size):
                        prefix.append(np.repeat(above, _unpack(size[level], np.uint32)))
                        nexts.append(_unpack(following[level], np.uint32))
                        counts.append(_unpack(count[level], np.uint32))
                        entries[k] = len(nexts[-1])
                prefix, nexts, counts = map(np.concatenate, (prefix, nexts, counts))
                live = prefix >= 0
                found, total, at = _summed(prefix[live].astype(np.uint64) << _WORD | nexts[live].astype(np.uint64), counts[live], min_count)
                place = np.full(len(prefix), -1)
                place[live] = at
                below = (found >> _WORD).astype(np.int64)
                words = [*[w[below] for w in words], found & _LAST]
                keep(words, total)
        return pa.concat_tables(out)

    return run


# --------------------------------------------------------------- operators

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def _shuffles_leave(spark: SparkSession):
    """The shuffle files of a job run inside are removed when it ends: its result has been written or collected."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def _materialize(df: DataFrame, name: str) -> DataFrame:
    with _shuffles_leave(df.sparkSession):
        return materialize(df.select("*"), name)


def stripes(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS,
            min_count: int = MIN_COUNT, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The merged stripes: words ``(id, lang, word, n)`` and word totals ``(lang, total)``
    (the empty prefixes' stripes), and the entries of all longer prefixes as ``(words, n)``,
    ``words`` being the ids of the prefix and the next word; words and entries of at least ``min_count``."""
    require(docs, text_col, lang_col)
    src = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                      text_or_empty(text_col).alias("text"))
    # about the number of words: it sizes ranges and bitmap only
    n = (src.agg(F.sum(F.length("text"))).collect()[0][0] or 0) // 6
    bitmap, bits = frequent(src, n, min_count, block_words)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    ranges = max(MIN_RANGES, 1 << (n // WORDS_PER_RANGE).bit_length())
    state = _materialize(src.mapInArrow(_first_stripes(block_words, ranges, shared, bits), _FIRST), "phrase-blocks")
    merged = _materialize(state.where(F.col("range").isNotNull()).groupBy("range")
                         .applyInArrow(_merge_first(min_count, ranges), _WORDS), "phrase-words")
    words = merged.where(F.col("word").isNotNull()).select("id", "lang", "word", "n")
    totals = (merged.where(F.col("lang").isNotNull() & F.col("word").isNull())
              .groupBy("lang").agg(F.sum("n").alias("total")))
    blocks = state.where(F.col("last").isNotNull()).select("block", "last", "counts")
    answers = merged.where(F.col("block").isNotNull()).select("block", "range", "ids")
    longer = (blocks.groupBy("block").cogroup(answers.groupBy("block"))
              .applyInArrow(_block_stripes(max_words, ranges), STRIPES))
    return words, totals, _materialize(longer.groupBy("range").applyInArrow(_merge(min_count), ENTRIES), "phrase-entries")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS,
                 min_count: int = MIN_COUNT, scale: int = SCALE, covered: int = COVERED,
                 block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every phrase of 2 to ``max_words`` words counted at least ``min_count`` times and
    not covered by a longer one: ``(lang, phrase, a, l, r, n, score)``."""
    words, totals, entries = stripes(docs, text_col, lang_col, max_words, min_count, block_words)
    none = F.array().cast("array<bigint>")
    below = _materialize(words.select(F.array("id").alias("words"), "lang", F.col("word").alias("first"),
                                     F.col("word").alias("phrase"), F.col("n").alias("a"), none.alias("firsts"),
                                     none.alias("rests")), "phrases-1")
    found = []
    for k in range(2, max_words + 1):
        # the first k - 1 words and the last: phrases one word shorter
        e = entries.where(F.size("words") == k).select(
            "words", F.slice("words", 1, k - 1).alias("head"), F.slice("words", 2, k - 1).alias("tail"), "n")
        p = below.select(F.col("words").alias("head"), "lang", "first", F.concat("firsts", F.array("a")).alias("firsts"))
        s = below.select(F.col("words").alias("tail"), F.col("phrase").alias("last"),
                         F.concat(F.array("a"), "rests").alias("rests"))
        longer = _materialize(e.join(p, "head").join(s, "tail").select(
            "words", "head", "tail", "lang", "first", F.concat_ws(" ", "first", "last").alias("phrase"),
            F.col("n").alias("a"), "firsts", "rests"), f"phrases-{k}")
        if k > 2:
            most = (longer.select(F.explode(F.array("head", "tail")).alias("words"), "a")
                    .groupBy("words").agg(F.max("a").alias("most")))
            found.append(_uncovered(below.join(most, "words", "left"), covered))
        below = longer
    found.append(below.select("lang", "phrase", "a", "firsts", "rests"))
    all_found = found[0]
    for f in found[1:]:
        all_found = all_found.unionByName(f)
    all_found = all_found.join(totals.select("lang", F.col("total").alias("n")), "lang")
    return all_found.withColumn("cut", _weakest_cut(scale)).select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
        F.col("cut.score").alias("score"))


def _uncovered(phrases: DataFrame, covered: int) -> DataFrame:
    """Phrases no longer one covers.  A longer phrase is never more frequent than
    those between, so the ones longer by one word decide."""
    big = lambda c: F.col(c).cast("decimal(20,0)")
    return phrases.where(F.col("most").isNull() | (big("most") * 100 < big("a") * covered)) \
        .select("lang", "phrase", "a", "firsts", "rests")


def _weakest_cut(scale: int) -> Column:
    """``(score, k, l, r)`` of the lowest-scoring cut after k words, in whole decimals."""
    product = f"cast(a as decimal(18,0)) * cast(n as decimal(18,0)) * cast({scale} as decimal(4,0))"
    return F.expr(f"""array_min(transform(firsts, (l, i) -> named_struct(
        'score', ({product}) div (cast(l as decimal(18,0)) * cast(rests[i] as decimal(18,0))),
        'k', i + 1, 'l', l, 'r', rests[i])))""")


def top(found: DataFrame, k: int = TOP) -> DataFrame:
    """The first ``k`` phrases of every language (``rank`` from 1)."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (found.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= k)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
