"""Periodic runs of words by Baier grouping.

A run is a maximal stretch of words with smallest period p and at least
``MIN_EXPONENT`` periods.  Every run holds Lyndon roots, one period apart, under
one of the two orders of the words (Bannai et al. 2017), so:

1. *Grouping* (phase one of Baier's suffix sorter): suffixes start in one group
   per word and groups are taken from the largest down.  The members of the
   group at hand leave the list of open suffixes; the open suffix before each
   stretch of k neighbouring members moves to a new group right behind its old
   one, ordered by k.  When a group is taken, the distance from a member to the
   next open suffix is the length of its longest Lyndon prefix, and two suffixes
   are in one group exactly if these prefixes are equal.  So phase one alone
   yields the Lyndon array; the sorter's second phase is not needed.  It is done
   under both orders.
2. *Runs*: where positions x, x+p, x+2p, ... hold one group of prefix length p,
   the first one is extended to the left and the last one to the right by the
   longest common extension (less than p words each).

Groups that hold no neighbours in the list of open suffixes do not touch one
another, so several of the largest ones are taken at a time, and the documents
of a batch take theirs together: a step is a few numpy operations over all these
members, and a text of n words needs about sqrt(n) steps.  The order of the words
is free; that of a scrambled number keeps neighbours apart.

One ``mapInArrow`` pass, no shuffle; memory is bounded by ``CHUNK`` words, or one
longer document.  Nulls: a null text has no words, a null doc_id never gets a
planted period (see ``planted``).  Empty texts have no runs.  Repeated rows
give a row each; ties of the best run go to the smallest start, then period; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import require, text_or_empty, words

MIN_EXPONENT = 4        # periods a run has at least
MIN_LENGTH = 6          # words a run has at least
CHUNK = 500_000         # words that are grouped together


# ------------------------------------------------------------- phase one

def lyndon(ranks: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(length of the longest Lyndon prefix, group) of every suffix of many texts
    of ``sizes`` words each.

    ``order`` is a permutation of the positions in which every group is a slice
    ``[first, end)`` and later slices are larger; below ``hi`` a text's groups are
    still to be taken.  ``left`` and ``right`` link the open suffixes.
    """
    n = len(ranks)
    stops = np.cumsum(sizes)
    texts = np.flatnonzero(sizes)
    base, text_end = (stops - sizes)[texts], stops[texts]
    hi = text_end.copy()
    text = np.repeat(np.arange(len(texts), dtype=np.int32), sizes[texts])
    order = np.lexsort((ranks, text)).astype(np.int32)
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    sorted_ranks = ranks[order]
    new = np.ones(n, bool)
    new[1:] = (sorted_ranks[1:] != sorted_ranks[:-1]) | (text[1:] != text[:-1])
    starts = np.flatnonzero(new)
    first = np.empty(n, np.int32)
    first[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    end = np.zeros(n, np.int32)
    end[starts] = np.append(starts[1:], n)
    left, right = np.arange(-1, n - 1, dtype=np.int32), np.arange(1, n + 1, dtype=np.int32)
    left[base] = -1
    length, group = np.empty(n, np.int32), np.empty(n, np.int32)
    member = np.zeros(n, bool)
    live = np.arange(len(texts))
    while len(live):
        # the largest groups of every text, about the root of its open suffixes
        top = hi[live]
        lo = first[order[np.maximum(base[live], top - np.sqrt(top - base[live]).astype(np.int64) - 1)]]
        slots, of = _ranges(lo, top)
        s = order[slots]
        g, l = first[s], left[s]
        member[s] = True
        beside = member[l] & (l >= 0)
        clash = beside & (first[l] != g)
        if clash.any():
            # two groups with neighbours are not taken at once: the lower one waits
            np.maximum.at(lo, of[clash], end[np.minimum(g, first[l])[clash]])
            stay = slots >= lo[of]
            member[s[~stay]] = False
            s, g, l, of = s[stay], g[stay], l[stay], of[stay]
            beside = member[l] & (l >= 0)
        member[s] = False
        group[s] = g
        length[s] = right[s] - s
        # stretches of neighbouring members; a text position decides their order
        if beside.any():
            by = np.argsort(s)
            s, g, l, of = s[by], g[by], l[by], of[by]
            heads = np.flatnonzero(~beside[by])
            count = np.diff(np.append(heads, len(s)))
            p, r, g, of = l[heads], right[s[heads + count - 1]], g[heads], of[heads]
        else:
            p, r, count = l, right[s], np.ones(len(s), np.int64)
        inner = r < text_end[live[of]]
        left[r[inner]] = p[inner]
        keep = p >= 0
        p, r, count, g = p[keep], r[keep], count[keep], g[keep]
        right[p] = r
        if len(p):
            _move(p, g, count, order, place, first, end, member)
        hi[live] = lo
        live = live[lo > base[live]]
    return length, group


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges ``[lo, hi)``, and the range each belongs to."""
    size = hi - lo
    of = np.repeat(np.arange(len(size)), size)
    return np.arange(len(of)) + (lo - (np.cumsum(size) - size))[of], of


def _move(p, g, count, order, place, first, end, member) -> None:
    """The suffixes ``p`` go to new groups at the end of their old ones, ordered
    by the group behind them (``g``) and how often it stands there (``count``)."""
    a = first[p]
    by = np.lexsort((count, g, a))
    p, a, g, count = p[by], a[by], g[by], count[by]
    differs = a[1:] != a[:-1]
    g0 = np.flatnonzero(np.append(True, differs))
    m = np.diff(np.append(g0, len(p)))          # how many leave each old group
    tail0 = end[a[g0]] - m                      # they take its last slots
    tail = np.repeat(tail0 - g0, m)
    slot = tail + np.arange(len(p))
    # slots of leavers before the tail go to those who sit in the tail and stay
    old = place[p]
    front = old < np.repeat(tail0, m)
    if front.any():
        sitting = order[slot]
        member[p] = True
        stays = sitting[~member[sitting]]
        member[p] = False
        order[old[front]] = stays
        place[stays] = old[front]
    order[slot] = p
    place[p] = slot
    sub = np.flatnonzero(np.append(True, differs | (g[1:] != g[:-1]) | (count[1:] != count[:-1])))
    width = np.diff(np.append(sub, len(p)))
    first[p] = np.repeat(slot[sub], width)
    left_over = tail0 > a[g0]
    end[a[g0[left_over]]] = tail0[left_over]
    end[slot[sub]] = slot[sub] + width


# ------------------------------------------------------------------- runs

def find_runs(ranks: np.ndarray, sizes: np.ndarray, min_exponent: int = MIN_EXPONENT,
              min_length: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """Per text its runs ``(start, length, period)``, by start, then period.

    ``min_exponent`` is 4 or more: such a run holds three whole roots in a row."""
    found: list[set] = [set() for _ in sizes]
    n = len(ranks)
    if n >= 1 << 31:
        raise ValueError("a chunk must hold fewer than 2^31 words")
    # any order of the words will do: odd multiples modulo 2^31, where no two meet
    scrambled = ranks * 1_580_030_173 % (1 << 31)
    stops = np.cumsum(sizes)
    base = stops - sizes
    stop_of = np.repeat(stops, sizes)
    x = np.arange(n)
    for sign in (1, -1):
        length, group = lyndon(sign * scrambled, sizes)
        # the next root of the chain: one period on, in the same group
        step = x + length
        inside = step < stop_of
        chained = np.zeros(n, bool)
        chained[inside] = group[step[inside]] == group[x[inside]]
        second = np.zeros(n, bool)
        second[step[chained]] = True
        for h in np.flatnonzero(chained & ~second).tolist():
            p = int(length[h])
            last = h + p
            if not chained[last]:
                continue                # fewer than three whole roots
            d = int(np.searchsorted(stops, h, side="right"))
            lo, hi = int(base[d]), int(stops[d])
            while chained[last]:
                last += p
            end = last + p              # all of [h, end) has period p
            tail = ranks[end - p:hi - p][:p] == ranks[end:hi][:p]
            end += len(tail) if tail.all() else int(tail.argmin())
            back = min(p, h - lo)
            same = (ranks[h - back:h] == ranks[h - back + p:h + p])[::-1]
            start = h - (back if same.all() else int(same.argmin()))
            if end - start >= max(min_length, min_exponent * p):
                found[d].add((start - lo, end - start, p))
    return [sorted(f, key=lambda r: (r[0], r[2])) for f in found]


def planted(doc, ranks: np.ndarray) -> np.ndarray:
    """The word numbers of a document, a periodic tail put into a tenth of the
    documents as a function of ``doc_id`` (see ``op13``'s contract)."""
    n = len(ranks)
    if doc is None or not n:
        return ranks
    h = zlib.crc32(str(doc).encode())
    g = h // 10
    if h % 10:
        return ranks
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return ranks[at]


SCHEMA = ("doc_id bigint, n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, "
          "exponent_milli bigint, runs_sha256 string, collapsed_sha256 string")


def _row(doc, ids: np.ndarray, vocabulary: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    best = None
    edge = np.zeros(len(ids) + 1, np.int64)
    for s, n, p in runs:
        edge[s + p] += 1
        edge[s + n] -= 1
        # greatest length / period, without division; runs come by start, then period
        if best is None or n * best[2] > best[1] * p:
            best = (s, n, p)
    kept = ids[np.cumsum(edge[:-1]) == 0] if runs else ids
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    text = b" ".join([vocabulary[i] for i in kept.tolist()])
    return (doc, len(ids), len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(text).hexdigest())


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False,
         min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH, chunk: int = CHUNK) -> DataFrame:
    """Per document: number of runs, the one of greatest exponent, digests of
    all runs and of the text without what runs repeat after their first period.
    ``plant``: periodic tails are put into some documents first (``planted``)."""
    require(docs, id_col, text_col)
    if min_exponent < 4:
        raise ValueError("min_exponent must be 4 or more")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number: defaultdict[bytes, int] = defaultdict()
            number.default_factory = number.__len__
            names, texts, size = [], [], 0
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                ids = np.array([number[w] for w in words(text.as_py().encode("utf-8", "surrogatepass"))], np.int64)
                names.append(doc)
                texts.append(planted(doc, ids) if plant else ids)
                size += len(ids)
                if size >= chunk:
                    yield out(names, texts, list(number))
                    names, texts, size = [], [], 0
                    number.clear()
            if names:
                yield out(names, texts, list(number))

    def out(names, texts, vocabulary) -> pa.RecordBatch:
        found = find_runs(np.concatenate(texts), np.array([len(t) for t in texts], np.int64), min_exponent, min_length)
        rows = [_row(doc, ids, vocabulary, r) for doc, ids, r in zip(names, texts, found)]
        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                          [c.split()[0] for c in SCHEMA.split(", ")])

    return (docs.select(F.col(id_col).cast("bigint").alias("id"), text_or_empty(text_col).alias("text"))
            .mapInArrow(run, SCHEMA))
