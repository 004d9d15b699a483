"""Toxicity classifier with counterfactual regularisation.

Features of a text: its distinct lower-cased words and their prefixes of
``PREFIXES`` letters (compounds and inflected forms share a prefix).  They mark
presence, so the length of a text does not dilute a match.

Fit: a bounded sample of labelled documents (``MAX_TRAIN``, those with the
smallest hash of their id) is cut into features; each feature's documents per
class are counted by Spark, and the ``MAX_FEATURES`` features with the largest
z-score of the difference between classes are kept (frequency at least
``MIN_DF``, z-score at least ``MIN_Z``), and besides them every identity term.  A logistic regression over them is fitted on the sample's feature
numbers.  The loss adds, for every identity term in a sentence of a sampled
document, ``COUNTERFACTUAL`` times the squared change of the logit when that term is
swapped, in that sentence, for the next term of its class (Garg et al. 2019):
naming one group or another must not change a score, so a group that is
insulted more often in the labels does not make a neutral mention toxic.  Only
features that differ count for such a change, so equal swaps are counted together.
The terms (``IDENTITY``) are a parameter; ``lexicon`` takes them from a table.

Scoring is one pass over all whole texts with the weights (at most
``MAX_FEATURES``) broadcast; no shuffle.

Nulls: a null text is an empty one; it is scored from the intercept.  Labels
with a null id or label are ignored; a repeated label counts as toxic if any
copy is.  Without labelled documents of both classes the score is the smoothed
share of toxic labels (0.5 without any) for every text alike, and ``drop_toxic``
keeps all rows: such a model tells nothing apart.  Repeated rows are scored each; ties
in the sample are broken by id; an empty table gives an empty result; extra
columns are ignored by ``score`` and kept by ``drop_toxic``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import require, text_or_empty
from tessera.session import materialize

MAX_TRAIN = 16_384      # labelled documents that are fitted at most
MAX_FEATURES = 4_096    # features besides the identity terms
MAX_TERMS = 10_000      # identity terms of a lexicon at most
MIN_DF = 5
MIN_Z = 5.0             # least z-score of a feature's difference between the classes
PREFIXES = (4, 5, 6)
RIDGE = 1e-5
COUNTERFACTUAL = 1.0
ROUNDS = 500
TOXIC_FROM = 0.3

#: Identity terms by class (fixed values); a term is swapped for the next of its class.
IDENTITY = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("woman", "man"), ("women", "men"), ("female", "male"), ("girl", "boy"), ("mother", "father"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("black", "white", "asian", "latino"), ("african", "european", "american"),
    ("immigrant", "native"), ("disabled", "able-bodied"), ("old", "young"),
    ("frau", "mann"), ("femme", "homme"), ("mujer", "hombre"),
)

_STRIP = ".,;:!?\"'()[]{}<>*_-–—«»„“”…"


def swaps(classes=IDENTITY) -> dict[str, str]:
    return {t: c[(i + 1) % len(c)] for c in classes for i, t in enumerate(c)}


def distinct_words(text: str) -> set[str]:
    return {w.strip(_STRIP) for w in set(text.lower().split())} - {""}


def features(found: set[str]) -> set[str]:
    """Words as they are, prefixes with a closing ``*``."""
    out = set(found)
    for n in PREFIXES:
        out.update([w[:n] + "*" for w in found if len(w) > n])
    return out


@dataclass
class Model:
    intercept: float
    weights: dict[str, float] = field(default_factory=dict)

    def score(self, text: str) -> float:
        get = self.weights.get
        z = self.intercept + sum(get(f, 0.0) for f in sorted(features(distinct_words(text)) & self.weights.keys()))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


SENTENCE = re.compile(r"[.!?\n]+")


def term_swaps(text: str, swap: dict[str, str]) -> list[tuple[frozenset, frozenset]]:
    """Per sentence and identity term in it: the features that a swap of the
    term takes away, and those it brings."""
    out = []
    low = text.lower()
    if not any(t in low for t in swap):
        return out
    for sentence in SENTENCE.split(low):
        w = distinct_words(sentence)
        for term in sorted(w & swap.keys()):
            before, after = features(w), features((w - {term}) | {swap[term]})
            out.append((frozenset(before - after), frozenset(after - before)))
    return out


def lexicon(table: DataFrame, group_col: str = "class", term_col: str = "term") -> tuple[tuple[str, ...], ...]:
    """Identity terms by class from a table, at most ``MAX_TERMS`` (an error beyond)."""
    rows = (table.where(F.col(group_col).isNotNull() & F.col(term_col).isNotNull())
            .select(F.col(group_col).alias("c"), F.lower(F.trim(term_col)).alias("t")).distinct()
            .orderBy("c", "t").limit(MAX_TERMS + 1).collect())
    if len(rows) > MAX_TERMS:
        raise ValueError(f"more than {MAX_TERMS} identity terms")
    by: dict = {}
    for r in rows:
        by.setdefault(r["c"], []).append(r["t"])
    return tuple(tuple(v) for v in by.values() if len(v) > 1)


def _fit(rows: list[np.ndarray], pairs: list[tuple[np.ndarray, np.ndarray, int]], y: np.ndarray, n_features: int,
         ridge: float, counterfactual: float, rounds: int) -> np.ndarray:
    """Weights (the last is the intercept) by Adam on the whole sample.  ``pairs``:
    features a swap takes away, features it brings, how often it occurs."""
    def flat(lists):
        sizes = np.array([len(r) for r in lists], np.int64)
        return np.repeat(np.arange(len(lists)), sizes), (np.concatenate(lists) if len(lists) else np.empty(0, int))

    doc, feat = flat(rows)
    cd1, cf1 = flat([p[0] for p in pairs])
    cd2, cf2 = flat([p[1] for p in pairs])
    often = np.array([p[2] for p in pairs], float)
    n, w = len(rows), np.zeros(n_features + 1)
    w[-1] = math.log((y.sum() + 1) / (n - y.sum() + 1))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        z = np.bincount(doc, w[feat], n) + w[-1]
        r = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y) / n
        g = np.append(np.bincount(feat, r[doc], n_features), r.sum())
        g[:-1] += ridge * w[:-1]
        if pairs:
            gap = np.bincount(cd1, w[cf1], len(pairs)) - np.bincount(cd2, w[cf2], len(pairs))
            gap *= 2 * counterfactual * often / n
            g[:-1] += np.bincount(cf1, gap[cd1], n_features) - np.bincount(cf2, gap[cd2], n_features)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        learn_from=None, max_train: int = MAX_TRAIN, max_features: int = MAX_FEATURES, ridge: float = RIDGE,
        counterfactual: float = COUNTERFACTUAL, classes=IDENTITY, rounds: int = ROUNDS) -> Model:
    """``learn_from``: condition on the label rows that may be used."""
    require(docs, id_col, text_col)
    require(labels, id_col, label_col)
    if learn_from is not None:
        labels = labels.where(learn_from)
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).cast("bigint").alias("_label_id"))
             .agg((F.max(F.col(label_col).cast("int")) > 0).cast("int").alias("_label"))
             .orderBy(F.xxhash64("_label_id"), "_label_id").limit(max_train))
    # at most max_train rows of (long, int): a proven bound
    sample = materialize(
        docs.select(F.col(id_col).cast("bigint").alias("_label_id"), text_or_empty(text_col).alias("text"))
        .join(F.broadcast(known), "_label_id").dropDuplicates(["_label_id"]).select("_label", "text"), "toxic-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}
        for b in batches:
            for y, text in zip(b.column("_label").to_pylist(), b.column("text").to_pylist()):
                for f in features(distinct_words(text)):
                    seen.setdefault(f, [0, 0])[y] += 1
            if len(seen) > 500_000:
                yield out(seen)
                seen = {}
        yield out(seen)

    def out(seen):
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()),
                                           pa.array([x[0] for x in seen.values()], pa.int64()),
                                           pa.array([x[1] for x in seen.values()], pa.int64())], ["f", "n0", "n1"])

    n = {r["_label"]: r["n"] for r in sample.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not n0 or not n1:
        return Model(math.log((n1 + 1) / (n0 + 1)))
    share = (F.col("n0") + F.col("n1")) / F.lit(n0 + n1)
    gap = F.col("n1") / F.lit(n1) - F.col("n0") / F.lit(n0)
    z = F.abs(gap) / F.sqrt(share * (1 - share) * F.lit(1 / n0 + 1 / n1) + F.lit(1e-12))
    best = (sample.mapInArrow(count, "f string, n0 bigint, n1 bigint").groupBy("f")
            .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
            .where((F.col("n0") + F.col("n1") >= min(MIN_DF, n1)) & (z >= MIN_Z))
            .orderBy(F.desc(z), "f").limit(max_features).select("f").collect())
    swap = swaps(classes)
    names = sorted({r["f"] for r in best} | swap.keys())    # identity terms are features whatever their z-score
    number = {f: k for k, f in enumerate(names)}

    def design(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, c = [], []
            for text in b.column("text").to_pylist():
                x.append(sorted(number[f] for f in features(distinct_words(text)) & number.keys()))
                pairs = Counter((tuple(sorted(number[f] for f in old & number.keys())),
                                 tuple(sorted(number[f] for f in new & number.keys())))
                                for old, new in term_swaps(text, swap))
                c.append([(list(old), list(new), k) for (old, new), k in sorted(pairs.items())])
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("_label"), pa.array(x, ints),
                 pa.array(c, pa.list_(pa.struct([("old", ints), ("new", ints), ("n", pa.int64())])))], ["y", "x", "c"])

    # at most max_train rows of feature numbers
    rows = sample.mapInArrow(design, "y int, x array<int>, c array<struct<old: array<int>, new: array<int>, n: bigint>>").collect()
    rows.sort(key=lambda r: (r["y"], r["x"]))  # the sum's order must not depend on task order
    pairs: Counter = Counter()
    for r in rows:
        for p in r["c"]:
            pairs[tuple(p["old"]), tuple(p["new"])] += p["n"]
    w = _fit([np.array(r["x"], np.int64) for r in rows],
             [(np.array(old, np.int64), np.array(new, np.int64), k) for (old, new), k in sorted(pairs.items())],
             np.array([r["y"] for r in rows], float), len(names), ridge, counterfactual, rounds)
    return Model(float(w[-1]), {f: float(x) for f, x in zip(names, w)})


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` of every row."""
    require(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([m.score(t.as_py()) for t in b.column("text")], pa.float64())],
                ["doc_id", "score"])

    return (docs.select(F.col(id_col).cast("bigint").alias("id"), text_or_empty(text_col).alias("text"))
            .mapInArrow(run, "doc_id bigint, score double"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", toxic_from: float = TOXIC_FROM) -> DataFrame:
    """``docs`` without the rows whose text scores ``toxic_from`` or more (all of
    ``docs`` if the model has no weights)."""
    require(docs, text_col)
    if not model.weights:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            yield b.filter(pa.array([m.score(t.as_py() or "") < toxic_from for t in b.column(text_col)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
