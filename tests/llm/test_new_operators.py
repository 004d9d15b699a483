"""Operators 11 to 13 against brute-force versions, and their edge cases."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import merkle, periodic_runs, phrases
from tessera.session import scratch_scope
from tests.conftest import SF_SMALL
from tests.llm.test_operators import CLASH, DOC, edge_rows, long_text

LANG = "doc_id bigint, text string, lang string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return sorted((r["doc_id"], r["text"], r["lang"]) for r in docs.collect())


# ------------------------------------------------------------------ 11 Merkle

def random_text(rng, n):
    return "".join(rng.choice(["word", "and", "é", "b", " ", ". ", ", ", "\n", "\n\n", "  ", "漢字", "|"]) for _ in range(n))


def test_trees_cut_without_loss_and_equal_roots_are_equal_texts():
    rng = random.Random(2)
    seen = {}
    for _ in range(400):
        t = random_text(rng, rng.randint(0, 80))
        paragraphs = merkle._PARAGRAPH.findall(t)
        assert "".join(paragraphs) == t
        for p in paragraphs:
            assert "".join(merkle._SPANS.findall(p)) == p == "".join(merkle._WORDS.findall(p))
        root = merkle.tree(t)
        assert root[1] == len(t) and seen.setdefault(root[0], t) == t
    assert len(set(seen.values())) == len(seen)


def test_differing_branches_locate_edits():
    rng = random.Random(3)
    paragraphs = [" ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(60)) + ".\n" for _ in range(60)]
    text = "".join(paragraphs)
    at = text.index(paragraphs[30]) + 100
    changed = text[:at] + "CHANGED" + text[at + 3:]
    left, right = merkle.differing(merkle.tree(text), merkle.tree(changed))
    assert len(left) == len(right) == 1
    assert left[0][0] <= at < sum(left[0]) and left[0][1] <= 2 * merkle.SPAN
    assert "CHANGED" in changed[right[0][0]:sum(right[0])]
    # a paragraph put in: nothing of the old text differs
    longer = "".join(paragraphs[:20] + ["A new one.\n"] + paragraphs[20:])
    left, right = merkle.differing(merkle.tree(text), merkle.tree(longer))
    assert left == [] and [longer[a:a + n] for a, n in right] == ["A new one.\n"]


def test_likeness_is_a_share():
    a, b = merkle.tree("one two three. " * 40), merkle.tree("quite other words here, " * 30)
    assert merkle.likeness(a, a) == 1 and merkle.likeness(a, b) == 0 == merkle.likeness(a, merkle.tree(""))
    assert merkle.likeness(merkle.tree(""), merkle.tree("")) == 1
    half = merkle.tree("one two three. " * 20 + "quite other words here, " * 12)
    assert 0.4 < merkle.likeness(a, half) < 0.6


def brute_edits(texts):
    """``texts`` in id order -> (n_chars, sha of the edited text, edited, next)."""
    out = []
    for i, t in enumerate(texts):
        following = texts[(i + 1) % len(texts)]
        n = len(t) // 2
        edited = t[:len(t) - n] + following[:n]
        out.append((len(t), hashlib.sha256(edited.encode()).hexdigest(), edited, following))
    return out


@pytest.mark.parametrize("partitions", [1, 7])
def test_fingerprints_equal_brute_force(spark, docs, rows, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["doc_id"]: r for r in merkle.edited_and_next(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(got) == len(rows)
    for (doc, text, _), (n, sha, edited, following) in zip(rows, brute_edits([t for _, t, _ in rows])):
        r = got[doc]
        a, b, c = merkle.tree(text), merkle.tree(edited), merkle.tree(following)
        assert (r["n_chars"], r["edited_sha256"]) == (n, sha)
        assert (r["fingerprint"], r["edited_fingerprint"]) == (a[0].hex(), b[0].hex())
        assert r["near_edited"] == merkle.likeness(a, b) and r["near_next"] == merkle.likeness(a, c)
    assert np.mean([r["near_edited"] > r["near_next"] for r in got.values()]) > 0.95


def test_merkle_edges(spark):
    assert merkle.edited_and_next(spark.createDataFrame([], DOC)).count() == 0
    one = merkle.edited_and_next(spark.createDataFrame([(7, "abcd")], DOC)).collect()
    assert len(one) == 1 and one[0]["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
    clash = CLASH + ", part int, _h long, partition int, end string"
    d = spark.createDataFrame([(*r, *("x" * 9), 1, 2, 3, "first") for r in edge_rows()], clash)
    got = merkle.edited_and_next(d).collect()
    assert len(got) == 9 and sum(r["doc_id"] is None for r in got) == 2
    by = {r["doc_id"]: r for r in got}
    assert by[1]["fingerprint"] == by[2]["fingerprint"] and by[1]["near_next"] == 1
    assert by[4]["near_next"] == 1 and by[4]["fingerprint"] == by[5]["fingerprint"]
    stored = merkle.trees(d).collect()
    root = {r["doc_id"]: r["fingerprint"] for r in stored}
    assert root[6] == by[6]["fingerprint"]
    nodes = next(r["nodes"] for r in stored if r["doc_id"] == 6)
    assert sum(n["n_chars"] for n in nodes if n["level"] == 2) == len(long_text())


# ----------------------------------------------------------------- 12 phrases

def brute_phrases(rows, min_count=100, max_words=5, top=2000):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = [x for x in re.split("[ \t]", piece) if x]
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    found = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= min_count}
    covered = set()
    for (lang, p), a in found.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                if 100 * a >= 100 * f[lang, p[i:i + k]]:
                    covered.add((lang, p[i:i + k]))
    out = collections.defaultdict(list)
    for (lang, p), a in found.items():
        if (lang, p) not in covered:
            score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {(lang, rank, p.decode(), -a, left, right, n[lang], -s) for lang, all_ in out.items()
            for rank, (s, a, p, left, right) in enumerate(sorted(all_)[:top], 1)}


def phrase_rows(spark, table, **options):
    return {tuple(r) for r in phrases.top(phrases.collocations(table, **options), options.pop("top", 2000)).collect()}


@pytest.mark.parametrize("block", [2_000, 1_000_000])
def test_phrases_equal_brute_force(spark, docs, rows, block):
    want = brute_phrases([(t, lang) for _, t, lang in rows], min_count=8)
    assert len({len(x[2].split()) for x in want}) == 4 and len(want) > 100
    assert phrase_rows(spark, docs, min_count=8, block_words=block) == want


def test_phrases_of_few_words_overlap_and_split(spark, monkeypatch):
    monkeypatch.setattr(phrases, "MIN_RANGES", 4)
    rng = random.Random(5)
    rows = []
    for i in range(300):
        words = [rng.choice(["a", "A", "b", "é", "É", "x\ty", ".", "a,a", "c\n"]) for _ in range(rng.randint(0, 60))]
        rows.append((i, rng.choice([" ", "  "]).join(words), rng.choice(["en", "de", None, "und"])))
    table = spark.createDataFrame(rows, LANG).repartition(5)
    for top in (7, 2000):
        want = brute_phrases([(t, lang) for _, t, lang in rows], min_count=20, top=top)
        got = {tuple(r) for r in phrases.top(phrases.collocations(table, min_count=20, block_words=500), top).collect()}
        assert got == want


def test_phrase_bytes_do_not_grow_with_the_number_of_frequent_phrases(spark):
    """Of 8 words all pairs are frequent in either table, longer phrases (up to 4 words) in the larger one
    only: it writes as much per word, not more for every level that its positions reach."""
    def written(n):
        rng = random.Random(n)
        rows = [(i, " ".join(rng.choices("abcdefgh", k=1000)), "en") for i in range(n // 1000)]
        table = spark.createDataFrame(rows, LANG).coalesce(1)
        with scratch_scope(spark) as created:
            want = brute_phrases([(t, lang) for _, t, lang in rows], min_count=20)
            got = {tuple(r) for r in phrases.top(phrases.collocations(table, min_count=20, block_words=2000)).collect()}
            assert got == want
            size = 0
            for path in created:
                if "/phrase-" in path:      # tables of blocks and occurrences; those of the phrases found are "phrases-"
                    t = spark.read.parquet(path)
                    binary = [c for c, kind in t.dtypes if kind == "binary"]
                    if binary:
                        size += t.agg(sum((F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in binary), F.lit(0))).collect()[0][0]
        return size / n, max(len(x[2].split()) for x in want)

    (small, short), (large, long_) = written(4_000), written(160_000)
    assert short == 2 and long_ == 4
    assert large < 1.15 * small


def test_phrase_products_beyond_64_bits(spark):
    row = [(10**12, 10**13, [10**6], [10**6])]
    d = spark.createDataFrame(row, "a bigint, n bigint, firsts array<bigint>, rests array<bigint>")
    assert d.select(phrases._weakest_cut(1000).alias("c")).collect()[0]["c"]["score"] == 10**16


def test_phrase_edges(spark):
    assert phrases.top(phrases.collocations(spark.createDataFrame([], LANG))).count() == 0
    extra = LANG + ", block string, range int, last binary, id long, n long, prefix long"
    rows = [(None, None, None), (1, "", "en"), (1, " \t.,\n", "en")] + [(2, "over and over and over", None)] * 60
    got = phrases.top(phrases.collocations(spark.createDataFrame([(*r, "x", 1, b"y", 2, 3, 4) for r in rows], extra)))
    assert {tuple(r) for r in got.collect()} == brute_phrases([(t, lang) for _, t, lang in rows])


# -------------------------------------------------------------------- 13 runs

def brute_runs(w):
    out = []
    for p in range(1, len(w) // 4 + 1):
        i = 0
        while i + p < len(w):
            if w[i] != w[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            n = j + p - i
            smaller = any(all(w[k] == w[k + q] for k in range(i, i + n - q)) for q in range(1, p))
            if n >= max(6, 4 * p) and not smaller:
                out.append((i, n, p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc, text):
    w = (text or "").encode().split()
    n = len(w)
    if doc is not None and n and zlib.crc32(str(doc).encode()) % 10 == 0:
        g = zlib.crc32(str(doc).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, m, p in runs for i in range(s + p, s + m)}
    from fractions import Fraction
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    return (doc, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


def periodic(rng):
    w = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 50))]
    if w and rng.random() < 0.5:
        a = rng.randrange(len(w))
        p = 1 + (len(w) - a) // rng.randint(3, 9)
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(len(w))]
    return w


@pytest.mark.parametrize("together", [1, 40])
def test_runs_equal_brute_force(together):
    rng = random.Random(together)
    for _ in range(200 // together + 20):
        texts = [periodic(rng) for _ in range(together)]
        got = periodic_runs.find_runs(np.array(sum(texts, []), np.int64), np.array([len(t) for t in texts]))
        assert got == [brute_runs(t) for t in texts]


def test_grouping_yields_lyndon_arrays():
    rng = random.Random(9)
    texts = [[rng.randrange(3) for _ in range(rng.randint(1, 30))] for _ in range(60)]
    length, group = periodic_runs.lyndon(np.array(sum(texts, []), np.int64), np.array([len(t) for t in texts]))
    at = 0
    for t in texts:
        prefixes = []
        for i in range(len(t)):
            # a Lyndon word is smaller than all its proper suffixes
            m = max(m for m in range(1, len(t) - i + 1)
                    if all(t[i:i + m] < t[j:i + m] for j in range(i + 1, i + m)))
            prefixes.append(tuple(t[i:i + m]))
        assert [len(p) for p in prefixes] == length[at:at + len(t)].tolist()
        g = group[at:at + len(t)].tolist()
        assert len(set(zip(g, prefixes))) == len(set(g)) == len(set(prefixes))
        assert [p for _, p in sorted(set(zip(g, prefixes)))] == sorted(set(prefixes))
        at += len(t)


@pytest.mark.parametrize("chunk", [300, 500_000])
def test_runs_of_documents_equal_brute_force(docs, rows, chunk):
    short = docs.where(F.length("text") < 3000)
    got = {tuple(r) for r in periodic_runs.runs(short, plant=True, chunk=chunk).drop("n_words").collect()}
    want = {brute_row(doc, text) for doc, text, _ in rows if len(text) < 3000}
    assert got == want and sum(r[1] > 0 for r in want) > 5


def test_run_edges(spark):
    assert periodic_runs.runs(spark.createDataFrame([], DOC)).count() == 0
    edge = [*edge_rows(), (20, "a " * 30), (21, "a b " * 4), (22, "a b a b a b a"), (23, "a a a a a"), (24, "x " * 6 + "y y y y y y")]
    d = spark.createDataFrame([(*r, *("x" * 9)) for r in edge], CLASH)
    got = collections.Counter(tuple(r) for r in periodic_runs.runs(d, plant=True).drop("n_words").collect())
    long = [r for r in edge if r[0] == 6]
    assert sum(got.values()) == len(edge)
    assert {r for r in got if r[0] != 6} == {brute_row(*r) for r in edge if r not in long}
    # 30,000 words of period 977, left as they are when nothing is planted
    r = periodic_runs.runs(d.where("doc_id = 6")).collect()[0]
    assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (1, 0, 30_000, 977, 30_706)
