"""Every operator against a brute-force version, and its edge cases: nulls in any
column, empty and very long texts, ties, repeated rows, empty tables, extra
columns with clashing names."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import (bpe, decontamination, hnsw, licenses, line_dedup, lm, packing, pii, simhash, token_counts,
                         toxicity)
from tessera.llm.common import connected_components, crc32_mod
from tests.conftest import SF_SMALL

DOC = "doc_id bigint, text string"
#: Extra columns whose names the operators use inside.
CLASH = DOC + ", id string, th string, fp string, did string, line string, t string, m string, key string, _id string"


def long_text(n=30_000):
    return " ".join(f"w{i % 977}" for i in range(n))


def edge_rows():
    return [(1, None), (None, "a b c d e f"), (2, ""), (3, "   \n\t\n"), (4, "one two three four five six"),
            (4, "one two three four five six"), (5, "one two three four five six"), (6, long_text()), (None, None)]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(*r, *("x" * 9)) for r in edge_rows()], CLASH)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


# -------------------------------------------------------------- components

def test_components_of_a_path_a_star_and_noise(spark):
    rows = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3), (8, 9)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(rows, "a long, b long"))
           .collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


# ----------------------------------------------------------- 1 benchmark leaks

ITEMS = [(1, "What does the quick brown fox jump over in the old story? It jumps over the lazy dog again."),
         (2, "Name seven rivers that cross the northern plain before winter. Alder, Birch, Cedar, Dogwood and Elm."),
         (3, None), (4, ""), (None, "Unnamed entry about seventeen purple umbrellas. They were left at the station.")]


def test_leaks_are_found_whole_and_clean_documents_stay(spark):
    random.seed(3)
    noise = ["".join(random.choices("abcdefgh", k=5)) for _ in range(4000)]
    filler = lambda n: " ".join(random.choices(noise, k=n))
    rows = [(10, filler(300) + " " + ITEMS[0][1] + " " + filler(200)), (11, ITEMS[1][1].upper()),
            (12, ITEMS[0][1].split("?")[0]),                      # the question alone
            (13, filler(500)), (14, None), (15, ""), (None, ITEMS[1][1]), (16, ITEMS[4][1]), (16, ITEMS[4][1]),
            (17, long_text() + " " + ITEMS[1][1])]
    d = spark.createDataFrame(rows, DOC)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(d, items).collect()}
    assert got == {(10, 1), (11, 2), (None, 2), (16, None), (17, 2)}
    assert sorted(r["doc_id"] for r in decontamination.drop_leaks(d, items).collect()) == [12, 13, 14, 15]


def test_items_with_one_word_edited_are_leaks(spark):
    items = spark.createDataFrame([(1, ITEMS[0][1]), (2, ITEMS[1][1]), (3, ITEMS[4][1])],
                                  "item_id bigint, text string")
    rows, want = [], set()
    for item, text in items.collect():
        w = text.split()
        for i, x in enumerate(w):
            mark = re.sub(r"\w", "", x)  # sentence ends stay
            for new in ([f"edited{mark}"], ["put", x], [mark]):
                want.add((len(rows), item))
                rows.append((len(rows), f"{long_text(60)} {' '.join(w[:i] + new + w[i + 1:])} {long_text(60)}"))
    # half of the answer missing, question and answer of different items
    more = [(-1, ITEMS[0][1].replace("lazy dog again.", "")[:-9] + long_text(60)),
            (-2, ITEMS[0][1].split("? ")[0] + "? " + ITEMS[1][1].split(". ")[1])]
    got = decontamination.find_leaks(spark.createDataFrame(rows + more, DOC), items)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want


def test_word_edits_equal_a_table():
    random.seed(5)
    for _ in range(300):
        part, text = ([random.choice([b"a", b"b", b"c"]) for _ in range(random.randint(1, n))] for n in (9, 14))
        row = [0] * (len(text) + 1)
        for i, x in enumerate(part, 1):
            old, row = row, [i]
            for j, y in enumerate(text, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        assert decontamination.word_edits(part, text) == (min(row), row.index(min(row)))


def test_wand_equals_exhaustive_scores(spark, docs):
    index = decontamination.build_index(spark.read.parquet(f"{SF_SMALL}/benchmark.parquet"))
    items = [tuple(x) for x in index[1].select("item", "item_id", "text", "n_words").collect()]
    post = [tuple(x) for x in index[0].select("item", "term", "weight").collect()]
    by_term = collections.defaultdict(list)
    for item, term, w in post:
        by_term[bytes(term)].append((item, w))
    for threshold in (0.1, 0.3):
        s = decontamination.Shard(items, post, threshold)
        order = {x[0]: k for k, x in enumerate(sorted(items))}
        for r in docs.limit(60).collect():
            words = set(decontamination.passage_words(r["text"])[:200])
            want = collections.Counter()
            for w in words:
                for item, x in by_term.get(w, ()):
                    want[order[item]] += x
            want = {i for i, x in want.items() if x >= threshold}
            terms = np.array(sorted(s.terms[w] for w in words if w in s.terms), np.int64)
            got = {i for i, _ in s.search(terms, s.live_blocks(terms))} if len(terms) else set()
            assert got == want


def test_index_in_many_shards_finds_the_same(spark, docs, monkeypatch):
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    one = {tuple(r) for r in decontamination.find_leaks(docs, items).select("doc_id", "item_id").collect()}
    full = decontamination.build_index
    monkeypatch.setattr(decontamination, "build_index", lambda *a: full(*a, shard_postings=200))
    many = {tuple(r) for r in decontamination.find_leaks(docs, items).select("doc_id", "item_id").collect()}
    assert one == many and one


def test_leak_edges(spark, edges, empty):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.find_leaks(edges, items).count() == 0
    assert decontamination.drop_leaks(edges, items).count() == len(edge_rows())
    assert decontamination.find_leaks(edges, none).count() == 0
    assert decontamination.drop_leaks(edges, none).columns == edges.columns
    assert decontamination.find_leaks(empty, items).count() == 0


# ------------------------------------------------------------------- 2 HNSW

VEC = "vec_id bigint, embedding array<double>, id string, score string"


def brute(rows, k):
    ok = [(i, np.array(v, float)) for i, v in rows
          if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {}
    for i, v in ok:
        if i % 50 == 0:
            s = sorted({(-float(u @ v) / (np.linalg.norm(u) * np.linalg.norm(v)), j) for j, u in ok if j != i})
            out[i] = [j for _, j in s[:k]]
    return out


def test_hnsw_recall_ties_and_invalid_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[50][1]) for i in range(20)]           # a group of copies
    bad = [(3000, None), (3050, [0.0] * 16), (3100, [float("nan")] * 16), (3150, [None] + [1.0] * 15),
           (None, rows[0][1]), (3200, [float("inf")] * 16), (3250, [1.0, 2.0])]
    table = spark.createDataFrame([(i, v, "a", "b") for i, v in rows + bad], VEC)
    index = hnsw.build_index(table, shard_rows=400)
    assert index.count() == 4
    got = collections.defaultdict(list)
    for r in hnsw.search(index, table.where("vec_id % 50 = 0"), query_block=7).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    want = brute(rows, 5)
    assert set(got) == set(want)
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.95
    assert got[50] == [2000, 2001, 2002, 2003, 2004]


def test_hnsw_small_and_empty(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], "", ""), (1, [1.0, 1.0], "", ""), (0, [1.0, 0.0], "", "")], VEC)
    got = [tuple(r) for r in hnsw.search(hnsw.build_index(few), few.where("vec_id = 0")).collect()]
    assert [g[:3] for g in got] == [(0, 1, 1)] and math.isclose(got[0][3], math.sqrt(0.5))
    none = spark.createDataFrame([], VEC)
    assert hnsw.search(hnsw.build_index(none), none).count() == 0


def test_hnsw_pairs_blocks_and_shards_without_a_broadcast(spark):
    """Blocks times shards grow with the square of the table: they must not pass the driver, however small the tables."""
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(600)]
    rows += [(50, rows[7][1]), (7, rows[50][1]), (100, rows[100][1])]  # two vectors of one id, a repeated query
    table = spark.createDataFrame([(i, v, "a", "b") for i, v in rows], VEC)
    found = hnsw.search(hnsw.build_index(table, shard_rows=100), table.where("vec_id % 50 = 0"), query_block=3)
    got = collections.defaultdict(list)
    for r in found.collect():
        got[r["query_id"]].append((-r["score"], r["vec_id"]))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Broadcast" not in plan
    want = collections.defaultdict(dict)
    for i, v in rows:
        for j, u in rows:
            if i % 50 == 0 and j != i:
                s = float(np.dot(u, v) / (np.linalg.norm(u) * np.linalg.norm(v)))
                want[i][j] = max(s, want[i].get(j, -1.0))
    assert set(got) == set(want)
    for i, near in want.items():  # a beam of 120 over shards of about 100 finds all
        best = sorted((-s, j) for j, s in near.items())[:5]
        assert [j for _, j in sorted(got[i])] == [j for _, j in best]
        assert np.allclose(sorted(s for s, _ in got[i]), [s for s, _ in best], rtol=0, atol=1e-12)


def test_hnsw_merged_keeps_the_best_of_an_id():
    def near(*rows):
        out = hnsw._nothing(len(rows), 3)
        for q, row in enumerate(rows):
            for j, (x, s) in enumerate(row):
                for col, value in zip(out, (x, s, True)):
                    col[q, j] = value
        return out

    x, s, has = hnsw._merged(near([(4, .9), (0, .5), (8, .1)], []), near([(0, .7), (3, .5), (2, .5)], [(0, -1.0)]), 3)
    assert [list(zip(x[q][has[q]].tolist(), s[q][has[q]].tolist())) for q in range(2)] == [
        [(4, .9), (0, .7), (2, .5)], [(0, -1.0)]]


# -------------------------------------------------------------------- 3 PII

def py_feistel(key, kind, left, right, a, b):
    for i in range(pii.ROUNDS):
        x = right if i % 2 == 0 else left
        f = int(hashlib.sha256(f"{key}|{kind}|{i}|{x}".encode()).hexdigest()[:15], 16)
        if i % 2 == 0:
            left = (left + f % a) % a
        else:
            right = (right + f % b) % b
    return left, right


def luhn(s):
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(s)))) % 10 == 0


def test_pii_formats_and_links(spark):
    card = "4111111111111111"
    text = (f"call +1 (212) 555-0100 or mail Jo.9@mail1.example.com, card {card}, 4111-1111-1111-1111, "
            "host 10.0.0.255, born 1985-03-04 = 03/04/1985 = 04.03.1985, ssn 123-45-6789.")
    stay = "card 4111111111111112, 2023-02-30, 999.1.1.1, 666-12-3456, v 1.2.3, 12345"
    d = spark.createDataFrame([(1, text, "a"), (2, "again: " + text, "b"), (3, stay, "c"), (4, None, "d"), (5, "", "e"),
                               (6, "+1 (112) 555-0100", "f")], DOC + ", t string")
    out = {r["doc_id"]: r for r in pii.pseudonymise(d, "k").collect()}
    kinds = [f["kind"] for f in out[1]["found"]]
    assert kinds == ["phone", "email", "card", "card", "ip", "date", "date", "date", "ssn"]
    new = [f["pseudonym"] for f in out[1]["found"]]
    assert re.fullmatch(r"\+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}", new[0])
    assert re.fullmatch(r"[A-Z][a-z]\.\d@mail1\.example\.com", new[1])
    assert luhn(new[2]) and new[3].replace("-", "") == new[2] and new[2] != card
    assert all(int(o) < 256 for o in new[4].split("."))
    y, m, day = new[5].split("-")
    assert new[6] == f"{m}/{day}/{y}" and new[7] == f"{day}.{m}.{y}"
    assert out[2]["text"] == "again: " + out[1]["text"] and card not in out[1]["text"]
    assert out[3]["text"] == stay and out[3]["found"] == []
    assert out[4]["text"] is None and out[4]["found"] is None and out[5]["text"] == ""
    # no valid area code: a pseudonym without one, so it never meets that of a valid number
    other = re.fullmatch(r"\+1 \((\d)\d\d\) (\d)\d\d-\d{4}", out[6]["text"])
    assert out[6]["text"] != "+1 (112) 555-0100" and (other[1] in "01" or other[2] in "01")
    ip = py_feistel("k", "ip", 10 * 256, 255, 65536, 65536)
    assert new[4] == f"{ip[0] >> 8}.{ip[0] & 255}.{ip[1] >> 8}.{ip[1] & 255}"


def test_pii_phone_forms_and_times(spark):
    rows = ["+1 (017) 555-7713", "+1 (212) 155-0100", "+1 (212) 555-0100", "(212) 555-0100", "212-555-0100",
            "+1-212-555-0100", "+1 212 555 0100", "+44 20 7946 0958", "+33 1 23 45 67 89", "2024-01-05T10:00"]
    d = spark.createDataFrame([(i, f"at {x}, then") for i, x in enumerate(rows)], DOC)
    out = [r for r in pii.pseudonymise(d, "k").orderBy("doc_id").collect()]
    assert [[f["kind"] for f in r["found"]] for r in out] == [["phone"]] * 9 + [["date"]]
    new = [r["text"][3:-6] for r in out]
    assert all(x != y and re.sub(r"\d", "0", x) == re.sub(r"\d", "0", y) for x, y in zip(rows, new))
    for x in new[:2]:
        digits = re.sub(r"\D", "", x)
        assert x.startswith("+1 (") and (digits[1] in "01" or digits[4] in "01")
    assert len({re.sub(r"\D", "", x)[-10:] for x in new[2:7]}) == 1
    assert new[7].startswith("+44 ") and new[8].startswith("+33 ") and new[9].endswith("T10:00")


def test_pii_is_a_permutation(spark):
    n = 627 * 233
    x = pii.feistel("k", "date", (F.col("id") / 233).cast("bigint"), F.col("id") % 233, F.lit(627), F.lit(233))
    got = spark.range(n).select(x.alias("x")).select((F.col("x.l") * 233 + F.col("x.r")).alias("v")) \
        .agg(F.countDistinct("v"), F.min("v"), F.max("v")).collect()[0]
    assert tuple(got) == (n, 0, n - 1)
    mails = spark.range(26 * 26 * 10).select(F.concat(
        F.char(F.col("id") % 26 + 97), F.char((F.col("id") / 26).cast("int") % 26 + 97),
        (F.col("id") / 676).cast("int").cast("string")).alias("s"))
    assert mails.select(pii.feistel_text("k", "email", F.col("s")).alias("p")).distinct().count() == 6760


def test_pii_uses_no_python(docs):
    plan = pii.pseudonymise(docs, "k")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_pii_edges(spark, edges, empty):
    assert pii.pseudonymise(edges, "k").count() == len(edge_rows())
    assert pii.pseudonymise(edges, "k").columns == [*edges.columns, "found"]
    assert pii.pseudonymise(empty, "k").count() == 0
    own = spark.createDataFrame([(1, "at 10.0.0.1", "mine")], DOC + ", found string")
    row = pii.pseudonymise(own, "k").collect()[0]
    assert [f["kind"] for f in row["found"]] == ["ip"] and row.__fields__ == ["doc_id", "text", "found"]


# --------------------------------------------------------------- 4 toxicity

def toxic_table(spark):
    random.seed(1)
    plain = [f"word{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(900):
        w = random.choices(plain, k=30)
        bad = i % 4 == 0
        if bad:
            w[3] = random.choice(["idiot", "scum", "moron"])
        if (bad and i % 8 == 0) or i % 40 == 1:
            w[5] = "muslim"      # named far more often in toxic sentences
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, DOC), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_toxicity_held_out_and_counterfactual(spark):
    d, labels = toxic_table(spark)
    held = crc32_mod("doc_id", 4)
    model = toxicity.fit(d, labels, learn_from=held != 2)
    got = toxicity.score(d, model).join(labels, "doc_id").where(held == 2).collect()
    assert all((r["score"] >= toxicity.TOXIC_FROM) == bool(r["toxic"]) for r in got) and len(got) > 100
    plainly = toxicity.fit(d, labels, learn_from=held != 2, counterfactual=0.0)
    gap = lambda m: abs(m.score("a muslim reads") - m.score("a buddhist reads"))
    strong = toxicity.fit(d, labels, learn_from=held != 2, counterfactual=50.0)
    assert gap(strong) < gap(plainly) and strong.score("a muslim reads") < toxicity.TOXIC_FROM


def test_neutral_mentions_are_fewer_false_positives(spark):
    """A group that is named in toxic sentences only: without the regulariser its
    name alone is taken for toxicity, with it a neutral mention is not."""
    random.seed(2)
    plain = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(1200):
        w = random.choices(plain, k=20)
        bad = i % 3 == 0
        if bad:
            w[4] = random.choice(["idiot", "scum", "moron", "vermin"]) if i % 2 else "buddhist"
            w[6] = "muslim"
        elif i % 5 == 1:
            w[6] = "christian"
        rows.append((i, " ".join(w[:10]) + ". " + " ".join(w[10:])))
        labels.append((i, int(bad)))
    d, y = spark.createDataFrame(rows, DOC), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    neutral = [f"The {t} {' '.join(random.choices(plain, k=8))}" for t in ("muslim", "jewish", "hindu") for _ in range(20)]
    wrong = {c: sum(toxicity.fit(d, y, counterfactual=c).score(t) >= toxicity.TOXIC_FROM for t in neutral) for c in (0.0, 20.0)}
    assert wrong[0.0] >= 20 and wrong[20.0] == 0


def test_fit_equals_a_dense_one():
    rng = np.random.default_rng(3)
    n, k = 60, 9
    x = rng.random((n, k)) < 0.3
    y = (x[:, 0] | (rng.random(n) < 0.1)).astype(float)
    pairs = [([0, 2], [1], 3), ([4], [5, 6], 1), ([], [7], 2)]
    got = toxicity._fit([np.flatnonzero(r) for r in x],
                        [(np.array(a, np.int64), np.array(b, np.int64), c) for a, b, c in pairs], y, k, 1e-3, 2.0, 120)
    change = np.zeros((len(pairs), k))
    for i, (a, b, _) in enumerate(pairs):
        change[i, a] += 1
        change[i, b] -= 1
    often = np.array([c for *_, c in pairs], float)
    w, m, v = np.append(np.zeros(k), math.log((y.sum() + 1) / (n - y.sum() + 1))), np.zeros(k + 1), np.zeros(k + 1)
    for t in range(1, 121):
        p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
        g = np.append(x.T @ (p - y) / n + 1e-3 * w[:-1] + 2 * 2.0 / n * change.T @ (often * (change @ w[:-1])), (p - y).sum() / n)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    assert np.allclose(got, w, atol=1e-9)


def test_one_swap_per_sentence_and_term(spark):
    swap = toxicity.swaps((("red", "green", "blue"),))
    got = toxicity.term_swaps("Red and blue. No term here! A red one", swap)
    # blue -> red, which the sentence holds already; red -> green, once per sentence
    assert got == [(frozenset({"blue"}), frozenset()), (frozenset({"red"}), frozenset({"green", "gree*"})),
                   (frozenset({"red"}), frozenset({"green", "gree*"}))]
    table = spark.createDataFrame([("c", " Red"), ("c", "blue"), ("d", "alone"), (None, "x"), ("c", None)], "class string, term string")
    assert toxicity.lexicon(table) == (("blue", "red"),)


def test_toxicity_edges(spark, edges, empty):
    labels = spark.createDataFrame([(1, 0), (None, 1), (4, None), (99, 1)], "doc_id bigint, toxic int")
    model = toxicity.fit(edges, labels)
    assert model.weights == {} and 0 < model.score("") < 1
    assert toxicity.score(edges, model).count() == len(edge_rows())
    assert toxicity.drop_toxic(edges, toxicity.Model(-5.0)).count() == len(edge_rows())
    assert toxicity.drop_toxic(edges, toxicity.Model(5.0)).columns == edges.columns
    assert toxicity.fit(empty, labels).score("x") == 0.5 and toxicity.score(empty, model).count() == 0


# --------------------------------------------------------------- 5 licences

def py_dice(text, template):
    a, b = set(licenses.bigrams(text)), set(licenses.bigrams(template))
    return 2 * len(a & b) / (len(a) + len(b)) if a and b else 0.0


def test_licenses_equal_unpruned_scores(spark):
    t = licenses.TEMPLATES
    half = t["MIT-permission"].split(" The above")[0]
    wrapped = re.sub(r"(.{60}\S*) ", r"\1\n", t["Apache-2.0-header"])
    rows = [(1, "x\n" + t["MIT"] + "\ny"), (2, wrapped), (3, "intro\n\n" + wrapped + "\n \nend"), (4, half),
            (5, "Released under the MIT"), (6, None), (7, ""), (8, "released UNDER the -- mit license"),
            (9, long_text()), (None, t["GPL-3.0"]), (10, t["CC-BY-4.0"] + " " + t["CC-BY-4.0"])]
    got = {(r["doc_id"], r["unit"], r["segment"]): (r["license"], r["score"])
           for r in licenses.scan(spark.createDataFrame(rows, DOC)).collect()}
    want = {}
    for doc, text in rows:
        parts = [("line", i, s) for i, s in enumerate((text or "").split("\n"), 1)] if text is not None else []
        parts += [("paragraph", i, s) for i, s in enumerate(re.split(r"\n[ \t\r]*\n", text or ""), 1) if "\n" in s]
        for unit, i, s in parts:
            best = min(((-py_dice(s, x), n) for n, x in t.items()))
            if -best[0] >= licenses.THRESHOLD:
                want[doc, unit, i] = (best[1], -best[0])
    assert got == want and len(got) >= 5


def test_every_notice_of_the_documents_is_reported(docs, texts):
    known = {"All rights reserved.": "All-rights-reserved", "Released under the MIT License.": "MIT",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
             "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0"}
    lines = [(d, i, x) for d, t in texts.items() for i, x in enumerate((t or "").split("\n"), 1)]
    notices = [(d, i, x) for d, i, x in lines if re.search(r"licensed? under|\bMIT License|rights reserved", x, re.I)]
    got = {(r["doc_id"], r["segment"]): r["license"] for r in licenses.scan(docs).where("unit = 'line'").collect()}
    assert got == {(d, i): known[x] for d, i, x in notices}
    assert [x for *_, x in notices].count("All rights reserved.") == 3


def test_notices_among_other_words_are_found(spark):
    t = licenses.TEMPLATES
    wrapped = re.sub(r"(.{60}\S*) ", r"\1\n", "here is a note on what may be done. " + t["Apache-2.0-header"]
                     + " and here the note goes on with many more words " + long_text(300))
    rows = [(1, "Copyright 2020 Acme. Released under the MIT License."),
            (2, long_text(900) + " " + t["GPL-2.0"].replace("work", "code") + " " + long_text(900)),
            (3, "one two three this work\nis licensed under the GNU\nGeneral Public License, version 3. four\nfive six seven eight nine ten"),
            (4, "(c) Acme. All rights reserved. Released under the MIT License, see there."),
            (5, "text\nReleased under the MIT License.\nmore, all rights are reserved"), (6, wrapped),
            (7, t["MIT"] + "\nor as you like: released under the MIT license")]
    got = collections.defaultdict(list)
    for r in licenses.scan(spark.createDataFrame(rows, DOC)).collect():
        got[r["doc_id"]].append((r["unit"], r["segment"], r["license"], r["score"]))
    assert got[1] == [("window", 4, "MIT", 1.0)]
    assert [x[:3] for x in got[2]] == [("window", 903, "GPL-2.0")] and got[2][0][3] >= licenses.THRESHOLD
    assert got[3] == [("window", 4, "GPL-3.0", 1.0)]
    assert sorted(got[4]) == [("window", 3, "All-rights-reserved", 1.0), ("window", 6, "MIT", 1.0)]
    assert got[5] == [("line", 2, "MIT", 1.0)]
    assert ("window", 10, "Apache-2.0-header", 1.0) in got[6]
    assert sorted(got[7]) == [("line", 1, "MIT", 1.0), ("window", 10, "MIT", 1.0)]


def test_places_of_matched_segments_are_counted_over_the_whole_text(spark):
    mit, gap = licenses.TEMPLATES["MIT"], "\n \n...\n\n"
    text = "one two" + gap + mit + gap + "three four\n" + mit + " five\n" + f"more. {mit} {mit} five six seven"
    got = sorted(tuple(r)[1:] for r in licenses.scan(spark.createDataFrame([(1, text)], DOC)).collect())
    at = [i for i, x in enumerate(text.split("\n"), 1) if x.startswith("Released")]
    assert [x[:2] for x in got if x[0] == "line"] == [("line", i) for i in at]
    # the windows of the last line alone: those over matched lines hold no more than these
    before = len(re.sub("[^a-z0-9]+", " ", text.lower().rsplit("more", 1)[0]).split())
    assert [x[:2] for x in got if x[0] == "window"] == [("window", before + 2), ("window", before + 7)]


def test_license_edges(edges, empty):
    assert licenses.scan(edges).count() == 0 and licenses.scan(empty).count() == 0
    assert licenses.scan(edges, templates={"none": "word"}).count() == 0


# ----------------------------------------------------------- 6 token counts

def test_ids_are_those_of_the_tokenizers_library(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    for x in [*list(texts.values())[:60], "", " ", "<|endoftext|> x", "é  \n\n b", "a" * 5000]:
        assert bpe.encode(x).tolist() == t.encode(x, add_special_tokens=False).ids


def test_edited_trees_equal_counting_anew(texts):
    random.seed(2)
    parts = ["", " ", "  ", "\n", "x", " the", "'s", "12", " é", "word " * 200, ".", "a" * 50]
    for leaf in (8, 64):
        for text in [*list(texts.values())[:25], "", " ", "foo  bar\t baz   q " * 20]:
            tree = token_counts.TokenTree.build(text[:2000], leaf=leaf)
            for _ in range(10):
                tree.edit(random.randint(0, len(tree.text) + 2), random.choice([0, 1, 5, 40, 300]),
                          random.choice(parts))
                assert tree.count == bpe.count(tree.text)


def test_stored_trees_take_edits_and_encode_little(spark, edges, empty):
    text = long_text(20_000)
    d = spark.createDataFrame([(1, text), (2, None), (3, "a b")], DOC)
    edits = spark.createDataFrame([(1, 2, 5, 3, "zzz"), (1, 1, 50_000, 0, " new words"), (2, 1, 9, 9, "hello"),
                                   (7, 1, 0, 0, "x"), (3, 1, -4, None, None)],
                                  "doc_id long, seq int, start long, n_deleted long, inserted string")
    got = {r["doc_id"]: r for r in token_counts.apply_edits(d, token_counts.build_trees(d), edits, keep_text=True)
           .collect()}
    want = text[:50_000] + " new words" + text[50_000:]
    want = want[:5] + "zzz" + want[8:]
    assert got[1]["text"] == want and got[1]["tokens_after"] == bpe.count(want)
    assert got[1]["encoded_chars"] < 2_000 and got[2]["text"] == "hello" and got[3]["tokens_after"] == 2
    null = F.lit(None).cast(token_counts.EDITS)
    assert token_counts.edit_and_count(edges, null).count() == len(edge_rows())
    assert token_counts.edit_and_count(empty, null).count() == 0


# ------------------------------------------------------------- 7 line dedup

def brute_lines(rows):
    order = sorted({(i if i is not None else math.inf, t) for i, t in rows if t is not None},
                   key=lambda x: x[0])
    at = [(d, i, tuple(line.split())) for d, t in order for i, line in enumerate(t.encode().split(b"\n"))
          if line.split()]
    first, gone = {}, {}
    for d, i, w in at:
        first.setdefault(w, (d, i))
    for w in sorted(first, key=first.get):  # against the lines that stay
        near = [first[v] for v in gone if gone[v] is None and min(len(v), len(w)) >= line_dedup.MIN_WORDS
                and line_dedup.within_one(list(v), list(w))]
        gone[w] = min(near, default=None)
    return {(d, i, *(gone[w] or first[w]), int(gone[w] is not None)) for d, i, w in at
            if gone[w] or first[w] != (d, i)}


def test_line_dedup_equals_brute_force(spark):
    random.seed(4)
    base = [[f"v{random.randrange(30)}" for _ in range(random.randint(1, 9))] for _ in range(25)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(4):
            w = list(random.choice(base))
            k = random.randrange(4)
            if k == 1:
                w[random.randrange(len(w))] = "new"
            elif k == 2:
                w.insert(random.randrange(len(w) + 1), "more")
            elif k == 3 and len(w) > 1:
                w.pop(random.randrange(len(w)))
            lines.append(random.choice([" ", "  "]).join(w))
        rows.append((i, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "\n \n"), (None, rows[0][1])]
    got = {tuple(math.inf if x is None else x for x in r)
           for r in line_dedup.repeated_lines(spark.createDataFrame(rows, DOC)).collect()}
    assert got == brute_lines(rows) and len(got) > 100


def test_chains_of_near_lines_are_decided_against_kept_ones(spark):
    chain, words = ["another line altogether"], list("abcdefgh")
    for i in range(8):  # every line one word from the one before, two from the one before that
        words = [*words[:i], f"n{i}", *words[i + 1:]]
        chain.append(" ".join(words))
    grid = [f"the {x} of a large {y} is here" for x in "pqrstu" for y in "vwxyz"]
    rows = [(i, t) for i, t in enumerate([*chain, *grid, *grid[7:9]])]
    got = {tuple(r) for r in line_dedup.repeated_lines(spark.createDataFrame(rows, DOC)).collect()}
    assert got == brute_lines(rows)
    gone = {d for d, *_ in got}
    assert [i for i in range(1, 9) if i in gone] == [2, 4, 6, 8]
    assert len(gone & set(range(9, 9 + len(grid)))) == len(grid) - 5


def test_line_hashes_of_deletions():
    rng = random.Random(3)
    for _ in range(300):
        w = [rng.choice([b"a", b"b", b"ab"]) for _ in range(rng.randint(1, 8))]
        prefix = line_dedup.prefix_hashes(w)
        for p in range(len(w)):
            assert line_dedup.without(prefix, p) == line_dedup.prefix_hashes(w[:p] + w[p + 1:])[-1]
    # different short sequences have different hashes
    many = {(x, y, z) for x in (b"a", b"b", b"ab", b"") for y in (b"a", b"b", b"ab", b"") for z in (b"a", b"", b"b")}
    assert len({line_dedup.prefix_hashes(list(w))[-1] for w in many}) == len(many)


def test_near_lines_of_20000_words(spark):
    w = [f"w{i}" for i in range(20_000)]
    rows = [(1, " ".join(w)), (2, " ".join([*w[:9_000], "new", *w[9_001:]])), (3, " ".join(w[:-1])),
            (4, " ".join([*w[:5], "x", "y", *w[7:]]))]
    got = line_dedup.repeated_lines(spark.createDataFrame(rows, DOC)).collect()
    assert sorted((r["doc_id"], r["kept_doc_id"], r["distance"]) for r in got) == [(2, 1, 1), (3, 1, 1)]


def test_lines_go_and_documents_left_empty_too(spark, edges, empty):
    rows = [(1, "a b c d e f\nx\n\nz"), (2, "a b c d e g\nown line"), (3, "x"), (4, ""), (5, None), (6, "x\n\nkept")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.drop_repeated_lines(spark.createDataFrame(rows, DOC)).collect()}
    assert got == {1: "a b c d e f\nx\n\nz", 2: "own line", 4: "", 5: None, 6: "\nkept"}
    out = line_dedup.drop_repeated_lines(edges)
    assert out.columns == edges.columns
    # the repeated row is one document with the first; 5 repeats its only line
    assert sorted((r["doc_id"] or 0) for r in out.collect()) == [0, 0, 1, 2, 3, 4, 4, 6]
    assert line_dedup.drop_repeated_lines(empty).count() == 0


# ------------------------------------------------------------- 8 LM scoring

@pytest.mark.parametrize("order", [2, 3])
def test_lm_equals_brute_force(docs, texts, order):
    got = {r["doc_id"]: r for r in lm.score(docs, crc32_mod("doc_id", 7) == 2, order=order, block_tokens=5000)
           .collect()}
    cut = lambda t: [b"<s>", *t.encode().lower().split(), b" "]
    seen, trains = collections.Counter(), 0
    for d, t in texts.items():
        if zlib.crc32(str(d).encode()) % 7 != 2:
            w, trains = cut(t), trains + 1
            seen.update(tuple(w[i - k + 1:i + 1]) for i in range(1, len(w)) for k in range(1, order + 1) if i >= k - 1)
    n = sum(c for g, c in seen.items() if len(g) == 1)
    v = sum(1 for g in seen if len(g) == 1)
    seen[(b"<s>",)] = trains
    better = 0.0
    for d, t in texts.items():
        w, base, total, known = cut(t), 0.0, 0.0, 0
        for i in range(1, len(w)):
            p = (seen[(w[i],)] + 1) / (n + v + 1)
            base, known = base + math.log10(p), known + (seen[(w[i],)] > 0)
            for k in range(2, min(order, i + 1) + 1):
                h = tuple(w[i - k + 1:i])
                p = (seen[(*h, w[i])] + lm.PRIOR * p) / (seen[h] + lm.PRIOR)
            total += math.log10(p)
        r = got[d]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w) - 1, known, n)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and math.isclose(r["score"], total, rel_tol=1e-9)
        better += (total - base) * r["held_out"]
    assert better > 0


def test_lm_edges(edges, empty):
    rows = lm.score(edges, crc32_mod("doc_id", 7) == 2).collect()
    assert len(rows) == len(edge_rows()) and all(r["score"] <= 0 for r in rows)
    none = lm.score(edges, F.lit(True)).collect()
    assert all(r["train_tokens"] == 0 and r["base_score"] == 0 for r in none)
    assert lm.score(empty, F.lit(False)).count() == 0


# ---------------------------------------------------------------- 9 packing

def test_packing_is_whole_gapless_and_tight(docs, texts):
    rows = packing.pack(docs).collect()
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for d, t in texts.items():
        ids = np.append(bpe.encode(t, special=True), 0).astype("<u4")
        p = sorted(by_doc[d], key=lambda r: r["piece"])
        assert [r["piece"] for r in p] == list(range(len(p)))
        assert all(r["length"] == packing.CAPACITY for r in p[1:]) and sum(r["length"] for r in p) == len(ids)
        at = 0
        for r in p:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.CAPACITY
    assert len(by_seq) <= -(-sum(r["length"] for r in rows) // packing.CAPACITY) + 2


def test_solver_uses_every_length_once_and_beats_best_fit():
    rng = random.Random(7)
    wins = 0
    for _ in range(40):
        counts = collections.Counter(rng.choices(range(15, 60), k=rng.randint(5, 40)))
        best = packing.pack_lengths(dict(counts), 100)
        used = collections.Counter()
        for p, m in best:
            assert sum(n * c for n, c in p.items()) <= 100
            used.update({n: c * m for n, c in p.items()})
        assert used == counts
        bins, greedy = sum(m for _, m in best), sum(m for _, m in packing.best_fit(dict(counts), 100))
        assert packing.lower_bound(dict(counts), 100) <= bins <= greedy
        wins += bins < greedy
    assert wins
    # an instance best fit gets wrong: 6 4 / 5 5 needs completion
    assert sum(m for _, m in packing.pack_lengths({44: 1, 24: 2, 22: 1, 21: 1, 17: 2, 8: 2, 6: 2}, 100)) == 2


def test_search_budget_grows_with_the_lengths():
    rng = random.Random(11)
    counts = {n: rng.randint(1, 200) for n in range(1, 2049)}
    best = packing.pack_lengths(counts)
    used = collections.Counter()
    for p, m in best:
        used.update({n: c * m for n, c in p.items()})
    assert used == counts and sum(m for _, m in best) <= sum(m for _, m in packing.best_fit(counts, 2048))


def test_pieces_of_special_tokens_and_ties(spark):
    rows = [(1, "a <|endoftext|> b"), (2, "x y"), (2, "x y"), (3, "x y")]
    got = packing.pack(spark.createDataFrame(rows, DOC)).orderBy("doc_id", "offset").collect()
    ids = np.array([64, 220, 50256, 275, 0], "<u4")
    assert got[0]["length"] == 5 and got[0]["ids_crc32"] == zlib.crc32(ids.tobytes())
    assert len({r["sequence_id"] for r in got}) == 1 and sorted(r["offset"] for r in got) == [0, 5, 8, 11]


def test_packing_edges(edges, empty):
    rows = packing.pack(edges).collect()
    assert sum(r["length"] == 1 for r in rows) == 3 and len({r["doc_id"] for r in rows}) == 7
    assert packing.pack(empty).count() == 0


# --------------------------------------------------------------- 10 SimHash

def test_masks_cover_every_pair_within_the_radius():
    rng = random.Random(0)
    for radius in (2, 4):
        masks = simhash.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(3000):
            flip = sum(1 << b for b in rng.sample(range(64), rng.randint(0, radius)))
            assert any(not flip & m for m in masks)


def brute_components(fps):
    out = list(range(len(fps)))

    def find(x):
        while out[x] != x:
            x = out[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = sorted((find(i), find(j)))
                out[b] = a
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("block", [2, simhash.BLOCK])
def test_fingerprint_links_equal_brute_force(spark, block):
    rng = random.Random(6)
    fps = set()
    for _ in range(15):
        x = rng.getrandbits(64)
        for _ in range(20):
            fps.add(x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    fps = sorted(fps)
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp bigint")
    comp = {r["id"] % (1 << 64): r["component"] % (1 << 64) for r in
            connected_components(simhash.fingerprint_links(df, block=block)).collect()}
    groups = collections.defaultdict(set)
    for x, c in zip(fps, brute_components(fps)):
        groups[c].add(x)
    got = collections.defaultdict(set)
    for x in fps:
        got[comp.get(x, x)].add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_fingerprint_by_hand_and_native_hash(spark):
    words = "The quick brown fox jumps over it".split()
    low = [w.lower() for w in words]
    shingles = [" ".join(low[i:i + 4]) for i in range(4)]
    hashes = [r[0] % (1 << 64) for r in spark.createDataFrame([(s,) for s in shingles], "s string")
              .select(F.xxhash64("s")).collect()]
    want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
    assert simhash.fingerprint("  ".join(words)) == want
    assert simhash.fingerprint("") == 0 == simhash.fingerprint(" \n")


def test_simhash_edges(edges, empty):
    near = {(r["doc_id"], r["fp"]): r["component_id"] for r in simhash.near_duplicates(edges).collect()}
    ids = collections.defaultdict(set)
    for (d, _), c in near.items():
        ids[d].add(c)
    assert ids[1] == ids[2] == ids[3] == {1} and ids[4] == ids[5] == {4} and ids[6] == {6}
    kept = simhash.drop_near_duplicates(edges)
    assert kept.columns == edges.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 4, 6]
    assert simhash.near_duplicates(empty).count() == 0 and simhash.drop_near_duplicates(empty).count() == 0
