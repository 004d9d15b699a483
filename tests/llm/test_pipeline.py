"""The pipeline against a brute-force run of its stages, and the registered queries."""

import collections

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tessera.llm import decontamination, simhash, toxicity
from tests.conftest import SF_SMALL
from tests.llm.test_operators import brute_components, brute_lines, long_text
from tests.oracle import compare, duck

OPS = [f"op{n}_" for n in range(1, 14)]


def test_one_query_per_operator_and_the_pipeline():
    names = list(entry.queries())
    assert all(sum(x.startswith(o) for x in names) == 1 for o in OPS) and "pipeline" in names


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n.startswith("op")])
def test_oracle(spark, name):
    r = compare(spark, name, entry.queries()[name], entry.oracle_sql()[name], SF_SMALL, duck(SF_SMALL))
    assert r["status"] == "ok", r


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    df, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = df
        df = stage(spark, df, SF_SMALL)
        if name != "best_fit_packing":
            assert df.columns == docs.columns
        df = corpus_pipeline.materialize(df, f"test-{name}")

    def of(name):
        return {r["doc_id"]: r["text"] for r in seen[name].collect()}

    before, after = of("toxicity"), of("line_dedup")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    assert set(after) == {d for d, t in before.items() if model.score(t) < toxicity.TOXIC_FROM}

    before, after = after, of("simhash_near_dedup")
    gone = collections.defaultdict(set)
    for d, i, *_ in brute_lines(before.items()):
        gone[d].add(i)
    want = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]) for d, t in before.items()}
    assert after == {d: t for d, t in want.items() if t.strip() or not gone[d]}

    before, after = after, of("benchmark_decontamination")
    ids = sorted(before)
    comp = brute_components([simhash.fingerprint(before[d]) for d in ids])
    assert set(after) == {ids[c] for c in comp}

    before, after = after, of("best_fit_packing")
    items = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    low = {d: b" ".join(decontamination.passage_words(t)) for d, t in before.items()}
    exact = {d for d, t in low.items()
             if any(b" ".join(decontamination.passage_words(x)) in t for x in items)}
    assert not exact & set(after) and len(set(before) - exact - set(after)) == 0
    assert {r["doc_id"] for r in df.collect()} == set(after)


#: Columns of ``documents`` and some whose names the operators use inside.
COLUMNS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, id string, th string, fp bigint, "
           "did string, line int, gone string, new string, t string, _n int, _id string, _th string, component string, "
           "length bigint, number bigint, bucket int, score double, _label int")
ITEM = "Which of the nine lanterns burns longest in the northern harbour? The seventh lantern burns until the morning."


def tables(spark, folder, docs, labels, items):
    for name, rows, schema in (("documents", docs, COLUMNS), ("labels", labels, "doc_id bigint, quality int, toxic int"),
                               ("benchmark", items, "item_id bigint, text string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def row(doc_id, text):
    return (doc_id, text, None, None, None, "x", "y", 7, "z", 3, *("g" * 3), 1, *("i" * 3), 5, 6, None, 0.5, None)


def words(k, n):
    """Text of its own for every ``k``."""
    return " ".join(f"w{k}x{i * 7919 % 1009}" for i in range(n))


@pytest.mark.parametrize("labels", [[], [(1, 1, None), (None, None, 1), (2, 1, 0)], [(2, 0, 1)]])
def test_stages_on_edge_rows(spark, tmp_path, labels):
    copy, leak = words(1, 60), words(2, 40) + " " + ITEM + " " + words(3, 40)
    docs = [(1, copy), (2, copy), (2, copy), (3, None), (4, ""), (None, words(4, 30)), (None, None), (5, leak),
            (6, long_text() + " " + words(5, 50)), (7, words(6, 25) + "\n" + words(7, 25)),
            (8, words(7, 25) + "\n" + words(8, 25))]
    sf = tables(spark, tmp_path / "edges", [row(*d) for d in docs], labels, [(1, ITEM), (2, None), (None, "")])
    df = spark.read.parquet(f"{sf}/documents.parquet")
    columns, left = df.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        df = corpus_pipeline.materialize(stage(spark, df, sf), f"test-{name}")
        rows = df.collect()
        if name != "best_fit_packing":
            assert df.columns == columns and all(r["th"] == "y" and r["fp"] == 7 for r in rows)
            left[name] = sorted(((r["doc_id"], r["text"]) for r in rows), key=str)
    texts = dict(docs)
    # labels of one class tell nothing apart: all documents stay
    assert left["toxicity"] == sorted(docs, key=str)
    # both rows of document 2 repeat document 1's only line; document 8 keeps its own line
    want = [(1, copy), (3, None), (4, ""), (None, texts[None]), (5, leak), (6, texts[6]), (7, texts[7]), (8, words(8, 25))]
    want = [x for x in want if x[0] is not None] + [(None, words(4, 30)), (None, None)]
    assert left["line_dedup"] == sorted(want, key=str)
    # the three texts without a word share the fingerprint zero; the smallest id stays
    want = [x for x in want if x not in ((4, ""), (None, None))]
    assert left["simhash_near_dedup"] == sorted(want, key=str)
    assert left["benchmark_decontamination"] == sorted((x for x in want if x[0] != 5), key=str)
    assert sorted({r["doc_id"] for r in rows}, key=str) == [1, 3, 6, 7, 8, None]


def test_run_on_empty_tables(spark, tmp_path):
    out = corpus_pipeline.run(spark, tables(spark, tmp_path / "empty", [], [], []))
    assert out.count() == 0 and {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns)
