"""Native file formats with tiny fixtures and their expected results."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.functions.expressions import tenths_celsius_to_fahrenheit_f32
from tessera.operators import aggregates as agg
from tessera.operators import graph as gr
from tessera.operators import relational as rel
from tessera.operators import similarity as sim
from tessera.operators import text
from tessera.sources import files

RATINGS = "".join(f"{u}\t{i}\t{r}\t881250949\n" for u, i, r in
                  [(1, 10, 3), (1, 20, 4), (2, 10, 5), (2, 20, 5), (3, 10, 0), (3, 30, 1)])

PEOPLE = "0,Will,33,385\n1,Jean-Luc,33,2\n2,Hugh,55,221\n3,Deanna,18,465\n4,Quark,19,21\n5,Weyoun,12,30\n"

GRAPH = "1 2 3 \n2 1 4\n3 1 4\n4 2 3 5\n5 4\n6 7\n1 6\n"
NAMES = ('1 "SPIDER/PETER"\n2 "TWO"\n3 "THREE"\n4 "FOUR"\n5 "FIVE/X"\n\nbad\n'
         '7000 "OUT"\n')


def kv(df, k, v):
    return {r[k]: r[v] for r in df.collect()}


# ---------------------------------------------------------------- ratings

def test_rating_histogram_and_popularity(spark, write_text):
    p = write_text("u.data", RATINGS)
    r = files.read_ratings_tsv(spark, p, rating_type="string")
    hist = agg.count_by_key(r, "rating").orderBy("rating")
    assert [(x["rating"], x["n"]) for x in hist.collect()] == \
        [("0", 1), ("1", 1), ("3", 1), ("4", 1), ("5", 2)]
    top = agg.top_by_count(r, "item_id", 100)
    assert [(x["item_id"], x["n"]) for x in top.collect()] == [(10, 3), (20, 2), (30, 1)]


@pytest.mark.parametrize("reader", ["tsv", "whitespace"])
def test_cosine_pairs(spark, write_text, reader):
    p = write_text("u.data", RATINGS)
    if reader == "tsv":
        r = files.read_ratings_tsv(spark, p, rating_type="double")
    else:
        r = files.read_ratings_whitespace(spark, p)
    got = {(x["i1"], x["i2"]): (x["score"], x["n"]) for x in sim.item_similarity(r).collect()}
    assert got[(10, 20)] == (0.9909924304103233, 2)
    assert got[(10, 30)] == (None, 1)
    assert set(got) == {(10, 20), (10, 30)}
    guarded = {(x["i1"], x["i2"]): x["score"]
               for x in sim.item_similarity(r, zero_denominator=0.0).collect()}
    assert guarded[(10, 30)] == 0.0


def test_similar_items_fixture(spark, write_text):
    p = write_text("u.data", RATINGS)
    r = files.read_ratings_tsv(spark, p, rating_type="double")
    top = sim.similar_items(r, 10, min_score=0.5, min_strength=1).collect()
    assert [(x["other"], x["score"], x["n"]) for x in top] == [(20, 0.9909924304103233, 2)]
    # strict thresholds: n must exceed min_strength
    assert sim.similar_items(r, 10, min_score=0.5, min_strength=2).count() == 0


def test_ratings_dcolon(spark, write_text):
    p = write_text("ratings.dat", "1::10::3::5\n2::10::4::6\n")
    r = files.read_ratings_dcolon(spark, p)
    assert sorted((x.user_id, x.item_id, x.rating) for x in r.collect()) == \
        [(1, 10, 3.0), (2, 10, 4.0)]


def test_failfast_and_permissive(spark, write_text):
    p = write_text("bad.data", "1\t10\tx\t1\n2\t20\t4\t1\n")
    with pytest.raises(Exception):
        files.read_ratings_tsv(spark, p, rating_type="int").collect()
    ok = files.read_ratings_tsv(spark, p, rating_type="int", mode=files.PERMISSIVE).collect()
    assert sorted((x.user_id, x.rating) for x in ok) == [(1, None), (2, 4)]


# ---------------------------------------------------------------- item titles

ITEMS = ("1::Toy Story (1995)::Anim|Child\n2::Café: Société (2016)::Drama\n\n3\n"
         ).encode("iso-8859-1")


def test_item_titles_encodings(spark, write_text):
    p = write_text("movies.dat", ITEMS)
    latin = kv(files.read_item_titles(spark, p, sep="::", encoding="ISO-8859-1"),
               "item_id", "title")
    assert latin == {1: "Toy Story (1995)", 2: "Café: Société (2016)"}
    utf8 = kv(files.read_item_titles(spark, p, sep="::"), "item_id", "title")
    assert utf8[2] == "Caf�: Soci�t� (2016)"
    assert 3 not in utf8


def test_item_titles_pipe_last_duplicate_wins(spark, write_text):
    p = write_text("u.item", "1|A|x|y\n2|B|z\n1|C|w\n")
    assert kv(files.read_item_titles(spark, p), "item_id", "title") == {1: "C", 2: "B"}


def test_popularity_named_strict(spark, write_text):
    p = write_text("u.data", RATINGS)
    titles = spark.createDataFrame([(10, "ten"), (20, "twenty")], "item_id int, title string")
    r = files.read_ratings_tsv(spark, p)
    named = agg.popularity_named(r, "item_id", titles, "item_id", "title")
    assert {(x.title, x.item_id, x.n) for x in named.collect()} == \
        {("ten", 10, 3), ("twenty", 20, 2), (None, 30, 1)}
    with pytest.raises(Exception):
        agg.require_titles(named, "title").collect()


# ---------------------------------------------------------------- people, orders, weather

def test_people(spark, write_text):
    p = write_text("fakefriends.csv", PEOPLE)
    people = files.read_people(spark, p)
    assert kv(agg.int_mean_by_key(people, "age", "num_friends", "a"), "age", "a") == \
        {12: 30, 18: 465, 19: 21, 33: 193, 55: 221}
    teens = rel.sql_range(spark, people, "age", 13, 19)
    assert sorted(x.id for x in teens.collect()) == [3, 4]
    young = rel.filter_less_than(people, "age", 21)
    assert sorted(x.id for x in young.collect()) == [3, 4, 5]
    plus = rel.plus_constant(people, "name", "age", 10)
    assert plus.columns == ["name", "(age + 10)"]
    assert rel.select_columns(people, "name").count() == 6
    assert kv(agg.count_by_key(people, "age"), "age", "n")[33] == 2


def test_customer_totals(spark, write_text):
    p = write_text("customer-orders.csv",
                   "44,8602,37.19\n35,5368,65.89\n44,3391,40.64\n2,1,10.00\n")
    o = files.read_customer_orders(spark, p)
    tot = agg.sum_by_key(o, "customer_id", "amount", "total").orderBy("total")
    assert [(x.customer_id, x.total) for x in tot.collect()] == \
        [("2", 10.0), ("35", 65.89), ("44", 77.83)]


def test_weather_minimum(spark, write_text):
    p = write_text("1800.csv",
                   "ITE1,18000101,TMAX,-75,,,E,\nITE1,18000101,TMIN,-148,,,E,\n"
                   "ITE1,18000102,TMIN,-125,,,E,\nGM01,18000101,TMIN,0,,,E,\n"
                   "GM01,18000101,PRCP,-999,,,E,\n")
    w = files.read_weather(spark, p)
    counts = agg.filter_counts(w, F.col("entry_type") == "TMIN").collect()[0]
    assert (counts.rows_in, counts.rows_out) == (5, 3)
    mins = agg.min_by_key(w.where(F.col("entry_type") == "TMIN"), "station",
                          tenths_celsius_to_fahrenheit_f32("value"), "m")
    got = kv(mins, "station", "m")
    assert got == {"ITE1": 5.3600006103515625, "GM01": 32.0}
    assert dict(mins.dtypes)["m"] == "float"


# ---------------------------------------------------------------- text

def test_word_count(spark, write_text):
    p = write_text("book.txt", "the cat the Cat,\nthe  dog42 naïve cat \n\nend\n")
    wc = kv(text.word_count(files.read_lines(spark, p)), "word", "n")
    assert wc == {"the": 3, "cat": 2, "end": 1}
    top = text.top_words(files.read_lines(spark, p), 2).collect()
    assert [(x.word, x.n) for x in top] == [("the", 3), ("cat", 2)]


def test_word_count_whole_documents(spark):
    docs = spark.createDataFrame([("a b\nb\n\nc c c\ndé x\n",)], "text string")
    assert kv(text.word_count(docs, "text"), "word", "n") == {"a": 1, "b": 2, "c": 3, "x": 1}


# ---------------------------------------------------------------- graph

@pytest.fixture()
def adjacency_graph(spark, write_text):
    g = gr.EdgeGraph(files.read_adjacency(spark, write_text("graph.txt", GRAPH)))
    names = files.read_names(spark, write_text("names.txt", NAMES))
    return g, names


def test_names_parsing(spark, write_text):
    p = write_text("names.txt", NAMES)
    cut = kv(files.read_names(spark, p), "id", "name")
    assert cut == {1: "SPIDER", 2: "TWO", 3: "THREE", 4: "FOUR", 5: "FIVE", 7000: "OUT"}
    uncut = kv(files.read_names(spark, p, cut_alias=False, max_id=6487), "id", "name")
    assert uncut == {1: "SPIDER/PETER", 2: "TWO", 3: "THREE", 4: "FOUR", 5: "FIVE/X"}


def test_connections_and_most_connected(spark, adjacency_graph):
    g, names = adjacency_graph
    assert kv(g.out_degree(), "id", "n") == {1: 3, 2: 2, 3: 2, 4: 3, 5: 1, 6: 1}
    best = gr.most_connected(g, names).collect()
    assert [(x.id, x.n, x.name) for x in best] == [(4, 3, "FOUR")]


def test_degrees(spark, adjacency_graph):
    g, names = adjacency_graph
    assert kv(g.degree(), "id", "deg") == {4: 6, 1: 5, 2: 4, 3: 4, 5: 2, 6: 2, 7: 1}
    top = gr.degree_top(g, names, k=10).collect()
    assert [(x.id, x.deg) for x in top] == [(4, 6), (1, 5), (2, 4), (3, 4), (5, 2)]


def test_hop_distance(spark, adjacency_graph):
    g, _ = adjacency_graph
    assert kv(gr.hop_distance(g, 1), "id", "dist") == \
        {1: 0, 2: 1, 3: 1, 6: 1, 4: 2, 7: 2, 5: 3}
    nodes = g.edges.select(F.col("src").alias("id")).union(g.edges.select(F.col("dst").alias("id")))
    from7 = kv(gr.hop_distance_all(g, 7, nodes), "id", "dist")
    assert from7[7] == 0.0
    assert all(math.isinf(v) for k, v in from7.items() if k != 7)


def test_bfs_hits(spark, adjacency_graph):
    g, _ = adjacency_graph
    one = lambda df: [(x.level, x.hits) for x in df.collect()]
    assert one(gr.bfs_hits(g, 1, 5)) == [(3, 1)]
    assert one(gr.bfs_hits(g, 1, 4)) == [(2, 2)]
    assert one(gr.bfs_hits(g, 5, 7)) == [(5, 1)]
    assert one(gr.bfs_hits(g, 1, 1)) == [(0, 0)]
    assert one(gr.bfs_hits(g, 7, 1)) == []          # 7 has no outgoing edge
    assert one(gr.bfs_hits(g, 1, 5, max_levels=2)) == []


# ---------------------------------------------------------------- regression, sink

def test_label_features_regression(spark, write_text):
    from tessera.operators import ml
    rows = "".join(f"{2.0 * x + 1.0},{x}\n" for x in range(-20, 21))
    df = files.read_label_features(spark, write_text("regression.txt", rows))
    data = ml.assemble(df, "label", ["x"])
    model = ml.fit_linear(data, reg_param=0.0, elastic_net=0.0)
    assert abs(model.coefficients[0] - 2.0) < 1e-6 and abs(model.intercept - 1.0) < 1e-6
    r = ml.rmse(model, data).collect()[0]
    assert r.n == 41 and r.rmse < 1e-6


def test_write_pairs_sorted(spark, write_text, tmp_path):
    p = write_text("u.data", RATINGS)
    pairs = sim.item_similarity(files.read_ratings_tsv(spark, p, rating_type="double"))
    out = str(tmp_path / "pairs")
    files.write_pairs(pairs, out, fmt="csv")
    back = spark.read.option("header", "true").csv(out).collect()
    keys = [(int(x.i1), int(x.i2)) for x in back]
    assert keys == sorted(keys) and len(keys) == 2


def test_named_vertices_and_distance_to(spark, adjacency_graph, write_text):
    g, _ = adjacency_graph
    names = files.read_names(spark, write_text("names2.txt", NAMES), cut_alias=False, max_id=6487)
    got = kv(gr.named_vertices(g, names), "id", "name")
    assert got == {1: "SPIDER/PETER", 2: "TWO", 3: "THREE", 4: "FOUR", 5: "FIVE/X",
                   6: "Nobody", 7: "Nobody"}
    assert [(r.id, r.dist) for r in gr.distance_to(g, 1, 5).collect()] == [(5, 3)]
    assert gr.distance_to(g, 7, 5).count() == 0
    named = gr.hop_distance(g, 1, names=names)
    assert sorted(r.id for r in named.collect()) == [1, 2, 3, 4, 5]   # 6, 7 have no name


def test_read_lines_repairs_utf8(spark, write_text):
    p = write_text("latin.txt", "caf\xe9 ok\n".encode("iso-8859-1"))
    fixed = files.read_lines(spark, p, repair_utf8=True).collect()[0].value
    assert fixed == "caf� ok"
    words = kv(text.word_count(files.read_lines(spark, p, repair_utf8=True)), "word", "n")
    assert words == {"ok": 1}


def test_item_titles_trailing_separator(spark, write_text):
    p = write_text("u2.item", "1|A|x\n3|\n4||x\n5::\n")
    got = kv(files.read_item_titles(spark, p), "item_id", "title")
    assert got == {1: "A", 4: ""}          # "3|" has no title field; "5::" is no id


def test_positional_fields_ignore_extras(spark, write_text):
    p = write_text("p.csv", "0,Will,33,385,extra,more\n1,Jean,33,2\n")
    assert [tuple(r) for r in files.read_people(spark, p).orderBy("id").collect()] == \
        [(0, "Will", 33, 385), (1, "Jean", 33, 2)]
    short = write_text("short.csv", "0,Will,33\n")
    with pytest.raises(Exception):
        files.read_people(spark, short).collect()
    assert [tuple(r) for r in files.read_people(spark, short, mode=files.PERMISSIVE).collect()] == \
        [(0, "Will", 33, None)]


def test_permissive_whitespace_keeps_short_lines_and_skips_blank_ones(spark, write_text):
    path = write_text("u.data", "1 2 3.5\n2 20\n\t\t\n\nx y z\n")
    got = [tuple(r) for r in files.read_ratings_whitespace(spark, path, mode=files.PERMISSIVE).collect()]
    assert sorted(got, key=str) == sorted([(1, 2, 3.5), (2, 20, None), (None, None, None)], key=str)
    assert files.read_adjacency_nodes(spark, write_text("g.txt", "1 2 3\n\t\t\n")).collect()[0]["connections"] == 2


def test_last_title_wins_by_path_then_place(spark, tmp_path):
    d = tmp_path / "titles"
    d.mkdir()
    (d / "a.txt").write_text("1|first\n1|second\n")
    (d / "b.txt").write_text("1|third\n2|x\n" + "".join(f"{i}|filler {i}\n" for i in range(10, 3000)))
    got = {r["item_id"]: r["title"] for r in files.read_item_titles(spark, str(d)).where("item_id < 3").collect()}
    assert got == {1: "third", 2: "x"}
