"""The README recipes, run as written on the tiny fixture files."""

from pyspark.sql import functions as F

from tessera.functions import tenths_celsius_to_fahrenheit_f32
from tessera.operators import aggregates as agg
from tessera.operators import graph as gr
from tessera.operators import ml
from tessera.operators import relational as rel
from tessera.operators import similarity as sim
from tessera.operators import text
from tessera.sources import files as src
from tests.test_fixtures import GRAPH, NAMES, PEOPLE, RATINGS


def test_readme_recipes(spark, write_text, tmp_path):
    u_data = write_text("u.data", RATINGS)
    r = src.read_ratings_tsv(spark, u_data, rating_type="string")
    assert agg.count_by_key(r, "rating").orderBy("rating").count() == 5
    assert agg.top_by_count(r, "item_id", 100).count() == 3
    titles = src.read_item_titles(spark, write_text("u.item", "10|Ten|x\n20|Twenty|y\n"),
                                  sep="|", encoding="ISO-8859-1")
    named = agg.popularity_named(r, "item_id", titles, "item_id", "title")
    assert named.where(F.col("title").isNull()).count() == 1

    people = src.read_people(spark, write_text("fakefriends.csv", PEOPLE))
    assert agg.int_mean_by_key(people, "age", "num_friends").count() == 5
    assert rel.sql_range(spark, people, "age", 13, 19).count() == 2
    assert rel.select_columns(people, "name").count() == 6
    assert rel.filter_less_than(people, "age", 21).count() == 3
    assert agg.count_by_key(people, "age").count() == 5
    assert rel.plus_constant(people, "name", "age", 10).count() == 6

    orders = src.read_customer_orders(spark, write_text("o.csv", "1,2,3.5\n1,3,1.5\n"))
    assert agg.sum_by_key(orders, "customer_id", "amount").orderBy("total").collect()[0].total == 5.0

    w = src.read_weather(spark, write_text("w.csv", "A,1,TMIN,-10,,,E,\nA,1,TMAX,5,,,E,\n"))
    assert agg.filter_counts(w, F.col("entry_type") == "TMIN").collect()[0].rows_out == 1
    m = agg.min_by_key(w.where(F.col("entry_type") == "TMIN"), "station",
                       tenths_celsius_to_fahrenheit_f32("value")).collect()[0]
    assert abs(m.m - 30.2) < 1e-4

    assert text.top_words(src.read_lines(spark, write_text("b.txt", "a b a\n")), 100).count() == 2

    g = gr.EdgeGraph(src.read_adjacency(spark, write_text("graph.txt", GRAPH)))
    names = src.read_names(spark, write_text("names.txt", NAMES))
    assert gr.most_connected(g, names).collect()[0].name == "FOUR"
    assert [tuple(x) for x in gr.bfs_hits(g, 1, 5).collect()] == [(3, 1)]
    long_names = src.read_names(spark, write_text("names2.txt", NAMES), cut_alias=False, max_id=6487)
    assert gr.degree_top(g, long_names, k=10).count() == 5
    assert gr.hop_distance(g, 1, names=long_names).count() == 5
    assert gr.named_vertices(g, long_names).count() == 7

    ratings = src.read_ratings_whitespace(spark, u_data)
    pairs = sim.item_similarity(ratings)
    src.write_pairs(pairs, str(tmp_path / "pairs"), fmt="csv")
    assert sim.similar_items(ratings, 10, min_score=0.5, min_strength=1, k=10).count() == 1

    rows = "".join(f"{3.0 * x - 2.0},{x}\n" for x in range(50))
    data = ml.assemble(src.read_label_features(spark, write_text("reg.txt", rows)), "label", ["x"])
    train, test = ml.split(data)
    model = ml.fit_linear(train)
    assert ml.rmse(model, test).collect()[0].n == test.count()

    fit = ml.fit_als(src.read_ratings_tsv(spark, u_data, "float"), "user_id", "item_id", "rating")
    recs = ml.recommend(fit, src.id_table(spark, [1], name="user", dtype="long"), 15).collect()
    assert 0 < len(recs) <= 3
