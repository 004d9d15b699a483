"""Properties and brute-force cross-checks on small inputs."""

import itertools
import math
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import graph as gr
from tessera.operators import similarity as sim
from tessera.operators import text
from tessera.plans import catalogue as cat
from tessera.session import materialize
from tessera.sources.tables import Tables
from tests.conftest import SF_SMALL


def brute_pairs(rows):
    """Every combination of two ratings of one user, i1 < i2."""
    by_user = defaultdict(list)
    for u, i, r in rows:
        by_user[u].append((i, r))
    acc = defaultdict(lambda: [0.0, 0.0, 0.0, 0])
    for rs in by_user.values():
        for (i1, r1), (i2, r2) in itertools.product(rs, rs):
            if i1 < i2:
                a = acc[(i1, i2)]
                a[0] += r1 * r1
                a[1] += r2 * r2
                a[2] += r1 * r2
                a[3] += 1
    out = {}
    for k, (xx, yy, xy, n) in acc.items():
        den = math.sqrt(xx) * math.sqrt(yy)
        out[k] = (None if den == 0 else xy / den, n)
    return out


ratings_strategy = st.lists(
    st.tuples(st.integers(1, 4), st.integers(1, 9), st.integers(0, 5)),
    min_size=1, max_size=40)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ratings_strategy, block=st.sampled_from([1, 2, 3, 1024]))
def test_similarity_matches_brute_force(spark, rows, block):
    df = spark.createDataFrame([(u, i, float(r)) for u, i, r in rows],
                               "user_id int, item_id int, rating double")
    got = {(r.i1, r.i2): (r.score, r.n)
           for r in sim.item_similarity(df, block_items=block).collect()}
    want = brute_pairs(rows)
    assert set(got) == set(want)
    for k, (score, n) in want.items():
        assert got[k][1] == n
        if score is None:
            assert got[k][0] is None
        else:
            assert abs(got[k][0] - score) < 1e-12
            assert -1e-12 <= got[k][0] <= 1 + 1e-12


def test_salted_pairs_equal_unsalted_on_table(spark):
    r = cat.ratings(Tables(spark, SF_SMALL))
    a = sim.pair_sums(r, block_items=1024)
    b = sim.pair_sums(r, block_items=4)   # every user spread over many keys
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_similar_items_equals_pair_table(spark):
    r = cat.ratings(Tables(spark, SF_SMALL))
    direct = sim.similar_items(r, 1, min_score=0.0, min_strength=0, k=1000)
    from_pairs = sim.similar_items_from_pairs(sim.item_similarity(r), 1, 0.0, 0, 1000)
    assert sorted(direct.collect()) == sorted(from_pairs.collect())
    raters = sim.item_raters(r, 1)
    fewer = cat.ratings(Tables(spark, SF_SMALL), raters.select("u"))
    again = sim.similar_items(fewer, 1, min_score=0.0, min_strength=0, k=1000, raters=raters)
    assert sorted(again.collect()) == sorted(direct.collect())


@pytest.mark.parametrize("bound", [0, 2, 5, 1000])
def test_strength_prune_loses_no_pair(spark, bound):
    rows = [(u, i, float(1 + (u * i) % 5)) for u in range(30) for i in range(u % 9)]
    rows += [(3, 50, 2.0)] * 4 + [(3, 51, 1.0)] * 3 + [(7, 60, 5.0)]  # copies count; 60 has one weak pair each
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating double")
    got = sim.similar_pairs(df, min_score=0.1, min_strength=bound)
    want = sim.item_similarity(df).where((F.col("score") > 0.1) & (F.col("n") > bound))
    assert sorted(got.collect()) == sorted(want.collect())
    assert bool(got.count()) == (bound < 1000)


def _clique_edges(spark):
    t = Tables(spark, SF_SMALL)
    e = (t.lineitem.select(F.col("l_orderkey").alias("o"), F.col("l_partkey").alias("p")))
    a, b = e.alias("a"), e.alias("b")
    return a.join(b, (F.col("a.o") == F.col("b.o")) & (F.col("a.p") != F.col("b.p"))) \
        .select(F.col("a.p").alias("src"), F.col("b.p").alias("dst"))


def test_co_member_graph_equals_explicit_edges(spark):
    t = Tables(spark, SF_SMALL)
    implicit = cat.co_purchase_graph(t)
    explicit = gr.EdgeGraph(_clique_edges(spark))
    assert sorted(implicit.out_degree().collect()) == sorted(explicit.out_degree().collect())
    assert sorted(implicit.degree().collect()) == sorted(explicit.degree().collect())
    d1 = sorted(gr.hop_distance(implicit, 1).collect())
    d2 = sorted(gr.hop_distance(explicit, 1).collect())
    assert d1 == d2
    for target in (3, 7, 11):
        assert gr.bfs_hits(implicit, 1, target).collect() == gr.bfs_hits(explicit, 1, target).collect()


def test_degree_sum_is_twice_edges(spark):
    g = gr.EdgeGraph(_clique_edges(spark))
    total = g.degree().agg(F.sum("deg")).collect()[0][0]
    assert total == 2 * g.edges.count()


def test_bfs_levels_respect_edges(spark):
    g = cat.co_purchase_graph(Tables(spark, SF_SMALL))
    dist = {r.id: r.dist for r in gr.hop_distance(g, 1).collect()}
    for r in _clique_edges(spark).collect():
        if r.src in dist:
            assert r.dst in dist and dist[r.dst] <= dist[r.src] + 1


def test_word_count_totals_and_repartition(spark):
    docs = Tables(spark, SF_SMALL).documents.select("text")
    wc = text.word_count(docs, "text")
    total = wc.agg(F.sum("n")).collect()[0][0]
    assert total == text.words(docs, "text").count()
    again = text.word_count(docs.repartition(7), "text")
    assert wc.exceptAll(again).count() == 0 and again.count() == wc.count()
    sample = Counter()
    for row in docs.limit(5).collect():
        for line in row.text.split("\n"):
            for w in line.split(" "):
                if w.isascii() and w.isalpha():
                    sample[w] += 1
    got = {r.word: r.n for r in text.word_count(docs.limit(5), "text").collect()}
    assert got == dict(sample)


def test_dense_index_is_a_bijection(spark):
    from tessera.operators import ml
    ids = spark.range(0, 5000, 7, numPartitions=6).select(
        (F.col("id") * 1_000_003 + 3_000_000_000).alias("k"))
    m = ml.dense_index(ids.union(ids), "k", "ix")
    rows = m.collect()
    assert sorted(r.ix for r in rows) == list(range(ids.count()))
    assert len({r.k for r in rows}) == len(rows)


def test_als_with_large_ids_maps_back(spark):
    from tessera.operators import ml
    big = 5_000_000_000
    base = cat.ratings(Tables(spark, SF_SMALL))
    shifted = base.select((F.col("user_id") + big).alias("user_id"),
                          (F.col("item_id") + big).alias("item_id"), "rating")
    fit = ml.fit_als(shifted, "user_id", "item_id", "rating")
    assert fit.user_map is not None
    users = spark.createDataFrame([(big + 1,)], "user long")
    recs = ml.recommend(fit, users, 5).collect()
    assert 0 < len(recs) <= 5
    assert all(r.user == big + 1 and r.item >= big for r in recs)
    assert [r.rank for r in recs] == sorted(r.rank for r in recs)


def test_hot_user_third_of_rows_salted(spark):
    """One user holds a third of the ratings; the salted join (S = 8 buckets
    for that user, 64 join keys) must give the brute-force sums."""
    hot = [(0, i, float(i % 5 + 1)) for i in range(60)]
    rest = [(u, (u * 7) % 60, float(u % 4 + 1)) for u in range(1, 61)]
    rest += [(u, (u * 11 + 3) % 60, float(u % 3 + 1)) for u in range(1, 61)]
    rows = hot + rest
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating double")
    got = {(r.i1, r.i2): (r.score, r.n) for r in sim.item_similarity(df, block_items=8).collect()}
    want = brute_pairs(rows)
    assert set(got) == set(want)
    for k, (score, n) in want.items():
        assert got[k][1] == n and abs(got[k][0] - score) < 1e-12


def test_hot_group_third_of_rows_implicit_graph(spark):
    """One order holds a third of the membership rows (with repeated parts);
    degrees and searches equal those of the explicit clique edges."""
    rows = [(0, p % 40) for p in range(60)]                      # hot order, copies included
    rows += [(o, (o * 13 + j) % 97) for o in range(1, 41) for j in range(3)]
    rows += [(o, 40 + o % 50) for o in range(41, 61)]
    df = spark.createDataFrame(rows, "group long, member long")
    implicit = gr.CoMemberGraph(df)
    a, b = df.alias("a"), df.alias("b")
    explicit = gr.EdgeGraph(a.join(b, (F.col("a.group") == F.col("b.group"))
                                   & (F.col("a.member") != F.col("b.member")))
                            .select(F.col("a.member").alias("src"), F.col("b.member").alias("dst")))
    assert sorted(implicit.degree().collect()) == sorted(explicit.degree().collect())
    dist = sorted(gr.hop_distance(implicit, 14).collect())
    assert len(dist) == 44 and dist == sorted(gr.hop_distance(explicit, 14).collect())
    found = {}
    for target in (0, 39, 42, 88):
        got = gr.bfs_hits(implicit, 14, target).collect()
        assert got == gr.bfs_hits(explicit, 14, target).collect()
        found[target] = [tuple(r) for r in got]
    assert found[0] == [(1, 4)] and found[88] == []   # copies multiply edges


def test_a_long_chain_is_reached_in_full(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 16)] + [(50, 51)], "src long, dst long")
    g = gr.EdgeGraph(edges)
    want = [(i, i - 1) for i in range(1, 17)]
    assert sorted(tuple(r) for r in gr.hop_distance(g, 1).collect()) == want
    assert [tuple(r) for r in gr.bfs_hits(g, 1, 16).collect()] == [(15, 1)]
    assert len(gr.hop_distance(g, 1, max_levels=4).collect()) == 5
    nodes = spark.createDataFrame([(16,), (51,)], "id long")
    assert sorted(tuple(r) for r in gr.hop_distance_all(g, 1, nodes).collect()) == [(16, 15.0), (51, math.inf)]
    pairs = spark.createDataFrame([(i, n) for i in range(15) for n in (i, i + 1)], "group long, member long")
    assert len(gr.hop_distance(gr.CoMemberGraph(pairs), 0).collect()) == 16


def test_hot_keys_are_split_in_the_final_plan(spark):
    """Three quarters of the rows on one group or user: AQE splits them."""
    rows = spark.range(60_000)
    hot = F.when(F.col("id") % 4 != 0, 0).otherwise(F.col("id"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "1k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        g = gr.CoMemberGraph(rows.select(hot.alias("group"), F.xxhash64("id").alias("member")).repartition(8))
        # a large membership table is read by many tasks; AQE splits a key by the tasks that wrote its rows
        g._stored = materialize(g.counted().repartition(8), "membership")
        users = rows.select(hot.alias("user_id"), (F.col("id") % 5000).alias("item_id"), F.lit(2.0).alias("rating")) \
            .repartition(8)
        for df in (g.out_degree(), sim.similar_items(users, 1, min_score=0.0, min_strength=0)):
            df.collect()
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_report_orders(spark):
    named = [r.n for r in cat.QUERIES["item_popularity_named"](spark, SF_SMALL).collect()]
    assert named == sorted(named, reverse=True)
    low = [r.m for r in cat.QUERIES["min_reading_by_key"](spark, SF_SMALL).collect()]
    assert low == sorted(low)
