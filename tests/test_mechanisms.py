"""Graph storage and searches, similarity by prefixes, exact sums, content-keyed
splits, model checks, byte lines and the zone map: against brute force and plans."""

import math
import random
from collections import Counter, defaultdict, deque

import pytest
from pyspark.sql import functions as F

from tessera.operators import aggregates as agg
from tessera.operators import graph as gr
from tessera.operators import ml
from tessera.operators import similarity as sim
from tessera.plans import catalogue as cat
from tessera.session import scratch_scope
from tessera.sources import files
from tessera.sources.tables import Tables
from tests.conftest import SF_SMALL
from tests.test_properties import brute_pairs


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------- graphs

def brute_distances(edges, start):
    out = defaultdict(list)
    for a, b in edges:
        out[a].append(b)
    dist, queue = {start: 0}, deque([start])
    while queue:
        a = queue.popleft()
        for b in out[a]:
            if b not in dist:
                dist[b] = dist[a] + 1
                queue.append(b)
    return dist


def brute_hits(edges, start, target):
    if start == target:
        return [(0, 0)]
    dist = brute_distances(edges, start)
    if target not in dist:
        return []
    return [(dist[target], sum(b == target and dist.get(a) == dist[target] - 1 for a, b in edges))]


def random_edges(seed, nodes, n, scale=1, shift=0):
    rng = random.Random(seed)
    return [(rng.randrange(nodes) * scale + shift, rng.randrange(nodes) * scale + shift) for _ in range(n)]


def test_a_lookup_shuffles_only_what_is_looked_up(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        g = gr.EdgeGraph(spark.createDataFrame(random_edges(1, 50, 400), "src long, dst long"))
        found = g.keyed("src").of(spark.range(5).select(F.col("id").alias("src")))
        plan = plan_of(found)
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        # the one exchange stands above the range, not above the stored rows
        scan = next(k for k, line in enumerate(plan.splitlines()) if "Bucketed: true" in line)
        exchange = next(k for k, line in enumerate(plan.splitlines()) if "Exchange hashpartitioning" in line)
        assert scan < exchange and found.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_keys_lie_in_several_buckets(spark):
    edges = [(7, i) for i in range(300)] + [(i, 7) for i in range(300)] + random_edges(2, 300, 200)
    rows = spark.createDataFrame(edges, "src long, dst long").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("c"))
    stored = gr.KeyedRows(rows, "src", "hot-test", rows_per_bucket=20)
    assert stored.hot is not None and stored.rows.where("src = 7").select("part").distinct().count() > 5
    found = stored.of(spark.createDataFrame([(7,), (8,), (9999,)], "src long"))
    assert Counter((r.src, r.dst, r.c) for r in found.collect()) == Counter(
        (a, b, c) for (a, b), c in Counter(edges).items() if a in (7, 8))


@pytest.mark.parametrize("scale, shift", [(1, 0), (1, -40), (3 * 10**13, -10**15)])
def test_searches_equal_brute_force(spark, scale, shift):
    """Dense, negative and sparse ids (these are numbered)."""
    edges = random_edges(3, 80, 130, scale, shift)
    g = gr.EdgeGraph(spark.createDataFrame(edges + [(None, 1), (shift, None)], "src long, dst long"))
    start = edges[0][0]
    dist = brute_distances(edges, start)
    assert {r.id: r.dist for r in gr.hop_distance(g, start).collect()} == dist
    assert (g.numbers is not None) == (scale > 1)
    far = max(dist, key=lambda x: (dist[x], x))
    unreached = next(b for e in edges for b in e if b not in dist)
    for target in (far, start, unreached, edges[0][1], 12345):
        assert [tuple(r) for r in gr.bfs_hits(g, start, target).collect()] == brute_hits(edges, start, target)
    assert gr.bfs_hits(g, start, far, max_levels=dist[far] - 1).count() == 0
    assert [tuple(r) for r in gr.hop_distance(g, 12345).collect()] == [(12345, 0)]


def test_search_from_both_ends_reads_fewer_rows(spark, monkeypatch):
    """A tree of out-degree 6 ends in one node: the far end is narrow."""
    edges, layer, node = [], [0], 1
    for _ in range(4):
        nxt = []
        for a in layer:
            for _ in range(6):
                edges.append((a, node))
                nxt.append(node)
                node += 1
        layer = nxt
    edges += [(layer[0], 10_000), (layer[0], 10_000), (10_000, 10_001)]
    g = gr.EdgeGraph(spark.createDataFrame(edges, "src long, dst long"))
    sizes = []
    step = gr.Search.step
    monkeypatch.setattr(gr.Search, "step", lambda self: sizes.append(step(self)) or sizes[-1])
    assert [tuple(r) for r in gr.bfs_hits(g, 0, 10_001).collect()] == brute_hits(edges, 0, 10_001) == [(6, 1)]
    assert sum(sizes) < 20 < len(layer)
    assert [tuple(r) for r in gr.bfs_hits(g, 0, 10_000).collect()] == [(5, 2)]


def test_bitmaps_of_any_ids(spark):
    ids = [0, 1, 7, 8, 32767, 32768, 32769, -1, -32768, -40000, 2**40, 2**40 + 3, 2**62]
    rows = spark.createDataFrame([(i,) for i in ids], "id long")
    bits = gr.id_bitmaps(rows)
    others = spark.createDataFrame([(i + d,) for i in ids for d in (-1, 0, 1)], "id long").distinct()
    left = {r.id for r in gr.not_in_bitmaps(others, bits).collect()}
    assert left == {i + d for i in ids for d in (-1, 0, 1)} - set(ids)


def test_levels_of_a_chain_cost_alike(spark):
    """Beyond ``FOLD`` levels; a level tests its rows against one table of bitmaps and
    at most ``FOLD`` levels, however many there were."""
    edges = [(i, i + 1) for i in range(19)]
    search = gr.Search(gr.EdgeGraph(spark.createDataFrame(edges, "src long, dst long")), 0)
    read = []
    while search.step():
        read.append(search.level - search.since + (search.visited is not None))
    assert search.level == 20 and max(read) <= gr.Search.FOLD + 1
    assert sorted(tuple(r) for r in search.distances().collect()) == [(i, i) for i in range(20)]


def test_scope_drops_bucketed_tables(spark):
    def tables():
        return {t.name for t in spark.catalog.listTables() if t.name.startswith("tessera_by_src")}

    before = tables()
    with scratch_scope(spark):
        gr.hop_distance(gr.EdgeGraph(spark.createDataFrame([(1, 2)], "src long, dst long")), 1).collect()
        assert len(tables() - before) == 1
    assert tables() == before


# --------------------------------------------------------------- similarity

@pytest.mark.parametrize("block", [3, 1024])
def test_prefixes_find_every_pair_above_the_strength(spark, block):
    rng = random.Random(block)
    rows = [(rng.randrange(150), int(rng.paretovariate(0.6)) % 60, float(rng.randrange(6))) for _ in range(900)]
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating double")
    brute = brute_pairs(rows)
    ui = sim.user_item_stats(df)
    fewer = []
    for strength in (0, 5, 20, 60):
        want = {p: (s, n) for p, (s, n) in brute.items() if n > strength and s is not None and s > 0.5}
        got = sim.similar_pairs(df, 0.5, strength, block_items=block, prefixes=True).collect()
        assert {(r.i1, r.i2) for r in got} == set(want)
        assert all(abs(r.score - want[r.i1, r.i2][0]) < 1e-12 and r.n == want[r.i1, r.i2][1] for r in got)
        found = {tuple(r) for r in sim.candidate_pairs(ui, strength, block).collect()}
        assert {p for p, (_, n) in brute.items() if n > strength} <= found <= set(brute)
        fewer.append(len(found))
    assert fewer == sorted(fewer, reverse=True) and fewer[-1] < len(brute) / 2


def test_best_of_each_item_is_limited_before_the_shuffle(spark):
    pairs = sim.item_similarity(cat.ratings(Tables(spark, SF_SMALL)))
    best = sim.similar_items_each(pairs, 3)
    assert "WindowGroupLimit" in plan_of(best)
    got = defaultdict(list)
    for r in best.orderBy("item", "rank").collect():
        got[r.item].append((r.other, r.score, r.n))
    for item in sorted(got)[:5]:
        want = sim.similar_items_from_pairs(pairs, item, -1.0, 0, 3).collect()
        assert got[item] == [(r.other, r.score, r.n) for r in want]


# --------------------------------------------------------------- exact sums

def test_sums_of_doubles_are_exact_in_any_order(spark):
    rng = random.Random(4)
    groups = {
        "any": [rng.uniform(-1, 1) * 2.0 ** rng.randint(-60, 60) for _ in range(400)],
        "cancel": [x for _ in range(100) for v in [rng.uniform(1, 9) * 10 ** rng.randint(-9, 9)] for x in (v, -v)] + [0.1],
        "cents": [rng.randrange(10**7) / 100 for _ in range(500)],
        "tiny": [5e-324, 5e-324, -1e-310, 2.0**-1022], "huge": [1.7e308, -1.6e308, 1e300],
        "powers": [2.0**k for k in range(-64, 65)] + [-2.0**64 + 1], "zero": [0.0, -0.0], "one": [0.1],
        "inf": [math.inf, 1.0], "nan": [math.inf, -math.inf], "nan2": [math.nan, 1.0], "null": [None], "some": [None, 2.5]}
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double")
    for parts in (1, 7):
        got = {r.k: r.total for r in agg.sum_by_key(df.repartition(parts), "k", "v").collect()}
        for k, vs in groups.items():
            vs = [v for v in vs if v is not None]
            if k in ("nan", "nan2"):
                assert math.isnan(got[k])
            else:
                assert got[k] == (math.fsum(vs) if vs else None), k


# ---------------------------------------------------------- splits and models

def test_content_split_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(i % 400, "x" if i % 3 else None) for i in range(2000)] + [(5000, "same")] * 700,
                               "a int, b string")
    sides = [[Counter(tuple(r) for r in side.collect()) for side in ml.content_split(d)]
             for d in (df, df.repartition(5), df.orderBy("a").coalesce(1))]
    assert sides[0] == sides[1] == sides[2]
    assert sides[0][0] + sides[0][1] == Counter(tuple(r) for r in df.collect())
    assert abs(sum(sides[0][0].values()) / 2700 - 0.7) < 0.04
    assert 0.6 < sides[0][0][5000, "same"] / 700 < 0.8       # copies are split too
    other = ml.content_split(df, (0.5, 0.5), seed=7)[0].count()
    assert abs(other / 2700 - 0.5) < 0.04


class Tampered:
    def __init__(self, coefficients):
        self.coefficients = coefficients


def test_stationarity_check_tells_solutions_from_others(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(300):
        a, b = rng.gauss(0, 1), rng.gauss(0, 3)
        rows.append((3 * a - b + rng.gauss(0, 0.5), a, b, a + rng.gauss(0, 0.1), rng.gauss(0, 1)))
    df = ml.assemble(spark.createDataFrame(rows, "y double, a double, b double, c double, d double"), "y", list("abcd"))
    model = ml.fit_linear(df, max_iter=1000, tol=1e-9)
    found = ml.kkt_residuals(model, df).collect()
    assert all(r.residual < 1e-4 for r in found) and any(r.coef == 0 for r in found)
    for k in range(4):
        moved = list(model.coefficients)
        moved[k] += 0.2
        assert max(r.residual for r in ml.kkt_residuals(Tampered(moved), df).collect()) > 1e-2
    n, m = ml.gram(df)
    assert n == 300 and abs(m[0][2] - sum(r[2] for r in rows) / 300) < 1e-9


def test_normal_equations_tell_solved_users_from_others(spark):
    r = cat.ratings(Tables(spark, SF_SMALL))
    fit = ml.fit_als(r, "user_id", "item_id", "rating")
    found = [x.residual for x in ml.normal_residuals(fit).collect()]
    assert len(found) == r.select("user_id").distinct().count() and max(found) < 1e-3
    # with another penalty they are no solution
    assert max(x.residual for x in ml.normal_residuals(fit, 1.0).collect()) > 1e-2


# ----------------------------------------------------------- lines and sink

def test_byte_lines_keep_every_byte(spark, write_text):
    path = write_text("items", b"1|caf\xe9\n2|caf\xc3\xa9\n\n3|\xe2\x82 x \xff\xfe\n")
    lines = files.read_byte_lines(spark, path)
    assert [bytes(r.line) for r in lines.collect()] == [b"1|caf\xe9", b"2|caf\xc3\xa9", b"", b"3|\xe2\x82 x \xff\xfe"]
    utf8 = {r.item_id: r.title for r in files.read_item_titles(spark, files.decode_lines(lines)).collect()}
    assert utf8 == {1: "caf�", 2: "café", 3: "� x ��"}
    latin = {r.item_id: r.title for r in files.read_item_titles(spark, files.decode_lines(lines, "ISO-8859-1")).collect()}
    assert latin == {1: "café", 2: "cafÃ©", 3: "â\x82 x ÿþ"}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_zone_map_prunes_files(spark, tmp_path, fmt):
    pairs = spark.createDataFrame([(i % 40, i, i / 2, 1) for i in range(40, 2000)], "i1 long, i2 long, score double, n long")
    path = str(tmp_path / "pairs")
    files.write_pairs(pairs, path, fmt=fmt, ranges=6)
    zones = files.pair_zones(spark, path).orderBy("first").collect()
    assert len(zones) == 6 and sum(z.rows for z in zones) == 1960
    assert all(tuple(a.last) < tuple(b.first) for a, b in zip(zones, zones[1:]))
    if fmt == "parquet":
        for item in (0, 17, 39, 99):
            got = files.read_pairs_of(spark, path, item)
            assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in pairs.where(F.col("i1") == item).collect())
            assert len(got.inputFiles()) <= 2 or item == 99
        one = files.read_pairs_of(spark, path, 17, 57)
        assert [tuple(r) for r in one.collect()] == [(17, 57, 28.5, 1)] and len(one.inputFiles()) == 1
