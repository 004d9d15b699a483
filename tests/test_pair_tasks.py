"""Pairs of items made and summed where they arrive: rows, plans and candidates."""

import random

import pytest

from tessera.operators import similarity as sim
from tests.test_mechanisms import plan_of
from tests.test_properties import brute_pairs


def odd_rows(item):
    """A hot user, a hot item, copies, ratings that are no small whole numbers, nulls."""
    rng = random.Random(7)
    rows = [(rng.randrange(40), item(rng.randrange(50)), float(rng.randrange(6))) for _ in range(500)]
    rows += [(99, item(k), 1.0 + k % 3) for k in range(50)]
    rows += [(u, item(0), 0.25 * u) for u in range(40)] + [(u, item(1), 1e6) for u in range(0, 40, 2)]
    return rows, [(None, item(3), 1.0), (5, None, 2.0), (41, item(7), None), (41, item(8), 3.0)]


@pytest.mark.parametrize("block,per_task", [(1024, 2_000_000), (4, 2_000_000), (1024, 30), (4, 30)])
@pytest.mark.parametrize("kind,item", [("bigint", lambda k: (k - 20) * 70_001 * 70_001), ("int", lambda k: k * 40_000 - 90_000),
                                       ("string", str)])
def test_pair_sums_of_hot_users_and_items(spark, block, per_task, kind, item):
    rows, nulls = odd_rows(item)
    df = spark.createDataFrame(rows + nulls, f"user_id int, item_id {kind}, rating double")
    got = {(r.i1, r.i2): r for r in sim.pair_sums(df, block_items=block, pairs_per_task=per_task).collect()}
    want = {}
    by_user = {}
    for u, i, r in rows:
        by_user.setdefault(u, []).append((i, r))
    for seen in by_user.values():
        for a, ra in seen:
            for b, rb in seen:
                if a < b:
                    s = want.setdefault((a, b), [0.0, 0.0, 0.0, 0])
                    for k, v in enumerate((ra * ra, rb * rb, ra * rb, 1)):
                        s[k] += v
    nothing = (min(item(7), item(8)), max(item(7), item(8)))
    want.setdefault(nothing, [0.0, 0.0, 0.0, 0])[3] += 1
    want[nothing][0 if item(8) < item(7) else 1] += 9.0
    assert set(got) == set(want)
    for p, (xx, yy, xy, n) in want.items():
        assert got[p].n == n
        assert all(abs((a or 0.0) - b) <= 1e-9 * max(1.0, abs(b))
                   for a, b in ((got[p].xx, xx), (got[p].yy, yy), (got[p].xy, xy)))


def test_no_row_of_a_pair_is_shuffled(spark):
    rows, _ = odd_rows(int)
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating double")
    plan = plan_of(sim.pair_sums(df, pairs_per_task=300))
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(i1" in line]
    assert len(dealt) == 1 and "share" in dealt[0] and "i2" not in dealt[0]
    assert "_rest" in plan and "Join [u" not in plan
    pairs = sim.similar_pairs(df, 0.1, 1)
    assert "Union" not in plan_of(sim.similar_items_each(pairs, 3))


def test_few_candidates_where_few_pairs_reach_the_strength(spark):
    rng = random.Random(3)
    rows = [(u, rng.randrange(300), float(rng.randrange(1, 9))) for u in range(200) for _ in range(12)]
    brute = brute_pairs(rows)
    ui = sim.user_item_stats(spark.createDataFrame(rows, "user_id int, item_id int, rating double"))
    found = {tuple(r) for r in sim.candidate_pairs(ui, 3).collect()}
    above = {p for p, (_, n) in brute.items() if n > 3}
    assert above <= found <= set(brute)
    # looked up one by one, so only those that are near the strength may come
    assert len(found) < len(brute) / 10
