"""Item-to-item cosine similarity (all pairs, and the top similar items of
one item).

For a pair of items (i1, i2), i1 < i2, the sums run over every combination
of a rating of i1 and a rating of i2 given by the same user (duplicate
ratings included):

    xx = sum r1*r1,  yy = sum r2*r2,  xy = sum r1*r2,  n = number of combinations
    score = xy / (sqrt(xx) * sqrt(yy))

Plan shape (all pairs):

1. ratings -> per (user, item) ``c = count, s1 = sum r, s2 = sum r^2``.
   Copies of one rating collapse here, in the map-side partial aggregate.
   The combination sums then factor per user:
   ``xx += s2(i1)*c(i2)``, ``yy += c(i1)*s2(i2)``, ``xy += s1(i1)*s1(i2)``,
   ``n += c(i1)*c(i2)``.
   This table is written once to the checkpoint folder (lineage cut).
2. A user's items are put side by side, a basket ordered by item.  A user with
   ``n`` items has ``S = ceil(n / block_items)`` buckets; the items are hashed
   into them and there is a basket per pair of buckets, so a hot user's pair work is
   spread over ``S * S / 2`` baskets; an ordinary user has one.
3. Each item goes, with the rest of the basket behind it, to the task of the
   item, where the pairs are made and summed: what is shuffled are ratings (a few
   bytes a pair), never rows of a pair, and no pair row is spilled.  The number of tasks
   grows with the pairs; a hot item is dealt over several tasks by the other item.

Where only pairs above a strength are wanted, items that cannot reach it leave
before the pairs are made: an item's pairs have at most ``sum over its users of
c * (the user's largest c)`` combinations.

For the similar items of ONE item no pair table is built: the item's
raters are joined to their other ratings (linear in those ratings) and the
sums are aggregated per other item.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from tessera.functions.expressions import cosine_score, other_item
from tessera.session import materialize

DEFAULT_BLOCK_ITEMS = 1024
PAIRS_PER_TASK = 2_000_000


def _ratings(ratings: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    return ratings.select(F.col(user).alias("u"), F.col(item).alias("i"),
                          F.col(rating).cast("double").alias("r"))


def user_item_stats(ratings: DataFrame, user: str = "user_id", item: str = "item_id",
                    rating: str = "rating") -> DataFrame:
    """Per (user, item): number of ratings, their sum and sum of squares."""
    r = _ratings(ratings, user, item, rating)
    return r.groupBy("u", "i").agg(
        F.count(F.lit(1)).alias("c"),
        F.sum("r").alias("s1"),
        F.sum(F.col("r") * F.col("r")).alias("s2"))


def baskets(rows: DataFrame, block_items: int = DEFAULT_BLOCK_ITEMS) -> DataFrame:
    """The rows ``(u, i, ...)`` of every user, one per item, side by side in arrays
    ordered by item: ``(u, k1, k2, i, b, ...)``, a row per user.  A user of more than
    ``block_items`` items has a row per pair of its ``S`` blocks ``k1 <= k2``
    (``b``: an item's block), so no array grows with the user."""
    values = [c for c in rows.columns if c != "u"]
    hot = materialize(rows.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_items)).cast("int").alias("S"))
                      .where(F.col("S") > 1), "hot-users")
    spread = (rows.join(hot, "u", "left").withColumn("S", F.coalesce("S", F.lit(1)))
              .withColumn("b", F.pmod(F.xxhash64("i"), F.col("S")).cast("int"))
              .withColumn("k", F.explode(F.sequence(F.lit(0), F.col("S") - 1)))
              .select("u", F.least("b", "k").alias("k1"), F.greatest("b", "k").alias("k2"), "b", *values))
    keys = ["u", "k1", "k2"]
    # dealt before the lists are built: no two tasks hold rows of a list, so partial lists save nothing
    lists = (spread.repartition(*keys).groupBy(*keys)
             .agg(F.sort_array(F.collect_list(F.struct("i", "b", *[c for c in values if c != "i"]))).alias("rows")))
    return materialize(lists.select(*keys, *[F.col(f"rows.{c}").alias(c) for c in ("i", "b", *[c for c in values if c != "i"])]),
                       "baskets")


def in_pairs(lists: DataFrame, values: list[str], sums: dict, usual: dict | None = None,
             pairs_per_task: int = PAIRS_PER_TASK) -> DataFrame:
    """``(i1, i2, <sums>)``: ``sums`` (expressions of ``<value>1`` and ``<value>2``) over
    every pair ``i1 < i2`` of items of a basket.

    An item goes to its task with the rest of the basket behind it, and the pairs
    are made and summed there: no row of a pair is shuffled.  The tasks grow with the
    pairs; an item with more than ``pairs_per_task`` of them is dealt over several, by
    the other item.  ``usual``: the value that an array of a column mostly holds; it is
    not moved where it is all there is."""
    usual = usual or {}
    n = F.size("i")
    whole_items = isinstance(lists.schema["i"].dataType.elementType, (IntegerType, LongType))
    lists = lists.where(n > 1)
    at = lists.withColumn("p", F.explode(F.sequence(F.lit(0), n - 2)))
    work = materialize(at.groupBy(F.get("i", F.col("p")).alias("i1")).agg(F.sum(n - 1 - F.col("p")).alias("work")),
                       "item-work")
    tasks = max(1, math.ceil((work.agg(F.sum("work")).collect()[0][0] or 0) / pairs_per_task))
    hot = materialize(work.where(F.col("work") > pairs_per_task)
                      .select("i1", F.ceil(F.col("work") / pairs_per_task).cast("int").alias("shares")), "hot-items")
    # dealt again: a basket is small beside what it sends
    wide = lists.repartition(max(1, tasks // 2), "u", "k1", "k2")
    names = ["i"]
    if whole_items:     # 16 bits and the bits above, which repeat: half the bytes once compressed
        wide = wide.withColumns({"low": F.transform("i", lambda x: (x.bitwiseAND(F.lit(0xFFFF)) - 0x8000).cast("smallint")),
                                 "high": F.transform("i", lambda x: F.shiftright(x, 16))})
        names = ["low", "high"]
    own = (wide.withColumn("p", F.explode(F.sequence(F.lit(0), n - 2))).select("*", F.get("i", F.col("p")).alias("i1"), *[F.get(v, F.col("p")).alias(f"{v}1") for v in values])
           .join(hot, "i1", "left").withColumn("shares", F.coalesce("shares", F.lit(1)))
           .withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))))
    mine = F.filter(F.sequence(F.col("p") + 1, n - 1), lambda j: (
        ((F.col("k1") == F.col("k2")) | (F.get("b", j) != F.get("b", F.col("p"))))
        & (F.pmod(F.xxhash64(F.get("i", j)), F.col("shares")) == F.col("share"))))
    whole = (F.col("k1") == F.col("k2")) & (F.col("shares") == 1)

    def rest(v):
        return F.when(whole, F.slice(v, F.col("p") + 2, n - 1 - F.col("p"))).otherwise(
            F.transform(mine, lambda j: F.get(v, j)))

    def moved(v):
        """The rest of an array, or null where it says nothing new."""
        if v == "high":     # ordered: the last is the largest
            return F.when(F.get(v, n - 1) != F.get(v, F.col("p")), rest(v)).alias("high_rest")
        if v not in usual:
            return rest(v).alias(f"{v}_rest")
        as_usual = F.array_min(rest(v)).eqNullSafe(F.lit(usual[v])) & F.array_max(rest(v)).eqNullSafe(F.lit(usual[v]))
        return F.when(~as_usual, rest(v)).alias(f"{v}_rest")

    dealt = own.select("i1", "share", *[f"{v}1" for v in values], *[moved(v) for v in [*names, *values]]) \
        .where(F.size(f"{names[0]}_rest") > 0).repartition(tasks, "i1", "share")
    pairs = dealt.withColumn("j", F.explode(F.sequence(F.lit(0), F.size(f"{names[0]}_rest") - 1)))
    i2 = F.get(f"{names[0]}_rest", F.col("j"))
    if whole_items:
        high = F.coalesce(F.get("high_rest", F.col("j")), F.shiftright("i1", 16))
        i2 = F.shiftleft(high, 16) + (i2.cast("int") + 0x8000)
    pairs = pairs.select(
        "i1", "share", i2.alias("i2"),
        *[f"{v}1" for v in values], *[F.coalesce(F.get(f"{v}_rest", F.col("j")), F.lit(usual.get(v))).alias(f"{v}2") for v in values])
    return (pairs.groupBy("i1", "share", "i2").agg(*[F.sum(e).alias(name) for name, e in sums.items()])
            .select("i1", "i2", *sums))


def pair_sums(ratings: DataFrame, user: str = "user_id", item: str = "item_id",
              rating: str = "rating", block_items: int = DEFAULT_BLOCK_ITEMS,
              min_strength: int | None = None, pairs_per_task: int = PAIRS_PER_TASK) -> DataFrame:
    """(i1, i2, xx, yy, xy, n) for every pair of items rated by a common user;
    with ``min_strength``, no pair with ``n > min_strength`` is missing and
    items that have none are left out."""
    ui = user_item_stats(ratings, user, item, rating).where(F.col("u").isNotNull() & F.col("i").isNotNull())
    # the square of one rating is its own: not moved
    ui = materialize(ui.withColumn("s2", F.when(F.col("c") > 1, F.col("s2"))), "user-item")
    lists = baskets(ui, block_items)
    if min_strength is not None:
        able = materialize(_reach(lists, block_items).where(F.col("reach") > F.lit(min_strength)).select("i"), "able-items")
        if not lists.select(F.explode("i").alias("i")).distinct().join(able, "i", "left_anti").isEmpty():
            lists = baskets(materialize(ui.join(able, "i", "left_semi"), "user-item-able"), block_items)
    # sums that are small whole numbers in all of a basket move as such
    small = F.forall("s1", lambda x: x.isNotNull() & (F.abs(x) < 0x8000) & (F.floor(x) == x))
    lists = lists.withColumns({"w": F.when(small, F.transform("s1", lambda x: x.cast("smallint"))),
                               "s1": F.when(~small, F.col("s1"))})
    s1 = {k: F.coalesce(F.col(f"w{k}").cast("double"), f"s1{k}") for k in (1, 2)}
    s2 = {k: F.coalesce(f"s2{k}", F.when(F.col(f"c{k}") == 1, s1[k] * s1[k])) for k in (1, 2)}
    return in_pairs(lists, ["c", "w", "s1", "s2"], {
        "xx": s2[1] * F.col("c2"), "yy": F.col("c1") * s2[2], "xy": s1[1] * s1[2], "n": F.col("c1") * F.col("c2")},
        {"c": 1, "s2": None}, pairs_per_task)


def _reach(lists: DataFrame, block_items: int) -> DataFrame:
    """``(i, reach)``: what an item's pairs can add up to at most, ``sum over its users
    of c * (the user's largest c)``."""
    # a block stands once with itself; only users of several blocks need a look at the others
    own = lists.where(F.col("k1") == F.col("k2"))
    cut = materialize(own.groupBy("u").agg(F.count(F.lit(1)).alias("blocks"), F.max(F.array_max("c")).alias("all"))
                      .where(F.col("blocks") > 1).select("u", "all"), "hot-users-most")
    one = own.join(cut, "u", "left").withColumn("most", F.coalesce("all", F.array_max("c"))).withColumn(
        "p", F.explode(F.sequence(F.lit(0), F.size("i") - 1)))
    return one.groupBy(F.get("i", F.col("p")).alias("i")).agg(F.sum(F.get("c", F.col("p")) * F.col("most")).alias("reach"))


def item_similarity(ratings: DataFrame, user: str = "user_id", item: str = "item_id",
                    rating: str = "rating", zero_denominator: float | None = None,
                    block_items: int = DEFAULT_BLOCK_ITEMS) -> DataFrame:
    """(i1, i2, score, n) for all co-rated item pairs, i1 < i2."""
    p = pair_sums(ratings, user, item, rating, block_items)
    return p.select("i1", "i2",
                    cosine_score("xy", "xx", "yy", zero_denominator).alias("score"),
                    "n")


def candidate_pairs(ui: DataFrame, min_strength: int, block_items: int = DEFAULT_BLOCK_ITEMS,
                    pairs_per_task: int = PAIRS_PER_TASK) -> DataFrame:
    """``(i1, i2)``: every pair of items that can have ``n > min_strength``, by
    prefix filtering.

    Users are ordered by rarity (few items first).  An item's pairs have at most
    ``c * most`` combinations at a user (``c`` its ratings there, ``most`` the user's
    largest count).  The users at the end of an item's order whose bounds add up to
    half the strength at most are left out, the others are its prefix.  Of the users
    that two items share, those outside either prefix are all left out by that of the two
    items whose prefix is shorter, so they hold at most half the strength: a
    pair above the strength has more than the other half at users in both prefixes."""
    users = materialize(ui.groupBy("u").agg(F.count(F.lit(1)).alias("items"), F.max("c").alias("most")), "user-rarity")
    rarity = materialize(ui.where(F.col("i").isNotNull()).join(users, "u")
                         .select("u", "i", "c", "items", (F.col("c") * F.col("most")).alias("bound")), "item-bounds")
    # per item and number of items of a user: what all users at least as frequent add up to
    steps = rarity.groupBy("i", "items").agg(F.sum("bound").alias("bound"))
    behind = Window.partitionBy("i").orderBy(F.desc("items")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # whole steps only: a step is in the prefix unless it and all behind it stay within half the strength
    half = min_strength // 2
    keep = steps.withColumn("rest", F.sum("bound").over(behind)).where(F.col("rest") > half).select("i", "items")
    prefix = materialize(rarity.join(keep, ["i", "items"]).select("u", "i", "c"), "item-prefixes")
    shared = in_pairs(baskets(prefix, block_items), ["c"], {"n": F.col("c1") * F.col("c2")}, {"c": 1}, pairs_per_task)
    return shared.where(F.col("n") > F.lit(min_strength - half)).select("i1", "i2")


def sums_of(pairs: DataFrame, ui: DataFrame) -> DataFrame:
    """The sums of ``pair_sums`` for the given pairs alone: the item with fewer users
    brings its users, which are looked up with the other item."""
    users = ui.groupBy("i").agg(F.count(F.lit(1)).alias("n_users"))
    a, b = (users.select(F.col("i").alias(f"i{k}"), F.col("n_users").alias(f"n{k}")) for k in (1, 2))
    flip = F.col("n2") < F.col("n1")
    oriented = pairs.join(a, "i1").join(b, "i2").select(
        F.when(flip, F.col("i2")).otherwise(F.col("i1")).alias("i"),
        F.when(flip, F.col("i1")).otherwise(F.col("i2")).alias("j"))
    other = ui.select("u", F.col("i").alias("j"), F.col("c").alias("cj"), F.col("s1").alias("s1j"), F.col("s2").alias("s2j"))
    sums = oriented.join(ui, "i").join(other, ["u", "j"]).groupBy("i", "j").agg(
        F.sum(F.col("s2") * F.col("cj")).alias("xx"), F.sum(F.col("c") * F.col("s2j")).alias("yy"),
        F.sum(F.col("s1") * F.col("s1j")).alias("xy"), F.sum(F.col("c") * F.col("cj")).alias("n"))
    first = F.col("i") < F.col("j")
    return sums.select(F.least("i", "j").alias("i1"), F.greatest("i", "j").alias("i2"),
                       F.when(first, F.col("xx")).otherwise(F.col("yy")).alias("xx"),
                       F.when(first, F.col("yy")).otherwise(F.col("xx")).alias("yy"), "xy", "n")


def similar_pairs(ratings: DataFrame, min_score: float = 0.97, min_strength: int = 50, user: str = "user_id",
                  item: str = "item_id", rating: str = "rating", zero_denominator: float | None = None,
                  block_items: int = DEFAULT_BLOCK_ITEMS, prefixes: bool = False) -> DataFrame:
    """(i1, i2, score, n) of the pairs above both bounds (strict).

    ``prefixes``: candidates by prefix filtering, the better plan where few
    pairs of co-rated items reach the strength; the same rows either way."""
    if prefixes:
        ui = materialize(user_item_stats(ratings, user, item, rating), "user-item")
        p = sums_of(materialize(candidate_pairs(ui, min_strength, block_items), "candidates"), ui)
    else:
        p = pair_sums(ratings, user, item, rating, block_items, min_strength)
    return (p.where(F.col("n") > F.lit(min_strength))
            .select("i1", "i2", cosine_score("xy", "xx", "yy", zero_denominator).alias("score"), "n")
            .where(F.col("score") > F.lit(min_score)))


def similar_items_each(pairs: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` items most similar to every item of a pair table ``(i1, i2, score,
    n)``: ``(item, rank, other, score, n)``, ordered as in ``similar_items``.

    A rank per item with a bound is planned as a group limit: every task keeps
    ``k`` rows an item before the shuffle."""
    sides = F.array(F.struct(F.col("i1").alias("item"), F.col("i2").alias("other")),
                    F.struct(F.col("i2").alias("item"), F.col("i1").alias("other")))
    # both sides of a pair from one pass: the pair table is not computed twice
    both = pairs.select(F.explode(sides).alias("side"), "score", "n").select("side.*", "score", "n")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.desc("n"), F.desc("other"))
    return (both.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("item", "rank", "other", "score", "n"))


def item_raters(ratings: DataFrame, item_id, user: str = "user_id", item: str = "item_id",
                rating: str = "rating") -> DataFrame:
    """``(u, ct, s1t, s2t)``: the users that rated the item, with the count, sum
    and sum of squares of their ratings of it; written once."""
    r = _ratings(ratings, user, item, rating)
    raters = (r.where(F.col("i") == F.lit(item_id))
              .groupBy("u").agg(F.count(F.lit(1)).alias("ct"),
                                F.sum("r").alias("s1t"),
                                F.sum(F.col("r") * F.col("r")).alias("s2t")))
    # written, so that a join has a plain scan on this side and AQE can split a hot user
    return materialize(raters, "raters")


def similar_items(ratings: DataFrame, item_id, user: str = "user_id",
                  item: str = "item_id", rating: str = "rating",
                  min_score: float = 0.97, min_strength: int = 50, k: int = 10,
                  zero_denominator: float | None = None, raters: DataFrame | None = None) -> DataFrame:
    """The ``k`` items most similar to ``item_id``.

    Pairs containing the item with ``score > min_score`` and
    ``n > min_strength`` (both strict), best first by score then strength,
    ties by the other item descending.  Output ``(other, score, n)``.

    ``raters``: what ``item_raters`` found, if the caller has it; ``ratings``
    may then be those of these users alone.
    """
    r = _ratings(ratings, user, item, rating)
    t = F.lit(item_id)
    if raters is None:
        raters = item_raters(ratings, item_id, user, item, rating)
    others = r.where(F.col("i") != t).join(raters, "u")
    sums = others.groupBy("i").agg(
        F.sum(F.col("s2t")).alias("a"),                       # sum r_t^2 over combos
        F.sum(F.col("ct") * F.col("r") * F.col("r")).alias("b"),  # sum r_j^2 over combos
        F.sum(F.col("s1t") * F.col("r")).alias("xy"),
        F.sum(F.col("ct")).alias("n"))
    # orient the sums as (i1, i2) with i1 < i2, as in the pair table
    t_first = F.col("i") > t
    xx = F.when(t_first, F.col("a")).otherwise(F.col("b"))
    yy = F.when(t_first, F.col("b")).otherwise(F.col("a"))
    scored = sums.select(F.col("i").alias("other"),
                         cosine_score(F.col("xy"), xx, yy, zero_denominator).alias("score"),
                         "n")
    return (scored
            .where((F.col("score") > F.lit(min_score)) & (F.col("n") > F.lit(min_strength)))
            .orderBy(F.desc("score"), F.desc("n"), F.desc("other"))
            .limit(k))


def similar_items_from_pairs(pairs: DataFrame, item_id, min_score: float = 0.97,
                             min_strength: int = 50, k: int = 10) -> DataFrame:
    """Same top-k read off an existing pair table (i1, i2, score, n)."""
    t = F.lit(item_id)
    return (pairs
            .where(((F.col("i1") == t) | (F.col("i2") == t))
                   & (F.col("score") > F.lit(min_score)) & (F.col("n") > F.lit(min_strength)))
            .select(other_item("i1", "i2", item_id).alias("other"), "score", "n")
            .orderBy(F.desc("score"), F.desc("n"), F.desc("other"))
            .limit(k))
