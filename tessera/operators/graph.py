"""Graph measures: connections, degrees, most connected node, breadth-first
hop distances and the start-to-target search with hit counting.

Two graph representations share the algorithms:

* ``EdgeGraph``: explicit directed edges ``(src, dst)`` (adjacency files).
* ``CoMemberGraph``: the graph implied by group membership rows
  ``(group, member)``: one directed edge a -> b for every pair of rows of
  the same group with different members (both directions, multi-edges
  kept).  Edges are never materialised: a group with m rows would emit
  m^2 edges, so a single hot group would dominate the job.  Degrees become
  per-group sums (``c * (size - c)``), a search level becomes two
  lookups (frontier -> its groups -> their members), and the hit count
  is ``sum over groups of (frontier rows) * (target rows)``.

A search is a driver loop over DataFrames that runs until its frontier is empty
(``max_levels`` ends it earlier if asked):

* The rows it looks up (``KeyedRows``) are written once, bucketed and sorted by the
  node or group they are looked up by, so a level shuffles its frontier and what it
  finds, never the stored rows.  A hot key's rows are spread over several buckets.
* The nodes visited are bitmaps, one row per 32,768 ids.  A level tests what it
  found against them; they are written together every few levels, so a level's work
  does not depend on how many there were.  Ids too sparse for bitmaps are numbered densely first.
* Every level is written as a Parquet folder ``dist=<k>`` in the session's checkpoint
  directory: lineage is cut, and the levels together are the result.

No join side is hinted: sizes and AQE decide.  ``bfs_hits`` searches from both ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.aggregates import arg_max, lookup
from tessera.operators.ml import dense_index
from tessera.session import bucketed, default_parallelism, materialize, scratch_path

ROWS_PER_BUCKET = 1 << 20
SPARSE = 64             # ids are numbered where their range holds so many times more values


class KeyedRows:
    """Rows of a table for lookups by one column (see module docstring)."""

    def __init__(self, rows: DataFrame, key: str, name: str, rows_per_bucket: int = ROWS_PER_BUCKET):
        n = rows.count()
        buckets = max(default_parallelism(rows.sparkSession), -(-n // rows_per_bucket))
        self.hot, self.keys = None, [key]
        if n > rows_per_bucket:     # else no key has more rows than a bucket should
            hot = materialize(rows.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_bucket)).cast("int")
                                                    .alias("parts")).where(F.col("parts") > 1), f"{name}-hot")
            self.hot = None if hot.isEmpty() else hot
        if self.hot is not None:
            self.keys = [key, "part"]
            others = [c for c in rows.columns if c != key]
            rows = (rows.join(hot, key, "left")
                    .withColumn("part", F.pmod(F.xxhash64(*others), F.coalesce("parts", F.lit(1))).cast("int"))
                    .drop("parts"))
        self.rows = bucketed(rows, name, buckets, *self.keys)

    def of(self, wanted: DataFrame) -> DataFrame:
        """The stored rows whose key is in ``wanted``, with its columns."""
        if self.hot is not None:
            wanted = (wanted.join(self.hot, self.keys[0], "left")
                      .withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
                      .drop("parts"))
        return self.rows.join(wanted, self.keys).drop("part")


class _Graph:
    """What both representations share: storage and the numbering of sparse ids."""

    spark: SparkSession
    ends: tuple[str, ...]           # the columns of ``counted`` that hold nodes

    def __init__(self):
        self._stored: DataFrame | None = None
        self._numbered: DataFrame | None = None
        self._keyed: dict[str, KeyedRows] = {}
        self.numbers: DataFrame | None = None

    def counted(self) -> DataFrame:
        raise NotImplementedError

    def stored(self) -> DataFrame:
        """Distinct rows with their multiplicity ``c``, written once."""
        if self._stored is None:
            self._stored = materialize(self.counted(), "graph")
        return self._stored

    def numbered(self) -> DataFrame:
        """``stored`` with node numbers in place of sparse ids; ``numbers (id, no)``
        maps them then."""
        if self._numbered is None:
            rows = self.stored()
            nodes = rows.select(F.explode(F.array(*self.ends)).alias("id"))
            low, high = nodes.agg(F.min("id"), F.max("id")).collect()[0]
            wide = low is not None and high - low >= SPARSE * 32_768
            if wide and high - low >= SPARSE * nodes.agg(F.approx_count_distinct("id")).collect()[0][0]:
                self.numbers = materialize(dense_index(nodes, "id", "no", "bigint"), "node-numbers")
                for c in self.ends:
                    no = self.numbers.select(F.col("id").alias(c), F.col("no").alias("_no"))
                    rows = rows.join(no, c).drop(c).withColumnRenamed("_no", c)
                rows = materialize(rows, "graph-numbered")
            self._numbered = rows
        return self._numbered

    def keyed(self, key: str) -> KeyedRows:
        if key not in self._keyed:
            self._keyed[key] = KeyedRows(self.numbered(), key, f"by-{key}")
        return self._keyed[key]

    def number_of(self, node) -> int | None:
        """A node's number in searches; None for a node without edges."""
        self.numbered()
        if self.numbers is None:
            return node
        found = self.numbers.where(F.col("id") == F.lit(node)).select("no").collect()   # one row at most
        return found[0]["no"] if found else None

    def named(self, rows: DataFrame) -> DataFrame:
        """``rows (id, ...)`` of a search in the caller's ids."""
        if self.numbers is None:
            return rows
        columns = rows.columns
        return rows.withColumnRenamed("id", "no").join(self.numbers, "no").select(*columns)


class EdgeGraph(_Graph):
    """Directed multigraph given by explicit edges ``(src, dst)``."""

    ends = ("src", "dst")

    def __init__(self, edges: DataFrame, src: str = "src", dst: str = "dst"):
        super().__init__()
        self.edges = edges.select(F.col(src).cast("bigint").alias("src"),
                                  F.col(dst).cast("bigint").alias("dst"))
        self.spark = edges.sparkSession

    def counted(self) -> DataFrame:
        return (self.edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
                .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("c")))

    def out_degree(self) -> DataFrame:
        """Outgoing edges per node (``id, n``)."""
        return self.edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("n"))

    def degree(self) -> DataFrame:
        """In + out degree (``id, deg``); self-loops count at both ends."""
        ends = self.edges.select(F.col("src").alias("id")).unionAll(
            self.edges.select(F.col("dst").alias("id")))
        return ends.groupBy("id").agg(F.count(F.lit(1)).alias("deg"))

    def expand(self, frontier: DataFrame, done: DataFrame | None = None, reverse: bool = False
               ) -> tuple[DataFrame, None]:
        """Heads of the edges leaving the frontier (``reverse``: tails of those
        entering it), one row each: ``(id, h)`` with ``h`` = number of those edges
        at ``id``."""
        near, far = ("dst", "src") if reverse else ("src", "dst")
        out = self.keyed(near).of(frontier.select(F.col("id").alias(near)))
        return out.groupBy(F.col(far).alias("id")).agg(F.sum("c").alias("h")), None


class CoMemberGraph(_Graph):
    """Graph of members that share a group (see module docstring)."""

    ends = ("m",)

    def __init__(self, membership: DataFrame, group: str = "group", member: str = "member"):
        super().__init__()
        # a row with a null group or member joins no edge (null never equals
        # anything), so it must not count towards group sizes either
        self.rows = (membership.select(F.col(group).alias("g"),
                                       F.col(member).cast("bigint").alias("m"))
                     .where(F.col("g").isNotNull() & F.col("m").isNotNull()))
        self.spark = membership.sparkSession

    def counted(self) -> DataFrame:
        """(g, m, c): multiplicity of each member in each group; copies of
        one row are combined map-side."""
        return self.rows.groupBy("g", "m").agg(F.count(F.lit(1)).alias("c"))

    def out_degree(self) -> DataFrame:
        """Edges leaving each member: sum over its groups of c * (size - c).
        Members whose groups hold nobody else have no edge and no row."""
        gm = self.stored()
        sizes = materialize(gm.groupBy("g").agg(F.sum("c").alias("size")), "group-sizes")
        return (gm.join(sizes, "g")
                .groupBy(F.col("m").alias("id"))
                .agg(F.sum(F.col("c") * (F.col("size") - F.col("c"))).alias("n"))
                .where(F.col("n") > 0))

    def degree(self) -> DataFrame:
        """Every edge has its reverse, so in-degree equals out-degree."""
        return self.out_degree().select("id", (F.col("n") * 2).alias("deg"))

    def expand(self, frontier: DataFrame, done: DataFrame | None = None, reverse: bool = False
               ) -> tuple[DataFrame, DataFrame]:
        """Members of the groups that hold a frontier member, one row each:
        ``(id, h)`` with ``h`` = edges from the frontier into ``id``; and those
        groups.  Every edge has its reverse, so ``reverse`` changes nothing.

        ``a`` = frontier rows of a group; each row of a member in that group
        closes ``a`` edges from the frontier (a frontier member's own rows
        count too, but frontier members are visited and dropped later).

        ``done`` = the groups of the step before.  They are left out: their
        members are all visited, so they hold no new one and no edge into one.
        Older groups need no test, a frontier member in one of them would have
        been reached earlier.
        """
        own = self.keyed("m").of(frontier.select(F.col("id").alias("m")))
        groups = own.groupBy("g").agg(F.sum("c").alias("a"))
        if done is not None:
            groups = groups.join(done.select("g"), "g", "left_anti")
        groups = materialize(groups, "frontier-groups")
        return (self.keyed("g").of(groups)
                .groupBy(F.col("m").alias("id"))
                .agg(F.sum(F.col("a") * F.col("c")).alias("h"))), groups


# ---------------------------------------------------------------- measures

DEFAULT_VERTEX_NAME = "Nobody"


def node_ids(graph) -> DataFrame:
    """Every node that has at least one edge (either end)."""
    if isinstance(graph, EdgeGraph):
        ends = graph.edges.select(F.col("src").alias("id")).unionAll(
            graph.edges.select(F.col("dst").alias("id")))
        return ends.distinct()
    return graph.out_degree().select("id")


def named_vertices(graph, names: DataFrame, name_col: str = "name",
                   default: str = DEFAULT_VERTEX_NAME) -> DataFrame:
    """G1: the graph's nodes with their names; nodes missing from ``names``
    get ``default`` (one name per id: the smallest, if repeated)."""
    one = names.groupBy("id").agg(F.min(name_col).alias(name_col))
    return (node_ids(graph).join(one, "id", "left")
            .select("id", F.coalesce(F.col(name_col), F.lit(default)).alias(name_col)))


def most_connected(graph, names: DataFrame | None = None, name_col: str = "name") -> DataFrame:
    """The node with the most connections (ties: larger id), with its
    name when ``names (id, name_col)`` is given (first name if repeated)."""
    best = arg_max(graph.out_degree(), "n", "id")
    if names is None:
        return best
    # one name per id (the smallest if repeated), looked up for one row
    return lookup(best, names.groupBy("id").agg(F.min(name_col).alias(name_col)), "id", 1)


def degree_top(graph, names: DataFrame | None = None, k: int = 10,
               name_col: str = "name") -> DataFrame:
    """The ``k`` nodes of largest in+out degree (ties: smaller id).
    With ``names``, nodes without a name drop out before ranking (inner
    join), as in the property-graph version."""
    deg = graph.degree()
    if names is not None:
        deg = deg.join(_one_name(names, name_col), "id")
    return deg.orderBy(F.desc("deg"), F.asc("id")).limit(k)


# ---------------------------------------------------------------- searches

LEVEL_SCHEMA = "id bigint, dist int"


def id_bitmaps(ids: DataFrame) -> DataFrame:
    """``(bucket, bits)``: one bitmap per 32,768 ids."""
    return ids.groupBy(F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def not_in_bitmaps(rows: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The rows whose ``id`` has no bit."""
    byte = F.expr("conv(hex(substring(bits, cast(bitmap_bit_position(id) div 8 as int) + 1, 1)), 16, 10)")
    bit = F.expr("cast(bitmap_bit_position(id) % 8 as int)")
    seen = F.getbit(byte.cast("int"), bit) == 1
    return (rows.withColumn("bucket", F.bitmap_bucket_number("id")).join(bitmaps, "bucket", "left")
            .where(F.col("bits").isNull() | ~seen).select(*rows.columns))


class Search:
    """Breadth-first levels from one node, along the edges or against them.

    Levels 1 to ``level`` are written below ``base`` as ``dist=k``, each node with
    the number ``h`` of edges between it and the level before; the last one has
    ``size`` nodes.  ``visited`` holds the bits of the levels below ``since``; those
    of the few later ones are taken from their rows, and every ``FOLD`` levels they
    are written together."""

    FOLD = 8

    def __init__(self, graph, start: int, reverse: bool = False):
        self.graph, self.reverse = graph, reverse
        self.base = scratch_path(graph.spark, "levels")
        self.seed = graph.spark.range(1).select(F.lit(start).cast("bigint").alias("id"), F.lit(0).cast("bigint").alias("h"))
        self.level, self.size, self.done = 0, 1, None
        self.visited, self.since = None, 0

    def rows(self, level: int | None = None) -> DataFrame:
        level = self.level if level is None else level
        if not level:
            return self.seed
        return self.graph.spark.read.schema("id bigint, h bigint").parquet(f"{self.base}/dist={level}")

    def bits(self) -> DataFrame:
        """Bitmaps of all nodes reached."""
        late = self.rows(self.since)
        for level in range(self.since + 1, self.level + 1):
            late = late.unionAll(self.rows(level))
        late = id_bitmaps(late)
        if self.visited is None:
            return late
        return self.visited.unionAll(late).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))

    def step(self) -> int:
        """Write the next level; its size."""
        found, self.done = self.graph.expand(self.rows(), self.done, self.reverse)
        not_in_bitmaps(found, self.bits()).select("id", "h").write.parquet(f"{self.base}/dist={self.level + 1}")
        if self.level + 1 - self.since >= self.FOLD:
            self.visited, self.since = materialize(self.bits(), "visited"), self.level + 1
        self.level += 1
        self.size = self.rows().count()
        return self.size

    def distances(self) -> DataFrame:
        """``(id, dist)`` of every node reached."""
        start = self.seed.select("id", F.lit(0).alias("dist"))
        if not self.level:
            return start
        return start.unionAll(self.graph.spark.read.schema(LEVEL_SCHEMA).parquet(self.base))


def _one_name(names: DataFrame, name_col: str) -> DataFrame:
    """One name per id (the smallest, if repeated)."""
    return names.groupBy("id").agg(F.min(name_col).alias(name_col))


def hop_distance(graph, root, max_levels: int | None = None,
                 names: DataFrame | None = None, name_col: str = "name") -> DataFrame:
    """Hop count from ``root`` along directed edges to every node
    reached (within ``max_levels`` hops, if given): ``(id, dist)``; the root has 0.
    With ``names``, an inner join attaches them (E6)."""
    start = graph.number_of(root)
    if start is None:       # a node without edges reaches itself
        dist = graph.spark.range(1).select(F.lit(root).cast("bigint").alias("id"), F.lit(0).alias("dist"))
    else:
        search = Search(graph, start)
        while (max_levels is None or search.level < max_levels) and search.step():
            pass
        dist = graph.named(search.distances())
    if names is not None:
        dist = dist.join(_one_name(names, name_col), "id")
    return dist


def distance_to(graph, root, target, max_levels: int | None = None) -> DataFrame:
    """The hop distance row of one node (empty when unreached)."""
    return hop_distance(graph, root, max_levels).where(F.col("id") == F.lit(target))


def hop_distance_all(graph, root, nodes: DataFrame,
                     max_levels: int | None = None) -> DataFrame:
    """G5 with every node of ``nodes (id)``: unreached ones get +Infinity
    (``dist`` double), as the vertex-program version reports them."""
    reached = hop_distance(graph, root, max_levels)
    return (nodes.select("id").distinct()
            .join(reached, "id", "left")
            .select("id", F.coalesce(F.col("dist").cast("double"),
                                     F.lit(float("inf"))).alias("dist")))


def bfs_hits(graph, start, target, max_levels: int | None = None) -> DataFrame:
    """One row ``(level, hits)`` = the target's distance from ``start`` and
    the number of edges into it from nodes one level nearer.  Empty when the
    target is not reached; ``(0, 0)`` when start is the target.

    Searched from both ends, always the end with fewer nodes in its last
    level.  Where the last levels first meet the distance is found; the nodes met are
    followed down the target's levels to those next to it, whose edges are the hits."""
    found = _meet(graph, start, target, max_levels)
    return graph.spark.createDataFrame([found] if found else [], "level int, hits bigint")


def _meet(graph, start, target, max_levels: int | None) -> tuple[int, int] | None:
    if start == target:
        return 0, 0
    first, last = graph.number_of(start), graph.number_of(target)
    if first is None or last is None:
        return None
    ahead, back = Search(graph, first), Search(graph, last, reverse=True)
    while max_levels is None or ahead.level + back.level < max_levels:
        side, other = (ahead, back) if ahead.size <= back.size else (back, ahead)
        if not side.step():
            return None
        met = materialize(side.rows().join(other.rows().select("id"), "id", "left_semi").select("id"), "met")
        if not met.isEmpty():
            break
    else:
        return None
    if not back.level:
        hits = ahead.rows().where(F.col("id") == F.lit(last))
    else:
        for level in range(back.level - 1, 0, -1):
            further, _ = graph.expand(met)
            met = materialize(back.rows(level).join(further.select("id"), "id", "left_semi").select("id"), "met")
        hits = back.rows(1).join(met, "id", "left_semi")
    return ahead.level + back.level, int(hits.agg(F.sum("h")).collect()[0][0])
