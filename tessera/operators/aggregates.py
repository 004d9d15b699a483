"""Keyed aggregates: histograms, popularity, totals, minima, integer means,
arg-max and filter counts.

All of them are ``groupBy().agg()`` with built-in functions, so Spark plans a
partial (map-side) HashAggregate, one exchange on the key, and a final
aggregate: a hot key is combined inside every map task before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.expressions import int_mean


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_by_key(df: DataFrame, key, name: str = "n") -> DataFrame:
    """Number of rows per key value."""
    return df.groupBy(_c(key)).agg(F.count(F.lit(1)).alias(name))


def top_by_count(df: DataFrame, key: str, k: int, name: str = "n") -> DataFrame:
    """the ``k`` most frequent keys; ties broken by key ascending.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps
    its own top ``k`` and only ``k`` rows per task reach the final merge.
    """
    return count_by_key(df, key, name).orderBy(F.desc(name), F.asc(key)).limit(k)


def popularity_named(facts: DataFrame, fact_key: str, dim: DataFrame, dim_key: str,
                     title: str, name: str = "n") -> DataFrame:
    """Counts per key with the dimension title attached.

    The facts are aggregated first, so the join sees one row per key.  No
    broadcast hint: the dimension grows with the data, so Spark's size
    checks (static statistics, then AQE's measured shuffle sizes) decide
    between a broadcast and a shuffled join.  Keys without a title keep a
    null title (the original job threw instead; see ``strict``).
    """
    counts = count_by_key(facts, fact_key, name)
    titles = dim.select(F.col(dim_key).alias(fact_key), F.col(title))
    return counts.join(titles, fact_key, "left").select(title, fact_key, name)


def lookup(bounded: DataFrame, dim: DataFrame, key: str, max_rows: int) -> DataFrame:
    """Attach dimension columns to a result whose row count has a
    proven bound ``max_rows`` (a top-k report, a one-row arg-max).

    The bounded result is computed once and its rows (at most ``max_rows``,
    checked) come back as the report itself; their keys become an ``IN``
    filter pushed into the dimension's scan, so the dimension is streamed
    and filtered at the source, never shuffled or broadcast however large it
    grows.  Result rows without a match keep nulls.
    """
    rows = bounded.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"lookup side exceeds its bound of {max_rows} rows")
    spark = bounded.sparkSession
    local = spark.createDataFrame(rows, bounded.schema)
    keys = sorted({r[key] for r in rows if r[key] is not None})
    matched = dim.where(F.col(key).isin(keys))
    return local.join(matched, key, "left")


def require_titles(df: DataFrame, title: str) -> DataFrame:
    """``strict`` variant of E2: fail the job when a key has no title."""
    return df.withColumn(
        title, F.when(F.col(title).isNull(),
                      F.raise_error(F.lit(f"missing {title}"))).otherwise(F.col(title)))


def int_mean_by_key(df: DataFrame, key: str, value, name: str = "a") -> DataFrame:
    """``sum(int(value)) div count(*)`` per key, truncating toward zero.

    The sum is a bigint (the original 32-bit sum could wrap; this cannot)
    and the mean is returned as int.
    """
    v = _c(value).cast("int")
    return (df.groupBy(key)
            .agg(F.sum(v).alias("_s"), F.count(F.lit(1)).alias("_n"))
            .select(key, int_mean("_s", "_n").alias(name)))


def sum_by_key(df: DataFrame, key: str, value, name: str = "total",
               decimal: tuple[int, int] | None = None) -> DataFrame:
    """Total per key as double, whatever the order in which rows meet.

    Doubles are summed exactly (``exact_sum``); with ``decimal`` they are first
    rounded to that decimal type, for amounts that are meant as such."""
    v = _c(value)
    if decimal is not None:
        v = v.cast(f"decimal({decimal[0]},{decimal[1]})")
        return df.groupBy(key).agg(F.sum(v).cast("double").alias(name))
    return exact_sum(df.select(key, v.cast("double").alias("_v")), key, "_v", name)


BAND = 32       # exponents of a band
PART = 27       # bits of the parts below the whole number


def exact_sum(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Sum of doubles per key without rounding on the way.

    A value's exponent tells its band of 2^32; divided by 2^(32 band), which is
    exact, it is a whole number and two parts of 27 bits, and three integer sums per (key,
    band) are exact in any order, for up to 2^30 rows a key and band.  At the end the few bands
    of a key are added with their rounding errors carried along (two-sum), so the total is
    that of the exact sum rounded once.  Nulls are skipped, a key without values gets null;
    infinities and NaN as in ordinary addition."""
    x = F.col(value)
    special = F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    size = F.abs(F.when(special, F.lit(0.0)).otherwise(x))
    band = F.when(size > 0, F.floor(F.log2(size) / BAND)).otherwise(F.lit(0)).cast("int")
    half = F.pow(F.lit(2.0), -F.col("_band") * (BAND // 2))      # twice, as 2^-1024 would be out of range
    rows = df.select(key, x.alias("_x"), special.alias("_special"), size.alias("_size"), band.alias("_band"))
    rows = rows.withColumn("_q", F.col("_size") * half * half)
    step = F.lit(float(1 << PART))
    whole = F.floor("_q")
    mid = F.floor((F.col("_q") - whole) * step)
    low = ((F.col("_q") - whole) * step - mid) * step
    sign = F.signum("_x").cast("bigint")
    parts = rows.groupBy(key, "_band").agg(
        *[F.sum(F.when(~F.col("_special"), sign * p.cast("bigint"))).alias(n)
          for n, p in (("_whole", whole), ("_mid", mid), ("_low", low))],
        F.sum(F.when(F.col("_special"), F.col("_x"))).alias("_other"), F.count("_x").alias("_n"))
    both = F.pow(F.lit(2.0), F.col("_band") * (BAND // 2))
    cut = 1 << 31           # sums of up to 62 bits as two doubles without rounding
    pieces = F.array(*[(p.cast("double") * scale * both * both)
                       for c, scale in (("_whole", 1.0), ("_mid", 2.0 ** -PART), ("_low", 2.0 ** (-2 * PART)))
                       for p in (F.expr(f"{c} - {c} % {cut}"), F.expr(f"{c} % {cut}"))])
    one = parts.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col("_band").alias("b"), pieces.alias("p"))),
                                              asc=False).alias("_bands"),
                                 F.sum("_other").alias("_other"), F.sum("_n").alias("_n"))
    total = F.expr("""aggregate(flatten(transform(_bands, x -> x.p)), named_struct('s', 0D, 'e', 0D),
        (a, v) -> named_struct('s', a.s + v,
            'e', a.e + ((a.s - ((a.s + v) - ((a.s + v) - a.s))) + (v - ((a.s + v) - a.s)))),
        a -> a.s + a.e)""")
    return one.select(key, F.when(F.col("_n") > 0, F.coalesce("_other", total)).alias(name))


def min_by_key(df: DataFrame, key: str, value, name: str = "m") -> DataFrame:
    """Minimum per key."""
    return df.groupBy(key).agg(F.min(_c(value)).alias(name))


def arg_max(df: DataFrame, value: str, key: str) -> DataFrame:
    """The single row with the largest ``value``; ties go to the
    largest ``key`` (tuple order).  A global ``max(struct(value, key))``:
    partial aggregation leaves one row per task, no sort, no collect."""
    best = df.agg(F.max(F.struct(F.col(value), F.col(key))).alias("_b"))
    return best.select(F.col("_b")[key].alias(key), F.col("_b")[value].alias(value))


def filter_counts(df: DataFrame, condition: Column) -> DataFrame:
    """Row counts before and after a filter, in one pass."""
    return df.agg(F.count(F.lit(1)).alias("rows_in"),
                  F.count_if(condition).alias("rows_out"))
