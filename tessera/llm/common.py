"""Helpers shared by the operators of this subpackage.

Lineage cuts go through ``tessera.session.materialize``: Parquet tables in the
session's shared checkpoint folder, so a lost executor costs a re-read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize


def text_or_empty(col: str = "text") -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def crc32_mod(col: str, mod: int) -> Column:
    """``crc32(col as text) mod m`` (null for a null value)."""
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(mod))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once: an expression that is used
    several times inside a larger one would be evaluated each time."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def require(df: DataFrame, *cols: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")


def words(data: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes (``bytes.split`` cuts at
    exactly these six characters)."""
    return data.split()


# ------------------------------------------------------- connected components

def _checksum(df: DataFrame):
    return tuple(df.agg(F.count(F.lit(1)),
                        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).collect()[0])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` of every node of an undirected edge list; the
    component is its smallest node id.

    Alternating large-star and small-star rounds (each O(edges), a logarithmic
    number of them in practice).  Every round's edges and minima are written to
    the checkpoint folder: the loop never re-runs its lineage, only one
    checksum row reaches the driver, and the joins read plain scans, so AQE can
    split the rows of a hub node.  Self-loops, repeated and null edges are
    ignored; an empty edge list gives an empty table.
    """
    e = edges.select(F.col(a).cast("bigint").alias("a"), F.col(b).cast("bigint").alias("b"))
    # orientation: a > b, b is the smaller end
    e = (e.where(F.col("a") != F.col("b"))
         .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    e = materialize(e, "cc-edges")
    before = _checksum(e)
    while before[0]:
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: every larger neighbour v of u is linked to u's minimum
        m = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "cc-min")
        large = (both.where(F.col("b") > F.col("a")).join(m, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        e = materialize(large, "cc-large")
        # small star: u and its smaller neighbours are linked to the smallest one
        m = materialize(e.groupBy("a").agg(F.min("b").alias("m")), "cc-min")
        small = (e.join(m, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionAll(m.select("a", F.col("m").alias("b"))).distinct())
        e = materialize(small, "cc-small")
        after = _checksum(e)
        if after == before:
            break
        before = after
    return (e.select(F.col("a").alias("id"), F.col("b").alias("component"))
            .unionAll(e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()))
