"""Projection, arithmetic, filters and parameterised SQL over a table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def select_columns(df: DataFrame, *cols: str) -> DataFrame:
    """B1: projection (pruned down to the scan's ReadSchema)."""
    return df.select(*cols)


def plus_constant(df: DataFrame, keep: str, col: str, constant: int,
                  name: str | None = None) -> DataFrame:
    """B2: ``col + constant``.  Unaliased, Spark names it ``(col + c)``."""
    expr = F.col(col) + F.lit(constant)
    return df.select(keep, expr.alias(name) if name else expr)


def filter_less_than(df: DataFrame, col: str, bound) -> DataFrame:
    """``col < bound`` (pushed into the Parquet scan)."""
    return df.where(F.col(col) < F.lit(bound))


def sql_range(spark: SparkSession, df: DataFrame, col: str, lo, hi,
              view: str | None = None) -> DataFrame:
    """Register a view and run an inclusive range query in SQL.

    The bounds are named parameter markers, not string-formatted values.
    """
    name = view or f"t_{uuid.uuid4().hex[:10]}"
    df.createOrReplaceTempView(name)
    out = spark.sql(
        f"SELECT * FROM {name} WHERE `{col}` >= :lo AND `{col}` <= :hi",
        args={"lo": lo, "hi": hi})
    if view is None:  # the plan is resolved: the call's own view is not needed any more
        spark.catalog.dropTempView(name)
    return out
