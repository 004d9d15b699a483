"""Parquet tables of a test scale factor (``<sf_dir>/<name>.parquet``).

Readers return lazy DataFrames: Catalyst prunes columns and pushes filters
into the Parquet scan, so callers should simply ``select``/``where`` what
they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


class Tables:
    """Attribute access to the tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)

    def register_views(self, names=TABLES) -> None:
        """Temp views named after the tables, for ``spark.sql``."""
        for n in names:
            read_table(self.spark, self.sf_dir, n).createOrReplaceTempView(n)

