"""A training-corpus pipeline over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps, in
the columns it was given; the last one returns the packing.  ``run`` writes every
stage's result to the shared checkpoint folder and hands it on reread, so a lost
executor costs a reread.

1. toxicity: documents that score ``TOXIC_FROM`` or more go;
2. line dedup: lines that repeat an earlier line go, and documents left empty;
3. SimHash near-dedup: one document of each group stays;
4. benchmark decontamination: documents with a verified benchmark item go;
5. best-fit packing of what is left into token sequences.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from tessera.llm import decontamination, line_dedup, packing, simhash, toxicity  # noqa: E402
from tessera.session import materialize  # noqa: E402
from tessera.sources.tables import read_table  # noqa: E402


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents among those it is given."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

#: SQL cannot express the stages; the tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        df = materialize(stage(spark, df, sf_dir), f"pipeline-{name}")
    return df
