"""Registered queries of this subpackage and their DuckDB oracle SQL.

Every query runs over its whole intended table with production parameters.
Where SQL cannot express a query (``ORACLE_SQL`` has no entry) the tests hold
it against a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (decontamination, hnsw, licenses, line_dedup, lm, merkle, packing, periodic_runs, phrases, pii,
                         simhash, token_counts, toxicity)
from tessera.llm.common import crc32_mod
from tessera.sources.tables import read_table

TOXIC_FOLDS, LM_FOLDS, HELD_OUT = 4, 7, 2
PII_KEY = "example key, not a secret"


def op1_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.find_leaks(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


def op2_hnsw(spark: SparkSession, sf: str) -> DataFrame:
    vectors = read_table(spark, sf, "embeddings")
    return hnsw.search(hnsw.build_index(vectors), vectors.where(F.col("vec_id") % 50 == 0))


def op3_pii_pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with personal data: findings and the pseudonymised text."""
    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).alias(f"n_{kind}")

    docs = pii.pseudonymise(read_table(spark, sf, "documents").select("doc_id", "text"), PII_KEY)
    return docs.where(F.size("found") > 0).select(
        "doc_id", F.size("found").alias("n_found"),
        *map(count, pii.KINDS), "text")


def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    model = toxicity.fit(docs, read_table(spark, sf, "labels"),
                         learn_from=crc32_mod("doc_id", TOXIC_FOLDS) != HELD_OUT)
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(crc32_mod("doc_id", TOXIC_FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= toxicity.TOXIC_FROM).cast("int").alias("predicted"))


def op5_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf, "documents"))


def op6_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Three edits per document, derived from it: its first 40 characters are put
    in at one place, up to 25 characters go at another, and 8 are replaced at a
    third."""
    n = F.length(F.coalesce("text", F.lit("")))

    def edit(k: int, deleted: int, inserted) -> Column:
        place = F.pmod(F.xxhash64("doc_id", F.lit(k)), n + 1)
        return F.struct(place.alias("start"), F.lit(deleted).cast("bigint").alias("n_deleted"),
                        inserted.alias("inserted"))

    edits = F.array(edit(1, 0, F.substring("text", 1, 40)), edit(2, 25, F.lit("")),
                    edit(3, 8, F.lit(" an edit, 2026\n")))
    return token_counts.edit_and_count(read_table(spark, sf, "documents"), edits)


def op7_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.repeated_lines(read_table(spark, sf, "documents"))


def op8_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return lm.score(read_table(spark, sf, "documents"), crc32_mod("doc_id", LM_FOLDS) == HELD_OUT)


def op9_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(read_table(spark, sf, "documents"))


def op10_simhash(spark: SparkSession, sf: str) -> DataFrame:
    near = simhash.near_duplicates(read_table(spark, sf, "documents"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_merkle_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.edited_and_next(read_table(spark, sf, "documents"))


def op12_phrase_mining(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.top(phrases.collocations(read_table(spark, sf, "documents")))


def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    return periodic_runs.runs(read_table(spark, sf, "documents"), plant=True).drop("n_words")


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_hnsw": op2_hnsw,
    "op3_pii_pseudonyms": op3_pii_pseudonyms,
    "op4_toxicity": op4_toxicity,
    "op5_license_scan": op5_license_scan,
    "op6_token_counts": op6_token_counts,
    "op7_line_dedup": op7_line_dedup,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_simhash": op10_simhash,
    "op11_merkle_fingerprints": op11_merkle_fingerprints,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_periodic_runs": op13_periodic_runs,
    "pipeline": pipeline,
}

ORACLE_SQL: dict[str, str] = {
    "op5_license_scan": licenses.oracle_sql(),
}
