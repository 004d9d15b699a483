"""Run a batch operator over a folder of arriving Parquet files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def stream_table(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None
                 ) -> DataFrame:
    """A streaming DataFrame over the Parquet files of ``path`` (schema is
    required for file streams)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def run_incremental(source: DataFrame, build: Callable[[DataFrame], DataFrame],
                    sink: Callable[[DataFrame, int], None], checkpoint: str,
                    output_mode: str = "complete") -> StreamingQuery:
    """Start ``build(source)`` as a streaming query.

    ``build`` is any keyed aggregate of this package (e.g.
    ``lambda df: count_by_key(df, 'k')``).  Results go to ``sink(batch_df,
    batch_id)`` via ``foreachBatch`` (idempotent writers recommended).
    ``checkpoint`` is a folder on the cluster's shared store: a query started
    again with it resumes where it stopped.
    """
    return (build(source).writeStream.outputMode(output_mode)
            .option("checkpointLocation", checkpoint).foreachBatch(sink).start())
