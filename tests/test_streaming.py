"""The batch aggregates run unchanged on a file stream."""

from pyspark.sql import functions as F

from tessera.operators import aggregates as agg
from tessera.operators import text
from tessera.sources.tables import Tables
from tessera.streaming import run_incremental, stream_table
from tests.conftest import SF_SMALL


def test_streamed_histogram_equals_batch(spark, tmp_path):
    orders = Tables(spark, SF_SMALL).orders.select(F.col("o_orderpriority").alias("k"))
    src = str(tmp_path / "orders_stream")
    orders.repartition(4).write.parquet(src)       # four files arrive
    stream = stream_table(spark, src, orders.schema, max_files_per_trigger=1)
    seen = []
    q = run_incremental(stream, lambda df: agg.count_by_key(df, "k"),
                        lambda batch, _: seen.append(sorted(tuple(r) for r in batch.collect())),
                        str(tmp_path / "checkpoint"))
    try:
        q.processAllAvailable()
        got = seen[-1]
    finally:
        q.stop()
    want = sorted(tuple(r) for r in agg.count_by_key(orders, "k").collect())
    assert got == want


def test_streamed_word_count_equals_batch(spark, tmp_path):
    docs = Tables(spark, SF_SMALL).documents.select("text")
    src = str(tmp_path / "docs_stream")
    docs.repartition(3).write.parquet(src)
    seen = []

    def sink(batch, batch_id):
        seen.append(sorted(tuple(r) for r in batch.collect()))

    q = run_incremental(stream_table(spark, src, docs.schema, 1),
                        lambda df: text.word_count(df, "text"), sink, str(tmp_path / "checkpoint"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    want = sorted(tuple(r) for r in text.word_count(docs, "text").collect())
    assert seen and seen[-1] == want
