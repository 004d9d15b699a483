"""Incremental execution of the batch operators.

The original jobs are batch only; nothing here adds an operator.  The
keyed aggregates (counts, sums, minima, word counts) are written against
plain DataFrames, so the same functions also run on a streaming DataFrame:
Spark keeps their partial aggregates in its state store and updates them
as new files arrive.
"""

from tessera.streaming.incremental import run_incremental, stream_table

__all__ = ["run_incremental", "stream_table"]
