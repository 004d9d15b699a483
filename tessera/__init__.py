"""tessera: a Spark-first analytics engine.

Every job is a function from DataFrames (or a SparkSession plus table
locations) to a DataFrame.  All data work is expressed with the DataFrame /
SQL / Spark ML APIs so that Catalyst, AQE and whole-stage codegen choose the
physical plan; Python only builds plans and drives the bounded level loop of
the graph searches.
"""

from tessera.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
