"""Operators for large-scale training-data preparation.

Nothing else in the library imports this subpackage.  Every operator takes
and returns DataFrames; see the module docstrings for the handling of nulls,
empty and very long texts, ties, repeated rows and empty tables.
"""
