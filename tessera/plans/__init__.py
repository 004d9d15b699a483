"""Query plans over the test tables: the catalogue of registered queries and
their DuckDB oracle SQL."""
