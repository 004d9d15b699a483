"""Data sources: the Parquet test tables and the native text formats."""

from tessera.sources.files import (
    FAILFAST,
    PERMISSIVE,
    id_table,
    read_adjacency,
    read_adjacency_nodes,
    read_customer_orders,
    read_item_titles,
    read_label_features,
    read_lines,
    read_names,
    read_people,
    read_ratings_dcolon,
    read_ratings_tsv,
    read_ratings_whitespace,
    read_weather,
    write_pairs,
)
from tessera.sources.tables import TABLES, Tables, read_table, table_path

__all__ = [
    "FAILFAST", "PERMISSIVE", "TABLES", "Tables", "id_table", "read_adjacency",
    "read_adjacency_nodes", "read_customer_orders", "read_item_titles",
    "read_label_features", "read_lines", "read_names", "read_people",
    "read_ratings_dcolon", "read_ratings_tsv", "read_ratings_whitespace",
    "read_table", "read_weather", "table_path", "write_pairs",
]
