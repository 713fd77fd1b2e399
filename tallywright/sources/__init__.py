"""Readers and writers for plain text, delimited files and key/value directories."""

from tallywright.sources.points import centroid_rows, read_centroids, read_points, read_seeds
from tallywright.sources.sinks import write_kv
from tallywright.sources.text import infer_csv_schema, read_checked_csv, read_lines, read_positional, read_table_csv, spread

__all__ = [
    "centroid_rows",
    "infer_csv_schema",
    "read_centroids",
    "read_checked_csv",
    "read_lines",
    "read_points",
    "read_positional",
    "read_seeds",
    "read_table_csv",
    "spread",
    "write_kv",
]
