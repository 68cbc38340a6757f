"""Reading, checking, shaping and writing order data."""

from .contract import COLUMNS, HEADER_PREFIX, require_columns, require_width
from .csv import classify_lines, parse_lines, read_lines, read_permissive, read_strict
from .prepare import cancellation_rows, spread_rows, style_rows, window_rows
from .sinks import land, read_partitions, write_parquet, write_partitions, write_text

__all__ = [
    "COLUMNS",
    "HEADER_PREFIX",
    "cancellation_rows",
    "classify_lines",
    "land",
    "parse_lines",
    "read_lines",
    "read_partitions",
    "read_permissive",
    "read_strict",
    "require_columns",
    "require_width",
    "spread_rows",
    "style_rows",
    "window_rows",
    "write_parquet",
    "write_partitions",
    "write_text",
]
