"""Sources and sinks: raw text lines, cleaned records, catalog tables."""

from assayframe.sources.clean import (
    CLEAN_COLUMNS,
    describe,
    preview,
    register_table,
    scan_clean,
    show_tables,
    write_clean,
)
from assayframe.sources.text import arity_guard, drop_header, fields_to_columns, first_line, parse_csv, scan_lines

__all__ = [
    "CLEAN_COLUMNS", "arity_guard", "describe", "drop_header", "fields_to_columns", "first_line", "parse_csv",
    "preview", "register_table", "scan_clean", "scan_lines", "show_tables", "write_clean",
]
