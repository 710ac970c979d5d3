"""Column-level building blocks (all Spark built-ins, no Python UDFs)."""

from assayframe.functions.text import jvm_trim, normalise_text, split_csv, split_csv_regex, strip_quotes
from assayframe.functions.values import (
    NO_LIMIT,
    UNKNOWN,
    clean_reading,
    is_missing_required,
    parse_double,
    profile_reading,
    reading_value,
    standardise_missing,
)

__all__ = [
    "NO_LIMIT", "UNKNOWN", "clean_reading", "is_missing_required", "jvm_trim", "normalise_text",
    "parse_double", "profile_reading", "reading_value", "split_csv", "split_csv_regex",
    "standardise_missing", "strip_quotes",
]
