"""Structured Streaming forms of the cleaning job and the rates."""

from assayframe.streaming.clean_stream import clean_stream, read_line_stream, running_rate, write_rates, write_stream
from assayframe.streaming.rate_table import keep_counts, read_counts

__all__ = ["clean_stream", "keep_counts", "read_counts", "read_line_stream", "running_rate", "write_rates",
           "write_stream"]
