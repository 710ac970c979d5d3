"""assayframe — measurement-quality analytics as Spark DataFrame operators.

Parse delimited text, drop incomplete records, standardise missing values and
readings, normalise labels through a synonym table, flag readings against a
table of limits, then summarise by any column.
"""

__version__ = "0.1.0"
