"""Profiling and the cleaning report.

Every scalar result is one aggregate over one scan (the original ran one job
per number).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.functions.values import NO_LIMIT, UNKNOWN, profile_reading
from assayframe.operators.cleaning import CLEAN_ARITY, clean_columns, enrich, required_ok
from assayframe.sources.text import FIELDS, drop_header, parse_csv


def row_count(df: DataFrame, out: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(out))


def row_count_grouped(df: DataFrame, label: str = "records", key: str = "key", out: str = "n") -> DataFrame:
    """The count as a (label, n) pair, grouped on a constant key."""
    return df.groupBy(F.lit(label).alias(key)).agg(F.count(F.lit(1)).alias(out))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def value_count(df: DataFrame, col: str, value: str, out: str = "n") -> DataFrame:
    """Rows where ``col`` equals ``value`` ignoring case."""
    return df.agg(F.count_if(F.lower(F.col(col)) == value.lower()).alias(out))


def reading_range(df: DataFrame, reading: str = "reading", parsed: bool = False) -> DataFrame:
    """Count, min, max and mean of the valid numbers in ``reading`` (profiling
    rules, negatives kept); 0.0 for min/max/mean when there are none.
    ``parsed=True`` takes ``reading`` as already numeric."""
    v = F.col(reading) if parsed else profile_reading(F.col(reading))
    vals = df.select(v.alias("__v"))          # NULL = not valid; the aggregates skip it
    return vals.agg(
        F.count("__v").alias("n_valid"),
        F.coalesce(F.min("__v"), F.lit(0.0)).alias("min_reading"),
        F.coalesce(F.max("__v"), F.lit(0.0)).alias("max_reading"),
        F.coalesce(F.avg("__v"), F.lit(0.0)).alias("avg_reading"),
    )


def cleaning_report(lines: DataFrame, limits: DataFrame, synonyms: DataFrame | None = None,
                    header: str | None = None, line_col: str = "value", **lookup_kw) -> DataFrame:
    """One row: raw records (every non-header line, blank ones too), records
    after cleaning, dropped, Unknown readings, Unknown percent (truncated to
    an int, 0 when nothing is left) and NA flags — one pass over the input."""
    parsed = parse_csv(drop_header(lines, header, line_col), line_col)
    keep = (F.size(F.col(FIELDS)) > CLEAN_ARITY) & required_ok()
    marked = parsed.select(keep.alias("__kept"), *clean_columns())
    flagged = enrich(marked, limits, synonyms, **lookup_kw)
    kept = F.col("__kept")
    agg = flagged.agg(
        F.count(F.lit(1)).alias("raw_records"),
        F.count_if(kept).alias("cleaned_records"),
        F.count_if(kept & (F.col("reading") == UNKNOWN)).alias("unknown_readings"),
        F.count_if(kept & (F.col("flag") == NO_LIMIT)).alias("na_flags"),
    )
    pct = F.coalesce(F.try_divide(F.col("unknown_readings").cast("double"), F.col("cleaned_records")) * 100,
                     F.lit(0.0)).cast("int")
    return agg.select("raw_records", "cleaned_records",
                      (F.col("raw_records") - F.col("cleaned_records")).alias("dropped"),
                      "unknown_readings", pct.alias("unknown_percent"), "na_flags")
