"""Row counts per value and per pair of values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_distribution(df: DataFrame, key: str, out: str = "n") -> DataFrame:
    """Rows per value of ``key``."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def pair_distribution(df: DataFrame, outer: str, inner: str, out: str = "n") -> DataFrame:
    """Rows per (outer, inner) pair, flat."""
    return df.groupBy(outer, inner).agg(F.count(F.lit(1)).alias(out))


def nested_distribution(df: DataFrame, outer: str, inner: str, out: str = "n", list_col: str = "counts",
                        digits: int = 0) -> DataFrame:
    """``outer, counts``: per ``outer`` value the sorted list of (inner, n).

    With ``digits`` the lists are split, ``outer, part, counts``: ``part`` is the first
    ``digits`` hex digits of ``md5(inner)`` (null counts as the empty string), so a list
    holds about 16 ** -digits of the distinct inner values of its outer value; for an inner
    column with so many values that a list would not fit a row.

    Counting happens on the flat pairs first (partial aggregation): a list holds
    one entry per distinct value, never one per row."""
    pairs = pair_distribution(df, outer, inner, out)
    part = F.substr(F.md5(F.coalesce(F.col(inner).cast("string"), F.lit(""))), F.lit(1), F.lit(digits)).alias("part")
    entries = F.sort_array(F.collect_list(F.struct(F.col(inner), F.col(out)))).alias(list_col)
    return pairs.groupBy(outer, *([part] if digits else [])).agg(entries)
