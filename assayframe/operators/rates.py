"""Rates and hit counts per group.

``group_rate`` covers the hazard rates (hits among decided flags, optional
cut-off) and the audit rates (share of rows with an Unknown reading or an NA
flag). ``group_hits`` covers the rankings by number of YES flags. All are
``sum``/``count`` aggregates: partial per task, one shuffle, O(1) per group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.functions.values import NO_LIMIT, UNKNOWN
from assayframe.operators.classify import NO, YES


COUNTS = ("rows", "yes", "decided", "na", "unknown")


def ci_equals(col: str, value: str) -> Column:
    """Case-insensitive equality."""
    return F.lower(F.col(col)) == value.lower()


def is_yes(flag: str = "flag") -> Column:
    return ci_equals(flag, YES)


def is_decided(flag: str = "flag") -> Column:
    return F.lower(F.col(flag)).isin(YES.lower(), NO.lower())


def is_na(flag: str = "flag") -> Column:
    return ci_equals(flag, NO_LIMIT)


def is_unknown(reading: str = "reading") -> Column:
    return ci_equals(reading, UNKNOWN)


def group_rate(df: DataFrame, key, hit: Column, among: Column | None = None, min_rate: float | None = None,
               out: str = "rate", with_counts: bool = False) -> DataFrame:
    """``hits / rows`` per group over the rows selected by ``among`` (all rows
    when None; groups without such rows are absent); groups at or below
    ``min_rate`` are dropped (strict ``>``)."""
    keys = [key] if isinstance(key, str) else list(key)
    # Conditional counts instead of a row filter: a filter on a computed
    # column (such as the flag) is pushed under the projection that computes
    # it and would evaluate the expression twice per row.
    if among is None:
        agg = df.groupBy(*keys).agg(F.count_if(hit).alias("hits"), F.count(F.lit(1)).alias("rows"))
    else:
        agg = (df.groupBy(*keys).agg(F.count_if(among & hit).alias("hits"), F.count_if(among).alias("rows"))
                 .where(F.col("rows") > 0))
    res = agg.withColumn(out, F.col("hits").cast("double") / F.col("rows"))
    if min_rate is not None:
        res = res.where(F.col(out) > F.lit(float(min_rate)))
    return res.select(*keys, out, *(["hits", "rows"] if with_counts else []))


def hazard_rate(df: DataFrame, key, flag: str = "flag", min_rate: float | None = None, out: str = "rate") -> DataFrame:
    """YES / (YES + NO) per group; NA rows are left out of the denominator."""
    return group_rate(df, key, is_yes(flag), among=is_decided(flag), min_rate=min_rate, out=out)


def unknown_rate(df: DataFrame, key, reading: str = "reading", out: str = "rate") -> DataFrame:
    """Share of all rows whose reading is Unknown (any case)."""
    return group_rate(df, key, is_unknown(reading), out=out)


def na_rate(df: DataFrame, key, flag: str = "flag", out: str = "rate") -> DataFrame:
    """Share of all rows whose flag is NA (any case)."""
    return group_rate(df, key, is_na(flag), out=out)


def group_hits(df: DataFrame, key, hit: Column, out: str = "n") -> DataFrame:
    """Number of rows with ``hit`` per group; every row counts, so groups with
    no hit are present with 0."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count_if(hit).alias(out))


def group_counts(df: DataFrame, keys) -> DataFrame:
    """``dimension, key, rows, yes, decided, na, unknown`` for several grouping
    columns in one pass; every rate is a ratio of two of them."""
    pairs = F.array(*[F.struct(F.lit(k).alias("dimension"), F.col(k).cast("string").alias("key")) for k in keys])
    return df.select(F.inline(pairs), "flag", "reading").groupBy("dimension", "key").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(is_yes()).alias("yes"), F.count_if(is_decided()).alias("decided"),
        F.count_if(is_na()).alias("na"), F.count_if(is_unknown()).alias("unknown"))


def rate_of_counts(counts: DataFrame, key: str, hits: str, among: str, above: float | None = None) -> DataFrame:
    """``key, rate`` of one grouping column from the counts: ``hits / among`` where
    ``among`` is above zero, rates at or below ``above`` dropped."""
    mine = counts.where((F.col("dimension") == key) & (F.col(among) > 0))
    rates = mine.select(F.col("key").alias(key), (F.col(hits).cast("double") / F.col(among)).alias("rate"))
    return rates.where(F.col("rate") > above) if above is not None else rates


def merge_counts(*counts: DataFrame) -> DataFrame:
    """The counts of several parts of the rows as those of all of them."""
    return reduce(DataFrame.unionByName, counts).groupBy("dimension", "key").agg(
        *[F.sum(c).alias(c) for c in COUNTS])
