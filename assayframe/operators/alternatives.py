"""The alternatives the original documentation proposes but never codes:
several limit sets at once, statistics by original beside normalised label,
weights by completeness, and estimates instead of excluding unknowns.

All are compositions of the same lookups and aggregates: one scan, small
broadcast dimensions, one grouped aggregate; no row explosion of the facts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.functions.values import NO_LIMIT, UNKNOWN, number_of
from assayframe.operators.classify import NO, YES
from assayframe.operators.lookup import check_unique, limit_frame, lookup
from assayframe.operators.stats import _null_safe_on, group_moments, known_values
from assayframe.session import write_once


def authority_limits(spark, rows: Sequence[tuple[str, str, str, float]]) -> dict[str, DataFrame]:
    """Limit dimensions per authority from (authority, category_key,
    analyte_key, max_reading) rows; keys are checked per authority."""
    by_auth: dict[str, list] = {}
    for auth, cat, ana, lim in rows:
        by_auth.setdefault(str(auth), []).append((cat, ana, lim))
    return {a: limit_frame(spark, r) for a, r in sorted(by_auth.items())}


def value_flag(value: Column, limit: Column) -> Column:
    """YES / NO / NA from a numeric value (NULL = unknown) and a limit."""
    return (F.when(limit.isNull() | value.isNull(), F.lit(NO_LIMIT))
             .when(~F.isnan(value) & (value > limit), F.lit(YES))
             .otherwise(F.lit(NO)))


def hazard_rate_by_authority(df: DataFrame, limits: Mapping[str, DataFrame], key: str,
                             category: str = "category", analyte: str = "analyte", reading: str = "reading",
                             authority: str = "authority", min_rate: float | None = None) -> DataFrame:
    """YES / (YES + NO) per (authority, key). The limits become one dimension
    with a column per authority: one join, one aggregate over one scan, then the
    small per-key result is turned into long form."""
    value = number_of(df, reading)
    names, pair = list(limits), ["category_key", "analyte_key"]
    for a in names:
        if getattr(limits[a], "_assay_unique_rows", None) is None:
            check_unique(limits[a], pair, f"limits of {a}")
    every = reduce(DataFrame.unionByName, [
        limits[a].select(*pair, F.lit(i).alias("__a"), F.col("max_reading").cast("double").alias("__max"))
        for i, a in enumerate(names)])
    wide = every.groupBy(*pair).agg(*[F.max(F.when(F.col("__a") == i, F.col("__max"))).alias(f"__lim{i}")
                                      for i in range(len(names))])
    wide._assay_unique_rows = (tuple(pair), None)
    cur = lookup(df.select(key, category, analyte, value.alias("__value")), wide,
                 on=[(F.lower(F.col(category)), pair[0]), (F.lower(F.col(analyte)), pair[1])],
                 values=[(f"__lim{i}", f"__lim{i}") for i in range(len(names))], what="limits")
    flags = [value_flag(F.col("__value"), F.col(f"__lim{i}")) for i in range(len(names))]
    agg = cur.groupBy(key).agg(*[x for i, f in enumerate(flags) for x in (
        F.count_if(f == YES).alias(f"__yes{i}"), F.count_if(f.isin(YES, NO)).alias(f"__dec{i}"))])
    per_auth = F.explode(F.array(*[
        F.struct(F.lit(a).alias(authority), F.col(f"__yes{i}").alias("yes"), F.col(f"__dec{i}").alias("dec"))
        for i, a in enumerate(names)]))
    long = agg.select(key, per_auth.alias("__a")).where(F.col("__a.dec") > 0)
    res = long.select(F.col(f"__a.{authority}").alias(authority), key,
                      (F.col("__a.yes").cast("double") / F.col("__a.dec")).alias("rate"))
    return res.where(F.col("rate") > min_rate) if min_rate is not None else res


def hazard_by_dual_label(df: DataFrame, raw: str = "item_raw", label: str = "item", flag: str = "flag") -> DataFrame:
    """Rows, YES count and hazard rate per (original label, normalised label)."""
    decided = F.lower(F.col(flag)).isin(YES.lower(), NO.lower())
    yes = F.lower(F.col(flag)) == YES.lower()
    agg = df.groupBy(raw, label).agg(F.count(F.lit(1)).alias("n"), F.count_if(yes).alias("yes"),
                                     F.count_if(decided).alias("decided"))
    return agg.select(raw, label, "n", "yes",
                      F.when(F.col("decided") > 0, F.col("yes").cast("double") / F.col("decided")).alias("rate"))


def completeness(df: DataFrame, key: str, flag: str = "flag") -> DataFrame:
    """Per group: hazard rate among decided rows and completeness = decided
    share of all rows (the weight)."""
    f = F.lower(F.col(flag))
    agg = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), F.count_if(f == YES.lower()).alias("yes"),
                              F.count_if(f.isin(YES.lower(), NO.lower())).alias("decided"))
    return agg.where(F.col("decided") > 0).select(
        key, (F.col("yes").cast("double") / F.col("decided")).alias("rate"),
        (F.col("decided").cast("double") / F.col("rows")).alias("completeness"))


def completeness_weighted_rate(per_group: DataFrame) -> DataFrame:
    """One row: Σ completeness·rate / Σ completeness, the plain mean of the
    group rates, and the number of groups."""
    return per_group.agg(
        (F.sum(F.col("completeness") * F.col("rate")) / F.sum("completeness")).alias("weighted_rate"),
        F.avg("rate").alias("unweighted_rate"), F.count(F.lit(1)).alias("groups"))


def hazard_rate_bounds(df: DataFrame, key: str, reading: str = "reading", limit: str = "max_reading",
                       flag: str = "flag") -> DataFrame:
    """Among rows that have a limit: the rate if every Unknown reading were
    below its limit (low) and if every one were above it (high)."""
    has_limit = F.col(limit).isNotNull()
    f = F.col(flag)
    agg = df.where(has_limit).groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(f == YES).alias("yes"),
        F.count_if(F.col(reading) == UNKNOWN).alias("unknown"))
    return agg.select(key, (F.col("yes").cast("double") / F.col("n")).alias("rate_low"),
                      ((F.col("yes") + F.col("unknown")).cast("double") / F.col("n")).alias("rate_high"))


def impute_group_mean(df: DataFrame, key: str, reading: str = "reading", out: str = "value") -> DataFrame:
    """Numeric reading with each Unknown replaced by the mean of the known
    readings of its group. The means are one row per group, joined back, so
    no group is gathered in one task."""
    # One row per group, written once: its size in bytes is then known, and the
    # planner broadcasts it or joins by shuffle, where AQE splits a hot key.
    means = write_once(group_moments(known_values(df, key, reading), key, mean="__mean", stddev=None), "group-means")
    joined = df.join(means, _null_safe_on([key], df, means), "left").drop(means[key])
    return joined.withColumn(out, F.coalesce(number_of(df, reading), F.col("__mean"))).drop("__mean")


def hazard_rate_imputed(df: DataFrame, key: str, impute_by: str | None = None, reading: str = "reading",
                        limit: str = "max_reading") -> DataFrame:
    """Hazard rate per ``key`` after group-mean imputation (means taken per
    ``impute_by``, default ``key``)."""
    imp = impute_group_mean(df, impute_by or key, reading, out="__v")
    fl = value_flag(F.col("__v"), F.col(limit))
    agg = imp.groupBy(key).agg(F.count_if(fl == YES).alias("yes"), F.count_if(fl.isin(YES, NO)).alias("dec"))
    return agg.where(F.col("dec") > 0).select(key, (F.col("yes").cast("double") / F.col("dec")).alias("rate"))
