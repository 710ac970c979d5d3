"""Estimates of unknown readings by draws from what is known of their group.

The group mean puts all unknown readings of a group on one side of a limit. A draw takes
a known reading of the group instead, each as likely as it is frequent, and several draws
(seeds) tell how far the rate depends on chance.

A draw is a rank in the group's sorted known readings (NaN first: never above a limit).
A reading is above a limit exactly if its rank is beyond the readings that are not, so a
rate needs no value looked up: per (group, limit) the number of known readings and of those
above the limit say it all. They come from the group's histogram, joined with the few
limits that its unknown readings have; both are grouped counts with map-side combine, and
no group is sorted or gathered. The rank is a hash of (seed, row id) modulo the number of
known readings: a repeated run or a recomputed task draws the same.

Defined results: unknown readings with one row id share their draws; a null row id is the
id ``''``; a null group is a group; unknown readings of a group without a known reading,
and rows without a limit, are left out, as in the other hazard rates; a ``key`` without any other
row is absent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.functions.values import number_of
from assayframe.operators.stats import _join_on_keys, _keys, histogram
from assayframe.session import write_once

SEEDS = tuple(range(16))
_DIGITS = 13                # hex digits of a hash that become a whole number: 52 bits


def drawn_rank(seed: int, row_id, known) -> Column:
    """A whole number below ``known`` from (seed, row id), the same in every run."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(row_id).cast("string"), F.lit("")))
    number = F.conv(F.substring(F.md5(text.cast("binary")), 1, _DIGITS), 16, 10).cast("long")
    return F.pmod(number, known)


def counts_above(df: DataFrame, key, reading: str = "reading", limit: str = "max_reading") -> DataFrame:
    """Per group and limit of its unknown readings: ``known`` readings of the group and
    those ``above`` the limit. Groups without a known reading are absent."""
    keys = _keys(key)
    rows = df.select(*keys, number_of(df, reading).alias("__v"), F.col(limit).alias("__limit"))
    hist = write_once(histogram(rows.where(F.col("__v").isNotNull()), keys, "__v", "__n"), "draw-histogram")
    limits = write_once(rows.where(F.col("__v").isNull() & F.col("__limit").isNotNull()).select(*keys, "__limit").distinct(),
                        "draw-limits")
    over = ~F.isnan("__v") & (F.col("__v") > F.col("__limit"))
    return _join_on_keys(hist, limits, keys).groupBy(*keys, "__limit").agg(
        F.sum("__n").alias("known"), F.sum(F.when(over, F.col("__n")).otherwise(F.lit(0))).alias("above"))


def hazard_rate_drawn(df: DataFrame, key: str, draw_by=None, row_id: str = "record_id", seeds: Sequence[int] = SEEDS,
                      reading: str = "reading", limit: str = "max_reading") -> DataFrame:
    """Hazard rate per ``key`` with every unknown reading drawn from the known ones of its
    ``draw_by`` group (default ``key``): the mean over the seeds (``rate``), the least and
    the greatest of them (``rate_low``, ``rate_high``; with 16 seeds another draw lies between
    them with probability 15/17), and how many readings were drawn. All lie within
    ``hazard_rate_bounds`` of the same rows, if every reading is a number or ``Unknown``."""
    if not seeds:
        raise ValueError("no seeds")
    by = _keys(draw_by or key)
    odds = write_once(counts_above(df, by, reading, limit), "draw-odds")
    names = list(dict.fromkeys([key, *by]))
    rows = df.where(F.col(limit).isNotNull()).select(
        *names, F.col(row_id).alias("__id"), F.col(limit).alias("__limit"), number_of(df, reading).alias("__v"))
    joined = _with_odds(rows, odds, by)
    unknown = F.col("__v").isNull()
    yes = ~F.isnan("__v") & (F.col("__v") > F.col("__limit"))
    decided = ~unknown | F.col("known").isNotNull()
    drawn = [unknown & (drawn_rank(s, "__id", F.col("known")) >= F.col("known") - F.col("above")) for s in seeds]
    agg = joined.groupBy(key).agg(
        F.count_if(decided).alias("__n"), F.count_if(~unknown & yes).alias("__yes"),
        F.count_if(unknown & decided).alias("drawn"), *[F.count_if(d).alias(f"__d{i}") for i, d in enumerate(drawn)])
    each = F.array(*[(F.col("__yes") + F.col(f"__d{i}")).cast("double") / F.col("__n") for i in range(len(seeds))])
    total = sum((F.col(f"__d{i}") for i in range(len(seeds))), F.lit(0).cast("long"))
    mean = (F.col("__yes") * len(seeds) + total).cast("double") / (F.col("__n") * len(seeds))
    return agg.where(F.col("__n") > 0).select(key, mean.alias("rate"), F.array_min(each).alias("rate_low"),
                                              F.array_max(each).alias("rate_high"), "drawn")


def _with_odds(rows: DataFrame, odds: DataFrame, by: Sequence[str]) -> DataFrame:
    """Every row; unknown readings with ``known`` and ``above`` of their group and limit."""
    names = {k: f"__o{i}" for i, k in enumerate([*by, "__limit"])}
    right = odds.select(*[F.col(k).alias(n) for k, n in names.items()], "known", "above")
    cond = F.col("__v").isNull()
    for k, n in names.items():
        cond = cond & F.col(k).eqNullSafe(F.col(n))
    return rows.join(right, cond, "left").drop(*names.values())
