"""Per-group statistics of known readings: mean, exact median, mode and
population standard deviation.

Scale design (one group may hold a third of all rows):

* mean and σ alone are algebraic aggregates (partial + final), O(1) state per group.
* mode and median start from a value histogram ``(key, value, n)`` built by a
  spillable hash aggregate with map-side combine; a hot group shrinks to its
  distinct values. It is written once, and every requested statistic is taken
  from it, so the facts are scanned once.
* mode = greatest ``packed(n, value)``: one decimal per group in a hash aggregate, ties
  go to the smallest value.
* median of a group with up to ``LISTED`` distinct values: the histogram itself, merged
  in one task, which that number bounds. Of a larger group: radix selection. Values become
  order-preserving 64-bit codes; four rounds each count the next 16 bits of the codes that
  still can be the middle (a hash aggregate with map-side combine, spread over
  all tasks) and pick the digit that holds the rank, from at most 65,536 counts.
* several keys: one joint histogram, and a histogram per key rolled up from the smallest
  table that has it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.functions.codes import code_double, double_code, packed, packed_value
from assayframe.functions.values import UNKNOWN, parse_double, typed_name
from assayframe.session import write_once

STATS = ("mean", "median", "mode", "stddev")
LISTED = 1 << 16            # distinct values of a group that may meet in one task
DIGIT = 16                  # bits of a code that one round of radix selection settles


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _null_safe_on(keys: Sequence[str], left: DataFrame, right: DataFrame) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def _join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """All columns of ``left``, then those of ``right`` but the keys, matched null-safely."""
    named = {k: f"__right_{i}" for i, k in enumerate(keys)}
    renamed = right.select(*[F.col(k).alias(named.get(k, k)) for k in right.columns])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(named[k])) for k in keys])
    return left.join(renamed, cond, how).drop(*named.values())


def known_values(df: DataFrame, key, reading: str = "reading", out: str = "v") -> DataFrame:
    """Rows whose reading is known, with the value as double. A typed table
    (column ``reading_value`` beside ``reading``) has null there for what is not
    known, and nothing is parsed; else rows whose text is not ``Unknown`` (exact
    case), NULL for text that is not a number."""
    keys, typed = _keys(key), typed_name(reading)
    if typed in df.columns:
        return df.where(F.col(typed).isNotNull()).select(*keys, F.col(typed).alias(out))
    # Text that is not a number gives NULL, which every aggregate here skips;
    # no row filter on the parsed value (it would be parsed twice per row).
    return (df.where(F.col(reading) != UNKNOWN)
              .select(*keys, parse_double(F.col(reading)).alias(out)))


def histogram(values: DataFrame, key, value: str = "v", n: str = "n") -> DataFrame:
    """``(key…, value, n)``: how often each value occurs in each group (NULL
    included: readings that are known but not numbers)."""
    return values.groupBy(*_keys(key), value).agg(F.count(F.lit(1)).alias(n))


def group_moments(values: DataFrame, key, value: str = "v", mean: str | None = "mean",
                  stddev: str | None = "stddev") -> DataFrame:
    aggs = []
    if mean:
        aggs.append(F.avg(value).alias(mean))
    if stddev:
        aggs.append(F.stddev_pop(value).alias(stddev))
    return values.groupBy(*_keys(key)).agg(*aggs)


def group_mode(hist: DataFrame, key, value: str = "v", n: str = "n", out: str = "mode") -> DataFrame:
    """Most frequent value per group; ties → smallest value."""
    best = hist.where(F.col(value).isNotNull()).groupBy(*_keys(key)).agg(F.max(packed(n, value)).alias("__best"))
    return best.select(*_keys(key), packed_value("__best").alias(out))


def _middle(digits: Column, rank: Column) -> Column:
    """The digit that holds the rank in a sorted list of (digit, count), and the counts
    before it."""
    start = F.struct(F.lit(0).cast("long").alias("before"), F.lit(None).cast("long").alias("digit"))

    def step(found, x):
        here = found["digit"].isNull() & (found["before"] + x["n"] >= rank)
        return F.struct(F.when(found["digit"].isNull() & ~here, found["before"] + x["n"]).otherwise(found["before"]).alias("before"),
                        F.when(here, x["digit"]).otherwise(found["digit"]).alias("digit"))
    return F.aggregate(digits, start, step)


def radix_median(hist: DataFrame, key, value: str = "v", n: str = "n", out: str = "median") -> DataFrame:
    """Exact median per group by radix selection over the codes of the values (see
    module doc): no sort, no window, and at most 65,536 counts of a group in a task."""
    keys = _keys(key)
    sign = F.lit(-(1 << 63))
    rows = hist.where(F.col(value).isNotNull()).select(*keys, double_code(value).bitwiseXOR(sign).alias("__u"), F.col(n).alias("__n"))
    total = rows.groupBy(*keys).agg(F.sum("__n").alias("__t"))
    ranks = F.array_distinct(F.array(F.expr("(__t + 1) div 2"), F.expr("__t div 2 + 1")))
    state = write_once(total.select(*keys, F.explode(ranks).alias("__target")).select(
        *keys, "__target", F.col("__target").alias("__rank"), F.lit(0).cast("long").alias("__prefix")), "radix-state")
    for shift in range(64 - DIGIT, -1, -DIGIT):
        above = F.shiftrightunsigned("__u", shift + DIGIT) if shift + DIGIT < 64 else F.lit(0).cast("long")
        open_ = _join_on_keys(rows.withColumn("__prefix", above), state, [*keys, "__prefix"])
        digit = F.shiftrightunsigned("__u", shift).bitwiseAND(F.lit((1 << DIGIT) - 1))
        counts = open_.select(*keys, "__target", "__rank", "__prefix", digit.alias("digit"), "__n").groupBy(
            *keys, "__target", "__rank", "__prefix", "digit").agg(F.sum("__n").alias("n"))
        lists = counts.groupBy(*keys, "__target", "__rank", "__prefix").agg(
            F.sort_array(F.collect_list(F.struct("digit", "n"))).alias("__d"))
        found = lists.withColumn("__f", _middle(F.col("__d"), F.col("__rank")))
        state = write_once(found.select(
            *keys, "__target", (F.col("__rank") - F.col("__f.before")).alias("__rank"),
            F.shiftleft("__prefix", DIGIT).bitwiseOR(F.col("__f.digit")).alias("__prefix")), "radix-state")
    v = code_double(F.col("__prefix").bitwiseXOR(sign))
    ends = state.groupBy(*keys).agg(F.min_by(v, "__target").alias("__lo"), F.max_by(v, "__target").alias("__hi"), F.count("*").alias("__c"))
    return ends.select(*keys, F.when(F.col("__c") == 1, F.col("__lo")).otherwise((F.col("__lo") + F.col("__hi")) / 2.0).alias(out))


def _large_groups(hist: DataFrame, keys: Sequence[str], value: str = "v") -> DataFrame:
    """Groups with more distinct values than may meet in one task."""
    return hist.groupBy(*keys).agg(F.count(value).alias("__distinct")).where(F.col("__distinct") > LISTED)


def group_median(hist: DataFrame, key, value: str = "v", n: str = "n", out: str = "median") -> DataFrame:
    """Exact median per group from a written histogram (mean of the two middle values for
    an even count)."""
    return _from_histogram(hist, _keys(key), ("median",), {"median": out}, value, n).where(F.col(out).isNotNull())


def _from_histogram(hist: DataFrame, keys: Sequence[str], stats: Sequence[str], names: dict, value: str = "v",
                    n: str = "n") -> DataFrame:
    """The statistics of every group of a written histogram, NULL for groups without
    numbers. All but σ and the medians of large groups come from one aggregate."""
    number = F.col(value).isNotNull()
    aggs, large = [], None
    if {"mean", "stddev"} & set(stats):
        aggs.append((F.sum(F.col(value) * F.col(n)) / F.sum(F.when(number, F.col(n)))).alias("__mean"))
    if "mode" in stats:
        aggs.append(F.max(F.when(number, packed(n, value))).alias("__mode"))
    rows = hist
    if "median" in stats:
        large = write_once(_large_groups(hist, keys, value), "large-groups")
        if large.isEmpty():
            large, listed = None, F.col(value)
        else:
            rows = _join_on_keys(hist, large, keys, "left")
            listed = F.when(F.col("__distinct").isNull(), F.col(value))
        aggs.append(F.percentile(listed, F.lit(0.5), F.col(n)).alias("__median"))
    out = rows.groupBy(*keys).agg(*(aggs or [F.count(F.lit(1)).alias("__rows")]))
    if large is not None:
        theirs = radix_median(_join_on_keys(hist, large, keys), keys, value, n, out="__radix")
        out = _join_on_keys(out, theirs, keys, "left").withColumn("__median", F.coalesce("__radix", "__median"))
    if "stddev" in stats:
        out = write_once(out, "group-stats")    # small, and read twice
        both = _join_on_keys(hist, out.select(*keys, "__mean"), keys)
        far = F.col(n) * (F.col(value) - F.col("__mean")) * (F.col(value) - F.col("__mean"))
        spread = both.groupBy(*keys).agg(F.sqrt(F.sum(far) / F.sum(F.when(number, F.col(n)))).alias("__stddev"))
        out = _join_on_keys(out, spread, keys, "left")
    of = {"mean": F.col("__mean"), "stddev": F.col("__stddev"), "median": F.col("__median"),
          "mode": packed_value("__mode") if "mode" in stats else None}
    return out.select(*keys, *[of[x].alias(names[x]) for x in STATS if x in stats])


def group_stats(df: DataFrame, key, stats: Sequence[str] = STATS, reading: str = "reading",
                round_to: int | None = None, names: dict | None = None) -> DataFrame:
    """One row per group of known readings with the requested statistics
    (``mean``, ``median``, ``mode``, ``stddev`` — population form). A group whose
    known readings are all not numbers has NULLs, whichever are requested."""
    keys = _keys(key)
    names = {s: s for s in STATS} | (names or {})
    unknown = set(stats) - set(STATS)
    if unknown:
        raise ValueError(f"unknown statistics {sorted(unknown)}")
    values = known_values(df, keys, reading)
    if not {"median", "mode"} & set(stats):
        out = group_moments(values, keys, mean=names["mean"] if "mean" in stats else None,
                            stddev=names["stddev"] if "stddev" in stats else None)
    else:
        out = _from_histogram(write_once(histogram(values, keys), "histogram"), keys, stats, names)
    return _rounded(out, stats, names, round_to).select(*keys, *[names[x] for x in STATS if x in stats])


def _rounded(out: DataFrame, stats: Sequence[str], names: dict, round_to: int | None) -> DataFrame:
    for x in ("mean", "stddev"):
        if round_to is not None and x in stats:
            out = out.withColumn(names[x], F.round(names[x], round_to))
    return out


def roll_ups(joint: DataFrame, keys: Sequence[str], value: str = "v", n: str = "n") -> dict[str, DataFrame]:
    """A histogram per key from a written joint histogram over all keys. The key with the
    most values is rolled up first and then summed out, so each key's parent is the
    smallest table that still has it; the numbers of values are measured."""
    sizes = joint.agg(*[F.approx_count_distinct(F.col(k)).alias(f"c{i}") for i, k in enumerate(keys)]).first()
    order = [k for _, k in sorted(((sizes[f"c{i}"], i), k) for i, k in enumerate(keys))]
    parent, out = joint, {}
    while order:
        k = order.pop()
        out[k] = parent.groupBy(k, value).agg(F.sum(n).alias(n))
        if order:
            parent = parent.groupBy(*order, value).agg(F.sum(n).alias(n))
    return out


def group_stats_by_each(df: DataFrame, keys: Sequence[str], stats: Sequence[str] = STATS, reading: str = "reading",
                        round_to: int | None = None, dimension: str = "dimension", key: str = "key") -> DataFrame:
    """Statistics for several grouping columns in one pass over the facts, in long form
    ``(dimension, key, stats…)``: one joint histogram of all columns is written, and each
    column's histogram rolled up from it, so no fact is repeated. Key values are
    compared as text."""
    keys = list(dict.fromkeys(keys))
    named = {k: f"__key_{i}" for i, k in enumerate(keys)}
    facts = known_values(df, keys, reading, out="v").select(
        *[F.col(k).cast("string").alias(c) for k, c in named.items()], "v")
    joint = write_once(histogram(facts, list(named.values())), "joint-histogram")
    each = roll_ups(joint, list(named.values()))
    long = reduce(DataFrame.unionAll, [
        each[c].select(F.lit(k).alias(dimension), F.col(c).alias(key), "v", "n") for k, c in named.items()])
    hist = write_once(long, "histogram")
    names = {x: x for x in STATS}
    out = _from_histogram(hist, [dimension, key], stats, names)
    return _rounded(out, stats, names, round_to).select(dimension, key, *[x for x in STATS if x in stats])
