"""Judge each reading against its limit: YES / NO / NA."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.functions.values import NO_LIMIT, UNKNOWN, parse_double, typed_name

YES, NO = "YES", "NO"


def flag_expr(reading: str = "reading", limit: str = "max_reading", value: Column | None = None) -> Column:
    """NA when there is no limit, the reading is ``Unknown`` or not a number;
    YES when the value is strictly above the limit; else NO. NaN is never
    above a limit (Spark orders NaN above every number, so test it first). ``value``
    is the number of the reading, where it is at hand; else the text is parsed."""
    v = parse_double(F.col(reading)) if value is None else value
    lim = F.col(limit)
    return (
        F.when(lim.isNull() | (F.col(reading) == UNKNOWN) | v.isNull(), F.lit(NO_LIMIT))
        .when(~F.isnan(v) & (v > lim), F.lit(YES))
        .otherwise(F.lit(NO))
    )


def classify(df: DataFrame, reading: str = "reading", limit: str = "max_reading", out: str = "flag",
             keep_limit: bool = True) -> DataFrame:
    """Append the flag column (after ``limit_lookup``)."""
    typed = typed_name(reading)
    df = df.withColumn(out, flag_expr(reading, limit, F.col(typed) if typed in df.columns else None))
    return df if keep_limit else df.drop(limit)
