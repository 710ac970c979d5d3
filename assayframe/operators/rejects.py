"""Why a line was dropped, and the cleaning job with its rejected lines kept.

Every raw line (all but header lines) gets the first rule it fails, in the order in which
the job applies them: the number of fields, then each required field from left to right.
``write_triaged`` writes accepted records and rejected lines in one pass over the input
and counts them by rule on the way, so the counts add up to the lines read.

A null line fails the first rule; repeated lines count each time; without lines every
count is zero. Columns beside the line are not carried along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.functions.values import NO_LIMIT, UNKNOWN, is_missing_required
from assayframe.operators.cleaning import CLEAN_ARITY, REQUIRED_POSITIONS, clean_columns, enrich
from assayframe.sources.clean import CLEAN_COLUMNS, READING, TYPED, current_folder, publish, typed_column
from assayframe.sources.text import FIELDS, drop_header, field, parse_csv

TOO_FEW = "too_few_fields"
OUTCOME, ACCEPTED, REJECTED = "outcome", "accepted", "rejected"


def rules(positions: Sequence[int] = REQUIRED_POSITIONS) -> list[str]:
    """Names of the rules in the order in which they are tried."""
    return [TOO_FEW, *[f"missing_{CLEAN_COLUMNS[i]}" for i in positions]]


def reject_reason(positions: Sequence[int] = REQUIRED_POSITIONS, more_than: int = CLEAN_ARITY,
                  fields: str = FIELDS) -> Column:
    """The first rule that a split line fails, NULL for an accepted one."""
    enough = F.size(F.col(fields)) > more_than
    reason = F.when(F.col(fields).isNull() | ~enough, F.lit(TOO_FEW))
    for i, name in zip(positions, rules(positions)[1:]):
        reason = reason.when(is_missing_required(field(i, fields)), F.lit(name))
    return reason


def triage(lines: DataFrame, limits: DataFrame, synonyms: DataFrame | None = None, header: str | None = None,
           line_col: str = "value", **lookup_kw) -> DataFrame:
    """Every raw line once: ``reason`` (NULL: accepted), the twelve cleaned columns and
    ``max_reading`` of an accepted record (NULL for a rejected line), and ``line``, the
    text of a rejected one (NULL for an accepted record). One pass, no shuffle."""
    if header is not None:
        # drop_header drops null lines with the header; here they are rejected.
        body = lines.where(~F.col(line_col).eqNullSafe(F.lit(header)))
    else:
        body = drop_header(lines, header, line_col)
    marked = parse_csv(body.select(line_col), line_col).select(F.col(line_col).alias("line"), reject_reason().alias("reason"), *clean_columns())
    accepted = F.col("reason").isNull()
    kept = [F.when(accepted, F.col(c)).alias(c) for c in CLEAN_COLUMNS[:-1]]
    full = enrich(marked.select("reason", F.when(~accepted, F.col("line")).alias("line"), *kept), limits, synonyms, **lookup_kw)
    flag = F.when(F.col("reason").isNull(), F.col("flag")).alias("flag")
    return full.select("reason", "line", *CLEAN_COLUMNS[:-1], flag, "max_reading")


def write_triaged(triaged: DataFrame, path: str) -> dict[str, int]:
    """Publish accepted records and rejected lines below ``path`` in one write, and return
    what was counted on the way: ``raw_records``, ``cleaned_records``, ``dropped``, the
    lines by rule, ``unknown_readings`` and ``na_flags``."""
    seen = Observation()
    ok = F.col("reason").isNull()
    counted = triaged.observe(
        seen, F.count(F.lit(1)).alias("raw_records"), F.count_if(ok).alias("cleaned_records"),
        F.count_if(~ok).alias("dropped"), *[F.count_if(F.col("reason").eqNullSafe(r)).alias(r) for r in rules()],
        F.count_if(ok & (F.col(READING) == UNKNOWN)).alias("unknown_readings"),
        F.count_if(ok & (F.col("flag") == NO_LIMIT)).alias("na_flags"))
    outcome = F.when(ok, F.lit(ACCEPTED)).otherwise(F.lit(REJECTED)).alias(OUTCOME)
    out = counted.select("reason", "line", *CLEAN_COLUMNS, typed_column(triaged), outcome)
    publish(triaged.sparkSession, path, lambda folder: out.write.partitionBy(OUTCOME).parquet(folder))
    return {k: int(v) for k, v in seen.get.items()}


def _part(spark: SparkSession, path: str, outcome: str, columns: Sequence[str], typed: bool = False) -> DataFrame:
    schema = [T.StructField(c, T.StringType(), True) for c in columns]
    schema += [T.StructField(TYPED, T.DoubleType(), True)] if typed else []
    # Both parts by one path: a run without rejected lines has no folder for them.
    whole = spark.read.schema(T.StructType([*schema, T.StructField(OUTCOME, T.StringType())])).parquet(current_folder(spark, path))
    return whole.where(F.col(OUTCOME) == outcome).drop(OUTCOME)


def accepted_records(spark: SparkSession, path: str, typed: bool = False) -> DataFrame:
    """The cleaned records of ``write_triaged``, as ``scan_clean`` gives them."""
    return _part(spark, path, ACCEPTED, CLEAN_COLUMNS, typed)


def rejected_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line, reason`` of the lines that were dropped; only their files are read."""
    return _part(spark, path, REJECTED, ("line", "reason"))


def reasons_report(spark: SparkSession, path: str) -> DataFrame:
    """``reason, n``: every rule with the lines dropped by it, zeros included."""
    named = spark.range(1).select(F.explode(F.array(*[F.lit(r) for r in rules()])).alias("reason"))
    counts = rejected_lines(spark, path).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return named.join(counts, "reason", "left").select("reason", F.coalesce("n", F.lit(0).cast("long")).alias("n"))
