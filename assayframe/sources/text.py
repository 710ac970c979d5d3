"""Raw delimited text: scan lines, drop the header, split, guard arity.

Lines are read with ``spark.read.text`` (one row per line, blank lines kept,
splittable, so a large file is spread over many tasks). The CSV reader is not
used: it drops blank lines, which count as raw records here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe.functions.text import split_csv

LINE = "value"
FIELDS = "fields"
N_FIELDS = "n_fields"


def scan_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per text line, column ``value``."""
    return spark.read.text(path)


def first_line(lines: DataFrame, col: str = LINE) -> str:
    """The first line of the input (one small driver action). Only a single
    file has a first line: with several, the header must be given."""
    if len(lines.inputFiles()) > 1:
        raise ValueError("the input has several files: pass the header text")
    row = lines.select(col).first()
    return row[0] if row is not None else ""


def drop_header(lines: DataFrame, header: str | None = None, col: str = LINE) -> DataFrame:
    """Remove every line equal to the header (not only the first one)."""
    if header is None:
        header = first_line(lines, col)
    return lines.where(F.col(col) != F.lit(header))


def parse_csv(lines: DataFrame, col: str = LINE, out: str = FIELDS) -> DataFrame:
    """Add ``fields: array<string>``: the quote-aware split of ``col``."""
    # Behind a generator the split is evaluated once: filters on the fields
    # cannot be pushed below it, where each would hold a copy of the split.
    kept = lines.drop(out) if out in lines.columns else lines
    return kept.select("*", F.inline(F.array(F.struct(split_csv(F.col(col)).alias(out)))))


def arity_guard(df: DataFrame, more_than: int = 10, fields: str = FIELDS) -> DataFrame:
    """Keep records with more than ``more_than`` fields (10 when cleaning,
    7 when profiling, 11 for the audit of cleaned output)."""
    return df.where(F.size(F.col(fields)) > more_than)


def field(i: int, fields: str = FIELDS):
    """Field ``i`` of the split record, NULL when the record is shorter."""
    return F.get(F.col(fields), i)


def fields_to_columns(df: DataFrame, names: Sequence[str], fields: str = FIELDS,
                      keep: Sequence[str] = ()) -> DataFrame:
    """Name the positions: field ``i`` becomes column ``names[i]``."""
    return df.select(*keep, *[field(i, fields).alias(n) for i, n in enumerate(names)])
