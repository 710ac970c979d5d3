"""Record cleaning: required-field filter, cleaned projection, full clean job,
and profiling's valid-number extraction.

The whole chain is narrow (no shuffle): scan → split → guard → filter →
project → two broadcast lookups → flag. One lazy DataFrame, one pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.functions.values import is_missing_required, profile_reading, standardise_missing, clean_reading
from assayframe.operators.classify import classify
from assayframe.operators.lookup import canonical_item, limit_lookup
from assayframe.sources.clean import CLEAN_COLUMNS
from assayframe.sources.text import FIELDS, arity_guard, drop_header, field, parse_csv

# --- fixed values: positions used by the cleaning job -----------------------
REQUIRED_POSITIONS = (1, 2, 3, 4)     # category, item, analyte, reading
ITEM_POSITION = 2
READING_POSITION = 4
CLEAN_ARITY = 10                       # keep records with more than 10 fields
PROFILE_ARITY = 7                      # profiling keeps more than 7
# ---------------------------------------------------------------------------


def required_ok(positions: Sequence[int] = REQUIRED_POSITIONS, mode: str = "all", fields: str = FIELDS) -> Column:
    """True when the required fields are present: ``all`` of them (default),
    or ``any`` of them (the earlier, looser rule)."""
    tests = [~is_missing_required(field(i, fields)) for i in positions]
    op = (lambda a, b: a & b) if mode == "all" else (lambda a, b: a | b)
    return reduce(op, tests)


def required_fields(df: DataFrame, positions: Sequence[int] = REQUIRED_POSITIONS, mode: str = "all",
                    fields: str = FIELDS) -> DataFrame:
    """Drop records whose required fields are blank, ``unknown`` or
    ``unknown or not stated`` (any case)."""
    return df.where(required_ok(positions, mode, fields))


def clean_columns(fields: str = FIELDS, names: Sequence[str] = CLEAN_COLUMNS[:-1]) -> list[Column]:
    """The 11 cleaned columns: every field standardised for missing words,
    except the item (standardised, then normalised later by the synonym step)
    and the reading (reading rules only)."""
    cols = []
    for i, name in enumerate(names):
        raw = field(i, fields)
        cols.append((clean_reading(raw) if i == READING_POSITION else standardise_missing(raw)).alias(name))
    return cols


def clean_records(lines: DataFrame, limits: DataFrame, synonyms: DataFrame | None = None,
                  header: str | None = None, line_col: str = "value", keep_line: bool = False,
                  **lookup_kw) -> DataFrame:
    """The cleaning job on raw lines → 12 named string columns (the last is the
    flag) plus ``max_reading``. ``header=None`` reads the first line."""
    parsed = parse_csv(drop_header(lines, header, line_col), line_col)
    kept = required_fields(arity_guard(parsed, CLEAN_ARITY))
    projected = kept.select(*([F.col(line_col)] if keep_line else []), *clean_columns())
    return enrich(projected, limits, synonyms, **lookup_kw)


def enrich(cleaned: DataFrame, limits: DataFrame, synonyms: DataFrame | None = None,
           item: str = "item", category: str = "category", analyte: str = "analyte", reading: str = "reading",
           **lookup_kw) -> DataFrame:
    """Normalise + canonicalise the item, look up the limit, append the flag."""
    df = canonical_item(cleaned, synonyms, item=item, **lookup_kw)
    df = limit_lookup(df, limits, category=category, analyte=analyte, **lookup_kw)
    return classify(df, reading=reading)


def valid_readings(lines: DataFrame, header: str | None = None, line_col: str = "value",
                   position: int = READING_POSITION, out: str = "reading_value",
                   keep_line: bool = False) -> DataFrame:
    """Profiling's numeric readings from raw lines: records with more than 7
    fields, reading parsed after stripping quotes and commas; text containing
    ``unknown`` or ``na`` is dropped; negatives stay."""
    parsed = arity_guard(parse_csv(drop_header(lines, header, line_col), line_col), PROFILE_ARITY)
    v = F.inline(F.array(F.struct(profile_reading(field(position)).alias(out))))     # parsed once, then filtered
    return parsed.select(*([F.col(line_col)] if keep_line else []), v).where(F.col(out).isNotNull())
