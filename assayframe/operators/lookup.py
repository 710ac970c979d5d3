"""Dictionary lookups as left equi-joins: synonyms (item → canonical) and limits
((category, analyte) → max reading).

Dimension frames are checked for key uniqueness before use (a map literal keeps
one value per key, a join would fan out) and fail clearly on duplicates. A
dimension built from driver-side rows (``limit_frame``, ``synonym_frame``) is
checked on the driver; any other DataFrame gets one grouped-count job over the
dimension (never over the facts). Whether it is broadcast is left to the planner
and AQE, which go by bytes: rows may hold texts of any length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.functions.text import normalise_text

class DimensionError(ValueError):
    pass


def dimension_profile(dim: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """(rows, largest number of rows sharing one key) in one job over the
    dimension: a grouped count with map-side combine, then one row."""
    per_key = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("__c"))
    row = per_key.agg(F.sum("__c").alias("rows"), F.max("__c").alias("dup")).first()
    return int(row["rows"] or 0), int(row["dup"] or 0)


def check_unique(dim: DataFrame, keys: Sequence[str], what: str = "dimension") -> int:
    rows, dup = dimension_profile(dim, keys)
    if dup > 1:
        raise DimensionError(f"{what}: a key of {tuple(keys)} appears {dup} times; keys must be unique")
    return rows


def lookup(df: DataFrame, dim: DataFrame, on: Sequence[tuple[Column, str]], values: Sequence[tuple[str, str]],
           what: str = "dimension") -> DataFrame:
    """Left join ``df`` to ``dim``; ``on`` pairs a fact expression with a
    dimension key column, ``values`` maps dimension columns to output names.
    Rows of ``df`` are never duplicated or dropped: a repeated key fails. No join
    is forced; the planner broadcasts a dimension by its size in bytes."""
    keys = [k for _, k in on]
    proven = getattr(dim, "_assay_unique_rows", None)
    if proven is None or tuple(proven[0]) != tuple(keys):
        check_unique(dim, keys, what)
    tmp = {k: f"__lk_{i}" for i, k in enumerate(keys)}
    vtmp = {v: f"__lv_{i}" for i, (v, _) in enumerate(values)}
    d = dim.select(*[F.col(k).alias(tmp[k]) for k in keys], *[F.col(v).alias(vtmp[v]) for v, _ in values])
    left = df.select("*", *[expr.alias(f"__lf_{i}") for i, (expr, _) in enumerate(on)])
    cond = [F.col(f"__lf_{i}") == F.col(tmp[k]) for i, (_, k) in enumerate(on)]
    joined = left.join(d, cond, "left")
    out_cols = [F.col(f"`{c}`") for c in df.columns] + [F.col(vtmp[v]).alias(name) for v, name in values]
    return joined.select(*out_cols)


def limit_lookup(df: DataFrame, limits: DataFrame, category: str = "category", analyte: str = "analyte",
                 key_category: str = "category_key", key_analyte: str = "analyte_key",
                 limit: str = "max_reading", out: str = "max_reading", **kw) -> DataFrame:
    """Add ``out`` (nullable double): the limit for the lower-cased
    (category, analyte) pair. Dimension keys are used as given (lower case)."""
    return lookup(
        df, limits,
        on=[(F.lower(F.col(category)), key_category), (F.lower(F.col(analyte)), key_analyte)],
        values=[(limit, out)], what="limits", **kw,
    ).withColumn(out, F.col(out).cast("double"))


def canonical_item(df: DataFrame, synonyms: DataFrame | None, item: str = "item", out: str | None = None,
                   alias_col: str = "alias", canonical_col: str = "canonical",
                   normalise: bool = True, normalise_keys: bool = False, **kw) -> DataFrame:
    """Normalise ``item`` (unless ``normalise=False``) and replace it by its
    canonical name when the normalised text is a dictionary key; otherwise the
    normalised text stays. One step, not transitive.

    Keys are used as given, so a key holding characters that normalisation
    removes (a hyphen, say) never matches. ``normalise_keys=True`` normalises
    the keys too (they must still be unique afterwards)."""
    out = out or item
    text = normalise_text(F.col(item)) if normalise else F.col(item)
    if synonyms is None:
        return df.withColumn(out, text)
    if normalise_keys:
        synonyms = synonyms.select(normalise_text(F.col(alias_col)).alias(alias_col), F.col(canonical_col))
    staged = df.withColumn("__item_norm", text)
    joined = lookup(staged, synonyms, on=[(F.col("__item_norm"), alias_col)],
                    values=[(canonical_col, "__item_canon")], what="synonyms", **kw)
    return joined.withColumn(out, F.coalesce(F.col("__item_canon"), F.col("__item_norm"))) \
        .drop("__item_norm", "__item_canon")


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return f"CAST('{v!r}' AS DOUBLE)"
    if isinstance(v, int):
        return str(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_frame(spark, rows: Sequence[Sequence], columns: Sequence[str]) -> DataFrame:
    """A small table from Python rows as an inline ``VALUES`` relation: it
    lives in the plan (LocalTableScan, exact size statistics), with no Python
    worker and no RDD behind it."""
    if not rows:
        raise ValueError("empty dimension")
    body = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")


def keyed_frame(spark, rows: Sequence[Sequence], columns: Sequence[str], keys: Sequence[str],
                what: str = "dimension") -> DataFrame:
    """``literal_frame`` whose key columns are checked for uniqueness on the
    driver, so lookups need no Spark job for that."""
    idx = [list(columns).index(k) for k in keys]
    seen: set = set()
    for r in rows:
        k = tuple(r[i] for i in idx)
        if k in seen:
            raise DimensionError(f"{what}: key {k} appears more than once")
        seen.add(k)
    df = literal_frame(spark, rows, columns)
    df._assay_unique_rows = (tuple(keys), len(rows))
    return df


def synonym_frame(spark, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Two-column synonym dimension from (alias, canonical) pairs."""
    return keyed_frame(spark, [(str(a), str(c)) for a, c in pairs], ("alias", "canonical"), ("alias",), "synonyms")


def limit_frame(spark, rows: Sequence[tuple[str, str, float]]) -> DataFrame:
    """Three-column limit dimension from (category_key, analyte_key, max_reading) rows."""
    return keyed_frame(spark, [(str(a), str(b), float(c)) for a, b, c in rows],
                       ("category_key", "analyte_key", "max_reading"), ("category_key", "analyte_key"), "limits")

