"""The four original jobs as functions: profile raw text, clean and flag it
(writing the cleaned records), compute the statistics and rates, and audit
the cleaned output. Each returns DataFrames (named results) instead of
printing; callers ``show``, ``write`` or collect the small ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from assayframe.functions.values import NO_LIMIT, UNKNOWN, profile_reading
from assayframe.operators.cleaning import (
    CLEAN_ARITY,
    PROFILE_ARITY,
    READING_POSITION,
    clean_columns,
    enrich,
    required_fields,
)
from assayframe.operators.distribution import nested_distribution, value_distribution
from assayframe.operators.ranking import rank_by
from assayframe.operators.rates import group_counts, rate_of_counts
from assayframe.operators.stats import group_stats_by_each
from assayframe.session import write_once
from assayframe.sources.clean import CLEAN_COLUMNS, publish_clean, scan_clean
from assayframe.sources.text import (
    FIELDS,
    arity_guard,
    drop_header,
    field,
    fields_to_columns,
    first_line,
    parse_csv,
    scan_lines,
)

# --- fixed values: what the original jobs report ------------------------------
TOP = 20                         # rows shown per ranked result
COUNTED_CATEGORY = "Other"       # category counted by the profiling job
HAZARD_CUTOFF = 0.5              # countries and makers above this rate
# ---------------------------------------------------------------------------


def profile_job(spark: SparkSession, path: str, header: str | None = None) -> dict[str, DataFrame]:
    """Record counts, distinct values and the range of valid readings of the
    raw text (uncleaned fields, records with more than 7 fields)."""
    lines = drop_header(scan_lines(spark, path), header)
    # Two reads of the text: one for all counts, one for all distinct values.
    summary = write_once(profile_summary(parse_csv(lines)), "profile-summary")
    fields = fields_to_columns(arity_guard(parse_csv(lines), PROFILE_ARITY), CLEAN_COLUMNS[:-1])
    values = write_once(distinct_of_each(fields, ("category", "analyte", "maker", "country")), "profile-values")
    of = lambda c: values.where(F.col("column") == c).select(F.col("value").alias(c))
    return {
        "records": summary.select("n"),
        "records_grouped": summary.select(F.lit("records").alias("key"), "n"),
        "categories": of("category"),
        "other_count": summary.select(F.col("other_count").alias("n")),
        "analytes": of("analyte"),
        "makers": of("maker"),
        "countries": of("country"),
        "reading_range": summary.select("n_valid", "min_reading", "max_reading", "avg_reading"),
    }


def profile_summary(parsed: DataFrame) -> DataFrame:
    """One row: records, how often ``COUNTED_CATEGORY`` is the category, and the
    range of valid readings, in one aggregate over split lines."""
    wide = F.size(FIELDS) > PROFILE_ARITY
    return parsed.select(
        F.when(wide, F.lower(field(1))).alias("category"),
        F.when(wide, profile_reading(field(READING_POSITION))).alias("v")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("category") == COUNTED_CATEGORY.lower()).alias("other_count"),
        F.count("v").alias("n_valid"), F.coalesce(F.min("v"), F.lit(0.0)).alias("min_reading"),
        F.coalesce(F.max("v"), F.lit(0.0)).alias("max_reading"), F.coalesce(F.avg("v"), F.lit(0.0)).alias("avg_reading"))


def distinct_of_each(df: DataFrame, columns) -> DataFrame:
    """``column, value``: the distinct values of several columns in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.inline(pairs)).distinct()


def clean_job(spark: SparkSession, path: str, out_path: str, limits: DataFrame, synonyms: DataFrame | None,
              header: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Clean, normalise and flag the raw text, publish the cleaned records as the current
    ones of ``out_path``, and return the one-row cleaning report."""
    lines = scan_lines(spark, path)
    if header is None:
        header = first_line(lines)
    # The input is parsed once: records are counted while the cleaned ones are
    # written, and the report's other numbers are read back from the output.
    seen = Observation()
    parsed = parse_csv(drop_header(lines, header)).observe(seen, F.count(F.lit(1)).alias("raw_records"))
    kept = required_fields(arity_guard(parsed, CLEAN_ARITY))
    publish_clean(enrich(kept.select(*clean_columns()), limits, synonyms), out_path, fmt=fmt)
    counts = scan_clean(spark, out_path, fmt=fmt).agg(
        F.count(F.lit(1)).alias("cleaned_records"), F.count_if(F.col("reading") == UNKNOWN).alias("unknown_readings"),
        F.count_if(F.col("flag") == NO_LIMIT).alias("na_flags"))
    raw = F.lit(seen.get["raw_records"]).cast("long")
    pct = F.coalesce(F.try_divide(F.col("unknown_readings").cast("double"), F.col("cleaned_records")) * 100, F.lit(0.0))
    return counts.select(raw.alias("raw_records"), "cleaned_records", (raw - F.col("cleaned_records")).alias("dropped"),
                         "unknown_readings", pct.cast("int").alias("unknown_percent"), "na_flags")


def analytics_job(spark: SparkSession, clean_path: str, fmt: str = "parquet", k: int | None = TOP,
                  country: str = "country") -> dict[str, DataFrame]:
    """Statistics by category, country and maker; analyte distributions;
    hazard rates; the makers and items with the most YES flags."""
    df = scan_clean(spark, clean_path, fmt=fmt, typed=True)
    out: dict[str, DataFrame] = {}
    # All statistics for the three grouping columns in one pass, all rates and hits
    # in another; the results (one row per group) are written once so that each
    # ranked view reads them back.
    res = write_once(group_stats_by_each(df, ["category", country, "maker"]), "job-stats")
    counts = write_once(group_counts(df, ["category", country, "maker", "item"]), "job-counts")
    for key, stats in (("category", ("mean", "median", "mode", "stddev")), (country, ("mean", "median", "mode")),
                       ("maker", ("mean", "median", "mode"))):
        part = res.where(F.col("dimension") == key).select(F.col("key").alias(key), *stats)
        for stat in stats:
            out[f"{stat}_by_{key}"] = rank_by(part.select(key, stat), stat, key, k=k)
    out["analyte_distribution"] = rank_by(value_distribution(df, "analyte"), "n", "analyte", k=k)
    out["category_per_analyte"] = nested_distribution(df, "analyte", "category").orderBy("analyte")
    out["hazard_rate_category"] = rank_by(rate_of_counts(counts, "category", "yes", "decided"), "rate", "category", k=k)
    out["hazard_country_over_half"] = rank_by(
        rate_of_counts(counts, country, "yes", "decided", HAZARD_CUTOFF), "rate", country, k=k)
    out["hazard_maker_over_half"] = rank_by(
        rate_of_counts(counts, "maker", "yes", "decided", HAZARD_CUTOFF), "rate", "maker", k=k)
    for name, key in (("top_makers", "maker"), ("top_items", "item")):
        hits = counts.where(F.col("dimension") == key)      # groups without a YES count too
        out[name] = rank_by(hits.select(F.col("key").alias(key), F.col("yes").alias("n")), "n", key, k=k)
    return out


def audit_job(spark: SparkSession, clean_path: str, fmt: str = "parquet", k: int | None = TOP,
              country: str = "country_alt") -> dict[str, DataFrame]:
    """Share of Unknown readings and of NA flags by category and by country
    (the alternate country column, as the original audit read it), over
    complete cleaned records."""
    df = scan_clean(spark, clean_path, fmt=fmt, min_fields=12 if fmt == "tsv" else None)
    counts = write_once(group_counts(df, ["category", country]), "audit-counts")
    return {
        "unknown_rate_category": rank_by(rate_of_counts(counts, "category", "unknown", "rows"), "rate", "category", k=k),
        "unknown_rate_country": rank_by(rate_of_counts(counts, country, "unknown", "rows"), "rate", country, k=k),
        "na_rate_category": rank_by(rate_of_counts(counts, "category", "na", "rows"), "rate", "category", k=k),
        "na_rate_country": rank_by(rate_of_counts(counts, country, "na", "rows"), "rate", country, k=k),
    }
