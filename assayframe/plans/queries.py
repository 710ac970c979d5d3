"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the driver's tables.

Every computed column is aliased to the name the DuckDB oracle uses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe.functions.text import normalise_text
from assayframe.functions.values import clean_reading, standardise_missing
from assayframe.operators.alternatives import (
    authority_limits,
    completeness,
    completeness_weighted_rate,
    hazard_by_dual_label,
    hazard_rate_bounds,
    hazard_rate_by_authority,
    hazard_rate_imputed,
)
from assayframe.operators.classify import classify
from assayframe.operators.cleaning import (
    CLEAN_ARITY,
    PROFILE_ARITY,
    clean_records,
    required_fields,
    valid_readings,
)
from assayframe.operators.distribution import nested_distribution, pair_distribution, value_distribution
from assayframe.operators.draws import hazard_rate_drawn
from assayframe.operators.lookup import canonical_item, limit_lookup
from assayframe.operators.profile import (
    cleaning_report,
    distinct_values,
    reading_range,
    row_count,
    row_count_grouped,
    value_count,
)
from assayframe.operators.ranking import rank_by
from assayframe.operators.rates import group_hits, hazard_rate, is_yes, na_rate, unknown_rate
from assayframe.operators.rejects import accepted_records, reasons_report, rejected_lines, triage, write_triaged
from assayframe.operators.stats import group_stats, group_stats_by_each
from assayframe.plans import fixtures as fx
from assayframe.session import scratch_path
from assayframe.sources.clean import CLEAN_COLUMNS, preview, publish_clean, register_table, scan_clean, write_clean
from assayframe.sources.text import arity_guard, drop_header, field, fields_to_columns, parse_csv, scan_lines
from assayframe.streaming.clean_stream import clean_stream, read_line_stream, write_stream
from assayframe.streaming.rate_table import keep_counts, read_counts

Query = Callable[[SparkSession, str], DataFrame]
TOP_K = 20
ROUND = 6          # float sums differ in the last digits with row order
N_FLAT_FIELDS = 11


# ---------------------------------------------------------------- measurements
def _classified(spark, sf, typed=True):
    m = fx.measurements(spark, sf, typed)
    return classify(limit_lookup(m, fx.measurement_limits(spark)))


def q_limit_lookup(spark, sf):
    return limit_lookup(fx.measurements(spark, sf), fx.measurement_limits(spark))


def q_classify(spark, sf):
    return _classified(spark, sf, typed=False)


def q_hazard_rate_category(spark, sf):
    return rank_by(hazard_rate(_classified(spark, sf), "category"), "rate", "category", k=None)


def q_hazard_category_over_half(spark, sf):
    return rank_by(hazard_rate(_classified(spark, sf), "category", min_rate=0.5), "rate", "category", k=None)


def q_hazard_country_over_half(spark, sf):
    return rank_by(hazard_rate(_classified(spark, sf), "country", min_rate=0.5), "rate", "country", k=None)


def q_hazard_maker_over_half(spark, sf):
    return rank_by(hazard_rate(_classified(spark, sf), "maker", min_rate=0.5), "rate", "maker", k=None)


def q_top_makers(spark, sf):
    return rank_by(group_hits(_classified(spark, sf), "maker", is_yes()), "n", "maker", k=TOP_K)


def q_top_items(spark, sf):
    return rank_by(group_hits(_classified(spark, sf), "item", is_yes()), "n", "item", k=TOP_K)


def q_na_rate_category(spark, sf):
    return rank_by(na_rate(_classified(spark, sf), "category"), "rate", "category", k=None)


def q_na_rate_country(spark, sf):
    return rank_by(na_rate(_classified(spark, sf), "country"), "rate", "country", k=None)


def q_unknown_rate_category(spark, sf):
    return rank_by(unknown_rate(fx.measurements(spark, sf), "category"), "rate", "category", k=None)


def q_unknown_rate_country(spark, sf):
    return rank_by(unknown_rate(fx.measurements(spark, sf), "country"), "rate", "country", k=None)


def _stat_query(key: str, stat: str) -> Query:
    def q(spark, sf):
        res = group_stats(fx.measurements(spark, sf, typed=True), key, stats=(stat,), round_to=ROUND)
        return rank_by(res, stat, key, k=None)
    q.__name__ = f"q_{stat}_by_{key}"
    return q


def q_stats_by_each_key(spark, sf):
    """Mean, median, mode and σ by category, country and maker in one pass."""
    return group_stats_by_each(fx.measurements(spark, sf, typed=True), ["category", "country", "maker"], round_to=ROUND)


def q_top_k_groups(spark, sf):
    """The 20 makers with the highest mean reading."""
    res = group_stats(fx.measurements(spark, sf, typed=True), "maker", stats=("mean",), round_to=ROUND)
    return rank_by(res, "mean", "maker", k=TOP_K)


def q_analyte_distribution(spark, sf):
    return rank_by(value_distribution(fx.measurements(spark, sf), "analyte"), "n", "analyte", k=None)


def q_category_per_analyte_flat(spark, sf):
    return pair_distribution(fx.measurements(spark, sf), "analyte", "category")


def q_category_per_analyte(spark, sf):
    nested = nested_distribution(fx.measurements(spark, sf), "analyte", "category")
    entry = lambda c: F.concat(c["category"], F.lit(":"), c["n"])
    return nested.select("analyte", F.array_join(F.transform("counts", entry), ",").alias("counts"))


def q_value_count(spark, sf):
    return value_count(fx.measurements(spark, sf), "category", "promo")


def _distinct_query(col: str) -> Query:
    def q(spark, sf):
        return distinct_values(fx.measurements(spark, sf), col)
    q.__name__ = f"q_distinct_{col}"
    return q


def q_reading_range(spark, sf):
    return reading_range(fx.measurements(spark, sf)).withColumn("avg_reading", F.round("avg_reading", ROUND))


# ------------------------------------------------------------------ raw lines
def _lines(spark, sf):
    return scan_lines(spark, fx.raw_lines_path(spark, sf))


def _parsed(spark, sf):
    return parse_csv(drop_header(_lines(spark, sf), fx.RAW_HEADER))


def _flat(df: DataFrame) -> list:
    return [F.size("fields").alias("n_fields")] + [field(i).alias(f"f{i}") for i in range(N_FLAT_FIELDS)]


def q_scan_lines(spark, sf):
    return _lines(spark, sf)


def q_drop_header(spark, sf):
    return drop_header(_lines(spark, sf), fx.RAW_HEADER)


def q_parse_csv(spark, sf):
    p = _parsed(spark, sf)
    return p.select("value", *_flat(p))


def q_arity_guard(spark, sf):
    return arity_guard(_parsed(spark, sf), CLEAN_ARITY).select("value", F.size("fields").alias("n_fields"))


def q_required_fields(spark, sf):
    return required_fields(arity_guard(_parsed(spark, sf), CLEAN_ARITY)).select("value")


def q_standardise_missing(spark, sf):
    g = arity_guard(_parsed(spark, sf), CLEAN_ARITY)
    return g.select("value", standardise_missing(field(1)).alias("category"),
                    standardise_missing(field(7)).alias("country"),
                    standardise_missing(field(10)).alias("extra_10"))


def q_clean_reading(spark, sf):
    g = arity_guard(_parsed(spark, sf), CLEAN_ARITY)
    return g.select("value", clean_reading(field(4)).alias("reading"))


def _clean(spark, sf):
    return clean_records(_lines(spark, sf), fx.raw_limits(spark), fx.raw_synonyms(spark), header=fx.RAW_HEADER)


def q_clean_records(spark, sf):
    return _clean(spark, sf)


def q_valid_readings(spark, sf):
    return valid_readings(_lines(spark, sf), header=fx.RAW_HEADER, keep_line=True)


def q_row_count(spark, sf):
    return row_count(drop_header(_lines(spark, sf), fx.RAW_HEADER))


def q_row_count_grouped(spark, sf):
    return row_count_grouped(drop_header(_lines(spark, sf), fx.RAW_HEADER))


def q_cleaning_report(spark, sf):
    return cleaning_report(_lines(spark, sf), fx.raw_limits(spark), fx.raw_synonyms(spark), header=fx.RAW_HEADER)


def q_scan_clean(spark, sf):
    path = scratch_path(spark, "clean_parquet")
    write_clean(_clean(spark, sf), path, fmt="parquet")
    return scan_clean(spark, path, fmt="parquet")


def q_clean_published(spark, sf):
    """The cleaned records published over an older, partial version, read back typed."""
    path = scratch_path(spark, "clean_published")
    clean = _clean(spark, sf)
    publish_clean(clean.where("flag = 'YES'"), path)
    publish_clean(clean, path)
    back = scan_clean(spark, path, typed=True)
    return back.withColumn("reading_value", F.when(~F.isnan("reading_value"), F.col("reading_value")))   # NaN has no one text


def q_clean_roundtrip(spark, sf):
    path = scratch_path(spark, "clean_tsv")
    write_clean(_clean(spark, sf), path, fmt="tsv")
    return scan_clean(spark, path, fmt="tsv")


def q_preview(spark, sf):
    path = scratch_path(spark, "clean_table")
    write_clean(_clean(spark, sf), path, fmt="parquet")
    register_table(spark, "clean_measurements", path)
    return preview(spark, "clean_measurements", n=10, order_by="record_id")


def q_catalog_partitioned(spark, sf):
    """The cleaned records written by category and read back as a catalog table."""
    path = scratch_path(spark, "clean_by_category")
    write_clean(_clean(spark, sf), path, fmt="parquet", partition_by=["category"])
    return register_table(spark, "clean_by_category", path)


_TSV: dict[tuple[str, str], str] = {}


def _clean_tsv(spark, sf):
    """The cleaned records in the tab-separated layout, written once per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TSV:
        path = scratch_path(spark, "clean_tsv_audit")
        write_clean(_clean(spark, sf), path, fmt="tsv")
        _TSV[key] = path
    return scan_clean(spark, _TSV[key], fmt="tsv", min_fields=12)


def q_audit_unknown_rate_country_alt(spark, sf):
    """The audit as originally run: on the cleaned text output, records with
    more than 11 fields, country taken from the alternate column."""
    return rank_by(unknown_rate(_clean_tsv(spark, sf), "country_alt"), "rate", "country_alt", k=None)


def q_audit_na_rate_country_alt(spark, sf):
    return rank_by(na_rate(_clean_tsv(spark, sf), "country_alt"), "rate", "country_alt", k=None)


def _profiled(spark, sf):
    """Profiling reads the raw, uncleaned fields of records with > 7 fields."""
    return fields_to_columns(arity_guard(_parsed(spark, sf), PROFILE_ARITY), CLEAN_COLUMNS[:-1])


def q_profile_distinct_category(spark, sf):
    return distinct_values(_profiled(spark, sf), "category")


def q_profile_distinct_country(spark, sf):
    return distinct_values(_profiled(spark, sf), "country")


def q_profile_value_count(spark, sf):
    return value_count(_profiled(spark, sf), "category", "household")


def q_profile_reading_range(spark, sf):
    res = reading_range(_profiled(spark, sf))
    return res.withColumn("avg_reading", F.round("avg_reading", ROUND))


def q_stream_clean_records(spark, sf):
    """The cleaning job as a Structured Streaming query over the raw-line
    files (processed once with an available-now trigger), read back."""
    out = scratch_path(spark, "stream_clean")
    lines = read_line_stream(spark, fx.raw_lines_path(spark, sf))
    q = write_stream(clean_stream(lines, fx.raw_limits(spark), fx.raw_synonyms(spark), fx.RAW_HEADER), out)
    q.awaitTermination()
    return scan_clean(spark, out, fmt="parquet")


_TRIAGED: dict[tuple[str, str], str] = {}


def _triaged(spark, sf):
    """Accepted records and rejected lines of the raw text, written once per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TRIAGED:
        path = scratch_path(spark, "triaged")
        lines = scan_lines(spark, fx.raw_lines_path(spark, sf))
        write_triaged(triage(lines, fx.raw_limits(spark), fx.raw_synonyms(spark), header=fx.RAW_HEADER), path)
        _TRIAGED[key] = path
    return _TRIAGED[key]


def q_rejected_lines(spark, sf):
    return rejected_lines(spark, _triaged(spark, sf))


def q_rejected_by_rule(spark, sf):
    return reasons_report(spark, _triaged(spark, sf))


def q_accepted_records(spark, sf):
    return accepted_records(spark, _triaged(spark, sf))


def q_stream_rates(spark, sf):
    """Hazard, Unknown and NA rates by category, country and maker from counts that a
    stream of the raw-line files keeps in a durable table, one file a batch."""
    out = scratch_path(spark, "stream_counts")
    lines = read_line_stream(spark, fx.raw_lines_path(spark, sf), max_files_per_trigger=1)
    stream = clean_stream(lines, fx.raw_limits(spark), fx.raw_synonyms(spark), fx.RAW_HEADER)
    keep_counts(stream, out).awaitTermination()
    ratio = lambda hits, among: F.try_divide(F.col(hits).cast("double"), F.col(among))
    return read_counts(spark, out).select("dimension", "key", "rows", ratio("yes", "decided").alias("hazard"),
                                          ratio("unknown", "rows").alias("unknown"), ratio("na", "rows").alias("na"))


# ---------------------------------------------- alternatives (several limits …)
def q_hazard_rate_by_authority(spark, sf):
    limits = authority_limits(spark, fx.authority_limit_rows())
    return hazard_rate_by_authority(fx.measurements(spark, sf, typed=True), limits, "category")


def q_hazard_by_dual_label(spark, sf):
    m = fx.measurements(spark, sf, typed=True).withColumnRenamed("item", "item_raw")
    m = canonical_item(m, fx.part_synonyms(spark), item="item_raw", out="item")
    return hazard_by_dual_label(classify(limit_lookup(m, fx.measurement_limits(spark))))


def q_completeness_by_country(spark, sf):
    return completeness(_classified(spark, sf), "country")


def q_completeness_weighted_rate(spark, sf):
    res = completeness_weighted_rate(completeness(_classified(spark, sf), "country"))
    return res.select(F.round("weighted_rate", ROUND).alias("weighted_rate"),
                      F.round("unweighted_rate", ROUND).alias("unweighted_rate"), "groups")


def q_hazard_rate_bounds_country(spark, sf):
    return hazard_rate_bounds(_classified(spark, sf), "country")


def q_hazard_rate_imputed_category(spark, sf):
    m = limit_lookup(fx.measurements(spark, sf, typed=True), fx.measurement_limits(spark))
    return hazard_rate_imputed(m, "category")


def q_hazard_rate_drawn_country(spark, sf):
    """Unknown readings drawn from the known ones of their category."""
    m = limit_lookup(fx.measurements(spark, sf, typed=True), fx.measurement_limits(spark))
    return hazard_rate_drawn(m, "country", draw_by="category")


# ------------------------------------------------------------- text & labels
def q_normalise_text(spark, sf):
    docs = fx.table(spark, sf, "documents")
    return docs.select("doc_id", normalise_text("text").alias("text_norm"))


def q_canonical_item(spark, sf):
    part = fx.table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("item"))
    return canonical_item(part, fx.part_synonyms(spark), item="item")


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {
        "limit_lookup": q_limit_lookup,
        "classify": q_classify,
        "hazard_rate_category": q_hazard_rate_category,
        "hazard_category_over_half": q_hazard_category_over_half,
        "hazard_country_over_half": q_hazard_country_over_half,
        "hazard_maker_over_half": q_hazard_maker_over_half,
        "top_makers": q_top_makers,
        "top_items": q_top_items,
        "na_rate_category": q_na_rate_category,
        "na_rate_country": q_na_rate_country,
        "unknown_rate_category": q_unknown_rate_category,
        "unknown_rate_country": q_unknown_rate_country,
    }
    for key in ("category", "country", "maker"):
        for stat in ("mean", "median", "mode"):
            q[f"{stat}_by_{key}"] = _stat_query(key, stat)
    q["stddev_by_category"] = _stat_query("category", "stddev")
    q["stats_by_each_key"] = q_stats_by_each_key
    q.update({
        "top_k_groups": q_top_k_groups,
        "analyte_distribution": q_analyte_distribution,
        "category_per_analyte_flat": q_category_per_analyte_flat,
        "category_per_analyte": q_category_per_analyte,
        "value_count": q_value_count,
        "distinct_category": _distinct_query("category"),
        "distinct_analyte": _distinct_query("analyte"),
        "distinct_maker": _distinct_query("maker"),
        "distinct_country": _distinct_query("country"),
        "reading_range": q_reading_range,
        "scan_lines": q_scan_lines,
        "drop_header": q_drop_header,
        "parse_csv": q_parse_csv,
        "arity_guard": q_arity_guard,
        "required_fields": q_required_fields,
        "standardise_missing": q_standardise_missing,
        "clean_reading": q_clean_reading,
        "clean_records": q_clean_records,
        "valid_readings": q_valid_readings,
        "row_count": q_row_count,
        "row_count_grouped": q_row_count_grouped,
        "cleaning_report": q_cleaning_report,
        "scan_clean": q_scan_clean,
        "clean_published": q_clean_published,
        "clean_roundtrip": q_clean_roundtrip,
        "preview": q_preview,
        "catalog_partitioned": q_catalog_partitioned,
        "profile_distinct_category": q_profile_distinct_category,
        "profile_distinct_country": q_profile_distinct_country,
        "profile_value_count": q_profile_value_count,
        "profile_reading_range": q_profile_reading_range,
        "stream_clean_records": q_stream_clean_records,
        "stream_rates": q_stream_rates,
        "rejected_lines": q_rejected_lines,
        "rejected_by_rule": q_rejected_by_rule,
        "accepted_records": q_accepted_records,
        "audit_unknown_rate_country_alt": q_audit_unknown_rate_country_alt,
        "audit_na_rate_country_alt": q_audit_na_rate_country_alt,
        "hazard_rate_by_authority": q_hazard_rate_by_authority,
        "hazard_by_dual_label": q_hazard_by_dual_label,
        "completeness_by_country": q_completeness_by_country,
        "completeness_weighted_rate": q_completeness_weighted_rate,
        "hazard_rate_bounds_country": q_hazard_rate_bounds_country,
        "hazard_rate_imputed_category": q_hazard_rate_imputed_category,
        "hazard_rate_drawn_country": q_hazard_rate_drawn_country,
        "normalise_text": q_normalise_text,
        "canonical_item": q_canonical_item,
    })
    return q
