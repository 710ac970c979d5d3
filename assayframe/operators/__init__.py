"""DataFrame → DataFrame operators."""

from assayframe.operators.classify import classify, flag_expr
from assayframe.operators.cleaning import clean_records, enrich, required_fields, valid_readings
from assayframe.operators.distribution import nested_distribution, pair_distribution, value_distribution
from assayframe.operators.lookup import (
    DimensionError,
    canonical_item,
    limit_frame,
    limit_lookup,
    lookup,
    synonym_frame,
)
from assayframe.operators.profile import (
    cleaning_report,
    distinct_values,
    reading_range,
    row_count,
    row_count_grouped,
    value_count,
)
from assayframe.operators.ranking import rank_by
from assayframe.operators.rates import group_hits, group_rate, hazard_rate, is_yes, na_rate, unknown_rate
from assayframe.operators.stats import group_median, group_mode, group_stats, histogram

__all__ = [
    "DimensionError", "canonical_item", "classify", "clean_records", "cleaning_report", "distinct_values",
    "enrich", "flag_expr", "group_hits", "group_median", "group_mode", "group_rate", "group_stats",
    "hazard_rate", "histogram", "is_yes", "limit_frame", "limit_lookup", "lookup", "na_rate",
    "nested_distribution", "pair_distribution", "rank_by", "reading_range", "required_fields", "row_count",
    "row_count_grouped", "synonym_frame", "unknown_rate", "valid_readings", "value_count", "value_distribution",
]
