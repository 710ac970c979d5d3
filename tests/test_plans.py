"""Plan shapes that the scale design depends on (checked before execution)."""

import re

import __spark_entry__ as entry
from conftest import SF_SMALL

QUERIES = entry.queries()


def plan(spark, name):
    return QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return re.findall(r"Exchange (\w+)", text)


def test_cleaning_is_narrow(spark):
    text = plan(spark, "clean_records")
    assert exchanges(text) and all(e.endswith("BroadcastMode") for e in exchanges(text))   # broadcasts only
    assert "BroadcastHashJoin" in text
    for shuffle in ("hashpartitioning", "rangepartitioning", "RoundRobinPartitioning", "SinglePartition"):
        assert shuffle not in text


def test_rates_shuffle_by_key_only(spark):
    text = plan(spark, "hazard_country_over_half")
    assert "SinglePartition" not in text
    assert re.search(r"hashpartitioning\(country", text)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_top_k_is_take_ordered(spark):
    text = plan(spark, "top_makers")
    assert "TakeOrderedAndProject" in text and "SinglePartition" not in text


def test_median_counts_small_groups_in_a_histogram(spark):
    """Groups of few distinct values: one weighted aggregate over the written histogram,
    no window, no range shuffle, no join."""
    text = plan(spark, "median_by_maker")
    assert "reading_value" not in text and "ReadSchema: struct<maker:string,v:double,n:bigint>" in text
    for node in ("Window", "SinglePartition", "Join"):
        assert node not in text, node


def test_mode_keeps_fixed_width_state(spark):
    text = plan(spark, "mode_by_maker")
    assert "HashAggregate" in text
    for node in ("ObjectHashAggregate", "SortAggregate", "SinglePartition", "Join"):
        assert node not in text, node


def test_scans_read_only_needed_columns(spark):
    text = plan(spark, "mean_by_maker")
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", text)
    lineitem = [s for s in schemas if "l_partkey" in s]
    assert lineitem, schemas
    for unused in ("l_shipdate", "l_tax", "l_extendedprice", "l_linestatus", "l_linenumber"):
        assert unused not in lineitem[0]
    assert re.search(r"PushedFilters: \[IsNotNull\(l_partkey\)", text)


def test_no_round_robin_shuffle(spark):
    for name in ("hazard_country_over_half", "normalise_text", "mean_by_maker", "reading_range", "clean_records"):
        assert "RoundRobinPartitioning" not in plan(spark, name)


def test_lines_are_split_once(spark):
    """One split per line and scan, however many conditions and columns use it."""
    for name in ("clean_records", "valid_readings", "profile_distinct_category"):
        text = plan(spark, name)
        assert text.count("Scan text") == 1
        assert len(re.findall(r"Generate inline\(", text)) >= 1
        assert text.count("array_join(") == 1, name


def test_statistics_scan_the_facts_once(spark):
    """The histogram is the only reader of the facts: what remains reads written tables."""
    from assayframe.operators.stats import group_stats_by_each
    from assayframe.plans import fixtures as fx
    facts = fx.measurements(spark, SF_SMALL)
    text = group_stats_by_each(facts, ["category", "maker"])._jdf.queryExecution().executedPlan().toString()
    assert "l_discount" not in text and "ReadSchema: struct<dimension:string,key:string,v:double,n:bigint" in text


def test_statistics_of_typed_tables_parse_nothing(spark):
    for name in ("mean_by_maker", "stddev_by_category", "hazard_rate_category", "hazard_rate_by_authority"):
        text = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "regexp_extract" not in text, name
