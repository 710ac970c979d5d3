"""Every registered query against its DuckDB oracle (small scale factor),
plus properties that must hold between results."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from assayframe.operators import classify, group_rate, group_stats, limit_lookup
from assayframe.operators.rates import is_na, is_unknown
from assayframe.plans import fixtures as fx
from assayframe.plans.oracle import oracle
from assayframe.plans.queries import registry
from conftest import SF_SMALL

QUERIES = registry()
ORACLE = oracle()


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _bag(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in fx.TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_oracle_key_is_a_query():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["country", "rate"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [r.asDict() for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    want = [dict(zip(cols, r)) for r in cur.fetchall()]
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert _bag(got, cols) == _bag(want, cols)


def test_nested_distribution_matches_flat(spark):
    nested = QUERIES["category_per_analyte"](spark, SF_SMALL)
    pair = F.split(F.col("c"), ":")
    flat = nested.select("analyte", F.explode(F.split("counts", ",")).alias("c")).select(
        "analyte", pair[0].alias("category"), pair[1].cast("long").alias("n"))
    assert sorted(map(tuple, flat.collect())) == sorted(map(tuple, QUERIES["category_per_analyte_flat"](spark, SF_SMALL).collect()))


def test_rate_properties(spark):
    m = classify(limit_lookup(fx.measurements(spark, SF_SMALL), fx.measurement_limits(spark)))
    na = dict(map(tuple, group_rate(m, "category", is_na()).collect()))
    unk = dict(map(tuple, group_rate(m, "category", is_unknown()).collect()))
    assert all(na[k] >= unk[k] for k in na)          # an Unknown reading is always NA
    counts = m.groupBy("flag").count().collect()
    assert {r["flag"] for r in counts} <= {"YES", "NO", "NA"}
    assert sum(r["count"] for r in counts) == fx.measurements(spark, SF_SMALL).count()


def test_median_between_min_and_max(spark):
    m = fx.measurements(spark, SF_SMALL)
    st = group_stats(m, "maker", stats=("median",))
    bounds = (m.where(F.col("reading") != "Unknown")
               .groupBy("maker").agg(F.min(F.col("reading").cast("double")).alias("lo"),
                                     F.max(F.col("reading").cast("double")).alias("hi")))
    bad = st.join(bounds, "maker").where((F.col("median") < F.col("lo")) | (F.col("median") > F.col("hi")))
    assert bad.count() == 0


def test_cleaning_report_consistent(spark):
    rep = QUERIES["cleaning_report"](spark, SF_SMALL).collect()[0]
    assert rep["cleaned_records"] <= rep["raw_records"]
    assert rep["dropped"] == rep["raw_records"] - rep["cleaned_records"]
    clean = QUERIES["clean_records"](spark, SF_SMALL)
    assert clean.count() == rep["cleaned_records"]
    assert clean.where(F.col("flag") == "NA").count() == rep["na_flags"]
