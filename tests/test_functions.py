import math
import random

import pytest
from pyspark.sql import functions as F

from assayframe.functions import (
    clean_reading,
    is_missing_required,
    normalise_text,
    parse_double,
    profile_reading,
    split_csv,
    split_csv_regex,
    standardise_missing,
    strip_quotes,
)
from assayframe.functions.text import jvm_trim


def one_col(spark, values, expr_fn, in_type="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {in_type}")
    return [r[0] for r in df.select(expr_fn(F.col("v"))).collect()]


SPLIT_CASES = [
    ('1,"a, b",c', ["1", "a, b", "c"]),
    ('1, "x ""q"" y" ,z', ["1", 'x ""q"" y', "z"]),
    ("a,,", ["a", "", ""]),
    ("", [""]),
    ('"a,b', ["a", "b"]),
    ('a,"b,c,d', ['a,"b', "c", "d"]),
    ('  "unknown "  ,1', ["unknown ", "1"]),
    ("\ta\x0b, b\x00", ["a", "b"]),
    ("x\x1fy,a\x1eb,z", ["x\x1fy", "a\x1eb", "z"]),
    ("p\x1ee\x1es,q\x1e\x1es", ["p\x1ee\x1es", "q\x1e\x1es"]),
]


@pytest.mark.parametrize("line,fields", SPLIT_CASES)
def test_split_csv_edges(spark, line, fields):
    assert one_col(spark, [line], split_csv) == [fields]


def test_split_linear_equals_regex_on_random_lines(spark):
    rnd = random.Random(7)
    alphabet = ['a', ',', ' ', '"', '\t']
    lines = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 24))) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in lines], "v string")
    diff = df.where(F.to_json(split_csv("v")) != F.to_json(split_csv_regex("v"))).count()
    assert diff == 0


def test_split_many_quoted_fields_is_linear(spark):
    line = ",".join(['"x, y"'] * 20000)
    out = one_col(spark, [line], lambda c: F.size(split_csv(c)))
    assert out == [20000]


def test_strip_quotes_once_each_side(spark):
    assert one_col(spark, ['"', '""', '"""', '"a"', 'a"', '"a'], strip_quotes) == ["", "", '"', "a", "a", "a"]


def test_jvm_trim_removes_control_chars(spark):
    assert one_col(spark, ["\t\x0b a \n\x00", " b"], jvm_trim) == ["a", "b"]


MISSING = [
    ("", "Unknown"), ("   ", "Unknown"), ("UNKNOWN", "Unknown"), ("Unknown or not stated", "Unknown"),
    ("null", "Unknown"), ("N/A", "Unknown"), ("na", "Unknown"), ("unknown ", "Unknown"),
    ("Nathan", "Nathan"), ("  India\t", "India"), (None, "Unknown"),
]


def test_standardise_missing(spark):
    got = one_col(spark, [v for v, _ in MISSING], standardise_missing)
    assert got == [e for _, e in MISSING]


def test_required_field_words(spark):
    values = ["", "UNKNOWN", "Unknown or not stated", "null", "N/A", "na", "unknown ", "Nathan"]
    missing = one_col(spark, values, is_missing_required)
    assert missing == [True, True, True, False, False, False, False, False]


READINGS = [
    ("1,200.5", "1200.5"), ("1.0", "1.0"), ("-1", "Unknown"), ("-0.0", "-0.0"), ("<5", "Unknown"),
    ("1L", "Unknown"), ("nan", "Unknown"), ("inf", "Unknown"), ("NaN", "NaN"), ("Infinity", "Infinity"),
    ("1e3", "1e3"), ("1.5d", "1.5d"), ('"7"', "7"), (" 5 ", "5"), ("", "Unknown"), ("unknown", "Unknown"),
    ("-Infinity", "Unknown"), ("0x1p3", "0x1p3"), (".5", ".5"), ("5.", "5."),
]


def test_clean_reading(spark):
    assert one_col(spark, [v for v, _ in READINGS], clean_reading) == [e for _, e in READINGS]


def test_parse_double_jvm_grammar(spark):
    got = one_col(spark, ["1", "+2.5", ".5", "5.", "1e-3", "1.5f", "0x1p3", "0x.8p1", "NaN", "Infinity",
                          "nan", "inf", "1L", "1e", "--1", "1,0", " 3 "], parse_double)
    assert got[:8] == [1.0, 2.5, 0.5, 5.0, 0.001, 1.5, 8.0, 1.0]
    assert math.isnan(got[8]) and got[9] == math.inf
    assert got[10:16] == [None] * 6 and got[16] == 3.0


def test_profile_reading_keeps_negatives_rejects_na_text(spark):
    got = one_col(spark, ["-1", '"1,200"', "NaN", "n/a", "banana", "unknown", "", "Infinity", "3"], profile_reading)
    assert got == [-1.0, 1200.0, None, None, None, None, None, math.inf, 3.0]


NORMALISED = [
    ("  Goldroot (Marrow) Powder ", "goldroot powder"), ("Blue-Fennet", "bluefennet"),
    ("100% HIGHLAND\tpepperel", "100 highland pepperel"), ("a((b)c)", "ac"), ("红椒", ""),
    ("Chili  Powder\n(hot)\x0b", "chili powder"), ("Unknown", "unknown"),
]


def test_normalise_text(spark):
    assert one_col(spark, [v for v, _ in NORMALISED], normalise_text) == [e for _, e in NORMALISED]


def test_normalise_is_idempotent(spark):
    df = spark.createDataFrame([(v,) for v, _ in NORMALISED], "v string").select(normalise_text("v").alias("n"))
    assert df.where(normalise_text("n") != F.col("n")).count() == 0


def test_parse_double_fast_path_equals_grammar(spark):
    from assayframe.functions.values import JVM_DOUBLE
    rnd = random.Random(3)
    alpha = list("0123456789.eE+-dDfFxXpPabcnNiItyAB \t")
    vals = ["".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 9))) for _ in range(20000)]
    vals += ["Infinity", "-Infinity", "NaN", "+NaN", "inf", "nan", "INF", "Inf", "infinity", "0x1p3", "1d"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    by_grammar = F.regexp_extract(jvm_trim(F.col("v")), JVM_DOUBLE, 0).try_cast("double")
    assert df.where(~parse_double("v").eqNullSafe(by_grammar)).count() == 0
