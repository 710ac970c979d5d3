"""Inputs built from the driver's tables, so every registered query reads
those tables and grows with them.

* ``measurements``: cleaned-record shaped view over lineitem ⋈ part ⋈
  supplier ⋈ nation (one row per line item).
* ``raw_line_frame`` / ``raw_lines_path``: delimited text composed from
  customer ⋈ nation ⋈ region (one line per customer, quoted fields with
  commas), plus a header and a few hand-written edge lines; written once per
  session to the shared folder and scanned back with ``read.text``.
* small dimension tables (limits, synonyms) used as parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe.operators.lookup import limit_frame, literal_frame, synonym_frame
from assayframe.session import scratch_path

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table, read once per session (file listing and footer
    reads are not repeated for every query)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def measurements(spark: SparkSession, sf_dir: str, typed: bool = False) -> DataFrame:
    """(record_id, category, item, analyte, reading, maker, country), and the number of
    the reading as a typed table has it. A line with no discount stands for a reading
    that was not measured."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag",
                                                 "l_quantity", "l_discount")
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name", "p_brand")
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # A plain chain: each dimension keeps its own size statistics, so the
    # planner can broadcast the small ones (a pre-joined supplier ⋈ nation has
    # no usable estimate and turned into a sort-merge join of the facts).
    joined = (li.join(pa, li.l_partkey == pa.p_partkey)
                .join(su, li.l_suppkey == su.s_suppkey)
                .join(na, su.s_nationkey == na.n_nationkey))
    reading = F.when(F.col("l_discount") == 0.0, F.lit("Unknown")).otherwise(F.col("l_quantity").cast("string"))
    value = F.when(F.col("l_discount") != 0.0, F.col("l_quantity").cast("double")).alias("reading_value")
    return joined.select(
        F.col("l_orderkey").alias("record_id"), F.col("p_type").alias("category"), F.col("p_name").alias("item"),
        F.col("l_returnflag").alias("analyte"), reading.alias("reading"), F.col("p_brand").alias("maker"),
        F.col("n_name").alias("country"), *([value] if typed else []),
    )


# --- fixed values: test dimensions (keys lower case, data upper case) -------
MEASUREMENT_LIMITS = (
    ("standard", "a", 25.0), ("standard", "n", 10.0), ("standard", "r", 40.0),
    ("promo", "a", 30.0), ("promo", "n", 38.0),
    ("economy", "r", 5.0), ("economy", "a", 20.0),
    ("medium", "a", 15.0),
    ("large", "n", 40.0),
)
PART_SYNONYMS = (
    ("blue anvil", "anvil"), ("red anvil", "anvil"),
    ("hot plate", "plate"), ("cold plate", "plate"),
    ("small widget", "widget"), ("large widget", "widget"),
    ("new gizmo", "gizmo"), ("old gizmo", "gizmo"),
)
# Two limit sets for the several-authorities form: the first is MEASUREMENT_LIMITS.
SECOND_AUTHORITY_LIMITS = (
    ("standard", "a", 20.0), ("standard", "n", 30.0),
    ("promo", "r", 25.0),
    ("small", "a", 10.0), ("small", "n", 45.0),
    ("large", "r", 35.0),
)
RAW_LIMITS = (
    ("building", "africa", 5000.0), ("building", "america", 2500.0),
    ("furniture", "asia", 4000.0), ("household", "europe", 1000.0),
    ("machinery", "middle east", 7000.0), ("automobile", "africa", 3000.0),
    ("food-spice", "lead", 1.0),
)
RAW_SYNONYMS = (
    ("goldroot marrow", "goldroot"),
    ("100 highland pepperel", "pepperel dust"),
    ("blue-fennet", "blue fennet"),
)
RAW_HEADER = "record_id,category,item,analyte,reading,unit,maker,country,country_alt,extra_9,extra_10"
# Hand-written lines appended to the composed ones: split edge cases, then
# required-field words, reading texts and label texts in 11-field records.
EDGE_LINES = (
    '1,"a, b",c',
    '1, "x ""q"" y" ,z',
    "a,,",
    "",
    '"a,b',
    'a,"b,c,d',
    '  "unknown "  ,1',
    "e01, ,Chili Powder,Lead,5,ppm,M,India,India,,",
    "e02,UNKNOWN,Chili Powder,Lead,5,ppm,M,India,India,,",
    "e03,Unknown or not stated,Chili Powder,Lead,5,ppm,M,India,India,,",
    "e04,null,Chili Powder,Lead,5,ppm,M,India,India,,",
    "e05,N/A,Chili Powder,Lead,5,ppm,M,India,India,,",
    "e06,na,Chili Powder,Lead,5,ppm,M,India,India,,",
    'e07,  "unknown "  ,Chili Powder,Lead,5,ppm,M,India,India,,',
    'e08,Food-Spice,  Goldroot (Marrow) Powder ,Lead,"1,200.5",ppm,M,India,India,,',
    "e09,Food-Spice,Goldroot Marrow,Lead,1.0,ppm,M,India,India,,",
    "e10,Food-Spice,Blue-Fennet,Lead,-1,ppm,M,Georgia,Georgia,,",
    "e11,Food-Spice,100% HIGHLAND\tpepperel,Lead,-0.0,ppm,M,India,India,,",
    "e12,Food-Spice,a((b)c),Lead,<5,ppm,M,India,India,,",
    "e13,Food-Spice,红椒,Lead,1L,ppm,M,China,China,,",
    "e14,Food-Spice,Chili,Lead,nan,ppm,M,India,India,,",
    "e15,Food-Spice,Chili,Lead,inf,ppm,M,India,India,,",
    "e16,Food-Spice,Chili,Lead,NaN,ppm,M,India,India,,",
    "e17,Food-Spice,Chili,Lead,Infinity,ppm,M,India,India,,",
    "e18,Food-Spice,Chili,Lead,1e3,ppm,M,India,India,,",
    "e19,Food-Spice,Chili,Lead,1.5d,ppm,M,India,India,,",
    "e20,Cosmetics,Kajal,Lead,12,ppm,M,N/A,na,,",
    "e21,Food-Spice,Chili,Lead,n/a,ppm,M,India,India,,",
)
# ---------------------------------------------------------------------------


def measurement_limits(spark: SparkSession) -> DataFrame:
    return limit_frame(spark, MEASUREMENT_LIMITS)


def authority_limit_rows():
    return [("agency_a", *r) for r in MEASUREMENT_LIMITS] + [("agency_b", *r) for r in SECOND_AUTHORITY_LIMITS]


def part_synonyms(spark: SparkSession) -> DataFrame:
    return synonym_frame(spark, PART_SYNONYMS)


def raw_limits(spark: SparkSession) -> DataFrame:
    return limit_frame(spark, RAW_LIMITS)


def raw_synonyms(spark: SparkSession) -> DataFrame:
    return synonym_frame(spark, RAW_SYNONYMS)


def customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 11-field line per customer: id, segment, quoted name with a comma,
    region, balance as text (negatives become Unknown when cleaned), unit,
    quoted maker with a comma, nation twice, an empty field, a quoted n/a."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    q = lambda *parts: F.concat(F.lit('"'), *parts, F.lit('"'))
    line = F.concat_ws(
        ",",
        F.col("c_custkey").cast("string"), F.col("c_mktsegment"),
        q(F.col("c_name"), F.lit(", ("), F.col("c_mktsegment"), F.lit(")")),
        F.col("r_name"), F.col("c_acctbal").cast("string"), F.lit("USD"),
        q(F.lit("Maker, "), (F.col("c_custkey") % 7).cast("string")),
        F.col("n_name"), F.col("n_name"), F.lit(""), F.lit('"n/a"'),
    )
    return j.select(line.alias("value"))


def raw_line_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header + composed lines + edge lines, as a ``value`` column."""
    fixed = literal_frame(spark, [(RAW_HEADER,)] + [(x,) for x in EDGE_LINES], ("value",))
    return fixed.unionByName(customer_lines(spark, sf_dir))


_WRITTEN: dict[tuple[str, str], str] = {}


def raw_lines_path(spark: SparkSession, sf_dir: str) -> str:
    """Write the raw lines as text to the shared folder once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WRITTEN:
        path = scratch_path(spark, "raw_lines")
        raw_line_frame(spark, sf_dir).write.mode("overwrite").text(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]
