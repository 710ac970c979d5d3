"""Order-preserving codes of doubles."""

import math
import random
import struct

from pyspark.sql import functions as F

from assayframe.functions.codes import code_double, double_code, packed, packed_value

EDGES = [0.0, -0.0, 1.0, -1.0, 0.5, 5e-324, -5e-324, 2.0 ** -1022, 2.0 ** -1022 - 5e-324, 1.7976931348623157e308, float("inf"),
         float("-inf"), float("nan"), 0.1, 3.0, 1 - 2 ** -53, 1 + 2 ** -52, 2.0 ** 1023, 1e22, 123456.789]
EDGES += [s * math.nextafter(2.0 ** e, to) for e in range(-1074, 1024, 37) for to in (0.0, math.inf) for s in (1, -1)]


def test_codes_keep_order_and_every_bit(spark):
    rng = random.Random(4)
    values = EDGES + [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", double_code("v").alias("c"))
    got = df.withColumn("back", code_double("c")).collect()
    for r in got:
        assert r["back"] == r["v"] or (math.isnan(r["v"]) and math.isnan(r["back"])), r
    numbers = sorted((r["v"], r["c"]) for r in got if not math.isnan(r["v"]))
    assert all(a[1] < b[1] if a[0] < b[0] else a[1] == b[1] for a, b in zip(numbers, numbers[1:]))
    assert min(r["c"] for r in got if math.isnan(r["v"])) > max(c for _, c in numbers)
    assert spark.range(1).select(double_code(F.lit(None).cast("double")).alias("c")).first()["c"] is None


def test_packed_pairs_take_the_greatest_count_then_the_least_value(spark):
    rng = random.Random(5)
    rows = [(g, rng.choice([1, 2, 10 ** 17, 10 ** 17 + 1]), v) for g in range(60) for v in rng.sample(EDGES, 12)]
    df = spark.createDataFrame(rows, "g int, n long, v double")
    best = df.groupBy("g").agg(F.max(packed("n", "v")).alias("p"))
    assert "HashAggregate" in best._jdf.queryExecution().executedPlan().toString()
    got = {r["g"]: r["v"] for r in best.select("g", packed_value("p").alias("v")).collect()}
    order = lambda v: (math.isnan(v), 0.0 if math.isnan(v) else v)
    for g in range(60):
        mine = [(n, v) for x, n, v in rows if x == g]
        want = min(
            (v for n, v in mine if n == max(n for n, _ in mine)), key=order)
        assert got[g] == want or (math.isnan(got[g]) and math.isnan(want))
