import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from assayframe.operators import (
    DimensionError,
    canonical_item,
    classify,
    group_hits,
    group_rate,
    group_stats,
    hazard_rate,
    is_yes,
    limit_frame,
    limit_lookup,
    nested_distribution,
    rank_by,
    reading_range,
    synonym_frame,
)
from assayframe.operators.lookup import lookup

from conftest import rows


def readings(spark, pairs):
    return spark.createDataFrame([(k, r) for k, r in pairs], "category string, reading string")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stats_small_groups(spark):
    data = [("a", x) for x in ("1", "2", "4", "10")] + [("b", "7")] + [("c", x) for x in ("3", "1", "3", "1", "2")]
    data += [("a", "Unknown"), ("b", "Unknown")]
    res = {r["category"]: r for r in group_stats(readings(spark, data), "category").collect()}
    assert res["a"]["median"] == 3.0 and res["a"]["mean"] == 4.25
    assert res["a"]["stddev"] == pytest.approx(3.491060010942235, rel=1e-15)
    assert res["b"]["stddev"] == 0.0 and res["b"]["median"] == 7.0
    assert res["c"]["mode"] == 1.0 and res["c"]["median"] == 2.0


def test_known_filter_is_case_sensitive(spark):
    # "unknown" (lower case) is not the sentinel; it is not a number either, so it is left out.
    res = group_stats(readings(spark, [("a", "unknown"), ("a", "2")]), "category", stats=("mean",))
    assert rows(res) == [("a", 2.0)]


def test_nan_reading(spark):
    res = group_stats(readings(spark, [("a", "NaN"), ("a", "1"), ("a", "2")]), "category").collect()[0]
    assert math.isnan(res["mean"]) and res["median"] == 2.0 and res["mode"] == 1.0


def test_median_exact_on_hot_group_across_partitions(spark):
    rnd = random.Random(11)
    data = [("hot", str(rnd.randint(0, 5000) / 4)) for _ in range(20000)]
    data += [(f"k{i}", str(rnd.randint(0, 50))) for i in range(300) for _ in range(rnd.randint(1, 6))]
    df = readings(spark, data).repartition(8)
    got = {r[0]: r[1] for r in group_stats(df, "category", stats=("median",)).collect()}
    by_key = {}
    for k, v in data:
        by_key.setdefault(k, []).append(float(v))
    assert got == {k: statistics.median(v) for k, v in by_key.items()}


def test_median_even_count_uses_mean_of_middle(spark):
    got = rows(group_stats(readings(spark, [("a", "1"), ("a", "2"), ("a", "2"), ("a", "9")]), "category",
                           stats=("median",)))
    assert got == [("a", 2.0)]


def test_null_group_key(spark):
    df = spark.createDataFrame([(None, "1"), (None, "3"), ("x", "5")], "category string, reading string")
    got = {r[0]: (r[1], r[2]) for r in group_stats(df, "category", stats=("median", "mode")).collect()}
    assert got == {None: (2.0, 1.0), "x": (5.0, 5.0)}


def flags(spark, pairs):
    return spark.createDataFrame(pairs, "maker string, flag string")


def test_hazard_rate_strictly_above_cutoff(spark):
    df = flags(spark, [("m1", "YES"), ("m1", "no"), ("m1", "NA"), ("m2", "yes"), ("m2", "Yes"), ("m2", "NO"),
                       ("m3", "NA")])
    all_rates = dict(rows(hazard_rate(df, "maker")))
    assert all_rates == {"m1": 0.5, "m2": 2 / 3}
    assert rows(hazard_rate(df, "maker", min_rate=0.5)) == [("m2", 2 / 3)]


def test_group_rate_over_all_rows_and_hits(spark):
    df = flags(spark, [("m1", "NA"), ("m1", "YES"), ("m2", "NO")])
    assert dict(rows(group_rate(df, "maker", F.lower("flag") == "na"))) == {"m1": 0.5, "m2": 0.0}
    assert dict(rows(group_hits(df, "maker", is_yes()))) == {"m1": 1, "m2": 0}


def test_rank_by_top_k_plan_and_ties(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1)], "k string, n int")
    top = rank_by(df, "n", "k", k=2)
    assert rows(top) == [("a", 2), ("b", 2)]
    assert "TakeOrderedAndProject" in plan_of(top)


LIMITS = [("food-spice", "lead", 1.0), ("cosmetics", "lead", 10.0)]


def test_classify_with_limit_one(spark):
    texts = ["1200.5", "1.0", "Unknown", "-0.0", "NaN", "Infinity", "1e3", "1.5d", "0.5"]
    df = spark.createDataFrame([("Food-Spice", "Lead", t) for t in texts] + [("Jewelry", "Lead", "5")],
                               "category string, analyte string, reading string")
    out = classify(limit_lookup(df, limit_frame(spark, LIMITS)))
    got = [r["flag"] for r in out.collect()]
    assert got == ["YES", "NO", "NA", "NO", "NO", "YES", "YES", "YES", "NO", "NA"]


def test_lookup_is_broadcast_and_never_fans_out(spark):
    cat = F.when(F.col("id") % 3 == 0, "Food-Spice").when(F.col("id") % 3 == 1, "Cosmetics").otherwise("Other")
    df = spark.range(1000).select(cat.alias("category"), F.lit("LEAD").alias("analyte"),
                                  F.col("id").cast("string").alias("reading"))
    out = limit_lookup(df, limit_frame(spark, LIMITS))
    assert out.count() == 1000
    assert "BroadcastHashJoin" in plan_of(out)


def test_duplicate_dimension_keys_fail(spark):
    with pytest.raises(DimensionError):
        limit_frame(spark, LIMITS + [("cosmetics", "lead", 3.0)])
    dup = spark.createDataFrame([("a", "x"), ("a", "y")], "alias string, canonical string")
    df = spark.createDataFrame([("A",)], "item string")
    with pytest.raises(DimensionError):
        canonical_item(df, dup).collect()


def test_unbounded_dimension_is_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        dim = spark.createDataFrame([(str(i), f"c{i}") for i in range(50)], "alias string, canonical string")
        df = spark.createDataFrame([("3",), ("x",)], "item string")
        out = lookup(df, dim, on=[(F.col("item"), "alias")], values=[("canonical", "canon")])
        assert "BroadcastHashJoin" not in plan_of(out)
        assert sorted(rows(out), key=str) == [("3", "c3"), ("x", None)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_canonical_item_one_step(spark):
    syn = synonym_frame(spark, [("goldroot marrow", "goldroot"), ("goldroot", "yellowroot"), ("blue-fennet", "x")])
    df = spark.createDataFrame([("Goldroot (Root) Marrow",), ("GOLDROOT",), ("Blue-Fennet",), ("Cumin",)],
                               "item string")
    got = [r[0] for r in canonical_item(df, syn).collect()]
    assert got == ["goldroot", "yellowroot", "bluefennet", "cumin"]


def test_reading_range_empty_is_zero(spark):
    df = spark.createDataFrame([("Unknown",), ("n/a",)], "reading string")
    assert rows(reading_range(df)) == [(0, 0.0, 0.0, 0.0)]


def test_reading_range_keeps_negatives(spark):
    df = spark.createDataFrame([("-2",), ('"1,000"',), ("NaN",)], "reading string")
    assert rows(reading_range(df)) == [(2, -2.0, 1000.0, 499.0)]


def test_nested_distribution_sorted_lists(spark):
    df = spark.createDataFrame([("lead", "b"), ("lead", "a"), ("lead", "a"), ("zinc", "c")],
                               "analyte string, category string")
    got = {r["analyte"]: [tuple(x) for x in r["counts"]]
           for r in nested_distribution(df, "analyte", "category", digits=0).collect()}
    assert got == {"lead": [("a", 2), ("b", 1)], "zinc": [("c", 1)]}


def test_no_python_in_plans(spark):
    syn = synonym_frame(spark, [("a b", "c")])
    df = spark.createDataFrame([("x", "A B (z)", "lead", "5", "M")], "category string, item string, analyte string, reading string, maker string")
    out = group_stats(classify(limit_lookup(canonical_item(df, syn), limit_frame(spark, LIMITS))), "maker")
    plan = plan_of(out)
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in plan


def test_alternatives_bounds_imputation_weights(spark):
    from assayframe.operators.alternatives import (
        authority_limits, completeness, completeness_weighted_rate, hazard_rate_bounds, hazard_rate_by_authority,
        hazard_rate_imputed)
    df = spark.createDataFrame(
        [("food-spice", "lead", "3", "IN"), ("food-spice", "lead", "Unknown", "IN"), ("food-spice", "lead", "0.5", "IN"),
         ("food-spice", "lead", "2", "PE"), ("jewelry", "lead", "50", "PE")],
        "category string, analyte string, reading string, country string")
    limited = limit_lookup(df, limit_frame(spark, [("food-spice", "lead", 1.0)]))
    flagged = classify(limited)
    assert dict((r[0], (r[1], r[2])) for r in hazard_rate_bounds(flagged, "country").collect()) == {
        "IN": (1 / 3, 2 / 3), "PE": (1.0, 1.0)}
    # Unknown in IN is imputed with mean(3, 0.5) = 1.75 > 1 → YES.
    assert dict(map(tuple, hazard_rate_imputed(limited, "country").collect())) == {"IN": 2 / 3, "PE": 1.0}
    per = {r[0]: (r[1], r[2]) for r in completeness(flagged, "country").collect()}
    assert per == {"IN": (0.5, 2 / 3), "PE": (1.0, 0.5)}
    w = completeness_weighted_rate(completeness(flagged, "country")).collect()[0]
    assert w["weighted_rate"] == pytest.approx((2 / 3 * 0.5 + 0.5 * 1.0) / (2 / 3 + 0.5)) and w["groups"] == 2
    lims = authority_limits(spark, [("x", "food-spice", "lead", 1.0), ("y", "food-spice", "lead", 2.5),
                                    ("y", "jewelry", "lead", 100.0)])
    got = {(r[0], r[1]): r[2] for r in hazard_rate_by_authority(df, lims, "country").collect()}
    assert got == {("x", "IN"): 0.5, ("x", "PE"): 1.0, ("y", "IN"): 0.5, ("y", "PE"): 0.0}


def test_canonical_item_normalised_keys_opt_in(spark):
    syn = synonym_frame(spark, [("blue-fennet", "blue fennet")])
    df = spark.createDataFrame([("Blue-Fennet",)], "item string")
    assert [r[0] for r in canonical_item(df, syn).collect()] == ["bluefennet"]
    assert [r[0] for r in canonical_item(df, syn, normalise_keys=True).collect()] == ["blue fennet"]


def test_required_fields_all_and_any(spark):
    from assayframe.operators import required_fields
    from assayframe.sources.text import FIELDS
    df = spark.createDataFrame([(["0", "x", "", "unknown", "1"],), (["0", "", " ", "UNKNOWN", "unknown or not stated"],),
                                (["0", "a", "b", "c", "d"],)], f"{FIELDS} array<string>")
    assert required_fields(df).count() == 1
    assert required_fields(df, mode="any").count() == 2


def test_cleaning_functions_idempotent(spark):
    from assayframe.functions import clean_reading, standardise_missing
    rnd = random.Random(5)
    alpha = list('aAnN/ ,"0123456789.-eEuUkKoOwWlL\t')
    vals = ["".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 10))) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    once = df.select(standardise_missing("v").alias("s"), clean_reading("v").alias("r"))
    again = once.where((standardise_missing("s") != F.col("s")) | (clean_reading("r") != F.col("r")))
    assert again.count() == 0


def test_lookup_keeps_odd_column_names(spark):
    df = spark.createDataFrame([("Food-Spice", "Lead", "2", 1)], "category string, analyte string, reading string, `a.b` int")
    out = limit_lookup(df, limit_frame(spark, LIMITS))
    assert out.columns == ["category", "analyte", "reading", "a.b", "max_reading"]
    assert rows(out) == [("Food-Spice", "Lead", "2", 1, 1.0)]


def test_stats_match_brute_force_and_multi_key_form(spark):
    from assayframe.operators.stats import group_stats_by_each
    rnd = random.Random(23)
    rows_ = []
    for i in range(2000):
        rows_.append((f"c{rnd.randint(0, 6)}", f"m{rnd.randint(0, 40)}",
                      "Unknown" if rnd.random() < 0.1 else str(rnd.randint(0, 30) / 2)))
    df = spark.createDataFrame(rows_, "category string, maker string, reading string")
    got = {r["category"]: r for r in group_stats(df, "category").collect()}
    by = {}
    for c, _, v in rows_:
        if v != "Unknown":
            by.setdefault(c, []).append(float(v))
    for c, vals in by.items():
        counts = {}
        for v in vals:
            counts[v] = counts.get(v, 0) + 1
        top = max(counts.values())
        assert got[c]["median"] == statistics.median(vals)
        assert got[c]["mode"] == min(v for v, n in counts.items() if n == top)
        assert got[c]["mean"] == pytest.approx(statistics.fmean(vals), rel=1e-12)
        assert got[c]["stddev"] == pytest.approx(statistics.pstdev(vals), rel=1e-9)
    each = group_stats_by_each(df, ["category", "maker"], round_to=6)
    for key in ("category", "maker"):
        single = {tuple(r) for r in group_stats(df, key, round_to=6).collect()}
        multi = {tuple(r)[1:] for r in each.where(F.col("dimension") == key).collect()}
        assert multi == single


def test_nested_distribution_is_one_list_or_parts_by_digits(spark):
    import hashlib
    many = spark.createDataFrame([("lead", f"c{i}") for i in range(400)] + [("zinc", "c1"), ("zinc", None)],
                                 "analyte string, category string")
    whole = nested_distribution(many, "analyte", "category")
    assert whole.columns == ["analyte", "counts"]
    assert {r["analyte"]: len(r["counts"]) for r in whole.collect()} == {"lead": 400, "zinc": 2}
    for digits in (1, 2):
        nested = nested_distribution(many, "analyte", "category", digits=digits)
        assert nested.columns == ["analyte", "part", "counts"]
        for r in nested.collect():
            assert r["counts"] == sorted(r["counts"], key=lambda c: c["category"] or "")
            assert {hashlib.md5((c["category"] or "").encode()).hexdigest()[:digits] for c in r["counts"]} == {r["part"]}
        flat = sorted((r["analyte"], c["category"] or "", c["n"]) for r in nested.collect() for c in r["counts"])
        assert flat == sorted([("lead", f"c{i}", 1) for i in range(400)] + [("zinc", "c1", 1), ("zinc", "", 1)])


def test_groups_do_not_depend_on_the_statistics(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "1"), ("b", "3"), ("c", "Unknown"), (None, "z")],
                               "grp string, reading string")
    for stats in (("mean",), ("stddev",), ("median",), ("mode",), ("mean", "median"), ("mean", "median", "mode", "stddev")):
        got = {r[0]: tuple(r)[1:] for r in group_stats(df, "grp", stats=stats).collect()}
        assert set(got) == {"a", "b", None}
        assert set(got["a"]) == {None} and None not in got["b"]


def test_sigma_from_the_histogram_is_stable(spark):
    values = [1e9 + 0.1 * i for i in range(9)] * 3
    df = spark.createDataFrame([("a", repr(v)) for v in values], "grp string, reading string")
    r = group_stats(df, "grp").first()
    assert r["stddev"] == pytest.approx(__import__("statistics").pstdev(values), rel=1e-6)


def test_long_aliases_are_not_broadcast_by_row_count(spark):
    """A dimension under two million rows whose texts are long: the planner goes by
    bytes, no hint overrides it."""
    dim = spark.range(3000).select(F.concat(F.repeat(F.lit("long alias "), 1000), F.col("id")).alias("alias"),
                                   F.col("id").cast("string").alias("canonical"))
    df = spark.createDataFrame([("3",)], "item string")
    out = lookup(df, dim, on=[(F.col("item"), "alias")], values=[("canonical", "canon")])
    assert "strategy=broadcast" not in out._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in out._jdf.queryExecution().logical().toString().lower()


def test_stats_with_integer_and_null_keys(spark):
    df = spark.createDataFrame([(1, "4"), (1, "2"), (2, "7"), (None, "3"), (None, "5"), (None, "5")],
                               "grp int, reading string")
    got = {r[0]: (r[1], r[2]) for r in group_stats(df, "grp", stats=("median", "mode")).collect()}
    assert got == {1: (3.0, 2.0), 2: (7.0, 7.0), None: (5.0, 5.0)}


def _hot_values(spark, n=6000):
    """One group with most rows, NaN, both zeros, infinities and denormal numbers."""
    rnd = random.Random(9)
    odd = [0.0, -0.0, float("nan"), float("inf"), float("-inf"), 5e-324, -5e-324, 1e308, -1e308, 2.5]
    rows_ = [("hot" if rnd.random() < .7 else f"g{rnd.randint(0, 5)}", rnd.choice(odd) if rnd.random() < .1 else rnd.gauss(0, 10 ** rnd.randint(-3, 9)))
             for _ in range(n)] + [("even", -1.0), ("even", 4.0), ("one", -7.25), ("all_nan", float("nan"))]
    return rows_, spark.createDataFrame(rows_, "grp string, reading_value double")


def test_radix_median_equals_brute_force(spark, monkeypatch):
    from assayframe.operators import stats as st
    rows_, df = _hot_values(spark)
    order = lambda v: (math.isnan(v), 0.0 if math.isnan(v) else v)
    want = {}
    for g in {g for g, _ in rows_}:
        v = sorted((v for x, v in rows_ if x == g), key=order)
        lo, hi = v[(len(v) - 1) // 2], v[len(v) // 2]
        want[g] = lo if len(v) % 2 else (lo + hi) / 2
    for listed in (st.LISTED, 40, 0):       # all groups in one list, large ones by radix, all by radix
        monkeypatch.setattr(st, "LISTED", listed)
        got = {r["grp"]: r["median"] for r in group_stats(df, "grp", stats=("median",)).collect()}
        assert set(got) == set(want)
        assert all(got[g] == want[g] or (math.isnan(got[g]) and math.isnan(want[g])) for g in want), (listed, got, want)
        both = group_stats(df.where("not isnan(reading_value)"), "grp").collect()
        assert {r["grp"] for r in both} == set(want) - {"all_nan"}


def test_radix_median_never_sorts_or_gathers_a_group(spark):
    from assayframe.operators import stats as st
    _, df = _hot_values(spark, 300)
    text = plan_of(st.radix_median(st.histogram(st.known_values(df, "grp"), "grp"), "grp"))
    for node in ("Window", "rangepartitioning", "SinglePartition", "percentile"):
        assert node not in text, node


def test_typed_tables_are_not_parsed(spark):
    from assayframe.operators.alternatives import hazard_rate_imputed
    from assayframe.operators.stats import group_stats_by_each
    typed = spark.createDataFrame([("food-spice", "lead", "3", 3.0, "a"), ("food-spice", "lead", "Unknown", None, "a"),
                                   ("food-spice", "lead", "NaN", float("nan"), "b"), ("food-spice", "lead", "0.5", 0.5, "b")],
                                  "category string, analyte string, reading string, reading_value double, maker string")
    text = typed.drop("reading_value")
    limits = limit_frame(spark, LIMITS)
    for run in (lambda d: group_stats(d, "maker", stats=("mean",)), lambda d: group_stats(d, "maker", stats=("mode", "median")),
                lambda d: group_stats_by_each(d, ["maker", "category"], stats=("mode", "median")),
                lambda d: classify(limit_lookup(d, limits)).select("maker", "reading", "flag"),
                lambda d: hazard_rate_imputed(limit_lookup(d, limits), "maker", "category")):
        assert sorted(map(repr, run(typed).collect())) == sorted(map(repr, run(text).collect()))
    logical = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    parsed = "try_cast"
    assert parsed not in logical(group_stats(typed, "maker", stats=("mean",))).lower()
    assert parsed not in logical(classify(limit_lookup(typed, limits))).lower()
    assert "cast" in logical(group_stats(text, "maker", stats=("mean",))).lower()


def test_roll_ups_take_the_smallest_parent_and_never_repeat_facts(spark):
    from assayframe.operators import stats as st
    rnd = random.Random(3)
    rows_ = [(rnd.choice("ab"), rnd.choice([None, "x", "y", "z"]), f"m{rnd.randint(0, 90)}", float(rnd.randint(0, 9))) for _ in range(3000)]
    df = spark.createDataFrame(rows_, "small string, mid string, big string, v double")
    joint = st.write_once(st.histogram(df, ["small", "mid", "big"]), "joint")
    found = st.roll_ups(joint, ["big", "small", "mid"])
    for i, key in enumerate(("small", "mid", "big")):
        counts = {}
        for r in rows_:
            counts[r[i], r[3]] = counts.get((r[i], r[3]), 0) + 1
        assert {(r[key], r["v"]): r["n"] for r in found[key].collect()} == counts
    # the key with the fewest values comes last, from a table without the others
    plan = found["small"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 3 and found["big"]._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1


def test_mode_runs_on_a_hash_aggregate(spark):
    rows_, df = _hot_values(spark, 500)
    assert "SortAggregate" not in plan_of(group_stats(df, "grp", stats=("mode",)))


def test_drawn_rates_equal_a_plain_version_and_lie_within_the_bounds(spark):
    import hashlib
    from assayframe.operators.alternatives import hazard_rate_bounds
    from assayframe.operators.draws import hazard_rate_drawn
    rnd = random.Random(4)
    data = []
    for i in range(1500):
        group = rnd.choice(["hot"] * 4 + ["b", "c", None])
        reading = "Unknown" if rnd.random() < 0.3 or group == "c" else rnd.choice(["NaN", "0", "1.5", "2", "2", "7", "Infinity"])
        data.append((rnd.choice([f"r{i}", "same", None]), group, rnd.choice(["x", "y", None]), reading,
                     rnd.choice([1.5, 2.0, 50.0, None]), "extra"))
    df = spark.createDataFrame(data, "record_id string, category string, country string, reading string, "
                                     "max_reading double, known string").repartition(4)
    known = {}
    for _, g, _, r, _, _ in data:
        if r != "Unknown":
            known.setdefault(g, []).append(float(r))
    for vs in known.values():
        vs.sort(key=lambda v: -1.0 if math.isnan(v) else v)
    seeds = (0, 3, 11)
    want = {}
    for i, g, country, r, lim, _ in data:
        if lim is None or (r == "Unknown" and g not in known):
            continue
        n, yes, drawn = want.setdefault(country, [0, [0] * len(seeds), 0])
        want[country][0] += 1
        want[country][2] += r == "Unknown"
        for j, s in enumerate(seeds):
            v = float(r) if r != "Unknown" else known[g][int(hashlib.md5(f"{s}:{i or ''}".encode()).hexdigest()[:13], 16) % len(known[g])]
            yes[j] += v > lim
    got = {r[0]: r for r in hazard_rate_drawn(df, "country", "category", seeds=seeds).collect()}
    assert set(got) == set(want)
    for country, (n, yes, drawn) in want.items():
        r = got[country]
        assert r["rate"] == pytest.approx(sum(yes) / n / len(seeds), rel=1e-15) and r["drawn"] == drawn
        assert r["rate_low"] == min(yes) / n and r["rate_high"] == max(yes) / n
    flagged = classify(df.drop("known").withColumn("flag", F.lit(None)).drop("flag"))
    for r in hazard_rate_bounds(flagged, "country").collect():
        g = got[r["country"]]
        assert r["rate_low"] <= g["rate_low"] <= g["rate"] <= g["rate_high"] <= r["rate_high"]
    assert hazard_rate_drawn(df.limit(0), "country").count() == 0


@pytest.mark.parametrize("hot", ["item 7", None])
def test_a_key_in_half_of_the_rows_is_split_by_adaptive_execution(spark, tmp_path, hot):
    """A dimension too large to broadcast: AQE splits the hot key's partition of the facts, so
    no task has more than twice the rows of the median one, for a hot key and a hot null."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "192KB", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in settings}
    rows, keys = 400_000, 20_000
    dim = spark.range(keys).select(F.concat(F.lit("item "), "id").alias("alias"),
                                   F.concat(F.lit("canonical "), "id").alias("canonical"))
    item = F.when(F.col("id") % 2 == 0, F.lit(hot)).otherwise(F.concat(F.lit("item "), F.pmod(F.hash("id"), F.lit(keys))))
    rest = [F.md5(F.concat(F.lit(str(i)), F.col("id").cast("string"))).alias(f"c{i}") for i in range(4)]
    facts = spark.range(rows, numPartitions=64).select(item.alias("item"), *rest)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        # Written whole: a count would prune the columns that the tasks carry.
        lookup(facts, dim, [(F.col("item"), "alias")], [("canonical", "name")]).write.parquet(str(tmp_path / "joined"))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    joined = spark.read.parquet(str(tmp_path / "joined"))
    per_task = sorted(r[1] for r in joined.groupBy(F.input_file_name()).count().collect())
    assert sum(per_task) == rows and joined.where("item is not null and name is null").count() == 0
    assert len(per_task) > 16 and per_task[-1] <= 2 * statistics.median(per_task), per_task
