import pytest
from pyspark.sql import functions as F

from assayframe.operators import clean_records, cleaning_report, limit_frame, synonym_frame, valid_readings
from assayframe.session import scratch_path
from assayframe.sources import (
    CLEAN_COLUMNS,
    arity_guard,
    drop_header,
    parse_csv,
    preview,
    register_table,
    scan_clean,
    scan_lines,
    write_clean,
)
from assayframe.streaming import clean_stream, read_line_stream, running_rate, write_rates, write_stream

HEADER = "id,category,item,analyte,reading,unit,maker,country,country_alt,x9,x10"
LINES = [
    HEADER,
    "1,Food-Spice,Goldroot (Marrow),Lead,\"1,200.5\",ppm,\"Maker, A\",India,India,,",
    "2,Food-Spice,Goldroot,Lead,-3,ppm,M,India,India,,",
    "",
    HEADER,
    "3,UNKNOWN,Chili,Lead,5,ppm,M,India,India,,",
    "4,Cosmetics,Kajal,Lead,12,ppm,M,N/A,na,,",
    "short,line",
    "5,null,Kajal,Mercury,0.5,ppm,M,Peru,Peru,,",
]
LIMITS = [("food-spice", "lead", 1.0), ("cosmetics", "lead", 10.0)]


def write_lines(path, lines):
    import os
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part-0.txt", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_scan_keeps_blank_and_header_dropped_everywhere(spark, tmp_path):
    write_lines(str(tmp_path / "raw"), LINES)
    lines = scan_lines(spark, str(tmp_path / "raw"))
    assert lines.count() == len(LINES)
    body = drop_header(lines)                          # header read from the first line
    assert body.count() == len(LINES) - 2
    guarded = arity_guard(parse_csv(body), 10)
    assert guarded.count() == 5


def test_clean_and_report(spark, tmp_path):
    write_lines(str(tmp_path / "raw"), LINES)
    lines = scan_lines(spark, str(tmp_path / "raw"))
    syn = synonym_frame(spark, [("goldroot", "goldroot powder")])
    lim = limit_frame(spark, LIMITS)
    clean = clean_records(lines, lim, syn, header=HEADER)
    got = {r["record_id"]: r for r in clean.collect()}
    assert set(got) == {"1", "2", "4", "5"}
    assert got["1"]["item"] == "goldroot powder" and got["1"]["reading"] == "1200.5" and got["1"]["flag"] == "YES"
    assert got["1"]["maker"] == "Maker, A"
    assert got["2"]["item"] == "goldroot powder" and got["2"]["reading"] == "Unknown" and got["2"]["flag"] == "NA"
    assert got["4"]["country"] == "Unknown" and got["4"]["country_alt"] == "Unknown" and got["4"]["flag"] == "YES"
    assert got["5"]["category"] == "Unknown" and got["5"]["flag"] == "NA"
    assert got["1"]["extra_9"] == "Unknown"
    rep = cleaning_report(lines, lim, syn, header=HEADER).collect()[0].asDict()
    assert rep == {"raw_records": 7, "cleaned_records": 4, "dropped": 3, "unknown_readings": 1,
                   "unknown_percent": 25, "na_flags": 2}
    vals = sorted(r[0] for r in valid_readings(lines, header=HEADER).collect())
    assert vals == [-3.0, 0.5, 5.0, 12.0, 1200.5]


def test_sinks_roundtrip_and_catalog(spark, tmp_path):
    write_lines(str(tmp_path / "raw"), LINES)
    clean = clean_records(scan_lines(spark, str(tmp_path / "raw")), limit_frame(spark, LIMITS), None, header=HEADER)
    expect = sorted(tuple(r[c] for c in CLEAN_COLUMNS) for r in clean.collect())
    for fmt in ("parquet", "tsv"):
        path = str(tmp_path / f"out_{fmt}")
        write_clean(clean, path, fmt=fmt)
        write_clean(clean, path, fmt=fmt)              # overwrite, not append
        back = scan_clean(spark, path, fmt=fmt, min_fields=12 if fmt == "tsv" else None)
        assert sorted(tuple(r) for r in back.collect()) == expect
    register_table(spark, "clean_test", str(tmp_path / "out_parquet"))
    assert [r[0] for r in preview(spark, "clean_test", n=2).collect()] == ["1", "2"]


def test_partitioned_sink_prunes(spark, tmp_path):
    write_lines(str(tmp_path / "raw"), LINES)
    clean = clean_records(scan_lines(spark, str(tmp_path / "raw")), limit_frame(spark, LIMITS), None, header=HEADER)
    path = str(tmp_path / "by_cat")
    write_clean(clean, path, partition_by=["category"])
    df = spark.read.parquet(path).where(F.col("category") == "Cosmetics")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and df.count() == 1


def test_streaming_clean_equals_batch(spark, tmp_path):
    src = str(tmp_path / "incoming")
    write_lines(src, LINES)
    lim = limit_frame(spark, LIMITS)
    out = scratch_path(spark, "stream-out")
    q = write_stream(clean_stream(read_line_stream(spark, src), lim, None, HEADER), out)
    q.awaitTermination(120)
    streamed = sorted(tuple(r) for r in spark.read.parquet(out).select(*CLEAN_COLUMNS).collect())
    batch = clean_records(scan_lines(spark, src), lim, None, header=HEADER).select(*CLEAN_COLUMNS)
    assert streamed == sorted(tuple(r) for r in batch.collect())


def test_streaming_running_rate(spark, tmp_path):
    src = str(tmp_path / "incoming2")
    write_lines(src, LINES)
    lim = limit_frame(spark, LIMITS)
    stream = clean_stream(read_line_stream(spark, src), lim, None, HEADER)
    q = write_rates(running_rate(stream, "category", F.lower("flag") == "na"), "na_rates_test")
    q.awaitTermination(120)
    got = {r["category"]: r["rate"] for r in spark.table("na_rates_test").collect()}
    assert got == {"Food-Spice": 0.5, "Cosmetics": 0.0, "Unknown": 1.0}


def test_four_jobs_end_to_end(spark, tmp_path):
    from assayframe.plans.jobs import analytics_job, audit_job, clean_job, profile_job
    raw = str(tmp_path / "raw_jobs")
    write_lines(raw, LINES)
    prof = profile_job(spark, raw)
    assert prof["records"].collect()[0][0] == 7
    assert {r[0] for r in prof["categories"].collect()} == {"Food-Spice", "UNKNOWN", "Cosmetics", "null"}
    assert prof["reading_range"].collect()[0]["n_valid"] == 5
    for fmt in ("parquet", "tsv"):
        out = str(tmp_path / f"clean_jobs_{fmt}")
        rep = clean_job(spark, raw, out, limit_frame(spark, LIMITS), None, fmt=fmt).collect()[0]
        assert rep["cleaned_records"] == 4 and rep["na_flags"] == 2
        res = analytics_job(spark, out, fmt=fmt)
        assert dict(map(tuple, res["hazard_rate_category"].collect())) == {"Food-Spice": 1.0, "Cosmetics": 1.0}
        assert res["median_by_category"].count() == 3
        aud = audit_job(spark, out, fmt=fmt)
        assert dict(map(tuple, aud["na_rate_category"].collect())) == {"Food-Spice": 0.5, "Cosmetics": 0.0, "Unknown": 1.0}


def test_streaming_rates_accumulate_over_batches(spark, tmp_path):
    import os
    src = str(tmp_path / "incoming3")
    os.makedirs(src)
    body = [line for line in LINES if line != HEADER]
    for i, chunk in enumerate((body[:3], body[3:])):
        with open(f"{src}/part-{i}.txt", "w") as f:
            f.write("\n".join([HEADER] + chunk) + "\n")
    lim = limit_frame(spark, LIMITS)
    stream = clean_stream(read_line_stream(spark, src, max_files_per_trigger=1), lim, None, HEADER)
    q = write_rates(running_rate(stream, "category", F.lower("flag") == "na"), "na_rates_batches")
    q.awaitTermination(180)
    assert len(q.recentProgress) >= 2                      # one micro-batch per file
    got = {r["category"]: (r["hits"], r["rows"]) for r in spark.table("na_rates_batches").collect()}
    assert got == {"Food-Spice": (1, 2), "Cosmetics": (0, 1), "Unknown": (1, 1)}


def test_cleaning_report_with_nothing_left(spark, tmp_path):
    raw = str(tmp_path / "raw_empty")
    write_lines(raw, [HEADER, "", "a,b", "1,UNKNOWN,x,Lead,5,u,m,c,c,,"])
    rep = cleaning_report(scan_lines(spark, raw), limit_frame(spark, LIMITS), None, header=HEADER).collect()[0]
    assert rep.asDict() == {"raw_records": 3, "cleaned_records": 0, "dropped": 3, "unknown_readings": 0,
                            "unknown_percent": 0, "na_flags": 0}


def test_audit_country_column_is_an_argument(spark, tmp_path):
    from assayframe.plans.jobs import audit_job, clean_job
    raw = str(tmp_path / "raw_audit")
    write_lines(raw, [HEADER, "1,Cosmetics,Kajal,Lead,12,ppm,M,India,Nepal,,", "2,Cosmetics,Kajal,Lead,-1,ppm,M,India,India,,"])
    out = str(tmp_path / "clean_audit")
    clean_job(spark, raw, out, limit_frame(spark, LIMITS), None)
    by_alt = dict(map(tuple, audit_job(spark, out)["unknown_rate_country"].collect()))
    by_country = dict(map(tuple, audit_job(spark, out, country="country")["unknown_rate_country"].collect()))
    assert by_alt == {"Nepal": 0.0, "India": 1.0}
    assert by_country == {"India": 0.5}


def test_stream_called_again_goes_on(spark, tmp_path):
    src, out = str(tmp_path / "arriving"), str(tmp_path / "stream_out")
    lim = limit_frame(spark, LIMITS)
    write_lines(src, [HEADER, "1,Cosmetics,Kajal,Lead,12,ppm,M,India,Nepal,,"])
    for rows_so_far, more in ((1, "2,Cosmetics,Kohl,Lead,1,ppm,M,India,Nepal,,"), (2, None)):
        write_stream(clean_stream(read_line_stream(spark, src), lim, None, HEADER), out).awaitTermination(120)
        assert spark.read.parquet(out).count() == rows_so_far
        if more:
            with open(f"{src}/later.txt", "w") as f:
                f.write(HEADER + "\n" + more + "\n")


def test_partitioned_table_has_all_rows(spark, tmp_path):
    from assayframe.sources import describe, show_tables
    raw, out = str(tmp_path / "raw_part"), str(tmp_path / "clean_part")
    write_lines(raw, LINES)
    clean = clean_records(scan_lines(spark, raw), limit_frame(spark, LIMITS), None, header=HEADER)
    write_clean(clean, out, partition_by=["category", "analyte"])
    table = register_table(spark, "clean_partitioned", out)
    want = sorted(map(tuple, scan_clean(spark, out).collect()))
    assert sorted(map(tuple, table.collect())) == want and len(want) == clean.count()
    assert "clean_partitioned" in {r["tableName"] for r in show_tables(spark).collect()}
    assert {r["data_type"] for r in describe(spark, "clean_partitioned").collect() if r["col_name"] in CLEAN_COLUMNS} == {"string"}
    spark.sql("DROP TABLE clean_partitioned")


def test_several_files_need_the_header(spark, tmp_path):
    src = str(tmp_path / "two_files")
    write_lines(src, [HEADER, "1,a"])
    with open(f"{src}/second.txt", "w") as f:
        f.write(HEADER + "\n2,b\n")
    with pytest.raises(ValueError):
        drop_header(scan_lines(spark, src))
    assert drop_header(scan_lines(spark, src), HEADER).count() == 2


def test_tab_in_a_field_shifts_the_text_layout(spark, tmp_path):
    raw = str(tmp_path / "raw_tab")
    write_lines(raw, [HEADER, "1,Cosmetics,Kajal,Lead,12,ppm,Ma\tker,India,Nepal,,"])
    clean = clean_records(scan_lines(spark, raw), limit_frame(spark, LIMITS), None, header=HEADER)
    out = str(tmp_path / "clean_tab")
    write_clean(clean, out, fmt="tsv")
    r = scan_clean(spark, out, fmt="tsv").first()
    assert (r["maker"], r["country"], r["country_alt"]) == ("Ma", "ker", "India")


def _many_lines():
    """Records over a few makers and items, some of which have no YES."""
    out = [HEADER]
    for i in range(300):
        maker, item = f"maker {i % 7}", f"item {i % 11}"
        reading = ["Unknown", "0.25", "3", "12.5", "NaN", "1,000", "0.5"][(i * i + i // 7) % 7] if i % 7 else "0.5"
        out.append(f"{i},{['Food-Spice', 'Cosmetics', 'Toys'][i % 3]},{item},{['Lead', 'Zinc'][i % 2]},\"{reading}\",ppm,"
                   f"{maker},{['India', 'Peru', 'N/A'][i // 5 % 3]},Chile,,")
    return out


def test_every_result_of_the_analytics_job_equals_its_operator(spark, tmp_path):
    from assayframe.operators import (group_hits, group_stats, hazard_rate, is_yes, nested_distribution, rank_by,
                                      value_distribution)
    from assayframe.plans.jobs import analytics_job, clean_job
    raw, out = str(tmp_path / "raw_all"), str(tmp_path / "clean_all")
    write_lines(raw, _many_lines())
    clean_job(spark, raw, out, limit_frame(spark, LIMITS), None)
    df = scan_clean(spark, out)
    want = {f"{stat}_by_{key}": rank_by(group_stats(df, key, stats=(stat,)), stat, key, k=None)
            for key in ("category", "country", "maker") for stat in ("mean", "median", "mode")}
    want["stddev_by_category"] = rank_by(group_stats(df, "category", stats=("stddev",)), "stddev", "category", k=None)
    want["analyte_distribution"] = rank_by(value_distribution(df, "analyte"), "n", "analyte", k=None)
    want["category_per_analyte"] = nested_distribution(df, "analyte", "category").orderBy("analyte")
    want["hazard_rate_category"] = rank_by(hazard_rate(df, "category"), "rate", "category", k=None)
    want["hazard_country_over_half"] = rank_by(hazard_rate(df, "country", min_rate=0.5), "rate", "country", k=None)
    want["hazard_maker_over_half"] = rank_by(hazard_rate(df, "maker", min_rate=0.5), "rate", "maker", k=None)
    want["top_makers"] = rank_by(group_hits(df, "maker", is_yes()), "n", "maker", k=None)
    want["top_items"] = rank_by(group_hits(df, "item", is_yes()), "n", "item", k=None)
    for k in (None, 4):
        got = analytics_job(spark, out, k=k)
        assert set(got) == set(want) and len(got) == 17
        for name, expected in want.items():
            rows_ = expected.collect()
            if k is not None and name != "category_per_analyte":
                rows_ = rows_[:k]
            found = got[name].collect()
            assert got[name].columns == expected.columns and len(found) == len(rows_), name
            for a, b in zip(found, rows_):
                for x, y in zip(a, b):      # σ and means: sums in another order
                    assert x == y or (isinstance(x, float) and (x == pytest.approx(y, rel=1e-9) or (x != x and y != y))), (name, a, b)
    makers = {r["maker"]: r["n"] for r in analytics_job(spark, out, k=None)["top_makers"].collect()}
    assert len(makers) == 7 and makers["maker 0"] == 0      # a maker without a YES is in the ranking


def test_typed_records_and_schema_versions(spark, tmp_path):
    from assayframe.sources.clean import TYPED, schema_version
    write_lines(str(tmp_path / "raw"), _many_lines())
    clean = clean_records(scan_lines(spark, str(tmp_path / "raw")), limit_frame(spark, LIMITS), None, header=HEADER)
    new, old, text = (str(tmp_path / x) for x in ("v2", "v1", "tsv"))
    write_clean(clean, new)
    clean.select(*CLEAN_COLUMNS).write.parquet(old)             # a table of the first version
    write_clean(clean, text, fmt="tsv")
    assert schema_version(spark, new) == 2 and schema_version(spark, old) == 1
    key = lambda r: repr(tuple(r))
    found = [sorted(scan_clean(spark, p, fmt=f, typed=True).collect(), key=key) for p, f in ((new, "parquet"), (old, "parquet"), (text, "tsv"))]
    assert list(map(key, found[0])) == list(map(key, found[1])) == list(map(key, found[2]))
    for r in found[0]:
        assert (r[TYPED] is None) == (r["reading"] == "Unknown")
        assert r[TYPED] is None or r["reading"] == "NaN" or r[TYPED] == float(r["reading"])
    plan = scan_clean(spark, new, typed=True).where(F.col(TYPED) > 2.0).select("maker", TYPED)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(reading_value,2.0)" in text             # the range reaches the files
    assert "ReadSchema: struct<maker:string,reading_value:double>" in text
    assert register_table(spark, "clean_typed", new).columns == list(CLEAN_COLUMNS)
    assert dict(spark.table("clean_typed").dtypes)[TYPED] == "double"


def test_publishing_keeps_the_old_table_until_the_new_one_is_whole(spark, tmp_path):
    from assayframe.sources.clean import current_folder, drop_old, publish_clean
    write_lines(str(tmp_path / "raw"), _many_lines())
    clean = clean_records(scan_lines(spark, str(tmp_path / "raw")), limit_frame(spark, LIMITS), None, header=HEADER)
    path = str(tmp_path / "published")
    first = publish_clean(clean.where("maker = 'maker 1'"), path)
    n = scan_clean(spark, path).count()
    assert n and current_folder(spark, path) == first
    fails = clean.withColumn("unit", F.when(F.col("record_id") == "290", F.raise_error(F.lit("lost"))).otherwise(F.col("unit")))
    with pytest.raises(Exception, match="lost"):
        publish_clean(fails, path)
    assert scan_clean(spark, path).count() == n and current_folder(spark, path) == first
    reader = scan_clean(spark, path)
    second = publish_clean(clean, path)
    assert scan_clean(spark, path).count() == clean.count() and reader.count() == n     # readers keep what they opened
    register_table(spark, "clean_pointed", path)
    assert spark.table("clean_pointed").count() == clean.count()
    assert len(drop_old(spark, path)) == 2 and current_folder(spark, path) == second    # the failed one too
    assert scan_clean(spark, path).count() == clean.count()
    for fmt in ("tsv",):
        publish_clean(clean, path + fmt, fmt=fmt)
        assert scan_clean(spark, path + fmt, fmt=fmt).count() == clean.count()


def _counted(frame):
    return sorted((tuple(r) for r in frame.select("dimension", "key", "rows", "yes", "decided", "na", "unknown").collect()),
                  key=repr)


@pytest.mark.parametrize("stop", ["before the rename", "after the rename"])
def test_durable_counts_of_a_stream_stopped_mid_batch_equal_the_batch_job(spark, tmp_path, monkeypatch, stop):
    from assayframe.operators.rates import group_counts, rate_of_counts
    from assayframe.streaming import keep_counts, rate_table, read_counts
    src, table, keys = str(tmp_path / "incoming"), str(tmp_path / "counts"), ["category", "country"]
    body = [line for line in LINES if line != HEADER]
    import os
    os.makedirs(src)
    for i in range(0, len(body), 3):
        with open(f"{src}/part-{i}.txt", "w") as f:
            f.write("\n".join([HEADER] + body[i:i + 3]) + "\n")
    lim = limit_frame(spark, LIMITS)

    def run():
        stream = clean_stream(read_line_stream(spark, src, max_files_per_trigger=1), lim, None, HEADER)
        q = keep_counts(stream, table, keys)
        q.awaitTermination(180)
        return q

    real, calls = rate_table.point, []

    def failing(s, path, name):
        calls.append(name)
        if len(calls) != 2:
            return real(s, path, name)
        if stop == "after the rename":
            real(s, path, name)
        raise RuntimeError("lost")

    monkeypatch.setattr(rate_table, "point", failing)
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.setattr(rate_table, "point", real)
    assert rate_table.applied_batch(spark, table)[1] == (1 if stop == "after the rename" else 0)
    run()
    batch = clean_records(scan_lines(spark, src), lim, None, header=HEADER)
    assert _counted(read_counts(spark, table)) == _counted(group_counts(batch, keys))
    rates = rate_of_counts(read_counts(spark, table), "category", "na", "rows")
    assert dict(map(tuple, rates.collect())) == {"Food-Spice": 0.5, "Cosmetics": 0.0, "Unknown": 1.0}
    with open(f"{src}/part-more.txt", "w") as f:                      # goes on where it stopped
        f.write("9,Toys,Top,Lead,5,ppm,M,Peru,Peru,,\n")
    run()
    batch = clean_records(scan_lines(spark, src), lim, None, header=HEADER)
    assert _counted(read_counts(spark, table)) == _counted(group_counts(batch, keys))


def test_durable_counts_refuse_other_streams_and_gaps(spark, tmp_path):
    from assayframe.streaming import read_counts
    from assayframe.streaming.rate_table import add_batch
    df = spark.createDataFrame([("a", "1", "YES"), (None, "Unknown", "NA"), ("a", "2", "NO")], "k string, reading string, flag string")
    path = str(tmp_path / "counts")
    assert read_counts(spark, path).count() == 0
    with pytest.raises(ValueError, match="does not follow"):
        add_batch(df, 1, path, ["k"], "s1")
    assert add_batch(df, 0, path, ["k"], "s1") and not add_batch(df, 0, path, ["k"], "s1")
    assert add_batch(df.limit(0), 1, path, ["k"], "s1")               # a batch without rows
    with pytest.raises(ValueError, match="stream"):
        add_batch(df, 2, path, ["k"], "s2")
    with pytest.raises(ValueError, match="does not follow"):
        add_batch(df, 3, path, ["k"], "s1")
    assert add_batch(df, 2, path, ["k"], "s1")
    assert _counted(read_counts(spark, path)) == [("k", "a", 4, 2, 4, 0, 0), ("k", None, 2, 0, 0, 2, 2)]


def test_every_line_is_accepted_or_has_the_first_rule_it_fails(spark, tmp_path):
    from assayframe.operators.rejects import accepted_records, reasons_report, rejected_lines, triage, write_triaged
    more = ["6,Toys, ,unknown,5,ppm,M,Peru,Peru,,", "7,Toys,Top, UNKNOWN ,5,ppm,M,Peru,Peru,,", "8,Toys,Top,Lead,,ppm,M,Peru,Peru,,",
            "8,Toys,Top,Lead,,ppm,M,Peru,Peru,,"]
    frame = spark.createDataFrame([(x, 1) for x in [*LINES, *more, None]], "value string, reason int")
    lim = limit_frame(spark, LIMITS)
    path = str(tmp_path / "triaged")
    report = write_triaged(triage(frame, lim, None, header=HEADER), path)
    got = sorted(map(tuple, rejected_lines(spark, path).collect()), key=repr)
    assert got == sorted([("", "too_few_fields"), ("short,line", "too_few_fields"), (None, "too_few_fields"),
                          (LINES[5], "missing_category"), (more[0], "missing_item"), (more[1], "missing_analyte"),
                          (more[2], "missing_reading"), (more[2], "missing_reading")], key=repr)
    by_rule = dict(map(tuple, reasons_report(spark, path).collect()))
    assert sum(by_rule.values()) == report["dropped"] == 8 and all(report[r] == n for r, n in by_rule.items())
    batch = clean_records(frame, lim, None, header=HEADER).select(*CLEAN_COLUMNS)
    records = accepted_records(spark, path)
    assert sorted(map(tuple, records.collect())) == sorted(map(tuple, batch.collect()))
    old = cleaning_report(frame.where("value is not null"), lim, None, header=HEADER).collect()[0]
    assert report["cleaned_records"] == old["cleaned_records"] and report["raw_records"] == old["raw_records"] + 1
    assert report["unknown_readings"] == old["unknown_readings"] and report["na_flags"] == old["na_flags"]
    assert {r["reading_value"] for r in accepted_records(spark, path, typed=True).collect()} == {1200.5, None, 12.0, 0.5}


def test_triage_reads_the_lines_once_and_handles_none(spark, tmp_path):
    from assayframe.operators.rejects import accepted_records, reasons_report, rejected_lines, triage, write_triaged
    write_lines(str(tmp_path / "raw"), LINES)
    lim = limit_frame(spark, LIMITS)
    triaged = triage(scan_lines(spark, str(tmp_path / "raw")), lim, None, header=HEADER)
    plan = triaged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "Exchange hashpartitioning" not in plan and "Python" not in plan
    path = str(tmp_path / "none")
    report = write_triaged(triage(spark.createDataFrame([], "value string"), lim, None, header=HEADER), path)
    assert set(report.values()) == {0}
    assert accepted_records(spark, path).count() == rejected_lines(spark, path).count() == 0
    assert {n for _, n in reasons_report(spark, path).collect()} == {0}
