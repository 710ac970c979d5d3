"""Decontamination, fingerprints, line chunks and chat formatting: SQL, brute force
and edge rows; no Python in their plans."""

import collections
import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from assayframe.llm import chat, decontamination, fingerprints, line_chunks, queries, queries_native
from .conftest import SF

TABLES = ("documents", "benchmark", "conversations")


@pytest.mark.parametrize("name", sorted(queries_native.ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(queries_native.ORACLE[name])
    cols = sorted(c[0] for c in cur.description)
    names = [c[0] for c in cur.description]
    want = sorted(tuple(dict(zip(names, r))[c] for c in cols) for r in cur.fetchall())
    df = queries.queries()[name](spark, SF)
    assert sorted(df.columns) == cols
    assert sorted(tuple(r[c] for c in cols) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(queries_native.QUERIES))
def test_native_queries_run_no_python(spark, name):
    df = queries.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


# ------------------------------------------------------------------ decontamination
def words13(text):
    import re
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_contamination_on_edge_rows(spark, edge_docs):
    items = spark.createDataFrame(
        [(1, "quick brown fox"), (1, "quick brown fox"), (2, ""), (3, None), (None, "lazy dog"),
         (4, "thirteen at least"), (5, "ÉTÉ"), (6, "word1 of1 word2 of2 word3 of3 word4 of4 word5 of5 word6 of6 word7")],
        "item_id long, text string")
    got = decontamination.contamination(edge_docs, items).collect()
    wins = {}
    for i, t in [(1, "quick brown fox"), (4, "thirteen at least"), (5, "ÉTÉ"),
                 (6, "word1 of1 word2 of2 word3 of3 word4 of4 word5 of5 word6 of6 word7")]:
        wins[i] = tuple(words13(t))
    want = collections.Counter()
    for d, text in [(r["doc_id"], r["text"]) for r in edge_docs.collect()]:
        w, hit, items_hit = words13(text), set(), set()
        for i, g in wins.items():
            for p in range(len(w) - len(g) + 1):
                if tuple(w[p:p + len(g)]) == g:
                    hit |= set(range(p, p + len(g)))
                    items_hit.add(str(i))
        want[d, len(w), len(hit), tuple(sorted(items_hit)), bool(hit) and 20 * len(hit) >= len(w)] += 1
    assert collections.Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"]), r["contaminated"])
                               for r in got) == want


def test_large_window_table_is_joined_by_shuffle(spark, edge_docs):
    items = spark.createDataFrame([(1, "quick brown fox")], "item_id long, text string")
    a = decontamination.contamination(edge_docs, items).collect()
    b = decontamination.contamination(edge_docs, items, max_broadcast_bytes=0).collect()
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def test_spans_and_documents_are_removed(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "Quick, brown FOX")], "item_id long, text string")
    cut = decontamination.drop_spans(edge_docs, items)
    assert cut.columns == edge_docs.columns
    texts = {r["doc_id"]: r["text"] for r in cut.where("doc_id in (1, 6)").collect()}
    assert texts == {1: "The jumps over the lazy dog and runs far away from here today now", 6: "one two"}
    left = decontamination.drop_contaminated(edge_docs, items)
    assert left.columns == edge_docs.columns and left.count() == edge_docs.count() - 3
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.drop_contaminated(edge_docs, nothing).count() == edge_docs.count()
    assert decontamination.contamination(no_docs, items).count() == 0


# ------------------------------------------------------------------ fingerprints
def jaccard(a, b):
    x, y = collections.Counter(a.lower().split()), collections.Counter(b.lower().split())
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def test_fingerprints_estimate_generalised_jaccard(spark, small_docs):
    rows = {r["doc_id"]: r for r in queries.queries()["op6_fingerprints"](spark, SF).collect()}
    docs = sorted(small_docs, reverse=True)
    errors = []
    for (d, text), (_, following) in zip(docs, docs[1:] + docs[:1]):
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        assert rows[d]["n_chars"] == len(text)
        assert rows[d]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        errors.append(rows[d]["near_edited"] - jaccard(text, edited))
    assert abs(sum(errors) / len(errors)) < 0.03                       # unbiased: sd of the mean is below 0.01
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.11     # binomial with 32 samples


def test_fingerprints_of_edge_rows(edge_docs, no_docs):
    got = collections.defaultdict(set)
    rows = fingerprints.fingerprints(edge_docs).collect()
    for r in rows:
        got[r["doc_id"]].add((r["n_chars"], r["fingerprint"]))
    assert len(rows) == edge_docs.select("doc_id", F.coalesce("text", F.lit(""))).distinct().count()
    assert got[1] == got[2] and len(got[13]) == 2
    assert {f for _, f in got[3] | got[4] | got[5]} == {"-" * 256}
    assert fingerprints.fingerprints(no_docs).count() == 0


def test_next_document_wraps_around(spark):
    keys = spark.createDataFrame([(k, d, 0) for k, d in [(10, 1), (20, 5), (30, 3), (40, None)]],
                                 "key long, doc_id long, n_chars long")
    got = {r["key"]: r["next_key"] for r in fingerprints.next_by_id(keys).collect()}
    assert got == {20: 30, 30: 10, 10: 40, 40: 20}


# ------------------------------------------------------------------ line chunks
def test_repeated_chunks_of_edge_rows(edge_docs, no_docs):
    rows = line_chunks.dedup_lines(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[4]["text"] == "" and by[4]["n_lines"] == 0 and by[3]["n_chunks"] == 0
    assert by[6]["text"] == "one two" and by[1]["text"].startswith("The quick")
    assert line_chunks.dedup_lines(no_docs).count() == 0


def test_shifted_chunks_are_found(spark):
    lines = [f"shared line {i}" for i in range(60)]
    a = "\n".join(lines)
    b = "\n".join(["something new"] + lines[:30] + ["in the middle"] + lines[30:])
    rows = {r["doc_id"]: r for r in line_chunks.dedup_lines(
        spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")).collect()}
    assert rows[1]["text"] == a
    assert rows[2]["n_removed_lines"] >= 35 and "something new" in rows[2]["text"]
    assert "in the middle" in rows[2]["text"]


@pytest.mark.parametrize("min_lines", [1, 2, 3])
def test_chunks_have_their_least_number_of_lines_and_exact_copies_lose_all(spark, min_lines):
    import random
    rnd = random.Random(min_lines)
    texts = ["\n".join(str(rnd.randint(0, 10 ** 6)) for _ in range(n)) for n in range(1, 120)]
    docs = spark.createDataFrame([(k * 1000 + i, t) for k in range(3) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = docs.select("doc_id", F.lit(0).alias("fp"), "text")
    sizes = line_chunks._chunks(rows, line_chunks.WINDOW, line_chunks.MEAN_LINES, min_lines).select(
        "doc_id", F.transform("chunks", lambda c: c["n_lines"]).alias("n")).collect()
    assert all(sum(r["n"]) == r["doc_id"] % 1000 + 1 and min(r["n"]) >= min(min_lines, sum(r["n"])) for r in sizes)
    assert max(len(r["n"]) for r in sizes) >= 120 // (3 * min_lines + 4)
    for r in line_chunks.dedup_lines(docs, min_lines=min_lines).collect():
        k, i = divmod(r["doc_id"], 1000)
        whole = k == 0 or i + 1 < min_lines
        assert r["text"] == (texts[i] if whole else "") and r["n_removed_lines"] == (0 if whole else i + 1)


# ------------------------------------------------------------------ chat
CHAT = [(1, 0, "system", "be kind"), (1, 1, "user", "hi [INST]"), (1, 2, "assistant", "</s> \\b ok"),
        (2, 0, "user", None), (2, 0, "user", None), (2, 1, "assistant", ""),
        (3, 1, "assistant", "first"), (3, 2, None, "nobody"), (3, 3, "tool]x[", "out<put"), (3, None, "user", "untimed"),
        (None, 0, "user", "no id"), (None, 1, "assistant", "none")]


def test_chat_round_trip_and_validity(spark):
    rows = spark.createDataFrame([(*r, "x", "y") for r in CHAT],
                                 "conv_id long, turn long, role string, text string, turns string, state string")
    out = chat.format_conversations(rows)
    back = {r["conv_id"]: r for r in out.select(
        "*", chat.parse_formatted(F.col("formatted")).alias("back"), chat.loss_text(F.col("segments")).alias("loss")).collect()}
    for conv in (1, 2, 3, None):
        turns = sorted([r for r in CHAT if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        r = back[conv]
        assert [(t["role"], t["text"]) for t in r["back"]] == [(t[2] or "", t[3] or "") for t in turns]
        assert r["loss"] == "".join(t[3] or "" for t in turns if t[2] == "assistant")
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        masked = [r["formatted"][s["start"] - 1:s["start"] - 1 + s["length"]] for s in r["loss_spans"]]
        assert masked == [s["text"] for s in r["segments"] if s["loss"]]
    assert back[1]["complete"] and back[1]["n_invalid"] == 0
    assert not back[2]["complete"] and back[2]["n_invalid"] == 1
    assert back[3]["n_invalid"] == 2 and back[None]["complete"]
    assert chat.format_conversations(rows.where("1 = 0")).count() == 0


def test_template_rejects_ambiguous_markers():
    with pytest.raises(ValueError):
        chat.Template(begin="s>")
    with pytest.raises(ValueError):
        chat.Template(turns={"a": chat.Turn("[A", "[/A]"), "b": chat.Turn("[AB]", "[/AB]")})
