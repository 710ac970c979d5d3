"""Phrase counts and collocations against a plain version."""

import collections
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from assayframe.llm import phrases, queries
from .conftest import SF


def counts_of(docs, max_words=3):
    total, f = collections.Counter(), collections.Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    return total, f


def best_of(docs, max_words=3, min_count=10, best=2000, contained=50):
    total, f = counts_of(docs, max_words)
    candidates = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= min_count}
    longest = collections.Counter()
    for (lang, p), a in candidates.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                longest[lang, p[i:i + m]] = max(longest[lang, p[i:i + m]], a)
    rows = collections.defaultdict(list)
    for (lang, p), a in candidates.items():
        if longest[lang, p] and 100 * longest[lang, p] >= contained * a:
            continue
        score, _, l, r = min((1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                             for k in range(1, len(p)))
        rows[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, i + 1, p.decode(), -a, l, r, total[lang], -score)
                  for lang, found in rows.items() for i, (score, a, p, l, r) in enumerate(sorted(found)[:best]))


def found(df):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect())


def test_query_equals_brute_force_and_its_sql(spark):
    docs = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = found(queries.queries()["op12_phrases"](spark, SF))
    assert got and got == best_of(docs)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    cur = con.execute(queries.oracle()["op12_phrases"])
    assert [d[0] for d in cur.description] == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(cur.fetchall()) == got


def invented(seed, n=80):
    rng = random.Random(seed)
    words = ["the", "a", "É", "x", "of", "House", "東京", "b c"] + [f"w{i}" for i in range(30)]
    gaps = [" "] * 12 + ["  ", "\t", ". ", ", ", "\n", "!", " ; "]
    text = lambda: "".join("the" + rng.choice(gaps) if rng.random() < .3 else rng.choice(words) + rng.choice(gaps)
                           for _ in range(rng.randint(0, 300)))
    return [(rng.choice(["en", "de", None, "und", "a b"]), text()) for _ in range(n)] + [("en", None), (None, ""), ("de", "x " * 3000)]


@pytest.mark.parametrize("run_words, bucket, max_words", [(1 << 20, 16 << 20, 3), (50, 3000, 3), (64, 500, 2), (97, 2000, 4)])
def test_small_runs_and_buckets_change_nothing(spark, monkeypatch, run_words, bucket, max_words):
    """Runs of a few words and buckets that the common words overflow."""
    from pyspark import cloudpickle
    docs = invented(run_words)
    monkeypatch.setattr(phrases, "RUN_WORDS", run_words)
    monkeypatch.setattr(phrases, "BUCKET_BYTES", bucket)
    cloudpickle.register_pickle_by_value(phrases)       # the tasks see the small sizes too
    try:
        df = spark.createDataFrame(docs, "lang string, text string")
        assert found(phrases.collocations(df, max_words=max_words)) == best_of(docs, max_words)
        counts, totals = phrases.phrase_counts(df, max_words, 4)
        total, f = counts_of(docs, max_words)
        assert {(r["lang"], tuple(r["phrase"].split(" "))): r["c"] for r in counts.collect()} == {x: c for x, c in f.items() if c >= 4}
        assert {r["lang"]: r["n"] for r in totals.collect()} == {k: v for k, v in total.items() if v}
    finally:
        cloudpickle.unregister_pickle_by_value(phrases)


@pytest.mark.parametrize("least", [(1, 1, 1), (6, 6, 6), (1, 1, 5)])
def test_three_way_partitions_count_prefixes(least):
    rng = np.random.default_rng(sum(least))
    keys = [rng.integers(0, 5, 700), rng.integers(-1, 6, 700), rng.integers(-1, 4, 700)]
    keys[2][keys[1] < 0] = -1
    weights = rng.integers(1, 4, 700)
    want = collections.Counter()
    for a, b, c, w in zip(*keys, weights):
        for p in ((a,), (a, b), (a, b, c)):
            if min(p) >= 0:
                want[tuple(map(int, p))] += int(w)
    got = {tuple(int(k[at]) for k in keys[:d + 1]): int(n)
           for d, pointers, counts in phrases.multikey_counts(keys, weights, least) for at, n in zip(pointers, counts)}
    assert got == {p: n for p, n in want.items() if n >= least[len(p) - 1]}


def test_scores_are_exact(spark):
    rows = [(10 ** 14 - 7, 10 ** 14 + 3, 10 ** 14 + 9), (999_999_999_999, 10 ** 12, 10 ** 12 + 1), (10, 10, 10), (3, 7, 10 ** 14)]
    df = spark.createDataFrame(rows, "a long, l long, r long").select(phrases.exact_score(F.col("a"), F.col("l"), F.col("r")).alias("s"))
    assert [r["s"] for r in df.collect()] == [1_000_000 * a * a // (l * r) for a, l, r in rows]


def test_edge_rows(edge_docs, no_docs):
    docs = [(r["lang"], r["text"]) for r in edge_docs.collect()]
    assert found(phrases.collocations(edge_docs, min_count=2)) == best_of(docs, min_count=2)
    assert phrases.collocations(no_docs).count() == 0
