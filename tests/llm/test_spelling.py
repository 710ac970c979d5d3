"""Spelling variants against all pairs."""

import collections
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from assayframe.llm import queries, spelling
from .conftest import SF

ALPHABET = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))


def words_of(docs):
    counts = collections.Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def near_of(words, w):
    made = {w[:i] + w[i + 1:] for i in range(len(w))}
    made |= {w[:i] + c + w[i + k:] for i in range(len(w) + 1) for c in ALPHABET for k in (0, 1)}
    return {x for x in made if x in words and x != w}


def variants(words):
    form, out = {}, {}
    for w, n in words.items():
        near = near_of(words, w)
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
        out[w] = (n, len(near), words.get(form[w]))
    rows = []
    for w, (n, n_near, form_n) in out.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, n_near, form_n))
    return sorted(rows, key=lambda r: r[0])


def found(df):
    return sorted(((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()), key=lambda r: r[0])


def invented(seed, n=400):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abcéstz") for _ in range(rng.randint(5, 8))): rng.randint(3, 400) for _ in range(n)}
    for w in list(words) * 2:
        i, k = rng.randrange(len(w)), rng.random()
        words.setdefault(w[:i] + w[i + 1:] if k < .3 else w[:i] + rng.choice("abcÿ") + w[i + (k > .6):], rng.randint(3, 50))
    words |= {"q" * 300: 5, "q" * 301: 11, "q" * 299 + "r": 30, "a" * 70: 3, "a" * 69 + "b": 3, "z" * 800: 4}
    return {w: n for w, n in words.items() if len(w) >= 5}


def test_query_equals_all_pairs_and_its_sql(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = found(queries.queries()["op13_spelling"](spark, SF))
    assert got == variants(words_of(docs))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    cur = con.execute(queries.oracle()["op13_spelling"])
    cols = [d[0] for d in cur.description]
    want = [dict(zip(cols, r)) for r in cur.fetchall()]
    assert sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in want) == sorted(got)


@pytest.mark.parametrize("limit", [20_000, 40, 7])
def test_blocks_lose_no_pair(spark, monkeypatch, limit):
    """Many blocks, and leaves of more words than a block may hold."""
    monkeypatch.setattr(spelling, "BLOCK_WORDS", limit)
    words = invented(limit) | {"".join(p): 3 for p in itertools.permutations("abcdef")}
    got = found(spelling.group_variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == variants(words)


def test_search_equals_all_pairs():
    words = sorted(invented(3, 700))
    data = [w.encode("latin-1") for w in words]
    a, b = spelling.near_pairs(data, spelling.letter_counts(data), np.ones(len(data), bool))
    got = [tuple(sorted((words[x], words[y]))) for x, y in zip(a, b)]
    want = {tuple(sorted((w, x))) for w in words for x in near_of(set(words), w)}
    assert len(got) == len(set(got)) and set(got) == want


def test_chains_end_at_their_root(spark):
    words = {"house": 1000, "hause": 400, "hausen": 150, "hausenn": 50, "haussenn": 20, "x" * 9: 5, "x" * 10: 5}
    got = found(spelling.group_variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == variants(words)
    assert {r[0]: r[2] for r in got}["haussenn"] == "house"


def test_edge_rows(edge_docs, no_docs):
    got = spelling.spelling_variants(edge_docs)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert found(got) == variants(words_of([(r["doc_id"], r["text"]) for r in edge_docs.collect()]))
    assert spelling.spelling_variants(no_docs).count() == 0
