"""The corpus pipeline, stage by stage, on a small fixture with planted documents."""

import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from assayframe.llm import mixing
from assayframe.llm._common import written
from .conftest import SF
from .test_free import exact_components

CLASHES = ("count", "h", "key", "block", "part", "probability", "tokens", "topic", "cls", "fp", "keep", "label")


def planted(spark, base, benchmark):
    """The small documents with copies, near copies, contaminated documents, junk, nulls,
    empty texts, repeated rows and extra columns under names that the stages use."""
    good = sorted((r for r in base.where("length(text) between 800 and 2000 and lang = 'en' and text not like '% | %'").collect()),
                  key=lambda r: r["doc_id"])[:3]
    item = max((r["text"] for r in benchmark.collect()), key=lambda t: len(t or ""))
    a, b = good[0]["text"], good[1]["text"]
    near = a.split(" ")
    near[len(near) // 2] = "thother"
    rows = [(70001, a), (70002, " ".join(near)), (70003, b + "\n" + item), (70004, item), (70005, "qqqzx " * 400),
            (70006, "".join(chr(33 + (i * 7919) % 90) for i in range(900))), (70007, None), (70008, ""), (70009, "  \n"),
            (None, good[2]["text"] + " and the rest of it"), (70010, b), (70010, b)]
    extra = spark.createDataFrame([(d, t, "en", "web", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    both = base.select("doc_id", "text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars")).unionByName(extra)
    return both.select("*", *[F.lit("x").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def seen(spark, tmp_path_factory):
    """Input and output rows of every stage of one run, and the result."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    read = lambda n: spark.read.parquet(f"{SF}/{n}.parquet")
    planted(spark, read("documents"), read("benchmark")).write.parquet(f"{folder}/documents.parquet")
    for n in ("labels", "benchmark"):
        read(n).write.parquet(f"{folder}/{n}.parquet")
    found, stages = [], corpus_pipeline.STAGES

    def spy(f):
        def stage(spark, docs, sf_dir):
            out = written(f(spark, docs, sf_dir), "spied")
            found.append((docs.collect(), out.collect(), docs.columns, out.columns))
            return out
        return stage
    corpus_pipeline.STAGES = [(n, spy(f)) for n, f in stages]
    try:
        result = corpus_pipeline.run(spark, folder).collect()
    finally:
        corpus_pipeline.STAGES = stages
    return found, result, read("benchmark").collect(), {r["doc_id"]: r for r in read("labels").collect()}


def ids(rows):
    return collections.Counter(r["doc_id"] for r in rows)


def test_stages_keep_the_columns_and_what_came_before(seen):
    found, *_ = seen
    assert len(found) == 5
    for before, after, names, kept_names in found[:4]:
        assert kept_names == names and not ids(after) - ids(before) and len(after) <= len(before)
    assert all(ids(a[1]) == ids(b[0]) for a, b in zip(found, found[1:]))


def test_quality_rejects_junk_and_keeps_trusted(seen):
    found, _, _, labels = seen
    before, after = ids(found[0][0]), ids(found[0][1])
    assert not {70005, 70006, 70007, 70008} & set(after)
    texts = {r["doc_id"]: r["text"] for r in found[0][0]}
    trusted = [d for d, r in labels.items() if r["quality"] == 1 and not r["toxic"] and texts.get(d)]
    lost = [(d, len(texts[d]), texts[d][:60]) for d in trusted if d not in after]
    # The 0.99 quantiles of three scores come from some thirty held-out documents here.
    assert len(lost) <= 0.1 * len(trusted), lost
    assert before[70010] == 2
    for d in (70001, 70010):        # equal texts have one fate, whatever their ids
        assert len({x in after for x, t in texts.items() if t == texts[d]}) == 1


def test_near_duplicates_equal_brute_force(seen):
    before, after = seen[0][1][:2]
    rows = [(r["doc_id"], r["text"]) for r in before]
    want = collections.Counter(d for d, _, least in exact_components(rows, 5, 80) if d == least)
    assert ids(after) == want
    assert not {70001, 70002, 70010} & set(want)        # copies of documents with smaller ids


def test_decontamination_equals_brute_force(seen):
    found, _, benchmark, _ = seen
    before, after = found[2][:2]
    words = lambda t: re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    grams = {tuple(w[i:i + 13]) for w in (words(r["text"]) for r in benchmark) if w for i in range(max(len(w) - 12, 1))}
    want = []
    for r in before:
        w, hit = words(r["text"]), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in grams:
                    hit.update(range(i, i + n))
        if not (hit and 20 * len(hit) >= len(w)):
            want.append(r["doc_id"])
    assert ids(after) == collections.Counter(want)
    assert 70004 not in ids(after)


def test_mixing_equals_plain_raking(spark, seen):
    before, after = seen[0][3][:2]
    tokens = [len(re.findall("[^\x20\x09-\x0D]+", r["text"] or "")) for r in before]
    topic = ["table" if " | " in (r["text"] or "") else "short" if n < 100 else "long" if n >= 1000 else "prose" for r, n in zip(before, tokens)]
    cells = collections.Counter()
    of = [(r["source"] or "", r["lang"] or "", t) for r, t in zip(before, topic)]
    for c, n in zip(of, tokens):
        cells[c] += n
    names, base = list(cells), np.maximum(np.array(list(cells.values()), float), 1.0)
    weight, whole = base.copy(), base.sum()
    groups, targets = [], []
    for k in range(3):
        values, g = np.unique([c[k] for c in names], return_inverse=True)
        t = np.bincount(g, np.array(list(cells.values()), float)) ** 0.85
        groups.append(g)
        targets.append(t / t.sum())
    for _ in range(400):
        for g, t in zip(groups, targets):
            weight *= (t * whole / np.maximum(np.bincount(g, weight), 1e-300))[g]
    chance = dict(zip(names, weight / base / (weight / base).max()))
    docs = spark.createDataFrame([(r["doc_id"],) for r in before], "doc_id long")
    draw = {r["doc_id"]: r["u"] for r in docs.select("doc_id", mixing.uniform(F.col("doc_id"), 7).alias("u")).collect()}
    kept = ids(after)
    for r, c in zip(before, of):
        if abs(draw[r["doc_id"]] - chance[c]) > 1e-3:
            assert (r["doc_id"] in kept) == (draw[r["doc_id"]] < chance[c]), (r["doc_id"], draw[r["doc_id"]], chance[c])


def test_token_output_equals_the_library(seen):
    import public_tokenizers
    from tokenizers import Tokenizer
    found, result, *_ = seen
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, want = 0, []
    for r in sorted(found[4][0], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)):
        tokens = np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        want.append((r["doc_id"], start, len(tokens), zlib.crc32(tokens.tobytes())))
        start += len(tokens)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted([tuple(r[c] for c in ("doc_id", "start", "n_tokens", "ids_crc32")) for r in result], key=key) == sorted(want, key=key)


def test_stages_take_empty_tables(spark, edge_docs):
    none = edge_docs.where("1 = 0").withColumn("n_chars", F.lit(0).cast("long"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0
