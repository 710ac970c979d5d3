"""Token counts against the libraries' own counts of whole texts."""

import random

import pytest
from pyspark.sql import functions as F

from assayframe.llm import queries, token_counts
from .conftest import SF

LETTERS = ["a", "the", " ", "  ", "\n", "'re", "'", "re", "<|endoftext|>", "<|endof", "é", "東", "🙂", "é", "9",
           " foo", "ing", " bar", "!?", "\t", "word word", "x" * 30, "A</s>", " ", "\r\n"]


def own_count(path):
    if path.endswith(".json"):
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        return lambda text: len(t.encode(text or "", add_special_tokens=False).ids)
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda text: len(m.encode(text or ""))


def path(name):
    import public_tokenizers
    return public_tokenizers.path(name)


def test_query_counts_as_the_library_does(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    count = own_count(path("byte_bpe_50k.json"))
    want = sorted((d["doc_id"], len((d["text"] or "").encode()), count(d["text"])) for d in docs)
    got = queries.queries()["op11_token_counts"](spark, SF).collect()
    assert sorted((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_spliced_chunks_count_as_the_whole(spark, name):
    """Small chunks, so that most texts are spliced and some cuts fall into special
    strings, runs without a break and combined letters."""
    rng = random.Random(len(name))
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 900))) for _ in range(60)]
    texts += ["x" * 3000, "<|endoftext|>" * 300, " " * 2500, "é" * 1000 + " " + "9" * 1500, "", None, "a b " * 700, "a b " * 700]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(7, texts[7]), (None, texts[8])], "doc_id long, text string")
    got = token_counts.count_tokens(docs, path(name), chunk=256, overlap=96).collect()
    count = own_count(path(name))
    want = [(r["doc_id"], count(r["text"])) for r in docs.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([(r["doc_id"], r["n_tokens"]) for r in got], key=key) == sorted(want, key=key)


def test_edge_rows(edge_docs, no_docs):
    count = own_count(path("byte_bpe_50k.json"))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for chunk, overlap in ((token_counts.CHUNK, token_counts.OVERLAP), (4096, 256)):
        got = token_counts.count_tokens(edge_docs, chunk=chunk, overlap=overlap)
        assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        assert sorted([(r["doc_id"], r["n_tokens"]) for r in got.collect()], key=key) == sorted(
            [(r["doc_id"], count(r["text"])) for r in edge_docs.collect()], key=key)
    assert token_counts.count_tokens(no_docs).count() == 0


def test_overlaps_widen_until_chunks_align(spark):
    """A run without a break across a cut has no common boundary at the first width."""
    text = "word " * 100 + "y" * 700 + " word" * 400
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    p = path("byte_bpe_50k.json")
    keyed = docs.withColumn("digest", F.unhex(F.sha2("text", 256)))
    assert token_counts._spliced(keyed, p, 512, 128).first()["n_tokens"] is None
    assert token_counts._spliced(keyed, p, 2048, 512).first()["n_tokens"] == own_count(p)(text)
    assert token_counts.count_tokens(docs, p, chunk=512, overlap=128).first()["n_tokens"] == own_count(p)(text)


def test_vocabularies_that_cannot_be_proven_are_not_cut():
    assert token_counts._overlap_each_other(["<a>", "a><"]) and token_counts._overlap_each_other(["abab"])
    assert not token_counts._overlap_each_other(["<|startoftext|>", "<|endoftext|>"])
