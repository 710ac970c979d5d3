"""The operators that run numpy inside tasks, against brute force and round trips."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assayframe.llm import (_shingles, kneser_ney, maxent_lm, mixing, near_dup, queries, simple8b, suffix_dedup,
                            superminhash, token_files, word_scores)
from assayframe.llm.components import components
from assayframe.session import scratch_path
from .conftest import SF, lower_words


# ------------------------------------------------------------------ shared numpy helpers
def test_shingle_sets_are_exact():
    rng = random.Random(1)
    letters = ["a", "B", "b", " ", "  ", "\n", "\t", "é", "x", "\x0b", "\x1c"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(1500)] + ["", " "]
    arr = pa.array(texts).slice(3)
    names = {}
    for text, found in zip(texts[3:], _shingles.sets(arr, 3)):
        w = lower_words(text)
        want = frozenset(tuple(w[i:i + 3]) for i in range(len(w) - 2)) or (frozenset([tuple(w)]) if w else frozenset())
        assert len(found) == len(want)
        assert names.setdefault(want, found.tobytes()) == found.tobytes()
    assert len(set(names.values())) == len(names)


@pytest.mark.parametrize("n", [3, 100])
def test_superminhash_is_unbiased_with_less_variance(n):
    rng, errors = np.random.default_rng(0), []
    for _ in range(300):
        u = rng.integers(0, 2 ** 63, int(n * 1.25) + 1).astype(np.uint64)
        a, b = u[:n], u[len(u) - n:]
        true = len(np.intersect1d(a, b)) / len(u)
        s = superminhash.signatures(np.concatenate([a, b]), np.array([0, n, 2 * n]), 64)
        errors.append((s[0] == s[1]).mean() - true)
    assert abs(np.mean(errors)) < 0.012
    assert np.std(errors) < 0.9 * math.sqrt(true * (1 - true) / 64)


# ------------------------------------------------------------------ near duplicates
def exact_components(docs, k, percent):
    sets, parent = [], list(range(len(docs)))
    for _, t in docs:
        w = lower_words(t or "")
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    groups = collections.defaultdict(list)
    for i, (d, _) in enumerate(docs):
        groups[root(i)].append(d)
    least = {r: min((d for d in g if d is not None), default=None) for r, g in groups.items()}
    return [(d, len(sets[i]), least[root(i)] if sets[i] else d) for i, (d, _) in enumerate(docs)]


def test_near_dup_query_is_exact(spark, small_docs):
    got = queries.queries()["op9_near_dup"](spark, SF).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(exact_components(small_docs, 3, 85))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_dup_on_edge_rows(edge_docs, no_docs):
    got = near_dup.near_duplicates(edge_docs, 3, 85).collect()
    want = exact_components([(r["doc_id"], r["text"]) for r in edge_docs.collect()], 3, 85)
    assert sorted(map(repr, [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got])) == sorted(map(repr, want))
    kept = near_dup.drop_near_duplicates(edge_docs, 3, 85)
    assert kept.columns == edge_docs.columns and {r["doc_id"] for r in kept.collect()} >= {1, 3, 4, 6, 8, 13, None}
    assert near_dup.near_duplicates(no_docs).count() == 0


def test_crowd_of_near_copies_is_one_group(spark):
    """Copies that are near their origin but less so to one another: a bucket far
    above the size up to which all pairs are looked at."""
    rng = random.Random(5)
    origin = [f"w{i}" for i in range(200)]
    docs = [(1000, " ".join(origin))]
    for d in range(120):
        copy = origin[:]
        for at in rng.sample(range(200), 4 + d % 2):
            copy[at] = f"new{d}x{at}"
        docs.append((d, " ".join(copy)))
    got = near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 3, 85).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(exact_components(docs, 3, 85))


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 60)] + [(7, 7)]
    got = {r["a"]: r["b"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(101, 161)} | {i: 1 for i in range(2, 60)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------------ suffix dedup
def repeats(docs):
    seen, out = set(), []
    for d, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            w = data[i:i + 100]
            if w in seen:
                gone[i:i + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((d, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def as_rows(df):
    return sorted((repr(tuple(r)) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()))


def test_suffix_dedup_query_is_exact(spark, small_docs):
    assert as_rows(queries.queries()["op2_suffix_dedup"](spark, SF)) == sorted(map(repr, repeats(small_docs)))


def test_suffix_dedup_bounds_do_not_change_the_result(spark, small_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = suffix_dedup.dedup_bytes(docs, hot_key=4, bucket_rows=20, segment=1500)
    assert as_rows(got) == sorted(map(repr, repeats(small_docs)))


def test_suffix_dedup_of_periodic_and_edge_texts(spark, edge_docs, no_docs):
    rng = random.Random(2)
    unit = "".join(rng.choice("ab") for _ in range(37))
    docs = [(1, "x" * 5000), (2, unit * 40), (3, "y" + unit * 9), (4, "ab" * 300), (5, "x" * 99), (6, None), (7, ""),
            (8, "é" * 120), (9, "x" * 50 + "é" * 120), (None, "x" * 200)]
    docs += [(20 + i, "".join(rng.choice("ab") for _ in range(400))) for i in range(5)]
    docs += [(40 + i, docs[11][1][i:i + 150] + "tail%d" % i) for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert as_rows(suffix_dedup.dedup_bytes(df)) == sorted(map(repr, repeats(docs)))
    assert suffix_dedup.dedup_bytes(edge_docs).count() == edge_docs.count()
    assert suffix_dedup.dedup_bytes(no_docs).count() == 0
    spans = suffix_dedup.dedup_bytes(df, spans=True).where("doc_id = 1").first()
    assert [tuple(s) for s in spans["spans"]] == [(1, 5000)] or spans["n_removed"] == sum(e - b for b, e in spans["spans"])


def test_suffix_dedup_sends_only_lists_that_hold_something_a_few_at_a_time(monkeypatch):
    rng = random.Random(4)
    passages = ["".join(rng.choice("abcdef ") for _ in range(300)) for _ in range(20)]
    texts = [" ".join(rng.sample(passages, 3)) for _ in range(40)]
    docs = pa.table({"doc_id": list(range(40)), "fp": list(range(40)), "text": texts})
    keys = suffix_dedup._list_keys(1 << 12, 5000)((pa.scalar(3),), docs)
    assert 0 < keys.num_rows < 1 << 12 and min(len(k) for k in keys["keys"].to_pylist()) > 0
    known = pa.table({"repeated": [b"".join(keys["keys"].to_pylist())], "hot": [b""]})
    contexts = lambda lists: sorted(c[i:i + suffix_dedup.WIDE] for c in lists["bytes"].to_pylist()
                                    for i in range(0, len(c), suffix_dedup.WIDE))
    whole = suffix_dedup._list_contexts(1, 5000)((pa.scalar(3),), docs, known)
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 10_000)
    lists = suffix_dedup._list_contexts(1 << 12, 5000)((pa.scalar(3),), docs, known)
    assert contexts(lists) == contexts(whole) and len(contexts(whole)) > 200
    assert all(len(r["sent"]) + len(r["alone"]) + len(r["found"]) for r in lists.to_pylist())
    batches = lists.to_batches()
    assert len(batches) > 3 and all(sum(map(len, b["bytes"].to_pylist())) < 12_000 for b in batches)


def test_difference_cover_resolves_every_pair():
    for v in (8, 32, 64):
        cover = suffix_dedup.difference_cover(v)
        shift = suffix_dedup.common_shift(cover, v)
        inside = set(cover.tolist())
        assert all((a + shift[a, b]) % v in inside and (b + shift[a, b]) % v in inside for a in range(v) for b in range(v))
        assert len(cover) <= v / 2


# ------------------------------------------------------------------ token output
def test_simple8b_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 59, 60, 61, 255, 256, 257, 5003):
        for top in (1, 2, 50_000, 2 ** 32, 2 ** 62):
            v = rng.integers(0, top, n, dtype=np.uint64)
            v[:n // 2] >>= np.uint64(7)
            words, offsets, escaped = simple8b.pack(v)
            assert (simple8b.unpack(words, offsets, n, escaped) == v).all()
    v = np.array([0, 2 ** 60 - 1, 2 ** 60, 2 ** 64 - 1, 2 ** 53 + 1], dtype=np.uint64)
    words, offsets, escaped = simple8b.pack(v)
    assert (simple8b.unpack(words, offsets, len(v), escaped) == v).all() and len(escaped) == 2
    assert len(simple8b.pack(np.ones(256, np.uint64))[0]) == 5          # sixty one-bit values a word


def whole_ids(texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(token_files.default_tokenizer())
    return [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_encoder_equals_the_tokenizer_on_odd_texts():
    rng = random.Random(3)
    letters = ["a", "b", " ", "  ", "\n", "\t", ",", ".", "'s", "1", "é", " ", "\x1c", "\x85", "<|endoftext|>", " ",
               "!", "　", "́", "​"]
    texts = ["", " ", "  a", "a  b", "\n x", "x <|endoftext|> y", "\n <|endoftext|>", "end "]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 12))) for _ in range(4000)]
    encoder = token_files.Encoder(token_files.default_tokenizer(), cache_entries=500)
    got = []
    for a in range(0, len(texts), 300):
        lengths, ids = encoder.encode(pa.array(texts[a:a + 300]))
        got += [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])]
    assert got == whole_ids(texts)


def test_encoder_looks_up_a_text_of_sixteen_megabytes_at_once(monkeypatch):
    """A stretch that many texts hold is looked up once for all of them, and the ids stay the same."""
    text = "the cat, it sat.\non mats " * 200
    batch = pa.record_batch({"part": pa.array([0] * 2400, pa.int32()), "doc_id": list(range(2400)), "text": [text] * 2400})
    asked, plain = [], token_files.Encoder.encode
    monkeypatch.setattr(token_files.Encoder, "encode", lambda self, t: asked.append(len(t)) or plain(self, t))
    writer = token_files._writer(token_files.default_tokenizer(), 2, 1 << 30, 1000)
    (out,) = writer(iter([batch]))
    lengths, ids = token_files.shard_values(out.column("payload")[0].as_py())
    (want,) = whole_ids([text])
    assert len(asked) == 1 and ids.tolist() == [*want, 2] * 2400


def check_token_rows(got, docs):
    at = 0
    for r, (d, ids) in zip(sorted(got, key=lambda r: r["start"]), docs):
        ids = [*ids, 2]
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (d, at, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_token_query_round_trip(spark, small_docs):
    docs = sorted(small_docs)
    got = queries.queries()["op8_token_output"](spark, SF).collect()
    assert len(got) == len(docs)
    check_token_rows(got, zip([d for d, _ in docs], whole_ids([t for _, t in docs])))


def test_token_files_of_edge_rows(spark, edge_docs, no_docs):
    path = scratch_path(spark, "edge-shards")
    token_files.write_token_files(edge_docs, path, shard_ids=50)
    back = token_files.read_token_files(spark, path)
    texts = [r["text"] or "" for r in edge_docs.collect()]
    want = collections.Counter(np.array([*ids, 2], "<u4").tobytes() for ids in whole_ids(texts))
    rows = sorted(back.collect(), key=lambda r: r["start"])
    assert collections.Counter(bytes(r["ids"]) for r in rows) == want
    assert [r["doc_id"] for r in rows] == sorted([r["doc_id"] for r in rows], key=lambda d: (d is not None, d or 0))
    path = scratch_path(spark, "no-shards")
    token_files.write_token_files(no_docs, path)
    assert token_files.read_token_files(spark, path).count() == 0


# ------------------------------------------------------------------ mixing
def test_raking_meets_the_marginals(spark):
    got = queries.queries()["op1_mixing"](spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().set_index("doc_id")
    assert len(got) == len(docs)
    assert (got.tokens.values == [len(lower_words(docs.text[d])) for d in got.doc_id]).all()
    cells = got.groupby(["source", "lang", "topic"]).tokens.sum().clip(lower=1).astype(float)
    weight, total = cells.copy(), cells.sum()
    for _ in range(200):
        for d in ("source", "lang", "topic"):
            share = got.groupby(d).tokens.sum() ** mixing.TEMPER
            want = share / share.sum() * total
            have = weight.groupby(level=d).sum()
            weight = weight * (want / have).reindex(weight.index.get_level_values(d)).values
    ratio = weight / cells
    ratio /= ratio.max()
    want = ratio.reindex(list(zip(got.source, got.lang, got.topic))).values
    assert np.allclose(got.probability, want, rtol=1e-3)
    assert abs(got.sampled.mean() - got.probability.mean()) < 0.12


def test_mixing_given_targets_and_edge_rows(spark, edge_docs, no_docs):
    target = lambda d, m: spark.createDataFrame(list(m.items()), f"{d} string, target double")
    docs = spark.createDataFrame([(i, "en" if i % 4 else "de", "s%d" % (i % 3), "t", 10) for i in range(1200)],
                                 "doc_id long, lang string, source string, topic string, tokens long")
    got = mixing.mix(docs, {"lang": target("lang", {"en": 1.0, "de": 1.0}), "source": target("source", {"s0": 2.0, "s1": 1.0})},
                     dims=("lang", "source")).toPandas()
    kept = got[got.sampled]
    assert set(kept.source) == {"s0", "s1"} and (got[got.source == "s2"].probability == 0).all()
    assert abs((kept.lang == "de").mean() - 0.5) < 0.06 and abs((kept.source == "s0").mean() - 2 / 3) < 0.06
    rows = mixing.mix_documents(edge_docs).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["probability"] <= 1 for r in rows)
    assert mixing.sample_documents(edge_docs).columns == edge_docs.columns
    assert mixing.mix_documents(no_docs).count() == 0 and mixing.sample_documents(no_docs).count() == 0


# ------------------------------------------------------------------ quality classifier
def plain_model(train, order):
    """Interpolated modified Kneser-Ney over bytes, with dictionaries."""
    counts = {order: collections.Counter()}
    for t in train:
        data = bytes(order - 1) + t.encode()
        for i in range(len(data) - order + 1):
            counts[order][data[i:i + order]] += 1
    for k in range(order - 1, 0, -1):
        counts[k] = collections.Counter(g[1:] for g in counts[k + 1])
    d, total, freed = {}, {}, {}
    for k, table in counts.items():
        n = collections.Counter(table.values())
        d[k] = kneser_ney._discounts([float(n[i]) for i in range(1, 5)])
        total[k], freed[k] = collections.Counter(), collections.Counter()
        for g, c in table.items():
            total[k][g[:-1]] += c
            freed[k][g[:-1]] += d[k][min(c, 3) - 1]

    def p(gram):
        if not gram:
            return 1 / 256
        k, h = len(gram), gram[:-1]
        if not total[k][h]:
            return p(gram[1:])
        c = counts[k][gram]
        return ((c - d[k][min(c, 3) - 1]) / total[k][h] if c else 0.0) + freed[k][h] / total[k][h] * p(gram[1:])
    return lambda t: sum(math.log(p((bytes(order - 1) + t.encode())[i:i + order])) for i in range(len(t.encode())))


def test_kneser_ney_equals_a_plain_model(spark, small_docs):
    train, rest = small_docs[:40], small_docs[40:70]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    model = kneser_ney.train(frame(train), shards=3)
    docs = frame(rest + train[:5]).select("doc_id", F.lit("en").alias("lang"), F.xxhash64("text").alias("fp"), "text")
    got = {r["doc_id"]: r for r in kneser_ney.score(docs, model, shards=3).collect()}
    want = plain_model([t for _, t in train], kneser_ney.ORDER)
    for d, t in rest[:12] + train[:5]:
        assert got[d]["n_bytes"] == len(t.encode())
        assert got[d]["log_p"] == pytest.approx(want(t), rel=1e-6)


def test_quality_separates_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.queries()["op5_quality"](spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert len(got) == docs.count()
    both = got.merge(labels, on="doc_id")
    assert both[(both.quality == 1) & (both.toxic == 0)].keep.mean() > 0.98
    assert both[both.quality == 0].keep.mean() < 0.35


def test_quality_rejects_toxic_words_and_repeats(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.queries()["op5_quality"](spark, sf).toPandas()
    both = got.merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    both = both[both.n_bytes > 0]
    assert both[(both.quality == 1) & (both.toxic == 0)].keep.mean() > 0.98
    assert both[(both.quality == 1) & (both.toxic == 1) & (both.lang == "en")].keep.mean() < 0.1
    assert both[both.quality == 0].keep.mean() < 0.05


def test_word_scores_equal_a_plain_version():
    texts = ["A b, a B! c", "", "x", "one two three " * 9, "scum"]
    words, _ = word_scores.words(pa.array(["scum", "b"]))
    order = np.argsort(words)
    worst, repeats = word_scores.scores(pa.array(texts), (words[order], np.array([2.5, 1.0])[order]))
    assert worst.tolist() == [1.0, 0.0, 0.0, 0.0, 2.5]
    n = word_scores.WINDOW
    for t, r in zip(texts, repeats.tolist()):
        w = re.findall(r"[a-z0-9]+", t.lower())
        again = [x in w[max(i - n + 1, 0):i] for i, x in enumerate(w)]
        assert r == max((sum(again[max(i - n + 1, 0):i + 1]) for i in range(len(w))), default=0)


def test_quality_on_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 1, None), (None, 1, 0), (8, None, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = kneser_ney.classify(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count()
    assert {r["keep"] for r in rows if not r["n_bytes"]} == {False}
    assert kneser_ney.keep_good(edge_docs, labels).columns == edge_docs.columns
    nothing = labels.where("1 = 0")
    kept = kneser_ney.keep_good(edge_docs, nothing)
    assert kept.count() == edge_docs.where("length(text) > 0").count()
    assert kneser_ney.classify(no_docs, labels).count() == 0


# ------------------------------------------------------------------ language model
def test_lm_query_counts_and_held_out_gain(spark, small_docs):
    got = {r["doc_id"]: r for r in queries.queries()["op4_lm_scoring"](spark, SF).collect()}
    tokens = {d: lower_words(t) + [None] for d, t in small_docs}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in tokens}
    count = collections.Counter(w for d in tokens if not held[d] for w in tokens[d])
    n, v, base, score, size = sum(count.values()), len(count), 0.0, 0.0, 0
    for d, w in tokens.items():
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[d], len(w), n)
        assert r["n_known"] == sum(x in count for x in w)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), rel=1e-9)
        if held[d]:
            base, score, size = base + r["base_score"], score + r["score"], size + len(w)
    assert score / size > base / size + 0.3


def test_lm_probabilities_sum_to_one(spark, small_docs):
    docs = spark.createDataFrame(small_docs[:60], "doc_id long, text string")
    counts, model = maxent_lm.train(docs)
    words = counts.toPandas()
    y = model["classes"](words.word.to_numpy().view(np.uint64), words.ending.to_numpy())
    share = np.bincount(y, weights=words.c, minlength=maxent_lm.CLASSES)
    assert np.allclose(share, model["mass"]) and share.sum() == model["n"]
    hashes, endings, first = maxent_lm.tokens(pa.array([t for _, t in small_docs[:5]]))
    logs = maxent_lm.class_log_probabilities(maxent_lm.features(hashes, first), model["weights"])
    used = model["mass"] > 0
    assert np.allclose(np.exp(logs).sum(axis=1), 1, atol=1e-5) and used.any()


def test_lm_learns_contexts_that_share_hashed_features(spark):
    """Far more contexts than hashed features, each with its own next word."""
    rng = random.Random(3)
    then = {f"w{i}": f"n{i}{'abcdefgh'[rng.randrange(8)] * 3}" for i in range(30_000)}
    docs = [(i, " ".join(f"{w} {then[w]}" for w in rng.sample(list(then), 500))) for i in range(400)]
    got = maxent_lm.score(spark.createDataFrame(docs, "doc_id long, text string")).where("held_out").toPandas()
    assert got.score.sum() / got.n_tokens.sum() > got.base_score.sum() / got.n_tokens.sum() + 0.4


def test_lm_rounds_read_all_training_documents(spark, small_docs, monkeypatch):
    plain, seen = maxent_lm._summed, []
    monkeypatch.setattr(maxent_lm, "_summed", lambda *a: seen.append(plain(*a)) or seen[-1])
    _, model = maxent_lm.train(spark.createDataFrame(small_docs, "doc_id long, text string"))
    rounds = [x for x in seen if x.ndim == 3]
    assert len(rounds) == maxent_lm.ROUNDS and all(r[0, -1].sum() == model["n"] for r in rounds)
    assert all(r[1, -1].sum() == pytest.approx(model["n"], rel=1e-4) for r in rounds[1:])


def test_lm_rounds_cut_no_texts_into_tokens(spark, small_docs, monkeypatch):
    plain, read = maxent_lm._summed, []
    monkeypatch.setattr(maxent_lm, "_summed", lambda texts, make, shape, *a: read.append((shape, texts.columns)) or plain(texts, make, shape, *a))
    maxent_lm.train(spark.createDataFrame(small_docs[:20], "doc_id long, text string"))
    assert [columns for shape, columns in read if len(shape) == 3] == [["low", "keys", "counts"]] * maxent_lm.ROUNDS


def _sums(batches, kind):
    return np.frombuffer(b"".join(b for batch in batches for b in batch.column("sums").to_pylist()), kind).reshape(
        2, -1, maxent_lm.CLASSES)


def test_lm_rounds_against_every_token(small_docs, monkeypatch):
    """Some rows of features from some tokens at a time; empty texts and copies among them."""
    monkeypatch.setattr(maxent_lm, "PIECE_BYTES", 5_000)
    monkeypatch.setattr(maxent_lm, "FEATURE_TOKENS", 2_000)
    monkeypatch.setattr(maxent_lm, "ROW_FEATURES", 300)
    monkeypatch.setattr(maxent_lm, "SCORE_TOKENS", 77)
    texts = pa.array([f"text {t}" for _, t in small_docs[:60]] + ["", "one", "one b one b one b"] * 40)
    hashes, endings, first = maxent_lm.tokens(texts)
    classes = maxent_lm.Classes(np.unique(hashes)[:9], np.arange(maxent_lm.SUFFIXES) % (maxent_lm.CLASSES - maxent_lm.SINGLES))
    y, rows = classes(hashes, endings), maxent_lm.features(hashes, first)
    listed = list(maxent_lm._list_features(classes)(iter([pa.record_batch({"text": texts})])))
    assert len(listed) > 1 and max(b.num_rows for b in listed) > 1
    got = collections.Counter()
    for key, of, n in maxent_lm._listed(iter(listed)):
        for *r, k, c in zip(*maxent_lm._split(key), of, n):
            got[(*r, k)] += c
    offsets = maxent_lm.BUCKETS * np.arange(maxent_lm.TEMPLATES)[:, None]
    assert got == collections.Counter(zip(*(rows - offsets), y))

    weights = np.random.default_rng(1).normal(size=(maxent_lm.TEMPLATES * maxent_lm.BUCKETS + 1, maxent_lm.CLASSES))
    p = np.exp(maxent_lm.class_log_probabilities(rows, weights))
    seen, expected = np.zeros((2, *weights.shape))
    for r in [*rows, np.full(len(y), -1)]:
        np.add.at(seen, (r, y), 1)
        np.add.at(expected, r, p)
    assert (_sums(maxent_lm._observed_counts(iter(listed)), "<f8")[0] == seen).all()
    read, found = _sums(maxent_lm._expected_counts(weights)(iter(listed)), "<f4")
    assert (read[-1] == seen[-1]).all() and np.allclose(found, expected, rtol=1e-4, atol=1e-6)


def test_lm_features_of_no_texts():
    classes = maxent_lm.Classes(np.empty(0, np.uint64), np.zeros(maxent_lm.SUFFIXES, np.int64))
    assert not list(maxent_lm._list_features(classes)(iter([])))
    assert not _sums(maxent_lm._observed_counts(iter([])), "<f8").any()
    assert not _sums(maxent_lm._expected_counts(np.zeros((maxent_lm.TEMPLATES * maxent_lm.BUCKETS + 1, maxent_lm.CLASSES)))(
        iter([])), "<f4").any()


@pytest.mark.parametrize("bits, tail", [(49, 5), (64, 0)])
def test_lm_order_is_that_of_the_whole_keys(bits, tail):
    rng = np.random.default_rng(2)
    near = rng.integers(0, 1 << 12, 5_000, dtype=np.uint64)         # the upper bits alone do not tell these apart
    top = np.uint64(1) << np.uint64(bits - 1)
    far = rng.integers(0, 1 << (bits - 1), 95_000, dtype=np.uint64)
    for keys in (np.concatenate((near, near | top, far, far[:9_000])), near, near[:1], near[:0]):
        keys = rng.permutation(keys)
        order, ordered = maxent_lm._order(keys, bits, tail)
        assert (ordered == np.sort(keys)).all() and (keys[order] == ordered).all()
        assert (np.sort(order) == np.arange(len(keys))).all()


def test_lm_common_tokens_that_share_low_bits():
    singles = np.array([5, 5 + (1 << 12), 5 + (1 << 13), 1], dtype=np.uint64)
    known = maxent_lm.Classes(singles, np.zeros(maxent_lm.SUFFIXES, np.int64))
    others = singles + np.uint64(1 << 40)
    assert known.single(np.concatenate((singles, others, singles[::-1]))).tolist() == [
        0, 1, 2, 3, *[maxent_lm.SINGLES] * 4, 3, 2, 1, 0]


def test_lm_words_of_a_block_are_counted_in_training_texts():
    hashes = np.array([9, 3, 9, 7, 3, 9, 2**64 - 1], dtype=np.uint64)
    distinct, n = maxent_lm._sorted_words(hashes, np.array([1, 0, 0, 0, 0, 1, 1], bool))
    assert distinct.tolist() == [3, 7, 9, 2**64 - 1] and n.tolist() == [0, 0, 2, 1]


@pytest.mark.parametrize("raw", [0, 3])
def test_lm_planes_come_back(raw):
    for values in ([], [0], [1, 255, 256, 0], [2**49 - 1, 7, 2**24]):
        got = maxent_lm._from_planes(pa.py_buffer(maxent_lm._planes(np.array(values, np.uint64), raw)))
        assert got.tolist() == values


def test_lm_strength_is_small_where_contexts_decide():
    own, prior = np.array([50, 40, 60]), np.full(3, 1 / 32)
    assert maxent_lm.strength(own, own, prior) == maxent_lm.STRENGTHS[0]
    own, whole = np.tile([2, 2, 2, 2], 50), np.full(200, 64)
    assert maxent_lm.strength(own, whole, np.full(200, 1 / 32)) > 64


def test_lm_on_edge_rows(edge_docs, no_docs):
    rows = maxent_lm.score(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) and r["n_tokens"] >= 1 for r in rows)
    assert maxent_lm.score(no_docs).count() == 0


def _plain_lm(docs):
    """A dictionary version of the whole model, from its classes and first weights on."""
    tokens = [(d, [*lower_words(t), None]) for d, t in docs]
    held = [zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in tokens]
    count = collections.Counter(w for (_, ws), h in zip(tokens, held) if not h for w in ws)
    return tokens, held, count


def test_lm_softmax_of_a_block_is_taken_some_tokens_at_a_time(monkeypatch):
    rng = random.Random(6)
    docs = pa.table({"doc_id": list(range(50)), "text": [" ".join(rng.choice("abcdefgh") for _ in range(30)) for _ in range(50)],
                     "held": [i % 7 == 2 for i in range(50)]})
    classes = maxent_lm.Classes(np.empty(0, np.uint64), np.arange(maxent_lm.SUFFIXES) % (maxent_lm.CLASSES - maxent_lm.SINGLES))
    weights = np.random.default_rng(0).normal(size=(maxent_lm.TEMPLATES * maxent_lm.BUCKETS + 1, maxent_lm.CLASSES))
    model = {"classes": classes, "weights": weights, "mass": np.full(maxent_lm.CLASSES, 50.0), "n": 1300, "v": 9, "unseen": 0.01}
    lists = maxent_lm._list_keys(classes, 1)((pa.scalar(0),), docs)
    share = np.full(maxent_lm.CLASSES, 1 / maxent_lm.CLASSES)
    found = pa.concat_tables([maxent_lm._sum_keys(share, 1)((pa.scalar(t),), lists.slice(t, 1)) for t in range(4)])
    score = lambda: maxent_lm._score(model, 1)((pa.scalar(0),), docs, found)
    whole, widths, plain = score(), [], maxent_lm._odds
    monkeypatch.setattr(maxent_lm, "SCORE_TOKENS", 100)
    monkeypatch.setattr(maxent_lm, "_odds", lambda rows, factors: widths.append(rows.shape[1]) or plain(rows, factors))
    assert score().equals(whole)
    assert len(widths) == 16 and max(widths) <= 100


def test_word_hashes_do_not_depend_on_how_many_are_taken_at_a_time(monkeypatch):
    texts = pa.array(["one two three", "", "x" * 500 + " y", "one two"] * 3)
    plain = maxent_lm.tokens(texts)[0]
    monkeypatch.setattr(_shingles, "HASH_BYTES", 7)
    assert (maxent_lm.tokens(texts)[0] == plain).all()


def test_lm_score_against_dictionaries(spark, small_docs, monkeypatch):
    """Words, contexts and strengths counted in dictionaries; the hashed weights are the model's own."""
    docs = small_docs[:80]
    kept = {}
    plain = maxent_lm.train
    monkeypatch.setattr(maxent_lm, "train", lambda texts: kept.setdefault("model", plain(texts)))
    monkeypatch.setattr(maxent_lm, "BLOCK_BYTES", 20_000)          # many blocks
    monkeypatch.setattr(maxent_lm, "TOKENS_PER_SHARD", 1 << 30)    # one shard: one strength per template
    got = {r["doc_id"]: r for r in maxent_lm.score(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    model = kept["model"][1]
    tokens, held, count = _plain_lm(docs)
    shares = (model["mass"] + 0.5) / (model["mass"] + 0.5).sum()
    hashes, endings, first = maxent_lm.tokens(pa.array([t for _, t in docs]))
    y = model["classes"](hashes, endings)
    p = np.exp(maxent_lm.class_log_probabilities(maxent_lm.features(hashes, first), model["weights"]))[np.arange(len(y)), y]
    training = np.repeat(~np.array(held), np.diff(first))
    for t in (2, 0, 1):
        before = []
        for _, ws in tokens:
            for i in range(len(ws)):
                one, two = (ws[i - 1] if i else 0), (ws[i - 2] if i > 1 else 0)
                before.append((one,) if t == 0 else (one, two) if t == 1 else (two,))
        own, whole = collections.Counter(), collections.Counter()
        for c, k, in_training in zip(before, y, training):
            own[c, k] += int(in_training)
            whole[c] += int(in_training)
        keys = list(own)
        alpha = maxent_lm.strength(np.array([own[k] for k in keys]), np.array([whole[k[0]] for k in keys]),
                                   shares[[k[1] for k in keys]])
        p = [(own[c, k] + alpha * q) / (whole[c] + alpha) for c, k, q in zip(before, y, p)]
    at = 0
    for d, ws in tokens:
        total = 0.0
        for w in ws:
            known = (1 - model["unseen"]) * p[at] * count[w] / model["mass"][y[at]] if count[w] else model["unseen"]
            total, at = total + math.log10(known), at + 1
        assert got[d]["score"] == pytest.approx(total, rel=1e-5)


def test_lm_sends_only_lists_that_hold_something(spark, small_docs):
    docs = spark.createDataFrame(small_docs[:60], "doc_id long, text string").selectExpr(
        "pmod(doc_id, 1000) AS block", "doc_id", "text", "false AS held")
    classes = maxent_lm.Classes(np.empty(0, np.uint64), np.zeros(maxent_lm.SUFFIXES, np.int64))
    lists = docs.groupBy("block").applyInArrow(maxent_lm._list_keys(classes, 1 << 20),
                                               "block long, shard long, keys binary, counts binary").collect()
    sizes = [len(maxent_lm._from_planes(pa.py_buffer(bytes(r["keys"])))) for r in lists]
    assert min(sizes) == 1 and sum(sizes) <= 4 * sum(len(lower_words(t)) + 1 for _, t in small_docs[:60])
    assert len({(r["block"], r["shard"]) for r in lists}) == len(lists) <= sum(sizes)


@pytest.mark.parametrize("tasks", [0, 1, 16, 17, 400, 400_000])
def test_lm_sums_in_a_tree(tasks):
    levels = [tasks, *maxent_lm._fan_in(tasks), 1]
    assert all(a <= maxent_lm.FAN_IN * b for a, b in zip(levels, levels[1:]))


def test_lm_tree_adds_every_task(spark):
    def ones(batches):
        rows = sum(b.num_rows for b in batches)
        yield maxent_lm._as_rows(np.full((3, 5), float(rows)))
    texts = spark.range(0, 1000, 1, 40).selectExpr("cast(id as string) AS text")
    assert (maxent_lm._summed(texts, ones, (3, 5)) == 1000).all()


def _classified(docs, labels):
    return sorted(map(str, kneser_ney.classify(docs, labels).collect()))


def test_quality_word_tables_of_any_size_score_alike(spark, edge_docs, monkeypatch):
    """A table too large to send whole is joined, with the same result."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.select("doc_id", "text", "lang").unionByName(edge_docs.selectExpr("doc_id + 100000 AS doc_id", "text", "lang"))
    tables, plain = [], word_scores.toxic_words
    monkeypatch.setattr(word_scores, "toxic_words", lambda *a: tables.append(plain(*a)) or tables[-1])
    sent = _classified(docs, labels)
    assert tables[0].count() > 3
    monkeypatch.setattr(word_scores, "MAX_COLLECTED", 3)
    assert _classified(docs, labels) == sent


def test_quality_trains_on_every_trusted_document_of_its_half(spark, monkeypatch):
    """However many they are, and the same whether their ids are sent or joined."""
    n = 44_000
    docs = spark.range(n).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'en' AS lang")
    labels = spark.range(n).selectExpr("id AS doc_id", "1 AS quality", "CAST(id % 1000 = 7 AS int) AS toxic")
    half = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(2)) == 0).where("doc_id % 1000 <> 7")
    trained, plain = [], kneser_ney.train
    monkeypatch.setattr(kneser_ney, "train", lambda texts: trained.append(texts) or plain(texts))
    sent = kneser_ney.classify(docs, labels)
    assert trained[0].count() == half.count() > 20_000
    monkeypatch.setattr(kneser_ney, "MAX_SENT", 10)
    joined = kneser_ney.classify(docs, labels)
    assert "BroadcastHint" not in str(trained[1]._jdf.queryExecution().logical())
    assert sent.exceptAll(joined).count() == joined.exceptAll(sent).count() == 0


def test_quality_model_of_many_shards_scores_alike(spark, small_docs, monkeypatch):
    train = spark.createDataFrame(small_docs[:60], "doc_id long, text string")
    docs = train.select("doc_id", F.lit("en").alias("lang"), F.xxhash64("text").alias("fp"), "text")
    scores = lambda: sorted(map(str, kneser_ney.score(docs, kneser_ney.train(train)).collect()))
    few = scores()
    monkeypatch.setattr(kneser_ney, "GRAMS_PER_SHARD", 1000)
    assert kneser_ney.train(train).agg(F.max("shard")).first()[0] + 1 > 3 * kneser_ney.SHARDS
    assert scores() == few


def test_quality_word_odds_against_dictionaries(spark):
    rng = random.Random(8)
    rows = [(" ".join(rng.choice("abcdefghij") * 2 for _ in range(rng.randrange(6))), i % 2) for i in range(60)]
    t, c = (collections.Counter(w for text, toxic in rows if toxic == v for w in set(text.split())) for v in (1, 0))
    want = [math.log((t[w] + 0.5) / 31) - math.log((c[w] + 0.5) / 31) for w in t if t[w] >= word_scores.MIN_DOCUMENTS]
    got = word_scores.toxic_words(spark.createDataFrame(rows, "text string, toxic int"), 30, 30)
    hashes, odds = word_scores.collected(got)
    assert (np.diff(hashes.astype(object)) > 0).all()
    assert sorted(odds) == pytest.approx(sorted(x for x in want if round(x, 6) > 0), abs=1e-6)
