"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text.

The model is over bytes: order ``ORDER`` n-grams of UTF-8, each packed into a long,
so that its tables are exact. Of the labelled documents, a half by hash of the id
trains: the model on all that are trusted there, the toxic words on the toxic ones
too. The other half is held out and sets the thresholds. Counts, continuation counts,
discounts and back-off weights are grouped sums and joins over n-gram tables.

Scoring joins counts by shard. Documents are dealt into blocks of about
``BLOCK_BYTES``; each block lists its distinct n-grams once, per shard of the model
(shards are by the two bytes before the last, which an n-gram shares with all its
lower orders and contexts); the lists meet the model's shard and come back with log
probabilities; the block then sums them over its documents. The texts are shuffled
once and read twice, and neither a shard nor a block grows with the input: a larger
model has more shards, and more blocks then share a copy of it.

A document is rejected when its log perplexity is above its language's threshold:
the ``quantile`` of held-out trusted documents of that language plus ``margin``
times their distance from the median to that quantile. Short texts scatter more:
``SHORT_SLACK`` over the root of their length in bytes is added. Languages with fewer than
``MIN_CALIBRATION`` such documents use the threshold over all languages.

A mean over a whole text hides single words and repeated passages, so a document is
also rejected when its worst word or its most repeated window (``word_scores``) is
above its language's limit. Of the quantiles of held-out trusted documents from
``quantile`` up to the largest value, the limit is the one with the fewest errors on
held-out labels: trusted above it, others not above it; the largest of equals.

Defined results: a null or empty text has no perplexity and is rejected; a null
language is a language of its own; without any trusted document nothing is
rejected but empty texts; every repeated row is scored and kept or rejected alike.
A document that is labelled more than once is trusted if all its labels are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.llm import _shingles, word_scores
from assayframe.llm._common import as_text, written

ORDER = 5                   # bytes; at most 8 fit a long
SHARDS = 12                 # at least
GRAMS_PER_SHARD = 200_000
BLOCK_BYTES = 16 << 20
PIECE_BYTES = 1 << 20       # of a block's texts, whose n-grams are in memory at a time
BLOCKS_PER_LOOKUP = 64      # with SHARDS shards; more with more
MAX_SENT = 2_000_000        # training ids that tasks get whole; more are joined
QUANTILE = 0.99
MARGIN = 1.0
SHORT_SLACK = 2.0
MIN_CALIBRATION = 50
LIMIT_STEPS = 10            # quantiles tried for a limit of the word scores


def _mask(k: int) -> int:
    return (1 << 8 * k) - 1


def ngrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte of each text (zero bytes stand before a
    text), and where each text's n-grams begin (one more entry)."""
    flat, begins = _shingles.text_bytes(texts)
    pad = ORDER - 1
    sizes = np.diff(begins)
    padded = np.zeros(len(flat) + pad * len(sizes), dtype=np.uint64)
    at = np.arange(len(flat)) + pad * np.repeat(np.arange(1, len(sizes) + 1), sizes)
    padded[at] = flat
    keys = np.zeros(len(flat), dtype=np.uint64)
    for i in range(ORDER):
        keys = (keys << np.uint64(8)) | padded[at - (pad - i)]
    return keys, begins


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _shingles.pieces(batches, PIECE_BYTES):
        keys, _ = ngrams(batch.column("text"))
        grams, counts = np.unique(keys, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(grams.astype(np.int64)), pa.array(counts.astype(np.int64))],
                                         names=["g", "c"])


def _discounts(n: list[float]) -> list[float]:
    """The three modified Kneser-Ney discounts from the numbers of n-grams seen
    once to four times; a discount that cannot be estimated is i / 2."""
    if not n[0] or not n[1]:
        return [0.5, 1.0, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    d = [i + 1 - (i + 2) * y * n[i + 1] / n[i] if n[i] else (i + 1) / 2 for i in range(3)]
    return [min(max(x, 0.0), i + 1.0) for i, x in enumerate(d)]


def train(texts: DataFrame, shards: int | None = None) -> DataFrame:
    """The model as rows ``shard, k, kind, key, value``: per order ``k`` the
    discounted probability of each n-gram (kind 0) and the back-off weight of each
    context (kind 1). Orders 1 and 2 are in every shard. Without ``shards`` their
    number goes by that of the n-grams."""
    counts = texts.select("text").mapInArrow(_count, "g long, c long")
    grams = {ORDER: written(counts.groupBy("g").agg(F.sum("c").alias("c")), "kn-grams")}
    for k in range(ORDER - 1, 0, -1):
        suffix = F.col("g").bitwiseAND(F.lit(_mask(k))).alias("g")
        grams[k] = written(grams[k + 1].select(suffix).groupBy("g").agg(F.count("*").alias("c")), "kn-grams")
    seen = {k: table.agg(F.count("*").alias("n"), *[F.sum((F.col("c") == i).cast("long")).alias(str(i)) for i in range(1, 5)])
            .first() for k, table in grams.items()}
    shards = shards or max(SHARDS, -(-sum(r["n"] for r in seen.values()) // GRAMS_PER_SHARD))
    parts = []
    for k, table in grams.items():
        d = _discounts([float(x or 0) for x in seen[k][1:]])
        taken = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        split = table.select("g", "c", F.shiftright("g", 8).alias("h"), taken.alias("d"))
        contexts = split.groupBy("h").agg(F.sum("c").alias("total"), F.sum("d").alias("freed"))
        alpha = split.join(contexts, "h").select(
            F.lit(0).alias("kind"), F.col("g").alias("key"), "h", ((F.col("c") - F.col("d")) / F.col("total")).alias("value"))
        gamma = contexts.select(F.lit(1).alias("kind"), F.col("h").alias("key"), "h",
                                (F.col("freed") / F.col("total")).alias("value"))
        both = alpha.unionByName(gamma)
        if k <= 2:
            both = both.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        else:
            both = both.withColumn("shard", _shard(F.col("h").bitwiseAND(F.lit(0xFFFF)), shards))
        parts.append(both.select("shard", F.lit(k).alias("k"), "kind", "key", "value"))
    model = parts[0]
    for p in parts[1:]:
        model = model.unionByName(p)
    return written(model, "kn-model")


def _shard(two_bytes, shards: int):
    return F.pmod(two_bytes * 40503, F.lit(shards)).cast("int")


def _distinct(keys: np.ndarray) -> np.ndarray:
    import pandas as pd
    return pd.unique(keys)


def _list_ngrams(shards: int):
    schema = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("keys", pa.binary())])

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        found = [np.empty(0, np.uint64)]
        for piece in _shingles.pieces(iter(table.to_batches()), PIECE_BYTES):
            found.append(_distinct(ngrams(piece.column("text"))[0]))
        keys = np.unique(np.concatenate(found))
        shard = (((keys >> np.uint64(8)) & np.uint64(0xFFFF)).astype(np.int64) * 40503) % shards
        lists = [_packed(keys[shard == s]) for s in range(shards)]
        return pa.Table.from_arrays([pa.array([key[0].as_py()] * shards), pa.array(range(shards), pa.int32()),
                                     pa.array(lists, pa.binary())], schema=schema)
    return run


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte plane by byte plane: the shuffle's
    compression then drops the high bytes, which are zero."""
    return np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(data) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").reshape(-1), dtype=np.uint64)


def log_probabilities(keys: np.ndarray, tables: dict) -> np.ndarray:
    """Natural log probability of each n-gram's last byte after the others.
    ``tables[k, kind]`` is a pair of arrays: sorted keys, values."""
    def look(k, kind, wanted, default):
        have, values = tables.get((k, kind), (np.empty(0, np.uint64), np.empty(0)))
        if not len(have):
            return np.full(len(wanted), default)
        at = np.minimum(np.searchsorted(have, wanted), len(have) - 1)
        return np.where(have[at] == wanted, values[at], default)
    p = np.full(len(keys), 1 / 256)
    for k in range(1, ORDER + 1):
        gram = keys & np.uint64(_mask(k))
        p = look(k, 0, gram, 0.0) + look(k, 1, gram >> np.uint64(8), 1.0) * p
    return np.log(p)


def _look_up(key: tuple[pa.Scalar, ...], lists: pa.Table, model: pa.Table) -> pa.Table:
    k, kind = model.column("k").to_numpy(), model.column("kind").to_numpy()
    keys, values = model.column("key").to_numpy().astype(np.uint64), model.column("value").to_numpy()
    tables = {}
    for order in range(1, ORDER + 1):
        for what in (0, 1):
            mine = np.flatnonzero((k == order) & (kind == what))
            mine = mine[np.argsort(keys[mine])]
            tables[order, what] = keys[mine], values[mine]
    logs = [log_probabilities(_unpacked(x.as_buffer()), tables).astype("<f4").tobytes() for x in lists.column("keys")]
    return pa.Table.from_arrays([lists.column("block"), lists.column("keys"), pa.array(logs, pa.binary())],
                                names=["block", "keys", "logs"])


def _sum_up(toxic: tuple[np.ndarray, np.ndarray]):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, lists: pa.Table) -> pa.Table:
        import pandas as pd
        keys = np.concatenate([np.empty(0, np.uint64), *(_unpacked(x.as_buffer()) for x in lists.column("keys"))])
        logs = np.concatenate([np.empty(0), *(np.frombuffer(x.as_buffer(), "<f4") for x in lists.column("logs"))])
        order = np.argsort(keys)
        keys, logs = keys[order], logs[order]
        sizes, sums, worst, repeats = [], [], [], []
        for piece in _shingles.pieces(iter(docs.to_batches()), PIECE_BYTES):
            grams, begins = ngrams(piece.column("text"))
            for to, values in zip((worst, repeats), word_scores.scores(piece.column("text"), toxic)):
                to.append(values)
            codes, distinct = pd.factorize(grams)
            upto = np.concatenate(([0.0], np.cumsum(logs[np.searchsorted(keys, distinct)][codes])))
            sizes.append(np.diff(begins))
            sums.append(upto[begins[1:]] - upto[begins[:-1]])
        n = np.concatenate([np.empty(0, np.int64), *sizes])
        total = np.concatenate([np.empty(0), *sums])
        return pa.Table.from_arrays([docs.column("doc_id"), docs.column("lang"), docs.column("fp"), pa.array(n),
                                     pa.array(np.round(total, 4)), pa.array(np.concatenate([np.empty(0), *worst])),
                                     pa.array(np.concatenate([np.empty(0, np.int64), *repeats]))],
                                    names=["doc_id", "lang", "fp", "n_bytes", "log_p", "worst_word", "repeats"])
    return run


NO_WORDS = np.empty(0, np.uint64), np.empty(0)


def score(docs: DataFrame, model: DataFrame, shards: int | None = None,
          toxic: tuple[np.ndarray, np.ndarray] = NO_WORDS) -> DataFrame:
    """``doc_id, lang, fp, n_bytes, log_p, worst_word, repeats`` per row of ``doc_id,
    lang, fp, text`` (``log_p``: natural log probability of the text's bytes; the last
    two by ``word_scores`` with the words of ``toxic``). ``shards`` is that of ``train``."""
    if shards is None:
        last = model.agg(F.max("shard")).first()[0]
        shards = SHARDS if last is None else last + 1
    size = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    n_blocks = -(-size // BLOCK_BYTES) or 1
    dealt = docs.select(F.pmod(F.xxhash64("doc_id", "fp"), F.lit(n_blocks)).alias("block"), "doc_id", "lang", "fp", "text")
    lists = dealt.groupBy("block").applyInArrow(_list_ngrams(shards), "block long, shard int, keys binary")
    per_lookup = max(1, BLOCKS_PER_LOOKUP * shards // SHARDS)
    lists = lists.withColumn("many", F.floor(F.col("block") / per_lookup))
    lookups = F.sequence(F.lit(0).cast("long"), F.lit((n_blocks - 1) // per_lookup).cast("long"))
    spread = model.select("*", F.explode(lookups).alias("many"))
    found = lists.groupBy("shard", "many").cogroup(spread.groupBy("shard", "many")).applyInArrow(
        _look_up, "block long, keys binary, logs binary")
    return dealt.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(
        _sum_up(toxic), "doc_id long, lang string, fp long, n_bytes long, log_p double, worst_word double, repeats long")


def _limits(held: DataFrame, of: Column, quantile: float) -> DataFrame:
    """``of, n, worst_word_limit, repeats_limit`` per value of ``of``; ``n`` counts the
    trusted rows. ``held`` has ``good, worst_word, repeats``."""
    held = held.withColumn("of", of)
    steps = [quantile + (1 - quantile) * i / LIMIT_STEPS for i in range(LIMIT_STEPS)] + [1.0]
    names = ("worst_word", "repeats")
    tried = held.where("good").groupBy("of").agg(F.count("*").alias("n"), *[
        F.percentile_approx(c, steps, F.lit(100_000)).alias(f"{c}_tried") for c in names])
    tried = tried.select(F.col("of").alias("tried_of"), "n", *[f"{c}_tried" for c in names])
    wrong = lambda c, limit: F.sum((F.col("good") == (F.col(c) > limit)).cast("long"))
    rows = held.join(F.broadcast(tried), F.col("of").eqNullSafe(F.col("tried_of")))
    return rows.groupBy("of").agg(F.first("n").alias("n"), *[F.array_min(F.array(*[
        F.struct(wrong(c, F.col(f"{c}_tried")[i]).alias("errors"), (-F.first(F.col(f"{c}_tried")[i])).alias("limit"))
        for i in range(len(steps))])).alias(c) for c in names]).select(
        "of", "n", *[(-F.col(f"{c}.limit")).cast("double").alias(f"{c}_limit") for c in names])


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN) -> DataFrame:
    """``doc_id, lang, fp, n_bytes, log_perplexity, threshold, worst_word,
    worst_word_limit, repeats, repeats_limit, keep`` per row of ``docs`` (``doc_id,
    text, lang``; other columns are ignored). ``labels`` has ``doc_id, quality,
    toxic``; trusted is quality 1 and not toxic."""
    text = as_text(F.col("text"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.xxhash64(text).alias("fp"), text.alias("text"))
    good = F.coalesce((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0), F.lit(False))
    toxic = F.coalesce(F.col("toxic") == 1, F.lit(False))
    labelled = written(labels.where("doc_id is not null").groupBy("doc_id").agg(
        (F.min(good.cast("int")) == 1).alias("good"), F.max(toxic.cast("int")).alias("toxic")), "kn-labels")
    # Half of the labelled documents train, all of them; the others set the thresholds.
    in_train = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(2)) == 0
    chosen = written(labelled.where(in_train & (F.col("good") | (F.col("toxic") == 1))).select("doc_id", "toxic"), "kn-train")
    n_train = {r["toxic"]: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    sent = sum(n_train.values()) <= MAX_SENT
    rows = docs.where(in_train).join(F.broadcast(chosen) if sent else chosen, "doc_id")
    model = train(rows.where("toxic = 0"))
    words = written(word_scores.toxic_words(rows, n_train.get(1, 0), n_train.get(0, 0)), "kn-words")
    few = word_scores.collected(words)
    scored = score(docs, model, toxic=NO_WORDS if few is None else few)
    if few is None:
        worst = word_scores.worst_words(docs, words).select(F.col("doc_id").alias("of_id"), F.col("fp").alias("of_fp"),
                                                            F.col("worst_word").alias("worst"))
        same = scored["doc_id"].eqNullSafe(worst["of_id"]) & (scored["fp"] == worst["of_fp"])
        scored = scored.join(worst, same, "left").withColumn("worst_word", F.coalesce("worst", F.lit(0.0)))
        scored = scored.drop("of_id", "of_fp", "worst")
    scored = written(scored, "kn-scores")
    scored = scored.select("doc_id", "lang", "fp", "n_bytes", F.when(
        F.col("n_bytes") > 0, -F.col("log_p") / F.col("n_bytes")).alias("log_perplexity"), "worst_word", "repeats")

    held = scored.where("n_bytes > 0").join(labelled.join(chosen, "doc_id", "left_anti"), "doc_id")
    held = written(held.select("lang", "good", "log_perplexity", "worst_word", "repeats"), "kn-held")
    middle, top = (F.percentile_approx("log_perplexity", q, F.lit(100_000)) for q in (0.5, quantile))
    limit = (top + margin * (top - middle)).alias("threshold")
    by_lang = held.where("good").groupBy("lang").agg(limit)
    cuts = _limits(held, F.col("lang"), quantile).where(F.col("n") >= MIN_CALIBRATION)
    names = ["worst_word_limit", "repeats_limit"]
    by_lang = by_lang.join(cuts, by_lang["lang"].eqNullSafe(cuts["of"])).select("lang", "threshold", *names)
    by_lang = written(by_lang, "kn-thresholds")     # one row per language
    overall = held.where("good").agg(limit).first()["threshold"]
    cut = _limits(held, F.lit(0), quantile).first()
    key = scored["lang"].eqNullSafe(by_lang["lang"])
    at = F.coalesce("threshold", F.lit(overall).cast("double")) + SHORT_SLACK / F.sqrt(F.greatest("n_bytes", F.lit(1)))
    out = scored.join(by_lang, key, "left").select(
        scored["doc_id"], scored["lang"], "fp", "n_bytes", "log_perplexity", at.alias("threshold"), "worst_word", "repeats",
        *[F.coalesce(c, F.lit(cut[c] if cut else None).cast("double")).alias(c) for c in names])
    kept = F.col("log_perplexity").isNotNull()
    for score_of, most in (("log_perplexity", "threshold"), ("worst_word", names[0]), ("repeats", names[1])):
        kept &= F.coalesce(F.col(score_of) <= F.col(most), F.lit(True))
    return out.withColumn("keep", kept)


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their columns unchanged."""
    good = classify(docs, labels, **options).where("keep").select(
        F.col("doc_id").alias("__good_id"), F.col("fp").alias("__good_fp"))
    same = docs["doc_id"].eqNullSafe(good["__good_id"]) & (F.xxhash64(as_text(docs["text"])) == good["__good_fp"])
    return docs.join(good, same, "left_semi")
