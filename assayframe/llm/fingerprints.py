"""Document fingerprints by consistent weighted sampling.

A document is a bag of words: each word weighs the number of times it occurs. For
each of ``k`` samples a word draws, from hashes of itself, r and c from
Gamma(2, 1) and b from the uniform distribution; with weight w it takes
t = floor(ln w / r + b) and a = c * exp(-r * (t - b + 1)), and the sample is the
(word, t) with the least a. Two documents share a sample with probability equal
to the generalised Jaccard similarity of their bags (sum of the smaller weights
over sum of the larger ones), so the share of equal samples estimates it.

Everything is built-in functions. ln a is compared as an integer of 2**-24 steps,
packed above 32 bits that name (word, t); the minimum of that long is the sample,
so each document needs ``k`` hash-aggregated minima and no sort.

Defined results: words are split at ASCII white space, lower case; a null text is
empty; a document without words has the sample -1 everywhere, so two such
documents are alike and no other is like them. Rows with equal id and text are one
document; rows with one id and different texts are different documents. Columns
other than the id and the text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayframe.llm._common import as_text, written

SAMPLES = 32
EMPTY = -1
_SPACE = r"[\x20\x09-\x0D]+"


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key, doc_id, text`` per row; the key is a hash of id and text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), as_text(F.col(text_col)).alias("text"))
    return rows.withColumn("key", F.xxhash64("doc_id", "text"))


def texts_by_key(rows: DataFrame) -> DataFrame:
    """``key, text``: each document once, partitioned by the key; what follows
    groups and joins on it without moving the text again."""
    return rows.select("key", "text").dropDuplicates(["key"])


def ids_by_key(rows: DataFrame) -> DataFrame:
    return rows.select("key", "doc_id", F.length("text").cast("long").alias("n_chars")).dropDuplicates(["key"])


def _samples(term: Column, log_weight: Column, k: int) -> list[Column]:
    def uniform(h, shift, bits):
        part = F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << bits) - 1))
        return (part + F.lit(0.5)) / F.lit(float(1 << bits))
    out = []
    for i in range(k):
        h = F.xxhash64(term, F.lit(i))
        g = F.xxhash64(term, F.lit(i), F.lit(1))
        r = -F.ln(uniform(h, 0, 20) * uniform(h, 20, 20))
        log_c = F.ln(-F.ln(uniform(g, 0, 20) * uniform(g, 20, 20)))
        b = uniform(h, 40, 24)
        t = F.floor(log_weight / r + b)
        log_a = log_c - r * (t - b + 1)
        order = F.floor((log_a + 64) * float(1 << 24))
        name = term.bitwiseXOR(F.shiftleft(t, 12)).bitwiseAND(F.lit(0xFFFFFFFF))
        out.append(F.min(F.shiftleft(order, 32).bitwiseOR(name)).alias(f"s{i}"))
    return out


def sample(texts: DataFrame, k: int = SAMPLES, by: tuple = ("key",)) -> DataFrame:
    """``samples`` (array of ``k`` longs) per group ``by`` of rows with a ``text``;
    groups without words are absent."""
    words = F.filter(F.split(F.lower("text"), _SPACE), lambda w: w != "")
    terms = texts.select(*by, F.explode_outer(words).alias("word")).where("word is not null")
    weights = (terms.select(*by, F.xxhash64("word").alias("term"))
               .groupBy(*by, "term").agg(F.count("*").alias("w"))
               .select(*by, "term", F.ln(F.col("w").cast("double")).alias("log_w")))
    mins = weights.groupBy(*by).agg(*_samples(F.col("term"), F.col("log_w"), k))
    low = [F.col(f"s{i}").bitwiseAND(F.lit(0xFFFFFFFF)) for i in range(k)]
    return mins.select(*by, F.array(*low).alias("samples"))


def no_words(k: int = SAMPLES) -> Column:
    return F.array_repeat(F.lit(EMPTY).cast("long"), k)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples, 0 to 1."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda n, x: n + x)
    return same / F.size(a)


def as_string(samples: Column) -> Column:
    """The samples as lower-case hex, eight digits each."""
    one = lambda x: F.when(x < 0, F.lit("-" * 8)).otherwise(F.lpad(F.lower(F.hex(x)), 8, "0"))
    return F.array_join(F.transform(samples, one), "")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SAMPLES) -> DataFrame:
    """``key, doc_id, n_chars, samples, fingerprint`` per distinct document."""
    rows = keyed(docs, id_col, text_col)
    found = ids_by_key(rows).join(sample(texts_by_key(rows), k), "key", "left")
    samples = F.coalesce("samples", no_words(k))
    return found.select("key", "doc_id", "n_chars", samples.alias("samples")).withColumn(
        "fingerprint", as_string(F.col("samples")))


def next_by_id(keys: DataFrame) -> DataFrame:
    """``key, n_chars, next_key``: the document after each in descending id (then
    key), the first one after the last. ``keys`` has ``key, doc_id, n_chars``.

    The rows are range-partitioned and written with their partition number; a
    window per partition gives the follower, and the head of the next partition
    that of its last row. Only the heads, one row per partition, meet in one task.
    """
    ranged = (keys.repartitionByRange(F.desc("doc_id"), F.col("key"))
              .withColumn("part", F.spark_partition_id()))
    ranged = written(ranged, "ids-by-range")
    order = [F.desc("doc_id"), F.col("key")]
    inside = Window.partitionBy("part").orderBy(*order)
    rows = ranged.select("part", "key", "n_chars", F.lead("key").over(inside).alias("follower"),
                         F.row_number().over(inside).alias("at"))
    heads = rows.where("at = 1").select("part", F.col("key").alias("head"))
    parts = Window.orderBy("part")
    after = heads.select("part", F.coalesce(F.lead("head").over(parts), F.first("head").over(
        parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("next_head"))
    return rows.join(after, "part").select("key", "n_chars", F.coalesce("follower", "next_head").alias("next_key"))
