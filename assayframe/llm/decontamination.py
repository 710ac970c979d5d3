"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Every window of ``n`` words of the test items is hashed. Each document's windows
are hashed the same way and probed against that set; the few that hit are then
compared word by word, so a hash collision never marks a document. All of it is
built-in functions, joins and aggregates.

Defined results: a null text has no words; an item without words has no window;
an item with fewer than ``n`` words is one window; repeated items with the same
id count once; a repeated document row gets its own (equal) result row. Columns
other than the id and the text are ignored, whatever their names. A null item id
is not an item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.llm._common import WORD_SEPARATORS, ascii_lower

WINDOW = 13
MIN_SHARE = 20              # contaminated: at least one word in MIN_SHARE is hit
MAX_BROADCAST_BYTES = 64 << 20
# A word with the separators that follow it, on text in its original case.
_PIECE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
_LEAD = r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"


def normal_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), WORD_SEPARATORS), "")


def _window_hashes(words: Column, length: int) -> Column:
    """The hash of each run of ``length`` words, in order of its first word."""
    starts = F.sequence(F.lit(1), F.size(words) - (length - 1))
    return F.when(F.size(words) >= length,
                  F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, length))))


def test_windows(items: DataFrame, n: int = WINDOW, id_col: str = "item_id",
                 text_col: str = "text") -> DataFrame:
    """One row per distinct window: hash ``h``, its words ``gram``, its length
    ``len`` and the ids of the items it occurs in, as strings."""
    words = (items.where(F.col(id_col).isNotNull())
             .select(F.col(id_col).cast("string").alias("item_id"), normal_words(F.col(text_col)).alias("words"))
             .where(F.size("words") > 0))
    size = F.size("words")
    starts = F.sequence(F.lit(1), F.greatest(size - (n - 1), F.lit(1)))
    grams = words.select("item_id", F.explode(F.transform(
        starts, lambda i: F.slice("words", i, F.least(size, F.lit(n))))).alias("gram"))
    return (grams.groupBy("gram").agg(F.collect_set("item_id").alias("items"))
            .select(F.xxhash64("gram").alias("h"), "gram", F.size("gram").alias("len"), "items"))


def _probe(words: DataFrame, windows: DataFrame, lengths: list[int], small: bool) -> DataFrame:
    """Window hits by hash: ``doc_id, fp, pos, gram, items`` (pos counts from 1)."""
    parts = []
    for length in lengths:
        hashed = words.select("doc_id", "fp", F.posexplode(_window_hashes(F.col("words"), length)).alias("pos", "h"))
        side = windows.where(F.col("len") == length).select("h", "gram", "items")
        parts.append(hashed.join(F.broadcast(side) if small else side, "h")
                     .select("doc_id", "fp", (F.col("pos") + 1).alias("pos"), "gram", "items"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def contamination(docs: DataFrame, items: DataFrame, n: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
                  min_share: int = MIN_SHARE, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Per document row: ``doc_id, fp`` (hash of the text), ``n_words``,
    ``hit_words`` (positions from 1), ``n_hit``, ``item_ids`` (sorted strings),
    ``contaminated``.

    The window table is broadcast only when its measured size (one aggregate over
    the test items) is within ``max_broadcast_bytes``; a larger one is joined by
    shuffle. Hits are compared with the whole document's words afterwards.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    docs = docs.withColumn("fp", F.xxhash64(F.coalesce("text", F.lit(""))))
    words = docs.select("doc_id", "fp", normal_words(F.col("text")).alias("words"))
    counts = words.select("doc_id", "fp", F.size("words").alias("n_words"))

    windows = test_windows(items, n, item_id_col, item_text_col)
    per_length = windows.groupBy("len").agg(
        F.sum(F.length(F.concat_ws(" ", "gram")) + F.length(F.concat_ws(",", "items")) + 64).alias("b")).collect()
    lengths = sorted(r["len"] for r in per_length)      # at most n values
    small = sum(r["b"] for r in per_length) <= max_broadcast_bytes
    none = F.array().cast("array<int>")
    if not lengths:
        return counts.select("doc_id", "fp", F.col("n_words").cast("long"), none.alias("hit_words"),
                             F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("item_ids"),
                             F.lit(False).alias("contaminated"))

    hits = (_probe(words, windows, lengths, small)
            .groupBy("doc_id", "fp").agg(F.collect_set(F.struct("pos", "gram", "items")).alias("hits")))
    same = F.filter("hits", lambda x: F.slice(F.col("words"), x["pos"], F.size(x["gram"])) == x["gram"])
    key = [F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")), F.col("d.fp") == F.col("h.fp")]
    found = words.alias("d").join(hits.alias("h"), key).select("d.doc_id", "d.fp", same.alias("hits"))
    covered = F.array_distinct(F.flatten(F.transform(
        "hits", lambda x: F.sequence(x["pos"], x["pos"] + F.size(x["gram"]) - 1))))
    found = (found.select("doc_id", "fp", F.array_sort(covered).alias("hit_words"),
                          F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda x: x["items"]))))
                          .alias("item_ids"))
             .dropDuplicates(["doc_id", "fp"]))
    key = [F.col("c.doc_id").eqNullSafe(F.col("f.doc_id")), F.col("c.fp") == F.col("f.fp")]
    out = (counts.alias("c").join(found.alias("f"), key, "left")
           .select("c.doc_id", "c.fp", F.col("n_words").cast("long").alias("n_words"),
                   F.coalesce("hit_words", none).alias("hit_words"),
                   F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")))
    n_hit = F.size("hit_words").cast("long")
    return out.select("doc_id", "fp", "n_words", "hit_words", n_hit.alias("n_hit"), "item_ids",
                      ((n_hit > 0) & (n_hit * min_share >= F.col("n_words"))).alias("contaminated"))


def _flagged(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, **options) -> DataFrame:
    flags = contamination(docs, items, id_col=id_col, text_col=text_col, **options)
    return (flags.where("n_hit > 0").select(F.col("doc_id").alias("__hit_id"), F.col("fp").alias("__hit_fp"),
                                            F.col("hit_words").alias("__hit_words"), "contaminated")
            .dropDuplicates(["__hit_id", "__hit_fp"]))


def _same_row(docs: DataFrame, hits: DataFrame, id_col: str, text_col: str) -> Column:
    fp = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    return docs[id_col].eqNullSafe(hits["__hit_id"]) & (fp == hits["__hit_fp"])


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **options) -> DataFrame:
    """The documents that are not contaminated, with their columns unchanged."""
    bad = _flagged(docs, items, id_col, text_col, **options).where("contaminated").select("__hit_id", "__hit_fp")
    return docs.join(bad, _same_row(docs, bad, id_col, text_col), "left_anti")


def drop_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               **options) -> DataFrame:
    """Every document, with the hit words (and the separators after each) cut
    out of its text."""
    hits = _flagged(docs, items, id_col, text_col, **options).drop("contaminated")
    joined = docs.join(hits, _same_row(docs, hits, id_col, text_col), "left")
    is_hit = F.col("__hit_words").isNotNull()
    joined = joined.withColumn("__pieces", F.when(is_hit, F.regexp_extract_all(text_col, F.lit(_PIECE), 0)))
    kept = F.array_except(F.sequence(F.lit(1), F.size("__pieces")), F.col("__hit_words"))
    rest = F.transform(kept, lambda i: F.element_at(F.col("__pieces"), i))
    cut = F.concat(F.regexp_extract(text_col, _LEAD, 0), F.array_join(rest, ""))
    return joined.withColumn(text_col, F.when(is_hit, cut).otherwise(F.col(text_col))).select(*docs.columns)
