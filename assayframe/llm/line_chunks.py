"""Line dedup by content-defined chunks of lines.

Each line is hashed; a rolling hash over the last ``window`` line hashes decides
after which lines a chunk may end. A mark less than ``min_lines`` lines behind another
mark, the text's start or before its end ends no chunk, so every chunk of a text of
``min_lines`` lines or more has at least that many, and boundaries still depend on nearby
lines alone and come back after an insertion or a deletion. A chunk of at least
``min_lines`` lines whose exact text also stands earlier (smaller document id, or
earlier in the same document) is removed, after its bytes were compared with those of
the earliest chunk of that hash: an exact copy of ``min_lines`` lines or more loses all.

Defined results: a null text is empty and has no line; a text splits at every
newline; a text of fewer than ``min_lines`` lines is one chunk that stays; a document left without chunks has an empty text; rows with the same
document id are told apart by the hash of their text, and equal rows are one
document (each gets the same result row); a null id sorts before all others. Two
different chunks with one hash are both kept. Columns other than the id and the
text are ignored.

Built-in functions, joins and aggregates only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.llm._common import written

WINDOW = 2
MEAN_LINES = 4          # a line is marked with probability 1 / MEAN_LINES: 4 or 16
MIN_LINES = 2


def _chunks(docs: DataFrame, window: int, mean_lines: int, min_lines: int) -> DataFrame:
    """``doc_id, fp, chunks``: chunks as array of (text, n_lines), none for an empty text.
    Each step is its own column, so that no array is built twice."""
    one = docs.withColumn("lines", F.when(F.col("text") == "", F.array().cast("array<string>"))
                          .otherwise(F.split("text", "\n")))
    one = one.withColumn("hashes", F.transform("lines", lambda x: F.md5(x)))
    roll = lambda i: F.md5(F.array_join(F.slice(
        F.col("hashes"), F.greatest(i - (window - 2), F.lit(1)), F.least(i + 1, F.lit(window))), ""))
    digits = ["0", "1", "2", "3"] if mean_lines == 4 else ["0"]
    one = one.withColumn("marks", F.transform("hashes", lambda _, i: F.substr(roll(i), F.lit(1), F.lit(1)).isin(*digits)))
    last = F.size("lines") - 1

    def ends_chunk(mark, i):
        for back in range(1, min_lines):
            mark &= ~F.coalesce(F.get(F.col("marks"), i - back), F.lit(False))
        return (i == last) | (mark & (i + 1 >= min_lines) & (last - i >= min_lines))

    ends = F.filter(F.transform("marks", lambda m, i: F.when(ends_chunk(m, i), i + 1)), lambda i: i.isNotNull())
    one = one.withColumn("ends", ends)
    begin = lambda k: F.when(k > 0, F.element_at(F.col("ends"), F.greatest(k, F.lit(1)))).otherwise(0)
    chunk = lambda e, k: F.struct(
        F.array_join(F.slice(F.col("lines"), begin(k) + 1, e - begin(k)), "\n").alias("text"),
        (e - begin(k)).alias("n_lines"))
    return one.select("doc_id", "fp", F.transform("ends", chunk).alias("chunks"))


def repeated_chunks(docs: DataFrame, window: int = WINDOW, mean_lines: int = MEAN_LINES,
                    min_lines: int = MIN_LINES) -> DataFrame:
    """``doc_id, fp, idx``: the chunks to remove. ``docs`` has ``doc_id, fp, text``."""
    # The outer form adds no filter on the array, which would rebuild it below every step.
    chunks = _chunks(docs, window, mean_lines, min_lines)
    exploded = (chunks.select("doc_id", "fp", F.posexplode_outer("chunks").alias("idx", "c"))
                .where(F.col("c.n_lines") >= min_lines)
                .select("doc_id", "fp", "idx", F.xxhash64("c.text").alias("h"), F.col("c.text").alias("chunk")))
    at = F.struct("doc_id", "fp", "idx")
    repeated = (exploded.groupBy("h").agg(F.count("*").alias("n"), F.min(at).alias("first"))
                .where("n > 1").select("h", "first"))
    # Chunks of repeated hashes are written once: the earliest of each hash, with its
    # text, then stands beside every other one.
    seen = written(exploded.join(repeated, "h").select("h", at.alias("at"), "first", "chunk"), "repeated-chunks")
    firsts = seen.where(F.col("at") == F.col("first")).groupBy("h").agg(F.first("chunk").alias("first_chunk"))
    return (seen.where(F.col("at") != F.col("first")).join(firsts, "h")
            .where(F.col("chunk") == F.col("first_chunk")).select("at.doc_id", "at.fp", "at.idx"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                mean_lines: int = MEAN_LINES, min_lines: int = MIN_LINES) -> DataFrame:
    """``doc_id, n_lines, n_chunks, n_removed_chunks, n_removed_lines, text`` per
    distinct document row; ``text`` is what is left."""
    if mean_lines not in (4, 16):
        raise ValueError("mean_lines is 4 or 16")
    if min_lines < 1:
        raise ValueError("a chunk has at least one line")
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = docs.withColumn("fp", F.xxhash64("text"))
    removed = (repeated_chunks(docs, window, mean_lines, min_lines)
               .groupBy("doc_id", "fp").agg(F.collect_set("idx").alias("removed")))
    key = F.col("c.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("c.fp") == F.col("r.fp"))
    joined = (docs.alias("c").join(removed.alias("r"), key, "left")
              .select("c.doc_id", "c.fp", "c.text", F.coalesce("removed", F.array().cast("array<int>")).alias("removed")))
    chunks = _chunks(joined.select("doc_id", F.struct("fp", "removed").alias("fp"), "text"), window, mean_lines, min_lines)
    keep = F.filter(F.transform("chunks", lambda c, i: F.struct(
        c["text"].alias("text"), c["n_lines"].alias("n_lines"), F.array_contains("fp.removed", i).alias("gone"))),
        lambda c: ~c["gone"])
    total = lambda col: F.aggregate(col, F.lit(0), lambda a, c: a + c["n_lines"])
    return chunks.withColumn("kept", keep).select(
        "doc_id", total("chunks").cast("long").alias("n_lines"), F.size("chunks").cast("long").alias("n_chunks"),
        (F.size("chunks") - F.size("kept")).cast("long").alias("n_removed_chunks"),
        (total("chunks") - total("kept")).cast("long").alias("n_removed_lines"),
        F.array_join(F.transform("kept", lambda c: c["text"]), "\n").alias("text"))
