"""What a mean over a whole text cannot show: single words and repeated passages.

Words are runs of letters, digits and non-ASCII bytes, with A-Z in lower case, by
their hash. Two scores of a text:

``worst_word``: the largest log odds of any of its words, between the toxic and the
trusted training documents, by the documents that hold the word (half a
document is added to each count). Zero without a word that speaks for toxic.

``repeats``: the most words of any ``WINDOW`` consecutive ones that stand already
among the ``WINDOW - 1`` words before them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.llm import _shingles
from assayframe.llm._common import written

WINDOW = 16
MIN_DOCUMENTS = 2           # toxic documents that hold a word of the table, at least
MAX_COLLECTED = 100_000     # words of a table that tasks get whole; a larger one is joined
PIECE_BYTES = 1 << 20

_BETWEEN = np.zeros(256, dtype=bool)
_BETWEEN[:128] = True
for _first, _last in ("09", "AZ", "az"):
    _BETWEEN[ord(_first):ord(_last) + 1] = False


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and per text the index of its first word (one more entry)."""
    return _shingles.word_hashes(*_shingles.text_bytes(texts), _BETWEEN)


def _documents_of_words(wanted: np.ndarray | None = None):
    """Per word, or per word of ``wanted`` (sorted), the documents that hold it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _shingles.pieces(batches, PIECE_BYTES):
            found, first = words(batch.column("text"))
            of = np.repeat(np.arange(len(first) - 1), np.diff(first))
            if wanted is not None:
                mine = np.isin(found, wanted)
                found, of = found[mine], of[mine]
            edges = np.searchsorted(of, np.arange(len(first)))
            sets = [np.unique(found[a:b]) for a, b in zip(edges, edges[1:])]
            word, n = np.unique(np.concatenate([np.empty(0, np.uint64), *sets]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])
    return run


def toxic_words(texts: DataFrame, n_toxic: int, n_trusted: int) -> DataFrame:
    """``word, odds``: the words that speak for toxic, and their log odds. ``texts``
    has ``text, toxic`` (0 or 1), a row per training document. The trusted documents
    are counted for the toxic ones' words alone."""
    def held(value: int, name: str, wanted: np.ndarray | None = None) -> DataFrame:
        counts = texts.where(F.col("toxic") == value).select("text").mapInArrow(_documents_of_words(wanted), "word long, n long")
        return counts.groupBy("word").agg(F.sum("n").alias(name))
    toxic = written(held(1, "t").where(F.col("t") >= MIN_DOCUMENTS), "toxic-words")
    rows = toxic.select("word").limit(MAX_COLLECTED + 1).collect()
    wanted = None if len(rows) > MAX_COLLECTED else np.sort(np.array([r["word"] for r in rows], np.int64).astype(np.uint64))
    odds = (F.log((F.col("t") + 0.5) / F.lit(n_toxic + 1.0))
            - F.log((F.coalesce("c", F.lit(0)) + 0.5) / F.lit(n_trusted + 1.0)))
    return toxic.join(held(0, "c", wanted), "word", "left").select("word", F.round(odds, 6).alias("odds")).where("odds > 0")


def collected(table: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """Sorted hashes and log odds of a table of at most ``MAX_COLLECTED`` words; None of
    a larger one, for ``worst_words``."""
    rows = table.limit(MAX_COLLECTED + 1).collect()
    if len(rows) > MAX_COLLECTED:
        return None
    hashes = np.array([r["word"] for r in rows], np.int64).astype(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.array([r["odds"] for r in rows], np.float64)[order]


def _words_of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _shingles.pieces(batches, PIECE_BYTES):
        found, first = words(batch.column("text"))
        sets = [np.unique(found[a:b]) for a, b in zip(first, first[1:])]
        of = pa.array(np.repeat(np.arange(len(sets)), [len(x) for x in sets]))
        word = np.concatenate([np.empty(0, np.uint64), *sets]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(of), batch.column("fp").take(of), pa.array(word)],
                                         names=["doc_id", "fp", "word"])


def worst_words(docs: DataFrame, table: DataFrame) -> DataFrame:
    """``doc_id, fp, worst_word`` of the documents (``doc_id, fp, text``) that hold a
    word of the table, one row for equal ones: a join, for a table of any size."""
    held = docs.select("doc_id", "fp", "text").mapInArrow(_words_of_rows, "doc_id long, fp long, word long")
    return held.join(table, "word").groupBy("doc_id", "fp").agg(F.max("odds").alias("worst_word"))


def scores(texts: pa.Array, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``worst_word`` and ``repeats`` of each text."""
    found, first = words(texts)
    worst, most = np.zeros(len(first) - 1), np.zeros(len(first) - 1, np.int64)
    if not len(found):
        return worst, most
    have, values = table
    if len(have):
        at = np.minimum(np.searchsorted(have, found), len(have) - 1)
        worst = _largest(np.where(have[at] == found, values[at], 0.0), first)
    of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    again = np.zeros(len(found), dtype=bool)
    for back in range(1, min(WINDOW, len(found))):
        again[back:] |= (found[back:] == found[:-back]) & (of[back:] == of[:-back])
    run = np.concatenate(([0], np.cumsum(again)))
    end = np.arange(1, len(found) + 1)
    return worst, _largest(run[end] - run[np.maximum(end - WINDOW, first[:-1][of])], first)


def _largest(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The largest value of each text, zero for a text without any."""
    out = np.zeros(len(first) - 1, values.dtype)
    some = np.flatnonzero(np.diff(first))
    out[some] = np.maximum.reduceat(values, first[some])
    return out
