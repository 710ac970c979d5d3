"""Token counts of whole texts; huge documents are counted in overlapping chunks.

A text of up to ``CHUNK`` code points is encoded whole. A longer one is cut into chunks
that overlap by ``OVERLAP`` on both sides of each cut, and the chunks are dealt out
over the tasks. A chunk may begin and end inside a token, so its tokens near its edges
mean nothing by themselves. Two neighbours are spliced at a boundary in their overlap
that both encodings have and that is proven to be one of the whole text:

* The pre-tokenizer reads from left to right and never looks back, so where it starts
  a piece, what follows depends on the text from there on alone. The first chunk starts
  where the document does; its piece starts are right, but for those within
  ``EDGE`` (and the longest special token) of its end, where the cut hides what comes.
  A piece start that the next chunk has too makes that chunk right from there on, and
  so on to the end of the document.
* Pieces are encoded each by itself, so the tokens before and after such a place are
  those of the whole text.
* For sentencepiece models, no piece of the vocabulary may hold a space mark behind
  another letter; then no merge ever crosses a place where a space follows a letter.

A document whose neighbours have no such common boundary (a run without a break) is cut
again with chunks and overlaps ``WIDEN`` times as long, at the latest until one chunk
holds all of it. A vocabulary for which the proof does not hold (its pre-tokenizer looks
back, or special tokens that overlap one another or strip the text about them) has its
texts encoded whole.

The number of tokens is a sum over the joints: those of the left chunk before the common
boundary, less those of the right chunk before it, plus all of the last chunk. Only sums
and one pair of short lists per joint meet in a group, however long the document is.

Defined results: a null text is empty and has no tokens; repeated rows and null ids each
keep their row; an empty table gives no rows; columns other than the id and the text are
ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.llm import _shingles, token_files
from assayframe.llm._common import as_text, written

CHUNK, OVERLAP = 1 << 15, 1 << 9        # code points
EDGE = 16                               # more than any pre-tokenizer here looks ahead
WIDEN = 4
LEFT_TO_RIGHT = ("ByteLevel", "Split", "Whitespace", "WhitespaceSplit")
SPACE_MARK = "▁"
JOINT_SCHEMA = "doc_id long, digest binary, joint int, side int, at array<int>, before array<int>"


def _overlap_each_other(words: list[str]) -> bool:
    """Whether an end of one word is a beginning of another, or one holds another."""
    return any(a[i:i + n] == b[:n] for a in words for b in words for i in range(len(a))
               for n in [min(len(a) - i, len(b))] if a is not b or i)


class JsonVocabulary:
    """A vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark runs one task per core
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.post_processor = None                # it would trim the offsets
        steps = spec.get("pre_tokenizer") or {}
        steps = steps.get("pretokenizers", [steps])
        added = spec.get("added_tokens") or []
        special = [t["content"] for t in added]
        self.normalized = bool(spec.get("normalizer"))
        self.provable = (
            all(s.get("type") in LEFT_TO_RIGHT and "(?<" not in json.dumps(s.get("pattern")) for s in steps)
            and not any(s.get("add_prefix_space") for s in steps)
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
            and not _overlap_each_other(special))
        self.edge = EDGE + max(map(len, special), default=0)
        byte_level = steps == [s for s in steps if s.get("type") == "ByteLevel" and s.get("use_regex", True)]
        self.cached = token_files.Encoder(path) if byte_level and len(steps) == 1 and self.provable and not self.normalized else None

    def counts(self, texts: pa.Array) -> np.ndarray:
        if self.cached:
            return self.cached.encode(texts)[0]
        found = self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
        return np.array([len(e) for e in found], dtype=np.int64)

    def boundaries(self, text: str) -> tuple[np.ndarray, np.ndarray, int]:
        """Where pieces of the pre-tokenizer start, how many tokens stand before each,
        and how many there are."""
        e = self.tokenizer.encode(text, add_special_tokens=False)
        if not e.ids:
            return np.empty(0, np.int64), np.empty(0, np.int64), 0
        begin = np.array(e.offsets, dtype=np.int64)[:, 0]
        piece = np.array([-1 - i if w is None else w for i, w in enumerate(e.word_ids)], dtype=np.int64)
        before = np.flatnonzero(np.concatenate(([True], piece[1:] != piece[:-1])))
        if self.normalized:     # letters that a normaliser may join to the one before are no place to cut
            before = before[[text[p] < "\x80" for p in begin[before]]]
        return begin[before], before, len(e.ids)


class PieceVocabulary:
    """A model file of the sentencepiece library."""

    normalized, edge = True, EDGE

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        # A part after a cut loses its space, which the model's own leading mark replaces.
        marks = self.model.encode("a", out_type=str)[0].startswith(SPACE_MARK)
        self.provable = marks and not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces)

    def counts(self, texts: pa.Array) -> np.ndarray:
        return np.array([len(ids) for ids in self.model.encode(texts.to_pylist(), num_threads=1)], dtype=np.int64)

    def boundaries(self, text: str) -> tuple[np.ndarray, np.ndarray, int]:
        """The same for places where one space follows another ASCII letter."""
        spaces = [m.start() + 1 for m in re.finditer("[!-~] (?=[!-~])", text)]
        parts = [text[a + (a > 0):b] for a, b in zip([0, *spaces], [*spaces, len(text)])]
        counts = self.model.encode(parts, num_threads=1)
        before = np.cumsum([0, *map(len, counts)])
        return np.array(spaces, dtype=np.int64), before[1:-1], int(before[-1])


_vocabularies: dict[str, JsonVocabulary | PieceVocabulary] = {}


def vocabulary(path: str) -> JsonVocabulary | PieceVocabulary:
    """The worker's vocabulary: it stays, with its cache, for the next task."""
    if path not in _vocabularies:
        _vocabularies.clear()
        _vocabularies[path] = (PieceVocabulary if path.endswith(".model") else JsonVocabulary)(path)
    return _vocabularies[path]


def _counter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in _shingles.pieces(batches):
            n = vocab.counts(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n)],
                                             names=["doc_id", "n_bytes", "n_tokens"])
    return run


def _cutter(chunk: int, overlap: int):
    """Chunks of each text: the chunk's number, the code point it starts at, whether
    it is the last, and its text with the overlaps."""
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("i", pa.int32()), ("start", pa.int32()),
                        ("last", pa.bool_()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                text = batch.column("text")[row].as_py()
                doc, digest = batch.column("doc_id")[row].as_py(), batch.column("digest")[row].as_py()
                n = max(1, -(-len(text) // chunk))
                for i in range(n):
                    start = max(0, i * chunk - overlap)
                    part = text[start:(i + 1) * chunk + overlap]
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (doc, digest, i, start, i == n - 1, part)))],
                                                     schema=schema)
    return run


def _joints(path: str, chunk: int, overlap: int):
    """The boundaries of a chunk in its overlaps (side 0: with the next chunk, 1: with
    the one before); joint -1 has the tokens of the last chunk."""
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("joint", pa.int32()), ("side", pa.int32()),
                        ("at", pa.list_(pa.int32())), ("before", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for row in batch.to_pylist():
                at, before, total = vocab.boundaries(row["text"])
                at, i, out = at + row["start"], row["i"], []
                for joint, side in ((i - 1, 1), (i, 0)):
                    if joint < 0 or (side == 0 and row["last"]):
                        continue
                    cut = (joint + 1) * chunk
                    inside = (at >= cut - overlap + vocab.edge) & (at < cut + overlap - vocab.edge)
                    out.append((joint, side, at[inside].tolist(), before[inside].tolist()))
                if row["last"]:
                    out.append((-1, 0, [0], [total]))
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(schema.names, (row["doc_id"], row["digest"], *x))) for x in out], schema=schema)
    return run


def _spliced(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """``doc_id, digest, n_tokens``; null where two chunks have no common boundary."""
    chunks = texts.mapInArrow(_cutter(chunk, overlap),
                              "doc_id long, digest binary, i int, start int, last boolean, text string")
    dealt = chunks.repartition(F.xxhash64("digest", "i"))      # one document's chunks go to many tasks
    joints = dealt.mapInArrow(_joints(path, chunk, overlap), JOINT_SCHEMA)
    zone = lambda side: F.first(F.when(F.col("side") == side, F.struct("at", "before")), ignorenulls=True)
    # Equal rows of one document fall together here: each joint counts once.
    both = joints.groupBy("doc_id", "digest", "joint").agg(zone(0).alias("l"), zone(1).alias("r"))
    common = F.array_min(F.array_intersect("l.at", "r.at"))
    before = lambda z: F.get(f"{z}.before", F.array_position(f"{z}.at", F.col("p")).cast("int") - 1)
    part = F.when(F.col("joint") == -1, F.get("l.before", F.lit(0))).otherwise(before("l") - before("r"))
    parts = both.withColumn("p", common).select("doc_id", "digest", part.cast("long").alias("part"))
    return parts.groupBy("doc_id", "digest").agg(
        F.when(F.count("part") == F.count("*"), F.sum("part")).alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer: str | None = None, limit: int = 512, chunk: int = CHUNK, overlap: int = OVERLAP,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row of ``docs``, by the vocabulary
    file ``tokenizer`` (``.json``: tokenizers, ``.model``: sentencepiece)."""
    if not 0 < 2 * overlap <= chunk:
        raise ValueError("chunks must hold both their overlaps")
    path = tokenizer or token_files.default_tokenizer()
    text = as_text(F.col(text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    huge = F.length("text") > chunk
    if not vocabulary(path).provable:
        huge = F.lit(False)
    short = rows.where(~huge).mapInArrow(_counter(path), "doc_id long, n_bytes long, n_tokens long")
    keyed = rows.where(huge).withColumn("digest", F.unhex(F.sha2("text", 256)))
    todo, found, size, margin = keyed.select("doc_id", "digest", "text"), None, chunk, overlap
    while True:
        tried = written(_spliced(todo, path, size, margin), "token-splices")
        done = tried.where("n_tokens is not null")
        found = done if found is None else found.unionByName(done)
        failed = tried.where("n_tokens is null").select(F.col("doc_id").alias("f_id"), F.col("digest").alias("f_digest"))
        if failed.isEmpty():
            break
        size, margin = size * WIDEN, margin * WIDEN
        todo = keyed.join(failed, keyed["doc_id"].eqNullSafe(F.col("f_id")) & (keyed["digest"] == F.col("f_digest")),
                          "left_semi").select("doc_id", "digest", "text")
    found = found.select(F.col("doc_id").alias("f_id"), F.col("digest").alias("f_digest"), "n_tokens")
    long = keyed.select("doc_id", "n_bytes", "digest").join(
        found, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("digest") == F.col("f_digest")))
    out = short.unionByName(long.select("doc_id", "n_bytes", "n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
