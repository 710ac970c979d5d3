"""Token-ID output: documents tokenized and written as Simple-8b shards.

``write_token_files`` range-partitions the documents by id, tokenizes each
partition in order and writes shards; ``read_token_files`` reads the documents'
ids back. A shard is one self-contained byte string, kept as one row of a Parquet
dataset, so that any file system Spark writes to can hold it and a task that is
lost and repeated leaves no half-written shard.

Layout of a shard, little-endian: the magic ``S8B1``, five unsigned 64-bit numbers
(documents, ids, blocks, words, escapes), the ids of each document as counts
(unsigned 64-bit), the index of each block's first word (unsigned 32-bit, padded to
eight bytes), the words, the escaped values. Document ids stand beside the shard
as a column, so that they can be pruned on.

Tokenizing looks up each stretch between spaces in a cache of bounded size: a
byte-level BPE never merges across the start of a space that a non-space follows,
so the parts of a text give the ids of the whole. A stretch that starts with other
white space (or is empty) is joined to the one before it.

Defined results: a null text is empty and gives the end id alone; documents are
ordered by (id, hash of the text), null ids first; repeated rows are all kept; an
empty table gives no shard. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assayframe.llm import simple8b
from assayframe.llm._common import as_text, written

MAGIC = b"S8B1"
SHARD_IDS = 1 << 20         # a shard ends with the document that reaches this many ids
CACHE_ENTRIES = 800_000     # per Python worker in both generations, below 200 MB
CHUNK_BYTES = 16 << 20      # texts encoded at a time
SHARD_SCHEMA = ("part int, shard int, first_in_part long, n_ids long, doc_ids array<long>, payload binary")
_SPACE_LIKE = re.compile("[\\s\x1c-\x1f\x85᠎​⁠﻿]")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    bytes stand for themselves, the others for the letters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    JOINS = b"joins"            # marks a stretch that belongs to the one before it

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark runs one task per core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        # Two generations: what is used again moves to the new one, so that common
        # stretches stay when the old one is dropped.
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.entries = cache_entries
        *marks, self.line_end = self._encode([",", ".", "\n"])
        self.marks = dict(zip(",.", marks))

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, word: str, space: bool) -> bytes:
        """Ids of a run of letters, after a space or not: one piece to the
        tokenizer, so its merges alone are applied."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(self.letters[32] + word if space else word)]).tobytes()

    def _plain(self, text: str, space: bool = True) -> bytes | None:
        """Ids of letters, or letters and a mark, which the tokenizer cuts apart."""
        if text.isalpha():
            return self._word(text, space)
        if text[-1:] in self.marks and text[:-1].isalpha():
            word = text[:-1]
            known = (self.cache.get(word) or self.old.get(word)) if space else None
            return (known or self._word(word, space)) + self.marks[text[-1]]
        return None

    def _learn(self, units: list[str]) -> None:
        """Put the stretches, none of which is in the new generation, into it."""
        if len(self.cache) + len(units) > self.entries // 2:
            self.old, self.cache = self.cache, {}
        cache, old, others = self.cache, self.old, []
        tokenize, space, letters, marks = self.model.tokenize, self.letters[32], self.letters, self.marks
        for u in units:
            ids = old.get(u)
            if ids is not None:
                cache[u] = ids
                continue
            # Runs of letters, and those with a mark after them, without a call for each.
            mark = marks.get(u[-1:])
            word = u if mark is None else u[:-1]
            if word.isalpha():
                known = None if mark is None else cache.get(word) or old.get(word)
                if known is None:
                    if not word.isascii():
                        word = word.encode().decode("latin-1").translate(letters)
                    known = array("I", [t.id for t in tokenize(space + word)]).tobytes()
                cache[u] = known if mark is None else known + mark
                continue
            if "\n" in u:      # a single line end between two words is a piece of its own
                left, right = u.split("\n", 1)
                left, right = self._plain(left), self._plain(right, space=False)
                ids = left + self.line_end + right if left and right else None
            if ids is not None:
                cache[u] = ids
            elif self._joins(u):
                cache[u] = self.JOINS
            else:
                others.append(u)
        cache.update(zip(others, self._encode([" " + u for u in others])))

    def _heads(self, units: list[str]) -> list[bytes]:
        """Ids of the first stretches of texts, which no space precedes."""
        ids = [self._plain(u, space=False) for u in units]
        others = [i for i, x in enumerate(ids) if x is None]
        for i, x in zip(others, self._encode([units[i] for i in others])):
            ids[i] = x
        return ids

    def _joined(self, units: list[str]) -> bytes:
        """A text with stretches that belong to the ones before them."""
        parts = [units[0]]
        for u in units[1:]:
            if self._joins(u):
                parts[-1] += " " + u
            else:
                parts.append(" " + u)
        return b"".join(self._encode(parts))

    def _joins(self, unit: str) -> bool:
        return not unit or bool(_SPACE_LIKE.match(unit)) or unit.startswith(self.special)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(lengths, ids)`` of an array of strings without nulls.

        Arrow cuts the texts and numbers the distinct stretches; only those are
        looked up, and the ids of all texts are gathered from theirs at once."""
        parts = pc.split_pattern(texts, " ")
        offsets = parts.offsets.to_numpy()
        heads = offsets[:-1] - offsets[0]
        coded = parts.flatten().dictionary_encode()
        at = coded.indices.to_numpy()
        units = coded.dictionary.to_pylist()
        ids = list(map(self.cache.get, units))
        if None in ids:
            self._learn([u for u, i in zip(units, ids) if i is None])
            ids = [self.cache[u] if i is None else i for u, i in zip(units, ids)]
        joins = np.zeros(len(ids), dtype=bool)
        for k in [k for k, i in enumerate(ids) if i is self.JOINS]:
            joins[k], ids[k] = True, b""

        # The first stretch of a text has no space before it; a text with stretches
        # to be joined is encoded apart and its ids take the place of the first.
        inner = joins[at]
        inner[heads] = False
        odd = np.logical_or.reduceat(inner, heads)
        firsts = self._heads([units[i] for i in at[heads]])
        for row in np.flatnonzero(odd):
            firsts[row] = self._joined(parts[int(row)].as_py())
        own = np.fromiter(map(len, ids), dtype=np.int32, count=len(ids)) // 4
        first_len = np.fromiter(map(len, firsts), dtype=np.int32, count=len(firsts)) // 4
        pool = np.frombuffer(b"".join(ids + firsts), dtype="<u4")
        begin, length = (np.cumsum(own, dtype=np.int32) - own)[at], own[at]
        length[np.repeat(odd, np.diff(offsets))] = 0
        begin[heads] = own.sum() + np.cumsum(first_len) - first_len
        length[heads] = first_len
        ends = np.cumsum(length, dtype=np.int32)
        where = np.arange(ends[-1], dtype=np.int32) + np.repeat(begin - ends + length, length)
        return np.add.reduceat(length, heads).astype(np.int64), pool[where]


_encoders: dict[str, Encoder] = {}


def _encoder(path: str, cache_entries: int = CACHE_ENTRIES) -> Encoder:
    """The worker's encoder: it stays, with its cache, for the next task."""
    found = _encoders.get(path)
    if found is None or found.entries != cache_entries:
        _encoders.clear()
        _encoders[path] = found = Encoder(path, cache_entries)
    return found


def shard_bytes(lengths: np.ndarray, ids: np.ndarray) -> bytes:
    words, offsets, escaped = simple8b.pack(ids)
    head = np.array([len(lengths), len(ids), len(offsets), len(words), len(escaped)], dtype="<u8")
    padded = np.zeros(len(offsets) + len(offsets) % 2, dtype="<u4")
    padded[:len(offsets)] = offsets
    return b"".join((MAGIC, head.tobytes(), lengths.astype("<u8").tobytes(), padded.tobytes(),
                     words.astype("<u8").tobytes(), escaped.astype("<u8").tobytes()))


def shard_values(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """``(lengths, ids)``: ids per document, and all ids."""
    if payload[:4] != MAGIC:
        raise ValueError("not a token shard")
    n_docs, n_ids, n_blocks, n_words, n_escaped = (int(x) for x in np.frombuffer(payload, "<u8", 5, 4))
    at = 44
    lengths = np.frombuffer(payload, "<u8", n_docs, at)
    at += 8 * n_docs
    offsets = np.frombuffer(payload, "<u4", n_blocks, at)
    at += 4 * (n_blocks + n_blocks % 2)
    words = np.frombuffer(payload, "<u8", n_words, at)
    escaped = np.frombuffer(payload, "<u8", n_escaped, at + 8 * n_words)
    return lengths, simple8b.unpack(words, offsets, n_ids, escaped)


def _pieces(batches: Iterator[pa.RecordBatch], size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``size`` bytes of text, one row at least."""
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64)
        groups = (np.cumsum(sizes) - sizes) // size
        edges = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(sizes)]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def _writer(path: str, end_id: int, shard_ids: int, cache_entries: int, chunk_bytes: int = CHUNK_BYTES) -> Callable:
    schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("first_in_part", pa.int64()),
                        ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, cache_entries)
        part, shard, done = 0, 0, 0
        docs, lengths, ids, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            payload = shard_bytes(np.concatenate(lengths), np.concatenate(ids))
            doc_ids = pa.concat_arrays(docs).to_pylist()
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(
                (part, shard, done, size, doc_ids, payload), schema.types)], schema=schema)

        for batch in _pieces(batches, chunk_bytes):
            part = batch.column("part")[0].as_py()
            n, values = encoder.encode(batch.column("text"))
            ends = np.cumsum(n)
            values, n, ends = np.insert(values, ends, end_id), n + 1, ends + np.arange(1, len(n) + 1)
            a = 0
            while a < len(n):       # cut after the document that fills the shard
                before = ends[a] - n[a]
                b = min(len(n), int(np.searchsorted(ends, before + shard_ids - size)) + 1)
                docs.append(batch.column("doc_id").slice(a, b - a))
                lengths.append(n[a:b])
                ids.append(values[before:ends[b - 1]])
                size += int(ends[b - 1] - before)
                a = b
                if size >= shard_ids:
                    yield flush()
                    shard, done, docs, lengths, ids, size = shard + 1, done + size, [], [], [], 0
        if docs:
            yield flush()
    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2,
                      shard_ids: int = SHARD_IDS, id_col: str = "doc_id", text_col: str = "text",
                      cache_entries: int = CACHE_ENTRIES, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Tokenize the documents in ascending id and write the shards to ``path``. A worker
    keeps up to ``cache_entries`` stretches, also after its task (about 250 bytes each);
    it encodes ``chunk_bytes`` of texts at a time, in some 20 times that memory."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), as_text(F.col(text_col)).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    ranged = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    ranged = ranged.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    shards = ranged.mapInArrow(_writer(tokenizer or default_tokenizer(), end_id, shard_ids, cache_entries, chunk_bytes), SHARD_SCHEMA)
    shards.write.parquet(path)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            lengths, ids = shard_values(batch.column("payload")[row].as_py())
            lengths = lengths.astype(np.int64)
            ends = np.cumsum(lengths)
            flat = ids.astype("<u4")
            buffer = pa.py_buffer(flat.tobytes())
            offsets = pa.py_buffer(np.concatenate(([0], 4 * ends)).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(lengths), batch.column("part")[row].as_py(), dtype=np.int32)),
                batch.column("doc_ids")[row].values,
                pa.array(batch.column("first_in_part")[row].as_py() + ends - lengths),
                pa.array(lengths),
                pa.Array.from_buffers(pa.binary(), len(lengths), [None, offsets, buffer]),
            ], names=["part", "doc_id", "start", "n_tokens", "ids"])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids``: per document the number of ids before it
    in the whole output, its number of ids, and the ids as little-endian unsigned
    32-bit bytes. Only one total per written partition meets in one task."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    bases = written(bases, "token-bases")       # its size on disk lets the planner choose the join
    docs = shards.select("part", "first_in_part", "doc_ids", "payload").mapInArrow(
        _reader, "part int, doc_id long, start long, n_tokens long, ids binary")
    return docs.join(bases, "part").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids")
