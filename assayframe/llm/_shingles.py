"""Words, shingles and set digests of many texts at once, in numpy.

Words are split at ASCII white space after A-Z were lower-cased. A word's hash is a
polynomial over its bytes modulo 2**64, taken from running sums, so that no word
becomes a Python object; a shingle's hash mixes the hashes of its words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 4 << 20
HASH_BYTES = 256 << 10      # of texts whose words are hashed at a time
_ODD = np.uint64(0x9E3779B97F4A7C15)        # splitmix64 constants (public domain generator)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    values = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _ODD)
    values[65:91] = values[97:123]          # A-Z as a-z
    return values


_VALUES = _byte_values()
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def pieces(batches: Iterator[pa.RecordBatch], size: int = CHUNK_BYTES, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``size`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        groups = (np.cumsum(sizes) - sizes) // size
        edges = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(sizes)]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an array of strings without nulls, and where each text begins
    (one more entry for the end)."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return flat, offsets.astype(np.int64) - offsets[0]


def _word_edges(flat: np.ndarray, begins: np.ndarray, space: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word, and the byte after its last; a text ends every word.
    ``space`` tells of each byte value whether it stands between words."""
    if not len(flat):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    word = ~space[flat]
    edge = np.zeros(len(flat) + 1, dtype=bool)
    edge[begins] = True
    start = np.flatnonzero(word & (np.concatenate(([True], ~word[:-1])) | edge[:-1]))
    end = np.flatnonzero(word & (np.concatenate((~word[1:], [True])) | edge[1:])) + 1
    return start, end


def hashes_between(flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each word; words in order, some at a time, so that the
    running sums fit a cache."""
    out, a = np.empty(len(start), dtype=np.uint64), 0
    while a < len(start):
        low = start[a]
        b = max(a + 1, int(np.searchsorted(start, low + HASH_BYTES)))
        own = flat[low:end[b - 1]]
        power, inverse = _power_tables(len(own))
        sums = np.zeros(len(own) + 1, dtype=np.uint64)
        np.cumsum(_VALUES[own] * power, out=sums[1:])
        begin, stop = start[a:b] - low, end[a:b] - low
        out[a:b] = mix((sums[stop] - sums[begin]) * inverse[begin] + (stop - begin).astype(np.uint64))
        a = b
    return out


def word_hashes(flat: np.ndarray, begins: np.ndarray, space: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and per text the index of its first word (one more entry)."""
    n = len(flat)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(begins), dtype=np.int64)
    start, end = _word_edges(flat, begins, space)
    return hashes_between(flat, start, end), np.searchsorted(start, begins)


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``k`` words inside a text (with fewer words, the whole
    sequence), and per text the index of its first shingle (one more entry)."""
    count = np.diff(first)
    short = (count > 0) & (count < k)
    per_text = np.where(count >= k, count - k + 1, short)
    bounds = np.concatenate(([0], np.cumsum(per_text)))
    of = np.repeat(np.arange(len(count)), per_text)
    at = first[:-1][of] + np.arange(bounds[-1]) - bounds[:-1][of]
    out = np.full(len(at), np.uint64(k), dtype=np.uint64)
    length = np.minimum(count[of], k)
    for i in range(k):
        inside = i < length
        word = words[np.minimum(at + i, len(words) - 1)] if len(words) else words
        out = np.where(inside, mix(out * _ODD + word), out)
    return mix(out + length.astype(np.uint64)), bounds


def sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    flat, begins = text_bytes(texts)
    words, first = word_hashes(flat, begins)
    hashes, bounds = shingle_hashes(words, first, k)
    for a, b in zip(bounds, bounds[1:]):
        yield np.unique(hashes[a:b])


def digest(items: np.ndarray) -> bytes:
    """Sixteen bytes that name a set."""
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest()
