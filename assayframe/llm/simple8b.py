"""Simple-8b: unsigned integers packed into 64-bit words, in numpy.

The top four bits of a word select how many values of how many bits fill the other
sixty. Values are packed in blocks of ``BLOCK``; a block starts a new word, and its
first word's index is kept, so blocks decode apart from each other and all blocks
of an array are packed and decoded together, one vector step per word of a block.
A value of more than sixty bits is an escape: its word holds an index into a list
of raw values.
"""

from __future__ import annotations

import numpy as np

BLOCK = 256
ESCAPE = 15
# Fixed values of the format: values and bits of selectors 1 to 14.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
_PAD = 64
_PER_SELECTOR = np.array((0, *COUNTS, 1), dtype=np.int64)


_SHORT = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits of each value; 61 or more for those that need an escape."""
    if values.max(initial=0) < len(_SHORT):
        return _SHORT[values]
    bits = np.frexp(values.astype(np.float64))[1].astype(np.uint8)
    return np.where(values >> np.uint64(60) > 0, np.uint8(64), np.minimum(bits, np.uint8(60)))


def _selectors(bits: np.ndarray) -> np.ndarray:
    """For every position of every (padded) block, the selector that packs most
    values from there on. A position that has no room for a selector's values has
    none for the next one's, which are more and narrower: the search ends there."""
    width = bits.shape[1] - _PAD
    best = np.full((bits.shape[0], width), ESCAPE, dtype=np.uint8)
    most, p = bits, 1                               # most: the largest of p values from each position
    for s in range(14, 0, -1):
        n, b = COUNTS[s - 1], BITS[s - 1]
        while 2 * p <= n:
            most, p = np.maximum(most[:, :-p], most[:, p:]), 2 * p
        fits = np.maximum(most[:, :width], most[:, n - p:n - p + width]) <= b
        if not fits.any():
            break
        best[fits] = s
    return best


def pack(values) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(words, block_offsets, escaped)`` of an array of unsigned integers."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    blocks = -(-n // BLOCK)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.uint64)
    wide = BLOCK + _PAD
    grid = np.zeros((blocks, wide), dtype=np.uint64)
    full = np.zeros(blocks * BLOCK, dtype=np.uint64)
    full[:n] = values
    grid[:, :BLOCK] = full.reshape(blocks, BLOCK)
    best = _selectors(_bit_lengths(grid))

    lengths = np.full(blocks, BLOCK, dtype=np.int64)
    lengths[-1] = n - (blocks - 1) * BLOCK
    at, live = np.zeros(blocks, dtype=np.int64), np.arange(blocks)
    n_words = np.zeros(blocks, dtype=np.int64)
    steps = []
    while len(live):
        here = at[live]
        chosen = best[live, here]
        steps.append((live, here, chosen, n_words[live]))
        n_words[live] += 1
        at[live] = here + _PER_SELECTOR[chosen]
        live = live[at[live] < lengths[live]]
    offsets = np.concatenate(([0], np.cumsum(n_words)[:-1]))
    block, start, chosen, step = (np.concatenate(x) for x in zip(*steps))
    to, flat = offsets[block] + step, block * wide + start
    words, cells = np.empty(n_words.sum(), dtype=np.uint64), grid.reshape(-1)
    escaped = np.empty(0, np.uint64)
    for s in np.unique(chosen):
        mine = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            mine = mine[np.argsort(to[mine])]
            escaped = cells[flat[mine]]
            body = np.arange(len(mine), dtype=np.uint64)
        else:
            count, bits = COUNTS[s - 1], BITS[s - 1]
            shifts = (np.arange(count) * bits).astype(np.uint64)
            body = np.bitwise_or.reduce(cells[flat[mine][:, None] + np.arange(count)] << shifts, axis=1)
        words[to[mine]] = body | np.uint64(int(s) << 60)
    return words, offsets.astype(np.uint32), escaped


def unpack(words: np.ndarray, offsets: np.ndarray, n: int, escaped: np.ndarray) -> np.ndarray:
    """The ``n`` values of :func:`pack`, as unsigned 64-bit integers."""
    if not n:
        return np.empty(0, np.uint64)
    wide, blocks = BLOCK + _PAD, len(offsets)
    chosen = (words >> np.uint64(60)).astype(np.int64)
    ends = np.cumsum(_PER_SELECTOR[chosen])
    begins = ends - _PER_SELECTOR[chosen]
    first = offsets.astype(np.int64)
    block = np.repeat(np.arange(blocks), np.diff(np.append(first, len(words))))
    flat = block * wide + begins - begins[first][block]
    cells = np.zeros(blocks * wide, dtype=np.uint64)
    for s in np.unique(chosen):
        mine = np.flatnonzero(chosen == s)
        body = words[mine] & np.uint64((1 << 60) - 1)
        if s == ESCAPE:
            cells[flat[mine]] = escaped[body.astype(np.int64)]
            continue
        count, bits = COUNTS[s - 1], BITS[s - 1]
        shifts = (np.arange(count) * bits).astype(np.uint64)
        cells[flat[mine][:, None] + np.arange(count)] = (body[:, None] >> shifts) & np.uint64((1 << bits) - 1)
    return cells.reshape(blocks, wide)[:, :BLOCK].reshape(-1)[:n]
