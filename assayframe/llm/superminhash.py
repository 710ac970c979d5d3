"""SuperMinHash signatures of many sets at once.

Each element visits the positions of the signature in a random order of its own
(one Fisher-Yates step at a time) and offers step + random fraction; a position
keeps the least offer. The ranks of one element over the positions are a
permutation, which makes the estimate less variable than independent hashes do.
A set stops as soon as no later step can lower any of its positions, which for
sets much larger than the signature is after the first step or two.
"""

from __future__ import annotations

import numpy as np

from assayframe.llm._shingles import mix

_STEP = 0x9E3779B97F4A7C15
_ODD = np.uint64(_STEP)
_FRACTION = 26              # bits of the random fraction; the step stands above them


def signatures(elements: np.ndarray, bounds: np.ndarray, m: int) -> np.ndarray:
    """Signatures (sets x ``m``, unsigned 32-bit) of the sets
    ``elements[bounds[i]:bounds[i + 1]]``; an empty set has the largest value."""
    if m > 64:
        raise ValueError("at most 64 positions")
    n = len(bounds) - 1
    out = np.full((n, m), np.uint32(0xFFFFFFFF), dtype=np.uint32)
    flat = out.reshape(-1)
    of = np.repeat(np.arange(n), np.diff(bounds))
    order = None                                # per active element, its permutation so far
    hashes = elements
    for step in range(m):
        draw = mix(hashes + np.uint64((step + 1) * _STEP & 0xFFFFFFFFFFFFFFFF))
        swap = step + ((draw & np.uint64(0xFFFFFFFF)) % np.uint64(m - step)).astype(np.int64)
        offer = (np.uint32(step << _FRACTION) | (draw >> np.uint64(64 - _FRACTION)).astype(np.uint32))
        if order is None:
            where = swap
        else:
            rows = np.arange(len(hashes))
            where = order[rows, swap].astype(np.int64)
            order[rows, swap] = order[:, step]
        np.minimum.at(flat, of * m + where, offer)
        # Later offers are at least (step + 1) << _FRACTION.
        open_sets = (out >= np.uint32(min((step + 1) << _FRACTION, 0xFFFFFFFF))).any(axis=1)
        live = open_sets[of]
        if not live.any():
            break
        if order is None:
            order = np.broadcast_to(np.arange(m, dtype=np.uint8), (int(live.sum()), m)).copy()
            rows, first = np.arange(len(order)), swap[live]
            order[rows, first] = 0              # the value that stood at position 0
            hashes, of = hashes[live], of[live]
        elif not live.all():
            order, hashes, of = order[live], hashes[live], of[live]
    return out


def band_hashes(signature: np.ndarray, rows: int) -> np.ndarray:
    """One signed 64-bit hash per band of ``rows`` positions."""
    n, m = signature.shape
    parts = signature.reshape(n, m // rows, rows).astype(np.uint64)
    out = np.broadcast_to(np.arange(m // rows, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(rows):
        out = mix(out * _ODD + parts[:, :, i])
    return out.view(np.int64)
