"""Suffix-array dedup: remove every byte of a 100-byte string that starts earlier too.

A byte of a text is removed when it lies in a window of ``LENGTH`` bytes that also
starts earlier (in a smaller document id, or earlier in the same document). Equal
windows are adjacent in a suffix array; the array is built one bucket at a time.

1. Which suffixes matter. Of the ``K``-grams in a window the one with the least
   hash is its anchor. Equal windows have equal anchors at equal offsets, so a
   window whose anchor's K-gram stands nowhere else cannot be repeated. Documents
   are dealt into blocks by id; each block lists its anchor keys, the keys are
   counted by shard, and only repeated ones come back.
2. Suffix buckets. The anchors of a repeated key are a bucket; each is sent with
   its context, the bytes that its windows cover. Inside a block, an anchor whose
   whole context stood before is not sent: all its windows are repeats. Neither is
   it sorted where another block had that context.
3. Sorting a bucket. Windows are sorted by their first ``COVER`` bytes; ties are
   resolved by ranks of a difference-cover sample: positions whose residue modulo
   ``COVER`` is in a difference cover are ranked beforehand by the bytes that
   follow (in doubling steps, since a sample's followers at multiples of ``COVER``
   are samples too), and any two suffixes have a common shift below ``COVER`` that
   takes both to samples. All tied classes are split at once around their earliest
   member; what equals it is a repeat. Buckets are sorted ``BUCKET_ROWS`` contexts
   at a time, which bounds the memory.
4. A key that stands more than ``HOT_KEY`` times is one bucket too large for a
   task: its windows are dealt out one by one, by 128 bits of hash, and the
   earliest of each kind stays.

The texts are shuffled once, by block, and read three times from that shuffle. The
repeats are byte intervals; each block cuts its documents with them.

Defined results: a null text is empty; texts under ``LENGTH`` bytes are kept whole;
rows with one id are ordered by the hash of their text and stand in one block, so
that a repeated row's bytes are repeats; a null id is ordered as the least long.
Columns other than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.llm import _shingles
from assayframe.llm._common import as_text
from assayframe.llm._shingles import mix

LENGTH = 100
K = 32
LEFT = LENGTH - K           # a window begins at most this far before its anchor
COVER = 32
MIDDLE = LENGTH - COVER     # bytes that a sample's rank stands for
WIDE = LEFT + LENGTH        # bytes of a context
STRIDE = 192                # of a context in a bucket's text, padded
BLOCK_BYTES = 16 << 20
PIECE_BYTES = 1 << 20       # of a block's texts, whose K-grams are in memory at a time
SEGMENT = 2 << 20           # a longer text is handled as overlapping pieces of this size
SHARD_BYTES = 8 << 20       # input bytes per shard of keys and buckets
BATCH_BYTES = 8 << 20       # of contexts that leave a task at a time
BUCKET_ROWS = 8_000
SLICE = 4096                # rows whose bytes are gathered at a time
HOT_KEY = 50_000
_POSITION = np.uint64(26)   # bits of a position beside a hash when windows take their least
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTES = mix((np.arange(256, dtype=np.uint64) + np.uint64(11)) * _ODD)


def difference_cover(v: int) -> np.ndarray:
    """A small set of residues such that every residue is a difference of two of
    them, by greedy choice."""
    cover, missing = [0], set(range(1, v))
    while missing:
        gain = lambda x: len(missing & {d % v for c in cover for d in (x - c, c - x)})
        best = max(range(v), key=gain)
        missing -= {d % v for c in cover for d in (best - c, c - best)}
        cover.append(best)
    return np.array(sorted(cover))


def common_shift(cover: np.ndarray, v: int) -> np.ndarray:
    """``table[a, b]``: the least shift that takes residues a and b into the cover."""
    inside = np.isin(np.arange(2 * v) % v, cover)
    return np.array([[next(s for s in range(v) if inside[a + s] and inside[b + s]) for b in range(v)]
                     for a in range(v)])


_COVER = difference_cover(COVER)
_SHIFT = common_shift(_COVER, COVER)
_IN_COVER = np.isin(np.arange(COVER), _COVER)


# ------------------------------------------------------------------ texts of a block
def _ordered(docs: pa.Table) -> pa.Table:
    """The block's rows by (id, hash of the text); a row's place is its number."""
    ids = docs.column("doc_id").to_numpy(zero_copy_only=False)
    if docs.column("doc_id").null_count:
        ids = np.array([np.iinfo(np.int64).min if x is None else x for x in docs.column("doc_id").to_pylist()])
    return docs.append_column("order_id", pa.array(ids.astype(np.int64))).take(
        pa.array(np.lexsort((docs.column("fp").to_numpy(), ids))))


def _segments(docs: pa.Table, segment: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(bytes, begins, rows, offsets)`` of pieces of the block: texts, or
    overlapping parts of a long one, with their row and offset in the text."""
    row = 0
    for piece in _shingles.pieces(iter(docs.combine_chunks().to_batches()), PIECE_BYTES):
        flat, begins = _shingles.text_bytes(piece.column("text"))
        if len(flat) <= segment:
            yield flat, begins, np.arange(row, row + piece.num_rows), np.zeros(piece.num_rows, dtype=np.int64)
        else:
            for i in range(piece.num_rows):
                text = flat[begins[i]:begins[i + 1]]
                for at in range(0, max(1, len(text) - LENGTH + 1), segment):
                    part = text[at:at + segment + LENGTH - 1]
                    yield part, np.array([0, len(part)]), np.array([row + i]), np.array([at])
        row += piece.num_rows


class Anchors:
    """Anchors of a piece: position, key, and the first and last window of each."""

    def __init__(self, flat: np.ndarray, begins: np.ndarray):
        n = len(flat)
        self.flat, self.begins = flat, begins
        self.at = self.lo = self.hi = self.text = np.empty(0, np.int64)
        self.key = np.empty(0, np.uint64)
        if n < LENGTH:
            return
        power, self.inverse = _shingles._power_tables(n + 1)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[flat] * power[:n])))
        grams = mix((self.sums[K:] - self.sums[:-K]) * self.inverse[:n - K + 1])
        least = (grams >> _POSITION << _POSITION) | np.arange(len(grams), dtype=np.uint64)
        size, step = LENGTH - K + 1, 1
        while 2 * step <= size:
            least, step = np.minimum(least[:-step], least[step:]), 2 * step
        if step < size:
            least = np.minimum(least[:step - size], least[size - step:])
        anchor = (least & np.uint64((1 << 26) - 1)).astype(np.int64)        # of each window of the bytes
        lengths = np.diff(begins)
        inside = np.zeros(n + 1, dtype=np.int64)                            # windows within one text
        long = lengths >= LENGTH
        np.add.at(inside, begins[:-1][long], 1)
        np.add.at(inside, begins[1:][long] - LENGTH + 1, -1)
        window = np.flatnonzero(np.cumsum(inside)[:n - LENGTH + 1] > 0)
        if not len(window):
            return
        mine = anchor[window]
        new = np.concatenate(([True], (mine[1:] != mine[:-1]) | (np.diff(window) > 1)))
        first = np.flatnonzero(new)
        text = np.searchsorted(begins, window[first], side="right") - 1
        self.at, self.lo = mine[first], window[first]
        self.hi = window[np.append(first[1:], len(window)) - 1]
        self.text, self.key = text, grams[self.at]

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))

    def keep(self, which: np.ndarray) -> None:
        self.at, self.lo, self.hi = self.at[which], self.lo[which], self.hi[which]
        self.text, self.key = self.text[which], self.key[which]

    def contexts(self) -> tuple[np.ndarray, np.ndarray]:
        """First byte of each context and the byte after its last."""
        return (np.maximum(self.at - LEFT, self.begins[self.text]), np.minimum(self.at + LENGTH, self.begins[self.text + 1]))


# ------------------------------------------------------------------ step 1: repeated keys
def _list_keys(shards: int, segment: int):
    schema = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])

    def run(key: tuple[pa.Scalar, ...], docs: pa.Table) -> pa.Table:
        found = [Anchors(flat, begins).key for flat, begins, _, _ in _segments(docs, segment)]
        keys, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *found]), return_counts=True)
        shard = (keys % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        cut = np.searchsorted(shard[order], np.arange(shards + 1))
        which = np.flatnonzero(np.diff(cut))
        if not len(which):
            return schema.empty_table()
        return pa.Table.from_arrays([
            pa.array([key[0].as_py()] * len(which), pa.int64()), pa.array(which, pa.int32()),
            _cells(keys[order], cut, which), _cells(np.minimum(counts[order], 1 << 30).astype("<u4"), cut, which)], schema=schema)
    return run


def _repeated_keys(hot_key: int):
    def run(key: tuple[pa.Scalar, ...], lists: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_buffer(), "<u8") for x in lists.column("keys")]
        counts = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in lists.column("counts")]).astype(np.int64)
        _, name = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.bincount(name, weights=counts)[name]
        out, hot, at = [], [], 0
        for p in parts:
            t = total[at:at + len(p)]
            at += len(p)
            out.append(p[(t > 1) & (t <= hot_key)].tobytes())
            hot.append(p[t > max(hot_key, 1)].tobytes())
        return pa.Table.from_arrays([lists.column("block"), pa.array(out, pa.binary()), pa.array(hot, pa.binary())],
                                    names=["block", "repeated", "hot"])
    return run


# ------------------------------------------------------------------ step 2: contexts
_SENT = np.dtype([("key", "<u8"), ("context", "<u8"), ("doc", "<i8"), ("row", "<i4"), ("at", "<i8"),
                  ("back", "u1"), ("from_", "u1"), ("to", "u1")])
_ALONE = np.dtype([("a", "<u8"), ("b", "<u8"), ("doc", "<i8"), ("row", "<i4"), ("at", "<i8")])
_FOUND = np.dtype([("row", "<i4"), ("begin", "<i8"), ("end", "<i8")])
_PLACE = np.dtype([("segment", "<i4"), ("at", "<i8"), ("lo", "<i8"), ("hi", "<i8")])
_NOTHING_LISTED = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("sent", pa.binary()), ("bytes", pa.binary()),
                             ("alone", pa.binary()), ("found", pa.binary())])
_LISTED = "block long, shard int, sent binary, bytes binary, alone binary, found binary"


def _sorted_values(column) -> np.ndarray:
    return np.unique(np.concatenate([np.empty(0, np.uint64), *(np.frombuffer(x.as_buffer(), "<u8") for x in column)]))


def _member(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(values):
        return np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
    return values[at] == wanted


def _first_of_each(*columns) -> np.ndarray:
    """For rows in their order, whether a row is the first with its values."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), dtype=bool)
    if len(order):
        new[0] = True
        for c in columns:
            new[1:] |= c[order][1:] != c[order][:-1]
    out = np.zeros(len(order), dtype=bool)
    out[order[new]] = True              # lexsort is stable: the earliest row leads its group
    return out


def _context_bytes(flat: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """``WIDE`` bytes from each position, zero outside ``lo`` to ``hi``."""
    out = np.empty((len(at), WIDE), dtype=np.uint8)
    for i in range(0, len(at), SLICE):
        column = at[i:i + SLICE, None] + np.arange(WIDE)
        inside = (column >= lo[i:i + SLICE, None]) & (column < hi[i:i + SLICE, None])
        out[i:i + SLICE] = np.where(inside, flat[np.clip(column, 0, len(flat) - 1)], 0)
    return out


def _list_contexts(shards: int, segment: int):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, known: pa.Table) -> pa.Table:
        docs = _ordered(docs)
        ids = docs.column("order_id").to_numpy()
        repeated, hot = _sorted_values(known.column("repeated")), _sorted_values(known.column("hot"))
        sent, alone, found, places = [], [], [], []
        for number, (flat, begins, rows, offsets) in enumerate(_segments(docs, segment)):
            a = Anchors(flat, begins)
            is_hot = _member(hot, a.key)
            which = np.flatnonzero(is_hot | _member(repeated, a.key))
            a.keep(which)
            is_hot = is_hot[which]
            if not len(which):
                continue
            lo, hi = a.contexts()
            row, shift = rows[a.text], offsets[a.text] - begins[a.text]
            here = np.zeros(len(which), dtype=_SENT)
            here["key"], here["doc"], here["row"], here["at"] = a.key, ids[row], row, a.at + shift
            here["context"] = mix(a.hashes(lo, hi) + (a.at - lo).astype(np.uint64) * _ODD)
            here["back"], here["from_"], here["to"] = a.at - lo, a.at - a.lo, a.at - a.hi
            cold = np.flatnonzero(~is_hot)
            sent.append(here[cold])
            place = np.zeros(len(cold), dtype=_PLACE)
            place["segment"], place["at"], place["lo"], place["hi"] = number, a.at[cold] - LEFT, lo[cold], hi[cold]
            places.append(place)
            if is_hot.any():
                h = np.flatnonzero(is_hot)
                count = a.hi[h] - a.lo[h] + 1
                start = np.repeat(a.lo[h] - (np.cumsum(count) - count), count) + np.arange(count.sum())
                of = np.repeat(h, count)
                one = np.zeros(len(start), dtype=_ALONE)
                one["a"] = a.hashes(start, start + LENGTH)
                tail = a.hashes(start, start + LENGTH // 2), a.hashes(start + LENGTH // 2, start + LENGTH)
                one["b"] = mix(tail[0] * _ODD + tail[1])
                one["doc"], one["row"], one["at"] = ids[row[of]], row[of], start + shift[of]
                alone.append(one)
        sent = np.concatenate([np.zeros(0, _SENT), *sent])
        places = np.concatenate([np.zeros(0, _PLACE), *places])
        alone = np.concatenate([np.zeros(0, _ALONE), *alone])
        first = _first_of_each(sent["key"], sent["context"])
        found.append(_intervals(sent[~first]))
        sent, places = sent[first], places[first]
        lone = _first_of_each(alone["a"], alone["b"])
        found.append(_window_intervals(alone[~lone]))
        alone = alone[lone]
        done = np.concatenate(found)
        # Shard by shard; the bytes of the contexts are read from the texts once their places are known.
        shard, lone_shard = (sent["key"] % np.uint64(shards)).astype(np.int64), (alone["a"] % np.uint64(shards)).astype(np.int64)
        order, lone_order = np.argsort(shard, kind="stable"), np.argsort(lone_shard, kind="stable")
        sent, places, alone = sent[order], places[order], alone[lone_order]
        texts = np.empty((len(sent), WIDE), dtype=np.uint8)
        by_segment = np.argsort(places["segment"], kind="stable")
        edges = np.searchsorted(places["segment"][by_segment], np.arange(places["segment"].max(initial=-1) + 2))
        for (flat, _, _, _), i, j in zip(_segments(docs, segment), edges, edges[1:]):
            for k in range(i, j, SLICE):
                some = by_segment[k:min(k + SLICE, j)]
                texts[some] = _context_bytes(flat, *(places[c][some] for c in ("at", "lo", "hi")))
        cut, lone_cut = (np.searchsorted(x, np.arange(shards + 1)) for x in (shard[order], lone_shard[lone_order]))
        done_cut = np.linspace(0, len(done), shards + 1).astype(np.int64)
        some = np.flatnonzero((np.diff(cut) > 0) | (np.diff(lone_cut) > 0) | (np.diff(done_cut) > 0))
        batch = (cut[some + 1] * WIDE) // BATCH_BYTES
        tables = []
        for b in np.unique(batch):
            mine = some[batch == b]
            tables.append(pa.Table.from_arrays([
                pa.array([key[0].as_py()] * len(mine), pa.int64()), pa.array(mine, pa.int32()),
                _cells(sent, cut, mine), _cells(texts, cut, mine), _cells(alone, lone_cut, mine), _cells(done, done_cut, mine)],
                names=["block", "shard", "sent", "bytes", "alone", "found"]))
        return pa.concat_tables(tables) if tables else _NOTHING_LISTED.empty_table()
    return run


def _cells(rows: np.ndarray, cut: np.ndarray, which: np.ndarray) -> pa.Array:
    """The rows of each of some shards, sorted by shard, as one binary value each."""
    part = rows[cut[which[0]]:cut[which[-1] + 1]]          # shards between them have no rows
    width = part.dtype.itemsize * (part.shape[1] if part.ndim > 1 else 1)
    offsets = np.append(cut[which], cut[which[-1] + 1]) - cut[which[0]]
    return pa.Array.from_buffers(pa.binary(), len(which), [None, pa.py_buffer((offsets * width).astype("<i4")),
                                                           pa.py_buffer(np.ascontiguousarray(part).view(np.uint8).reshape(-1))])


def _intervals(sent: np.ndarray) -> np.ndarray:
    """The bytes that all windows of these anchors cover."""
    out = np.zeros(len(sent), dtype=_FOUND)
    out["row"], out["begin"], out["end"] = sent["row"], sent["at"] - sent["from_"], sent["at"] - sent["to"] + LENGTH
    return out


def _window_intervals(windows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(windows), dtype=_FOUND)
    out["row"], out["begin"], out["end"] = windows["row"], windows["at"], windows["at"] + LENGTH
    return out


# ------------------------------------------------------------------ step 3: sort the buckets
def _dense_ranks(*columns) -> np.ndarray:
    """Ranks of rows by their columns, equal rows alike."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), dtype=np.int64)
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(new)
    return out


def _words(text: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """``n`` bytes from each position as big-endian 64-bit words: rows x n / 8."""
    out = np.empty((len(at), n // 8), dtype=np.uint64)
    for i in range(0, len(at), SLICE):
        out[i:i + SLICE] = text[at[i:i + SLICE, None] + np.arange(n)].view(">u8")
    return out


def sample_ranks(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Ranks of cover samples at ``at`` (sorted) by the ``MIDDLE`` bytes that
    follow, over the whole of ``text``; -1 elsewhere. Doubling: first by COVER
    bytes, then by the pair of that rank and the rank COVER bytes on, then by the
    bytes that remain."""
    names = np.full(len(text), -1, dtype=np.int64)
    words = _words(text, at, COVER)
    names[at] = _dense_ranks(*words.T)
    rest = text[np.minimum(at[:, None] + 2 * COVER + np.arange(MIDDLE - 2 * COVER), len(text) - 1)]
    tail = np.zeros(len(at), dtype=np.int64)
    for i in range(rest.shape[1]):
        tail = tail << 8 | rest[:, i]
    following = np.minimum(at + COVER, len(text) - 1)
    ranks = np.full(len(text), -1, dtype=np.int64)
    ranks[at] = _dense_ranks(names[at], names[following], tail)
    return ranks


def repeated_windows(bucket: np.ndarray, rows: np.ndarray, order: np.ndarray, at: np.ndarray, start: np.ndarray,
                     of: np.ndarray) -> np.ndarray:
    """Which windows equal an earlier one of their bucket.

    ``rows`` is the text of the contexts (contexts x WIDE); window i begins at
    column ``start[i]`` of context ``of[i]``. ``at`` is each context's position in
    its document, ``bucket`` its bucket; ``order`` says which windows are earlier."""
    text = np.zeros((len(rows), STRIDE), dtype=np.uint8)
    text[:, :WIDE] = rows
    text = text.reshape(-1)
    place = of * STRIDE + start
    last = place + LENGTH - COVER
    # Windows whose two ends are alone in their bucket are nobody's repeat.
    ends = [mix(_fold(_words(text, p, COVER))) for p in (place, last)]
    group = _dense_ranks(bucket[of], *ends)
    live = np.flatnonzero(np.bincount(group)[group] > 1)
    out = np.zeros(len(place), dtype=bool)
    if not len(live):
        return out
    residue = (at[of] - LEFT + start) % COVER
    # Samples of the contexts that are still in question.
    used = np.unique(of[live])
    columns = np.arange(WIDE - COVER + 1)
    sampled = _IN_COVER[(at[used][:, None] - LEFT + columns) % COVER]
    samples = (used[:, None] * STRIDE + columns)[sampled]
    ranks = sample_ranks(text, samples)
    # Sort by the first COVER bytes; the last COVER bytes and the samples decide ties.
    classes = _dense_ranks(bucket[of[live]], *_words(text, place[live], COVER).T, *_words(text, last[live], COVER).T)
    sequence = np.lexsort((order[live], classes))
    live, classes = live[sequence], classes[sequence]
    while len(live):
        head = np.concatenate(([True], classes[1:] != classes[:-1]))
        pivot = live[np.flatnonzero(head)][np.cumsum(head) - 1]
        shift = _SHIFT[residue[live], residue[pivot]]
        mine, its = ranks[place[live] + shift], ranks[place[pivot] + shift]
        out[live[(mine == its) & ~head]] = True
        side = np.sign(mine - its)
        rest = side != 0
        live, classes = live[rest], classes[rest] * 2 + (side[rest] > 0)
        sequence = np.lexsort((order[live], classes))
        live = live[sequence]
        classes = classes[sequence]
        if len(classes):                # renumber, so that doubling does not overflow
            classes = np.cumsum(np.concatenate(([0], classes[1:] != classes[:-1])))
    return out


def _fold(words: np.ndarray) -> np.ndarray:
    total = np.zeros(len(words), dtype=np.uint64)
    for w in words.T:
        total = mix(total * _ODD + w)
    return total


def _sort_buckets(bucket_rows: int):
    def run(key: tuple[pa.Scalar, ...], lists: pa.Table) -> pa.Table:
        """Intervals of repeats for each block, from all contexts of a shard."""
        blocks = lists.column("block").to_numpy()
        read = lambda name, kind: [np.frombuffer(x.as_buffer(), kind) for x in lists.column(name)]
        parts = read("sent", _SENT)
        sent = np.concatenate(parts)
        texts = read("bytes", np.uint8)
        texts = (texts[0] if len(texts) == 1 else np.concatenate(texts)).reshape(-1, WIDE)
        block = np.repeat(blocks, [len(p) for p in parts])
        # By bucket and context, the earliest first; the bytes stay where they are.
        order = np.lexsort((sent["at"], sent["row"], sent["doc"], sent["context"], sent["key"]))
        sent, block = sent[order], block[order]
        found, owner = [], []
        if len(sent):
            new = np.concatenate(([True], (sent["key"][1:] != sent["key"][:-1]) | (sent["context"][1:] != sent["context"][:-1])))
            lead = np.flatnonzero(new)[np.cumsum(new) - 1]
            same = np.ones(len(sent), dtype=bool)               # bytes decide, not the hash
            again = np.flatnonzero(~new)
            for i in range(0, len(again), SLICE):
                some = again[i:i + SLICE]
                same[some] = (texts[order[some]] == texts[order[lead[some]]]).all(axis=1)
            whole = ~new & same
            found.append(_intervals(sent[whole]))
            owner.append(block[whole])
            left = np.flatnonzero(~whole)
            keys = sent["key"][left]
            edge = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            sizes = np.diff(np.append(edge, len(left)))
            edge, sizes = edge[sizes > 1], sizes[sizes > 1]
            begin = 0
            while begin < len(edge):        # buckets, some thousands of contexts at a time
                upto = begin + max(1, int(np.searchsorted(np.cumsum(sizes[begin:]), bucket_rows, side="right")))
                mine = left[np.concatenate([np.arange(e, e + s) for e, s in zip(edge[begin:upto], sizes[begin:upto])])]
                got, who = _repeats_of(sent[mine], texts[order[mine]], np.repeat(np.arange(upto - begin), sizes[begin:upto]))
                found.append(got)
                owner.append(block[mine][who])
                begin = upto
        alone_parts = read("alone", _ALONE)
        alone = np.concatenate(alone_parts)
        alone_block = np.repeat(blocks, [len(p) for p in alone_parts])
        if len(alone):
            order = np.lexsort((alone["at"], alone["row"], alone["doc"]))
            alone, alone_block = alone[order], alone_block[order]
            again = ~_first_of_each(alone["a"], alone["b"])
            found.append(_window_intervals(alone[again]))
            owner.append(alone_block[again])
        for b, own in zip(blocks, read("found", _FOUND)):
            found.append(own)
            owner.append(np.full(len(own), b))
        found = np.concatenate([np.zeros(0, _FOUND), *found])
        owner = np.concatenate([np.zeros(0, np.int64), *owner])
        names = np.unique(blocks)
        return pa.Table.from_arrays([pa.array(names, pa.int64()),
                                     pa.array([found[owner == b].tobytes() for b in names], pa.binary())], names=["block", "found"])
    return run


def _repeats_of(sent: np.ndarray, texts: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of repeated windows as intervals, with the index of their context."""
    count = sent["from_"].astype(np.int64) - sent["to"] + 1
    of = np.repeat(np.arange(len(sent)), count)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    back = sent["from_"].astype(np.int64)[of] - nth         # bytes from the window's start to the anchor
    place = np.lexsort((sent["at"], sent["row"], sent["doc"]))
    earlier = np.empty(len(sent), dtype=np.int64)
    earlier[place] = np.arange(len(sent))
    again = repeated_windows(bucket, texts, earlier[of], sent["at"], LEFT - back, of)
    starts = again & np.concatenate(([True], ~again[:-1] | (of[1:] != of[:-1])))
    ends = again & np.concatenate((~again[1:] | (of[1:] != of[:-1]), [True]))
    s, e = np.flatnonzero(starts), np.flatnonzero(ends)
    out = np.zeros(len(s), dtype=_FOUND)
    out["row"] = sent["row"][of[s]]
    out["begin"], out["end"] = sent["at"][of[s]] - back[s], sent["at"][of[e]] - back[e] + LENGTH
    return out, of[s]


# ------------------------------------------------------------------ step 4: cut
def _cut(with_text: bool):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, lists: pa.Table) -> pa.Table:
        docs = _ordered(docs)
        found = np.concatenate([np.zeros(0, _FOUND), *(np.frombuffer(x.as_buffer(), _FOUND) for x in lists.column("found"))])
        found = found[np.lexsort((found["begin"], found["row"]))]
        edges = np.searchsorted(found["row"], np.arange(docs.num_rows + 1))
        rows = {"doc_id": docs.column("doc_id"), "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
        spans = []
        for row, text in enumerate(docs.column("text")):
            data = text.as_buffer()
            mine, kept, at, removed, n = found[edges[row]:edges[row + 1]], [], 0, 0, 0
            own = []
            if len(mine):
                reach = np.maximum.accumulate(mine["end"])
                apart = np.concatenate(([True], mine["begin"][1:] > reach[:-1]))
                begin, end = mine["begin"][apart], reach[np.append(np.flatnonzero(apart)[1:], len(mine)) - 1]
                for b, e in zip(begin.tolist(), end.tolist()):
                    kept.append(data[at:b])
                    at, removed, n = e, removed + e - b, n + 1
                    own.append({"begin": b, "end": e})
            kept.append(data[at:])
            digest = hashlib.sha256()
            for part in kept:
                digest.update(part)
            for name, value in (("n_bytes", len(data)), ("n_removed", removed), ("n_spans", n),
                                ("kept_sha256", digest.hexdigest())):
                rows[name].append(value)
            spans.append(own)
        out = {k: v if k == "doc_id" else pa.array(v, pa.string() if k == "kept_sha256" else pa.int64())
               for k, v in rows.items()}
        if with_text:
            out["spans"] = pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))
        return pa.table(out)
    return run


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spans: bool = False,
                hot_key: int = HOT_KEY, bucket_rows: int = BUCKET_ROWS, segment: int = SEGMENT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per document row and,
    with ``spans``, the removed intervals of bytes (begin, end). The last three
    arguments bound the work at a time and do not change the result."""
    text = as_text(F.col(text_col))
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("fp"), text.alias("text"))
    size = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    n_blocks, shards = -(-size // BLOCK_BYTES) or 1, -(-size // SHARD_BYTES) or 1
    dealt = docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(n_blocks)).alias("block"), "doc_id", "fp", "text")
    keys = dealt.groupBy("block").applyInArrow(
        _list_keys(shards, segment), "block long, shard int, keys binary, counts binary")
    known = keys.groupBy("shard").applyInArrow(_repeated_keys(hot_key), "block long, repeated binary, hot binary")
    listed = dealt.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        _list_contexts(shards, segment), _LISTED)
    found = listed.groupBy("shard").applyInArrow(_sort_buckets(bucket_rows), "block long, found binary")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return dealt.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(
        _cut(spans), schema + (", spans array<struct<begin:long,end:long>>" if spans else ""))
