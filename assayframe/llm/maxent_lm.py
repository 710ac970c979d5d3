"""LM scoring: a hashed maximum-entropy model with a class-factored softmax.

log P(text) is summed over its tokens (words, then one end):

    P(token | before) = (1 - u) * P(class | before) * count(token) / count(class)

for a token seen in training, and u for any other, u being the share of training
tokens that were seen once (Good-Turing). P(class | before) is a softmax over
``CLASSES`` classes whose weights are looked up by hashed features: the word
before (n-gram), the two words before (n-gram), and the word before the last
(skip). The commonest tokens are a class each; all others are classed by a hash
of their last three bytes, those hashes being clustered by the common tokens they
stand next to.

Training counts every token of every training text. The weights of the hashed
features start at smoothed log ratios and are then raised by gradient updates: each
round covers every token of all training documents, tasks return observed or expected
class counts per feature, and their differences, scaled by the expected counts, move
the weights. A round needs of a token no more than its hashed features and its class:
texts are cut into tokens once, and the rounds read how often each of those stands.

Hashed features are of a fixed size, so many contexts share one. Beside them each
context of each template has features of its own, whose number grows with the
corpus: one per class that followed it in training. Their weights,
log(1 + count / (strength * P)) beside the P of the features before, are the mode
under a Dirichlet prior of that strength around P and keep the softmax normalised:

    P'(class | context) = (count(context, class) + strength * P) / (count(context) + strength)

template by template: skip, word before, two words before. The strength is the one
of ``STRENGTHS`` under which a shard's training counts are likeliest, each left out
of its own context.

Token counts and context counts are never gathered: documents are scored in blocks,
each of which lists its distinct words and contexts by shard, a range of their
hashes, and scores its texts in sparse numpy batches. The lists carry the block's
training counts, so that a shard sums over all blocks what it answers to each. Only
lists that hold something are sent: their number never passes that of the words and
contexts in them, however many blocks and shards there are.

Defined results: a null text is empty and has the end token alone; a null id counts
as an empty one and a null is never held out by itself; repeated rows are scored
and trained on each; without training documents every token has probability one.
Columns other than the id and the text are ignored. Words are named by 64-bit
hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.llm import _shingles
from assayframe.llm._common import as_text, written
from assayframe.llm._shingles import mix

SINGLES = 15                # tokens that are a class of their own
CLASSES = 32
SUFFIXES = 4096             # hashed word endings
BUCKETS = 4096              # hashed features per template
TEMPLATES = 3
ROUNDS = 4                  # the first sets the weights, the others move them
CONTEXT_BITS = 44           # of a context's hash, above the class in a key
CLASS_BITS = 5
TOKENS_PER_SHARD = 1 << 20  # training tokens for each range of the hashes
STRENGTHS = 4.0 ** np.arange(9)
STEP = 0.7                  # of the distance that would match each feature's counts alone
BLOCK_BYTES = 16 << 20
PIECE_BYTES = 2 << 20
SCORE_TOKENS = 1 << 15      # of a block, whose softmax is in memory at a time
FEATURE_TOKENS = 1 << 21    # of a task, whose features are counted at a time
ROW_FEATURES = 1 << 18      # distinct features and classes in a row of them
FAN_IN = 16                 # arrays of tasks that are added in one group
END = np.uint64(0x1)        # the end token's hash; words' hashes are mixed 64-bit values
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PARTS = 8                  # a summed array travels in so many rows
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
_ZSTD = pa.Codec("zstd", 1)


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hashes, endings, first)``: of all tokens, texts one after the other, with
    the end token after each, and where each text begins (one more entry)."""
    flat, begins = _shingles.text_bytes(texts)
    start, stop = _shingles._word_edges(flat, begins)
    words, first = _shingles.hashes_between(flat, start, stop), np.searchsorted(start, begins)
    n, total = len(texts), len(words) + len(texts)
    out, ending = np.full(total, END, dtype=np.uint64), np.zeros(total, dtype=np.int64)
    at = np.arange(len(words)) + np.repeat(np.arange(n), np.diff(first))
    out[at] = words
    if len(words):
        last = np.zeros(len(stop), dtype=np.uint32)
        for k in range(3):
            last |= _LOWER[flat[np.maximum(stop - 1 - k, 0)]] << np.uint32(8 * k)
        ending[at] = (mix(last.astype(np.uint64) * _ODD) % np.uint64(SUFFIXES)).astype(np.int64)
    return out, ending, first + np.arange(n + 1)


class Classes:
    """The class of a token: its own for the common ones, else that of its ending."""

    def __init__(self, singles: np.ndarray, of_ending: np.ndarray):
        self.singles, self.of_ending = singles, of_ending
        bits = 12                                           # as many low bits as tell the common tokens apart
        while len(np.unique(self._slot(singles, bits))) < len(singles):
            bits += 1
        self.bits, self.table = bits, np.full(1 << bits, SINGLES)
        self.table[self._slot(singles, bits)] = np.arange(len(singles))

    @staticmethod
    def _slot(hashes: np.ndarray, bits: int) -> np.ndarray:
        return (hashes & np.uint64((1 << bits) - 1)).astype(np.int64)

    def single(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each common token, SINGLES for the others."""
        index = self.table[self._slot(hashes, self.bits)]
        hit = np.flatnonzero(index < SINGLES)
        index[hit[self.singles[index[hit]] != hashes[hit]]] = SINGLES
        return index

    def __call__(self, hashes: np.ndarray, endings: np.ndarray) -> np.ndarray:
        single = self.single(hashes)
        return np.where(single < SINGLES, single, SINGLES + self.of_ending[endings])


def features(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows of the weight table for each token: templates x tokens."""
    size = np.uint64(BUCKETS)
    return np.stack([x % size + np.uint64(t) * size for t, x in enumerate(contexts(hashes, first))]).astype(np.int64)


def contexts(hashes: np.ndarray, first: np.ndarray, templates=range(TEMPLATES)) -> list[np.ndarray]:
    """Hash of each token's context, per template: word before, two words before, and
    the word before the last."""
    n = len(hashes)
    one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    one[1:], two[2:] = hashes[:-1], hashes[:-2]
    start = first[:-1]
    one[start], two[start] = 0, 0
    second = start + 1
    two[second[second < first[1:]]] = 0
    makers = (lambda: mix(one + _ODD), lambda: mix(mix(one + _ODD) * _ODD + two), lambda: mix(two * _ODD + np.uint64(7)))
    return [makers[t]() for t in templates]


def class_log_probabilities(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Tokens x classes: the log softmax of the summed weights."""
    logits = weights[-1] + weights[rows[0]]
    for r in rows[1:]:
        logits += weights[r]
    logits -= logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def _batches(table_pieces: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for piece in table_pieces:
        yield piece, *tokens(piece.column("text"))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pandas as pd
    for _, hashes, endings, _ in _batches(_shingles.pieces(batches)):
        codes, words = pd.factorize(hashes)
        ending = np.zeros(len(words), dtype=np.int64)
        ending[codes] = endings
        yield pa.RecordBatch.from_arrays(
            [pa.array(words.view(np.int64)), pa.array(ending), pa.array(np.bincount(codes, minlength=len(words)))],
            names=["word", "ending", "c"])


def _as_rows(total: np.ndarray, kind: str = "<f8") -> pa.RecordBatch:
    parts = np.array_split(total.reshape(-1), _PARTS)
    return pa.RecordBatch.from_arrays([pa.array(range(_PARTS), pa.int32()),
                                       pa.array([p.astype(kind).tobytes() for p in parts], pa.binary())],
                                      names=["part", "sums"])


def _add(kind: str):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        total = 0.0
        for x in table.column("sums"):
            total = total + np.frombuffer(x.as_buffer(), kind).astype(np.float64)
        return pa.Table.from_arrays([pa.array([key[0].as_py()], pa.int32()),
                                     pa.array([total.astype(kind).tobytes()], pa.binary())], names=["part", "sums"])
    return run


def _fan_in(tasks: int) -> list[int]:
    """How many sums each level of the tree leaves, until one group can add the rest."""
    levels = []
    while tasks > FAN_IN:
        tasks = -(-tasks // FAN_IN)
        levels.append(tasks)
    return levels


def _summed(texts: DataFrame, make, shape: tuple, kind: str = "<f8") -> np.ndarray:
    """The sum over tasks of an array of fixed shape. Tasks return one each, which are
    added in a tree; its root brings ``_PARTS`` rows here. ``kind`` is the number
    format on the way."""
    rows = texts.mapInArrow(make, "part int, sums binary")
    for width in _fan_in(texts.rdd.getNumPartitions()):
        some = rows.withColumn("some", F.pmod(F.xxhash64("sums"), F.lit(width)))
        rows = some.groupBy("part", "some").applyInArrow(_add(kind), "part int, sums binary")
    parts = rows.groupBy("part").applyInArrow(_add(kind), "part int, sums binary").collect()
    if not parts:
        return np.zeros(shape)
    parts = [np.frombuffer(r["sums"], kind) for r in sorted(parts, key=lambda r: r["part"])]
    return np.concatenate(parts).astype(np.float64).reshape(shape)


def _neighbours(singles: np.ndarray):
    """Counts of (ending, common token before) and (ending, common token after)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Classes(singles, np.zeros(SUFFIXES, dtype=np.int64))
        width = 2 * (SINGLES + 1)
        total = np.zeros(SUFFIXES * width)
        for _, hashes, endings, first in _batches(_shingles.pieces(batches, PIECE_BYTES)):
            single = known.single(hashes)
            inside = np.ones(len(hashes), dtype=bool)
            inside[first[:-1]] = False                      # the first token of a text has none before it
            at = np.flatnonzero(inside)
            other = at[single[at] == SINGLES]
            total += np.bincount(endings[other] * width + single[other - 1], minlength=len(total))
            other = at[single[at - 1] == SINGLES]
            total += np.bincount(endings[other - 1] * width + SINGLES + 1 + single[other], minlength=len(total))
        yield _as_rows(total)
    return run


def cluster(counts: np.ndarray, k: int, rounds: int = 25) -> np.ndarray:
    """Weighted k-means of the endings by the square roots of their neighbour shares."""
    mass = counts.sum(axis=1)
    points = np.sqrt((counts + 0.05) / (mass + 0.05 * counts.shape[1])[:, None])
    centres = [points[int(np.argmax(mass))]]
    for _ in range(k - 1):                                  # next: most mass times distance
        far = np.min([((points - c) ** 2).sum(axis=1) for c in centres], axis=0)
        centres.append(points[int(np.argmax(far * mass))])
    centres = np.array(centres)
    for _ in range(rounds):
        nearest = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        for c in range(k):
            w = mass * (nearest == c)
            if w.sum():
                centres[c] = (points * w[:, None]).sum(axis=0) / w.sum()
    return nearest


def _factors(weights: np.ndarray) -> np.ndarray:
    """Classes x rows: the weights' exponentials, the first template's with those of
    the class. The bound keeps a product of all within 32-bit numbers."""
    factors = np.exp(np.ascontiguousarray(np.clip(weights.T, -20, 20), dtype=np.float32))
    factors[:, :BUCKETS] *= factors[:, -1:]
    return factors


def _odds(rows: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes x tokens: what the softmax of the summed weights is in proportion to,
    and its sum over the classes."""
    odds, more = np.empty((CLASSES, rows.shape[1]), np.float32), np.empty(rows.shape[1], np.float32)
    for k, f in enumerate(factors):
        np.take(f, rows[0], out=odds[k], mode="clip")
        for r in rows[1:]:
            odds[k] *= np.take(f, r, out=more, mode="clip")
    return odds, odds.sum(axis=0)


def _list_features(classes: Classes):
    """The distinct features and classes of a task's tokens, some at a time, in order,
    as steps from the row's first, and how many tokens have them."""
    def rows(keys: np.ndarray) -> pa.RecordBatch:
        keys.sort()
        starts = _starts(keys)
        distinct, n = keys[starts], np.diff(np.append(starts, len(keys)))
        cuts = range(0, len(distinct), ROW_FEATURES)
        lists = [distinct[a:a + ROW_FEATURES] for a in cuts]
        return pa.RecordBatch.from_arrays([
            pa.array([int(x[0]) for x in lists], pa.int64()),
            pa.array([_planes(np.diff(x, prepend=x[0]), 2) for x in lists], pa.binary()),
            pa.array([_planes(n[a:a + ROW_FEATURES]) for a in cuts], pa.binary())], names=["low", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, n = [], 0
        for _, hashes, endings, first in _batches(_shingles.pieces(batches, PIECE_BYTES)):
            key = 0
            for t, r in enumerate(features(hashes, first)):
                key = key * BUCKETS + (r - t * BUCKETS)
            some.append(key * CLASSES + classes(hashes, endings))
            n += len(hashes)
            if n >= FEATURE_TOKENS:
                yield rows(np.concatenate(some))
                some, n = [], 0
        if n:
            yield rows(np.concatenate(some))
    return run


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(features, y, n)`` of each row of ``_list_features``: distinct features, first
    templates foremost, and classes, in order, and how many tokens have them."""
    for batch in batches:
        for low, keys, counts in zip(*(batch.column(c) for c in ("low", "keys", "counts"))):
            key = np.cumsum(_from_planes(keys.as_buffer())).astype(np.int64) + low.as_py()
            yield key // CLASSES, key % CLASSES, _from_planes(counts.as_buffer()).astype(np.int64)


def _split(key: np.ndarray) -> list[np.ndarray]:
    """The hashed feature of each template."""
    return [key // BUCKETS ** (TEMPLATES - 1 - t) % BUCKETS for t in range(TEMPLATES)]


def _observed_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of each feature and class, in the first of two planes."""
    seen = np.zeros((2, TEMPLATES * BUCKETS + 1, CLASSES))
    for key, y, n in _listed(batches):
        for t, r in enumerate(_split(key)):
            seen[0, t * BUCKETS:(t + 1) * BUCKETS] += np.bincount(
                r * CLASSES + y, weights=n, minlength=BUCKETS * CLASSES).reshape(BUCKETS, CLASSES)
        seen[0, -1] += np.bincount(y, weights=n, minlength=CLASSES)
    yield _as_rows(seen)


def _expected_counts(weights: np.ndarray):
    """Per feature and class the counts that the weights expect, in the second of two
    planes; the first has the classes' counts alone, what was read. They travel as 32-bit numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_n = TEMPLATES * BUCKETS + 1
        seen, expected = np.zeros((rows_n, CLASSES)), np.zeros((CLASSES, rows_n))
        factors = _factors(weights)
        for key, y, n in _listed(batches):
            seen[-1] += np.bincount(y, weights=n, minlength=CLASSES)
            starts = _starts(key)
            n, own = np.add.reduceat(n, starts), np.stack(_split(key[starts]))
            for a in range(0, len(n), SCORE_TOKENS):
                rows = own[:, a:a + SCORE_TOKENS]
                odds, whole = _odds(rows + BUCKETS * np.arange(TEMPLATES)[:, None], factors)
                times = n[a:a + SCORE_TOKENS] / whole.astype(np.float64)
                runs = _starts(rows[0])                     # the first template's are in order
                heads = rows[0][runs]
                for k, p in enumerate(odds):
                    p = p * times
                    expected[k, heads] += np.add.reduceat(p, runs)
                    for t in range(1, TEMPLATES):
                        expected[k, t * BUCKETS:(t + 1) * BUCKETS] += np.bincount(rows[t], weights=p, minlength=BUCKETS)
        expected[:, -1] = expected[:, :BUCKETS].sum(axis=1)
        yield _as_rows(np.stack([seen, expected.T]), "<f4")
    return run


def train(texts: DataFrame) -> tuple[DataFrame, dict]:
    """The token counts (``word, ending, c``) and the model of ``doc_id, text``
    rows; of the model, what reaches the driver has a fixed size."""
    counts = texts.select("text").mapInArrow(_count, "word long, ending long, c long").groupBy("word").agg(
        F.first("ending").alias("ending"), F.sum("c").alias("c"))
    counts = written(counts, "lm-counts")
    top = counts.orderBy(F.desc("c"), "word").limit(SINGLES).collect()
    singles = np.array([r["word"] for r in top], dtype=np.int64).view(np.uint64)
    whole = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v"),
                       F.sum((F.col("c") == 1).cast("long")).alias("once")).first()
    n, v, once = (int(x or 0) for x in whole)

    near = _summed(texts.select("text"), _neighbours(singles), (SUFFIXES, 2 * (SINGLES + 1)))
    classes = Classes(singles, cluster(near, CLASSES - SINGLES))
    common = F.col("word").isin([int(r["word"]) for r in top]) if top else F.lit(False)
    mass = np.zeros(CLASSES)
    for i, r in enumerate(top):
        mass[i] = r["c"]
    for r in counts.where(~common).groupBy("ending").agg(F.sum("c").alias("c")).collect():      # SUFFIXES rows
        mass[SINGLES + classes.of_ending[r["ending"]]] += r["c"]

    shape = (2, TEMPLATES * BUCKETS + 1, CLASSES)
    listed = texts.select("text").mapInArrow(_list_features(classes), "low long, keys binary, counts binary")
    listed = written(listed, "lm-features")
    seen = _summed(listed, _observed_counts, shape)[0]
    weights = _start(seen)
    for _ in range(ROUNDS - 1):
        expected = _summed(listed, _expected_counts(weights), shape, "<f4")[1]
        weights = _update(weights, seen, expected)
    return counts, {"classes": classes, "weights": weights.astype(np.float32), "mass": mass,
                    "n": n, "v": v, "unseen": (once + 0.5) / (n + 1) if n else 1.0}


def _start(seen: np.ndarray) -> np.ndarray:
    """Log ratios of each feature's class shares to the overall ones, smoothed, and
    divided among the templates; the last row is the log share of each class."""
    prior = (seen[-1] + 0.5) / (seen[-1] + 0.5).sum()
    shares = (seen[:-1] + 20 * prior) / (seen[:-1].sum(axis=1, keepdims=True) + 20)
    scale = np.repeat([0.5, 0.4, 0.3], BUCKETS)[:, None]
    return np.concatenate([scale * (np.log(shares) - np.log(prior)), np.log(prior)[None]])


def _update(weights: np.ndarray, seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """One gradient update: observed minus expected counts, scaled by what is
    expected; rarely seen features move little."""
    total = seen.sum(axis=1, keepdims=True)
    gradient = seen - expected
    scaled = STEP * gradient / (expected + 0.02 * total + 5.0)
    scaled[:-1] /= TEMPLATES
    return weights + np.clip(scaled, -1.0, 1.0)


def _keys(context: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A context of one template and the class after it, in one number."""
    return ((context >> np.uint64(64 - CONTEXT_BITS)) << np.uint64(CLASS_BITS)) | y.astype(np.uint64)


def _planes(values: np.ndarray, raw: int = 0) -> bytes:
    """Byte planes of whole numbers: how many the largest needs, the lowest ``raw`` as
    they are (hashes), the others compressed (few values, mostly small)."""
    width = max(-(-int(values.max(initial=0)).bit_length() // 8), raw, 1)
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width, raw]) + len(values).to_bytes(4, "little") + planes[:raw].tobytes() + _ZSTD.compress(
        planes[raw:].tobytes(), asbytes=True)


def _from_planes(data) -> np.ndarray:
    data = memoryview(data)
    width, raw, n = data[0], data[1], int.from_bytes(data[2:6], "little")
    out = np.zeros((n, 8), np.uint8)
    out[:, :raw] = np.frombuffer(data[6:6 + raw * n], np.uint8).reshape(raw, n).T
    out[:, raw:width] = np.frombuffer(_ZSTD.decompress(data[6 + raw * n:], (width - raw) * n), np.uint8).reshape(width - raw, n).T
    return out.view("<u8").reshape(-1)


def _token_keys(pieces: list[tuple], template: int) -> np.ndarray:
    """The key of each token of a block's pieces ``(hashes, y, first)``."""
    out, at = np.empty(sum(len(p[0]) for p in pieces), np.uint64), 0
    for hashes, y, first in pieces:
        out[at:at + len(hashes)] = _keys(contexts(hashes, first, [template])[0], y)
        at += len(hashes)
    return out


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate((np.ones(min(len(ordered), 1), bool), ordered[1:] != ordered[:-1])))


def _sorted_counts(keys: np.ndarray, training: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of a block's tokens, sorted, and how often each stands in
    training documents."""
    keys = (keys << np.uint64(1)) | training                # in the lowest bit, so that one sort does
    keys.sort()
    upto = np.concatenate(([0], np.cumsum(keys & np.uint64(1), dtype=np.int64)))
    keys >>= np.uint64(1)
    starts = _starts(keys)
    return keys[starts], np.diff(upto[np.append(starts, len(keys))])


def _sorted_words(hashes: np.ndarray, training: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same of words, whose hashes leave no bit free."""
    held = np.sort(hashes[~training])
    hashes = np.sort(hashes)
    starts, some = _starts(hashes), _starts(held)
    distinct, n = hashes[starts], np.diff(np.append(starts, len(hashes)))
    n[np.searchsorted(distinct, held[some])] -= np.diff(np.append(some, len(held)))
    return distinct, n


def _order(keys: np.ndarray, bits: int, tail: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a block's keys of so many bits stand in ascending order, equal ones in any,
    and the ordered keys. One number holds a key's upper bits, its lowest ``tail``
    (classes) and its place, so that a plain sort does; the few keys that differ in
    the bits between alone are put in order after it."""
    place = len(keys).bit_length()
    lost, tail, at = np.uint64(max(bits + place - 64, 0)), np.uint64(tail), np.uint64(place)
    packed = keys >> (tail + lost) << tail
    packed |= keys & ((np.uint64(1) << tail) - np.uint64(1))
    packed <<= at
    packed |= np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    order = (packed & ((np.uint64(1) << at) - np.uint64(1))).astype(np.int64)
    ordered = keys[order]
    wrong = np.flatnonzero(ordered[1:] < ordered[:-1])
    if len(wrong):
        packed >>= at + tail
        upper = np.unique(packed[wrong])
        for a, b in zip(np.searchsorted(packed, upper), np.searchsorted(packed, upper, "right")):
            order[a:b] = order[a:b][np.argsort(ordered[a:b])]
            ordered[a:b].sort()
    return order, ordered


def _list_keys(classes: Classes, shards: int):
    """Per template, words last, and shard that has any: the block's distinct keys, in
    order, as steps from the shard's least possible key, and their training counts."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        pieces, training = [], []
        for piece, hashes, endings, first in _batches(_shingles.pieces(iter(table.to_batches()), PIECE_BYTES)):
            pieces.append((hashes, classes(hashes, endings).astype(np.uint8), first))
            held = piece.column("held").to_numpy(zero_copy_only=False).astype(bool)
            training.append(np.repeat(~held, np.diff(first)))
        training = np.concatenate(training)
        shard, lists, counts = [], [], []
        for t in range(TEMPLATES + 1):
            if t < TEMPLATES:
                distinct, n = _sorted_counts(_token_keys(pieces, t), training)
                shift, raw = CONTEXT_BITS + CLASS_BITS - 32, 3
            else:
                distinct, n = _sorted_words(np.concatenate([p[0] for p in pieces]), training)
                shift, raw = 32, 5
            of = ((distinct >> np.uint64(shift)) * np.uint64(shards)) >> np.uint64(32)
            cuts = _starts(of)
            for a, b in zip(cuts, np.append(cuts[1:], len(distinct))):
                s = int(of[a])
                low = np.uint64(-(-(s << 32) // shards) << shift)
                shard.append(t * shards + s)
                lists.append(_planes(np.diff(distinct[a:b], prepend=low), raw))
                counts.append(_planes(n[a:b]))
        return pa.Table.from_arrays([pa.array([key[0].as_py()] * len(shard), pa.int64()), pa.array(shard, pa.int64()),
                                     pa.array(lists, pa.binary()), pa.array(counts, pa.binary())],
                                    names=["block", "shard", "keys", "counts"])
    return run


def strength(own: np.ndarray, whole: np.ndarray, prior: np.ndarray) -> float:
    """The likeliest of STRENGTHS for counts of (context, class), those of their
    contexts and the classes' shares, each token left out of its context."""
    own, whole, prior = own[own > 0], whole[own > 0], prior[own > 0]
    fit = [(own * np.log((own - 1 + a * prior) / (whole - 1 + a))).sum() for a in STRENGTHS]
    return float(STRENGTHS[len(fit) - 1 - int(np.argmax(fit[::-1]))])


def _sum_keys(shares: np.ndarray, shards: int):
    """Answers each list of a shard: training counts of its keys over all blocks and,
    unless they are words, those of their contexts, and the shard's strength."""
    def run(key: tuple[pa.Scalar, ...], lists: pa.Table) -> pa.Table:
        wanted = [np.cumsum(_from_planes(x.as_buffer()), dtype=np.uint64) for x in lists.column("keys")]
        n = np.concatenate([_from_planes(x.as_buffer()) for x in lists.column("counts")])
        distinct, at = np.unique(np.concatenate(wanted), return_inverse=True)
        own = np.bincount(at, weights=n.astype(np.float64), minlength=len(distinct)).astype(np.int64)
        ends = np.cumsum([len(x) for x in wanted])
        answers = [at[e - len(x):e] for x, e in zip(wanted, ends)]
        if key[0].as_py() < TEMPLATES * shards:
            _, of = np.unique(distinct >> np.uint64(CLASS_BITS), return_inverse=True)
            whole = np.bincount(of, weights=own).astype(np.int64)[of]
            prior = shares[(distinct & np.uint64((1 << CLASS_BITS) - 1)).astype(np.int64)]
            alpha, wholes = strength(own, whole, prior), [_planes(whole[x]) for x in answers]
        else:
            alpha, wholes = 0.0, [None] * len(answers)
        return pa.Table.from_arrays([
            lists.column("block"), lists.column("shard"), pa.array([_planes(own[x]) for x in answers], pa.binary()),
            pa.array(wholes, pa.binary()), pa.array([alpha] * len(answers), pa.float64())],
            names=["block", "shard", "own", "whole", "strength"])
    return run


def _answers(found: pa.Table, template: int, shards: int) -> tuple:
    """``own, whole, strength`` of a block's distinct keys of a template, in their
    order; words (the template after the last) have ``own`` alone."""
    mine = sorted((s, i) for i, s in enumerate(found.column("shard").to_pylist()) if s // shards == template)
    read = lambda c: [_from_planes(found.column(c)[i].as_buffer()) for _, i in mine]
    own = read("own")
    if template == TEMPLATES:
        return np.concatenate(own).astype(np.int64), None, None
    alpha = np.repeat([found.column("strength")[i].as_py() for _, i in mine], [len(x) for x in own])
    return np.concatenate(own).astype(np.float64), np.concatenate(read("whole")).astype(np.float64), alpha


def _score(model: dict, shards: int):
    classes, weights, mass = model["classes"], model["weights"], model["mass"]
    n, v, unseen = model["n"], model["v"], model["unseen"]
    factors = _factors(weights)

    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, found: pa.Table) -> pa.Table:
        pieces, ids, p = [], [], []
        for piece, hashes, endings, first in _batches(_shingles.pieces(iter(docs.to_batches()), PIECE_BYTES)):
            y = classes(hashes, endings)
            pieces.append((hashes, y.astype(np.uint8), first))
            ids.append(piece.column("doc_id"))
            of = features(hashes, first)
            for a in range(0, len(y), SCORE_TOKENS):
                odds, whole = _odds(of[:, a:a + SCORE_TOKENS], factors)
                p.append(odds[y[a:a + SCORE_TOKENS], np.arange(len(whole))] / whole)
            del of
        p = np.concatenate(p).astype(np.float64)
        for t in (2, 0, 1):                                 # skip, word before, two words before
            order, keys = _order(_token_keys(pieces, t), CONTEXT_BITS + CLASS_BITS, CLASS_BITS)
            sizes = np.diff(np.append(_starts(keys), len(keys)))
            del keys
            own, whole, alpha = _answers(found, t, shards)
            whole += alpha
            alpha /= whole
            own /= whole
            del whole
            mixed = p[order]
            mixed *= np.repeat(alpha, sizes)
            mixed += np.repeat(own, sizes)
            p[order] = mixed
            del order, mixed, own, alpha
        order, keys = _order(np.concatenate([hashes for hashes, _, _ in pieces]), 64, 0)
        sizes = np.diff(np.append(_starts(keys), len(keys)))
        del keys
        count = np.empty(len(order), np.int64)
        count[order] = np.repeat(_answers(found, TEMPLATES, shards)[0], sizes)
        del order
        out, done = [], 0
        log_mass = np.log(np.maximum(mass, 1e-300))
        for (hashes, y, first), doc_id in zip(pieces, ids):
            c = count[done:done + len(y)]
            base = np.log10((c + 1) / (n + v + 1))
            logs = np.log(np.maximum(p[done:done + len(y)], 1e-300))
            done += len(y)
            known = np.log1p(-unseen) + logs + np.log(np.maximum(c, 1)) - log_mass[y] if n else np.zeros(len(y))
            model_log = np.where(c > 0, known, np.log(unseen)) / np.log(10)
            begin = first[:-1]
            out.append(pa.Table.from_arrays([
                doc_id, pa.array(np.diff(first)), pa.array(np.add.reduceat((c > 0).astype(np.int64), begin)),
                pa.array(np.add.reduceat(base, begin)), pa.array(np.add.reduceat(model_log, begin))],
                names=["doc_id", "n_tokens", "n_known", "base_score", "score"]))
        return pa.concat_tables(out)
    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per
    document row: all rows are scored by a model of those that are not held out."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), as_text(F.col(text_col)).alias("text"))
    _, model = train(docs.where(~is_held_out(F.col("doc_id"))))
    size = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    n_blocks = -(-size // BLOCK_BYTES) or 1
    shards = -(-model["n"] // TOKENS_PER_SHARD) or 1
    shares = (model["mass"] + 0.5) / (model["mass"] + 0.5).sum()
    dealt = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).alias("block"), "doc_id", "text",
                        is_held_out(F.col("doc_id")).alias("held"))
    lists = dealt.groupBy("block").applyInArrow(_list_keys(model["classes"], shards),
                                                "block long, shard long, keys binary, counts binary")
    found = lists.groupBy("shard").applyInArrow(_sum_keys(shares, shards),
                                                "block long, shard long, own binary, whole binary, strength double")
    scored = dealt.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(
        _score(model, shards), "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
                         F.lit(model["n"]).cast("long").alias("train_tokens"), "base_score", "score")
