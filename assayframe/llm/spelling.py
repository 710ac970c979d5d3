"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

1. Words are counted over all documents by a hash aggregate with map-side combine.
2. Every word has a vector: how many of its letters fall into each of ``GROUPS`` letter
   groups (code point modulo ``GROUPS``; counts above 255 stand as 255). One inserted or
   deleted letter changes one count by one; a replaced letter takes one from a group and
   gives one to another, or changes none. So two words one edit apart have vectors with
   a surplus of one at most and a deficit of one at most.
3. The trie branches on successive counts. It is cut into blocks: the highest nodes that
   hold no more than a limit of words (``BLOCK_WORDS``, or the ``MAX_HEAVY``-th part of
   all words if that is more, so that there are at most ``MAX_HEAVY`` heavier nodes per
   level and the list of blocks, which goes to every task, stays small). A word lives in
   its own block and visits each later block that it can reach within the budget.
4. In a block, a depth-first search walks the trie of all its words' vectors together with the
   trie of the residents' vectors, pair of nodes by pair of nodes, and spends the budget;
   the pairs of leaves it arrives at are verified letter by letter. The search holds at
   most ``STATES`` pairs of nodes at a time. Leaves of many words are matched by half:
   words one edit apart agree in the first or in the second half of the shorter one.
   A leaf of more words than a block may hold is dealt into several blocks.
5. A word's form is its near word of largest count, if that is ``RATIO`` times its own at
   least; roots follow the forms by pointer jumping (counts grow on the way, so there is
   no circle and the number of rounds is the logarithm of a logarithm).

Defined results: a null text has no words, a null id stands as the empty text before the
colon; repeated rows count once each; an empty table gives no rows; columns other than the id and the
text are ignored.
"""

from __future__ import annotations

import bisect
import string
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.llm._common import as_text, written

LETTERS = "[A-Za-zÀ-ÿ]"   # every one of them is one byte in Latin-1
GROUPS = 16
MIN_LENGTH, MIN_COUNT, RATIO, THINNED = 5, 3, 2, 97
BLOCK_WORDS, MAX_HEAVY = 20_000, 4096
STATES = 1 << 20
LEAF_PAIRS = 256            # leaves with more pairs of words are matched by half
MATRIX_LETTERS = 64         # longer words are compared one pair at a time
ROUNDS = 64


# ------------------------------------------------------------------ words
def thinned(doc_id: Column, run: Column) -> Column:
    """The run without one code point, for the runs that their hash picks."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.length(run)).cast("int")
    rest = F.concat(F.left(run, at), F.substr(run, at + 2, F.length(run)))
    return F.when(F.pmod(h, F.lit(THINNED)) == 0, rest).otherwise(run)


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough."""
    runs = docs.select(F.col(id_col).alias("d"), F.explode(F.regexp_extract_all(
        as_text(F.col(text_col)), F.lit(f"({LETTERS}{{{min_length},}})"), 1)).alias("run"))
    lower = runs.select("d", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    words = lower.select(thinned(F.col("d"), F.col("run")).alias("word")).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def letter_counts(words: list[bytes]) -> np.ndarray:
    """One row of ``GROUPS`` counts per word (Latin-1 bytes)."""
    flat = np.frombuffer(b"".join(words), dtype=np.uint8)
    of = np.repeat(np.arange(len(words)), [len(w) for w in words])
    counts = np.bincount(of * GROUPS + flat % GROUPS, minlength=len(words) * GROUPS)
    return np.minimum(counts, 255).astype(np.uint8).reshape(len(words), GROUPS)


def _with_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            rows = letter_counts([w.encode("latin-1") for w in batch.column("word").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"), pa.array([r.tobytes() for r in rows], pa.binary())],
                names=["word", "n", "vec"])


# ------------------------------------------------------------------ the trie
class Trie:
    """Rows of counts, sorted and none a beginning of another, as one array of children
    per level: a child's key is its parent's number on the level above times 256 plus
    its count, so the children of a node are neighbours and keys are found by bisection."""

    def __init__(self, rows: np.ndarray, depth: np.ndarray):
        node, alive, self.levels = np.zeros(len(rows), np.int64), np.arange(len(rows)), []
        above = 1
        for j in range(rows.shape[1]):
            alive = alive[depth[alive] > j]
            if not len(alive):
                break
            keys, node[alive] = np.unique(node[alive] * 256 + rows[alive, j], return_inverse=True)
            leaf = np.full(len(keys), -1, dtype=np.int64)
            done = alive[depth[alive] == j + 1]
            leaf[node[done]] = done
            first = np.searchsorted(keys // 256, np.arange(above + 1))
            self.levels.append((keys, leaf, first))
            above = len(keys)


def near_rows(asking: Trie, answering: Trie) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows, one of each trie, within the budget: a surplus of one and a deficit
    of one over all levels."""
    zero = np.zeros(1, np.int64)
    stack = [(0, zero, zero, np.zeros(1, np.uint8))]     # level, node, node, budget spent (1: surplus, 2: deficit)
    while stack:
        j, a, b, spent = stack.pop()
        if len(a) > STATES:
            half = len(a) // 2
            stack += [(j, a[:half], b[:half], spent[:half]), (j, a[half:], b[half:], spent[half:])]
            continue
        keys, leaf, first = asking.levels[j]
        other, other_leaf, _ = answering.levels[j]
        n = first[a + 1] - first[a]
        child = np.repeat(first[a] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        value, b, spent = keys[child] % 256, np.repeat(b, n), np.repeat(spent, n)
        found = []
        for step, cost in ((0, 0), (1, 1), (-1, 2)):
            may = (spent & cost == 0) & (value + step >= 0) & (value + step < 256)
            key = (b * 256 + value + step)[may]
            at = np.minimum(np.searchsorted(other, key), len(other) - 1)
            hit = other[at] == key
            found.append((child[may][hit], at[hit], (spent[may] | cost)[hit]))
        a, b, spent = (np.concatenate(x) for x in zip(*found))
        at_leaf = other_leaf[b] >= 0
        if at_leaf.any():
            yield leaf[a[at_leaf]], other_leaf[b[at_leaf]]
            a, b, spent = a[~at_leaf], b[~at_leaf], spent[~at_leaf]
        if len(a):
            stack.append((j + 1, a, b, spent))


def reached_blocks(rows: np.ndarray, blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(row, block)``: the blocks each row of counts reaches within the budget, with
    their numbers in the sorted list ``blocks``."""
    top = np.zeros((len(blocks), GROUPS), dtype=np.uint8)
    for i, b in enumerate(blocks):
        top[i, :len(b)] = np.frombuffer(b, np.uint8)
    trie = Trie(top, np.array([len(b) for b in blocks]))
    row, node, spent, out = np.arange(len(rows)), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.uint8), []
    for j, (keys, leaf, _) in enumerate(trie.levels):
        found = []
        for step, cost in ((0, 0), (1, 1), (-1, 2)):
            value = rows[row, j].astype(np.int64) + step
            key = node * 256 + value
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = (spent & cost == 0) & (value >= 0) & (value < 256) & (keys[at] == key)
            found.append((row[hit], at[hit], (spent | cost)[hit]))
        row, node, spent = (np.concatenate(x) for x in zip(*found))
        done = leaf[node] >= 0
        out.append((row[done], leaf[node[done]]))
        row, node, spent = row[~done], node[~done], spent[~done]
    a, b = (np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 2
    pairs = np.unique(a * len(blocks) + b)      # a block may be reached by several ways of spending
    return pairs // len(blocks), pairs % len(blocks)


def home_blocks(rows: np.ndarray, blocks: list[bytes]) -> np.ndarray:
    """The number of the block that each row of counts begins with."""
    return np.array([bisect.bisect_right(blocks, r.tobytes()) - 1 for r in rows], dtype=np.int64)


# ------------------------------------------------------------------ verification
def one_edit(a: bytes, b: bytes) -> bool:
    """Whether one inserted, deleted or replaced letter makes ``a`` into ``b``."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p:] == b[p + 1:] if len(a) < len(b) else a[p + 1:] == b[p + 1:]


class Words:
    """Words of a block, with their letters as a matrix for those that are not long."""

    def __init__(self, words: list[bytes]):
        self.words, self.length = words, np.array([len(w) for w in words], dtype=np.int64)
        kept = np.minimum(self.length, MATRIX_LETTERS)
        flat = np.frombuffer(b"".join(w[:MATRIX_LETTERS] for w in words), np.uint8)
        self.letters = np.zeros((len(words), MATRIX_LETTERS + 1), dtype=np.uint8)
        self.letters[np.arange(MATRIX_LETTERS + 1) < kept[:, None]] = flat

    def one_edit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The same as the function, for arrays of word numbers."""
        swap = self.length[a] > self.length[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        grown = self.length[b] - self.length[a]
        ok = (grown <= 1) & (a != b)
        long = self.length[b] > MATRIX_LETTERS
        for i in np.flatnonzero(ok & long):
            ok[i] = one_edit(self.words[a[i]], self.words[b[i]])
        rest = np.flatnonzero(ok & ~long)
        x, y = self.letters[a[rest]], self.letters[b[rest]]
        differ = x != y
        first = differ.argmax(axis=1)
        shifted = (x[:, :-1] != y[:, 1:]) & (np.arange(MATRIX_LETTERS) >= first[:, None])
        ok[rest] = np.where(grown[rest] == 1, ~shifted.any(axis=1), differ.sum(axis=1) == 1)
        return ok

    def by_half(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of two leaves that agree in the first or in the second half of the
        shorter word."""
        out = set()
        halves = defaultdict(list)
        for j in b.tolist():
            w = self.words[j]
            for n in {len(w) - 1, len(w)}:      # the length of a shorter word, or one as long
                halves[n, len(w), 0, w[:n // 2]].append(j)
                halves[n, len(w), 1, w[len(w) - (n - n // 2):]].append(j)
        for i in a.tolist():
            w = self.words[i]
            for m in (len(w) - 1, len(w), len(w) + 1):
                n = min(m, len(w))
                for side, part in ((0, w[:n // 2]), (1, w[len(w) - (n - n // 2):])):
                    out.update((i, j) for j in halves.get((n, m, side, part), ()))
        pairs = np.array(sorted(out), dtype=np.int64).reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1]


def near_pairs(words: list[bytes], rows: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of word numbers one edit apart, the second a resident of the block; two
    residents make one pair."""
    if not home.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    text, out = Words(words), []
    sides = []
    for members in (np.arange(len(words)), np.flatnonzero(home)):
        distinct, of = np.unique(rows[members], axis=0, return_inverse=True)
        order = np.argsort(of.reshape(-1), kind="stable")
        first = np.searchsorted(of.reshape(-1)[order], np.arange(len(distinct) + 1))
        sides.append((Trie(distinct, np.full(len(distinct), GROUPS)), members[order], first))
    (asking, a_words, a_first), (answering, b_words, b_first) = sides
    for a, b in near_rows(asking, answering):
        n_a, n_b = a_first[a + 1] - a_first[a], b_first[b + 1] - b_first[b]
        big = n_a * n_b > LEAF_PAIRS
        parts = [text.by_half(a_words[a_first[i]:a_first[i + 1]], b_words[b_first[j]:b_first[j + 1]])
                 for i, j in zip(a[big], b[big])]
        a, b, n_a, n_b = a[~big], b[~big], n_a[~big], n_b[~big]
        edges = [0, *(np.flatnonzero(np.diff(np.cumsum(n_a * n_b) // STATES)) + 1).tolist(), len(a)]
        for lo, hi in zip(edges, edges[1:]):
            n = (n_a * n_b)[lo:hi]
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            width = np.repeat(n_b[lo:hi], n)
            parts.append((a_words[np.repeat(a_first[a[lo:hi]], n) + at // np.maximum(width, 1)],
                          b_words[np.repeat(b_first[b[lo:hi]], n) + at % np.maximum(width, 1)]))
        for x, y in parts:
            wanted = ~home[x] | (x < y)
            x, y = x[wanted], y[wanted]
            good = text.one_edit(x, y)
            out.append((x[good], y[good]))
    a, b = (np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 2
    return a, b


# ------------------------------------------------------------------ Spark
def _blocks(vectors: DataFrame, n_words: int) -> tuple[list[bytes], list[int]]:
    """The blocks in order, and in how many parts each is dealt (one, but for leaves
    above the limit)."""
    limit = max(BLOCK_WORDS, -(-n_words // MAX_HEAVY))
    leaves = vectors.groupBy("vec").agg(F.count("*").alias("n"))
    levels = F.explode(F.sequence(F.lit(1), F.lit(GROUPS)))
    nodes = written(leaves.select("vec", "n", levels.alias("j")).select(F.expr("substring(vec, 1, j)").alias("node"), "n")
                    .groupBy("node").agg(F.sum("n").alias("n")), "trie-nodes")
    heavy = nodes.where(F.col("n") > limit)
    leaf = F.octet_length("node") == GROUPS
    parent = F.expr("substring(node, 1, octet_length(node) - 1)")
    ends = nodes.where((F.col("n") <= limit) | leaf).select("node", "n", parent.alias("up"))
    below = ends.join(heavy.select(F.col("node").alias("up")), "up", "left_semi").unionByName(ends.where(F.octet_length("up") == 0))
    found = sorted((bytes(r["node"]), -(-r["n"] // limit)) for r in below.select("node", "n").collect())
    return [b for b, _ in found], [n for _, n in found]


def _dealer(blocks: list[bytes], parts: list[int]):
    """A row per block that a word lives in or visits. Blocks of several parts: a resident
    lives in one, and visits the later ones; visitors go to all."""
    schema = pa.schema([("block", pa.int64()), ("home", pa.bool_()), ("word", pa.string()), ("n", pa.int64()), ("vec", pa.binary())])
    first = np.concatenate(([0], np.cumsum(parts)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.frombuffer(b"".join(batch.column("vec").to_pylist()), np.uint8).reshape(-1, GROUPS)
            own = home_blocks(rows, blocks)
            share = np.array(batch.column("share")) % np.array(parts)[own]
            row, block = reached_blocks(rows, blocks)
            later = block >= own[row]
            row, block = row[later], block[later]
            low = first[block] + np.where(block == own[row], share[row], 0)
            n = first[block + 1] - low
            number = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            row = np.repeat(row, n)
            home = number == (first[own] + share)[row]
            pick = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(number), pa.array(home), *(batch.column(c).take(pick) for c in ("word", "n", "vec"))], schema=schema)
    return run


def _search(group: pa.Table) -> pa.Table:
    words = [w.encode("latin-1") for w in group.column("word").to_pylist()]
    rows = np.frombuffer(b"".join(group.column("vec").to_pylist()), np.uint8).reshape(-1, GROUPS)
    a, b = near_pairs(words, rows, np.array(group.column("home")))
    pick = lambda name, at: group.column(name).take(pa.array(at))
    return pa.table({"a": pick("word", a), "a_n": pick("n", a), "b": pick("word", b), "b_n": pick("n", b)})


def near_words(words: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n``: the pairs of ``words`` (columns ``word, n``) one edit apart,
    each once. Words may hold letters of ``LETTERS`` only."""
    known = written(words.select("word", "n").mapInArrow(_with_vectors, "word string, n long, vec binary"), "words")
    n_words = known.count()
    blocks, parts = _blocks(known, n_words) if n_words else ([b"\0"], [1])
    keyed = known.withColumn("share", F.xxhash64("word").bitwiseAND(F.lit((1 << 62) - 1)))
    dealt = keyed.mapInArrow(_dealer(blocks, parts), "block long, home boolean, word string, n long, vec binary")
    return dealt.groupBy("block").applyInArrow(_search, "a string, a_n long, b string, b_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form`` (both never null)."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(ROUNDS):
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = written(now.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")
    raise RuntimeError("the forms run in a circle")


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for a table ``word, n``."""
    pairs = near_words(words)
    both = pairs.select(F.inline(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))))
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    large = -F.col("best.less") >= ratio * F.col("n")
    found = written(words.select("word", "n").join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(large, F.col("best.near")).alias("form"), F.when(large, -F.col("best.less")).alias("form_n")), "forms")
    roots = _roots(found.where("form is not null"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same for the words of documents."""
    return group_variants(written(count_words(docs, id_col, text_col), "word-counts"))
