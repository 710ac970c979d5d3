"""Phrase collocations: counts of word sequences by a multikey three-way quicksort of
suffix pointers, and the phrases whose words stand together more often than by chance.

1. Texts are cut into pieces and words. Every word starts a suffix of up to ``max_words``
   words of its piece. Equal suffixes of one stretch of text (``RUN_WORDS`` words) are
   added up first; a row then holds a leading word with all its tails and their counts.
2. Rows are routed by language and leading word, over all documents, into buckets of
   about ``BUCKET_BYTES``. Leading words whose tails are larger than that (one word may
   start a third of all suffixes) are routed by all their words instead: each tail
   goes to one bucket, and the counts of their shorter phrases are added up afterwards.
3. In a bucket, pointers to the suffixes are partitioned by their word at the current
   depth into smaller, equal and larger than a pivot, all partitions of a pass at once.
   The weight of an equal partition is the count of the phrase down to that depth, and
   it goes on with the next word. A partition of any kind whose weight is below the
   least count is abandoned: nothing frequent can come of it.
4. A candidate's parts are at least as frequent as itself, so their counts are in the
   same table; they are joined, scored in whole numbers, and the best kept per language.

Exact: words are compared as bytes, counts are whole numbers, and products are 38-digit
decimals (counts up to 10 ** 15).

Defined results: a null text is empty, a null language is ``und``; ids are not looked at,
so repeated rows and null ids count like any other; an empty table gives no rows; columns
other than the text and the language are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayframe.llm import _shingles
from assayframe.llm._common import as_text, written
from assayframe.session import scratch_path

MIN_COUNT, MAX_WORDS, BEST, SCALE, CONTAINED = 10, 3, 2000, 1_000_000, 50
RUN_WORDS = 1 << 20
BUCKET_BYTES = 4 << 20
SUFFIXES = "lang string, word string, tails binary, counts binary, n long"

# ------------------------------------------------------------------ words and pieces
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP, _END = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_END[[*b".,;:!?", 10, 11, 12, 13]] = True
_GAP[[9, 32]] = True
_GAP |= _END


def _strings(data: np.ndarray, length: np.ndarray) -> pa.Array:
    """Byte strings that stand one after another in ``data``."""
    offsets = np.concatenate(([0], np.cumsum(length)))
    return pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])


def _tails(words: pa.Array, ids: np.ndarray, joined: np.ndarray, n: int, group: np.ndarray, depth: int):
    """The distinct suffixes of the first ``n`` words: their leading words (group times the
    number of words, plus the word), where each one's begin, the words that follow (0:
    none, else 1 + word) and the counts. ``joined[i]``: word i + 1 goes on the piece of word i."""
    follow = []
    alive = np.ones(n, dtype=bool)
    for k in range(1, depth):
        alive = alive & joined[k - 1:k - 1 + n]
        follow.append(np.where(alive, ids[k:k + n] + 1, 0))
    lead, of = np.unique(group[:n] * len(words) + ids[:n], return_inverse=True)
    if depth <= 3:      # the codes of a run fit in 21 bits each: one number holds a suffix
        key = of.astype(np.int64)
        for f in follow:
            key = (key << 21) | f
        key, counts = np.unique(key, return_counts=True)
        rows = [(key >> 21 * (depth - 2 - k)) & ((1 << 21) - 1) for k in range(depth - 1)]
        lead_of = key >> 21 * (depth - 1)
    else:
        order = np.lexsort([*follow[::-1], of])
        columns = [x[order] for x in (of, *follow)]
        at = np.flatnonzero(np.concatenate(([True], np.any([c[1:] != c[:-1] for c in columns], axis=0))))
        counts = np.diff(np.append(at, n))
        lead_of, *rows = [c[at] for c in columns]
    return lead, np.searchsorted(lead_of, np.arange(len(lead) + 1)), rows, counts


def _joined(parts: list[pa.Array], by: bytes = b" ") -> pa.Array:
    return pc.binary_join_element_wise(*parts, pa.scalar(by, pa.large_binary()))


def _lines(rows: pa.Array, first: np.ndarray) -> pa.Array:
    """The rows from each entry of ``first`` to the next one as one byte string, a line
    end after each."""
    ended = _joined([rows, pa.scalar(b"", pa.large_binary())], b"\n")
    offsets = np.frombuffer(ended.buffers()[1], np.int64)[first]
    return pa.Array.from_buffers(pa.large_binary(), len(first) - 1, [None, pa.py_buffer(offsets.tobytes()), ended.buffers()[2]]).cast(pa.binary())


def _suffixes(depth: int):
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("tails", pa.binary()), ("counts", pa.binary()), ("n", pa.int64()), ("opens", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _shingles.pieces(batches, RUN_WORDS * 6):
            flat, begins = _shingles.text_bytes(batch.column("text"))
            if not len(flat):
                continue
            start, end = _shingles._word_edges(flat, begins, _GAP)
            if not len(start):
                continue
            text = np.searchsorted(begins, start, side="right") - 1
            ends = np.cumsum(_END[flat])
            # Word i + 1 goes on the piece of word i: one text, and no mark between them.
            joined = np.concatenate(((text[1:] == text[:-1]) & (ends[start[1:]] == ends[end[:-1] - 1]), [False] * depth))
            langs = batch.column("lang").dictionary_encode()
            group = langs.indices.to_numpy(zero_copy_only=False)[text].astype(np.int64)
            flat = _LOWER[flat]
            for a in range(0, len(start), RUN_WORDS):
                b = min(a + RUN_WORDS, len(start))
                seen = slice(a, min(b + depth - 1, len(start)))
                part = flat[start[a]:end[seen.stop - 1]]
                coded = _strings(part[~_GAP[part]], (end - start)[seen]).dictionary_encode()
                words, ids = coded.dictionary, np.append(coded.indices.to_numpy().astype(np.int64), [0] * depth)
                lead, first, rows, counts = _tails(words, ids, joined[a:b + depth], b - a, group[a:b], depth)
                named = pa.concat_arrays([pa.array([b""], pa.large_binary()), words])
                tails = _lines(_joined([named.take(pa.array(r)) for r in rows]), first)
                packed = counts.astype("<u4")
                yield pa.RecordBatch.from_arrays([
                    langs.dictionary.take(pa.array(lead // len(words))),
                    words.take(pa.array(lead % len(words))).cast(pa.large_string()).cast(pa.string()),
                    tails,
                    pa.Array.from_buffers(pa.binary(), len(lead), [
                        None, pa.py_buffer((4 * first).astype("<i4").tobytes()), pa.py_buffer(packed.tobytes())]),
                    pa.array(np.add.reduceat(counts, first[:-1])),
                    pa.array((np.arange(len(lead)) == 0).astype(np.int32))], schema=schema)
    return run


def _parse(tails: Sequence[bytes], width: int) -> tuple[np.ndarray, list[np.ndarray], pa.Array]:
    """How many tails each row holds, the numbers of their words by place (negative:
    none), and the words by number."""
    flat = np.frombuffer(b"".join(tails), dtype=np.uint8)
    between = (flat == 10) | (flat == 32)
    n = np.array([t.count(b"\n") for t in tails], dtype=np.int64)
    codes, words = _codes(_strings(flat[~between], np.diff(np.flatnonzero(between), prepend=-1) - 1))
    return n, [codes[k::width] for k in range(width)], words


# ------------------------------------------------------------------ the sort
def multikey_counts(keys: list[np.ndarray], weights: np.ndarray, least: Sequence[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(depth, pointers, counts)``: a pointer to one suffix of each equal partition of
    depth + 1 words whose weight is ``least[depth]`` or more.

    ``keys[d]`` has the word of every suffix at depth d; negative: the suffix is shorter.
    A pass splits each open partition into three, about a pivot of its own."""
    table, floor = np.stack(keys), np.asarray(least)
    pointers, depth, first = np.arange(len(weights)), np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(pointers):
        size = np.diff(np.append(first, len(pointers)))
        kept = np.add.reduceat(weights[pointers], first) >= floor[depth]        # the others are abandoned
        pointers, size, depth = pointers[np.repeat(kept, size)], size[kept], depth[kept]
        if not len(pointers):
            return
        first = np.cumsum(size) - size
        of = np.repeat(np.arange(len(size)), size)
        word = table[depth[of], pointers]
        pivot = np.sort(np.stack([word[first], word[first + size // 2], word[first + size - 1]]), axis=0)[1]
        side = np.sign(word - pivot[of]) + 1
        n = np.bincount(3 * of + side, minlength=3 * len(size))
        begin = np.cumsum(n) - n
        # A pointer's new place: its rank among those of its side in its partition.
        place = np.empty_like(pointers)
        for s in range(3):
            mine = np.flatnonzero(side == s)
            group = 3 * of[mine] + s
            place[mine] = np.arange(len(mine)) - (np.cumsum(n[s::3]) - n[s::3])[of[mine]] + begin[group]
        moved = np.empty_like(pointers)
        moved[place] = pointers
        run = np.concatenate(([0], np.cumsum(weights[moved])))
        equal = (run[begin + n] - run[begin])[1::3]
        for d in np.unique(depth):
            found = np.flatnonzero((depth == d) & (equal >= floor[d]))
            if len(found):
                yield int(d), moved[begin[3 * found + 1]], equal[found]
        # Equal partitions go on with the next word, without the suffixes that end there.
        depth = np.stack([depth, depth + 1, depth], axis=1).reshape(-1)
        part = np.repeat(np.arange(len(n)), n)
        goes_on = depth[part] < len(keys)
        goes_on[goes_on] = table[depth[part[goes_on]], moved[goes_on]] >= 0
        pointers, part = moved[goes_on], part[goes_on]
        first = np.flatnonzero(np.diff(part, prepend=-1))
        depth = depth[part[first]]


def _codes(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Numbers of the words, negative for empty ones, and the words by number."""
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy().copy()
    empty = pc.index(coded.dictionary, b"").as_py()
    if empty >= 0:
        codes[codes == empty] = -1
    return codes, coded.dictionary


def _bucket_counts(depth: int, min_count: int):
    """Phrases of one bucket with their counts; those of leading words that were dealt
    over several buckets have partial counts, but for the longest phrases."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("k", pa.int32()), ("c", pa.int64())])

    def run(group: pa.Table) -> pa.Table:
        out = []
        for dealt in (False, True):
            rows = group.filter(pc.equal(group.column("dealt"), dealt)).combine_chunks()
            if not rows.num_rows:
                continue
            n, places, words = _parse(rows.column("tails").to_pylist(), depth - 1)
            weights = np.frombuffer(b"".join(rows.column("counts").to_pylist()), "<u4").astype(np.int64)
            of = np.repeat(np.arange(len(n)), n)
            lang, word = (rows.column(c).cast(pa.large_binary()).combine_chunks() for c in ("lang", "word"))
            lead, _ = _codes(_joined([lang, word]))
            least = [1] * (depth - 1) + [min_count] if dealt else [min_count] * depth
            for d, at, counts in multikey_counts([lead[of], *places], weights, least):
                phrase = [word.take(pa.array(of[at])), *[words.take(pa.array(c[at])) for c in places[:d]]]
                joined = _joined(phrase)
                out.append(pa.table([lang.take(pa.array(of[at])).cast(pa.large_string()).cast(pa.string()),
                                     joined.cast(pa.large_string()).cast(pa.string()),
                                     pa.array(np.full(len(at), d + 1, dtype=np.int32)), pa.array(counts)], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()
    return run


# ------------------------------------------------------------------ Spark
def _deal(depth: int):
    """The tails of a leading word in ``parts`` rows, each tail in the one its words
    choose."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("tails", pa.binary()), ("counts", pa.binary()), ("part", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tails, counts = row["tails"].splitlines(keepends=True), np.frombuffer(row["counts"], "<u4")
                part = np.array([crc32(t) % row["parts"] for t in tails])
                for p in np.unique(part).tolist():
                    mine = np.flatnonzero(part == p)
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (
                        row["lang"], row["word"], b"".join([tails[i] for i in mine]), counts[mine].tobytes(), p)))], schema=schema)
    return run


def phrase_counts(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, text_col: str = "text",
                  lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, k, c`` (phrases of ``k`` words, up to ``max_words``, that occur
    ``c`` times, ``min_count`` at least), and ``lang, n`` (all words)."""
    if max_words < 2:
        raise ValueError("phrases have two words or more")
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), as_text(F.col(text_col)).alias("text"))
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "suffixes")
    rows.mapInArrow(_suffixes(max_words), SUFFIXES + ", opens int").write.option("compression", "zstd").parquet(path)
    suffixes = spark.read.schema(SUFFIXES + ", opens int").parquet(path)
    size = (F.octet_length("tails") + F.octet_length("counts")).cast("long")
    totals = written(suffixes.groupBy("lang").agg(F.sum("n").alias("n"), F.sum(size).alias("bytes"), F.sum("opens").alias("runs")), "words")
    whole = totals.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.coalesce(F.sum("runs"), F.lit(0)).alias("runs")).first()
    buckets = max(1, -(-whole["bytes"] // BUCKET_BYTES))
    # A leading word has one row per run at most. Rows left out here are smaller than
    # half a bucket together, so every word above a bucket is found.
    some = suffixes.where(size * (2 * max(1, whole["runs"])) >= BUCKET_BYTES)
    hot = written(some.groupBy("lang", "word").agg(F.sum(size).alias("bytes")).where(F.col("bytes") * 2 > BUCKET_BYTES).select(
        "lang", "word", F.ceil(F.col("bytes") * 2 / BUCKET_BYTES).cast("long").alias("parts")), "hot-words")
    marked = suffixes.select("lang", "word", "tails", "counts").join(hot, ["lang", "word"], "left")
    columns = ["lang", "word", "tails", "counts", "part"]
    plain = marked.where("parts is null").withColumn("part", F.lit(-1).cast("long")).select(columns)
    dealt = marked.where("parts is not null").mapInArrow(_deal(max_words), "lang string, word string, tails binary, counts binary, part long")
    routed = plain.unionByName(dealt).select("*", (F.col("part") >= 0).alias("dealt"),
                                             F.pmod(F.xxhash64("lang", "word", "part"), F.lit(buckets)).alias("bucket"))
    found = routed.groupBy("bucket").applyInArrow(_bucket_counts(max_words, min_count), "lang string, phrase string, k int, c long")
    added = found.groupBy("lang", "phrase", "k").agg(F.sum("c").alias("c")).where(F.col("c") >= min_count)
    return written(added, "phrase-counts"), totals.select("lang", "n")


def exact_score(a: Column, part: Column, rest: Column, scale: int = SCALE) -> Column:
    """``floor(scale * a * a / (part * rest))`` in whole numbers."""
    whole = lambda c: c.cast("decimal(15,0)")
    return F.call_function("div", F.lit(scale) * (whole(a) * whole(a)), whole(part) * whole(rest))


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, best: int = BEST,
                 contained: int = CONTAINED, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``best`` phrases of each language. A
    phrase inside a longer candidate that occurs ``contained`` percent as often, or
    more, is dropped."""
    counts, totals = phrase_counts(docs, max_words, min_count, text_col, lang_col)
    candidates = counts.where("k > 1").select("lang", "phrase", "k", F.col("c").alias("a"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut", F.expr("substring_index(phrase, ' ', cut)").alias("head"),
        F.expr("substring_index(phrase, ' ', cut - k)").alias("rest"))
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("c").alias("l"))
    rests = counts.select("lang", F.col("phrase").alias("rest"), F.col("c").alias("r"))
    scored = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).select(
        "lang", "phrase", "a", F.struct(exact_score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "cut", "l", "r").alias("cut"))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min("cut").alias("cut"))

    words = F.split("phrase", " ")
    spans = F.expr("flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), i -> struct(i as i, m as m))))")
    inner = (candidates.where("k > 2").select("lang", "a", words.alias("words"), F.explode(spans).alias("s"))
             .select("lang", "a", F.array_join(F.slice("words", F.col("s.i"), F.col("s.m")), " ").alias("phrase")))
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = lowest.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < contained * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = (kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
              .withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= best))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
