"""MinHash near-dedup: SuperMinHash signatures, banding, verification, grouping.

1. Each document's set of word shingles gets a digest, a signature and band hashes.
   Documents with equal sets form one class; everything below works on classes.
2. Classes that share a band hash form a bucket. In a bucket of up to
   ``SMALL_BUCKET`` classes all pairs are candidates. In a larger one each class is
   first paired with the bucket's hub alone (the class that shares its buckets with
   most others, which for a crowd of near copies is their common origin).
3. Candidates whose signatures and set sizes allow the similarity are verified on
   the full sets; verified links give components.
4. In large buckets, a class that is not in the hub's component may still be
   similar to any other class of the bucket, so it is compared with all of them
   that are in another component, in blocks: signatures first, then full sets. One
   link per component is enough. No candidate is dropped and no bucket is capped.
5. The components of all links give the groups.

With the default 16 bands of 4 rows, a pair at similarity 0.85 shares no band with
probability below 1e-5. Links are exact: intersections of the full sets.

Defined results: a null text is empty; a document without words has the empty set,
is linked with nothing and is its own component; equal documents have a link each;
the component of rows with a null id is the least id that is not null, if any.
Rows with one id and different texts are different documents. Columns other than
the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.llm import _shingles, superminhash
from assayframe.llm._common import as_text, written
from assayframe.llm.components import components

BANDS, ROWS = 16, 4
SMALL_BUCKET = 16
BLOCK = 4000                # classes of a large bucket compared with one another at a time
SLACK = 0.2                 # signatures this far below the threshold are ruled out (4 to 5 sd)


def _profile(k: int):
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("n_shingles", pa.int64()), ("cls", pa.binary()),
                        ("bands", pa.list_(pa.int64())), ("sig", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _shingles.pieces(batches):
            sets = list(_shingles.sets(batch.column("text"), k))
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            bounds = np.concatenate(([0], np.cumsum(sizes)))
            sig = superminhash.signatures(np.concatenate(sets), bounds, BANDS * ROWS)
            bands = superminhash.band_hashes(sig, ROWS)
            empty = sizes == 0
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("fp"), pa.array(sizes),
                pa.array([None if e else _shingles.digest(s) for e, s in zip(empty, sets)], pa.binary()),
                pa.ListArray.from_arrays(np.arange(0, bands.size + 1, BANDS, dtype=np.int32), bands.reshape(-1)),
                pa.array([s.tobytes() for s in sig], pa.binary()),
            ], schema=schema)
    return run


def _sets_of(k: int):
    schema = pa.schema([("cls", pa.binary()), ("items", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _shingles.pieces(batches):
            sets = list(_shingles.sets(batch.column("text"), k))
            yield pa.RecordBatch.from_arrays([pa.array([_shingles.digest(s) for s in sets], pa.binary()),
                                              pa.array([s.tobytes() for s in sets], pa.binary())], schema=schema)
    return run


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct values."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = _common(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verify(percent: int):
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x"), batch.column("y")
            keep = [_similar(np.frombuffer(x[i].as_buffer(), "<u8"), np.frombuffer(y[i].as_buffer(), "<u8"), percent)
                    for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(pa.array(keep, pa.bool_())), batch.column("b").filter(pa.array(keep, pa.bool_()))],
                schema=schema)
    return run


def _agreement(min_equal: int):
    """Keep the pairs whose signatures agree in at least ``min_equal`` positions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.frombuffer(b"".join(batch.column("sx").to_pylist()), "<u4").reshape(batch.num_rows, -1)
            y = np.frombuffer(b"".join(batch.column("sy").to_pylist()), "<u4").reshape(batch.num_rows, -1)
            keep = pa.array((x == y).sum(axis=1) >= min_equal)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)],
                                             names=["a", "b"])
    return run


def _compare_blocks(percent: int, min_equal: int):
    """Links between the askers and the other classes of one block of a bucket that
    are in other components: one per asker and component."""
    def run(key, pdf):
        sig = np.frombuffer(b"".join(pdf["sig"]), "<u4").reshape(len(pdf), -1)
        sets = [np.frombuffer(x, "<u8") for x in pdf["items"]]
        _, label = np.unique(pdf["label"].to_numpy(), return_inverse=True)
        asks, answers = np.flatnonzero(pdf["asks"].to_numpy()), np.flatnonzero(~pdf["asks"].to_numpy())
        cls, out = pdf["cls"].to_numpy(), []
        for q in asks:
            close = answers[((sig[answers] == sig[q]).sum(axis=1) >= min_equal) & (label[answers] != label[q])]
            found = set()
            for c in close:
                if label[c] not in found and _similar(sets[q], sets[c], percent):
                    found.add(label[c])
                    out.append((cls[q], cls[c]))
        import pandas as pd
        return pd.DataFrame(out, columns=["a", "b"])
    return run


def _pairs_in_small(members: DataFrame, limit: int) -> DataFrame:
    x, y = members.where(F.col("size") <= limit).alias("x"), members.where(F.col("size") <= limit).alias("y")
    same = (F.col("x.band") == F.col("y.band")) & (F.col("x.h") == F.col("y.h"))
    return x.join(y, same & (F.col("x.cls") < F.col("y.cls"))).select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b"))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, fp, n_shingles, component_id, kept`` per document row (``fp`` is a
    hash of the text). Documents are linked when their sets of ``shingle``-word shingles have
    100 * intersection >= ``percent`` * union."""
    text = as_text(F.col(text_col))
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("fp"), text.alias("text"))
    profile = written(docs.mapInArrow(
        _profile(shingle), "doc_id long, fp long, n_shingles long, cls binary, bands array<long>, sig binary"), "profiles")
    firsts = profile.where("cls is not null").groupBy("cls").agg(
        F.min("doc_id").alias("least_id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"),
        F.first("sig").alias("sig"))
    classes = written(firsts, "classes")

    banded = classes.select("cls", F.posexplode("bands").alias("band", "h"))
    buckets = banded.groupBy("band", "h").agg(F.count("*").alias("size")).where("size > 1")
    members = written(banded.join(buckets, ["band", "h"]), "buckets")
    company = members.groupBy("cls").agg(F.sum("size").alias("company"))
    large = members.where(F.col("size") > SMALL_BUCKET).join(company, "cls")
    hubs = large.groupBy("band", "h").agg(F.max(F.struct("company", "cls")).alias("top")).select(
        "band", "h", F.col("top.cls").alias("hub"))
    large = written(large.join(hubs, ["band", "h"]).select("band", "h", "cls", "hub", "size"), "large-buckets")
    pairs = _pairs_in_small(members, SMALL_BUCKET).unionByName(
        large.where("cls != hub").select(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b"))).distinct()

    min_equal = int((percent / 100 - SLACK) * BANDS * ROWS)
    signed = (pairs.join(classes.select(F.col("cls").alias("a"), F.col("sig").alias("sx"), F.col("n").alias("nx")), "a")
              .join(classes.select(F.col("cls").alias("b"), F.col("sig").alias("sy"), F.col("n").alias("ny")), "b")
              .where(100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny")).select("a", "b", "sx", "sy"))
    likely = written(signed.mapInArrow(_agreement(min_equal), "a binary, b binary"), "likely-pairs")

    wanted = (likely.select(F.col("a").alias("cls")).unionByName(likely.select(F.col("b").alias("cls")))
              .unionByName(large.select("cls")).distinct().join(classes.select("cls", "least_id"), "cls"))
    texts = docs.join(wanted.select("least_id").distinct(), docs["doc_id"].eqNullSafe(F.col("least_id")), "left_semi")
    sets = written(texts.select("text").mapInArrow(_sets_of(shingle), "cls binary, items binary")
                   .join(wanted.select("cls"), "cls", "left_semi").dropDuplicates(["cls"]), "sets")
    both = (likely.join(sets.select(F.col("cls").alias("a"), F.col("items").alias("x")), "a")
            .join(sets.select(F.col("cls").alias("b"), F.col("items").alias("y")), "b"))
    links = written(both.select("a", "b", "x", "y").mapInArrow(_verify(percent), "a binary, b binary"), "verified")

    more = _between_components(large, components(links), classes, sets, percent, min_equal)
    links = links.unionByName(more)
    groups = components(links).select(F.col("a").alias("cls"), F.col("b").alias("root"))
    rooted = classes.select("cls", "least_id").join(groups, "cls", "left").select(
        "cls", "least_id", F.coalesce("root", "cls").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(least, "root").select("cls", "component_id")
    out = profile.select("doc_id", "fp", "n_shingles", "cls").join(named, "cls", "left").select(
        "doc_id", "fp", "n_shingles", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(
            F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that are not the first of their group, columns
    unchanged; repeated rows of the first document are one document and stay."""
    gone = near_duplicates(docs, shingle, percent, id_col, text_col).where("not kept").select(
        F.col("doc_id").alias("__gone_id"), F.col("fp").alias("__gone_fp"))
    same = docs[id_col].eqNullSafe(gone["__gone_id"]) & (F.xxhash64(as_text(docs[text_col])) == gone["__gone_fp"])
    return docs.join(gone, same, "left_anti")


def _between_components(large: DataFrame, groups: DataFrame, classes: DataFrame, sets: DataFrame, percent: int,
                        min_equal: int) -> DataFrame:
    """Links inside large buckets between classes of different components.

    The askers of a bucket are the classes outside its hub's component; every other
    class answers. Both are dealt into numbered blocks, and each block of askers
    meets each block of answers of its bucket in a group of its own."""
    label = groups.select(F.col("a").alias("cls"), F.col("b").alias("label"))
    of_hub = label.select(F.col("cls").alias("hub"), F.col("label").alias("hub_label"))
    labelled = (large.join(label, "cls", "left").join(of_hub, "hub", "left")
                .select("band", "h", "cls", "size", F.coalesce("label", "cls").alias("label"),
                        F.coalesce("hub_label", "hub").alias("hub_label"))
                .withColumn("asker", F.col("label") != F.col("hub_label")))
    askers = labelled.where("asker").groupBy("band", "h").agg(F.count("*").alias("n_askers"))
    open_ = labelled.join(askers, ["band", "h"])
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    own = lambda n, salt: F.pmod(F.xxhash64("cls", F.lit(salt)), blocks(n)).cast("int")
    all_of = lambda n: F.sequence(F.lit(0), blocks(n) - 1)
    answers = open_.select("band", "h", "cls", "label", F.lit(False).alias("asks"),
                           F.explode(all_of("n_askers")).alias("i"), own("size", 1).alias("j"))
    questions = open_.where("asker").select("band", "h", "cls", "label", F.lit(True).alias("asks"),
                                            own("n_askers", 2).alias("i"), F.explode(all_of("size")).alias("j"))
    rows = (answers.unionByName(questions).join(classes.select("cls", "sig"), "cls").join(sets, "cls"))
    return rows.groupBy("band", "h", "i", "j").applyInPandas(_compare_blocks(percent, min_equal), "a binary, b binary")
