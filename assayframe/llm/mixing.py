"""Mixing to target weights: iterative proportional fitting, then sampling.

Documents fall into cells, one per combination of the dimensions (source, language,
topic). The cells' token totals are raked: each dimension in turn is scaled so that
its marginal shares equal the targets, until all of them do. The ratio of a cell's
raked weight to its tokens, scaled so that none exceeds one, is the probability
with which each of its documents is kept; the expected tokens of the sample then
have the target marginals. A document is kept when a uniform number made from its
id is below its probability, so the sample does not change between runs.

The documents are read twice (totals, then probabilities); everything between works
on the cell table, which is aggregated before it is shuffled; a window per dimension
gives the marginal sums. The table is written every ``SWEEPS_PER_CHECK`` sweeps, which cuts the lineage and gives the
one-row test of convergence.

Defined results: a null dimension value is the empty string; a null text has no
token; a value without a target has target zero and loses its documents; targets
are divided by their sum over the values that occur; a cell without tokens counts
as one token; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayframe.llm._common import as_text, written

DIMENSIONS = ("source", "lang", "topic")
TEMPER = 0.85               # default targets: observed shares to this power
SWEEPS_PER_CHECK = 4
MAX_SWEEPS = 40
TOLERANCE = 1e-6
SHORT, LONG = 100, 1000


def token_count(text: Column) -> Column:
    return F.regexp_count(as_text(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def form_topic(text: Column, tokens: Column) -> Column:
    """A stand-in for a topic label: the form of the document."""
    return (F.when(F.contains(as_text(text), F.lit(" | ")), "table").when(tokens < SHORT, "short")
            .when(tokens >= LONG, "long").otherwise("prose"))


def tempered_targets(cells: DataFrame, dims: Sequence[str] = DIMENSIONS, power: float = TEMPER) -> dict[str, DataFrame]:
    """Per dimension ``value, target``: observed token totals to ``power``."""
    return {d: cells.groupBy(d).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("target")) for d in dims}


def cell_totals(docs: DataFrame, dims: Sequence[str] = DIMENSIONS) -> DataFrame:
    return docs.groupBy(*dims).agg(F.sum("tokens").cast("double").alias("tokens"), F.count("*").alias("docs"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = TOLERANCE,
         max_sweeps: int = MAX_SWEEPS) -> DataFrame:
    """``cells`` with ``weight``: token totals fitted to the target marginals.

    ``targets`` maps a dimension to (value, target). Cells without tokens count as
    one token, so that their documents get a probability too. Where the targets
    contradict each other (a value with a target but no cell that may carry it),
    the fit stops after ``max_sweeps`` with the last dimension exact.
    """
    dims = list(targets)
    start = F.greatest(F.col("tokens"), F.lit(1.0))
    work = cells.withColumn("base", start).withColumn("weight", start)
    for d in dims:
        seen = cells.select(d).distinct().join(targets[d].select(d, "target"), d, "left")
        seen = seen.select(d, F.coalesce("target", F.lit(0.0)).alias("target"))
        total = seen.agg(F.sum("target").alias("t")).first()["t"] or 1.0
        work = work.join(seen.select(d, (F.col("target") / total).alias(f"target_{d}")), d)
    names = [*cells.columns, "base", *(f"target_{d}" for d in dims), "weight"]
    work = written(work.select(*names), "mix-cells")
    whole = work.agg(F.sum("weight").alias("w")).first()["w"] or 1.0
    for _ in range(max(1, max_sweeps // SWEEPS_PER_CHECK)):
        for _ in range(SWEEPS_PER_CHECK):
            for d in dims:
                have = F.sum("weight").over(Window.partitionBy(d))
                work = work.withColumn("weight", F.when(
                    have > 0, F.col("weight") * F.col(f"target_{d}") * whole / have).otherwise(0.0))
        work = written(work.select(*names), "mix-cells")
        apart = work.select(*[F.abs(F.sum("weight").over(Window.partitionBy(d)) / whole - F.col(f"target_{d}")).alias(d)
                              for d in dims])
        worst = apart.agg(F.max(F.array_max(F.array(*dims))).alias("gap")).first()["gap"]
        if (worst or 0.0) <= tolerance:
            break
    return work


def keep_probabilities(cells: DataFrame, dims: Sequence[str] = DIMENSIONS, share: float = 1.0) -> DataFrame:
    """Per cell the ``probability``: raked weight over tokens, scaled so that the
    largest is ``share``."""
    ratio = F.col("weight") / F.col("base")
    top = cells.agg(F.max(ratio).alias("r")).first()["r"] or 1.0
    return cells.select(*dims, (ratio * (share / top)).alias("probability"))


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on ``key`` and ``seed`` alone."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11) / F.lit(float(1 << 53))


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, dims: Sequence[str] = DIMENSIONS,
        key: str = "doc_id", seed: int = 7, share: float = 1.0) -> DataFrame:
    """``docs`` (with the dimension columns and ``tokens``) plus ``probability``
    and ``sampled``. Without targets, tempered observed shares are used."""
    clean = docs
    for d in dims:
        clean = clean.withColumn(d, F.coalesce(F.col(d).cast("string"), F.lit("")))
    cells = written(cell_totals(clean, dims), "mix-totals")
    fitted = rake(cells, targets or tempered_targets(cells, dims))
    chances = written(keep_probabilities(fitted, dims, share), "mix-probabilities")
    joined = clean.join(chances, list(dims))
    return joined.withColumn("sampled", uniform(F.col(key), seed) < F.col("probability"))


def mix_documents(docs: DataFrame, seed: int = 7) -> DataFrame:
    """``doc_id, source, lang, topic, tokens, probability, sampled`` of documents
    with a ``text``, the topic being the document's form."""
    tokens = token_count(F.col("text"))
    rows = docs.select("doc_id", "source", "lang", "text", tokens.alias("tokens"))
    rows = rows.select("doc_id", "source", "lang", form_topic(F.col("text"), F.col("tokens")).alias("topic"), "tokens")
    return mix(rows, seed=seed).select("doc_id", *DIMENSIONS, "tokens", "probability", "sampled")


def sample_documents(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The sampled rows of ``docs``, columns unchanged. A row's cell is looked up
    again in the cell table, so the texts are not shuffled."""
    tokens = token_count(F.col("text"))
    cell = {"__source": F.coalesce(F.col("source").cast("string"), F.lit("")),
            "__lang": F.coalesce(F.col("lang").cast("string"), F.lit("")),
            "__topic": form_topic(F.col("text"), tokens)}
    rows = docs.select(*[c.alias(n) for n, c in cell.items()], tokens.alias("tokens"))
    cells = written(cell_totals(rows, list(cell)), "mix-totals")
    chances = keep_probabilities(rake(cells, tempered_targets(cells, list(cell))), list(cell))
    chances = written(chances.withColumnRenamed("probability", "__probability"), "mix-probabilities")
    marked = docs.withColumns(cell).join(chances, list(cell))
    return marked.where(uniform(F.col("doc_id"), seed) < F.col("__probability")).select(*docs.columns)
