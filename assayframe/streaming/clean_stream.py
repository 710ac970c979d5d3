"""The cleaning job on a stream of text files, and running rates over it.

Parsing, guards, cleaning, both lookups and the flag are stateless row
operations, so the batch functions apply unchanged to a streaming DataFrame
(the lookups become stream-static broadcast joins). Rates per group are a
stateful aggregation whose state is one (hits, rows) pair per group.
The default checkpoint of a written stream lies inside its output folder, so a
restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assayframe.operators.cleaning import clean_records
from assayframe.session import scratch_path
from assayframe.sources.clean import CLEAN_COLUMNS


def read_line_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New text files in ``source_dir`` as a stream of lines (``value``)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(source_dir)


def clean_stream(lines: DataFrame, limits: DataFrame, synonyms: DataFrame | None, header: str) -> DataFrame:
    """Cleaned, flagged records from a line stream. The header must be given:
    a stream has no first line to read it from."""
    if header is None:
        raise ValueError("a streaming source needs the header text")
    return clean_records(lines, limits, synonyms, header=header).select(*CLEAN_COLUMNS)


def write_stream(df: DataFrame, path: str, checkpoint: str | None = None, fmt: str = "parquet",
                 available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Append the stream to ``path``. ``available_now`` processes what is
    there and stops; otherwise a trigger every ``processing_time``.

    The file sink keeps its own log of batches in ``path``, so progress and
    output must go together: without ``checkpoint`` it is ``path/_checkpoint``
    (readers skip it), and a second call goes on after the first."""
    writer = (df.writeStream.format(fmt).outputMode("append").option("path", path)
                .option("checkpointLocation", checkpoint or f"{path.rstrip('/')}/_checkpoint"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time or "1 minute")
    return writer.start()


def running_rate(df: DataFrame, key: str, hit: Column, among: Column | None = None, out: str = "rate") -> DataFrame:
    """Running ``hits / rows`` per group over a stream (state: one pair of
    counts per group). Write with output mode ``update`` or ``complete``."""
    rows = df.where(among) if among is not None else df
    agg = rows.groupBy(key).agg(F.count_if(hit).alias("hits"), F.count(F.lit(1)).alias("rows"))
    return agg.withColumn(out, F.col("hits").cast("double") / F.col("rows"))


def write_rates(df: DataFrame, query_name: str, checkpoint: str | None = None,
                available_now: bool = True) -> StreamingQuery:
    """Keep the running rates in an in-session table named ``query_name``
    (complete mode: one row per group, bounded by the number of groups)."""
    spark = df.sparkSession
    writer = (df.writeStream.format("memory").queryName(query_name).outputMode("complete")
                .option("checkpointLocation", checkpoint or scratch_path(spark, "rate-checkpoint")))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
