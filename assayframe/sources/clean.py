"""Cleaned records: the on-disk layout, sink, scan and catalog table.

Default format is Parquet (typed, column-pruned, predicate push-down, safe for
tabs inside fields). The tab-separated text layout of the original output is
also available; like the original it is not escaped, so a tab inside a field
shifts later columns for readers.

Schema versions of the Parquet layout: 1 has the twelve texts; 2 has the number of the
reading beside its text (``reading_value``, null for ``Unknown``) and says so in that
column's metadata, which Spark keeps in the files. Readers that ask for typed records get
the number from version 2 as it stands and parse it from version 1 and from text.

``publish_clean`` never touches what readers see until all is written: the records go to a
folder of their own below the table's, then one small file that names it is replaced.
A write that fails, or a driver that dies, leaves the table as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.functions.values import number_of, reading_value, typed_name

# --- fixed values: positions of the cleaned record --------------------------
CLEAN_COLUMNS = (
    "record_id", "category", "item", "analyte", "reading", "unit",
    "maker", "country", "country_alt", "extra_9", "extra_10", "flag",
)
# ---------------------------------------------------------------------------
CLEAN_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in CLEAN_COLUMNS])
TAB = "\t"
READING, TYPED = "reading", typed_name("reading")
VERSION, VERSION_KEY = 2, "clean_schema"
POINTER = "_current"        # readers of a folder skip names that begin with "_"


def typed_column(df: DataFrame) -> Column:
    """The number of the reading, marked with the schema version."""
    return number_of(df, READING).alias(TYPED, metadata={VERSION_KEY: VERSION})


def write_clean(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Sequence[str] | None = None,
                columns: Sequence[str] = CLEAN_COLUMNS) -> None:
    """Overwrite ``path`` with the cleaned records.

    ``fmt="parquet"``: named columns and the number of the reading, optional
    ``partition_by`` (e.g. ``["category"]``) for partition pruning downstream.
    ``fmt="tsv"``: one line per record, fields joined by a tab, no header.
    """
    if fmt == "parquet":
        typed = [typed_column(df)] if READING in columns else []
        writer = df.select(*columns, *typed).write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
    elif fmt == "tsv":
        df.select(F.concat_ws(TAB, *[F.coalesce(F.col(c), F.lit("")) for c in columns]).alias("value")) \
            .write.mode("overwrite").text(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def publish_clean(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None,
                  columns: Sequence[str] = CLEAN_COLUMNS) -> str:
    """Write the records to a fresh folder below ``path`` and make it the table's current
    one. Returns the folder; older ones stay until ``drop_old`` is called."""
    return publish(df.sparkSession, path, lambda folder: write_clean(df, folder, fmt, partition_by, columns))


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Let ``write`` fill a fresh folder below ``path``, then make it the current one."""
    folder = f"{path.rstrip('/')}/data-{uuid.uuid4().hex}"
    write(folder)
    point(spark, path, folder.rsplit("/", 1)[1])
    return folder


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def point(spark: SparkSession, path: str, name: str) -> None:
    """Replace the pointer by one rename: readers see the old name or the new one."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs, new = _files(spark, f"{path.rstrip('/')}/{POINTER}-{name}")
    out = fs.create(new, True)
    out.write(bytearray(name.encode()))
    out.close()
    overwrite = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    overwrite[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsparkSession.sessionState().newHadoopConf())
    context.rename(fs.makeQualified(new), fs.makeQualified(hadoop.Path(f"{path.rstrip('/')}/{POINTER}")), overwrite)


def current_folder(spark: SparkSession, path: str) -> str:
    """The folder that holds the records: what the pointer names, or ``path`` itself
    where nothing was published."""
    fs, at = _files(spark, f"{path.rstrip('/')}/{POINTER}")
    if not fs.exists(at):
        return path
    stream = fs.open(at)
    name = bytes(stream.readAllBytes()).decode()
    stream.close()
    return f"{path.rstrip('/')}/{name}"


def drop_old(spark: SparkSession, path: str) -> list[str]:
    """Delete the published folders that are not current; call it when no reader
    uses them any more. Returns their names."""
    current = current_folder(spark, path).rsplit("/", 1)[1]
    fs, at = _files(spark, path)
    old = [s.getPath() for s in fs.listStatus(at) if s.getPath().getName().startswith("data-") and s.getPath().getName() != current]
    for folder in old:
        fs.delete(folder, True)
    return sorted(p.getName() for p in old)


def schema_version(spark: SparkSession, path: str) -> int:
    """The version of a Parquet folder of cleaned records (1 where none is stated)."""
    fields = {f.name: f for f in spark.read.parquet(current_folder(spark, path)).schema}
    return fields[TYPED].metadata.get(VERSION_KEY, 1) if TYPED in fields else 1


def scan_clean(spark: SparkSession, path: str, fmt: str = "parquet",
               columns: Sequence[str] = CLEAN_COLUMNS, min_fields: int | None = None, typed: bool = False) -> DataFrame:
    """Read cleaned records back with named string columns; ``typed`` adds the
    number of the reading (``reading_value``), read or parsed as the version says.

    For ``tsv`` the split is on every tab with trailing empty fields dropped
    (the behaviour of a JVM ``split("\\t")``); ``min_fields`` keeps only lines
    with at least that many fields (the audit uses 12).
    """
    if fmt not in ("parquet", "tsv"):
        raise ValueError(f"unknown format {fmt!r}")
    folder = current_folder(spark, path)
    if fmt == "parquet":
        fields = [T.StructField(c, T.StringType(), True) for c in columns]
        if typed and schema_version(spark, path) >= 2:
            schema = T.StructType([*fields, T.StructField(TYPED, T.DoubleType(), True)])
            return spark.read.schema(schema).parquet(folder).select(*columns, TYPED)
        df = spark.read.schema(T.StructType(fields)).parquet(folder).select(*columns)     # partition columns come last otherwise
    else:
        parts = F.split(F.regexp_replace(F.col("value"), "\t+$", ""), TAB, -1)
        df = spark.read.text(folder).select(parts.alias("__f"))
        if min_fields is not None:
            df = df.where(F.size("__f") >= min_fields)
        df = df.select(*[F.get(F.col("__f"), i).alias(c) for i, c in enumerate(columns)])
    return df.withColumn(TYPED, reading_value(READING)) if typed else df


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Names of the ``name=value`` folder levels below ``path``."""
    names, (fs, at) = [], _files(spark, path)
    while True:
        below = [s.getPath() for s in fs.listStatus(at) if s.isDirectory() and "=" in s.getPath().getName()]
        if not below:
            return names
        names.append(below[0].getName().split("=", 1)[0])
        at = below[0]


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
                   columns: Sequence[str] = CLEAN_COLUMNS) -> DataFrame:
    """Catalog table over a cleaned-output folder (external: dropping it keeps
    the files); partitions written by ``partition_by`` are registered with it,
    all as strings. Returns ``spark.table(name)``."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    path = current_folder(spark, path)
    if fmt == "parquet":
        parts = partition_columns(spark, path)
        typed = [f"`{TYPED}` DOUBLE"] if schema_version(spark, path) >= 2 else []
        held = ", ".join([*[f"`{c}` STRING" for c in columns if c not in parts], *typed, *[f"`{c}` STRING" for c in parts]])
        by = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in parts)})" if parts else ""
        where = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({held}) USING parquet{by} LOCATION '{where}'")
        if parts:
            spark.catalog.recoverPartitions(name)
    else:
        scan_clean(spark, path, fmt).createOrReplaceTempView(name)
    return spark.table(name).select(*columns)


def show_tables(spark: SparkSession) -> DataFrame:
    """Tables and views of the current catalog database."""
    return spark.sql("SHOW TABLES")


def describe(spark: SparkSession, name: str) -> DataFrame:
    """Column names and types of a catalog table."""
    return spark.sql(f"DESCRIBE TABLE {name}")


def preview(spark: SparkSession, name: str, n: int = 10, order_by: str = "record_id", typed: bool = False) -> DataFrame:
    """First ``n`` rows of a table in ``order_by`` order (a top-n: per-task
    heaps, no full sort); the number of the reading only when ``typed``."""
    table = spark.table(name)
    return (table if typed else table.drop(TYPED)).orderBy(F.col(order_by).asc()).limit(n)
