"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
import shutil
import string
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe.session import scratch_path

# Words of the decontamination contract, on text whose A-Z are already lower case.
WORD_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that functions
    run inside tasks can be imported there; like submitting it with --py-files."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="assayframe-package-")
    archive = shutil.make_archive(os.path.join(folder, "assayframe"), "zip", os.path.dirname(package),
                                  os.path.basename(package))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the result no longer
    depends on the executors that computed it, and several readers share it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are. Null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def as_text(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))
