"""All training-data queries and their SQL."""

from __future__ import annotations

import corpus_pipeline
from assayframe.llm import queries_free, queries_native


def queries() -> dict:
    return queries_native.QUERIES | queries_free.QUERIES | {"pipeline": corpus_pipeline.run}


def oracle() -> dict:
    return queries_native.ORACLE | queries_free.ORACLE
