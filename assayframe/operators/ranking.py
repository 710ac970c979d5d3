"""Ordered results and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rank_by(df: DataFrame, by: str, keys: Sequence[str] | str, k: int | None = 20,
            ascending: bool = False) -> DataFrame:
    """Sort by ``by`` (descending by default), ties by ``keys`` ascending, then
    keep the first ``k`` rows (``k=None`` keeps all). With a ``k`` Spark plans
    a per-task heap of k rows (TakeOrderedAndProject), not a full sort."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [F.col(by).asc() if ascending else F.col(by).desc()] + [F.col(c).asc() for c in keys]
    out = df.orderBy(*order)
    return out.limit(k) if k is not None else out
