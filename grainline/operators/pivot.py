"""Pivots by conditional aggregation: one pass, one shuffle, fixed output columns.

``groupBy().pivot()`` would first collect the distinct pivot values (an extra job)
and return NULL rather than 0 for empty counts; a ``when`` per output column does
neither and keeps map-side partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_min(df: DataFrame, rows: Sequence[str], col: str, val: str,
              values: Sequence[str], names: Sequence[str] | None = None,
              cast: str | None = "double") -> DataFrame:
    names = list(names) if names else [v.lower() for v in values]
    aggs = []
    for v, n in zip(values, names):
        m = F.min(F.when(F.col(col) == F.lit(v), F.col(val)))
        aggs.append((m.cast(cast) if cast else m).alias(n))
    return df.groupBy(*rows).agg(*aggs)


def pivot_count(df: DataFrame, rows: Sequence[str], col: str, count_col: str,
                values: Sequence[str], names: Sequence[str] | None = None,
                total: str | None = None) -> DataFrame:
    """``COUNT(count_col) FILTER (WHERE col = v)`` per value (0 when empty), plus
    optionally a total over all values, listed or not."""
    names = list(names) if names else [v.lower() for v in values]
    aggs = [F.count(F.when(F.col(col) == F.lit(v), F.col(count_col))).alias(n)
            for v, n in zip(values, names)]
    if total:
        aggs.append(F.count(F.col(count_col)).alias(total))
    return df.groupBy(*rows).agg(*aggs)
