"""Materialised lookups (the ``CREATE TEMP TABLE ... AS SELECT DISTINCT`` pattern)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..sources.steps import Steps


def distinct_lookup(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct rows of ``cols``, lazily."""
    return df.select(*cols).distinct()


def temp_table(df: DataFrame, name: str, steps: Steps) -> DataFrame:
    """Compute ``df`` once and register its stored rows as the session temp view ``name``, so that later SQL text reads
    them and not the query behind them. Rows and view last until ``steps`` are released."""
    return steps.view(name, lambda: df)
