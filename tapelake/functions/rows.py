"""Rows of a report."""

from __future__ import annotations

from pyspark.sql import DataFrame


def first_rows(df: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` rows of an ordered DataFrame, or all of them."""
    return df if limit is None else df.limit(limit)
