"""Counts, each in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def column_counts(df: DataFrame) -> DataFrame:
    """Non-null values per column as ``(column_name, n_values)``."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    return counts.unpivot([], list(df.columns), "column_name", "n_values")


def split_counts(df: DataFrame, split_col: str = "split") -> DataFrame:
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"))
