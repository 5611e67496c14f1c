"""Schema and label set checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def unknown_values(df: DataFrame, column: str, allowed: DataFrame) -> DataFrame:
    """Distinct values of `column` that the one-column frame `allowed` lacks."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().exceptAll(
        allowed.toDF(column).distinct()
    )
