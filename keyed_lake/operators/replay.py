"""Repeat an input, to test idempotence and to size benchmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replay(df: DataFrame, copies: int, copy_column: str | None = None) -> DataFrame:
    """Every row `copies` times; `copy_column` numbers the copies from 0. Runs without a join or shuffle."""
    if copies < 1:
        raise ValueError("copies must be at least 1")
    numbers = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    repeated = df.withColumn(copy_column or "_copy", numbers)
    return repeated if copy_column else repeated.drop("_copy")
