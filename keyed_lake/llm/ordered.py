"""Ordered computations within groups of any size: what a window over the group does, without the group in one task.

Rows are range-partitioned by group and order, which also cuts a large group; each part works on its own rows, and a
table with a row per group and part tells it what the parts before it hold. Order columns should tell the rows of a group
apart; rows that tie are ordered arbitrarily, but once for all, as the parts are a written table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written


def _parts(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    ranged = df.repartitionByRange(*[F.col(k) for k in keys], *order)
    return written(ranged.withColumn("_part", F.spark_partition_id()), "ordered-parts")


def _with_carry(parts: DataFrame, keys: list[str], total: Column, combine: Column) -> DataFrame:
    """Adds `_carry`: `combine` (over `_total`) of the totals of the group's earlier parts. Null keys are a group."""
    totals = parts.groupBy(*keys, "_part").agg(total.alias("_total"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.withColumn("_carry", combine.over(earlier)).drop("_total")
    carry = written(carry, "ordered-carry")
    right = carry.select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.col("_part").alias("_rpart"), "_carry")
    same = F.col("_part") == F.col("_rpart")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return parts.join(right, same, "left").drop("_rpart", *[f"_r_{k}" for k in keys])


def largest_before(df: DataFrame, keys: list[str], order: list[Column], value: str, name: str) -> DataFrame:
    """Adds the largest value among the group's earlier rows; nulls don't count."""
    parts = _with_carry(_parts(df, keys, order), keys, F.max(value), F.max("_total"))
    local = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn(name, F.greatest(F.max(value).over(local), F.col("_carry"))).drop("_part", "_carry")


def position(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Adds the number of the row within its group, from 0 without a gap."""
    parts = _with_carry(_parts(df, keys, order), keys, F.count(F.lit(1)), F.sum("_total"))
    local = Window.partitionBy(*keys, "_part").orderBy(*order)
    number = F.row_number().over(local) - 1 + F.coalesce("_carry", F.lit(0))
    return parts.withColumn(name, number.cast("long")).drop("_part", "_carry")
