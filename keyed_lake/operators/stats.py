"""Counts and summaries of batches and logs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyed_lake.spec import PARTITION_COLUMN

_WIDE = (T.StringType, T.BinaryType)
_ROW_OVERHEAD = 24


def size_expression(schema: T.StructType) -> Column:
    """The bytes one row needs in memory, from above: the lengths of its texts plus a fixed part."""
    size = F.lit(_ROW_OVERHEAD + 16 * len(schema.fields)).cast("long")
    for f in schema:
        if isinstance(f.dataType, _WIDE):
            size = size + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
    return size


@dataclass(frozen=True)
class BatchStats:
    rows: int = 0
    bad_rows: int = 0
    bytes: int = 0
    first_time: datetime | None = None
    last_time: datetime | None = None
    dates: list[str] = field(default_factory=list)
    null_dates: int = 0


def batch_stats(batch: DataFrame, time_column: str | None = None, bad_column: str | None = None) -> BatchStats:
    """Size, time span and partition dates of a batch in one aggregate; one row comes back to the driver.

    The dates are a set of days, so its size is bounded by the calendar and not by the rows. They travel as text,
    which also carries years a Python date can't hold.
    """
    good = ~F.col(bad_column) if bad_column else F.lit(True)
    nothing = F.lit(None)
    when_good = lambda c: F.when(good, c)
    date = F.col(PARTITION_COLUMN).cast("string") if PARTITION_COLUMN in batch.columns else nothing.cast("string")
    time = F.col(time_column) if time_column else nothing.cast("timestamp")
    row = batch.agg(
        F.count("*").alias("rows"),
        F.count_if(~good).alias("bad_rows"),
        F.sum(when_good(size_expression(batch.schema))).alias("bytes"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
        F.collect_set(when_good(date)).alias("dates"),
        F.count_if(good & date.isNull()).alias("null_dates"),
    ).head()
    return BatchStats(
        row["rows"], row["bad_rows"], row["bytes"] or 0, row["first_time"], row["last_time"],
        sorted(row["dates"]), row["null_dates"],
    )


def log_tail(log: DataFrame, n: int = 100) -> DataFrame:
    """The newest `n` records. Offsets count per partition, so time comes first among equal offsets."""
    return log.orderBy(F.desc("offset"), F.desc("timestamp"), F.desc("partition")).limit(n)


def log_stats(log: DataFrame) -> DataFrame:
    """Record count and greatest offset per log partition; no rows for an empty log."""
    return log.groupBy("partition").agg(F.count("*").alias("records"), F.max("offset").alias("max_offset"))


def metadata_counts(
    spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str] = (), extremes: Sequence[str] = (),
    paths: Sequence[str] = (),
) -> DataFrame:
    """records (and least_x, most_x of number and date columns) of a Parquet folder or some `paths` in it, per partition
    column or in all.

    Answered from file footers, without reading a row: Spark's second Parquet reader pushes such aggregates into the
    scan. It is chosen in a session of its own, so that other reads stay as they are.
    """
    side = spark.newSession()
    side.conf.set("spark.sql.sources.useV1SourceList", "")
    side.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    found = [f(c).alias(f"{name}_{c}") for c in extremes for name, f in (("least", F.min), ("most", F.max))]
    rows = side.read.schema(schema).option("basePath", path).parquet(*(paths or [path]))
    return rows.groupBy(*by).agg(F.count("*").alias("records"), *found)


def count_rows(df: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    """Row counts, in all or per group."""
    return df.groupBy(*by).agg(F.count("*").alias("records"))
