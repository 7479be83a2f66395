"""Exact duplicates by two passes over a Bloom filter; DataFrame functions only.

Pass 1 counts how many rows set each cell of a counting Bloom filter and keeps, as 64-bit words, the cells set at least
twice. Pass 2 looks up every row: a row with a cell set once only is alone and passes straight through. The rest, the
true repeats and a few false positives, shuffles by the SHA-256 of its text, which decides exactly.

The filter never has more than `max_bits` cells, which bounds its broadcast. With more rows than it was made for, more
rows shuffle; the result stays the same.

Null texts count as empty. Of equal texts the row with the largest key stays; a null key is the smallest. Rows with
equal text and equal key are one group, of which one row stays. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bloom import MAX_BITS, build
from .common import col, fresh, written

def text_hash(text: str) -> Column:
    return F.sha2(F.coalesce(col(text).cast("string"), F.lit("")), 256)


def duplicate_report(df: DataFrame, key: str, text: str, max_bits: int = MAX_BITS) -> DataFrame:
    """A row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    light = written(
        df.select(
            col(key).alias("doc_id"), F.unhex(text_hash(text)).alias("sha"), F.monotonically_increasing_id().alias("row")
        ),
        "text-hashes",
    )
    seen = build(light, "sha", light.count(), 2, max_bits).flag(light, "maybe", F.col("sha"))
    maybe = seen.where("maybe").drop("maybe")
    groups = written(
        maybe.groupBy("sha")
        .agg(F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size"))
        .where("group_size > 1"),
        "text-groups",
    )  # a table of its own, so that Spark can split the join for a hash with many rows
    repeated = maybe.join(groups, "sha", "left").select(
        "doc_id",
        F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (F.col("best").isNull() | (F.col("row") == F.col("best.row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
    alone = seen.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )
    return alone.unionByName(repeated)


def drop_duplicates(df: DataFrame, key: str, text: str, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows that stay, with all their columns.

    Every task sends one row per repeated text at most: Spark prunes `row_number() = 1` before the shuffle.
    """
    sha, maybe, tie, place = (fresh(n, df.columns) for n in ("sha", "maybe", "tie", "place"))
    hashes = df.select(F.unhex(text_hash(text)).alias("sha"))
    seen = build(hashes, "sha", df.count(), 2, max_bits).flag(df.withColumn(sha, F.unhex(text_hash(text))), maybe, F.col(sha))
    order = Window.partitionBy(sha).orderBy(col(key).desc_nulls_last(), tie)
    rest = (
        seen.where(maybe)
        .withColumn(tie, F.xxhash64(*[col(c).cast("string") for c in df.columns]))
        .withColumn(place, F.row_number().over(order))
        .where(F.col(place) == 1)
    )
    columns = [col(c) for c in df.columns]
    return seen.where(~F.col(maybe)).select(*columns).unionByName(rest.select(*columns))
