"""Balanced contiguous shards from global prefix sums of byte sizes.

The order is by content hash, then key, so equal texts are neighbours. Rows are range-partitioned in that order; each
task sums the sizes of its own rows, and the totals of the partitions, one row each, turn these into global sums. Cuts
at equal targets then give the shards.

Equal texts stay in one shard: a group goes where its middle lies. Groups with more than `whole` of a shard's bytes would
bend the balance, and ones with more than that share of its rows, such as empty texts, would fill one task. There are at
most `shards / whole` of either, a bound that doesn't depend on the data; those that fit into a shard are handed out
first, the largest to the emptiest shard, and the cuts of the others leave room for them. A group larger than a shard
can't be kept whole in any balanced way: it is cut between rows like the rest.

A null text has no bytes and is of the group of empty ones. Very long texts only count by their size: past the first
step no row holds a text. Keys may be null or repeat; equal rows, the ties of this order, are separate rows with slots
of their own. Columns are made by position, so names of the table can't clash. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import col, fresh, map_arrow, plus, written

SHARDS = 40
OVERHEAD = 16
WHOLE = 1 / 32


def sizes(df: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, size, text_crc32 and the content hash of every row; all that the rest needs."""
    body = F.encode(F.coalesce(col(text).cast("string"), F.lit("")), "UTF-8")
    return df.select(
        col(key).alias("doc_id"), (F.length(body) + OVERHEAD).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"), F.unhex(F.md5(body)).alias("hash"),
    )


def _middles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds where the middle of each row's group lies, in bytes from the start of the partition."""
    done, last, start = 0, None, 0
    for batch in batches:
        size = batch.column("size").to_numpy()
        hashes, salt = batch.column("hash").to_pylist(), batch.column("salt").to_numpy()
        first = np.empty(len(size), np.int64)
        for i, key in enumerate(zip(hashes, salt.tolist())):
            if key != last:
                last, start = key, done
            first[i] = start
            done += int(size[i])
        middle = first + batch.column("bytes").to_numpy() / 2
        yield batch.append_column("middle", pa.array(middle, pa.float64()))


def _local_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the number of rows of the same shard before each row within its partition."""
    seen: dict[int, int] = {}
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        slot = np.empty(len(shard), np.int64)
        for s in np.unique(shard):
            at = np.flatnonzero(shard == s)
            slot[at] = seen.get(s, 0) + np.arange(len(at))
            seen[s] = seen.get(s, 0) + len(at)
        yield batch.append_column("local", pa.array(slot, pa.int64()))


def place_large(groups: dict[bytes, int], shards: int) -> tuple[dict[bytes, int], list[int]]:
    """The largest group to the emptiest shard, and so on; the bytes that each shard then has."""
    heap = [(0, s) for s in range(shards)]
    placed, load = {}, [0] * shards
    for h in sorted(groups, key=lambda h: (-groups[h], h)):
        bytes_, s = heapq.heappop(heap)
        placed[h], load[s] = s, bytes_ + groups[h]
        heapq.heappush(heap, (load[s], s))
    return placed, load


def assign_shards(df: DataFrame, key: str, text: str, shards: int = SHARDS, whole: float = WHOLE) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row."""
    spark = df.sparkSession
    light = written(sizes(df, key, text).withColumn("row", F.monotonically_increasing_id()), "shard-sizes")
    total, rows_in = light.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    target = total / shards
    groups = light.groupBy("hash").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    many = max(1.0, rows_in / shards * whole)
    large = groups.where((F.col("bytes") > target * whole) | (F.col("rows") > many)).collect()  # 2 * shards / whole at most
    placed, load = place_large({bytes(r["hash"]): r["bytes"] for r in large if r["bytes"] <= target}, shards)
    cut = [bytes(r["hash"]) for r in large if r["bytes"] > target]
    known = spark.createDataFrame(
        [(bytearray(h), s) for h, s in placed.items()] + [(bytearray(h), -1) for h in cut], "hash binary, fixed int"
    )
    rows = light.join(F.broadcast(known), "hash", "left")

    # the other rows in order; salt lets the rows of a group that is cut anyway go to several tasks
    salt = F.when(F.col("fixed") == -1, F.xxhash64("row")).otherwise(F.lit(0).cast("long"))
    flow = rows.where("fixed is null or fixed < 0").withColumn("salt", salt).drop("fixed")
    group = F.sum("size").over(Window.partitionBy("hash", "salt"))
    ordered = flow.repartitionByRange("hash", "salt").withColumn("bytes", group)
    ordered = ordered.sortWithinPartitions("hash", "salt", "row").withColumn("part", F.spark_partition_id())
    summed = written(map_arrow(ordered, _middles, plus(ordered.schema, ("middle", "double"))), "shard-sums")
    totals = summed.groupBy("part").agg(F.sum("size").alias("total")).orderBy("part").collect()  # a row per partition
    starts = [0, *accumulate(t["total"] for t in totals)]
    begin = spark.createDataFrame([(t["part"], s) for t, s in zip(totals, starts)], "part int, start long")
    room = list(accumulate(max(0.0, target - x) for x in load))
    scale = starts[-1] / room[-1] if room[-1] else 1.0
    cuts = F.array(*[F.lit(c * scale) for c in room[:-1]]).cast("array<double>")
    shard = F.size(F.filter(cuts, lambda c: c <= F.col("start") + F.col("middle")))
    columns = ["doc_id", "size", "text_crc32", "shard"]
    flowed = summed.join(F.broadcast(begin), "part").withColumn("shard", shard).select(*columns)
    kept = rows.where("fixed >= 0").withColumn("shard", F.col("fixed")).select(*columns)
    return _slots(flowed.unionByName(kept))


def _slots(rows: DataFrame) -> DataFrame:
    """Numbers the rows of each shard without a gap: within each task first, then by what earlier tasks have."""
    rows = rows.withColumn("task", F.spark_partition_id())
    local = written(map_arrow(rows, _local_slots, plus(rows.schema, ("local", "long"))), "shard-slots")
    counts = local.groupBy("shard", "task").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    slot = (F.col("first") + F.col("local")).cast("long").alias("slot")
    return local.join(offsets, ["shard", "task"]).select("doc_id", "size", "text_crc32", "shard", slot)


def write_shards(df: DataFrame, key: str, text: str, path: str, shards: int = SHARDS) -> None:
    """The rows with all their columns as Parquet, a folder `shard=N` each; keys must be unique and not null."""
    name = fresh("_key", df.columns)
    place = assign_shards(df, key, text, shards).select(F.col("doc_id").alias(name), "shard")
    out = df.drop("shard").join(place, col(key) == F.col(name)).drop(name)
    out.write.partitionBy("shard").parquet(path)
