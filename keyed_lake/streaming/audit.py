"""One record per merged micro-batch, and checks on the outcome."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from keyed_lake.operators.stats import BatchStats, log_stats, log_tail
from keyed_lake.sources.changelog import ParquetLog
from keyed_lake.spec import TableSpec
from keyed_lake.storage import Files

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("table_folder", T.StringType()),
        T.StructField("csv_folder", T.StringType()),
        T.StructField("batch_size", T.LongType()),
        T.StructField("bad_rows", T.LongType()),
        T.StructField("partition_values", T.ArrayType(T.StringType())),
        T.StructField("log_time", T.TimestampType()),
        T.StructField("fetch_time", T.TimestampType()),
        T.StructField("partition_time", T.TimestampType()),
        T.StructField("merge_time", T.TimestampType()),
    ]
)


def now() -> datetime:
    return datetime.now(timezone.utc)


def append_audit(
    spark: SparkSession,
    target,
    spec: TableSpec,
    stats: BatchStats,
    times: tuple[datetime, datetime, datetime],
    stream: str,
    batch_id: int,
) -> None:
    """Write the record of one batch to a folder or a log; a batch that has one already keeps it.

    `times` are when the batch was fetched, when its partitions were known, and when the merge was done. The log
    time is the least record time of the batch.
    """
    values = [
        spec.topic, spec.table_folder, spec.csv_folder, stats.rows, stats.bad_rows,
        F.array(*[F.lit(d) for d in stats.dates]), stats.first_time, *times,
    ]
    columns = [
        (v if isinstance(v, Column) else F.lit(v)).cast(f.dataType).alias(f.name)
        for v, f in zip(values, AUDIT_SCHEMA.fields)
    ]
    row = spark.range(0, 1, 1, 1).select(*columns)
    if not isinstance(target, str):
        target.append(audit_records(row), f"audit-{stream}", batch_id)
        return
    folder = f"{target.rstrip('/')}/batch={stream}-{batch_id}"
    if not Files(spark).exists(f"{folder}/_SUCCESS"):
        row.write.mode("overwrite").parquet(folder)


METRICS = "audit"
PROGRESS_SCHEMA = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("batch", T.LongType()),
        T.StructField("batch_size", T.LongType()),
        T.StructField("bad_rows", T.LongType()),
        T.StructField("log_time", T.TimestampType()),
        T.StructField("last_offset", T.DecimalType(38, 0)),
        T.StructField("fetch_time", T.TimestampType()),
        T.StructField("batch_ms", T.LongType()),
        T.StructField("merge_ms", T.LongType()),
    ]
)


def observe_batches(rows: DataFrame) -> DataFrame:
    """Decoded rows of a stream that count themselves on their way: no second pass over a batch is needed for its audit."""
    bad = F.col("_bad") if "_bad" in rows.columns else F.lit(False)
    place = lambda name, kind: (F.col(name) if name in rows.columns else F.lit(None)).cast(kind)
    return rows.observe(
        METRICS,
        F.count(F.lit(1)).alias("batch_size"),
        F.count_if(bad).alias("bad_rows"),
        F.min(place("_log_timestamp", "timestamp")).alias("log_time"),
        F.max(place("_log_offset", "decimal(38,0)")).alias("last_offset"),
    )


class ProgressAudit(StreamingQueryListener):
    """Audit records from the progress reports of streams: observed metrics and the times Spark measures itself.

    Add it with `spark.streams.addListener`. Records are written by day, `every` reports in one file and the rest when
    a query ends.
    """

    def __init__(self, spark: SparkSession, folder: str, every: int = 100):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.every = every
        self.records: list[tuple] = []
        self.ended = threading.Condition()
        self.done: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(METRICS)
        if seen is None or not seen["batch_size"]:
            return
        took = progress.durationMs
        fetched = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
        self.records.append(
            (
                progress.name, progress.batchId, seen["batch_size"], seen["bad_rows"], seen["log_time"], seen["last_offset"],
                fetched, took.get("triggerExecution"), took.get("addBatch"),
            )
        )
        if len(self.records) >= self.every:
            self.write()

    def onQueryTerminated(self, event) -> None:
        self.write()
        with self.ended:
            self.done.add(str(event.runId))
            self.ended.notify_all()

    def write(self) -> None:
        records, self.records = self.records, []
        if records:
            rows = self.spark.createDataFrame(records, PROGRESS_SCHEMA).withColumn("day", F.to_date("fetch_time"))
            rows.coalesce(1).write.mode("append").partitionBy("day").parquet(self.folder)

    def wait(self, query: StreamingQuery, timeout: float = 60) -> None:
        """Wait until the report of a query's end is in; reports come some time after what they report."""
        with self.ended:
            if not self.ended.wait_for(lambda: str(query.runId) in self.done, timeout):
                raise TimeoutError(f"no report of the end of {query.name}")

    def read(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS_SCHEMA).parquet(self.folder).select(*PROGRESS_SCHEMA.names)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).parquet(path).select(*AUDIT_SCHEMA.names)


def audit_records(audit: DataFrame) -> DataFrame:
    """Audit rows as `key`, `value` records with a JSON value, ready to append to a log."""
    return audit.select(F.col("topic").alias("key"), F.to_json(F.struct(*AUDIT_SCHEMA.names)).alias("value"))


def wait_for_count(
    count: Callable[[], int], expected: int, timeout: float = 600.0, interval: float = 5.0
) -> float:
    """Poll `count` until it gives `expected`; returns the seconds it took.

    More rows than expected is an error, and so is running out of time.
    """
    start = time.monotonic()
    while True:
        actual = count()
        elapsed = time.monotonic() - start
        if actual == expected:
            return elapsed
        if actual > expected:
            raise ValueError(f"{actual} rows, more than the {expected} expected")
        if elapsed + interval > timeout:
            raise TimeoutError(f"{actual} of {expected} rows after {elapsed:.0f} s")
        time.sleep(interval)


def watch_log(
    log: Callable[[], DataFrame] | ParquetLog, n: int = 100, loops: int = 1, interval: float = 1.0
) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Look at a log `loops` times; yields its tail and its statistics whenever a new record has come in.

    A `ParquetLog` is looked at by its newest batches and by file footers: nothing is read while nothing is new. Of
    others, such as a topic, `log` is their scan.
    """
    seen: dict[int, int] | int = {}
    for i in range(loops):
        if i:
            time.sleep(interval)
        if isinstance(log, ParquetLog):
            newest = log.next_number() if log.batches(1) else {}
            if newest != seen:
                seen = newest
                yield log.tail(n), log.counts()
            continue
        log_now = log()
        stats = log_stats(log_now)
        # one row per log partition
        newest = {r["partition"]: r["max_offset"] for r in stats.collect()}
        if newest != seen and newest:
            seen = newest
            yield log_tail(log_now, n), stats
