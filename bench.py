"""Times the headline queries and the merge comparison at $BENCH_SF_DIR; prints one JSON line.

Both ways of the comparison begin with the same CSV batches of a change stream. `plain_merge` merges every raw batch
into the table. `log_pipeline` takes them through dedup, log and compaction first, then merges once.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyed_lake.functions.codec import BAD, decode, typed, with_partition_date
from keyed_lake.operators.replay import replay
from keyed_lake.plans import queries as plans
from keyed_lake.sources.changelog import ParquetLog
from keyed_lake.sources.table import ParquetTable
from keyed_lake.spec import parse_type
from keyed_lake.storage import scratch_folder
from keyed_lake.streaming.pipelines import csv_to_records

HEADLINE = [
    "keep_latest_events", "keep_latest_lineitem", "compact_records", "codec_roundtrip_safe", "codec_roundtrip_compat",
    "codec_roundtrip_documents", "merge_batch_scope", "merge_partition_scope", "merge_global", "merge_lineitem",
    "merge_batches", "compact_log", "ingest_csv", "csv_to_table", "rekey_stream_dedup", "export_roundtrip",
]
COPIES = 5
BATCHES = 10
SPEC = replace(
    plans.SPECS["lineitem"], columns=(*plans.SPECS["lineitem"].columns, "l_month"),
    types=(*plans.SPECS["lineitem"].types, parse_type("timestamp")), partition_by="l_month",
)


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(run, keep: list | None = None) -> float:
    start = time.perf_counter()
    result = run()
    if keep is not None:
        keep.append(result)
    return round(time.perf_counter() - start, 3)


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change stream: lines repeated, each copy of a line in a batch of its own."""
    lines = plans.load(spark, sf_dir, "lineitem")
    lines = lines.withColumn("l_month", F.date_trunc("month", "l_shipdate"))
    batch = F.pmod(F.hash(*SPEC.pks) + F.col("copy") * 3, F.lit(BATCHES))
    return replay(lines, COPIES, "copy").withColumn("batch_no", batch).drop("copy")


def plain_merge(spark: SparkSession, batches: list[DataFrame]) -> ParquetTable:
    table = ParquetTable(spark, scratch_folder(spark, "plain"), SPEC).create()
    for i, batch in enumerate(batches):
        rows = batch.select(*[typed(c, SPEC.type_of(c)).alias(c) for c in SPEC.columns])
        held = with_partition_date(rows, SPEC).persist()
        table.merge(held, stream="plain", batch_id=i)
        held.unpersist()
    return table


def log_pipeline(spark: SparkSession, batches: list[DataFrame]) -> ParquetTable:
    work = scratch_folder(spark, "pipeline")
    log = ParquetLog(spark, f"{work}/log").create("lineitem")
    compacted = ParquetLog(spark, f"{work}/compacted")
    table = ParquetTable(spark, f"{work}/table", SPEC).create()
    for i, batch in enumerate(batches):
        log.append(csv_to_records(batch, SPEC), "bench", i)
    log.compact_into(compacted)
    held = decode(compacted.scan(), SPEC).where(~F.col(BAD)).persist()
    table.merge(held, ties=["_log_offset"], stream="pipeline", batch_id=0)
    held.unpersist()
    return table


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    registered = plans.registered()
    drain(plans.keep_latest_events(spark, sf_dir))  # start-up costs count for no query
    seconds = {name: timed(lambda: drain(registered[name](spark, sf_dir))) for name in HEADLINE}

    raw = f"{scratch_folder(spark, 'changes')}/batches"
    # several files per batch, so that reading a batch uses all cores
    changes(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism).write.partitionBy("batch_no").csv(raw)
    batches = [spark.read.schema(SPEC.text_schema).csv(f"{raw}/batch_no={i}") for i in range(BATCHES)]
    rows = spark.read.schema(SPEC.text_schema).csv(raw).count()
    tables: list[ParquetTable] = []
    seconds["plain_merge"] = timed(lambda: plain_merge(spark, batches), tables)
    seconds["log_pipeline"] = timed(lambda: log_pipeline(spark, batches), tables)
    one, other = (t.read() for t in tables)
    for name, gone in (("plain_merge", one.exceptAll(other)), ("log_pipeline", other.exceptAll(one))):
        rest = gone.limit(5).collect()
        if rest:
            raise AssertionError(f"rows that only {name} has, such as {rest}")
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "merge_rows": rows,
        "plain_rows_per_sec": round(rows / seconds["plain_merge"]),
        "pipeline_rows_per_sec": round(rows / seconds["log_pipeline"]),
        "tables_equal": True,
        "pipeline_speedup": round(seconds["plain_merge"] / seconds["log_pipeline"], 2),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    sys.exit(main())
