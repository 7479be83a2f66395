"""Keyed changelogs and partition-wise table upserts on Spark."""

from keyed_lake.functions.codec import decode, encode, encode_key, encode_value, rekey, with_partition_date
from keyed_lake.operators.dedup import compact, keep_latest, keep_latest_text, latest_records
from keyed_lake.operators.merge import merge_frames
from keyed_lake.operators.replay import replay
from keyed_lake.operators.stats import batch_stats, count_rows, log_stats, log_tail, metadata_counts
from keyed_lake.sources.changelog import ParquetLog
from keyed_lake.sources.csv import csv_stream
from keyed_lake.sources.delta import DeltaTable
from keyed_lake.sources.kafka import KafkaLog
from keyed_lake.sources.table import ParquetTable, export_csv
from keyed_lake.spec import TableSpec, load_specs, parse_specs, parse_type
from keyed_lake.storage import scratch_folder
from keyed_lake.streaming.audit import ProgressAudit, append_audit, read_audit, wait_for_count, watch_log
from keyed_lake.streaming.pipelines import (
    apply_all,
    apply_log,
    await_all,
    compact_stream,
    ingest_all,
    ingest_csv,
    merge_batch,
    rekey_log,
    rekey_newest,
)

__all__ = [
    "DeltaTable", "KafkaLog", "ParquetLog", "ParquetTable", "TableSpec", "append_audit", "apply_all", "apply_log", "await_all", "batch_stats",
    "ProgressAudit", "compact", "compact_stream", "count_rows", "latest_records", "metadata_counts", "rekey_newest", "csv_stream", "decode", "encode", "encode_key", "encode_value", "export_csv",
    "ingest_all", "ingest_csv", "keep_latest", "keep_latest_text", "load_specs", "log_stats", "log_tail",
    "merge_batch", "merge_frames", "parse_specs", "parse_type", "read_audit", "rekey", "rekey_log", "replay",
    "scratch_folder", "wait_for_count", "watch_log", "with_partition_date",
]
