"""One query per operator, each over whole tables of the data folder.

Queries that need files of their own (logs, tables, CSV folders) write them under `spark.checkpoint.dir`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyed_lake.functions.codec import BAD, decode, encode, encode_key, encode_value, typed, with_partition_date
from keyed_lake.operators.dedup import compact, keep_latest, keep_latest_text
from keyed_lake.operators.merge import merge_frames
from keyed_lake.operators.replay import replay
from keyed_lake.operators.stats import batch_stats, count_rows, log_stats
from keyed_lake.sources.changelog import ParquetLog
from keyed_lake.sources.csv import ARCHIVE_FOLDER
from keyed_lake.sources.table import ParquetTable, export_csv
from keyed_lake.spec import PARTITION_COLUMN, TableSpec, parse_specs
from keyed_lake.storage import scratch_folder
from keyed_lake.streaming.audit import AUDIT_SCHEMA, ProgressAudit, audit_records, read_audit, wait_for_count, watch_log
from keyed_lake.streaming.pipelines import (
    apply_all,
    apply_log,
    await_all,
    compact_stream,
    csv_to_records,
    ingest_all,
    ingest_csv,
    rekey_log,
    rekey_newest,
    rekey_records,
)

SPECS = parse_specs(
    """
    <tableInfos>
        <table name="events">
            <csvFolder>events</csvFolder><topic>events</topic><deltaFolder>events</deltaFolder>
            <columns>EVENT_ID,TS,USER_ID,EVENT_TYPE,VALUE,PROPS</columns>
            <pks>user_id</pks>
            <types>long,timestamp,long,string,double,string</types>
            <partitionBy>ts</partitionBy><orderBy>ts</orderBy>
        </table>
        <table name="orders">
            <csvFolder>orders</csvFolder><topic>orders</topic><deltaFolder>orders</deltaFolder>
            <columns>o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority</columns>
            <pks>o_custkey</pks>
            <types>long,long,string,double,timestamp,string</types>
            <orderBy>o_orderdate,o_orderkey</orderBy>
        </table>
        <table name="lineitem">
            <csvFolder>lineitem</csvFolder><topic>lineitem</topic><deltaFolder>lineitem</deltaFolder>
            <columns>l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,l_discount,l_tax,
                l_returnflag,l_linestatus,l_shipdate</columns>
            <pks>l_orderkey,l_linenumber</pks>
            <types>long,long,long,int,double,double,double,double,str,str,time</types>
            <partitionBy>l_shipdate</partitionBy><orderBy>l_shipdate</orderBy>
        </table>
        <table name="documents">
            <csvFolder>documents</csvFolder><topic>documents</topic><deltaFolder>documents</deltaFolder>
            <columns>doc_id,text,lang,source,n_chars</columns>
            <pks>doc_id</pks>
            <types>long,string,string,string,long</types>
            <orderBy>doc_id</orderBy>
        </table>
    </tableInfos>
    """
)
EVENTS = SPECS["events"]
CUT = "2024-01-21"
EARLIER_CUT = "2024-01-15"
_MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, its timestamps as the specs declare them."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    spec = SPECS[name]
    return df.select(*[F.col(c).cast(spec.type_of(c)).alias(c) for c in spec.columns])


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the input tables have them."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events")


def dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_partition_date(events(spark, sf_dir), EVENTS)


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def _events_log(spark: SparkSession, sf_dir: str, name: str) -> ParquetLog:
    """Events in a stored log, in the order of their ids: key user_id, value event_id, ten partitions."""
    log = _new_log(spark, name)
    records = events(spark, sf_dir).select(
        F.col("user_id").alias("key"), F.col("event_id").alias("value"), F.col("ts").alias("timestamp"), "event_id"
    )
    log.append(records, "whole", 0, order_by=["event_id"])
    return log


def _table(spark: SparkSession, spec: TableSpec, name: str) -> ParquetTable:
    return ParquetTable(spark, scratch_folder(spark, name), spec).create()


def _slices(df: DataFrame, n: int) -> list[DataFrame]:
    """The whole input in n batches."""
    return [df.where(F.col("event_id") % n == i) for i in range(n)]


# dedup


def keep_latest_events(spark, sf_dir):
    return plain(keep_latest(dated(spark, sf_dir), ["user_id"], ["ts"], ["event_id"]))


def keep_latest_lineitem(spark, sf_dir):
    spec = SPECS["lineitem"]
    return plain(keep_latest(load(spark, sf_dir, "lineitem"), spec.pks, spec.order_by))


def keep_latest_text_compat(spark, sf_dir):
    """Text order: event 9 comes after event 10."""
    spec = replace(EVENTS, order_by=("event_id",))
    return keep_latest_text(as_text(events(spark, sf_dir)), spec, "compat").select("user_id", "event_id", "event_type")


def keep_latest_text_typed(spark, sf_dir):
    spec = replace(EVENTS, order_by=("event_id",))
    return keep_latest_text(as_text(events(spark, sf_dir)), spec).select("user_id", "event_id", "event_type")


def keep_latest_ties(spark, sf_dir):
    """Text rows whose order column ties: part 10 beats part 9, as it does among typed rows."""
    spec = SPECS["lineitem"]
    rows = keep_latest_text(as_text(load(spark, sf_dir, "lineitem")), spec)
    return plain(rows.select(*[typed(c, spec.type_of(c)).alias(c) for c in spec.columns]))


def compact_records(spark, sf_dir):
    """The last record of every key of a stored log, in the order of the event ids."""
    return compact(_events_log(spark, sf_dir, "compact-records").scan()).select("key", "value")


# codec


def partition_date(spark, sf_dir):
    """Every seventh timestamp text is damaged; its date must be NULL and the rest unharmed."""
    damaged = F.when(F.col("event_id") % 7 == 0, F.lit("bad")).otherwise(F.col("ts"))
    rows = as_text(events(spark, sf_dir)).withColumn("ts", damaged)
    return count_rows(with_partition_date(rows, EVENTS), [PARTITION_COLUMN])


def encode_key_compat(spark, sf_dir):
    spec = replace(EVENTS, pks=("user_id", "event_type"))
    return events(spark, sf_dir).select("event_id", encode_key(spec, "compat").alias("key"))


def encode_key_safe(spark, sf_dir):
    spec = replace(EVENTS, pks=("user_id", "event_type"))
    return events(spark, sf_dir).select("event_id", encode_key(spec).alias("key"))


def encode_value_compat(spark, sf_dir):
    return dated(spark, sf_dir).select("event_id", encode_value(EVENTS, "compat").alias("value"))


def encode_value_safe(spark, sf_dir):
    return dated(spark, sf_dir).select("event_id", encode_value(EVENTS).alias("value"))


def codec_roundtrip_compat(spark, sf_dir):
    rows = decode(encode(dated(spark, sf_dir), EVENTS, "compat"), EVENTS, "compat")
    return plain(rows.select(*EVENTS.table_columns))


def codec_roundtrip_safe(spark, sf_dir):
    rows = decode(encode(dated(spark, sf_dir), EVENTS), EVENTS)
    return plain(rows.where(~F.col(BAD)).select(*EVENTS.table_columns))


def codec_roundtrip_documents(spark, sf_dir):
    """Whole texts with commas, quotes and line breaks."""
    spec = SPECS["documents"]
    rows = decode(encode(load(spark, sf_dir, "documents"), spec), spec)
    return rows.where(~F.col(BAD)).select(*spec.columns)


def _damaged_value(mode: str) -> Column:
    """Every fifth record has a broken number in `value`."""
    broken = F.when(F.col("event_id") % 5 == 0, F.lit("bad")).otherwise(F.col("value").cast("string"))
    fields = [F.col(c).cast("string") if c != "value" else broken for c in EVENTS.table_columns]
    if mode == "compat":
        return F.concat_ws(",", *fields)
    return F.to_json(F.array(*fields))


def decode_malformed(spark, sf_dir):
    """Compat: the broken token alone is NULL."""
    records = dated(spark, sf_dir).select(_damaged_value("compat").alias("value"))
    return plain(decode(records, EVENTS, "compat").select(*EVENTS.columns))


def decode_quarantine(spark, sf_dir):
    """Safe: the broken records are marked."""
    records = dated(spark, sf_dir).select(_damaged_value("safe").alias("value"))
    return decode(records, EVENTS).select("event_id", F.col(BAD).alias("bad"), F.col("value").alias("number"))


def spec_decode(spark, sf_dir):
    """Spec-driven typing of text rows: per column its type, role and number of values."""
    spec = SPECS["lineitem"]
    text = as_text(load(spark, sf_dir, "lineitem"))
    counts = text.select(*[F.count(typed(c, spec.type_of(c))).alias(c) for c in spec.columns])
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(spec.type_of(c).simpleString()).alias("type_name"),
                F.lit(c in spec.pks).alias("is_pk"),
                F.col(c).alias("n_values"),
            )
            for c in spec.columns
        ]
    )
    return counts.select(F.explode(rows).alias("r")).select("r.*")


# merge


def _base_and_batch(spark, sf_dir):
    """Base: latest row per user and day before the cut. Batch: all rows from the earlier cut on."""
    rows = dated(spark, sf_dir)
    before = rows.where(F.col("ts") < F.lit(CUT).cast("timestamp"))
    base = keep_latest(before, ["user_id", PARTITION_COLUMN], ["ts"], ["event_id"])
    return base, rows.where(F.col("ts") >= F.lit(EARLIER_CUT).cast("timestamp"))


def _merge_tables(spark, sf_dir, scope):
    table = _table(spark, EVENTS, f"merge-{scope}")
    base, batch = _base_and_batch(spark, sf_dir)
    table.merge(base, scope="partition")
    table.merge(batch, scope=scope)
    return plain(table.read())


def merge_batch_scope(spark, sf_dir):
    return _merge_tables(spark, sf_dir, "batch")


def merge_partition_scope(spark, sf_dir):
    return _merge_tables(spark, sf_dir, "partition")


def touched_partitions(spark, sf_dir):
    """The part of a table that a batch may touch: only the partitions of the batch's dates are read."""
    table = _table(spark, EVENTS, "touched")
    rows = dated(spark, sf_dir)
    table.merge(rows, scope="partition")
    batch = rows.where(F.col("ts") >= F.lit(CUT).cast("timestamp"))
    return count_rows(table.read(batch_stats(batch).dates), [PARTITION_COLUMN])


def merge_global(spark, sf_dir):
    table = _table(spark, EVENTS, "merge-global")
    rows = dated(spark, sf_dir)
    late = F.col("ts") >= F.lit(CUT).cast("timestamp")
    table.merge(rows.where(~late), scope="global")
    table.merge(rows.where(late), scope="global")
    return plain(table.read())


def merge_frames_batch_scope(spark, sf_dir):
    base, batch = _base_and_batch(spark, sf_dir)
    updates = keep_latest(batch, ["user_id"], ["ts"], ["event_id"])
    return plain(merge_frames(base, updates, ["user_id"], "batch", dates=batch.select(PARTITION_COLUMN)))


def merge_frames_global(spark, sf_dir):
    base, batch = _base_and_batch(spark, sf_dir)
    return plain(merge_frames(base, keep_latest(batch, ["user_id"], ["ts"], ["event_id"]), ["user_id"], "global"))


def merge_unpartitioned(spark, sf_dir):
    """Latest order per customer, in two batches by order status."""
    spec = SPECS["orders"]
    table = _table(spark, spec, "merge-unpartitioned")
    rows = load(spark, sf_dir, "orders")
    open_orders = F.col("o_orderstatus") == "O"
    table.merge(rows.where(~open_orders), scope="global")
    table.merge(rows.where(open_orders), scope="global")
    return plain(table.read())


def merge_lineitem(spark, sf_dir):
    """Composite key with duplicates, many partitions; second batch holds the returned lines."""
    spec = SPECS["lineitem"]
    table = _table(spark, replace(spec, name="lineitem_month"), "merge-lineitem")
    rows = load(spark, sf_dir, "lineitem").withColumn(
        PARTITION_COLUMN, F.trunc(F.col("l_shipdate").cast("date"), "month")
    )
    returned = F.col("l_returnflag") == "R"
    table.merge(rows.where(~returned), scope="global")
    table.merge(rows.where(returned), scope="global")
    return plain(table.read())


def merge_batches(spark, sf_dir):
    table = _table(spark, EVENTS, "merge-batches")
    for i, batch in enumerate(_slices(dated(spark, sf_dir), 4)):
        table.merge(batch, scope="global", stream="batches", batch_id=i)
    return plain(table.read())


def merge_newest_guard(spark, sf_dir):
    table = _table(spark, replace(EVENTS, order_by=("ts", "event_id")), "merge-newest")
    for batch in reversed(_slices(dated(spark, sf_dir), 4)):
        table.merge(batch, scope="global", on_conflict="newest")
    return plain(table.read())


def replay_idempotent(spark, sf_dir):
    """Three copies of every row, merged twice."""
    table = _table(spark, EVENTS, "replay")
    batch = replay(dated(spark, sf_dir), 3)
    table.merge(batch, scope="global")
    table.merge(batch, scope="global")
    return plain(table.read())


# logs


def _append_slices(spark, sf_dir, log: ParquetLog, n: int) -> None:
    for i, batch in enumerate(_slices(events(spark, sf_dir), n)):
        log.append(csv_to_records(as_text(batch), EVENTS), "slices", i)


def _new_log(spark, name: str, topic: str = "events") -> ParquetLog:
    return ParquetLog(spark, scratch_folder(spark, name)).create(topic)


def compact_log(spark, sf_dir):
    """Four batches appended to a log, then reduced to the last record per key."""
    log = _new_log(spark, "compact")
    _append_slices(spark, sf_dir, log, 4)
    target = ParquetLog(spark, scratch_folder(spark, "compacted"))
    log.compact_into(target)
    return plain(decode(target.scan(), EVENTS).select(*EVENTS.table_columns))


def compact_continuous(spark, sf_dir):
    """Four batches, compacted by a stream that is stopped and started again after two: the last record per key."""
    log = _new_log(spark, "compact-stream")
    target = ParquetLog(spark, scratch_folder(spark, "compacted-stream"))
    work = scratch_folder(spark, "compact-stream-cp")
    for i, batch in enumerate(_slices(events(spark, sf_dir), 4)):
        log.append(csv_to_records(as_text(batch), EVENTS), "slices", i)
        if i % 2:
            compact_stream(spark, log, target, f"{work}/cp", available_now=True).awaitTermination()
    return plain(decode(compact(target.scan()), EVENTS).select(*EVENTS.table_columns))


def log_tail_query(spark, sf_dir):
    """The newest records of a log of four batches; only batches that may hold one are opened."""
    log = _new_log(spark, "tail")
    rows = events(spark, sf_dir)
    quarter = F.ntile(4).over(Window.orderBy("event_id"))
    bounds = rows.select("event_id", quarter.alias("q")).groupBy("q").agg(F.max("event_id").alias("last")).orderBy("q").collect()
    first = None
    for i, (_, last) in enumerate(bounds):
        part = rows.where(F.col("event_id") <= last)
        part = part if first is None else part.where(F.col("event_id") > first)
        first = last
        records = part.select(F.col("user_id").alias("key"), F.col("event_id").alias("value"), "event_id")
        log.append(records, "quarters", i, order_by=["event_id"])
    return log.tail(100).select("key", "value")


def log_counts(spark, sf_dir):
    """Records of a log by file footers, and the newest record."""
    log = _events_log(spark, sf_dir, "counts")
    records = log.counts().agg(F.sum("records")).head()[0]
    return log.tail(1).select(F.lit(records).alias("records"), F.col("value").alias("last_value"))


def log_stats_query(spark, sf_dir):
    """Records over all log partitions, and the event at the greatest offset."""
    log = _events_log(spark, sf_dir, "stats").scan()
    stats = log_stats(log).agg(F.sum("records").alias("records"), F.max("max_offset").alias("offset"))
    return stats.join(log.select("offset", "value"), "offset").select("records", F.col("value").alias("last_value"))


def compact_incremental(spark, sf_dir):
    """Append, compact, append, compact: what a stream that follows the compacted log puts into its table."""
    work = scratch_folder(spark, "compact-incremental")
    log = _new_log(spark, "compact-source")
    target = ParquetLog(spark, f"{work}/compacted")
    table = ParquetTable(spark, f"{work}/table", EVENTS)
    for i, batch in enumerate(_slices(events(spark, sf_dir), 4)):
        log.append(csv_to_records(as_text(batch), EVENTS), "slices", i)
        if i % 2:
            log.compact_into(target)
            apply_log(
                spark, EVENTS, target, table, f"{work}/cp", scope="global", start="earliest", available_now=True
            ).awaitTermination()
    return plain(table.read())


def log_watch(spark, sf_dir):
    """What a look at a log of all events reports: the number of records, over all log partitions."""
    log = _new_log(spark, "watch")
    log.append(encode(dated(spark, sf_dir), EVENTS), "whole", 0)
    _, stats = next(watch_log(log))
    return stats.agg(F.sum("records").alias("records"))


# streams


def _write_csv(spark, sf_dir) -> str:
    root = scratch_folder(spark, "csv")
    rows = events(spark, sf_dir).withColumn("ts", F.date_format("ts", _MICROS))
    rows.write.option("escape", '"').csv(f"{root}/{EVENTS.csv_folder}/first")
    return root


def _csv_to_log(spark, sf_dir, work: str) -> ParquetLog:
    log = ParquetLog.for_spec(spark, f"{work}/logs", EVENTS)
    # the writer doubles quotes inside a field, as most CSV exporters do
    query = ingest_csv(
        spark, EVENTS, _write_csv(spark, sf_dir), log, f"{work}/cp-ingest", available_now=True,
        csv_options={"escape": '"'},
    )
    query.awaitTermination()
    return log


def ingest_csv_query(spark, sf_dir):
    log = _csv_to_log(spark, sf_dir, scratch_folder(spark, "ingest"))
    return plain(decode(log.scan(), EVENTS).select(*EVENTS.table_columns))


def archived_csv(spark, sf_dir):
    """All events as CSV files, ingested file by file: what lies in the archive and what is still in place are all lines."""
    work = scratch_folder(spark, "archive")
    for i, batch in enumerate(_slices(events(spark, sf_dir).withColumn("ts", F.date_format("ts", _MICROS)), 4)):
        batch.coalesce(1).write.option("escape", '"').csv(f"{work}/csv/{EVENTS.csv_folder}/{i}")
    log = ParquetLog.for_spec(spark, f"{work}/logs", EVENTS)
    for _ in range(2):  # the second start moves what the first left
        ingest_csv(
            spark, EVENTS, f"{work}/csv", log, f"{work}/cp", max_files_per_trigger=1, csv_options={"escape": '"'},
            available_now=True,
        ).awaitTermination()
    lines = spark.read.schema(EVENTS.row_schema).option("escape", '"').option("recursiveFileLookup", "true")
    return plain(lines.option("pathGlobFilter", "*.csv").csv([f"{work}/csv/{EVENTS.csv_folder}", f"{work}/csv/{ARCHIVE_FOLDER}"]))


def csv_to_table(spark, sf_dir):
    """CSV files to log to table, both steps as streams."""
    work = scratch_folder(spark, "pipeline")
    log = _csv_to_log(spark, sf_dir, work)
    table = ParquetTable(spark, f"{work}/table", EVENTS)
    apply_log(
        spark, EVENTS, log, table, f"{work}/cp-apply", scope="global", start="earliest", available_now=True
    ).awaitTermination()
    return plain(table.read())


def _apply(spark, sf_dir, name: str) -> ParquetTable:
    work = scratch_folder(spark, name)
    log = ParquetLog(spark, f"{work}/log").create("events")
    _append_slices(spark, sf_dir, log, 5)
    table = ParquetTable(spark, f"{work}/table", EVENTS)
    spec = replace(EVENTS, max_offsets_per_trigger=1)  # one log file per micro-batch
    apply_log(
        spark, spec, log, table, f"{work}/cp", scope="global", start="earliest", audit=f"{work}/audit",
        available_now=True,
    ).awaitTermination()
    return table


def apply_stream(spark, sf_dir):
    return plain(_apply(spark, sf_dir, "apply").read())


def audit_stream(spark, sf_dir):
    """Rows merged in all micro-batches, per partition date that occurred in one of them.

    The audit rows go through a log as JSON records first.
    """
    table = _apply(spark, sf_dir, "audit")
    log = _new_log(spark, "audit-log", "log")
    log.append(audit_records(read_audit(spark, table.path.removesuffix("/table") + "/audit")), "audit", 0)
    audit = log.scan().select(F.from_json("value", AUDIT_SCHEMA).alias("a")).select("a.*")
    dates = audit.select(F.explode("partition_values").alias(PARTITION_COLUMN)).distinct()
    total = audit.agg(F.sum("batch_size")).head()[0]
    return dates.select(F.col(PARTITION_COLUMN).cast("date").alias(PARTITION_COLUMN), F.lit(total).alias("merged_rows"))


def audit_times(spark, sf_dir):
    """Batches of a stream whose audit times are out of order, and the rows that all merged."""
    audit = read_audit(spark, _apply(spark, sf_dir, "audit-times").path.removesuffix("/table") + "/audit")
    ordered = F.col("fetch_time").between(F.col("log_time"), F.col("partition_time"))
    ordered = ordered & (F.col("partition_time") <= F.col("merge_time"))
    return audit.agg(F.count_if(~ordered).alias("out_of_order"), F.sum("batch_size").alias("merged_rows"))


def rekey_query(spark, sf_dir):
    return rekey_records(events(spark, sf_dir), "event_type", "value")


def rekey_dedup(spark, sf_dir):
    return rekey_records(events(spark, sf_dir), "event_type", "value", ["user_id"], ["ts", "event_id"])


def _rekey_stream(spark, sf_dir, dedup: bool) -> DataFrame:
    work = scratch_folder(spark, "rekey")
    source = ParquetLog(spark, f"{work}/source").create("events")
    source.append(encode(dated(spark, sf_dir), EVENTS), "whole", 0)
    target = ParquetLog(spark, f"{work}/target").create("types", partitions=4)
    rekey_log(
        spark, EVENTS, source, target, f"{work}/cp", "event_type", "value", dedup=dedup, available_now=True
    ).awaitTermination()
    return target.scan().select("key", "value")


def rekey_stream(spark, sf_dir):
    return _rekey_stream(spark, sf_dir, False)


def rekey_stream_dedup(spark, sf_dir):
    return _rekey_stream(spark, sf_dir, True)


def rekey_state(spark, sf_dir):
    """Every event by type, in three log batches that overlap in time: what a reader of the new log holds per user.

    A record that is older than one before would take its place; `late` counts those.
    """
    work = scratch_folder(spark, "rekey-state")
    spec = replace(EVENTS, order_by=("ts", "event_id"), max_offsets_per_trigger=1)
    source = ParquetLog(spark, f"{work}/source").create("events")
    target = ParquetLog(spark, f"{work}/target").create("types")
    payload = F.to_json(F.struct("user_id", "event_id", F.unix_micros("ts").alias("at"), "value"))
    for i, batch in enumerate(_slices(dated(spark, sf_dir), 3)):
        source.append(encode(batch, spec), "slices", i)
        await_all(spark, rekey_newest(
            spark, spec, source, target, f"{work}/cp", "event_type", payload, "3650 days", available_now=True
        ))
    fields = "user_id long, event_id long, at long, value double"
    rows = target.scan().select("key", "offset", F.from_json("value", fields).alias("r")).select("key", "offset", "r.*")
    before = F.lag(F.struct("at", "event_id")).over(Window.partitionBy("user_id").orderBy("offset"))
    rows = rows.withColumn("late", before > F.struct("at", "event_id"))
    held = rows.groupBy("user_id").agg(
        F.max_by(F.struct("key", "event_id", "value"), "offset").alias("r"), F.count_if("late").alias("late")
    )
    return held.select("user_id", F.col("r.key").alias("event_type"), "r.event_id", "r.value", "late")


def audit_observed(spark, sf_dir):
    """Rows and bad rows of all micro-batches as the stream observed them, and batches with times out of order."""
    work = scratch_folder(spark, "audit-observed")
    log = ParquetLog(spark, f"{work}/log").create("events")
    _append_slices(spark, sf_dir, log, 3)
    junk = events(spark, sf_dir).where("event_id % 10 = 0").select(F.col("user_id").alias("key"), F.lit("junk").alias("value"))
    log.append(junk, "junk", 0)
    table = ParquetTable(spark, f"{work}/table", EVENTS)
    audit = ProgressAudit(spark, f"{work}/audit")
    spark.streams.addListener(audit)
    try:
        query = apply_log(
            spark, replace(EVENTS, max_offsets_per_trigger=1), log, table, f"{work}/cp", scope="global", start="earliest",
            audit=audit, available_now=True,
        )
        query.awaitTermination()
        audit.wait(query)
    finally:
        spark.streams.removeListener(audit)
    late = (F.col("log_time") > F.col("fetch_time")) | (F.col("merge_ms") > F.col("batch_ms"))
    return audit.read().agg(
        F.sum("batch_size").alias("records"), F.sum("bad_rows").alias("bad_records"), F.count_if(late).alias("out_of_order")
    )


def rekey_then_apply(spark, sf_dir):
    """Every event under a new key in another log, applied one file at a time: the last event of each type stays."""
    work = scratch_folder(spark, "rekey-apply")
    source = ParquetLog(spark, f"{work}/source").create("events")
    rows = events(spark, sf_dir)
    spec = replace(EVENTS, name="numbers", pks=("event_id",), order_by=("event_id",), partition_by=None)
    for i, batch in enumerate(_slices(rows, 3)):
        records = batch.select(encode_key(spec).alias("key"), encode_value(spec).alias("value"), "event_id")
        source.append(records, "slices", i, ["event_id"], 1000)
    target = ParquetLog(spark, f"{work}/target").create("types")
    by_type = F.to_json(F.array("event_type", F.col("event_id").cast("string")))
    rekey_log(spark, spec, source, target, f"{work}/cp-re", "event_type", by_type, available_now=True).awaitTermination()
    types = TableSpec(
        "types", columns=("event_type", "event_id"), types=(T.StringType(), T.LongType()), pks=("event_type",), order_by=("event_type",),
        max_offsets_per_trigger=1,
    )
    table = ParquetTable(spark, f"{work}/table", types)
    apply_log(
        spark, types, target, table, f"{work}/cp", scope="global", start="earliest", available_now=True
    ).awaitTermination()
    return table.read()


def ingest_quarantine(spark, sf_dir):
    """All events as CSV, some lines damaged: good rows in the log (one a key) and lines put aside, by kind of damage."""
    work = scratch_folder(spark, "ingest-quarantine")
    spec = replace(EVENTS, pks=("event_id",), order_by=("event_id",))
    rows = events(spark, sf_dir).withColumn("ts", F.date_format("ts", _MICROS))
    kind = F.col("event_id") % 10
    text = F.concat_ws(
        ",", F.when(kind == 3, F.lit("")).otherwise(F.col("event_id").cast("string")),
        F.when(kind == 5, F.lit("soon")).otherwise(F.col("ts")),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("user_id", "event_type", "value")],
        F.translate(F.coalesce("props", F.lit("")), ',"', ";'"),
        F.when(kind == 7, F.lit("surplus")),
    )
    rows.select(text.alias("line")).write.text(f"{work}/csv/events/first")
    log = ParquetLog.for_spec(spark, f"{work}/logs", spec)
    aside = f"{work}/aside"
    ingest_csv(spark, spec, f"{work}/csv", log, f"{work}/cp", quarantine=aside, available_now=True).awaitTermination()
    bad = spark.read.parquet(aside)
    kinds = (
        F.when(F.col("_corrupt").isNotNull(), F.lit("fields")).when(F.col("event_id").isNull(), F.lit("key")).otherwise(F.lit("type"))
    )
    good = decode(log.scan(), spec).select(F.lit("good").alias("kind"))
    return count_rows(bad.select(kinds.alias("kind")).unionByName(good), ["kind"])


def apply_latest(spark, sf_dir):
    """A stream from the end of the log on, stopped and started after every batch: all but the first batch."""
    work = scratch_folder(spark, "apply-latest")
    log = ParquetLog(spark, f"{work}/log").create("events")
    table = ParquetTable(spark, f"{work}/table", EVENTS)
    for i, batch in enumerate(_slices(events(spark, sf_dir), 3)):
        log.append(csv_to_records(as_text(batch), EVENTS), "slices", i)
        apply_log(spark, EVENTS, log, table, f"{work}/cp", scope="global", available_now=True).awaitTermination()
    return plain(table.read())


def merge_empty_batches(spark, sf_dir):
    """Batches of every eighth hour, those without an event among them; an empty one leaves the table as it is."""
    table = _table(spark, EVENTS, "merge-empty")
    rows = dated(spark, sf_dir)
    skipped = 0
    for hour in (0, 8, 24, 16):
        batch = rows.where(F.hour("ts").between(hour, hour + 7))
        skipped += table.merge(batch, scope="global", stream="hours", batch_id={0: 0, 8: 1, 24: 2, 16: 3}[hour]).skipped
    return plain(table.read()).withColumn("skipped", F.lit(skipped))


def table_date_counts(spark, sf_dir):
    """Rows, least and greatest key per date of a table of all events, from the footers of its files."""
    spec = replace(EVENTS, pks=("event_id",), order_by=("event_id",))
    table = _table(spark, spec, "date-counts")
    table.merge(dated(spark, sf_dir), scope="partition")
    return table.counts(extremes=["event_id"])


def apply_stream_batch_scope(spark, sf_dir):
    """Three log batches, each latest per user and applied by itself, in the scope of its own dates."""
    return plain(_scoped(spark, sf_dir, "batch", "safe").read())


def apply_stream_compat(spark, sf_dir):
    return plain(_scoped(spark, sf_dir, "batch", "compat").read())


def _scoped(spark, sf_dir, scope: str, mode: str) -> ParquetTable:
    work = scratch_folder(spark, f"scope-{scope}-{mode}")
    log = ParquetLog(spark, f"{work}/log").create("events")
    spec = replace(EVENTS, order_by=("ts", "event_id"))
    table = ParquetTable(spark, f"{work}/table", spec)
    # without commas, which the compat form can't carry
    rows = events(spark, sf_dir).withColumn("props", F.translate("props", ',"', ";'"))
    for i, batch in enumerate(_slices(rows, 3)):
        log.append(csv_to_records(as_text(batch), spec, mode), "slices", i)
        # stopped and started again after every batch
        apply_log(
            spark, spec, log, table, f"{work}/cp", mode=mode, scope=scope, start="earliest", available_now=True
        ).awaitTermination()
    return table


def apply_stream_unpartitioned(spark, sf_dir):
    """Orders, latest per customer, by two batches of order status."""
    work = scratch_folder(spark, "apply-unpartitioned")
    spec = SPECS["orders"]
    log = ParquetLog(spark, f"{work}/log").create("orders")
    table = ParquetTable(spark, f"{work}/table", spec)
    rows = load(spark, sf_dir, "orders")
    is_open = F.col("o_orderstatus") == "O"
    for i, batch in enumerate([rows.where(~is_open), rows.where(is_open)]):
        log.append(encode(keep_latest(batch, spec.pks, spec.order_by), spec), "status", i)
        apply_log(
            spark, spec, log, table, f"{work}/cp", scope="global", start="earliest", available_now=True
        ).awaitTermination()
    return plain(table.read())


def run_all(spark, sf_dir):
    """Three tables in one run, CSV folders to tables: rows and keys of each."""
    work = scratch_folder(spark, "run-all")
    specs = {
        "events": EVENTS,
        "orders": replace(SPECS["orders"], pks=("o_orderkey",)),
        "documents": SPECS["documents"],
    }
    for name, spec in specs.items():
        rows = load(spark, sf_dir, name).select(*[F.col(c) for c in spec.columns])
        text = rows.select(*[F.date_format(c, _MICROS).alias(c) if isinstance(t, T.TimestampType) else F.col(c) for c, t in zip(spec.columns, spec.types)])
        # files whose fields may hold line ends are read whole by one task, compressed or not
        text.write.option("escape", '"').option("compression", "gzip").csv(f"{work}/csv/{spec.csv_folder}/first")
    await_all(spark, ingest_all(
        spark, specs, f"{work}/csv", f"{work}/logs", f"{work}/cp", available_now=True,
        csv_options={"escape": '"', "multiLine": "true"},
    ))
    await_all(spark, apply_all(
        spark, specs, f"{work}/logs", f"{work}/tables", f"{work}/cp", f"{work}/compacted", start="earliest",
        scope="global", available_now=True,
    ))
    out = None
    for name, spec in specs.items():
        table = ParquetTable(spark, f"{work}/tables/{spec.table_folder or name}", spec).read()
        counts = table.agg(F.lit(name).alias("name"), F.count("*").alias("records"), F.sum(spec.pks[0]).alias("key_sum"))
        out = counts if out is None else out.unionByName(counts)
    return out


# export and counts


def export_roundtrip(spark, sf_dir):
    spec = replace(SPECS["orders"], pks=("o_orderkey",))
    table = _table(spark, spec, "export")
    table.merge(load(spark, sf_dir, "orders"), scope="global")
    target = scratch_folder(spark, "csv-out") + "/orders"
    export_csv(table.read(), target)
    return plain(spark.read.schema(spec.row_schema).csv(target))


def table_counts(spark, sf_dir):
    """Orders per year, counted in a table once it holds as many rows as were merged."""
    spec = replace(SPECS["orders"], pks=("o_orderkey",))
    table = _table(spark, spec, "counts")
    orders = load(spark, sf_dir, "orders")
    table.merge(orders, scope="global")
    wait_for_count(lambda: table.read().count(), orders.count(), timeout=60)
    return count_rows(table.read(), [F.year("o_orderdate").alias("order_year")])


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "keep_latest_events": keep_latest_events,
        "keep_latest_lineitem": keep_latest_lineitem,
        "keep_latest_text_compat": keep_latest_text_compat,
        "keep_latest_text_typed": keep_latest_text_typed,
        "keep_latest_ties": keep_latest_ties,
        "compact_records": compact_records,
        "partition_date": partition_date,
        "encode_key_compat": encode_key_compat,
        "encode_key_safe": encode_key_safe,
        "encode_value_compat": encode_value_compat,
        "encode_value_safe": encode_value_safe,
        "codec_roundtrip_compat": codec_roundtrip_compat,
        "codec_roundtrip_safe": codec_roundtrip_safe,
        "codec_roundtrip_documents": codec_roundtrip_documents,
        "decode_malformed": decode_malformed,
        "decode_quarantine": decode_quarantine,
        "spec_decode": spec_decode,
        "merge_batch_scope": merge_batch_scope,
        "merge_partition_scope": merge_partition_scope,
        "touched_partitions": touched_partitions,
        "merge_global": merge_global,
        "merge_frames_batch_scope": merge_frames_batch_scope,
        "merge_frames_global": merge_frames_global,
        "merge_unpartitioned": merge_unpartitioned,
        "merge_lineitem": merge_lineitem,
        "merge_batches": merge_batches,
        "merge_newest_guard": merge_newest_guard,
        "replay_idempotent": replay_idempotent,
        "compact_log": compact_log,
        "compact_incremental": compact_incremental,
        "compact_stream": compact_continuous,
        "log_counts": log_counts,
        "rekey_state": rekey_state,
        "audit_observed": audit_observed,
        "archived_csv": archived_csv,
        "apply_latest": apply_latest,
        "merge_empty_batches": merge_empty_batches,
        "table_date_counts": table_date_counts,
        "log_tail": log_tail_query,
        "log_stats": log_stats_query,
        "log_watch": log_watch,
        "ingest_csv": ingest_csv_query,
        "csv_to_table": csv_to_table,
        "apply_stream": apply_stream,
        "audit_stream": audit_stream,
        "audit_times": audit_times,
        "rekey_then_apply": rekey_then_apply,
        "ingest_quarantine": ingest_quarantine,
        "apply_stream_batch_scope": apply_stream_batch_scope,
        "apply_stream_compat": apply_stream_compat,
        "apply_stream_unpartitioned": apply_stream_unpartitioned,
        "run_all": run_all,
        "rekey": rekey_query,
        "rekey_dedup": rekey_dedup,
        "rekey_stream": rekey_stream,
        "rekey_stream_dedup": rekey_stream_dedup,
        "export_roundtrip": export_roundtrip,
        "table_counts": table_counts,
    }
