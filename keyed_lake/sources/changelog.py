"""A keyed, append-only log of text records, kept as Parquet files.

Layout of a log folder:

    settings.json                                             number of partitions, number of the first batch, ...
    _writers/<writer>                                         the last batch of a writer
    data/block=<n>/batch=<number>-<rows>-<bytes>-<writer>-<id>/   one folder per appended batch, 10,000 in a block
    _staging/...                                              batches being written

A batch is written aside and renamed into `data` when complete, in one step: a reader sees all of it or nothing. Before
that, the writer's last batch is noted with the name of its folder, so a batch that runs again is found whatever
others have written since.

An offset is the batch number times 2**64 and the row's place in the write, so offsets grow from batch to batch without
a limit on rows or tasks, but leave gaps, as in a compacted topic. Batch numbers go on when a log is created anew.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyed_lake.operators.dedup import compact
from keyed_lake.operators.stats import log_tail, metadata_counts
from keyed_lake.spec import TableSpec
from keyed_lake.storage import Files, needs_rename

LOG_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.DecimalType(38, 0)),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
LOG_COLUMNS = LOG_SCHEMA.fieldNames()
STREAM_SCHEMA = T.StructType(
    [*LOG_SCHEMA.fields, T.StructField("block", T.StringType()), T.StructField("batch", T.StringType())]
)
ROWS_PER_FILE = 1_000_000
STARTS = ("latest", "earliest")
COMPACTION = "compaction"  # the writer of compacted batches; streams add their id

_STEP = 1 << 64  # between the first offsets of two batches
_BLOCK = 10_000  # batches per block folder
_DIGITS, _BLOCK_DIGITS = 12, 8
_BYTES_PER_ROW = 32  # taken for a log without a batch to measure
_MEASURED = 1_000  # batches that the row size is measured over
_JOINED_BYTES = 256 << 20  # of a batch whose files are joined; the files of larger ones are left as they are
_FEW = 3  # files of a batch that are left as they are in any case
_FILE_BYTES = 64 << 20  # of a joined file, about
_GROUP_BYTES = 4 << 20  # of a row group, uncompressed: readers split a file by these, and a stream may take one file a trigger
_FILLED = 0.8  # share of its rows that a joined file is planned with, as ranges come out uneven


@dataclass(frozen=True)
class Appended:
    """The outcome of an append; `rows` is 0 when the batch was empty or there before."""

    rows: int
    end_offset: int | None
    skipped: bool = False


def partition_of(key: Column, partitions: int) -> Column:
    """The log partition of a key; the same key always gets the same partition."""
    return F.pmod(F.hash(key), F.lit(partitions)).cast("int")


def _row_offset(number: int) -> Column:
    """Offsets from the row's place in the write: increasing along the task order, without another shuffle."""
    first = F.lit(str(number * _STEP)).cast("decimal(38,0)")
    return (first + F.monotonically_increasing_id().cast("decimal(19,0)")).cast("decimal(38,0)")


def _numbers_from(number: int, digits: int) -> list[str]:
    """Glob patterns for all numbers of so many digits from `number` on."""
    text = f"{number:0{digits}d}"
    above = [
        f"{text[:i]}[{int(c) + 1}-9]{'?' * (digits - i - 1)}" for i, c in enumerate(text) if c != "9"
    ]
    return [text, *above]


class ParquetLog:
    """One log in one folder on any file system Spark can reach. Appends must come one after another."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.data = f"{self.path}/data"
        self.files = Files(spark)
        self._settings: dict | None = None

    @property
    def settings(self) -> dict:
        if self._settings is None:
            self._settings = json.loads(self.files.read_text(f"{self.path}/settings.json"))
        return self._settings

    def exists(self) -> bool:
        return self.files.exists(f"{self.path}/settings.json")

    def create(self, topic: str, partitions: int = 10, compact: bool = True, recreate: bool = False) -> ParquetLog:
        """Create the log if it is absent; `recreate=True` drops all records first."""
        needs_rename(self.path)
        if not isinstance(recreate, bool):
            raise TypeError(f"recreate must be True or False, not {recreate!r}")
        first, uid = 0, uuid.uuid4().hex
        if recreate and self.exists():
            first, uid = self.next_number(), self.settings.get("uid", uid)
            self.files.delete(self.path)
        if not self.exists():
            self.files.mkdirs(self.data)
            settings = {"topic": topic, "partitions": partitions, "compact": compact, "first": first, "uid": uid}
            self.files.publish_text(f"{self.path}/settings.json", json.dumps(settings))
        self._settings = None
        return self

    @classmethod
    def for_spec(cls, spark: SparkSession, root: str, spec: TableSpec, recreate: bool = False) -> ParquetLog:
        log = cls(spark, f"{root.rstrip('/')}/{spec.topic or spec.name}")
        return log.create(spec.topic or spec.name, spec.partitions, spec.compact, recreate)

    def _blocks(self) -> list[str]:
        return [name for name in self.files.names(self.data) if name.startswith("block=")]

    def batches(self, newest_blocks: int | None = None) -> list[str]:
        """The batch folders in append order, all of them or those of the newest blocks."""
        blocks = self._blocks()
        chosen = blocks if newest_blocks is None else blocks[-newest_blocks:]
        return [n for b in chosen for n in self.files.names(f"{self.data}/{b}") if n.startswith("batch=")]

    def _written(self, writer: str, batch_id: int) -> bool:
        """Whether a writer's batch is in the log: an earlier one than its last, or its last with its folder."""
        note = f"{self.path}/_writers/{writer}"
        if not self.files.exists(note):
            return False
        last = json.loads(self.files.read_text(note))
        return batch_id < last["batch"] or (batch_id == last["batch"] and self.files.exists(f"{self.data}/{last['folder']}"))

    def next_number(self) -> int:
        batches = self.batches(1)
        return _number(batches[-1]) + 1 if batches else self.settings.get("first", 0)

    def next_offset(self) -> int:
        return self.next_number() * _STEP

    def uid(self) -> str:
        """Names the log whose offsets can be compared; it stays when the log is created anew."""
        return self.settings.get("uid", self.path)

    def recorded_rows(self) -> int:
        """The number of records, as counted when they were appended; no file is opened."""
        return sum(int(b.split("-", 3)[1]) for b in self.batches())

    def append(
        self,
        records: DataFrame,
        writer: str,
        batch_id: int,
        order_by: list[str] | None = None,
        rows_per_file: int | None = None,
        keep_offsets: bool = False,
    ) -> Appended:
        """Append `key`, `value` (and optionally `timestamp`) records as one batch.

        The batches of a writer have rising ids and are written once. Records of one batch are ordered by `order_by` if
        given; this matters only when a key occurs more than once in the batch. With `keep_offsets`, whole log records
        keep their partition and offset, as in a compacted log.
        """
        if "-" in str(batch_id):
            raise ValueError("batch_id must not be negative")
        if self._written(writer, batch_id):
            return Appended(0, None, skipped=True)
        stamp = F.col("timestamp").cast("timestamp") if "timestamp" in records.columns else F.current_timestamp()
        if order_by:
            # a range sort splits by the full order, so a frequent key does not end in one task
            records = records.orderBy(*order_by)
        number = self.next_number()
        key = F.col("key").cast("string")
        rows = records.select(
            key.alias("key"),
            F.col("value").cast("string").alias("value"),
            F.lit(self.settings["topic"]).alias("topic"),
            F.col("partition") if keep_offsets else partition_of(key, self.settings["partitions"]).alias("partition"),
            F.col("offset") if keep_offsets else _row_offset(number).alias("offset"),
            stamp.alias("timestamp"),
        )
        return self._publish(rows, number, writer, batch_id, rows_per_file or ROWS_PER_FILE)

    def _publish(self, rows: DataFrame, number: int, writer: str, batch_id: int, rows_per_file: int) -> Appended:
        staged = f"{self.path}/_staging/{uuid.uuid4().hex}"
        # counted while writing: no second look at what was written
        seen = Observation()
        counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.max("offset").alias("end"))
        (
            counted.write.option("compression", "zstd")
            .option("parquet.block.size", _GROUP_BYTES)
            .option("maxRecordsPerFile", rows_per_file)
            .parquet(staged)
        )
        written, end = seen.get["rows"], seen.get["end"]
        if not written:
            self.files.delete(staged)
            return Appended(0, None)
        staged = self._joined(staged, written, rows_per_file)
        name = f"batch={number:0{_DIGITS}d}-{written}-{self.files.size(staged)}-{writer}-{batch_id}"
        folder = f"{_block(number)}/{name}"
        self.files.publish_text(f"{self.path}/_writers/{writer}", json.dumps({"batch": batch_id, "folder": folder}), replace=True)
        self.files.publish_folder(staged, f"{self.data}/{folder}")
        return Appended(written, int(end))

    def _joined(self, staged: str, rows: int, rows_per_file: int) -> str:
        """The folder of a staged batch in a few files, or as many as its rows need.

        Every task writes a file, however small, and a stream with a small limit takes one file a trigger: the number of
        its triggers must follow the records and not the tasks. Each file keeps to a range of offsets.
        """
        size = self.files.size(staged)
        if size > _JOINED_BYTES:
            return staged
        files = sum(name.endswith(".parquet") for name in self.files.names(staged))
        needed = 1 if rows <= rows_per_file and size <= _FILE_BYTES else max(math.ceil(rows / (_FILLED * rows_per_file)), math.ceil(size / _FILE_BYTES))
        if files <= max(_FEW, needed):
            return staged
        joined = f"{self.path}/_staging/{uuid.uuid4().hex}"
        records = self.spark.read.schema(LOG_SCHEMA).parquet(staged)
        # ranges by number, so that adaptive execution leaves them
        records = records.coalesce(1) if needed == 1 else records.repartitionByRange(needed, "offset")
        writer = records.write.option("compression", "zstd").option("parquet.block.size", _GROUP_BYTES)
        writer.option("maxRecordsPerFile", rows_per_file).parquet(joined)
        self.files.delete(staged)
        return joined

    def scan(self, after: int | None = None) -> DataFrame:
        """All records as a bounded table, or those of the batches after a number."""
        reader = self.spark.read.schema(STREAM_SCHEMA).option("basePath", self.data)
        if after is None or after < 0:
            return reader.parquet(self.data).select(*LOG_COLUMNS)
        newer = self.next_number() - 1 > after and self.batches(1)
        return (reader.parquet(self._glob_from(after + 1)) if newer else reader.parquet(self.data).where("false")).select(*LOG_COLUMNS)

    def tail(self, n: int = 100) -> DataFrame:
        """The newest `n` records. Batches are opened from the newest one back, until they hold as many.

        In a compacted log a batch may repeat an older record, so there the whole log is read.
        """
        chosen, rows = [], 0
        for block in reversed(self._blocks()):
            for name in reversed(self.files.names(f"{self.data}/{block}")):
                if name.startswith("batch=") and rows < n:
                    if name.split("-", 3)[3].startswith(COMPACTION):
                        return log_tail(self.scan(), n)
                    chosen.append(f"{self.data}/{block}/{name}")
                    rows += int(name.split("-", 3)[1])
            if rows >= n:
                break
        reader = self.spark.read.schema(STREAM_SCHEMA).option("basePath", self.data)
        return log_tail((reader.parquet(*chosen) if chosen else self.scan()).select(*LOG_COLUMNS), n)

    def counts(self) -> DataFrame:
        """batch, records of every batch in the log, from the footers of its files."""
        return metadata_counts(self.spark, self.data, STREAM_SCHEMA, ["block", "batch"]).select("batch", "records")

    def _glob_from(self, number: int) -> str:
        return f"{self.data}/{{{','.join(p.removeprefix(f'{self.data}/') for p in self._paths_from(number))}}}"

    def _paths_from(self, number: int) -> list[str]:
        """Glob paths of the batches from a number on; folders of older ones are not opened."""
        block = number // _BLOCK
        same = [f"{_block(number)}/batch={n}-*" for n in _numbers_from(number, _DIGITS)]
        later = [f"block={n}/batch=*" for n in _numbers_from(block + 1, _BLOCK_DIGITS)]
        return [f"{self.data}/{p}" for p in (*same, *later)]

    def bytes_per_row(self) -> float:
        """The size of a record in a file, over the newest batches."""
        sizes = [tuple(map(int, b.split("-", 3)[1:3])) for b in self.batches(2)[-_MEASURED:]]
        rows = sum(r for r, _ in sizes)
        return max(1.0, sum(b for _, b in sizes) / rows) if rows else _BYTES_PER_ROW

    def stream(self, start: str = "earliest", checkpoint: str = "", max_records: int | None = None) -> DataFrame:
        """Records as a stream, from the first batch on or (`latest`) from those appended after the first start.

        A trigger takes about `max_records`, and one file at least: the limit is given in bytes, from the size of the
        records appended before the start. Files hold at most the rows they were written with.
        """
        first = self._first_number(start, checkpoint)
        reader = self.spark.readStream.schema(STREAM_SCHEMA).option("basePath", self.data)
        reader = reader.option("maxFileAge", "36500d")  # age never makes a file count as read
        if max_records is not None:
            reader = reader.option("maxBytesPerTrigger", str(max(1, int(max_records * self.bytes_per_row()))))
        if first is None:
            return reader.parquet(self.data).select(*LOG_COLUMNS)
        return reader.parquet(self._glob_from(first)).select(*LOG_COLUMNS)

    def _first_number(self, start: str, checkpoint: str) -> int | None:
        """The batch a stream begins with. A `latest` start is kept beside the checkpoint for the next start."""
        if start not in STARTS:
            raise ValueError(f"start must be one of {STARTS}, not {start!r}")
        if start == "earliest":
            return None
        mark = f"{checkpoint.rstrip('/')}-start"
        if not self.files.exists(mark):
            self.files.publish_text(mark, str(self.next_number()))
        return int(self.files.read_text(mark))

    def compact_into(self, target: ParquetLog) -> Appended:
        """Append the last record per key of the batches not yet compacted to another log, offsets unchanged.

        This log stays as it is. The target's batches carry the number of the last batch they hold, so a compaction
        that runs again finds its work done, and a stream can follow the target from compaction to compaction.
        """
        target.create(self.settings["topic"], self.settings["partitions"], self.settings["compact"])
        done = target.batches(1)
        if done and not done[-1].split("-", 3)[3].startswith(f"{COMPACTION}-"):
            raise ValueError(f"the log at {target.path} holds other records; compact into one of its own")
        last, newest = (_number(done[-1]) if done else None), self.next_number() - 1
        if newest < 0 or (last is not None and last >= newest) or not self.batches(1):
            return Appended(0, None, skipped=True)
        return target._publish(compact(self.scan(last)), newest, COMPACTION, newest, ROWS_PER_FILE)


def _number(batch: str) -> int:
    return int(batch.removeprefix("batch=").split("-", 1)[0])


def _block(number: int) -> str:
    return f"block={number // _BLOCK:0{_BLOCK_DIGITS}d}"


def rows_per_file(spec: TableSpec) -> int:
    """Rows per log file that let the reader keep to the spec's records per trigger."""
    return min(ROWS_PER_FILE, spec.max_offsets_per_trigger)
