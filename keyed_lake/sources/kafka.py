"""The same log interface over a Kafka topic.

Needs Spark's Kafka connector on the class path and an existing topic, created with the spec's number of partitions
and, for compaction, `cleanup.policy=compact`. Not tried here: neither connector nor broker is at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyed_lake.sources.changelog import LOG_COLUMNS, STARTS, Appended


class KafkaLog:
    def __init__(self, spark: SparkSession, servers: str, topic: str, options: dict[str, str] | None = None):
        self.spark = spark
        self.topic = topic
        self.options = {"kafka.bootstrap.servers": servers, **(options or {})}

    @property
    def write_options(self) -> dict[str, str]:
        return {
            "kafka.compression.type": "zstd",
            "kafka.enable.idempotence": "true",
            "topic": self.topic,
            **self.options,
        }

    def read_options(self, start: str, max_records: int | None = None) -> dict[str, str]:
        if start not in STARTS:
            raise ValueError(f"start must be one of {STARTS}, not {start!r}")
        options = {"subscribe": self.topic, "startingOffsets": start, **self.options}
        if max_records is not None:
            options["maxOffsetsPerTrigger"] = str(max_records)
        return options

    def append(
        self,
        records: DataFrame,
        writer: str,
        batch_id: int,
        order_by: list[str] | None = None,
        rows_per_file: int | None = None,
    ) -> Appended:
        """Produce `key`, `value` (and `timestamp`) records; a batch that runs again is produced again.

        The row count is not known. `order_by` holds within a task only, as always with a partitioned topic.
        """
        if order_by:
            records = records.sortWithinPartitions(*order_by)
        columns = [F.col("key").cast("string"), F.col("value").cast("string")]
        if "timestamp" in records.columns:
            columns.append(F.col("timestamp"))
        records.select(*columns).write.format("kafka").options(**self.write_options).save()
        return Appended(0, None)

    def scan(self) -> DataFrame:
        """The whole topic as a bounded table."""
        return self._fields(self.spark.read.format("kafka").options(**self.read_options("earliest")).load())

    def stream(self, start: str = "latest", checkpoint: str = "", max_records: int | None = None) -> DataFrame:
        """The topic as a stream; Kafka's own offsets in the checkpoint rule a restart."""
        return self._fields(self.spark.readStream.format("kafka").options(**self.read_options(start, max_records)).load())

    @staticmethod
    def _fields(records: DataFrame) -> DataFrame:
        text = {c: F.col(c).cast("string") for c in ("key", "value")}
        return records.withColumns(text).select(*LOG_COLUMNS)
