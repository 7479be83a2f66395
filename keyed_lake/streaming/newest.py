"""Records that are newer than all before them with the same primary key, over the whole life of a stream.

What is known of a key is the order of its newest record, as one text that sorts like the order columns do, and the time
until which it is remembered. It is kept as Parquet files in the checkpoint, a version for each micro-batch, which one
join with the newest records of the batch makes of the version before. So Spark does all of it, for all keys at once:
Spark's own state would call Python for every key of a micro-batch, and for every state partition, however few its keys.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyed_lake.spec import TableSpec
from keyed_lake.storage import Files

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_OFFSET_DIGITS = 39
_RECORD = ("key", "value", "timestamp", "place")
_VERSION = "id string, rank string, until long, fresh boolean, key string, value string, timestamp timestamp, place string"
_DIGITS = 12


def sortable(column: Column, data_type: T.DataType) -> Column:
    """A text that sorts like the values, NULL first."""
    if isinstance(data_type, T.TimestampType):
        number = F.unix_micros(column)
    elif isinstance(data_type, T.DateType):
        number = F.unix_date(column)
    elif isinstance(data_type, _WHOLE):
        number = column
    elif isinstance(data_type, T.StringType):
        # a character below all others ends the text, and stands for itself doubled with a larger one
        return F.coalesce(F.concat(F.lit("1"), F.replace(column, F.lit("\0"), F.lit("\0\1")), F.lit("\0\0")), F.lit("0"))
    else:
        raise ValueError(f"no order over micro-batches by a column of type {data_type.simpleString()}")
    shifted = number.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")
    return F.coalesce(F.concat(F.lit("1"), F.lpad(shifted.cast("decimal(20,0)").cast("string"), 20, "0")), F.lit("0"))


def ranked_records(rows: DataFrame, spec: TableSpec, key: Column | str, value: Column | str) -> DataFrame:
    """Decoded rows to `id`, `rank`, `at` of their primary key, order and event time, and the records they become.

    NULL keys are a key.
    """
    time = spec.order_by[0]
    if not isinstance(spec.type_of(time), T.TimestampType):
        raise ValueError(f"the first orderBy column of {spec.name} must be a timestamp")
    text = lambda c: (F.col(c) if isinstance(c, str) else c).cast("string")
    place = F.lpad(F.col("_log_offset").cast("string"), _OFFSET_DIGITS, "0")
    order = F.concat(*[sortable(F.col(c), spec.type_of(c)) for c in spec.order_by], place)
    return rows.select(
        F.to_json(F.array(*[text(c) for c in spec.pks])).alias("id"), order.alias("rank"), F.col(time).alias("at"),
        text(key).alias("key"), text(value).alias("value"), F.col("_log_timestamp").alias("timestamp"), place.alias("place"),
    )


class Known:
    """What a stream knows of its keys, a version a micro-batch; a version also holds the records that were new in it.

    A version is a folder of files, and a note that names the folder once it is complete. A micro-batch that runs again
    finds its version. The event time may fall back by the horizon: the watermark is that much below the greatest time
    of the micro-batches before. As in Spark's own state, a record is too late if it isn't above the watermark that the
    micro-batch before had (or left, at a start of the stream), and a key is forgotten when the watermark passes the
    horizon after its last record.
    """

    def __init__(self, spark: SparkSession, folder: str, horizon: str):
        self.files = Files(spark)
        self.folder = folder.rstrip("/")
        self.run = uuid.uuid4().hex
        millis = f"SELECT cast(unix_millis(timestamp '1970-01-01 00:00:00Z' + interval {horizon}) as long)"
        self.horizon = spark.sql(millis).head()[0]

    def newest(self, ranked: DataFrame, batch_id: int) -> DataFrame:
        """`key`, `value`, `timestamp`, `place` of the records newer than all before of their key, one a key."""
        number = f"{batch_id:0{_DIGITS}d}"
        notes = [name.removesuffix(".json") for name in self.files.names(self.folder) if name.endswith(".json")]
        if number not in notes:
            earlier = [n for n in notes if n < number]
            self._learn(ranked, number, self._note(earlier[-1]) if earlier else None)
        return self._read(ranked.sparkSession, self._note(number)).where("fresh").select(*_RECORD)

    def tidy(self, batch_id: int) -> None:
        """Drop all versions but that of a micro-batch whose records are stored."""
        number = f"{batch_id:0{_DIGITS}d}"
        keep = {f"{number}.json", self._note(number)["version"]}
        for name in sorted(self.files.names(self.folder), key=lambda n: not n.endswith(".json")):
            if name not in keep:
                self.files.delete(f"{self.folder}/{name}")

    def _note(self, number: str) -> dict:
        return json.loads(self.files.read_text(f"{self.folder}/{number}.json"))

    def _read(self, spark: SparkSession, note: dict) -> DataFrame:
        return spark.read.schema(_VERSION).parquet(f"{self.folder}/{note['version']}")

    def _learn(self, ranked: DataFrame, number: str, before: dict | None) -> None:
        now, late = 0, 0
        if before:
            now, late = before["next"], before["now"] if before["run"] == self.run else before["next"]
        in_time = F.col("at").isNull() | (F.unix_micros("at") > late * 1000)
        seen = ranked.groupBy("id").agg(
            F.max(F.when(in_time, F.struct("rank", *_RECORD))).alias("r"),
            F.max(F.when(in_time, F.unix_millis("at"))).alias("seen"), F.max(F.unix_millis("at")).alias("top"),
        )
        if before:
            known = self._read(ranked.sparkSession, before).where(F.col("until") >= late)
            known = known.select("id", F.col("rank").alias("known"), "until")
            met = seen.join(known, "id", "full_outer")
        else:
            met = seen.withColumns({"known": F.lit(None).cast("string"), "until": F.lit(None).cast("long")})
        there = F.col("r").isNotNull()
        until = F.when(there, F.greatest("seen", F.lit(now)) + self.horizon + 1).otherwise(F.col("until"))
        fresh = there & (F.col("known").isNull() | (F.col("r.rank") > F.col("known")))
        tops = Observation()
        rows = met.observe(tops, F.max("top").alias("top")).where(there | (F.col("until") >= now)).select(
            "id", F.greatest("r.rank", "known").alias("rank"), until.alias("until"), fresh.alias("fresh"),
            *[F.when(fresh, F.col(f"r.{c}")).alias(c) for c in _RECORD],
        )
        version = f"{number}-{uuid.uuid4().hex}"
        rows.write.option("compression", "zstd").parquet(f"{self.folder}/{version}")
        top = tops.get["top"]
        left = now if top is None else max(now, top - self.horizon)
        note = {"version": version, "now": now, "next": left, "run": self.run}
        self.files.publish_text(f"{self.folder}/{number}.json", json.dumps(note))
