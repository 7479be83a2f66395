"""Helpers that several operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import Files, scratch_folder

BATCH_BYTES = 4 << 20  # of a batch between Spark and a worker; both hold several copies of one
_BATCH_SETTING, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "64m"
_SHUFFLE_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to a new folder under the shared scratch folder and read again.

    This cuts the lineage, fixes values that depend on a task's place, and outlives a lost executor. Nothing needs the
    write's shuffles then, so they go at once: else they stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark, name)}/rows"
    before = spark.conf.get(_SHUFFLE_SETTING, None)
    spark.conf.set(_SHUFFLE_SETTING, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_SHUFFLE_SETTING) if before is None else spark.conf.set(_SHUFFLE_SETTING, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes written tables that no table still to be written, and no result, reads."""
    for table in tables:
        found = table.inputFiles()
        if found:
            Files(table.sparkSession).delete(unquote(found[0]).rsplit("/", 2)[0])


def fresh(name: str, taken: list[str]) -> str:
    """The name, with underscores in front until it clashes with none of the taken ones (in any case)."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = "_" + name
    return name


def col(name: str) -> Column:
    """A top-level column whose name may hold dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def fold(key: Column | str, modulus: int) -> Column:
    """crc32 of an id as text, modulo a number; the usual fold of a key."""
    return F.crc32(F.coalesce((key if isinstance(key, Column) else col(key)).cast("string"), F.lit(""))) % modulus


def plus(schema: T.StructType, *more: tuple[str, str]) -> T.StructType:
    """The schema and further fields; unlike `add`, leaves the schema as it is."""
    more = T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in more)) if more else T.StructType()
    return T.StructType([*schema.fields, *more.fields])


def map_arrow(df: DataFrame, function, schema: T.StructType | str) -> DataFrame:
    """mapInArrow, with workers that find this package where the driver has it.

    On a cluster whose machines don't share that path, install the package or submit it with `--py-files`.
    """
    find_package(df.sparkSession)

    def released(batches):
        try:
            yield from function(batches)
        finally:
            release_memory()

    return df.mapInArrow(released, schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most so many rows, which bounds what a worker makes of them at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to workers in batches of about `BATCH_BYTES`, or one text if that is larger.

    Sets Spark's limit on Arrow batches for the session, unless the session has one other than Spark's own.
    """
    if spark.conf.get(_BATCH_SETTING, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


_kept: dict[tuple, object] = {}


def kept(key: tuple | None = None, make: Callable[[], object] | None = None) -> object:
    """What a worker keeps from task to task. It serves one operator after another, so what others have left there goes."""
    if key not in _kept:
        _kept.clear()
        release_memory()
        if make:
            _kept[key] = make()
    return _kept.get(key)


def release_memory() -> None:
    """Give what a task has freed back to the system: its worker stays for the next task, which may be another operator's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library keeps its own counsel
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def find_package(spark: SparkSession) -> None:
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, known)])
