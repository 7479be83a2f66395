"""The same table interface over a Delta table, merged with its own MERGE.

Needs the `delta` package and its jars. Not tried here, as they are not at hand; only the match condition is tested.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyed_lake.operators.dedup import keep_latest
from keyed_lake.operators.merge import CONFLICTS, check_scope, match_keys
from keyed_lake.operators.stats import BatchStats, batch_stats
from keyed_lake.sources.table import Merged, export_csv
from keyed_lake.spec import PARTITION_COLUMN, TableSpec


def match_condition(spec: TableSpec, scope: str, dates: Sequence[str]) -> Column:
    """When a row `t` of the table and an update `u` match; the dates let Delta prune partitions."""
    parts = [F.col(f"t.{k}") == F.col(f"u.{k}") for k in match_keys(spec.pks, scope)]
    if spec.partition_column and scope != "global":
        parts.insert(0, F.col(f"t.{PARTITION_COLUMN}").isin([F.lit(d).cast("date") for d in dates]))
    return reduce(lambda a, b: a & b, parts)


class DeltaTable:
    def __init__(self, spark: SparkSession, path: str, spec: TableSpec):
        self.spark = spark
        self.path = path.rstrip("/")
        self.spec = spec

    @staticmethod
    def _api():
        try:
            from delta.tables import DeltaTable as api
        except ImportError as error:
            raise ImportError("a Delta table needs the delta-spark package") from error
        return api

    def create(self) -> DeltaTable:
        builder = self._api().createIfNotExists(self.spark).location(self.path).addColumns(self.spec.table_schema)
        if self.spec.partition_column:
            builder = builder.partitionedBy(PARTITION_COLUMN)
        builder.execute()
        return self

    def read(self, dates: Sequence[str] | None = None) -> DataFrame:
        rows = self.spark.read.format("delta").load(self.path)
        if dates is None:
            return rows
        return rows.where(F.col(PARTITION_COLUMN).isin([F.lit(d).cast("date") for d in dates]))

    def merge(
        self,
        batch: DataFrame,
        scope: str = "batch",
        on_conflict: str = "last_batch",
        ties: Sequence[str] = (),
        stream: str | None = None,
        batch_id: int | None = None,
        stats: BatchStats | None = None,
    ) -> Merged:
        """Upsert a batch; see `ParquetTable.merge`. A batch that runs again is merged again."""
        check_scope(scope, self.spec.partition_column is not None)
        if on_conflict not in CONFLICTS:
            raise ValueError(f"on_conflict must be one of {CONFLICTS}, not {on_conflict!r}")
        stats = stats or batch_stats(batch)
        if stats.rows == 0:
            return Merged(stats, skipped=True)
        keys = match_keys(self.spec.pks, scope)
        updates = keep_latest(batch, keys, self.spec.order_by, ties).select(*self.spec.table_columns)
        newer = None
        if on_conflict == "newest":
            order = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in self.spec.order_by])
            newer = order("u") >= order("t")
        (
            self._api().forPath(self.spark, self.path).alias("t")
            .merge(updates.alias("u"), match_condition(self.spec, scope, stats.dates))
            .whenMatchedUpdateAll(newer)
            .whenNotMatchedInsertAll()
            .execute()
        )
        return Merged(stats)

    def export_csv(self, target: str) -> None:
        export_csv(self.read(), target)
