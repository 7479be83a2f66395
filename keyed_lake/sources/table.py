"""A table kept as plain Parquet, upserted by dynamic partition overwrite.

    pt_date=<date>/...                     a dated table
    pt_date=<date>/_bucket=<n>/...         a dated table with buckets
    _bucket=<n>/...                        a table without dates
    _table.json, _applied/<stream>         its columns, and the last batch of every stream

A merge overwrites the partitions that hold a match, in one Spark write that replaces just those, and appends to the
others. Tables with buckets are Spark tables with `CLUSTERED BY` the primary key: their rows lie where a join by key needs
them, so a merge shuffles the batch and never the table. The bucket is a partition too, so that a merge overwrites the
buckets with a match only.

Spark writes replaced partitions aside and moves them when all are complete. Before that, the names of the files in place
are noted in `_pending.json`. After a crash the next merge finishes a move that had begun, drops what had been
appended, and merges the batch again, which changes nothing for the keys that are in. One writer at a time; a reader
may fail while partitions are being replaced, and then reads again.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyed_lake.operators.dedup import keep_latest
from keyed_lake.operators.keyfilter import KeyFilter, key_filter
from keyed_lake.operators.merge import CONFLICTS, apply_updates, check_scope, match_keys, matched_places, unmatched
from keyed_lake.operators.stats import BatchStats, batch_stats, metadata_counts
from keyed_lake.spec import PARTITION_COLUMN, TableSpec
from keyed_lake.storage import Files, needs_rename, scratch_folder

OFFSET = "_log_offset"  # kept beside the columns of the spec, so that no older record replaces a newer one
OFFSET_TYPE = T.DecimalType(38, 0)
SOURCE = "_log_source"  # the log that the offset belongs to; offsets of different logs aren't compared
BUCKET = "_bucket"
NULL_DATE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder name Spark gives to a NULL partition
FILTER_FROM = 4  # rows of the target for each of the batch, from which on a filter of the keys pays
STAGING = ".spark-staging-"  # fixed value: where Spark puts partitions that will replace others


def part_name(date: str | None) -> str:
    return f"{PARTITION_COLUMN}={NULL_DATE if date is None else date}"


@dataclass(frozen=True)
class Merged:
    stats: BatchStats
    rewritten: tuple[str, ...] = ()
    appended: tuple[str, ...] = ()
    skipped: bool = False


class ParquetTable:
    def __init__(self, spark: SparkSession, path: str, spec: TableSpec, buckets: int | None = None):
        """`buckets` counts when the table is created; an existing table keeps its own.

        The default is 1 for a dated table and `spec.partitions` for one without dates.
        """
        self.spark = spark
        self.path = path.rstrip("/")
        self.spec = spec
        self.files = Files(spark)
        self.dated = spec.partition_column is not None
        self.places = [PARTITION_COLUMN] * self.dated
        self._set_buckets(buckets or (1 if self.dated else spec.partitions))
        self._opened = False

    def _set_buckets(self, buckets: int) -> None:
        self.buckets = buckets
        self.bucketed = buckets > 1 or not self.dated
        self.places = [PARTITION_COLUMN] * self.dated + [BUCKET] * self.bucketed
        plain = [f for f in self.spec.table_schema.fields if f.name != PARTITION_COLUMN]
        dates = [f for f in self.spec.table_schema.fields if f.name == PARTITION_COLUMN]
        kept = [T.StructField(OFFSET, OFFSET_TYPE), T.StructField(SOURCE, T.StringType())]
        self.schema = T.StructType([*plain, *kept, *dates, *[T.StructField(BUCKET, T.IntegerType())] * self.bucketed])

    # the table

    def exists(self) -> bool:
        return self.files.exists(f"{self.path}/_table.json")

    def create(self) -> ParquetTable:
        """Create the table if it is absent; an existing one must have the columns of the spec."""
        needs_rename(self.path)
        if not self.exists():
            self.files.mkdirs(self.path)
            facts = {"schema": self.spec.table_schema.json(), "buckets": self.buckets}
            self.files.publish_text(f"{self.path}/_table.json", json.dumps(facts))
        return self._open()

    def _open(self) -> ParquetTable:
        """Take columns and buckets from the table, and make a bucketed one known to the session."""
        if not self._opened:
            facts = json.loads(self.files.read_text(f"{self.path}/_table.json"))
            if T.StructType.fromJson(json.loads(facts["schema"])) != self.spec.table_schema:
                raise ValueError(f"the table at {self.path} has other columns than spec {self.spec.name}")
            self._set_buckets(facts["buckets"])
            if self.buckets > 1:
                self._register()
            self._opened = True
        return self

    @property
    def name(self) -> str:
        """The name of a bucketed table in the session's catalog."""
        return f"keyed_{re.sub('[^a-z0-9]', '_', self.spec.name.lower())}_{hashlib.md5(self.path.encode()).hexdigest()[:12]}"

    def _register(self) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        keys = ", ".join(f"`{k}`" for k in self.spec.pks)
        place = self.path.replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet "
            f"OPTIONS (partitionOverwriteMode 'dynamic', compression 'zstd') PARTITIONED BY ({', '.join(self.places)}) "
            f"CLUSTERED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )
        self.spark.catalog.recoverPartitions(self.name)  # the catalog keeps a list of its own

    def parts(self) -> list[str]:
        """The partition folders; as many as dates times buckets."""
        return self._open()._folders(self.path)

    def _folders(self, root: str) -> list[str]:
        names = [n for n in self.files.names(root) if n.startswith(f"{self.places[0]}=")]
        if len(self.places) == 1:
            return names
        return [f"{n}/{m}" for n in names for m in self.files.names(f"{root}/{n}") if m.startswith(f"{BUCKET}=")]

    def applied(self, stream: str) -> int:
        """The last batch of a stream that was merged, -1 before the first."""
        mark = f"{self.path}/_applied/{stream}"
        return int(self.files.read_text(mark)) if self.files.exists(mark) else -1

    # reading

    def read(self, dates: Iterable[str | None] | None = None) -> DataFrame:
        """The table, or only the partitions of some dates (ISO text, None for the NULL partition)."""
        if dates is None:
            return self._rows(None).select(*self.spec.table_columns)
        wanted = {part_name(d) for d in dates}
        return self._rows([n for n in self.parts() if n.split("/")[0] in wanted]).select(*self.spec.table_columns)

    def _rows(self, parts: Sequence[str] | None) -> DataFrame:
        """The rows of some partitions with their log offsets; folders of other dates aren't opened."""
        self._open()
        if self.buckets > 1:
            self.spark.catalog.refreshTable(self.name)
            rows = self.spark.read.table(self.name)
            return rows if parts is None else rows.where(self._among(parts))
        folders = [f"{self.path}/{p}" for p in (self.parts() if parts is None else parts)]
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*folders)

    def _among(self, parts: Iterable[str]) -> Column:
        """Whether a row belongs to one of the partitions."""
        by_date: dict[str | None, set] = {}
        for part in parts:
            values = dict(x.split("=", 1) for x in part.split("/"))
            by_date.setdefault(values.get(PARTITION_COLUMN), set()).add(values.get(BUCKET))
        dates: dict[frozenset, list] = {}
        for date, numbers in by_date.items():
            dates.setdefault(frozenset(numbers), []).append(date)
        found = []
        for numbers, days in dates.items():  # dates with the same buckets are one condition
            inside = [f"{BUCKET} IN ({', '.join(sorted(numbers))})"] if self.bucketed else []
            if self.dated:
                known = ", ".join(f"CAST('{d}' AS DATE)" for d in days if d != NULL_DATE)
                of_day = [f"{PARTITION_COLUMN} IN ({known})"] if known else []
                of_day += [f"{PARTITION_COLUMN} IS NULL"] if NULL_DATE in days else []
                inside.append(f"({' OR '.join(of_day)})")
            found.append(" AND ".join(inside))
        return F.expr(f"coalesce({' OR '.join(found)}, false)") if found else F.lit(False)

    # writing

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
        """Upsert a batch of typed rows.

        `scope` says which rows a primary key identifies: `batch` those in the partition dates of this batch,
        `partition` those of the same date, `global` all. `on_conflict="newest"` keeps a target row that is newer in
        the orderBy columns. `ties` are extra columns of the batch that order equal rows, such as the log offset.

        Rows with a log offset (`_log_offset`) and the name of its log (`_log_source`) keep them in the table. A later
        batch wins, but a row never replaces one of a greater offset of the same log, in whatever order its files were
        read. A batch of a stream is applied once; a NULL key never matches.

        The batch is read more than once; persist it first.
        """
        check_scope(scope, self.dated)
        if on_conflict not in CONFLICTS:
            raise ValueError(f"on_conflict must be one of {CONFLICTS}, not {on_conflict!r}")
        self.recover()
        if stream is not None and batch_id is not None and self.applied(stream) >= batch_id:
            return Merged(stats or BatchStats(), skipped=True)
        stats = stats or batch_stats(batch)
        if stats.rows == 0:
            return Merged(stats, skipped=True)

        keys = match_keys(self.spec.pks, scope)
        known = lambda name, kind: (F.col(name) if name in batch.columns else F.lit(None)).cast(kind).alias(name)
        latest = keep_latest(batch, keys, self.spec.order_by, ties).select(
            *self.spec.table_columns, known(OFFSET, OFFSET_TYPE), known(SOURCE, T.StringType())
        )
        updates = self._dealt(latest).select(*self.schema.names).persist()
        work = scratch_folder(self.spark, "merge")
        try:
            whole = self._can_match(scope)
            places = updates.groupBy(*self.places).agg(F.count_if(~whole).alias("loose"))
            loose = {self._part(r): r["loose"] for r in self._as_text(places, self.places, ["loose"])}
            landing = set(loose)
            held = self.parts()
            candidates = self._candidates(held, landing, scope, stats)
            rewrite: set[str] = set()
            fresh, changed = updates, None
            if candidates:
                # the raw batch is at least as large as its latest rows
                small = stats.bytes <= self._broadcast_limit()
                may_match = None if small else self._key_filter(updates, keys, stats, candidates)
                dealt = self.spec.pks if self.buckets > 1 else ()
                target = self._rows(candidates)
                # written, not cached: what is read again after the overwrite must not be computed again
                matched_places(target, updates, keys, self.places, small, may_match, dealt).write.parquet(f"{work}/hits")
                hits = self.spark.read.parquet(f"{work}/hits")
                both = F.array(*[F.struct(*[F.col(f"{side}_{p}").alias(p) for p in self.places]) for side in ("old", "new")])
                found = hits.select(F.explode(both).alias("p")).select("p.*").distinct()
                rewrite = {self._part(r) for r in self._as_text(found, self.places)}
                fresh = unmatched(updates, hits, keys)
            if rewrite:
                changed = self._changed(sorted(rewrite & set(held)), updates, keys, scope, on_conflict, small, may_match, dealt)
                changed = self._joined_by(changed, fresh.where(self._among(rewrite) & whole), landing & rewrite, small)
                fresh = fresh.where(~(self._among(rewrite) & whole))
            self._replace(changed, fresh, rewrite, {p for p in landing if p not in rewrite or loose[p]})
        finally:
            updates.unpersist()
            self.files.delete(work)
        self._note({"done": [stream, batch_id]})
        self._finish(stream, batch_id)
        return Merged(stats, tuple(sorted(rewrite)), tuple(sorted(landing - rewrite)))

    def _dealt(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.hash(*self.spec.pks), F.lit(self.buckets)).cast("int")) if self.bucketed else rows

    def _can_match(self, scope: str) -> Column:
        """Rows that never match, for a NULL in their key, are appended only: an overwrite that runs again would add them again."""
        whole = F.lit(True)
        for key in [*self.spec.pks, *[PARTITION_COLUMN] * (self.dated and scope != "global")]:
            whole = whole & F.col(key).isNotNull()
        return whole

    def _as_text(self, rows: DataFrame, columns: Sequence[str], more: Sequence[str] = ()) -> list[Row]:
        """One row per partition: as many as dates times buckets reach the driver."""
        return rows.select(*[F.col(c).cast("string").alias(c) for c in columns], *more).collect()

    def _part(self, row: Row) -> str:
        return "/".join(part_name(row[p]) if p == PARTITION_COLUMN else f"{p}={row[p]}" for p in self.places)

    def _key_filter(self, updates: DataFrame, keys: Sequence[str], stats: BatchStats, candidates: Sequence[str]) -> KeyFilter | None:
        """A filter where it lets most of the target pass by; buckets aren't shuffled in any case."""
        if self.buckets > 1:
            return None
        folders = [f"{self.path}/{p}" for p in candidates]
        held = metadata_counts(self.spark, self.path, self.schema, paths=folders).head()[0]
        return key_filter(updates, keys, stats.rows, self._broadcast_limit()) if held > FILTER_FROM * stats.rows else None

    def _candidates(self, held: Sequence[str], landing: set[str], scope: str, stats: BatchStats) -> list[str]:
        """The partitions that may hold a match: those of the dates of the raw batch, or all."""
        out = list(held)
        if self.dated and scope != "global":
            days = {part_name(d) for d in stats.dates}  # without the NULL date, which matches none
            out = [n for n in out if n.split("/")[0] in days]
        if self.bucketed:
            numbers = {n.split("/")[-1] for n in landing}
            out = [n for n in out if n.split("/")[-1] in numbers]
        return out

    def _changed(self, parts, updates, keys, scope, on_conflict, small, may_match, dealt) -> tuple[DataFrame, DataFrame | None]:
        """The rows of some partitions after the updates, and those of them that passed by the join."""
        target, beside = self._rows(parts), None
        if may_match is not None:
            target, beside = may_match.split(target)
        in_scope = F.col(f"t.{PARTITION_COLUMN}").isNotNull() if scope == "batch" and self.dated else None
        older = (F.col(f"u.{SOURCE}") == F.col(f"t.{SOURCE}")) & (F.col(f"u.{OFFSET}") < F.col(f"t.{OFFSET}"))
        newest = self.spec.order_by if on_conflict == "newest" else ()
        return apply_updates(target, updates, keys, in_scope, newest, small, older, dealt), beside

    def _joined_by(self, changed: tuple, fresh: DataFrame, landing: set[str], small: bool) -> DataFrame:
        """Rows that were not shuffled are written by the task that read them; the others are grouped by partition."""
        rows, beside = changed
        if small or self.buckets > 1:
            return rows.unionByName(self._spread(fresh, len(landing)))
        rows = self._spread(rows.unionByName(fresh), 2)
        return rows if beside is None else rows.unionByName(beside)

    def _replace(self, changed: DataFrame | None, fresh: DataFrame, rewrite: set[str], append: set[str]) -> None:
        """Overwrite the partitions to rewrite, then append the rows that go elsewhere or never match."""
        if changed is not None:
            before = self._files_in(rewrite)
            self._note({"rewrite": before})
            self._write(changed, overwrite=True)
            self._drop_emptied(before)
        if append:
            self._note({"append": self._files_in(append)})
            self._write(self._spread(fresh, len(append)), overwrite=False)

    def _note(self, pending: dict) -> None:
        self.files.publish_text(f"{self.path}/_pending.json", json.dumps(pending), replace=True)

    def _finish(self, stream: str | None, batch_id: int | None) -> None:
        if stream is not None and batch_id is not None:
            self.files.publish_text(f"{self.path}/_applied/{stream}", str(batch_id), replace=True)
        self.files.delete(f"{self.path}/_pending.json")

    def _files_in(self, parts: Iterable[str]) -> dict[str, list[str]]:
        """The names of the data files of some partitions; none for those that don't exist."""
        out: dict[str, list[str]] = {p: [] for p in sorted(parts)}
        held = [f"{self.path}/{p}" for p in sorted(set(out) & set(self.parts()))]
        found = self.files.data_files(self.spark, held) if held else []
        for place in found:
            folder, name = place.rsplit("/", 1)
            out["/".join(folder.split("/")[-len(self.places) :])].append(name)
        return {p: sorted(names) for p, names in out.items()}

    def _drop_emptied(self, before: dict[str, list[str]]) -> None:
        """Remove partitions that were to be overwritten and got no row: their old files are still there."""
        after = self._files_in(before)
        for part, names in before.items():
            if names and after[part] == names:
                if self.buckets > 1:
                    where = ", ".join(f"{k}='{v}'" for k, v in (x.split("=", 1) for x in part.split("/")))
                    self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({where})")  # of the catalog's list
                self.files.delete(f"{self.path}/{part}")

    def recover(self) -> None:
        """Bring a table in order whose last merge broke off; the batch then runs again."""
        self._open()
        for name in self.files.names(self.path):
            if name.startswith(STAGING):
                if self.files.exists(f"{self.path}/{name}/_SUCCESS"):
                    for part in self._folders(f"{self.path}/{name}"):
                        self.files.replace_folder(f"{self.path}/{name}/{part}", f"{self.path}/{part}")
                self.files.delete(f"{self.path}/{name}")
        note = f"{self.path}/_pending.json"
        if not self.files.exists(note):
            return
        pending = json.loads(self.files.read_text(note))
        if "done" in pending:
            self._finish(*pending["done"])
            return
        before = pending.get("rewrite", {})
        if self._files_in(before) != before:
            self._drop_emptied(before)
        before = pending.get("append", {})
        for part, names in self._files_in(before).items():
            for name in set(names) - set(before[part]):
                self.files.delete(f"{self.path}/{part}/{name}")
        self.files.delete(note)

    def _broadcast_limit(self) -> int:
        """The size up to which Spark itself would broadcast; negative turns it off."""
        text = self.spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        return self.spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text) if text != "-1" else -1

    def _spread(self, rows: DataFrame, places: int) -> DataFrame:
        """Group rows by partition before the write, so that a task does not open a file for every date.

        The rebalance hint lets Spark split a date that is larger than others over several tasks; without adaptive
        execution every date is split by key. With a single place there is nothing to group, and the shuffle is left
        out.
        """
        if places < 2:
            return rows
        if self.spark.conf.get("spark.sql.adaptive.enabled") == "true":
            return rows.hint("rebalance", *self.places)
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        share = F.pmod(F.xxhash64(*self.spec.pks), F.lit(max(1, tasks // places)))
        return rows.repartition(tasks, *[F.col(p) for p in self.places], share)

    def _write(self, rows: DataFrame, overwrite: bool) -> None:
        rows = rows.select(*self.schema.names)
        if self.buckets > 1:
            rows.write.insertInto(self.name, overwrite=overwrite)
            return
        writer = rows.write.option("compression", "zstd").option("partitionOverwriteMode", "dynamic")
        writer.mode("overwrite" if overwrite else "append").partitionBy(*self.places).parquet(self.path)

    def rewrite(self, parts: Iterable[str]) -> None:
        """Write partitions anew, in fewer files, after many appends."""
        chosen = sorted(set(parts) & set(self.parts()))
        if chosen:
            self._write(self._spread(self._rows(chosen), 2), overwrite=True)

    def counts(self, by_date: bool = True, extremes: Sequence[str] = ()) -> DataFrame:
        """Rows (and least and most of number and date columns) per date or in all, from the footers of the files."""
        self._open()
        by = [PARTITION_COLUMN] if by_date and self.dated else []
        return metadata_counts(self.spark, self.path, self.schema, by, extremes)

    def export_csv(self, target: str) -> None:
        """Write all rows as header-less CSV; fails if the target exists."""
        export_csv(self.read(), target)


def export_csv(df: DataFrame, target: str) -> None:
    df.write.csv(target)
