"""Upsert as DataFrame operators: match on the keys, update all columns, insert what is new.

The pieces are separate so that the table can find the partitions with a match first and rewrite only those:

    hits    = matched_keys(target, updates)       distinct matched keys and their partition, key columns only
    changed = apply_updates(target, updates)      target left outer join updates
    fresh   = unmatched(updates, hits)            updates left anti join hits

With a filter of the batch's keys (`operators.keyfilter`), target rows that surely have no match pass by both joins.

A left outer join is used instead of a full outer join for two reasons: the target side is not shuffled when the
updates are small enough to broadcast, and Spark can split a skewed target partition only in the left form.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyed_lake.operators.keyfilter import KeyFilter
from keyed_lake.spec import PARTITION_COLUMN

SCOPES = ("batch", "partition", "global")
CONFLICTS = ("last_batch", "newest")


def check_scope(scope: str, partitioned: bool = True) -> None:
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}, not {scope!r}")
    if scope == "partition" and not partitioned:
        raise ValueError("partition scope needs a partitioned table")


def match_keys(pks: Sequence[str], scope: str) -> list[str]:
    """The columns that must be equal for a match, which are also the dedup keys of a batch."""
    return [*pks, PARTITION_COLUMN] if scope == "partition" else list(pks)


def _equal(left: str, right: str, keys: Sequence[str], dealt: Sequence[str] = ()) -> Column:
    """Plain equality, so that a NULL key never matches.

    `dealt` are the columns that the target is bucketed by: the partition date beside them is compared in a form that
    Spark does not take for a key of the join, as a join on more columns would shuffle the buckets again.
    """
    beside = [k for k in keys if dealt and k == PARTITION_COLUMN and k not in dealt]
    same = [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys if k not in beside]
    same += [F.datediff(F.col(f"{left}.{k}"), F.col(f"{right}.{k}")) == 0 for k in beside]
    return reduce(lambda a, b: a & b, same)


def _sized(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def matched_keys(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], extra: Sequence[str] = (), small: bool = False
) -> DataFrame:
    """The distinct keys of `target` that occur in `updates`, with the `extra` columns of the target."""
    wanted = [*keys, *[c for c in extra if c not in keys]]
    return (
        target.select(*wanted)
        .join(_sized(updates.select(*keys), small), list(keys), "left_semi")
        .groupBy(*wanted)
        .agg(F.lit(True).alias("_hit"))
        .drop("_hit")
    )


def matched_places(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], places: Sequence[str], small: bool = False,
    may_match: KeyFilter | None = None, dealt: Sequence[str] = (),
) -> DataFrame:
    """Like `matched_keys`, with the `places` columns of the target (as `old_...`) and of the update (`new_...`)."""
    if may_match is not None:
        target = may_match.split(target)[0]
    wanted = [*keys, *[p for p in places if p not in keys]]
    found = target.select(*wanted).alias("t").join(
        _sized(updates.select(*wanted), small).alias("u"), _equal("t", "u", keys, dealt)
    )
    columns = [F.col(f"u.{k}").alias(k) for k in keys]
    columns += [F.col(f"{side}.{p}").alias(f"{name}_{p}") for side, name in (("t", "old"), ("u", "new")) for p in places]
    rows = found.select(*columns)
    return rows.groupBy(*rows.columns).agg(F.lit(True).alias("_hit")).drop("_hit")


def apply_updates(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    condition: Column | None = None,
    newest_by: Sequence[str] = (),
    small: bool = False,
    unless: Column | None = None,
    dealt: Sequence[str] = (),
) -> DataFrame:
    """All rows of `target`, those with a match replaced by the matching update.

    `condition` (over `t`, the target) must hold for a match too. With `newest_by` the target row stays if it is
    newer in these columns, and so it does where `unless` (over `t` and `u`, the update) holds. `updates` must hold each
    key once.
    """
    marked = _sized(updates.withColumn("_new", F.lit(True)), small)
    on = _equal("t", "u", keys, dealt)
    if condition is not None:
        on = on & condition
    taken = F.col("u._new").isNotNull()
    if newest_by:
        # in a struct comparison NULL is the least value, the same as NULLs last in descending order
        order = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in newest_by])
        taken = taken & (order("u") >= order("t"))
    if unless is not None:
        taken = taken & ~F.coalesce(unless, F.lit(False))
    return (
        target.alias("t")
        .join(marked.alias("u"), on, "left_outer")
        .select(*[F.when(taken, F.col(f"u.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns])
    )


def unmatched(updates: DataFrame, hits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The updates without a match in the target."""
    return updates.join(hits.select(*keys), list(keys), "left_anti")


def merge_frames(
    target: DataFrame,
    updates: DataFrame,
    pks: Sequence[str],
    scope: str = "global",
    dates: DataFrame | None = None,
    newest_by: Sequence[str] = (),
    small: bool = False,
) -> DataFrame:
    """The target after an upsert, as one lazy DataFrame.

    `updates` must be reduced to one row per match key. In `batch` scope only target rows in one of `dates` (a
    one-column frame, the partition dates of the raw batch) can match.
    """
    check_scope(scope)
    keys = match_keys(pks, scope)
    if scope == "batch":
        if dates is None:
            raise ValueError("batch scope needs the dates of the raw batch")
        days = dates.select(F.col(dates.columns[0]).alias(PARTITION_COLUMN)).distinct()
        inside = target.join(days, PARTITION_COLUMN, "left_semi").select(*target.columns)
        outside = target.join(days, PARTITION_COLUMN, "left_anti").select(*target.columns)
    else:
        inside, outside = target, None
    changed = apply_updates(inside, updates, keys, newest_by=newest_by, small=small)
    fresh = unmatched(updates, matched_keys(inside, updates, keys, small=small), keys)
    merged = changed.unionByName(fresh.select(*target.columns))
    return merged if outside is None else merged.unionByName(outside)
