"""Keep one row per key.

Every form is one `row_number() = 1` over a total order. Spark prunes each input partition to one row per key
before the shuffle, so a key that holds a large share of all rows sends one row per task. The total order makes the
survivor the same however the input is partitioned and whichever task is run again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyed_lake.functions.codec import typed
from keyed_lake.spec import TableSpec

_UNORDERED = (T.MapType, T.VariantType)


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    ties: Sequence[str | Column] = (),
) -> DataFrame:
    """Keep the row with the greatest `order_by` per key; NULLs come last, keys that are NULL form groups too.

    Equal rows are told apart by `ties`, then by all other columns, greatest first.
    """
    if not keys:
        raise ValueError("keep_latest needs at least one key column")
    wanted = [*order_by, *ties]
    named = {c for c in wanted if isinstance(c, str)} | set(keys)
    rest = [f.name for f in df.schema if f.name not in named and not isinstance(f.dataType, _UNORDERED)]
    order = [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in [*wanted, *rest]]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")


def keep_latest_text(df: DataFrame, spec: TableSpec, mode: str = "safe") -> DataFrame:
    """Keep the latest all-text row per primary key, before encoding.

    Rows are ordered by the declared types, so that 10 comes after 9, and so are the columns that tell equal rows apart:
    a row that wins here also wins among decoded rows. Raw text only tells rows of equal values apart. `compat` orders
    the raw text instead.
    """
    if mode == "compat":
        return keep_latest(df, spec.pks, spec.order_by)
    others = [c for c in spec.columns if c not in spec.pks and c not in spec.order_by]
    types = {c: spec.type_of(c) for c in df.columns if c in spec.columns and c not in spec.pks}
    types = {c: t for c, t in types.items() if not isinstance(t, T.StringType)}
    if not types or not set(spec.columns) <= set(df.columns):
        as_typed = lambda names: [typed(c, spec.type_of(c)) for c in names]
        return keep_latest(df, spec.pks, as_typed(spec.order_by), as_typed(others))
    # a typed column stands for its text where that is how Spark writes the value; sorts and shuffles carry one of the two
    ties, places = [], []
    for c in [*df.columns, None]:
        if c in types:
            places.append(_raw_order(F.col(c), _plain_text(typed(c, types[c]))))
        elif c not in spec.columns:  # another column, or the end
            if places:
                ties.append(F.concat(*places).alias(f"_order{len(ties)}"))
                places = []
            ties += [c] * (c is not None and not isinstance(df.schema[c].dataType, _UNORDERED))
    raw = {c: F.when(~F.col(c).eqNullSafe(_plain_text(typed(c, t))), F.col(c)) for c, t in types.items()}
    odd = reduce(lambda a, b: a | b, [r.isNotNull() for r in raw.values()])
    packed = df.select(
        *[typed(c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns],
        *[t for t in ties if isinstance(t, Column)],
        F.when(odd, F.struct(*[r.alias(c) for c, r in raw.items()])).alias("_raw"),
    )
    named = [t if isinstance(t, str) else f"_order{i}" for i, t in enumerate(ties)]
    latest = keep_latest(packed, spec.pks, spec.order_by, [*others, *named])
    return latest.select(
        *[F.coalesce(F.col("_raw").getField(c), _plain_text(F.col(c))).alias(c) if c in types else F.col(c) for c in df.columns]
    )


def _plain_text(value: Column) -> Column:
    """The text of a value as Spark writes it, the same for values that sort as equal: 0.0 also for -0.0."""
    text = value.cast("string")
    return F.when(text == "-0.0", F.lit("0.0")).otherwise(text)


def _raw_order(raw: Column, plain: Column) -> Column:
    """A text that sorts raw texts of equal values as they sort themselves, NULL first, and is short for the plain one."""
    # a character below all others ends the text, and stands for itself doubled with a larger one
    whole = F.concat(F.replace(raw, F.lit("\0"), F.lit("\0\1")), F.lit("\0\0"))
    above = plain.isNull() | (raw > plain)
    return F.when(raw.eqNullSafe(plain), F.lit("1")).otherwise(F.concat(F.when(above, F.lit("2")).otherwise(F.lit("0")), whole))


def latest_records(log: DataFrame, keys: Sequence[str] = ("partition", "key")) -> DataFrame:
    """The last record per key and log partition, as an aggregate that also runs on a stream, with the records as state."""
    rest = [c for c in log.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.col("offset")).alias("_last")
    return log.groupBy(*keys).agg(last).select(*[c if c in keys else F.col(f"_last.{c}").alias(c) for c in log.columns])


def compact(log: DataFrame, keys: Sequence[str] = ("partition", "key")) -> DataFrame:
    """Keep the last record per key and log partition. Offsets stay as they were, so gaps appear."""
    return keep_latest(log, keys, ["offset"])
