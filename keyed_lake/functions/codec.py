"""Turn typed or text rows into key/value text records and back.

Two text forms:

- `safe` (default): JSON arrays of strings, by position. Every text survives, NULL and "" stay apart, and records that
  can't be decoded are marked so that they can be put aside. Arrays take less than half the room of JSON objects.
- `compat`: values joined with commas, without quoting. NULL key parts are left out, NULL values become "", and a
  comma inside a value shifts the columns after it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyed_lake.spec import PARTITION_COLUMN, TableSpec

MODES = ("safe", "compat")
BAD = "_bad"
LOG_FIELDS = ("partition", "offset", "timestamp")


def check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")


def with_partition_date(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Append the partition date, taken from the partitionBy column; text that is no date gives NULL."""
    if spec.partition_column is None:
        return df
    return df.withColumn(PARTITION_COLUMN, F.try_to_date(F.col(spec.partition_by)))


def _to_text(column: str, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.BinaryType):
        # an arbitrary byte string is not text; base64 is
        return F.base64(F.col(column).cast("binary"))
    return F.col(column).cast("string")


def _from_text(text: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.BinaryType):
        return F.try_to_binary(text, F.lit("base64"))
    return text if isinstance(data_type, T.StringType) else text.try_cast(data_type)


def typed(text: Column | str, data_type: T.DataType) -> Column:
    """The typed value of a raw CSV token; NULL where the token does not parse."""
    column = F.col(text) if isinstance(text, str) else text
    return column if isinstance(data_type, T.StringType) else column.try_cast(data_type)


def unreadable(spec: TableSpec) -> Column:
    """Whether an all-text row lacks a primary key part or holds a token that doesn't parse."""
    bad = F.lit(False)
    for name in spec.columns:
        if name in spec.pks:
            bad = bad | typed(name, spec.type_of(name)).isNull()
        else:
            bad = bad | (F.col(name).isNotNull() & typed(name, spec.type_of(name)).isNull())
    return bad


def encode_key(spec: TableSpec, mode: str = "safe") -> Column:
    """The record key: the primary key columns as one text."""
    check_mode(mode)
    if mode == "compat":
        return F.concat_ws(",", *[F.col(c).cast("string") for c in spec.pks])
    return F.to_json(F.array(*[_to_text(c, spec.type_of(c)) for c in spec.pks]))


def encode_value(spec: TableSpec, mode: str = "safe") -> Column:
    """The record value: all table columns, the partition date last, as one text."""
    check_mode(mode)
    fields = spec.table_schema.fields
    if mode == "compat":
        return F.concat_ws(",", *[F.coalesce(F.col(f.name).cast("string"), F.lit("")) for f in fields])
    return F.to_json(F.array(*[_to_text(f.name, f.dataType) for f in fields]))


def encode(df: DataFrame, spec: TableSpec, mode: str = "safe") -> DataFrame:
    """Rows to `key`, `value` records; both are built in one step, so columns may carry these names too."""
    return df.select(encode_key(spec, mode).alias("key"), encode_value(spec, mode).alias("value"))


def decode(df: DataFrame, spec: TableSpec, mode: str = "safe", value: str = "value") -> DataFrame:
    """Log records to typed rows.

    Log fields that are present stay as `_log_partition`, `_log_offset`, `_log_timestamp`. In safe mode the boolean
    `_bad` marks records that are no JSON array of the right length, hold a token that does not parse, or lack a
    primary key part; `_bad_value` is their text.
    """
    check_mode(mode)
    kept = [F.col(f"`{name}`").alias(f"_log_{name}") for name in LOG_FIELDS if name in df.columns]
    text = F.col(value).cast("string")
    if mode == "compat":
        row = F.from_csv(text, spec.table_schema.simpleString())
        return df.select(row.alias("_row"), *kept).select("_row.*", *_names(df))

    fields = spec.table_schema.fields
    parsed = F.from_json(text, T.ArrayType(T.StringType()))
    # explode makes one row of one row; it keeps a filter on the result from parsing the text again per column
    rows = df.select(F.explode(F.array(parsed)).alias("_row"), text.alias("_text"), *kept)
    values, broken = [], F.col("_row").isNull() | (F.size("_row") != len(fields))
    for i, f in enumerate(fields):
        token = F.get("_row", F.lit(i))
        value = _from_text(token, f.dataType)
        values.append(value.alias(f.name))
        if f.name in spec.pks:
            broken = broken | value.isNull()
        elif not isinstance(f.dataType, T.StringType):
            broken = broken | (token.isNotNull() & value.isNull())
    places = _names(df)
    return rows.select(*values, *places, broken.alias(BAD), F.when(broken, F.col("_text")).alias("_bad_value"))


def _names(df: DataFrame) -> list[str]:
    return [f"_log_{name}" for name in LOG_FIELDS if name in df.columns]


def rekey(df: DataFrame, key: Column | str, value: Column | str, keep: Sequence[str] = ()) -> DataFrame:
    """New `key`, `value` records from other columns, as text."""
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    return df.select(
        as_column(key).cast("string").alias("key"), as_column(value).cast("string").alias("value"), *keep
    )
