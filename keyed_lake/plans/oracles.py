"""The same results in SQL, over the same tables."""

from __future__ import annotations

from keyed_lake.plans.queries import CUT, EARLIER_CUT

_E = "event_id, ts, user_id, event_type, value, props"
_ED = f"{_E}, cast(ts as date) as pt_date"
_L = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)
_L_ORDER = (
    "l_shipdate desc nulls last, l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc, "
    "l_discount desc, l_tax desc, l_returnflag desc, l_linestatus desc"
)
_O = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_LATEST = "row_number() over (partition by user_id order by ts desc nulls last, event_id desc) = 1"
_CSV = ", ".join(
    f"coalesce(cast({c} as varchar), '')"
    for c in ("event_id", "ts", "user_id", "event_type", "value", "props", "cast(ts as date)")
)
_JSON = "event_id::varchar, ts::varchar, user_id::varchar, event_type, value::varchar, props, cast(ts as date)::varchar"
_BASE = f"""
    d as (select {_ED} from events),
    t as (
        select * from d where ts < timestamp '{CUT}'
        qualify row_number() over (partition by user_id, pt_date order by ts desc, event_id desc) = 1
    ),
    raw as (select * from d where ts >= timestamp '{EARLIER_CUT}'),
    p as (select distinct pt_date from raw),
    b as (select * from raw qualify {_LATEST})
"""
_COLUMNS = f"{_E}, pt_date"
_B = ", ".join(f"b.{c.strip()}" for c in _COLUMNS.split(","))
_T = ", ".join(f"t.{c.strip()}" for c in _COLUMNS.split(","))


def _merged(match: str) -> str:
    return f"""
        with {_BASE}
        select {_T} from t where not exists (select 1 from b where {match})
        union all
        select {_B} from t join b on {match}
        union all
        select {_B} from b where not exists (select 1 from t where {match})
    """


def _by_slices(n: int) -> str:
    return f"""
        select {_ED} from events
        qualify row_number() over (
            partition by user_id order by event_id % {n} desc, ts desc, event_id desc) = 1
    """


_KEEP_LATEST = f"select {_ED} from events qualify {_LATEST}"
_MERGE_BATCH = _merged("t.user_id = b.user_id and t.pt_date in (select pt_date from p)")


def _upsert(target: str, batch: str) -> str:
    """Rows of the target in one of the batch's dates are replaced by key, the other rows of the batch added."""
    columns = "event_id, ts, user_id, event_type, value, props, pt_date"
    b = ", ".join(f"b.{c}" for c in columns.split(", "))
    match = f"t.user_id = b.user_id and t.pt_date in (select pt_date from {batch})"
    return f"""
        select {columns} from {target} t where not exists (select 1 from {batch} b where {match})
        union all select {b} from {target} t join {batch} b on {match}
        union all select {b} from {batch} b where not exists (select 1 from {target} t where {match})
    """


_SCOPED = f"""
    with s as (
        select event_id, ts, user_id, event_type, value, replace(translate(props, ',"', ';~'), '~', chr(39)) as props, cast(ts as date) as pt_date
        from events
        qualify row_number() over (partition by event_id % 3, user_id order by ts desc, event_id desc) = 1
    ),
    b0 as (select * from s where event_id % 3 = 0),
    b1 as (select * from s where event_id % 3 = 1),
    b2 as (select * from s where event_id % 3 = 2),
    t1 as ({_upsert("b0", "b1")})
    {_upsert("t1", "b2")}
"""


def registered() -> dict[str, str]:
    return {
        "keep_latest_events": _KEEP_LATEST,
        "keep_latest_lineitem": f"""
            select {_L} from lineitem
            qualify row_number() over (partition by l_orderkey, l_linenumber order by {_L_ORDER}) = 1
        """,
        "keep_latest_ties": f"""
            select {_L} from lineitem
            qualify row_number() over (partition by l_orderkey, l_linenumber order by {_L_ORDER}) = 1
        """,
        "keep_latest_text_compat": """
            select cast(user_id as varchar) as user_id, cast(event_id as varchar) as event_id, event_type
            from events
            qualify row_number() over (partition by user_id order by cast(event_id as varchar) desc) = 1
        """,
        "keep_latest_text_typed": """
            select cast(user_id as varchar) as user_id, cast(event_id as varchar) as event_id, event_type
            from events
            qualify row_number() over (partition by user_id order by event_id desc) = 1
        """,
        "compact_records": """
            select cast(user_id as varchar) as key, cast(max(event_id) as varchar) as value from events group by user_id
        """,
        "partition_date": """
            select case when event_id % 7 = 0 then null else cast(ts as date) end as pt_date, count(*) as records
            from events group by 1
        """,
        "encode_key_compat": "select event_id, concat_ws(',', user_id, event_type) as key from events",
        "encode_key_safe": """
            select event_id, cast(json_array(user_id::varchar, event_type) as varchar) as key from events
        """,
        "encode_value_compat": f"select event_id, concat_ws(',', {_CSV}) as value from events",
        "encode_value_safe": f"select event_id, cast(json_array({_JSON}) as varchar) as value from events",
        "codec_roundtrip_compat": f"select {_ED} from events",
        "codec_roundtrip_safe": f"select {_ED} from events",
        "codec_roundtrip_documents": "select doc_id, text, lang, source, n_chars from documents",
        "decode_malformed": """
            select event_id, ts, user_id, event_type, case when event_id % 5 = 0 then null else value end as value,
                   props from events
        """,
        "decode_quarantine": """
            select event_id, event_id % 5 = 0 as bad, case when event_id % 5 = 0 then null else value end as number
            from events
        """,
        "spec_decode": " union all ".join(
            f"select '{c}' as column_name, '{t}' as type_name, {'true' if c in ('l_orderkey', 'l_linenumber') else 'false'}"
            f" as is_pk, count({c}) as n_values from lineitem"
            for c, t in zip(
                _L.split(", "),
                ["bigint", "bigint", "bigint", "int", "double", "double", "double", "double", "string", "string", "timestamp"],
            )
        ),
        "merge_batch_scope": _MERGE_BATCH,
        "merge_frames_batch_scope": _MERGE_BATCH,
        "merge_frames_global": _merged("t.user_id = b.user_id"),
        "merge_partition_scope": f"""
            with d as (select {_ED}, ts >= timestamp '{EARLIER_CUT}' as late from events)
            select {_COLUMNS} from d
            qualify row_number() over (partition by user_id, pt_date order by late desc, ts desc, event_id desc) = 1
        """,
        "touched_partitions": f"""
            select cast(ts as date) as pt_date, count(distinct user_id) as records from events
            where cast(ts as date) in (select cast(ts as date) from events where ts >= timestamp '{CUT}')
            group by 1
        """,
        "merge_global": f"""
            select {_ED} from events
            qualify row_number() over (
                partition by user_id order by (ts >= timestamp '{CUT}') desc, ts desc, event_id desc) = 1
        """,
        "merge_unpartitioned": f"""
            select {_O} from orders
            qualify row_number() over (
                partition by o_custkey order by (o_orderstatus = 'O') desc, o_orderdate desc, o_orderkey desc) = 1
        """,
        "merge_lineitem": f"""
            select {_L}, cast(date_trunc('month', l_shipdate) as date) as pt_date from lineitem
            qualify row_number() over (
                partition by l_orderkey, l_linenumber order by (l_returnflag = 'R') desc, {_L_ORDER}) = 1
        """,
        "merge_batches": _by_slices(4),
        "merge_newest_guard": _KEEP_LATEST,
        "replay_idempotent": _KEEP_LATEST,
        "compact_log": _by_slices(4),
        "log_tail": """
            select cast(user_id as varchar) as key, cast(event_id as varchar) as value
            from events order by event_id desc limit 100
        """,
        "log_stats": "select count(*) as records, cast(max(event_id) as varchar) as last_value from events",
        "compact_stream": _by_slices(4),
        "log_counts": "select count(*) as records, cast(max(event_id) as varchar) as last_value from events",
        "rekey_state": f"""
            select user_id, event_type, event_id, value, cast(0 as bigint) as late from events qualify {_LATEST}
        """,
        "audit_observed": """
            select (select count(*) from (select distinct event_id % 3, user_id from events))
                   + (select count(*) from events where event_id % 10 = 0) as records,
                   (select count(*) from events where event_id % 10 = 0) as bad_records, cast(0 as bigint) as out_of_order
        """,
        "archived_csv": f"select {_E} from events",
        "apply_latest": f"""
            select {_ED} from events where event_id % 3 > 0
            qualify row_number() over (partition by user_id order by event_id % 3 desc, ts desc, event_id desc) = 1
        """,
        "merge_empty_batches": f"""
            select {_ED}, 1 as skipped from events
            qualify row_number() over (partition by user_id order by hour(ts) // 8 desc, ts desc, event_id desc) = 1
        """,
        "table_date_counts": """
            select cast(ts as date) as pt_date, count(*) as records, min(event_id) as least_event_id, max(event_id) as most_event_id
            from events group by 1
        """,
        "compact_incremental": f"""
            with s as (
                select {_ED}, event_id % 4 as slice from events
                qualify row_number() over (partition by event_id % 4, user_id order by ts desc, event_id desc) = 1
            )
            select {_COLUMNS} from s qualify row_number() over (partition by user_id order by slice desc) = 1
        """,
        "audit_times": """
            select cast(0 as bigint) as out_of_order, count(*) as merged_rows
            from (select distinct event_id % 5, user_id from events)
        """,
        "rekey_then_apply": """
            select event_type, arg_max(event_id, event_id % 3 * 1000000000 + event_id) as event_id
            from events group by event_type
        """,
        "ingest_quarantine": """
            select case event_id % 10 when 3 then 'key' when 5 then 'type' when 7 then 'fields' else 'good' end as kind,
                   count(*) as records
            from events group by 1
        """,
        "apply_stream_batch_scope": _SCOPED,
        "apply_stream_compat": _SCOPED,
        "apply_stream_unpartitioned": f"""
            select {_O} from orders
            qualify row_number() over (
                partition by o_custkey order by (o_orderstatus = 'O') desc, o_orderdate desc, o_orderkey desc) = 1
        """,
        "run_all": """
            select 'events' as name, count(distinct user_id) as records, cast(sum(distinct user_id) as bigint) as key_sum from events
            union all
            select 'orders', count(distinct o_orderkey), cast(sum(distinct o_orderkey) as bigint) from orders
            union all
            select 'documents', count(distinct doc_id), cast(sum(distinct doc_id) as bigint) from documents
        """,
        "log_watch": "select count(*) as records from events",
        "ingest_csv": _KEEP_LATEST,
        "csv_to_table": _KEEP_LATEST,
        "apply_stream": _by_slices(5),
        "audit_stream": f"""
            with b as (
                select {_ED} from events
                qualify row_number() over (
                    partition by event_id % 5, user_id order by ts desc, event_id desc) = 1
            )
            select distinct pt_date, cast((select count(*) from b) as bigint) as merged_rows from b
        """,
        "rekey": "select event_type as key, cast(value as varchar) as value from events",
        "rekey_dedup": f"select event_type as key, cast(value as varchar) as value from events qualify {_LATEST}",
        "rekey_stream": "select event_type as key, cast(value as varchar) as value from events",
        "rekey_stream_dedup": f"select event_type as key, cast(value as varchar) as value from events qualify {_LATEST}",
        "export_roundtrip": f"select {_O} from orders",
        "table_counts": """
            select cast(year(o_orderdate) as integer) as order_year, count(*) as records from orders group by 1
        """,
    }
