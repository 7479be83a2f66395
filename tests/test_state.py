"""Streams with state, and looks at logs and tables that read no more than needed."""

import os
from dataclasses import replace
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import make_spec, plan_of, rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyed_lake.functions.codec import encode
from keyed_lake.operators.dedup import compact, latest_records
from keyed_lake.operators.stats import metadata_counts
from keyed_lake.sources.changelog import ParquetLog
from keyed_lake.sources.table import ParquetTable
from keyed_lake.streaming.audit import ProgressAudit, watch_log
from keyed_lake.streaming.newest import Known, ranked_records, sortable
from keyed_lake.streaming.pipelines import apply_all, apply_log, await_all, compact_stream, rekey_newest

SPEC = make_spec("id long,at timestamp,n int,v string", "id", "at,n", name="s", topic="s", table_folder="s", partitions=3)
T0 = datetime(2024, 5, 1, 12)


@pytest.fixture
def log(spark, folder):
    return ParquetLog(spark, f"{folder}/logs/s").create("s", 3)


def records(spark, *rows):
    """(id, minutes after T0, n, v) as records."""
    rows = [(i, None if m is None else T0 + timedelta(minutes=m), n, v) for i, m, n, v in rows]
    return encode(spark.createDataFrame(rows, SPEC.row_schema), SPEC)


def plain_records(spark, *pairs):
    return spark.createDataFrame(list(pairs), "key string, value string")


# compaction


def test_the_aggregate_is_the_batch_operator(spark):
    schema = "key string, value string, partition int, offset decimal(38,0), timestamp timestamp"
    rows = [(f"k{i % 7}" if i % 9 else None, f"v{i}" if i % 5 else None, i % 2, i * 7919 % 100, T0) for i in range(100)]
    df = spark.createDataFrame([(*r[:3], Decimal(r[3]), r[4]) for r in rows], schema)
    assert rows_of(latest_records(df)) == rows_of(compact(df))


def test_compaction_goes_on_after_a_restart(spark, folder, log):
    target = ParquetLog(spark, f"{folder}/small")
    run = lambda: compact_stream(spark, log, target, f"{folder}/cp", available_now=True).awaitTermination()
    log.append(plain_records(spark, ("a", "a0"), ("b", "b0")), "w", 0)
    log.append(plain_records(spark, ("a", "a1")), "w", 1)
    run()
    assert rows_of(target.scan(), "key", "value") == [("a", "a1"), ("b", "b0")]
    run()
    assert len(target.batches()) == 1
    log.append(plain_records(spark, ("b", "b2"), ("c", "c2")), "w", 2)
    run()
    assert rows_of(target.scan(), "key", "value") == [("a", "a1"), ("b", "b0"), ("b", "b2"), ("c", "c2")]
    source = {(r["key"], r["value"]): (r["offset"], r["partition"]) for r in log.scan().collect()}
    assert all(source[r["key"], r["value"]] == (r["offset"], r["partition"]) for r in target.scan().collect())
    assert rows_of(compact(target.scan()), "key", "value") == rows_of(compact(log.scan()), "key", "value")


def test_an_older_record_that_is_read_late_does_not_win(spark, folder, log):
    log.append(plain_records(spark, ("a", "old")), "w", 0)
    log.append(plain_records(spark, ("a", "new")), "w", 1)
    for k, batch in enumerate(reversed(log.batches())):  # the file source goes by file times
        path = f"{log.data}/block=00000000/{batch}"
        for name in os.listdir(path):
            os.utime(f"{path}/{name}", (1_700_000_000 + k, 1_700_000_000 + k))
    target = ParquetLog(spark, f"{folder}/small")
    compact_stream(spark, log, target, f"{folder}/cp", max_records=1, available_now=True).awaitTermination()
    assert {r["value"] for r in target.scan().collect()} == {"new"}


@pytest.mark.parametrize("continuous", [False, True])
def test_tables_follow_compacted_logs(spark, folder, log, continuous):
    def run():
        queries = apply_all(
            spark, {"s": SPEC}, f"{folder}/logs", f"{folder}/tables", f"{folder}/cp", f"{folder}/compacted",
            continuous=continuous, start="earliest", scope="global", available_now=True,
        )
        assert len(queries) == 1 + continuous
        await_all(spark, queries)
        return rows_of(ParquetTable(spark, f"{folder}/tables/s", SPEC).create().read(), "id", "v")

    log.append(records(spark, (1, 0, 0, "a"), (2, 0, 0, "b")), "w", 0)
    log.append(records(spark, (1, 1, 0, "c")), "w", 1)
    assert run() == [(1, "c"), (2, "b")]
    log.append(records(spark, (2, 2, 0, "d"), (3, 2, 0, "e")), "w", 2)
    assert run() == [(1, "c"), (2, "d"), (3, "e")]


# re-keying over micro-batches


def rekeyed(spark, folder, log, batches, horizon="1 hour", **more):
    target = ParquetLog(spark, f"{folder}/target").create("t", 2)
    for i, batch in enumerate(batches):
        log.append(batch, "w", i)
        await_all(spark, rekey_newest(spark, SPEC, log, target, f"{folder}/cp", "v", "n", horizon, available_now=True, **more))
    return [(r["key"], r["value"]) for r in target.scan().orderBy("offset").collect()]


def test_a_late_older_record_is_left_out(spark, folder, log):
    batches = [
        records(spark, (1, 10, 1, "a"), (2, 10, 1, "b")),
        records(spark, (1, 5, 2, "late"), (2, 11, 2, "newer")),
        records(spark, (1, 10, 0, "late by n"), (1, 10, 2, "newer by n"), (2, 11, 2, "same order, later in the log")),
    ]
    assert rekeyed(spark, folder, log, batches) == [
        ("a", "1"), ("b", "1"), ("newer", "2"), ("newer by n", "2"), ("same order, later in the log", "2"),
    ]


def test_one_record_per_key_and_micro_batch(spark, folder, log):
    batch = records(spark, *[(1, m, 0, f"v{m}") for m in (3, 9, 4)], (2, None, 0, "no time"), (2, None, 1, "no time, newer"))
    assert sorted(rekeyed(spark, folder, log, [batch])) == [("no time, newer", "1"), ("v9", "0")]


def test_keys_are_forgotten_after_the_horizon(spark, folder, log):
    batches = [
        records(spark, (1, 0, 0, "first")),
        records(spark, (2, 300, 0, "five hours on")),  # moves the watermark
        records(spark, (3, 301, 0, "x")),  # times out key 1
        records(spark, (1, 30, 0, "too late to tell"), (1, 290, 0, "in time")),
    ]
    assert rekeyed(spark, folder, log, batches) == [("first", "0"), ("five hours on", "0"), ("x", "0"), ("in time", "0")]


def test_bad_records_go_aside_and_orders_are_checked(spark, folder, log):
    batch = records(spark, (1, 0, 0, "a")).unionAll(plain_records(spark, ("x", "junk")))
    assert rekeyed(spark, folder, log, [batch], quarantine=f"{folder}/bad") == [("a", "0")]
    assert rows_of(spark.read.parquet(f"{folder}/bad"), "value") == [("junk",)]
    with pytest.raises(ValueError, match="timestamp"):
        rekey_newest(spark, replace(SPEC, order_by=("n",)), log, log, f"{folder}/cp2", "v", "n")
    with pytest.raises(ValueError, match="no order"):
        sortable(F.lit(1.0), T.DoubleType())


def test_keys_cost_no_python_and_no_state_partitions(spark, folder, log):
    log.append(records(spark, *[(i % 700, i, 0, f"v{i}") for i in range(2000)]), "w", 0)
    target = ParquetLog(spark, f"{folder}/target").create("t", 2)
    queries = rekey_newest(spark, SPEC, log, target, f"{folder}/cp", "v", "n", available_now=True)
    await_all(spark, queries)
    assert queries[0].lastProgress["stateOperators"] == []
    assert rows_of(target.scan(), "key") == sorted((f"v{i}",) for i in range(1300, 2000))


def test_a_micro_batch_that_runs_again_finds_the_same(spark, folder):
    def ranked(*rows):
        rows = [(i, m and T0 + timedelta(minutes=m), n, v, Decimal(k), T0) for k, (i, m, n, v) in enumerate(rows)]
        schema = "id long, at timestamp, n int, v string, _log_offset decimal(38,0), _log_timestamp timestamp"
        return ranked_records(spark.createDataFrame(rows, schema), SPEC, "v", "n")

    def new(batch_id, *rows, known=None):
        return rows_of((known or Known(spark, f"{folder}/known", "1 hour")).newest(ranked(*rows), batch_id), "key")

    one = Known(spark, f"{folder}/known", "1 hour")
    first = [(1, 10, 0, "a"), (2, 10, 0, "b"), (2, 20, 0, "c"), (3, None, 0, "d")]
    assert new(0, *first, known=one) == new(0, *first) == [("a",), ("c",), ("d",)]
    os.makedirs(f"{folder}/known/000000000001-broken")
    second = [(1, 5, 0, "late"), (2, 20, 1, "e"), (3, 300, 0, "f"), (None, 8, 0, "no key")]
    assert new(1, *second, known=one) == new(1, *second) == [("e",), ("f",), ("no key",)]
    one.tidy(1)
    left = [n for n in os.listdir(f"{folder}/known") if not n.startswith(".")]
    assert len(left) == 2 and {n[:12] for n in left} == {"000000000001"} and "000000000001-broken" not in left
    # after the start of a stream, the watermark is 240: other keys than 3 are forgotten
    third = [(1, 30, 0, "too late to tell"), (2, 250, 0, "g"), (3, 299, 0, "older"), (1, None, 0, "no time")]
    assert new(2, *third) == [("g",), ("no time",)]


@pytest.mark.parametrize(
    "kind, values",
    [
        ("long", [None, -(2**63), -5, 0, 7, 2**63 - 1]), ("int", [None, -3, 0, 12]),
        ("string", [None, "", "\0", "\0\0", "\0a", "\1", "a", "a\0", "a\0b", "ab", "b"]),
        ("timestamp", [None, datetime(1960, 1, 1), datetime(1970, 1, 1, 0, 0, 0, 1), T0]),
    ],
)
def test_sortable_texts(spark, kind, values):
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(values)], f"i int, v {kind}, w int")
    text = F.concat(sortable(F.col("v"), df.schema["v"].dataType), sortable(F.col("w"), T.IntegerType()))
    assert [r["i"] for r in df.select("i", text.alias("t")).collect() if r] == list(range(len(values)))
    texts = [r["t"] for r in df.select("i", text.alias("t")).orderBy("i").collect()]
    assert texts == sorted(texts) and len(set(texts)) == len(values)


# tails and counts


def test_a_tail_opens_the_newest_batches_only(spark, log):
    for i in range(12):
        log.append(plain_records(spark, (f"k{i}", str(i)), (f"k{i}", f"{i}b")), "w", i, order_by=["value"])
    tail = log.tail(3)
    assert [r["value"] for r in tail.collect()] == ["11b", "11", "10b"]
    assert {f.split("batch=")[1][:12] for f in tail.inputFiles()} == {"000000000010", "000000000011"}
    assert log.tail(1000).count() == 24 and ParquetLog(spark, log.path).tail(0).count() == 0


def test_tail_of_an_empty_and_of_a_compacted_log(spark, folder, log):
    assert log.tail(5).count() == 0 and log.counts().count() == 0
    for i in range(3):
        log.append(plain_records(spark, ("a", f"a{i}"), (f"b{i}", f"b{i}")), "w", i, order_by=["value"])
    target = ParquetLog(spark, f"{folder}/small")
    log.compact_into(target)
    assert [r["value"] for r in target.tail(2).collect()] == ["b2", "a2"]


def test_counts_come_from_footers(spark, log):
    for i in range(3):
        log.append(plain_records(spark, *[("a", "x")] * (i + 1)), "w", i)
    counts = log.counts()
    plan = plan_of(counts)
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [block" in plan
    assert sorted(r["records"] for r in counts.collect()) == [1, 2, 3]


def test_table_counts_come_from_footers(spark, folder):
    spec = make_spec("id long,at timestamp", "id", "at", "at")
    table = ParquetTable(spark, f"{folder}/t", spec).create()
    rows = spark.range(100).selectExpr("id", "timestamp'2024-01-01' + make_interval(0,0,0,cast(id % 3 as int)) at")
    table.merge(rows.selectExpr("*", "cast(at as date) pt_date"))
    counts = table.counts(extremes=["id"])
    plan = plan_of(counts)
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id)]" in plan and "PushedGroupBy: [pt_date]" in plan
    found = [(r["pt_date"].day, *r[1:]) for r in counts.orderBy("pt_date").collect()]
    assert found == [(1, 34, 0, 99), (2, 33, 1, 97), (3, 33, 2, 98)]
    assert table.counts(by_date=False).head()["records"] == 100
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    assert metadata_counts(spark, table.path, table.schema).head()[0] == 100


def test_watching_reads_nothing_while_nothing_is_new(spark, log, monkeypatch):
    assert list(watch_log(log)) == []
    log.append(plain_records(spark, ("a", "1")), "w", 0)
    looks, tail = [], ParquetLog.tail
    monkeypatch.setattr(ParquetLog, "tail", lambda self, n: looks.append(n) or tail(self, n))
    found = []
    for newest, counts in watch_log(log, n=5, loops=4, interval=0.01):
        found.append((newest.count(), counts.groupBy().sum("records").head()[0]))
        if len(found) == 1:
            log.append(plain_records(spark, ("b", "2")), "w", 1)
    assert found == [(1, 1), (2, 2)] and looks == [5, 5]


def test_batches_read_after_a_mark(spark, log):
    for i in range(4):
        log.append(plain_records(spark, ("k", str(i))), "w", i)
    assert rows_of(log.scan(1), "value") == [("2",), ("3",)] and log.scan(3).count() == 0 and log.scan(-1).count() == 4


# writers and audits


def test_a_writer_that_returns_after_many_batches(spark, log, monkeypatch):
    from keyed_lake.sources import changelog

    monkeypatch.setattr(changelog, "_BLOCK", 2)
    log.append(plain_records(spark, ("a", "1")), "first", 7)
    for i in range(9):
        log.append(plain_records(spark, ("b", str(i))), "other", i)
    assert log.append(plain_records(spark, ("a", "1")), "first", 7).skipped
    assert log.append(plain_records(spark, ("a", "0")), "first", 3).skipped
    assert not log.append(plain_records(spark, ("a", "2")), "first", 8).skipped


def test_observed_audit(spark, folder, log):
    for i in range(3):
        log.append(records(spark, *[(k, i, 0, "x") for k in range(i + 1)]), "w", i)
    log.append(plain_records(spark, ("x", "junk")), "w", 3)
    table, audit = ParquetTable(spark, f"{folder}/t", SPEC), ProgressAudit(spark, f"{folder}/audit", every=3)
    spark.streams.addListener(audit)
    try:
        query = apply_log(
            spark, replace(SPEC, max_offsets_per_trigger=1), log, table, f"{folder}/cp", scope="global", start="earliest",
            audit=audit, available_now=True,
        )
        query.awaitTermination()
        audit.wait(query)
    finally:
        spark.streams.removeListener(audit)
    rows = audit.read().orderBy("batch").collect()
    assert sum(r["batch_size"] for r in rows) == 7 and sum(r["bad_rows"] for r in rows) == 1
    assert rows[-1]["last_offset"] == log.scan().agg(F.max("offset")).head()[0]
    assert all(r["query"] == "apply s" and r["log_time"] <= r["fetch_time"] and r["merge_ms"] <= r["batch_ms"] for r in rows)
    files = [n for _, _, names in os.walk(f"{folder}/audit") for n in names if n.endswith(".parquet")]
    assert len(files) < len(rows) and not os.path.exists(f"{table.path}/_audit")
    assert table.read().count() == 3
    with pytest.raises(TimeoutError):
        audit.wait(type("Q", (), {"runId": "none", "name": "q"}), 0.01)
