import json
import os
import shutil
from dataclasses import replace
from datetime import date, datetime

import pytest
from conftest import make_spec, rows_of
from pyspark.sql import functions as F

from keyed_lake.functions.codec import decode
from keyed_lake.sources.changelog import ParquetLog
from keyed_lake.sources.table import ParquetTable
from keyed_lake.storage import Files
from keyed_lake.streaming import pipelines
from keyed_lake.streaming.audit import audit_records, read_audit, wait_for_count, watch_log
from keyed_lake.streaming.pipelines import (
    apply_all, apply_log, await_all, ingest_all, ingest_csv, ready_to_apply, ready_to_ingest, rekey_log,
)

SENSORS = make_spec(
    "sensor long,installed timestamp,seen timestamp,place string,level double",
    "sensor", "seen", "installed", name="sensors", csv_folder="sensors", topic="sensors",
    table_folder="sensors", partitions=4,
)
INSTALLED = "2025-11-02 06:00:00"
# readings of four sensors; the last reading of a sensor is not always the last line
CHANGES = [
    (7, "10:15:00", "roof", "20.5"), (31, "10:15:30", "cellar", "11.0"), (7, "10:20:00", "roof", "21.5"),
    (402, "10:02:00", "gate", "17.2"), (31, "10:05:00", "cellar", "10.5"), (8, "10:15:00", "yard", "3.0"),
    (402, "11:00:10", "north gate", "18.0"), (402, "10:59:00", "gate", "17.5"),
]
T0, DAY = datetime(2025, 11, 2, 6), date(2025, 11, 2)
LATEST = [
    (i, T0, datetime.fromisoformat(f"2025-11-02 {t}"), p, float(v), DAY)
    for i, t, p, v in sorted({i: (i, t, p, v) for i, t, p, v in sorted(CHANGES, key=lambda c: c[1])}.values(), key=lambda c: str(c[0]))
]


def held(table):
    return table._files_in(table.parts())


def applied(table):
    """The last batch of every stream."""
    return [table.applied(stream) for stream in table.files.names(f"{table.path}/_applied") if not stream.startswith(".")]


def put_csv(folder, name, rows):
    path = f"{folder}/csv/sensors/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.writelines(f"{i},{INSTALLED},2025-11-02 {t},{p},{v}\n" for i, t, p, v in rows)


def ingest(spark, folder, **more):
    log = ParquetLog.for_spec(spark, f"{folder}/logs", SENSORS)
    query = ingest_csv(spark, SENSORS, f"{folder}/csv", log, f"{folder}/cp-in", available_now=True, **more)
    query.awaitTermination()
    return log


def apply(spark, folder, log, spec=SENSORS, **more):
    table = ParquetTable(spark, f"{folder}/table", spec)
    options = {"start": "earliest", "scope": "partition", "available_now": True, **more}
    apply_log(spark, spec, log, table, f"{folder}/cp-out", **options).awaitTermination()
    return table


@pytest.mark.parametrize("mode", ["safe", "compat"])
def test_csv_to_log_to_table(spark, folder, mode):
    put_csv(folder, "001.csv", CHANGES)
    log = ingest(spark, folder, mode=mode)
    assert log.scan().count() == 4
    if mode == "compat":
        assert rows_of(log.scan(), "key", "value")[0] == (
            "31", "31,2025-11-02 06:00:00,2025-11-02 10:15:30,cellar,11.0,2025-11-02",
        )
    table = apply(spark, folder, log, mode=mode)
    assert rows_of(table.read()) == LATEST


def test_restarts_take_up_where_they_stopped(spark, folder):
    put_csv(folder, "a/001.csv", CHANGES[:3])
    put_csv(folder, "b/deep/002.csv", CHANGES[3:6])
    log = ingest(spark, folder, max_files_per_trigger=1)
    table = apply(spark, folder, log)
    assert table.read().count() == 4
    before = held(table)
    ingest(spark, folder)
    assert held(apply(spark, folder, log)) == before
    put_csv(folder, "c/003.csv", CHANGES[6:])
    ingest(spark, folder)
    table = apply(spark, folder, log)
    assert rows_of(table.read(), "sensor", "level")[1] == (402, 18.0)
    assert held(table) != before and applied(table) == [1]


def test_one_log_file_per_batch_and_audit(spark, folder):
    for i, change in enumerate(CHANGES[:4]):
        put_csv(folder, f"{i}.csv", [change])
        ingest(spark, folder)
    log = ParquetLog(spark, f"{folder}/logs/sensors")
    assert len(log.batches()) == 4
    table = apply(spark, folder, log, replace(SENSORS, max_offsets_per_trigger=1), audit=f"{folder}/audit")
    levels = rows_of(table.read(), "sensor", "level")
    assert levels == [(31, 11.0), (402, 17.2), (7, 21.5)]
    audit = read_audit(spark, f"{folder}/audit")
    assert audit.count() == 4
    row = audit.head().asDict()
    assert (row["topic"], row["table_folder"], row["csv_folder"]) == ("sensors",) * 3
    assert (row["batch_size"], row["bad_rows"], row["partition_values"]) == (1, 0, ["2025-11-02"])
    assert row["log_time"] <= row["fetch_time"] <= row["partition_time"] <= row["merge_time"]
    value = json.loads(audit_records(audit).head()["value"])
    assert value["batch_size"] == 1 and value["topic"] == "sensors"


def test_a_batch_that_runs_again_changes_nothing(spark, folder):
    put_csv(folder, "1.csv", CHANGES)
    log = ingest(spark, folder)
    table = apply(spark, folder, log, audit=f"{folder}/audit")
    before = held(table)
    # the job died after the commit of the table and before that of the checkpoint
    for name in os.listdir(f"{folder}/cp-out/commits"):
        os.remove(f"{folder}/cp-out/commits/{name}")
    table = apply(spark, folder, log, audit=f"{folder}/audit")
    assert held(table) == before and read_audit(spark, f"{folder}/audit").count() == 1
    for name in os.listdir(f"{folder}/cp-in/commits"):
        os.remove(f"{folder}/cp-in/commits/{name}")
    assert len(ingest(spark, folder).batches()) == 1


def test_a_new_checkpoint_is_a_new_stream(spark, folder):
    put_csv(folder, "1.csv", CHANGES)
    log = ingest(spark, folder)
    table = apply(spark, folder, log)
    shutil.move(f"{folder}/cp-out", f"{folder}/cp-old")
    assert applied(apply(spark, folder, log)) == [0, 0]
    assert rows_of(table.read()) == LATEST


def test_start_latest_skips_the_past_but_nothing_after_a_restart(spark, folder):
    put_csv(folder, "1.csv", CHANGES[:1])
    log = ingest(spark, folder)
    assert apply(spark, folder, log, start="latest").read().count() == 0
    # comes in while the job is down
    put_csv(folder, "2.csv", CHANGES[6:])
    ingest(spark, folder)
    assert rows_of(apply(spark, folder, log, start="latest").read(), "sensor") == [(402,)]


def test_bad_records_are_put_aside(spark, folder):
    log = ParquetLog(spark, f"{folder}/log").create("sensors")
    good = f'["1","{INSTALLED}","{INSTALLED}","x","5","2025-11-02"]'
    rows = [("1", good), ("2", "junk"), ("3", good.replace('"1"', "null", 1)), ("4", None)]
    log.append(spark.createDataFrame(rows, "key string, value string"), "w", 0)
    table = apply(spark, folder, log, quarantine=f"{folder}/bad")
    assert rows_of(table.read(), "sensor") == [(1,)]
    assert sorted(str(r["value"]) for r in spark.read.parquet(f"{folder}/bad").collect()) == sorted(
        ["junk", good.replace('"1"', "null", 1), "None"]
    )


def test_compat_keeps_rows_without_key(spark, folder):
    log = ParquetLog(spark, f"{folder}/log").create("sensors")
    log.append(spark.createDataFrame([("1", None)], "key string, value string"), "w", 0)
    assert rows_of(apply(spark, folder, log, mode="compat").read()) == [(None,) * 6]


def test_archive(spark, folder):
    for i in range(3):
        put_csv(folder, f"{i}.csv", CHANGES[i : i + 1])
    ingest(spark, folder, max_files_per_trigger=1)
    put_csv(folder, "late.csv", CHANGES[6:])
    ingest(spark, folder)
    archived = [n for _, _, names in os.walk(f"{folder}/csv/_archive") for n in names if n.endswith(".csv")]
    assert archived  # Spark moves the files of a batch some time after its end
    assert ParquetLog(spark, f"{folder}/logs/sensors").scan().count() == 4


def test_rekey(spark, folder):
    put_csv(folder, "1.csv", CHANGES[:2])
    ingest(spark, folder)
    put_csv(folder, "2.csv", CHANGES[5:])
    source = ingest(spark, folder)
    source.append(spark.createDataFrame([("x", "junk")], "key string, value string"), "other", 0)
    target = ParquetLog(spark, f"{folder}/target").create("levels", 3)
    rekey_log(
        spark, SENSORS, source, target, f"{folder}/cp-re", "place", "level", available_now=True,
        quarantine=f"{folder}/bad",
    ).awaitTermination()
    assert rows_of(target.scan(), "key", "value") == [
        ("cellar", "11.0"), ("north gate", "18.0"), ("roof", "20.5"), ("yard", "3.0"),
    ]
    assert spark.read.parquet(f"{folder}/bad").count() == 1


def test_rekey_with_dedup_keeps_the_time(spark, folder):
    rows = decode_rows(spark)
    source = ParquetLog(spark, f"{folder}/source").create("sensors")
    source.append(rows, "w", 0)
    target = ParquetLog(spark, f"{folder}/target").create("levels", 3)
    rekey_log(
        spark, SENSORS, source, target, f"{folder}/cp", "place", "level", dedup=True, available_now=True
    ).awaitTermination()
    assert rows_of(target.scan(), "key", "value") == [
        ("cellar", "11.0"), ("north gate", "18.0"), ("roof", "21.5"), ("yard", "3.0"),
    ]
    assert target.scan().select("timestamp").distinct().head() == source.scan().select("timestamp").distinct().head()


def decode_rows(spark):
    """All changes as records, without dedup."""
    df = spark.createDataFrame(
        [(str(i), INSTALLED, f"2025-11-02 {t}", p, v) for i, t, p, v in CHANGES], SENSORS.text_schema
    )
    return pipelines.encode(pipelines.with_partition_date(df, SENSORS), SENSORS)


def test_records_of_one_micro_batch_are_reduced_by_order_then_offset(spark, folder):
    log = ParquetLog(spark, f"{folder}/log").create("sensors")
    log.append(decode_rows(spark), "w", 0)
    assert rows_of(apply(spark, folder, log).read()) == LATEST
    assert decode(log.scan(), SENSORS).columns[-5:-2] == ["_log_partition", "_log_offset", "_log_timestamp"]


def test_many_tables(spark, folder):
    put_csv(folder, "1.csv", CHANGES)
    other = replace(SENSORS, name="other", topic="other", table_folder="other")
    gone = replace(SENSORS, name="gone", topic="gone", csv_folder="gone")
    specs = {"sensors": SENSORS, "other": other, "gone": gone}
    assert set(ready_to_ingest(spark, specs, f"{folder}/csv")) == {"sensors", "other"}
    queries = ingest_all(spark, specs, f"{folder}/csv", f"{folder}/logs", f"{folder}/cp", available_now=True, archive=False)
    await_all(spark, queries)
    assert set(ready_to_apply(spark, specs, f"{folder}/logs")) == {"sensors", "other"}
    queries = apply_all(
        spark, specs, f"{folder}/logs", f"{folder}/tables", f"{folder}/cp", start="earliest", available_now=True
    )
    await_all(spark, queries)
    for spec in (SENSORS, other):
        assert rows_of(ParquetTable(spark, f"{folder}/tables/{spec.table_folder}", spec).read()) == LATEST
    with pytest.raises(FileNotFoundError):
        ingest_all(spark, {"gone": gone}, f"{folder}/csv", f"{folder}/logs", f"{folder}/cp")


def test_a_failing_table_does_not_stop_the_others(spark, folder):
    put_csv(folder, "1.csv", CHANGES)
    other = replace(SENSORS, name="other", topic="other", table_folder="other")
    specs = {"other": other, "sensors": SENSORS}
    await_all(spark, ingest_all(spark, specs, f"{folder}/csv", f"{folder}/logs", f"{folder}/cp", available_now=True, archive=False))
    os.makedirs(f"{folder}/tables/other/pt_date=2025-11-02")
    with open(f"{folder}/tables/other/pt_date=2025-11-02/x.parquet", "w") as f:
        f.write("no Parquet")
    pools = []
    merge = pipelines.merge_batch

    def noted(batch, *args):
        pools.append(batch.sparkSession.sparkContext.getLocalProperty("spark.scheduler.pool"))
        return merge(batch, *args)

    pipelines.merge_batch = noted
    try:
        queries = apply_all(spark, specs, f"{folder}/logs", f"{folder}/tables", f"{folder}/cp", start="earliest", available_now=True)
        with pytest.raises(pipelines.TablesFailed) as failed:
            await_all(spark, queries)
    finally:
        pipelines.merge_batch = merge
    assert list(failed.value.errors) == ["apply other"] and set(pools) == {"apply other", "apply sensors"}
    assert rows_of(ParquetTable(spark, f"{folder}/tables/sensors", SENSORS).read()) == LATEST
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_a_failing_stream_stops_the_others_if_asked(spark, folder):
    put_csv(folder, "1.csv", CHANGES)
    log = ingest(spark, folder)
    fine = apply_log(spark, SENSORS, log, ParquetTable(spark, f"{folder}/t1", SENSORS), f"{folder}/cp1")

    def fail(batch, number):
        raise RuntimeError("no")

    bad = log.stream().writeStream.foreachBatch(fail).option("checkpointLocation", f"{folder}/cp2").start()
    with pytest.raises(Exception):
        await_all(spark, [fine, bad], stop_on_failure=True)
    fine.awaitTermination(60)
    assert not fine.isActive and not bad.isActive


def test_checkpoint_and_arguments_are_required(spark, folder):
    put_csv(folder, "1.csv", CHANGES)
    log = ParquetLog.for_spec(spark, f"{folder}/logs", SENSORS)
    with pytest.raises(ValueError, match="checkpoint"):
        ingest_csv(spark, SENSORS, f"{folder}/csv", log, "")
    with pytest.raises(ValueError, match="start"):
        apply(spark, folder, log, start="middle")


def test_adaptive_execution_is_on_inside_a_batch(spark, folder):
    put_csv(folder, "1.csv", CHANGES)
    log = ingest(spark, folder)
    seen = []
    query = (
        log.stream().writeStream.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True)
        .foreachBatch(lambda df, _: seen.append(df.sparkSession.conf.get("spark.sql.adaptive.enabled"))).start()
    )
    query.awaitTermination()
    assert seen == ["true"]


def test_wait_for_count():
    counts = iter([0, 1, 3])
    assert wait_for_count(lambda: next(counts), 3, timeout=5, interval=0.01) >= 0
    with pytest.raises(ValueError, match="more than"):
        wait_for_count(lambda: 4, 3)
    with pytest.raises(TimeoutError):
        wait_for_count(lambda: 1, 3, timeout=0.05, interval=0.02)


def test_watch_log(spark, folder):
    log = ParquetLog(spark, f"{folder}/log").create("t")
    assert list(watch_log(log.scan, loops=1)) == []
    one = spark.range(1).select(F.lit("k").alias("key"), F.lit("v").alias("value"))
    log.append(one, "w", 0)
    found = []
    for number, (tail, stats) in enumerate(watch_log(log.scan, n=5, loops=3, interval=0.01)):
        found.append((tail.count(), stats.head()["records"]))
        if number == 0:
            log.append(one, "w", 1)
    assert found == [(1, 1), (2, 2)]
    assert Files(spark).exists(log.data)


# records that must not be lost or take a wrong turn


def test_latest_goes_on_after_the_log_was_made_anew(spark, folder):
    put_csv(folder, "1.csv", CHANGES[:1])
    log = ingest(spark, folder)
    assert apply(spark, folder, log, start="latest").read().count() == 0
    log.create("sensors", 4, recreate=True)
    log.append(decode_rows(spark).limit(1), "other", 0)
    assert apply(spark, folder, log, start="latest").read().count() == 1


def test_latest_has_no_empty_triggers(spark, folder):
    log = ParquetLog(spark, f"{folder}/log").create("sensors")
    for i in range(4):
        log.append(decode_rows(spark), "w", i)
    table = apply(spark, folder, log, replace(SENSORS, max_offsets_per_trigger=1), start="latest")
    log.append(decode_rows(spark).limit(1), "w", 4)
    before = len(os.listdir(f"{folder}/cp-out/commits"))
    apply(spark, folder, log, replace(SENSORS, max_offsets_per_trigger=1), start="latest")
    new = [n for n in os.listdir(f"{folder}/cp-out/commits") if not n.startswith(".")]
    assert table.read().count() == 1 and len(new) - before <= 1


def test_records_per_trigger_and_not_files(spark, folder):
    log = ParquetLog(spark, f"{folder}/log").create("sensors")
    for i in range(8):
        log.append(decode_rows(spark).limit(1), "w", i)
    assert applied(apply(spark, folder, log)) == [0]
    log.append(decode_rows(spark), "w", 8)
    small = replace(SENSORS, max_offsets_per_trigger=2)
    table = ParquetTable(spark, f"{folder}/table2", small)
    apply_log(spark, small, log, table, f"{folder}/cp2", start="earliest", scope="partition", available_now=True).awaitTermination()
    assert applied(table)[0] >= 3


def test_an_older_record_read_later_does_not_win(spark, folder):
    log = ParquetLog(spark, f"{folder}/log").create("sensors")
    row = lambda v: spark.createDataFrame([("1", f'["1","{INSTALLED}","{INSTALLED}","{v}","5","2025-11-02"]')], "key string, value string")
    log.append(row("first"), "w", 0)
    log.append(row("second"), "w", 1)
    for k, batch in enumerate(reversed(log.batches())):  # the file source goes by file times
        path = f"{log.data}/block=00000000/{batch}"
        for name in os.listdir(path):
            os.utime(f"{path}/{name}", (1_700_000_000 + k, 1_700_000_000 + k))
    table = apply(spark, folder, log, replace(SENSORS, max_offsets_per_trigger=1))
    assert applied(table)[0] >= 1
    assert rows_of(table.read(), "place") == [("second",)]


def test_offsets_of_another_log_are_not_compared(spark, folder):
    row = lambda v: spark.createDataFrame([("1", f'["1","{INSTALLED}","{INSTALLED}","{v}","5","2025-11-02"]')], "key string, value string")
    old = ParquetLog(spark, f"{folder}/old").create("sensors")
    for i in range(3):
        old.append(row("old"), "w", i)
    apply(spark, folder, old)
    new = ParquetLog(spark, f"{folder}/new").create("sensors")
    new.append(row("new"), "w", 0)
    shutil.move(f"{folder}/cp-out", f"{folder}/cp-of-old")
    assert rows_of(apply(spark, folder, new).read(), "place") == [("new",)]


def test_bad_lines_are_put_aside_before_dedup(spark, folder):
    os.makedirs(f"{folder}/csv/sensors")
    good = f"7,{INSTALLED},2025-11-02 10:00:00,roof,1.5"
    lines = [good, good + ",SURPLUS", good.replace("7,", ",", 1), good.replace("7,", ",", 1), f"7,{INSTALLED},soon,roof,2.5",
             f"8,{INSTALLED}", f"9,{INSTALLED},2025-11-02 10:00:00,,"]
    with open(f"{folder}/csv/sensors/1.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    log = ingest(spark, folder, quarantine=f"{folder}/aside")
    aside = spark.read.parquet(f"{folder}/aside")
    assert aside.count() == 5
    assert sorted(r["_corrupt"] for r in aside.where("_corrupt is not null").collect()) == sorted([lines[1], lines[5]])
    assert rows_of(apply(spark, folder, log).read(), "sensor", "level") == [(7, 1.5), (9, None)]


def test_a_compacted_log_is_followed(spark, folder):
    put_csv(folder, "1.csv", CHANGES[:5])
    log = ingest(spark, folder)
    specs = {"sensors": SENSORS}
    again = lambda: await_all(spark, apply_all(
        spark, specs, f"{folder}/logs", f"{folder}/tables", f"{folder}/cp", compacted_root=f"{folder}/compacted",
        start="earliest", scope="partition", available_now=True,
    ))
    again()
    put_csv(folder, "2.csv", CHANGES[5:])
    ingest(spark, folder)
    again()
    assert rows_of(ParquetTable(spark, f"{folder}/tables/sensors", SENSORS).read()) == LATEST
    assert len(ParquetLog(spark, f"{folder}/compacted/sensors").batches()) == len(log.batches()) == 2


def test_audit_rows_go_to_a_log(spark, folder):
    put_csv(folder, "1.csv", CHANGES)
    log = ingest(spark, folder)
    audit = ParquetLog(spark, f"{folder}/audit-log").create("audit")
    apply(spark, folder, log, audit=audit)
    assert [json.loads(r["value"])["batch_size"] for r in audit.scan().collect()] == [4]


def test_rekey_to_a_log_without_a_folder(spark, folder):
    class Sink:
        taken = []

        def append(self, records, writer, batch_id, order_by=None):
            self.taken += records.select("key", "value").collect()

    source = ParquetLog(spark, f"{folder}/source").create("sensors")
    source.append(decode_rows(spark), "w", 0)
    rekey_log(spark, SENSORS, source, Sink(), f"{folder}/cp", "place", "level", available_now=True).awaitTermination()
    assert len(Sink.taken) == len(CHANGES)
