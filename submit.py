"""Run one job with spark-submit: `spark-submit submit.py ingest --specs ... `."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from keyed_lake import (
    KafkaLog,
    ParquetLog,
    ParquetTable,
    apply_all,
    await_all,
    ingest_all,
    load_specs,
    rekey_log,
    wait_for_count,
    watch_log,
)


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str, *required: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=text)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        return sub

    def stream_options(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--mode", choices=["safe", "compat"], default="safe")
        sub.add_argument("--once", action="store_true", help="take what is there and stop")

    ingest = job("ingest", "CSV folders to logs", "specs", "csv", "logs", "checkpoints")
    ingest.add_argument("--servers", help="Kafka servers; the logs are existing topics then, named by the specs")
    ingest.add_argument("--recreate", action="store_true", help="drop the logs first")
    ingest.add_argument("--csv-option", action="append", default=[], metavar="NAME=VALUE", help="a Spark CSV option")
    stream_options(ingest)
    apply = job("apply", "logs to tables", "specs", "logs", "tables", "checkpoints")
    apply.add_argument("--scope", choices=["batch", "partition", "global"], default="batch")
    apply.add_argument("--start", choices=["latest", "earliest"], default="latest")
    apply.add_argument("--on-conflict", choices=["last_batch", "newest"], default="last_batch")
    apply.add_argument("--format", choices=["parquet", "delta"], default="parquet", help="of the tables")
    apply.add_argument("--servers", help="Kafka servers; the logs are topics then, named by the specs")
    apply.add_argument("--continuous", action="store_true", help="go on compacting, as a stream for each log")
    apply.add_argument("--compacted", help="root of compacted logs, brought up to date first and applied instead")
    stream_options(apply)
    rekey = job("rekey", "log to log", "specs", "table", "source", "target", "checkpoints", "key", "value")
    rekey.add_argument("--dedup", action="store_true")
    rekey.add_argument("--servers", help="Kafka servers; source and target are topics then")
    rekey.add_argument("--quarantine", help="folder of records that can't be decoded")
    stream_options(rekey)
    job("compact", "append the last record per key of what is new to another log", "source", "target")
    count = job("count", "rows of a table", "specs", "table", "path")
    count.add_argument("--expect", type=int, help="wait until the table has this many rows")
    tail = job("tail", "newest records of a log")
    tail.add_argument("--log", help="folder of a log")
    tail.add_argument("--servers", help="Kafka servers, with --topic")
    tail.add_argument("--topic")
    tail.add_argument("--records", type=int, default=100)
    tail.add_argument("--loop", type=int, default=1)
    tail.add_argument("--interval", type=float, default=1)
    job("export", "table to CSV", "specs", "table", "path", "output")
    return parser.parse_args()


def main() -> None:
    a = arguments()
    spark = SparkSession.builder.getOrCreate()
    specs = load_specs(spark, a.specs) if "specs" in a else {}
    if a.job == "ingest":
        csv_options = dict(o.split("=", 1) for o in a.csv_option)
        options = {"servers": a.servers, "recreate": a.recreate, "mode": a.mode, "available_now": a.once, "csv_options": csv_options}
        await_all(spark, ingest_all(spark, specs, a.csv, a.logs, a.checkpoints, **options))
    elif a.job == "apply":
        options = {
            "scope": a.scope, "start": a.start, "mode": a.mode, "available_now": a.once, "on_conflict": a.on_conflict,
            "compacted_root": a.compacted, "continuous": a.continuous, "servers": a.servers, "table_format": a.format,
        }
        await_all(spark, apply_all(spark, specs, a.logs, a.tables, a.checkpoints, **options))
    elif a.job == "rekey":
        spec = specs[a.table]
        if a.servers:
            source, target = KafkaLog(spark, a.servers, a.source), KafkaLog(spark, a.servers, a.target)
        else:
            source = ParquetLog(spark, a.source)
            target = ParquetLog(spark, a.target).create(a.target.rstrip("/").rsplit("/", 1)[-1], spec.partitions)
        query = rekey_log(
            spark, spec, source, target, f"{a.checkpoints.rstrip('/')}/rekey-{a.table}",
            a.key, a.value, dedup=a.dedup, mode=a.mode, available_now=a.once, quarantine=a.quarantine,
        )
        await_all(spark, [query])
    elif a.job == "compact":
        print(ParquetLog(spark, a.source).compact_into(ParquetLog(spark, a.target)))
    elif a.job == "count":
        table = ParquetTable(spark, a.path, specs[a.table])
        if a.expect is not None:
            print(f"{a.expect} rows after {wait_for_count(lambda: table.read().count(), a.expect):.0f} s")
        else:
            print(f"{table.read().count()} rows in {a.path}")
    elif a.job == "tail":
        log = KafkaLog(spark, a.servers, a.topic).scan if a.servers else ParquetLog(spark, a.log)
        for newest, stats in watch_log(log, a.records, a.loop, a.interval):
            newest.show(a.records, truncate=False)
            stats.show()
    else:
        ParquetTable(spark, a.path, specs[a.table]).export_csv(a.output)


if __name__ == "__main__":
    main()
