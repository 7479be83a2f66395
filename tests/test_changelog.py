import pyarrow.parquet as pq
import pytest
from conftest import make_spec, plan_of, rows_of
from pyspark.sql import functions as F

from keyed_lake.operators.replay import replay
from keyed_lake.sources.changelog import LOG_SCHEMA, ParquetLog, rows_per_file


@pytest.fixture
def log(spark, folder):
    return ParquetLog(spark, f"{folder}/log").create("topic", partitions=4)


def records(spark, *pairs):
    return spark.createDataFrame(list(pairs), "key string, value string")


def test_create_is_idempotent_and_recreate_drops(spark, log):
    log.append(records(spark, ("a", "1")), "w", 0)
    settings = dict(log.create("other", 9).settings)
    uid = settings.pop("uid")
    assert settings == {"topic": "topic", "partitions": 4, "compact": True, "first": 0}
    assert log.scan().count() == 1
    assert log.create("other", 9, recreate=True).settings["topic"] == "other" and log.uid() == uid
    assert log.scan().count() == 0 and log.scan().schema == LOG_SCHEMA
    with pytest.raises(TypeError):
        log.create("other", recreate="false")


def test_append_and_scan(spark, log):
    done = log.append(records(spark, ("a", "1"), ("b", None), ("a", "2")), "w", 0, order_by=["value"])
    assert done.rows == 3 and not done.skipped
    log.append(records(spark, ("a", "3")), "w", 1)
    rows = log.scan().collect()
    by_key = {}
    for r in sorted(rows, key=lambda r: r["offset"]):
        by_key.setdefault((r["key"], r["partition"]), []).append(r["value"])
    assert {k: v for (k, _), v in by_key.items()} == {"a": ["1", "2", "3"], "b": [None]}
    assert len({r["offset"] for r in rows}) == 4 and {r["topic"] for r in rows} == {"topic"}
    assert all(0 <= r["partition"] < 4 and r["timestamp"] for r in rows)


def test_a_batch_is_written_once(spark, log):
    log.append(records(spark, ("a", "1")), "w", 3)
    assert log.append(records(spark, ("a", "other")), "w", 3).skipped
    log.append(records(spark, ("b", "1")), "w2", 3)
    assert rows_of(log.scan(), "key", "value") == [("a", "1"), ("b", "1")]


def test_an_empty_batch_leaves_no_folder(spark, log):
    assert log.append(records(spark, ("a", "1")).where("false"), "w", 0).rows == 0
    assert log.batches() == [] and log.next_offset() == 0 and log.files.names(f"{log.path}/_staging") == []


def test_crash_before_publishing(spark, log, monkeypatch):
    from keyed_lake.storage import Files

    def crash(self, *paths):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as patch:
        patch.setattr(Files, "publish_folder", crash)
        with pytest.raises(RuntimeError):
            log.append(records(spark, ("a", "1")), "w", 0)
    assert log.scan().count() == 0
    log.append(records(spark, ("a", "1")), "w", 0)
    assert log.scan().count() == 1


def test_order_within_a_batch_over_many_tasks(spark, log):
    df = spark.range(5000).select((F.col("id") % 7).cast("string").alias("key"), F.col("id").cast("string").alias("value"), "id")
    log.append(df.repartition(5), "w", 0, order_by=["id"])
    wrong = log.scan().selectExpr("*", "lag(cast(value as long)) over (partition by key order by offset) as before")
    assert wrong.where("before > cast(value as long)").count() == 0
    assert log.scan().agg(F.countDistinct("offset")).head()[0] == 5000


def test_ordered_append_splits_a_frequent_key(spark, log):
    df = spark.range(40_000).select(
        F.lit("hot").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("value"), F.xxhash64("id").alias("at")
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        log.append(df, "w", 0, order_by=["at"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(log.scan().inputFiles()) == 3
    assert log.scan().select("partition").distinct().count() == 1


def test_append_of_deduped_rows_adds_no_shuffle(spark, log, monkeypatch):
    plans = []
    monkeypatch.setattr(ParquetLog, "_publish", lambda self, rows, *a: plans.append(plan_of(rows)))
    log.append(spark.range(10).selectExpr("cast(id as string) as key", "'x' as value"), "w", 0)
    assert "Exchange" not in plans[0]


def test_compaction(spark, log, folder):
    for i in range(3):
        log.append(records(spark, ("a", f"a{i}"), (f"k{i}", "x")), "w", i)
    target = ParquetLog(spark, f"{folder}/small")
    assert log.compact_into(target).rows == 4
    assert log.compact_into(target).skipped
    assert rows_of(target.scan(), "key", "value") == [("a", "a2"), ("k0", "x"), ("k1", "x"), ("k2", "x")]
    kept = {r["key"]: r["offset"] for r in target.scan().collect()}
    assert kept["a"] == log.scan().where("key = 'a'").agg(F.max("offset")).head()[0]
    assert target.next_offset() == log.next_offset() and log.scan().count() == 6
    log.append(records(spark, ("a", "late"), ("a", "later"), ("k9", "x")), "w", 3, order_by=["value"])
    assert log.compact_into(target).rows == 2 and log.compact_into(target).skipped
    assert rows_of(target.scan().where("key = 'a'"), "value") == [("a2",), ("later",)]
    assert target.next_offset() == log.next_offset()
    with pytest.raises(ValueError, match="other records"):
        target.compact_into(log)


def test_files_hold_no_more_rows_than_wanted(spark, log):
    log.append(replay(records(spark, ("a", "1")), 25), "w", 0, rows_per_file=10)
    sizes = [r[0] for r in log.scan().groupBy(F.input_file_name()).count().select("count").collect()]
    assert sum(sizes) == 25 and max(sizes) <= 10
    assert rows_per_file(make_spec("id long", "id", "id", max_offsets_per_trigger=7)) == 7


def test_numbers_and_offsets_go_on_after_a_new_start(spark, log):
    log.append(records(spark, ("a", "1")), "w", 0)
    end = log.scan().head()["offset"]
    log.create("topic", recreate=True)
    assert log.append(records(spark, ("a", "2")), "w", 0).rows == 1
    assert log.scan().head()["offset"] > end


def test_globs_open_newer_batches_only(spark, log, monkeypatch):
    from keyed_lake.sources import changelog

    monkeypatch.setattr(changelog, "_BLOCK", 3)
    for i in range(11):
        log.append(records(spark, ("k", str(i))), "w", i)
    for after in (-1, 0, 4, 8, 9):
        found = sorted(int(r["value"]) for r in log.scan(after).collect())
        assert found == list(range(after + 1, 11))
    assert log.recorded_rows() == 11 and len(log.batches(1)) == 2
    assert log.append(records(spark, ("k", "again")), "w", 10).skipped


def test_an_append_looks_at_the_newest_blocks_only(spark, log, monkeypatch):
    from keyed_lake.sources import changelog
    from keyed_lake.storage import Files

    monkeypatch.setattr(changelog, "_BLOCK", 100)
    for i in range(1, 500):
        log.files.mkdirs(f"{log.data}/{changelog._block(i)}/batch={i:012d}-1-500-w-{i}")
    listed = []
    names = Files.names
    monkeypatch.setattr(Files, "names", lambda self, path: listed.append(names(self, path)) or listed[-1])
    assert log.append(records(spark, ("a", "1")), "w", 500).rows == 1
    assert max(map(len, listed)) <= 100 and len(listed) <= 8
    assert log.next_number() == 501


def test_files_follow_the_rows_and_not_the_tasks(spark, log):
    many = spark.range(0, 2000, 1, 50).selectExpr("id AS key", "id AS value")
    log.append(many, "w", 0)
    log.append(many, "w", 1, order_by=["value"])
    log.append(many, "w", 2, rows_per_file=500)
    files = {}
    for f in log.scan().inputFiles():
        files.setdefault(f.split("/")[-2].split("-")[0], []).append(f)
    assert [len(files[b]) for b in sorted(files)[:2]] == [1, 1] and len(files[sorted(files)[2]]) <= 10
    per_file = log.scan().groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"), F.min("offset").alias("a"), F.max("offset").alias("z"))
    held = per_file.orderBy("a").collect()
    assert max(r["n"] for r in held if r["f"] in files[sorted(files)[2]]) <= 500
    assert all(x["z"] < y["a"] for x, y in zip(held, held[1:]))  # each file keeps to a range of offsets
    first = log.scan().where(F.col("offset") < F.lit(str(1 << 64)).cast("decimal(38,0)")).orderBy("offset").select("value").collect()
    assert [int(r["value"]) for r in first] == list(range(2000)) and log.recorded_rows() == 6000
    assert log.files.names(f"{log.path}/_staging") == []


def test_a_file_can_be_read_by_several_tasks(spark, log):
    many = spark.range(60_000).select(F.md5(F.col("id").cast("string")).alias("key"))
    log.append(many.withColumn("value", F.concat(*[F.md5(F.concat("key", F.lit(str(i)))) for i in range(4)])).coalesce(1), "w", 0)
    (file,) = [f.removeprefix("file://") for f in log.scan().inputFiles()]
    assert pq.ParquetFile(file).metadata.num_row_groups > 1 and log.scan().count() == 60_000
