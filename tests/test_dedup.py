import random

import pytest
from conftest import make_spec, plan_of, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keyed_lake.functions.codec import typed
from keyed_lake.operators.dedup import compact, keep_latest, keep_latest_text
from keyed_lake.operators.replay import replay
from keyed_lake.operators.stats import batch_stats, count_rows, log_stats, log_tail

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def test_text_order_and_typed_order(spark):
    spec = make_spec("id string,n long", "id", "n")
    df = spark.createDataFrame([("1", "9"), ("1", "10"), ("2", "x"), ("2", "1")], "id string, n string")
    assert rows_of(keep_latest_text(df, spec)) == [("1", "10"), ("2", "1")]
    assert rows_of(keep_latest_text(df, spec, "compat")) == [("1", "9"), ("2", "x")]


def test_null_order_comes_last_and_null_keys_group(spark):
    df = spark.createDataFrame([(1, None), (1, 1), (2, None), (None, 1), (None, 2)], "k int, o int")
    assert rows_of(keep_latest(df, ["k"], ["o"])) == [(None, 2), (1, 1), (2, None)]


def test_ties(spark):
    df = spark.createDataFrame([(1, 1, 5, "a"), (1, 1, 7, "b"), (1, 1, 6, "c")], "k int, o int, offset int, v string")
    assert rows_of(keep_latest(df, ["k"], ["o"], ["offset"])) == [(1, 1, 7, "b")]
    assert rows_of(keep_latest(df.drop("offset"), ["k"], ["o"])) == [(1, 1, "c")]


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 5)), max_size=30), st.integers(1, 6))
def test_partitioning_does_not_matter(spark, rows, parts):
    df = spark.createDataFrame(rows, "k int, o int, v int")
    best = {}
    for k, o, v in rows:
        best[k] = max(best.get(k, (o, v)), (o, v))
    expected = sorted((k, *ov) for k, ov in best.items())
    assert rows_of(keep_latest(df.repartition(parts, F.rand()), ["k"], ["o"])) == expected


def test_plan_prunes_before_the_shuffle(spark):
    plan = plan_of(keep_latest(spark.range(100).withColumn("k", F.col("id") % 3), ["k"], ["id"]))
    assert plan.count("WindowGroupLimit") == 2 and "rangepartitioning" not in plan
    assert plan.count("Exchange") == 1


def test_a_frequent_key_sends_one_row_per_task(spark):
    # a third of all rows has one key
    df = spark.range(0, 30_000, 1, 6).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    out = keep_latest(df, ["k"], ["id"])
    assert out.count() == 20_001 and out.where("k = -1").head()["id"] == 29_997
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = keep_latest(df, ["k"], ["id"])
        out.collect()
        plan = out._jdf.queryExecution().executedPlan()
        exchange = plan
        while "Exchange" not in exchange.nodeName():
            exchange = exchange.children().head()
        assert exchange.metrics().apply("shuffleRecordsWritten").value() == 20_000 + 6
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_keys(spark):
    with pytest.raises(ValueError):
        keep_latest(spark.range(1), [], ["id"])


LOG = "key string, value string, partition int, offset long, timestamp timestamp"


def test_compact_keeps_the_last_record_and_offsets(spark):
    rows = [("a", "1", 0, 0, None), ("b", "2", 1, 0, None), ("a", "3", 0, 4, None), ("a", None, 0, 9, None)]
    log = spark.createDataFrame(rows, LOG)
    assert rows_of(compact(log), "key", "value", "offset") == [("a", None, 9), ("b", "2", 0)]


def test_tail_and_stats(spark):
    rows = [("a", "x", p, o, None) for p in (0, 1) for o in range(3)]
    log = spark.createDataFrame(rows, LOG)
    assert [(r["offset"], r["partition"]) for r in log_tail(log, 3).collect()] == [(2, 1), (2, 0), (1, 1)]
    assert rows_of(log_stats(log)) == [(0, 3, 2), (1, 3, 2)]
    empty = log.where("false")
    assert log_tail(empty).count() == 0 and log_stats(empty).count() == 0
    assert count_rows(log).head()[0] == 6
    assert "TakeOrderedAndProject" in plan_of(log_tail(log, 3))


def test_replay(spark):
    df = spark.range(3)
    assert replay(df, 4).groupBy("id").count().where("count = 4").count() == 3
    assert rows_of(replay(df, 2, "copy").where("id = 1")) == [(1, 0), (1, 1)]
    assert "Join" not in plan_of(replay(df, 4)) and "Exchange" not in plan_of(replay(df, 4))
    with pytest.raises(ValueError):
        replay(df, 0)


def test_batch_stats(spark):
    df = spark.sql(
        "select * from values (1, date'2024-01-02', timestamp'2024-01-01 10:00:00', 'abc', false),"
        " (2, null, timestamp'2024-01-01 09:00:00', null, false), (3, date'2024-01-01', null, 'x', true)"
        " as t(id, pt_date, at, s, bad)"
    )
    stats = batch_stats(df, "at", "bad")
    assert (stats.rows, stats.bad_rows, stats.dates, stats.null_dates) == (3, 1, ["2024-01-02"], 1)
    assert (stats.first_time.hour, stats.last_time.hour) == (9, 10)
    assert stats.bytes >= 2 * 24 + 3
    assert batch_stats(df.where("false")).rows == 0


def test_text_rows_tie_like_typed_rows(spark):
    spec = make_spec("id long,part long,at timestamp,v string", "id", "at")
    rows = [("1", "9", "2024-01-01", "a"), ("1", "10", "2024-01-01 00:00:00", "b"), ("2", "7", None, "a"), ("2", "07", None, "b")]
    text = spark.createDataFrame(rows, "id string, part string, at string, v string")
    typed = text.selectExpr("cast(id as long) id", "cast(part as long) part", "cast(at as timestamp) at", "v")
    chosen = keep_latest_text(text, spec)
    assert rows_of(chosen, "id", "v") == [("1", "b"), ("2", "b")]
    assert rows_of(keep_latest(typed, ["id"], ["at"]), "id", "v") == [(1, "b"), (2, "b")]


def test_text_rows_carry_a_value_once_and_keep_their_order(spark):
    spec = make_spec("id long, n int, x double, at timestamp, s string", "id", "at")
    texts = {
        "id": ["1", "2", "01", None], "n": ["1", "01", "+1", "x", None, "1 "], "x": ["0.0", "-0.0", "0", "1e0", "1.0", "NaN", "nan", "?", "a\0", "a", None],
        "at": ["2024-01-01 00:00:00", "2024-01-01", "2024-01-01T00:00:00", "soon", "later", None], "s": ["a", "", None], "more": ["p", "q", None],
    }
    draw = random.Random(5)
    rows = [tuple(draw.choice(v) for v in texts.values()) for _ in range(1500)]
    for n in (1, 2, 5, 40, 1500):
        for names in (list(texts), ["more", *[c for c in texts if c != "more"]], ["id", "n", "more", "x", "at", "s"]):
            df = spark.createDataFrame(rows[:n], ", ".join(f"{c} string" for c in texts)).select(*names)
            as_typed = lambda cs: [typed(c, spec.type_of(c)) for c in cs]
            plainly = keep_latest(df, spec.pks, as_typed(spec.order_by), as_typed(["n", "x", "s"]))
            assert keep_latest_text(df, spec).columns == names
            assert rows_of(keep_latest_text(df, spec)) == rows_of(plainly)
    lines = spark.range(0, 20000).selectExpr("string(id) id", "string(int(id * 7)) n", "string(id / 3) x", "'2024-01-01 00:00:00' at", "'' s")
    # Spark adds such columns where an order isn't by columns: the typed values would be carried beside the texts
    assert "_w0" not in plan_of(keep_latest_text(lines, spec))
