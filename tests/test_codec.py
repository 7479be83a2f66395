from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import make_spec, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keyed_lake.functions.codec import BAD, decode, encode, encode_key, encode_value, rekey, with_partition_date

SENSORS = make_spec(
    "sensor long,installed timestamp,seen timestamp,place string,level double", "sensor", "seen", "installed",
)
TEXTS = make_spec("a string,b string", "a,b", "a")
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def test_partition_date_of_good_bad_and_missing_text(spark):
    rows = [("2025-11-02 06:00:00",), ("bad",), (None,), ("",)]
    df = spark.createDataFrame(rows, "installed string")
    assert [r[0] for r in with_partition_date(df, SENSORS).select("pt_date").collect()] == [
        date(2025, 11, 2), None, None, None,
    ]


def test_compat_text_of_a_row(spark):
    df = spark.createDataFrame(
        [("31", "2025-11-02 06:00:00", "2025-11-02 10:15:30", "cellar", "11.0")], SENSORS.text_schema
    )
    out = encode(with_partition_date(df, SENSORS), SENSORS, "compat").head()
    assert tuple(out) == ("31", "31,2025-11-02 06:00:00,2025-11-02 10:15:30,cellar,11.0,2025-11-02")


def test_key_collisions(spark):
    rows = [("a", None), (None, "a"), ("a,b", "c"), ("a", "b,c"), ("", "a"), ("a", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    keys = lambda mode: [r[0] for r in df.select(encode_key(TEXTS, mode)).collect()]
    assert keys("compat") == ["a", "a", "a,b,c", "a,b,c", ",a", "a,"]
    assert len(set(keys("safe"))) == 6


HOSTILE = [
    "", " ", "  lead", "trail  ", "a,b", '"', '"quoted"', "a\nb", "a\r\nb", "\\", "\\n", "tab\t", "é漢字😀", "null", "[]",
    '["x"]', "\u0000", " ", None,
]


def test_hostile_texts_survive_safe(spark):
    spec = make_spec("id long,t string", "id", "id")
    df = spark.createDataFrame(list(enumerate(HOSTILE)), "id long, t string")
    out = decode(encode(df, spec), spec)
    assert {r["id"]: r["t"] for r in out.collect()} == dict(enumerate(HOSTILE))
    assert out.where(BAD).count() == 0


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(st.characters(exclude_categories=["Cs"]), max_size=12)), max_size=20))
def test_any_text_survives_safe(spark, values):
    spec = make_spec("id long,t string", "id", "id")
    df = spark.createDataFrame(list(enumerate(values)), "id long, t string")
    assert {r["id"]: r["t"] for r in decode(encode(df, spec), spec).collect()} == dict(enumerate(values))


@SETTINGS
@given(st.lists(st.text("abc xyz0189-", min_size=1, max_size=12), max_size=20))
def test_plain_text_survives_compat(spark, values):
    spec = make_spec("id long,t string", "id", "id")
    df = spark.createDataFrame(list(enumerate(values)), "id long, t string")
    out = decode(encode(df, spec, "compat"), spec, "compat")
    assert {r["id"]: r["t"] for r in out.collect()} == dict(enumerate(values))


def test_all_types_survive_safe(spark):
    spec = make_spec(
        "l long,i int,s short,b byte,f float,d double,c decimal,o boolean,dt date,ts timestamp,x binary,t string", "l", "l"
    )
    row = (
        2**62, -5, 7, -1, 1.5, 0.1, Decimal(12), True, date(1, 1, 1), datetime(2024, 1, 2, 3, 4, 5, 678901),
        bytearray(b"\x00\xff\x80"), "x",
    )
    df = spark.createDataFrame([row, (1, *[None] * 11)], spec.table_schema)
    assert rows_of(decode(encode(df, spec), spec).drop(BAD, "_bad_value")) == rows_of(df)


def test_compat_decode_table(spark):
    values = [
        "1,2022-01-01 00:00:00,2022-01-01 00:00:00,x,5,2022-01-01",
        "2,2022-01-01 00:00:00",
        "3,2022-01-01 00:00:00,2022-01-01 00:00:00,x,5,2022-01-01,more",
        "bad,2022-01-01 00:00:00,2022-01-01 00:00:00,x,5,2022-01-01",
        "5,nonsense,2022-01-01 00:00:00,x,5,2022-01-01",
        '6,2022-01-01 00:00:00,2022-01-01 00:00:00,"a,b",5,2022-01-01',
        "7,2022-01-01 00:00:00,2022-01-01 00:00:00,a,b,5,2022-01-01",
        None,
        "",
    ]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    out = [tuple(r) for r in decode(df, SENSORS, "compat").collect()]
    t, d = datetime(2022, 1, 1), date(2022, 1, 1)
    assert out == [
        (1, t, t, "x", 5, d), (2, t, None, None, None, None), (3, t, t, "x", 5, d), (None, t, t, "x", 5, d),
        (5, None, t, "x", 5, d), (6, t, t, "a,b", 5, d), (7, t, t, "a", None, None), (None,) * 6, (None,) * 6,
    ]


def test_safe_marks_what_it_cant_decode(spark):
    good = '["1","2022-01-01 00:00:00","2022-01-01 00:00:00","x","5","2022-01-01"]'
    values = [
        (good, False),
        (good.replace('"5"', "null"), False),
        (good.replace('"5"', '"five"'), True),
        (good.replace('"1"', "null", 1), True),
        ('["1"]', True),
        (good[:-1] + ',"more"]', True),
        ("not json", True),
        ('{"id":"1"}', True),
        ("", True),
        (None, True),
    ]
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(values)], "offset long, value string")
    out = {r["_log_offset"]: r for r in decode(df, SENSORS).collect()}
    assert [out[i][BAD] for i in range(len(values))] == [bad for _, bad in values]
    assert [out[i]["_bad_value"] for i in range(len(values))] == [v if bad else None for v, bad in values]


def test_columns_may_be_called_key_and_value(spark):
    spec = make_spec("key long,value string,timestamp timestamp", "key", "timestamp", "timestamp")
    rows = spark.createDataFrame([(1, "v", datetime(2024, 1, 1))], spec.row_schema)
    records = encode(with_partition_date(rows, spec), spec).withColumn("timestamp", F.current_timestamp())
    out = decode(records, spec).select("key", "value", "timestamp").head()
    assert tuple(out) == (1, "v", datetime(2024, 1, 1))


def test_value_encoding_of_nulls(spark):
    df = spark.createDataFrame([("a", None)], "a string, b string")
    assert df.select(encode_value(TEXTS, "compat"), encode_value(TEXTS)).head()[:] == ("a,", '["a",null]')


def test_rekey(spark):
    df = spark.createDataFrame([(1, "roof", 5, 9)], "id long, place string, level long, ts long")
    assert rekey(df, "place", "level", ["ts"]).head().asDict() == {"key": "roof", "value": "5", "ts": 9}


def test_mode_is_checked():
    with pytest.raises(ValueError, match="mode"):
        encode_key(TEXTS, "fast")


def test_a_filter_parses_the_record_once(spark):
    df = spark.createDataFrame([("[]",)], "value string")
    plan = decode(df, SENSORS).where(~F.col(BAD))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
