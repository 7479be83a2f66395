import pytest
from conftest import make_spec
from pyspark.sql import types as T

from keyed_lake.spec import load_specs, parse_specs, parse_type


def xml(body: str, name: str = "t") -> str:
    return f'<tableInfos><table name="{name}">{body}</table></tableInfos>'


FULL = (
    "<csvFolder>f</csvFolder><topic>p</topic><deltaFolder>d</deltaFolder><columns>C1, c2 ,C3</columns><pks>C1</pks>"
    "<types>int,timestamp,str</types><partitionBy>C2</partitionBy><orderBy>c2,c3</orderBy>"
)


@pytest.mark.parametrize(
    "name, expected",
    [
        ("string", T.StringType()), ("str", T.StringType()), ("StringType", T.StringType()),
        (" INT ", T.IntegerType()), ("integer", T.IntegerType()), ("IntegerType", T.IntegerType()),
        ("long", T.LongType()), ("short", T.ShortType()), ("ByteType", T.ByteType()),
        ("float", T.FloatType()), ("doubletype", T.DoubleType()), ("decimal", T.DecimalType(10, 0)),
        ("decimal(12,2)", T.DecimalType(12, 2)), ("boolean", T.BooleanType()), ("date", T.DateType()),
        ("time", T.TimestampType()), ("TimestampType", T.TimestampType()), ("binary", T.BinaryType()),
    ],
)
def test_type_names(name, expected):
    assert parse_type(name) == expected


@pytest.mark.parametrize("name", ["bool", "null", "NullType", "data", "DataType", "array", "strtype", "inttype", ""])
def test_unknown_type_names(name):
    with pytest.raises(ValueError):
        parse_type(name)


def test_full_spec():
    spec = parse_specs(xml(FULL))["t"]
    assert spec.columns == ("c1", "c2", "c3") and spec.pks == ("c1",) and spec.order_by == ("c2", "c3")
    assert (spec.csv_folder, spec.topic, spec.table_folder) == ("f", "p", "d")
    assert (spec.partitions, spec.compact, spec.processing_time) == (10, True, 5)
    assert spec.max_offsets_per_trigger == 5_000_000
    assert spec.table_schema.simpleString() == "struct<c1:int,c2:timestamp,c3:string,pt_date:date>"
    assert all(f.nullable for f in spec.table_schema)
    assert {f.dataType for f in spec.text_schema} == {T.StringType()}


def test_optional_elements():
    body = FULL.replace("<types>int,timestamp,str</types>", "").replace("<partitionBy>C2</partitionBy>", "")
    body += "<partitions>3</partitions><compact> False </compact><processingTime>7</processingTime>"
    spec = parse_specs(xml(body + "<maxOffsetsPerTrigger>9</maxOffsetsPerTrigger>"))["t"]
    assert spec.types == (T.StringType(),) * 3
    assert spec.partition_column is None and spec.table_columns == ["c1", "c2", "c3"]
    assert (spec.partitions, spec.compact, spec.processing_time, spec.max_offsets_per_trigger) == (3, False, 7, 9)


@pytest.mark.parametrize(
    "change, message",
    [
        (("<pks>C1</pks>", "<pks>c9</pks>"), "pk column c9"),
        (("<pks>C1</pks>", "<pks>,</pks>"), "pks can't be empty"),
        (("<pks>C1</pks>", ""), "pks is required"),
        (("<orderBy>c2,c3</orderBy>", ""), "orderBy is required"),
        (("<orderBy>c2,c3</orderBy>", "<orderBy>c9</orderBy>"), "orderBy column c9"),
        (("int,timestamp,str", "int,timestamp"), "2 types for 3 columns"),
        (("int,timestamp,str", "int,timestamp,str,str"), "4 types for 3 columns"),
        (("<partitionBy>C2", "<partitionBy>c1"), "must be a timestamp"),
        (("<partitionBy>C2", "<partitionBy>c8"), "not in columns"),
        (("C1, c2 ,C3", "c1,c2,c2"), "duplicate columns"),
        (("</orderBy>", "</orderBy><compact>ture</compact>"), "compact must be true or false"),
        (("</orderBy>", "</orderBy><partitions>0</partitions>"), "partitions must be at least 1"),
    ],
)
def test_bad_specs(change, message):
    with pytest.raises(ValueError, match=message):
        parse_specs(xml(FULL.replace(*change)))


def test_duplicate_and_missing_names():
    one = f'<table name="a">{FULL}</table>'
    with pytest.raises(ValueError, match="duplicate name"):
        parse_specs(f"<x>{one}{one}</x>")
    with pytest.raises(ValueError, match="needs a name"):
        parse_specs(f"<x><table>{FULL}</table></x>")


def test_load_from_a_file(spark, tmp_path):
    path = tmp_path / "spec.xml"
    path.write_text('<?xml version="1.0" encoding="utf-8"?>\n' + xml(FULL, "one"))
    assert list(load_specs(spark, str(path))) == ["one"]


def test_columns_named_like_record_fields_are_allowed():
    assert make_spec("key long,value string,timestamp timestamp", "key", "timestamp", "timestamp").pks == ("key",)


@pytest.mark.parametrize("name", ["pt_date", "PT_DATE", "_log_offset"])
def test_reserved_column_names(name):
    with pytest.raises(ValueError, match="reserved"):
        make_spec(f"id long,{name} string", "id", "id")
