"""What can be checked of the Kafka and Delta backends without their jars."""

from datetime import date

import pytest
from conftest import make_spec, rows_of

from keyed_lake.sources.delta import DeltaTable, match_condition
from keyed_lake.sources.kafka import KafkaLog

SPEC = make_spec("id long,at timestamp", "id", "at", "at")


def test_kafka_options(spark):
    log = KafkaLog(spark, "host:9092", "t", {"kafka.security.protocol": "SSL"})
    assert log.read_options("earliest", 9) == {
        "kafka.bootstrap.servers": "host:9092", "kafka.security.protocol": "SSL", "subscribe": "t",
        "startingOffsets": "earliest", "maxOffsetsPerTrigger": "9",
    }
    assert log.write_options["topic"] == "t" and log.write_options["kafka.compression.type"] == "zstd"
    with pytest.raises(ValueError, match="start"):
        log.read_options("middle")
    with pytest.raises(Exception, match="kafka"):
        log.scan()


def test_delta_needs_its_package(spark, folder):
    with pytest.raises(ImportError, match="delta-spark"):
        DeltaTable(spark, folder, SPEC).create()


@pytest.mark.parametrize(
    "scope, expected", [("batch", [(1, 1, 2), (2, 2, 2)]), ("partition", [(2, 2, 2)]), ("global", [(1, 1, 2), (2, 2, 2), (3, 9, 2)])]
)
def test_delta_condition(spark, scope, expected):
    day = lambda n: date(2024, 1, n)
    target = spark.createDataFrame([(1, day(1)), (2, day(2)), (3, day(9)), (None, day(1))], "id long, pt_date date")
    updates = spark.createDataFrame([(1, day(2)), (2, day(2)), (3, day(2)), (None, day(1))], "id long, pt_date date")
    condition = match_condition(SPEC, scope, ["2024-01-01", "2024-01-02"])
    pairs = target.alias("t").join(updates.alias("u"), condition)
    assert rows_of(pairs.selectExpr("t.id", "day(t.pt_date)", "day(u.pt_date)")) == expected
