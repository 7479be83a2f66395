import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from keyed_lake.spec import TableSpec, parse_type  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "3")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def make_spec(columns: str, pks: str, order_by: str, partition_by: str | None = None, **more) -> TableSpec:
    """A spec from text such as `id long, ts timestamp`."""
    pairs = [c.split() for c in columns.split(",")]
    return TableSpec(
        name=more.pop("name", "t"),
        columns=[name for name, _ in pairs],
        types=[parse_type(kind) for _, kind in pairs],
        pks=pks.split(","),
        order_by=order_by.split(","),
        partition_by=partition_by,
        csv_folder=more.pop("csv_folder", "t"),
        topic=more.pop("topic", "t"),
        **more,
    )


def rows_of(df, *columns):
    """The rows as a sorted list of tuples, NULLs first."""
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=lambda r: [(v is not None, str(v)) for v in r])


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
