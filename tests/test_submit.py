import os

import pytest
import submit
from conftest import rows_of

SPEC = (
    "<t><table name='a'><csvFolder>a</csvFolder><topic>a</topic><deltaFolder>a</deltaFolder>"
    "<columns>id,at,v</columns><pks>id</pks><types>long,timestamp,str</types><partitionBy>at</partitionBy>"
    "<orderBy>at</orderBy></table></t>"
)


def test_jobs(spark, folder, monkeypatch, capsys):
    os.makedirs(f"{folder}/csv/a")
    with open(f"{folder}/csv/a/1.csv", "w") as f:
        f.write("1,2024-01-01 00:00:00,x\n1,2024-01-01 10:00:00,y\n2,2024-01-02 00:00:00,z\n")
    with open(f"{folder}/spec.xml", "w") as f:
        f.write(SPEC)

    def run(*words):
        monkeypatch.setattr("sys.argv", ["submit.py", *words])
        submit.main()
        return capsys.readouterr().out

    specs, checkpoints = ["--specs", f"{folder}/spec.xml"], ["--checkpoints", f"{folder}/cp"]
    run(
        "ingest", *specs, *checkpoints, "--csv", f"{folder}/csv", "--logs", f"{folder}/logs", "--once",
        "--csv-option", "escape=\"")
    run(
        "apply", *specs, *checkpoints, "--logs", f"{folder}/logs", "--tables", f"{folder}/tables", "--once",
        "--start", "earliest", "--on-conflict", "newest", "--compacted", f"{folder}/compacted",
    )
    table = ["--table", "a", "--path", f"{folder}/tables/a"]
    assert "2 rows" in run("count", *specs, *table)
    assert "2 rows after" in run("count", *specs, *table, "--expect", "2")
    assert "2024-01-01 10:00:00" in run("tail", "--log", f"{folder}/logs/a")
    assert "rows=2" in run("compact", "--source", f"{folder}/logs/a", "--target", f"{folder}/small")
    run(
        "rekey", *specs, *checkpoints, "--table", "a", "--source", f"{folder}/logs/a", "--target", f"{folder}/by-v",
        "--key", "v", "--value", "id", "--once",
    )
    assert rows_of(spark.read.parquet(f"{folder}/by-v/data"), "key", "value") == [("y", "1"), ("z", "2")]
    run("export", *specs, *table, "--output", f"{folder}/out")
    assert spark.read.csv(f"{folder}/out").count() == 2
    with pytest.raises(SystemExit):
        run("count", *specs)
