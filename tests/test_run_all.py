from datetime import datetime

from keyed_lake.plans import queries


def test_run_all_keeps_whole_texts_of_compressed_files(spark, tmp_path, monkeypatch):
    """Fields with quotes, commas and line ends; the CSV files, which are most of what is written, are small."""
    odd = 'a "quoted", text\nof two lines \\ and more, '
    docs = [(i, odd * (i % 5 + 1) + str(i), "en", None, 5) for i in range(400)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    day = datetime(2024, 1, 2, 3, 4, 5, 678901)
    rows = [(i, day, i % 7, "view", 0.5, "{}") for i in range(50)]
    spark.createDataFrame(
        rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    ).write.parquet(f"{tmp_path}/events.parquet")
    rows = [(i, i % 7, "O", 1.5, day, "1-URGENT") for i in range(60)]
    spark.createDataFrame(
        rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    work = tmp_path / "work"
    monkeypatch.setattr(queries, "scratch_folder", lambda spark, name: f"file://{work}")
    got = {r["name"]: (r["records"], r["key_sum"]) for r in queries.run_all(spark, str(tmp_path)).collect()}
    assert got == {"documents": (400, sum(range(400))), "events": (7, 21), "orders": (60, sum(range(60)))}
    stored = spark.read.parquet(f"{work}/tables/documents").select("doc_id", "text").collect()
    assert sorted(map(tuple, stored)) == [d[:2] for d in docs]
    files = [f for f in work.rglob("*.csv*") if not f.name.startswith(".")]
    raw = sum(len(d[1]) for d in docs)
    assert files and sum(f.stat().st_size for f in files) < raw / 2
