"""What bounds the memory of a worker and of its executor, whatever the batches and the stages before."""

import pyarrow as pa
import pytest
from helpers import documents
from keyed_lake.llm import common
from keyed_lake.llm import decontamination as D
from keyed_lake.llm import jaccard_join as J
from keyed_lake.llm import packing as P
from keyed_lake.llm.queries import tokenizer_path
from pyspark.sql import types as T

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
ITEM = "one of the few passages that a benchmark asks for in plain words"


@pytest.fixture
def limit(spark):
    before = spark.conf.get(LIMIT)
    spark.conf.unset(LIMIT)
    yield
    spark.conf.set(LIMIT, before)


def test_a_large_batch_is_scanned_in_pieces():
    hit = T.StructType([T.StructField(n, T.LongType()) for n in ("item", "edits", "begin", "end")])
    shared = type("Shared", (), {"value": [(7, ITEM)]})
    texts = [f"{i} {ITEM if i % 5 == 0 else 'nothing'} here" for i in range(3 * D.PART_DOCS + 10)]
    out = list(D._scan_rows(shared, 0, hit, D.DISTANCE, "hits")(iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])])))
    assert max(b.num_rows for b in out) <= D.PART_DOCS
    assert [t for b in out for t in b.column(0).to_pylist()] == texts
    found = [[h["item"] for h in hits] for b in out for hits in b.column(1).to_pylist()]
    assert found == [[7] if i % 5 == 0 else [] for i in range(len(texts))]


def test_texts_go_to_workers_in_small_batches(spark, limit, monkeypatch):
    monkeypatch.setattr(common, "BATCH_BYTES", 100_000)
    bench = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    table = documents(spark, [f"{i} " + "word " * 400 for i in range(600)]).coalesce(1)
    D.scan(table, "text", bench, "item_id", "text")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["size"])

    found = [r["size"] for r in table.mapInArrow(sizes, "size long").collect()]
    assert len(found) >= 10 and max(found) < 200_000


def test_the_limit_of_a_session_stays(spark, limit):
    spark.conf.set(LIMIT, "1234567")
    common.small_batches(spark)
    assert spark.conf.get(LIMIT) == "1234567b" or spark.conf.get(LIMIT) == "1234567"


def test_a_worker_keeps_what_one_operator_needs():
    file = tokenizer_path()
    first = P.tokens(file, 1000)
    assert P.tokens(file, 1000) is first
    words = J.shingles_of(4)
    assert J.shingles_of(4) is words and P.tokens(file, 1000) is not first
    common.kept()
    assert not common._kept


def test_few_kept_chunks_give_the_same_pieces(spark):
    texts = [" ".join(f"w{i * k % 977}" for k in range(300)) for i in range(300)]
    table = documents(spark, texts).coalesce(1)
    few, many = (P.cut_pieces(table, "doc_id", "text", tokenizer_path(), cached=n).collect() for n in (50, 1_000_000))
    assert few == many and len(few) >= 300
