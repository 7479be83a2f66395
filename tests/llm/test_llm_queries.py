"""The registered queries over a whole small data folder, and the pipeline's stages against plain code."""

import struct
import zlib
from collections import Counter, defaultdict

import __spark_entry__ as entry_points
import corpus_pipeline
import duckdb
import pytest
from keyed_lake.llm import decontamination as D
from keyed_lake.llm import jaccard_join as J
from keyed_lake.llm import oracles, queries
from keyed_lake.llm.packing import Tokens
from test_jaccard_join import brute

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op2_licenses": "doc_id license share begin_shingle",
    "op3_toxicity": "doc_id held_out score predicted",
    "op4_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op5_language": "doc_id held_out lang_pred score",
    "op6_html_text": "page_id url text n_chars",
    "op7_quotes": "conv_id turn role text n_quoted n_linked parent_turn nesting position",
    "op8_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op9_jaccard_join": "doc_id n_shingles component_id",
    "op10_decontamination": "doc_id item_id edits begin_word end_word",
    "op11_filter_audit": "part filter_order step filter kept removed redundant unique_fails good_lost toxic_lost shapley",
    "op12_centroids": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
    "op13_line_dedup": "doc_id n_lines n_dropped kept_sha256",
}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        connection.execute(f"create view {name} as select * from read_parquet('{SF}/{name}.parquet')")
    return connection


def test_all_are_registered():
    assert list(queries.registered()) == list(COLUMNS)
    assert {*COLUMNS, "pipeline"} <= set(entry_points.queries())
    assert set(oracles.registered()) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", COLUMNS)
def test_query(spark, db, name):
    df = entry_points.queries()[name](spark, SF)
    rows = df.collect()
    assert " ".join(df.columns) == COLUMNS[name]
    table = {"op6_html_text": "pages", "op7_quotes": "conversations"}.get(name, "documents")
    if name in oracles.registered():
        sql = db.execute(oracles.registered()[name])
        at = [[d[0] for d in sql.description].index(c) for c in df.columns]
        assert sorted(tuple(r) for r in rows) == sorted(tuple(r[i] for i in at) for r in sql.fetchall())
    elif name not in ("op8_packing", "op10_decontamination"):
        assert len(rows) == db.execute(f"select count(*) from {table}").fetchone()[0]


def test_held_out_languages(spark, db):
    known = dict(db.execute("select doc_id, lang from documents").fetchall())
    rows = [r for r in queries.op5_language(spark, SF).collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows) and len(rows) > 30
    assert sum(known[r.doc_id] == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_pages_hold_their_article(spark, db):
    for page_id, html in db.execute("select page_id, html from pages limit 40").fetchall():
        assert html.index("<article>") > 0
    rows = queries.op6_html_text(spark, SF).collect()
    assert all(r.n_chars == len(r.text) > 0 and "<" not in r.text and "\n\n" not in r.text for r in rows)


def test_pipeline_stages(spark, db):
    docs = {i: t for i, t in db.execute("select doc_id, text from documents").fetchall()}
    table = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.written(stage(spark, table, SF), "tested-stage")
        if name != "packing":
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            kept[name] = {r.doc_id for r in out.select("doc_id").collect()}
        table = out
    assert kept["language"] == {i for i, t in docs.items() if any(c.isalpha() for c in t or "")}
    largest = {}
    for i in sorted(kept["language"]):
        largest[docs[i]] = i
    assert kept["exact_dedup"] == set(largest.values())
    ids = sorted(kept["exact_dedup"])
    components = brute([docs[i] for i in ids], corpus_pipeline.NEAR)
    assert kept["near_dedup"] == {ids[k] for k, (_, c) in components.items() if k == c}
    index = D.Index(db.execute("select item_id, text from benchmark").fetchall())
    ids = sorted(kept["near_dedup"])
    assert kept["decontamination"] == {i for i, hits in zip(ids, index.scan([docs[i] for i in ids])) if not hits}
    tokens = Tokens(queries.tokenizer_path())
    fill, length = Counter(), Counter()
    pieces = defaultdict(int)
    for r in table.collect():
        fill[r.sequence_id] += r.length
        length[r.doc_id] += r.length
        pieces[r.doc_id] += 1
    assert max(fill.values()) <= 2048 and set(length) == kept["decontamination"]
    for i, found in zip(length, tokens.of([docs[i] for i in length])):
        assert length[i] == len(struct.unpack(f"<{len(found) // 4}I", found)) + 1


def test_a_run_is_its_stages(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == COLUMNS["op8_packing"].split() and rows.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
    assert J.Similarity() == J.Similarity(4, 85, 100)
