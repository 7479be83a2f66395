import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from helpers import ODD, documents
from keyed_lake.llm import bloom, exact_dedup, sharding
from pyspark.sql import functions as F

TEXTS = ODD + ["copy"] * 40 + [f"text {i} " * (i % 7) for i in range(60)]


def test_report(spark):
    rows = exact_dedup.duplicate_report(documents(spark, TEXTS), "doc_id", "text").collect()
    groups = defaultdict(list)
    for i, t in enumerate(TEXTS):
        groups[t or ""].append(i)
    assert len(rows) == len(TEXTS)
    for r in rows:
        same = groups[TEXTS[r.doc_id] or ""]
        assert (r.keep_id, r.group_size, r.kept) == (max(same), len(same), r.doc_id == max(same))
        assert r.text_sha256 == hashlib.sha256((TEXTS[r.doc_id] or "").encode()).hexdigest()


def test_a_full_filter_changes_nothing(spark):
    docs = documents(spark, TEXTS)
    few = exact_dedup.drop_duplicates(docs, "doc_id", "text", max_bits=64).select("doc_id").collect()
    many = exact_dedup.drop_duplicates(docs, "doc_id", "text").select("doc_id").collect()
    assert sorted(few) == sorted(many)
    assert len(many) == len({t or "" for t in TEXTS})


def test_drop_keeps_columns_and_one_of_equal_rows(spark):
    docs = documents(spark, ["a", "a", "b"])
    kept = exact_dedup.drop_duplicates(docs.unionByName(docs), "doc_id", "text")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]


def test_null_keys_are_smallest(spark):
    docs = spark.createDataFrame([(None, "a"), (3, "a"), (None, "b"), (None, "b")], "doc_id long, text string")
    rows = exact_dedup.duplicate_report(docs, "doc_id", "text").collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.kept) for r in rows if r.group_size == 2) == [
        ("3", "3", True), ("None", "3", False), ("None", "None", False), ("None", "None", True),
    ]


def test_main_path_is_native(spark):
    plan = exact_dedup.duplicate_report(documents(spark, TEXTS), "doc_id", "text")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_filter_has_no_false_negative(spark):
    keys = spark.range(500).selectExpr("id * 7 as k")
    flagged = bloom.build(keys, "k", 500).flag(spark.range(3500), "hit", F.col("id")).where("hit").collect()
    found = {r.id for r in flagged}
    assert {7 * i for i in range(500)} <= found and len(found) < 1000


@pytest.mark.parametrize("shards", [1, 4, 40])
def test_shards(spark, shards):
    texts = TEXTS + ["large group " * 20] * 12 + ["hot"] * 150
    rows = sharding.assign_shards(documents(spark, texts), "doc_id", "text", shards).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    load, slots, place = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        body = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(body) + 16, zlib.crc32(body))
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
        place[texts[r.doc_id] or ""].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = Counter()
    for t in texts:
        sizes[t or ""] += len((t or "").encode()) + 16
    target = sum(load.values()) / shards
    assert set(load) <= set(range(shards))
    assert max(load.values()) <= target * (1 + 2 * sharding.WHOLE) + max(r.size for r in rows)
    for t, n in sizes.items():
        if n <= target:
            assert len(place[t]) == 1


def plain_shards(texts, shards):
    """Shard of each text by the rule of the operator, where no group is larger than a shard."""
    bodies = [(t or "").encode() for t in texts]
    names = [hashlib.md5(b).digest() for b in bodies]
    size, rows = Counter(), Counter(names)
    for name, body in zip(names, bodies):
        size[name] += len(body) + 16
    target = sum(size.values()) / shards
    many = max(1.0, len(texts) / shards * sharding.WHOLE)
    large = {h for h in size if size[h] > target * sharding.WHOLE or rows[h] > many}
    load, place = [0] * shards, {}
    for h in sorted(large, key=lambda h: (-size[h], h)):
        place[h] = min(range(shards), key=lambda s: (load[s], s))
        load[place[h]] += size[h]
    room = [max(0.0, target - x) for x in load]
    rest = sum(n for h, n in size.items() if h not in large)
    ends = [sum(room[: s + 1]) * rest / sum(room) for s in range(shards - 1)]
    done = 0
    for h in sorted(size.keys() - large):
        place[h] = sum(end <= done + size[h] / 2 for end in ends)
        done += size[h]
    return [place[h] for h in names]


@pytest.mark.parametrize("shards", [2, 5])
def test_shards_against_brute_force(spark, shards):
    texts = [f"document {i % 900} " * (3 + i % 900 * 7 % 13) for i in range(1200)] + ["", None] * 60 + ["long " * 200] * 3
    rows = sharding.assign_shards(documents(spark, texts), "doc_id", "text", shards).collect()
    assert [r.shard for r in sorted(rows)] == plain_shards(texts, shards)


def test_groups_of_many_rows_do_not_flow(spark, monkeypatch):
    """Empty texts weigh little, yet a task must not hold them all: they are placed as a group."""
    texts = [f"a text of some length, number {i} " * 40 for i in range(400)] + [None, ""] * 100
    placed = {}
    place = sharding.place_large
    monkeypatch.setattr(sharding, "place_large", lambda groups, n: placed.update(groups) or place(groups, n))
    rows = sharding.assign_shards(documents(spark, texts), "doc_id", "text", 2).collect()
    assert placed[hashlib.md5(b"").digest()] == 200 * 16 < 0.01 * sum(r.size for r in rows)
    assert len({r.shard for r in rows if r.size == 16}) == 1


def test_shards_are_balanced(spark):
    texts = [f"document {i} " * (3 + i * i % 11) for i in range(3000)]
    rows = sharding.assign_shards(documents(spark, texts), "doc_id", "text", 8).collect()
    load = Counter()
    for r in rows:
        load[r.shard] += r.size
    assert max(load.values()) <= 1.02 * min(load.values())


def test_empty(spark):
    empty = documents(spark, TEXTS).where("false")
    assert exact_dedup.duplicate_report(empty, "doc_id", "text").count() == 0
    assert exact_dedup.drop_duplicates(empty, "doc_id", "text").count() == 0
    assert sharding.assign_shards(empty, "doc_id", "text").count() == 0


def test_shards_are_written(spark, folder):
    sharding.write_shards(documents(spark, ["a", "b", "c"]), "doc_id", "text", f"{folder}/out", 2)
    assert spark.read.parquet(f"{folder}/out").count() == 3
