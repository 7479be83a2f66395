import os
import random
import time
import uuid
from collections import defaultdict

import numpy as np
import pytest
from helpers import ODD, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from keyed_lake.llm import common
from keyed_lake.llm import jaccard_join as J
from keyed_lake.llm.components import components
from pyspark.sql import functions as F


def corpus(seed, families=12, copies=9, size=90):
    """Families of texts with few to many changed words, shared lines, and odd texts."""
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(900)]
    line = " ".join(pick.choices(vocabulary, k=14))
    texts = list(ODD) + ["a b", "A B", "a b c d", "a\tb  c\nd", "a b c d e f g h i j", "a b c d e f g h i k"]
    for _ in range(families):
        base = pick.choices(vocabulary, k=pick.randint(8, size))
        for _ in range(copies):
            words = list(base)
            for _ in range(pick.randint(0, 4)):
                words[pick.randrange(len(words))] = pick.choice(vocabulary)
            if pick.random() < 0.4:
                words += line.split()
            texts.append(" ".join(words))
    return texts


def shingle_set(text, n):
    words = J.WORD.findall((text or "").encode().translate(J.LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute(texts, rule):
    sets = [shingle_set(t, rule.words) for t in texts]
    parent = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and rule.den * len(a & sets[j]) >= rule.num * len(a | sets[j]):
                x, y = J.find(parent, i), J.find(parent, j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), J.find(parent, i)) for i in range(len(texts))}


@pytest.mark.parametrize("rule", [J.Similarity(), J.Similarity(5, 80, 100), J.Similarity(2, 50, 100)])
def test_components_are_those_of_all_pairs(spark, rule):
    texts = corpus(rule.words)
    rows = J.similar_groups(documents(spark, texts), "doc_id", "text", rule).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(texts, rule)


def test_parts_of_a_group_find_the_same(spark):
    texts = corpus(5, families=2, copies=60)
    rows = J.grouped(documents(spark, texts), "doc_id", "text", part_tokens=500).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(texts, J.Similarity())


def test_drop_keeps_one_of_each(spark):
    texts = corpus(6)
    docs = documents(spark, texts)
    kept = J.drop_similar(docs, "doc_id", "text")
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in brute(texts, J.Similarity()).items() if i == c}


def test_null_keys(spark):
    docs = spark.createDataFrame([(None, "a b c d e"), (7, "A b c d e"), (None, None), (None, "z y x")], "doc_id long, text string")
    rows = J.similar_groups(docs, "doc_id", "text").collect()
    assert sorted((r.n_shingles, str(r.component_id)) for r in rows) == [(0, "None"), (1, "None"), (2, "7"), (2, "7")]


def test_empty(spark):
    empty = documents(spark, ["a"]).where("false")
    assert J.similar_groups(empty, "doc_id", "text").count() == 0
    assert J.drop_similar(empty, "doc_id", "text").count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 60))
def test_similar_sets_share_first_hashes(common, more_a, more_b):
    """The bound behind the candidates, on random orders."""
    rule = J.Similarity()
    a, b = common + more_a, common + more_b
    if rule.den * common < rule.num * (common + more_a + more_b) or min(a, b) < rule.smallest():
        return
    ranks = np.random.default_rng(common).permutation(common + more_a + more_b)
    x, y = np.sort(ranks[:a]), np.sort(np.concatenate([ranks[:common], ranks[a:]]))
    shared = len(np.intersect1d(x[: rule.prefix(a)], y[: rule.prefix(b)]))
    assert shared >= min(rule.extra(a), rule.extra(b))
    assert min(rule.extra(a), rule.extra(b)) >= rule.extra(rule.least_partner(max(a, b)))


def test_tree_skips_but_loses_nothing():
    random_ = np.random.default_rng(3)
    rule = J.Similarity()
    base = [np.unique(random_.integers(0, 2**60, 120).astype(np.uint64)) for _ in range(6)]
    sets = []
    for k in range(300):
        s = base[k % 6].copy()
        change = random_.integers(0, len(s), k % 9)
        s[change] = random_.integers(0, 2**60, len(change)).astype(np.uint64)
        sets.append(np.unique(s))
    parent = list(range(300))
    tree = J.Tree(sets, 1024)
    order = sorted(range(300), key=lambda i: len(sets[i]))
    tree = J.Tree([sets[i] for i in order], 1024)
    J.walk(tree, tree, True, parent, 0, rule)
    want = list(range(300))
    for i in range(300):
        for j in range(i):
            a, b = sets[order[i]], sets[order[j]]
            if len(np.intersect1d(a, b)) >= rule.least_overlap(len(a), len(b)):
                x, y = J.find(want, i), J.find(want, j)
                want[max(x, y)] = min(x, y)
    assert [J.find(parent, i) for i in range(300)] == [J.find(want, i) for i in range(300)]


def test_components(spark):
    pick = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(pick.randint(200, 300), pick.randint(200, 300)) for _ in range(60)]
    links += [(5, 5), (None, 3)]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    neighbours = defaultdict(set)
    for a, b in links:
        if a is not None and a != b:
            neighbours[a].add(b)
            neighbours[b].add(a)
    for r in rows:
        seen, todo = {r.node}, [r.node]
        while todo:
            for n in neighbours[todo.pop()] - seen:
                seen.add(n)
                todo.append(n)
        assert r.component == min(seen)
    assert {r.node for r in rows} == set(neighbours)


def test_a_chain_of_chance_meetings_is_not_dealt_all_to_all(spark, tmp_path, monkeypatch):
    """Each text shares a third of its words with the next: one group, but none is similar to another but its copy."""
    rule, folder, plain = J.Similarity(1, 50, 100), str(tmp_path), J.tree_links
    texts = [" ".join(f"w{k}" for k in range(20 * i, 20 * i + 40)) for i in range(100)]
    texts += [t + f" more{i}" for i, t in enumerate(texts[::10])]

    def counted(rows, rule):
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as file:
            file.write(str(len(rows)))
        return plain(rows, rule)

    monkeypatch.setattr(J, "tree_links", counted)
    rows = J.grouped(documents(spark, texts), "doc_id", "text", rule, part_tokens=200).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(texts, rule)
    dealt = [int(p.read_text()) for p in tmp_path.iterdir()]
    assert len(texts) < sum(dealt) < 5 * len(texts)  # 23 parts would make 23 copies of each


@pytest.mark.parametrize("part_tokens", [1, 200, 5_000])
def test_classes_that_meet_share_a_block(spark, part_tokens):
    pick = random.Random(part_tokens)
    meeting = [(t, n, 10 + n, pick.randint(1, 9)) for t in range(60) for n in pick.sample(range(40), pick.choice([1, 2, 3, 30]))]
    met = J.met_hubs(spark.createDataFrame(meeting, "token long, node long, n long, weight long"))
    groups = components(met, "node", "hub")
    sizes = spark.createDataFrame([(n, 10 + n) for n in range(40)], "node long, n long")
    placed = J.blocks(groups.select("node", F.col("component").alias("grp")).join(sizes, "node"), met, part_tokens).collect()
    of, total = defaultdict(set), defaultdict(int)
    for r in placed:
        assert r.block not in of[r.node]
        of[r.node].add(r.block)
        total[r.block] += 10 + r.node
    assert all(r.parts == -(-total[r.block] // part_tokens) for r in placed)
    holders = defaultdict(list)
    for t, n, *_ in meeting:
        holders[t].append(n)
    assert all(of[a] & of[b] for nodes in holders.values() for a in nodes for b in nodes if a != b)


def test_intermediate_tables_go_when_they_were_read(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    texts = corpus(8)
    assert len(J.similar_groups(documents(spark, texts), "doc_id", "text").collect()) == len(texts)
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(shared)) - before}
    assert not left & {"outlines", "classes", "token-counts", "shared-tokens", "meeting-tokens", "members", "member-sets"}


def test_a_written_table_leaves_no_shuffle(spark):
    def shuffles():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in files.mkString("\n").split("\n") if "/shuffle_" in name}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, had = shuffles(), spark.conf.get(setting)
    rows = common.written(spark.range(100_000).selectExpr("id % 5000 AS k").groupBy("k").count(), "counted")
    until = time.monotonic() + 5
    while shuffles() - before and time.monotonic() < until:  # they go a moment after the write
        time.sleep(0.1)
    assert not shuffles() - before and spark.conf.get(setting) == had
    assert rows.count() == 5000
