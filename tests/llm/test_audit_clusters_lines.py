"""The filter audit, the clusters and the line deduplication against plain code."""

import hashlib
import random
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from helpers import ODD, documents
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from keyed_lake.llm import centroids as C
from keyed_lake.llm import filter_audit as A
from keyed_lake.llm import line_dedup as L

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
BLANK = " \t\n\x0b\x0c\r"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string, part string")


# filter audit


def words_of(text):
    for c in BLANK[1:]:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def fails_of(rows):
    """The letters that every (doc_id, text) fails."""
    texts = [t or "" for _, t in rows]
    first = {}
    for (i, _), t in zip(rows, texts):
        if i is not None:
            first[t] = min(first.get(t, i), i)
    out = []
    for (i, _), t in zip(rows, texts):
        w = words_of(t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
                 "D": any(c in "#$%&*|" for c in t), "E": i is not None and i > first[t]}
        out.append({f for f, failed in fails.items() if failed})
    return out


def audit_by_hand(rows, parts, good, toxic):
    fails = fails_of(rows)
    out = {}
    for part in {p or "" for p in parts}:
        own = [(f, i) for f, (i, _), p in zip(fails, rows, parts) if (p or "") == part]
        total = Counter()
        for order in permutations("ABCDE"):
            alive = list(own)
            for step, letter in enumerate(order, 1):
                gone = [x for x in alive if letter in x[0]]
                alive = [x for x in alive if letter not in x[0]]
                total[letter] += len(gone)
                out[part, "".join(order), step] = [
                    letter, len(alive), len(gone), sum(letter in f for f, _ in own) - len(gone), sum(f == {letter} for f, _ in own),
                    sum(i in good for _, i in gone), sum(i in toxic for _, i in gone),
                ]
        for (p, _, _), row in out.items():
            if p == part:
                row.append(total[row[0]])
    return {k: tuple(v) for k, v in out.items()}


def audit_rows(df):
    return {(r[0], r[1], r[2]): tuple(r[3:]) for r in df.collect()}


def test_audit(spark):
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [" ".join(r.choices(vocabulary, k=r.choice([3, 99, 100, 150, 400]))) for _ in range(40)]
    texts += [t.upper() for t in texts[:5]] + [t + " #" for t in texts[:9]] + texts[:12] * 2 + ODD + [texts[0]] * 100
    df = documents(spark, texts)
    rows = [(x.doc_id, x.text) for x in df.select("doc_id", "text").collect()]
    parts = [r.choice(["en", "de", "", None]) for _ in rows]
    schema = T.StructType([*df.schema.fields, T.StructField("mask", T.StringType()), T.StructField("good", T.StringType())])
    values = [[*x[:2], p, *x[3:], "m", "g"] for x, p in zip(df.collect(), parts)]
    marks = [(i, i % 3 % 2, int(i % 4 == 1), "x", "y") for i in range(0, 90)] + [(5, 0, None, "x", "y"), (None, 1, 1, "x", "y"), (9_999, 1, 1, "x", "y")]
    got = audit_rows(A.filter_audit(spark.createDataFrame(values, schema).repartition(5), labels(spark, marks), "doc_id", "text", "lang"))
    good, toxic = {i for i, q, *_ in marks if q == 1}, {i for i, _, t, *_ in marks if t == 1}
    assert got == audit_by_hand(rows, parts, good, toxic)
    assert len(got) == 3 * 600


def test_audit_of_repeated_rows_and_null_ids(spark):
    rows = [(1, "a"), (1, "a"), (2, "a"), (None, "a"), (None, "a"), (3, None), (4, ""), (1, "b #"), (1, "b #")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, lang string")
    got = audit_rows(A.filter_audit(df, labels(spark, [(1, 1, 0, "", "")]), "doc_id", "text", "lang"))
    assert got == audit_by_hand(rows, ["x"] * len(rows), {1}, set())
    assert got["x", "EABCD", 1][2] == 2  # the copies of document 2 and document 4


def test_audit_of_nothing(spark):
    empty = documents(spark, [])
    assert A.filter_audit(empty, labels(spark, [(1, 1, 1, "", "")]), "doc_id", "text", "lang").count() == 0
    one = documents(spark, ["word " * 200_000])
    got = audit_rows(A.filter_audit(one, labels(spark, []), "doc_id", "text", "lang"))
    assert got["en", "BACDE", 1][1:3] == (0, 1)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2**32 - 1), st.integers(1, 1000)), max_size=200))
def test_positional_counts(pairs):
    words, times = np.array([w for w, _ in pairs], np.uint32), np.array([n for _, n in pairs], np.int64)
    expected = [sum(n for w, n in pairs if w >> bit & 1) for bit in range(32)]
    assert A.positional_counts(words, times).tolist() == expected


def test_a_common_text_sends_a_row_per_task(spark):
    rows = [(i, "x", 0, "t" if i % 3 == 0 else f"t{i}", False) for i in range(3_000)]
    df = spark.createDataFrame(rows, "doc_id long, part string, mask int, sha string, good boolean").selectExpr("*", "good as toxic")
    plan = A.survival_words(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


# clusters


def clusters_by_hand(rows, k=8, rounds=10):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and abs(x) <= C.LARGEST for x in v):
            kept.append((i, tuple(int(np.floor(1024 * float(x))) for x in v)))
    hashed = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    points = [list(v) for _, v in hashed[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, p)), j) for j, p in enumerate(points))
    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        for j, vs in members.items():
            points[j] = [sum(x) // len(vs) for x in zip(*vs)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    own = Counter()
    for _, j, d in found:
        own[j] += d
    shas = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return sorted(((i, j, d, own[j], sum(own.values()), shas[j]) for i, j, d in found), key=str)


VECTORS = "vec_id long, embedding array<{}>, q string, lead int, cluster string"


def clustered(spark, rows, kind="double"):
    df = spark.createDataFrame([(i, v, "q", 1, "c") for i, v in rows], VECTORS.format(kind))
    return sorted((tuple(r) for r in C.cluster_report(df.repartition(4), "vec_id", "embedding").collect()), key=str)


def test_clusters(spark):
    r = np.random.default_rng(3)
    centers = r.normal(0, 1, (5, 64))
    rows = [(i, (centers[i % 5] + r.normal(0, 0.3, 64)).tolist()) for i in range(150)]
    rows += [(i, rows[0][1]) for i in range(150, 230)] + [rows[3], rows[3]]  # copies and repeated rows
    nan, inf = float("nan"), float("inf")
    rows += [(300, None), (301, []), (302, [1.0] * 63), (303, [nan] + [0.0] * 63), (304, [inf] * 64), (305, [None] + [0.0] * 63)]
    rows += [(306, [1e9] * 64), (307, [float(C.LARGEST)] * 64), (308, [-float(C.LARGEST)] * 64), (None, rows[1][1])]
    assert clustered(spark, rows) == clusters_by_hand(rows)


def test_ties_and_few_vectors(spark):
    r = random.Random(1)
    rows = [(i, [r.choice([0.0, 1 / 1024]) if k < 3 else 0.0 for k in range(64)]) for i in range(40)]
    assert clustered(spark, rows, "float") == clusters_by_hand(rows)
    assert clustered(spark, rows[:3]) == clusters_by_hand(rows[:3])
    assert clustered(spark, []) == []


def test_the_filter_saves_distances_and_never_changes_one():
    r = np.random.default_rng(7)
    q = np.floor(1024 * (r.normal(0, 1, (8, 64))[r.integers(0, 8, 2000)] * np.linspace(2, 0.1, 64) + r.normal(0, 0.1, (2000, 64)))).astype(np.int64)
    values = q - q.mean(0)
    _, axes = np.linalg.eigh(values.T @ values)
    rotation = C.Rotation(np.ascontiguousarray(axes[:, ::-1]), 16)
    state = C.Centroids(q[:8], rotation)
    label, best, computed = state.nearest(q, *rotation.turned(q))
    all_distances = ((q[:, None, :] - q[:8]) ** 2).sum(2)
    assert (label == all_distances.argmin(1)).all() and (best == all_distances.min(1)).all()
    assert computed < 0.5 * all_distances.size


# lines


def lines_by_hand(rows):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))
    owners = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= 10:
                owners[key(line)].add(i)
    out = []
    for i, t in rows:
        parts = (t or "").split("\n")
        gone = [i is not None and len(owners[key(x)]) >= 2 and i != min(owners[key(x)]) for x in parts]
        out.append((i, len(parts), sum(gone), "\n".join(x for x, g in zip(parts, gone) if not g)))
    return sorted(out, key=str)


def deduped(df):
    out = L.dedup_lines(df, "doc_id", "text")
    return sorted((tuple(r) for r in out.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()), key=str)


def test_lines(spark):
    r = random.Random(2)
    pool = [f"A shared line, number {i}" for i in range(12)] + ["short", "", "  ", "ÄÖÜ äöü ß €", "é" * 9, "é" * 10, "𝔘" * 9, "𝔘" * 10]
    dressed = lambda x: r.choice(["", " ", "\t", "\x0b\r"]) + r.choice([x, x.upper(), x.lower()]) + r.choice(["", "\r", "  \x0c", " "])
    texts = ["\n".join(dressed(r.choice(pool + [f"only here {i}"])) for _ in range(r.randrange(0, 9))) for i in range(60)]
    texts += ODD + ["a very common line\nand more"] * 30 + [" " * 100_000 + "x\n" + "many lines of one text\n" * 20_000, "\n", "\n\n\n"]
    df = documents(spark, texts).repartition(5)
    rows = [(x.doc_id, x.text) for x in df.collect()]
    assert deduped(df) == lines_by_hand(rows)
    assert set(df.columns) < set(L.dedup_lines(df, "doc_id", "text").columns)


def test_repeated_rows_null_ids_and_nothing(spark):
    rows = [(1, "the same long line"), (1, "the same long line"), (None, "the same long line"), (None, "a line without id"),
            (2, "A line without id"), (2, "the same long line\nx"), (2, "the same long line\nx"), (1, "another text\nTHE same long line")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert deduped(df) == lines_by_hand(rows)
    assert deduped(df.where("false")) == []


@pytest.mark.parametrize("name", ["kept_text", "digest", "gone", "lines", "N_LINES"])
def test_clashing_names(spark, name):
    df = spark.createDataFrame([(1, "one long line", "a"), (2, "one long line", "b")], f"doc_id long, text string, {name} string")
    out = L.dedup_lines(df, "doc_id", "text")
    assert len(out.columns) == 6 and {r[2] for r in out.collect()} == {"a", "b"}
