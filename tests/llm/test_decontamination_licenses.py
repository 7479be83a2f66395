import random

import pytest
from helpers import ODD, documents
from keyed_lake.llm import decontamination as D
from keyed_lake.llm import licenses as L


def run_distance(item, text):
    """The least edit distance of the item to any run of the text, by plain dynamic programming."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        last, row = row, [i]
        for j, y in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return min(row)


def planted(seed, n_items=40, n_docs=260):
    """Items of 1 to 70 words; documents with exact, edited (to the limit and beyond) and no passages."""
    pick = random.Random(seed)
    common = [f"c{i}" for i in range(30)]
    vocabulary = common * 6 + [f"v{i}" for i in range(700)]
    items = [pick.choices(vocabulary, k=k) for k in [1, 2, 3, 4, 5, 6, 8, 10, *(pick.randint(9, 70) for _ in range(n_items - 8))]]
    docs = []
    for d in range(n_docs):
        words = pick.choices(vocabulary, k=pick.randint(0, 200))
        if d % 3:
            item = list(pick.choice(items))
            limit = D.edits(len(item))
            for _ in range([0, limit, limit + 2][d % 9 // 3] if d % 3 == 1 else pick.randint(0, limit)):
                at = pick.randrange(len(item) + 1)
                kind = pick.random()
                if kind < 0.5 and at < len(item):
                    item[at] = pick.choice(vocabulary)
                elif kind < 0.75:
                    item.insert(at, pick.choice(vocabulary))
                elif len(item) > 1 and at < len(item):
                    del item[at]
            at = pick.randrange(len(words) + 1)
            words[at:at] = item
        docs.append(" ".join(words))
    return [" ".join(i) for i in items], docs


def brute(items, docs):
    found = {}
    for i, t in enumerate(items):
        item = D.words(t)
        for d, text in enumerate(docs):
            n = run_distance(item, D.words(text)) if item else None
            if n is not None and n <= D.edits(len(item)):
                found[d, i] = n
    return found


def test_recall_and_precision(spark):
    items, docs = planted(1)
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(900, None), (901, "")], "item_id long, text string")
    rows = D.contamination_report(documents(spark, docs), "doc_id", "text", bench, "item_id", "text").collect()
    got = {(r.doc_id, r.item_id): r.edits for r in rows}
    want = brute(items, docs)
    assert len(got) == len(rows) and set(got) <= set(want)
    assert len(got) >= 0.99 * len(want)
    assert all(want[p] == 0 or n > 0 for p, n in got.items())
    assert {p for p, n in want.items() if n == 0} <= set(got)
    assert sum(got[p] == want[p] for p in got) >= 0.95 * len(got)


def test_best_run():
    pick = random.Random(2)
    for _ in range(300):
        item, text = ([pick.randint(1, 4) for _ in range(pick.randint(1, n))] for n in (12, 30))
        assert D.best_run(item, text)[0] == run_distance(item, text)


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    items, docs = planted(3, 30, 60)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    table = documents(spark, docs + ODD)
    whole = D.contamination_report(table, "doc_id", "text", bench, "item_id", "text").select("doc_id", "item_id").collect()
    monkeypatch.setattr(D, "BLOCK_ITEMS", 8)
    parts = D.contamination_report(table, "doc_id", "text", bench, "item_id", "text").select("doc_id", "item_id").collect()
    assert sorted(whole) == sorted(parts) and whole


def test_scripts_without_blanks(spark):
    pick = random.Random(7)
    letters = [chr(c) for c in [*range(0x4E00, 0x4F00), *range(0x3042, 0x3080), *range(0x0E01, 0x0E2F)]]
    items = ["".join(pick.choices(letters, k=k)) for k in (6, 12, 25, 60)]
    docs = []
    for n in range(80):
        item = list(items[n % 4])
        for at in pick.sample(range(len(item)), [0, 1, D.edits(len(item)), D.edits(len(item)) + 3][n // 4 % 4]):
            item[at] = "変"
        docs.append("".join([*pick.choices(letters, k=30), *item, *pick.choices(letters, k=30)]) + " and words" * (n % 3))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = D.contamination_report(documents(spark, docs), "doc_id", "text", bench, "item_id", "text").collect()
    want = brute(items, docs)
    got = {(r.doc_id, r.item_id) for r in rows}
    assert got <= set(want) and len(got) >= 0.99 * len(want) and len(want) >= 55
    assert {p for p, n in want.items() if n == 0} <= got
    assert D.words("Ein Wort, 世界 wort_2") == ["ein", "wort", "世", "界", "wort", "2"]


def test_long_items_in_parts(spark, monkeypatch):
    pick = random.Random(8)
    item = pick.choices([f"v{i}" for i in range(300)], k=400)
    near = [w if i % 9 else "other" for i, w in enumerate(item)]
    docs = [" ".join(["x"] * 40 + near + ["y"] * 30), " ".join(item[:250]), None, "", " ".join(item) + " z" * 5_000]
    index = D.Index([(1, " ".join(item))])
    whole = index.scan(docs)
    sizes = []
    meet = D.SizeClass.meet
    monkeypatch.setattr(D, "CELLS", 40_000)
    monkeypatch.setattr(D.SizeClass, "meet", lambda self, x, starts: sizes.append(len(starts)) or meet(self, x, starts))
    assert index.scan(docs) == whole and max(sizes) * 3 * 400 <= 40_000 and len(sizes) > 2
    assert [bool(w) for w in whole] == [True, False, False, False, True]


def test_clean_documents_stay(spark):
    docs = documents(spark, ["all of these words are harmless", "one two three four five six", *ODD])
    bench = spark.createDataFrame([("a", "two three four five")], "item string, text string")
    kept = D.drop_contaminated(docs, "text", bench, "item", "text")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3, 6, 7, 8]
    assert D.drop_contaminated(docs, "text", bench.where("false"), "item", "text").count() == docs.count()
    assert D.drop_contaminated(docs.where("false"), "text", bench, "item", "text").count() == 0


def best_share(words, template, size):
    """The best share of the template's shingles in any window of the operator's."""
    grams = lambda w: [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)]
    want, have = set(grams(template)), grams(words)
    t = len(template) - size + 1
    starts = range(0, max(len(have) - t, 1), t) if have else []
    return max((len(want & set(have[s : s + 2 * t])) / len(want) for s in starts), default=0)


def test_licenses(spark):
    pick = random.Random(5)
    vocabulary = [f"w{i}" for i in range(50)] + ["the", "license", "licensed", "reserved"]
    texts = list(ODD)
    for k in range(250):
        words = pick.choices(vocabulary, k=pick.randint(0, 120))
        notice = L.template_words(pick.choice(list(L.TEMPLATES.values())))
        for _ in range(pick.randint(0, 2) if k % 2 else 0):
            notice[pick.randrange(len(notice))] = "changed"
        at = pick.randrange(len(words) + 1)
        if k % 5:
            words[at:at] = notice
        texts.append(" ".join(words).upper() if k % 7 == 0 else ", ".join(words))
    rows = L.license_report(documents(spark, texts), "doc_id", "text").collect()
    got = {(r.doc_id, r.license): r.share for r in rows}
    want = {}
    for i, t in enumerate(texts):
        words = L.template_words(t or "")
        for name, notice in L.TEMPLATES.items():
            template = L.template_words(notice)
            share = best_share(words, template, min(L.SHINGLE, len(template)))
            if share >= L.SHARE:
                want[i, name] = share
    assert len(got) == len(rows)
    assert sorted(got.keys() - want.keys()) == []
    assert got == pytest.approx(want) and len(want) > 100


def test_anchors_lose_no_template():
    for notice in L.TEMPLATES.values():
        words = L.template_words(notice)
        size = min(L.SHINGLE, len(words))
        grams = {" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}
        assert sum(not any(a in g for a in L.ANCHORS) for g in grams) < L.SHARE * len(grams), notice


def test_licenses_are_native(spark):
    plan = L.license_report(documents(spark, ODD), "doc_id", "text")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert L.license_report(documents(spark, ODD).where("false"), "doc_id", "text").count() == 0
