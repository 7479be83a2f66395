import random

import pytest
from keyed_lake.llm import components as C


def plain_components(links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


def found(spark, links):
    rows = C.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len({r.node for r in rows}) == len(rows)
    return {r.node: r.component for r in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    pick = random.Random(seed)
    links = [(pick.randrange(-90, 90), pick.randrange(-90, 90)) for _ in range(100)]
    links += links[:20] + [(5, 5), (400, 400), (None, 3), (3, None)] + [(500, 500 + i) for i in range(40)]
    assert found(spark, links) == plain_components(links)


def test_a_chain_in_id_order_takes_few_rounds(spark, monkeypatch):
    rounds = []
    write = C.written
    monkeypatch.setattr(C, "written", lambda df, name: rounds.append(name) or write(df, name))
    links = [(i, i + 1) for i in range(300)]
    assert found(spark, links) == dict.fromkeys(range(301), 0)
    assert rounds.count("parents") <= 12  # in id order of parents it would be 300


def test_no_links(spark):
    assert found(spark, []) == {} == found(spark, [(1, 1), (None, None)])
