import random
from collections import defaultdict

import numpy as np
from keyed_lake.llm.ordered import largest_before, position
from keyed_lake.llm.quotes import line_ends, normalised, parse, passage_hash, reply_order, run_hashes, split_quotes
from pyspark.sql import functions as F


def test_parse():
    text = "Hello there.\n\nOn Monday Ann wrote:\n> first line\n> goes on\n>> deeper one\n> back again\n\nMy answer."
    own, quoted, hashes = parse(text)
    assert own == "Hello there.\n\nMy answer."
    assert quoted == [(1, passage_hash("first line goes on")), (2, passage_hash("deeper one")), (1, passage_hash("back again"))]
    assert passage_hash("My answer.") in hashes and passage_hash(own) in hashes
    assert parse(None) == (None, [], [])
    assert parse("") == ("", [], [])
    assert parse("> all of it")[0] == ""
    assert parse("a > b\n->c") == ("a > b\n->c", [], sorted({passage_hash("a > b\n->c"), passage_hash("a > b")} - {None} | ({passage_hash("->c")} - {None})))


def chat(seed, n):
    """Conversations whose messages quote earlier ones now and then; the turn that each answers."""
    pick = random.Random(seed)
    rows, parents = [], {}
    for c in range(n):
        texts = []
        for t in range(pick.randint(1, 14)):
            text = f"message {t} of {c} says {pick.randint(0, 10**6)}\nand more {pick.randint(0, 10**6)}"
            parent = t - 1
            if t and pick.random() < 0.4:
                parent = pick.randrange(t)
                line = texts[parent].split("\n")[pick.randrange(2)]
                text = f"> {line.upper()}\n\n{text}"
            texts.append(text.split("\n\n")[-1])
            rows.append((c, t, "user", text))
            parents[c, t] = parent if t else None
    return rows, parents


def walked(parents):
    """Positions by a plain walk: the uninterrupted course first, then the branches, each in the order of their turns."""
    children = defaultdict(list)
    for (c, t), p in parents.items():
        if p is not None:
            children[c, p].append(t)
    out = {}
    for c in {c for c, _ in parents}:
        todo, n = [0], 0
        while todo:
            t = todo.pop()
            out[c, t] = n
            n += 1
            todo += sorted(children[c, t], reverse=True)
    return out


def test_reply_order(spark):
    rows, parents = chat(1, 40)
    out = reply_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), "conv_id", "turn", "role", "text").collect()
    assert len(out) == len(rows)
    assert {(r.conv_id, r.turn): r.parent_turn for r in out} == parents
    assert {(r.conv_id, r.turn): r.position for r in out} == walked(parents)
    assert not any(">" in r.text for r in out)
    assert sum(r.n_linked for r in out) == sum(">" in x[3] for x in rows)


def test_odd_tables(spark):
    rows = [(None, None, None, None), (None, 1, "a", "> nothing like it"), (1, 1, "a", "same text"), (1, 1, "a", "same text"),
            (1, 2, "b", "> same text\nyes indeed"), (2, 0, "a", ""), (2, 1, "b", "> same text\nother conversation")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("row", F.lit(1))
    out = reply_order(table, "conv_id", "turn", "role", "text").collect()
    assert len(out) == len(rows)
    assert sorted((str(r.conv_id), r.position) for r in out) == [("1", 0), ("1", 1), ("1", 2), ("2", 0), ("2", 1), ("None", 0), ("None", 1)]
    assert [r.n_linked for r in sorted(out, key=lambda r: (r.conv_id or 0, r.position))] == [0, 0, 0, 0, 1, 0, 0]
    assert reply_order(table.where("false"), "conv_id", "turn", "role", "text").count() == 0


def test_ordered_helpers(spark):
    pick = random.Random(2)
    rows = [(pick.choice([None, 1, 1, 1, 1, 2]), i, pick.choice([None, i % 17, i])) for i in range(500)]
    table = spark.createDataFrame(rows, "g long, o long, v long").repartition(5)
    out = {r.o: r for r in position(largest_before(table, ["g"], [F.col("o")], "v", "most"), ["g"], [F.col("o")], "at").collect()}
    most, at = {}, defaultdict(int)
    for g, o, v in rows:
        assert (out[o].most, out[o]["at"]) == (most.get(g), at[g])
        at[g] += 1
        if v is not None:
            most[g] = max(v, most.get(g, v))


def text_of(pick):
    """Paragraphs of one to five lines; some lines are frequent."""
    line = lambda: pick.choice(["Thanks a lot,", "so far", f"Straße {pick.randint(0, 9)} und  mehr", f"line {pick.randint(0, 10**6)} é"])
    return "\n\n".join("\n".join(line() for _ in range(pick.randint(1, 5))) for _ in range(pick.randint(1, 4)))


def held(own):
    """Every run of a text's lines, normalised."""
    lines = [x for x in own.split("\n") if x.strip()]
    return {normalised("\n".join(lines[i:j])) for i in range(len(lines)) for j in range(i + 1, len(lines) + 1)}


def test_run_hashes():
    pick = random.Random(3)
    for k in range(60):
        own = text_of(pick)
        ends, values = line_ends(own)
        runs = held(own)
        sizes = sorted({len(r) for r in runs} | set(range(9_000, 9_000 + k)))
        for some in (sizes, sizes[:2]):
            want = {passage_hash(r.decode()) for r in runs if len(r) in some}
            assert run_hashes(np.array(ends), values, np.array(some)) == want


def test_partial_quotes(spark):
    """Quotes of some lines or paragraphs, wrapped alike or anew, against every run of every earlier message."""
    pick = random.Random(4)
    rows, parents, linked = [(9, 0, "a", "one\ntwo\n\nthree\nfour"), (9, 1, "b", "other"), (9, 2, "a", "> two\n> \n> three\n\nyes"),
                             (9, 3, "a", "> one\n> three"), (9, 4, "b", "> one two\n> three")], {}, {}
    for c in range(8):
        owns = []
        for t in range(pick.choice([3, 12, 150])):
            text = text_of(pick)
            if owns and pick.random() < 0.6:
                lines = owns[pick.randrange(len(owns))].split("\n")
                a = pick.randrange(len(lines))
                cut = lines[a : pick.randint(a + 1, len(lines))]
                if pick.random() < 0.3:
                    cut = "\n".join(cut).split()
                text = "\n".join("> " + x for x in cut) + "\n\n" + text
            owns.append(split_quotes(text)[0])
            rows.append((c, t, "u", text))
    owns = {(c, t): held(split_quotes(x)[0]) for c, t, _, x in rows}
    for c, t, _, x in rows:
        best, n = t - 1 if t else None, 0
        for _, q in split_quotes(x)[1]:
            origin = max((s for s in range(t) if normalised(q) in owns[c, s]), default=None)
            if passage_hash(q) is not None and origin is not None:
                best, n = origin, n + 1
        parents[c, t], linked[c, t] = best, n
    assert (parents[9, 2], parents[9, 3], parents[9, 4]) == (0, 2, 0)
    out = reply_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), "conv_id", "turn", "role", "text").collect()
    assert {(r.conv_id, r.turn): r.parent_turn for r in out} == parents
    assert {(r.conv_id, r.turn): r.n_linked for r in out} == linked
    assert sum(linked.values()) > 100
    assert {(r.conv_id, r.turn): r.position for r in out} == walked(parents)
