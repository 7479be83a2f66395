"""How five filters act together: what every order of them removes, step by step, per part of the corpus.

Every document becomes a 32-bit word, one bit for each subset of the filters: bit S is set if the document survives all
filters of S. Adding up the words position by position gives, for every subset at once, how many documents survive it.
Tasks add words with carry-save adders (three words of a weight become one of that weight and one of twice the weight),
per part and label, and send 32 rows per part and batch. All else follows from these counts: an order removes at step k
what survives its first k - 1 filters and not its first k.

Four filters look at one text. The fifth, "identical to the text of a smaller key", needs all texts: every keyed document
first counts as failing it, without a shuffle; then the holders of the smallest key of each text, found with one row
per text and task, add the bits they were denied.

Defined results: a null text counts as empty, a null part as "". A document with a null key is neither smaller nor larger
than another, so it never fails the fifth filter and makes no other fail it. Rows with equal key and text count
each and pass or fail together. A key with several label rows has a label if one of them says 1; a null label is none.
An empty table has no parts and gives no rows. Other columns, whatever their names, are not looked at. Texts of any
length are read whole, one at a time.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, map_arrow, written

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
COPY = 1 << FILTERS.index("E")
#: The word of every failure mask: bit S is set if none of the filters of S is failed.
WORDS = [sum(1 << s for s in range(SUBSETS) if not mask & s) for mask in range(SUBSETS)]

MIN_WORDS = 100
DISTINCT_PERCENT = 80
CAPITAL_PERCENT = 10
_BLANKS = r"[\x20\x09-\x0D]+"


def text_failures(text: Column) -> Column:
    """The failure mask of filters A to D, which look at one text only."""
    words = F.array_remove(F.split(text, _BLANKS), "")
    n, different = F.size(words), F.size(F.array_distinct(words))
    capitals = F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = [
        n < MIN_WORDS,
        100 * different < DISTINCT_PERCENT * n,
        100 * capitals > CAPITAL_PERCENT * F.char_length(text),
        text.rlike("[#$%&*|]"),
    ]
    mask = F.lit(0)
    for i, fail in enumerate(fails):
        mask = mask + F.when(fail, 1 << i).otherwise(0)
    return mask


def judged(docs: DataFrame, labels: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """A small row per document: doc_id, sha (of its text), part, mask (of filters A to D), good, toxic."""
    whole = F.coalesce(col(text).cast("string"), F.lit(""))
    rows = docs.select(
        col(key).alias("doc_id"),
        F.unhex(F.sha2(whole, 256)).alias("sha"),
        F.coalesce(col(part).cast("string"), F.lit("")).alias("part"),
        text_failures(whole).alias("mask"),
    )
    marks = labels.groupBy(col(key).alias("doc_id")).agg(
        F.max(F.coalesce(col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    return rows.join(marks, "doc_id", "left").select(
        "doc_id", "sha", "part", "mask", F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )


def survival_words(rows: DataFrame) -> DataFrame:
    """Words to be added up: part, word, times, good, toxic. `rows` (as from `judged`) is read twice; store it first."""
    word = lambda mask: F.element_at(F.array(*[F.lit(w) for w in WORDS]), mask + 1).cast("long")
    failing = F.col("mask") + F.when(F.col("doc_id").isNull(), 0).otherwise(COPY)
    once = F.lit(1).cast("long").alias("times")
    all_rows = rows.select("part", word(failing).alias("word"), once, "good", "toxic")
    # rank() <= 1 is pruned per task, so a text with a third of all rows sends a row per task
    smallest = F.rank().over(Window.partitionBy("sha").orderBy("doc_id"))
    first = (
        rows.where("doc_id IS NOT NULL")
        .groupBy("sha", "doc_id", "part", "mask", "good", "toxic").agg(F.count("*").alias("times"))
        .withColumn("place", smallest).where("place = 1")
    )
    denied = word(F.col("mask")).bitwiseAND(F.bitwise_not(word(F.col("mask") + COPY)))
    return all_rows.unionByName(first.select("part", denied.alias("word"), "times", "good", "toxic"))


def positional_counts(words: np.ndarray, times: np.ndarray) -> np.ndarray:
    """How many words, each counted `times`, have bit 0, 1, ..., 31 set; by carry-save addition."""
    total = np.zeros(SUBSETS, np.int64)
    bits = np.arange(SUBSETS, dtype=np.uint32)
    carried, weight = np.zeros(0, np.uint32), 0
    while len(carried) or (times >> weight).any():
        layer = np.concatenate([carried, words[(times >> weight) & 1 == 1]])
        carries = []
        while len(layer) > 2:
            n = len(layer) // 3
            a, b, c = layer[:n], layer[n : 2 * n], layer[2 * n : 3 * n]
            half = a ^ b
            carries.append((a & b) | (half & c))
            layer = np.concatenate([half ^ c, layer[3 * n :]])
        for left in layer:
            total += ((left >> bits) & 1).astype(np.int64) << weight
        carried = np.concatenate(carries) if carries else carried[:0]
        weight += 1
    return total


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        parts = batch.column("part").dictionary_encode()
        codes = parts.indices.to_numpy(zero_copy_only=False)
        words = batch.column("word").to_numpy().astype(np.uint32)
        times = batch.column("times").to_numpy()
        marks = [np.ones(len(words), bool), *[batch.column(c).to_numpy(zero_copy_only=False) for c in ("good", "toxic")]]
        order = np.argsort(codes, kind="stable")
        ends = np.searchsorted(codes[order], np.arange(len(parts.dictionary) + 1))
        for code, part in enumerate(parts.dictionary.to_pylist()):
            at = order[ends[code] : ends[code + 1]]
            counts = [positional_counts(words[at[m[at]]], times[at[m[at]]]) for m in marks]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * SUBSETS, pa.string()), pa.array(range(SUBSETS), pa.int32()), *map(pa.array, counts)],
                ["part", "subset", "n", "good", "toxic"],
            )


def subset_survivors(words: DataFrame) -> DataFrame:
    """Survivors of every subset per part: part, subset, n, good, toxic; 32 rows a part."""
    added = map_arrow(words, _added, "part string, subset int, n long, good long, toxic long")
    return added.groupBy("part", "subset").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def order_report(survivors: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    steps = [
        {"o": "".join(order), "s": i + 1, "f": letter, "b": sum(1 << FILTERS.index(x) for x in order[:i]), "x": FILTERS.index(letter)}
        for order in permutations(FILTERS)
        for i, letter in enumerate(order)
    ]
    orders = F.from_json(F.lit(json.dumps(steps)), "array<struct<o: string, s: int, f: string, b: int, x: int>>")
    rows = survivors.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("subset", "n", "good", "toxic"))).alias("c"))
    shares = []
    for x in range(len(FILTERS)):
        share = F.lit(0).cast("long")
        for s in range(SUBSETS):
            if not s >> x & 1:
                before = s.bit_count()
                weight = factorial(before) * factorial(len(FILTERS) - 1 - before)  # orders with just s before x
                share = share + weight * (F.get("c", F.lit(s))["n"] - F.get("c", F.lit(s | 1 << x))["n"])
        shares.append(share)
    rows = rows.select("part", "c", F.array(*shares).alias("shapley")).withColumn("step", F.explode(orders))
    own = F.element_at(F.array(*[F.lit(1 << x) for x in range(len(FILTERS))]), F.col("step.x") + 1)
    at = lambda subset, what: F.get("c", subset)[what]
    before, after = F.col("step.b"), F.col("step.b") + own
    lost = lambda what: at(before, what) - at(after, what)
    return rows.select(
        "part", F.col("step.o").alias("filter_order"), F.col("step.s").alias("step"), F.col("step.f").alias("filter"),
        at(after, "n").alias("kept"),
        lost("n").alias("removed"),
        (at(F.lit(0), "n") - at(own, "n") - lost("n")).alias("redundant"),
        (at(SUBSETS - 1 - own, "n") - at(F.lit(SUBSETS - 1), "n")).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.get("shapley", F.col("step.x")).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """The report over all orders of the five filters; `labels` holds the key, `quality` and `toxic`."""
    rows = written(judged(docs, labels, key, text, part), "judged")
    return order_report(written(subset_survivors(survival_words(rows)), "survivors"))
