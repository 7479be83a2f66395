"""Documents whose sets of word n-grams have a Jaccard similarity of at least num / den, by signature trees.

A document's set holds the 64-bit hashes of its distinct n-grams of words. Equal sets are one class; classes are linked
exactly, in two steps.

*Which classes can meet.* With hashes in ascending order, two similar sets of sizes about n share at least l(n) of their
first n - ceil(t n) + l(n) hashes. So every class posts these hashes only, and then drops out if fewer than l of them
occur in any other class; what remains is counted again (`ROUNDS` times), which leaves near copies and little else. Of
the shared hashes a class needs only the rarest ones for meeting each partner in one of them. Classes that meet, directly
or not, form a candidate group; groups contain all similar pairs, and usually little else.

*Blocks.* A group of up to `part_tokens` hashes is a block. A larger one is mostly a chain of classes that meet by chance,
and grows with the table. It has a block for every hub of its hashes; the hub of a hash is, of the classes with it, the one
that meets most others, so classes with much in common have few hubs. A class is in the blocks of the hubs of all its hashes:
two that meet in a hash are in the block of its hub. Where classes have so many hubs that this copies more than one block
would, the group is one block. A block above `part_tokens` hashes is dealt in parts.

*Signature trees.* The sets of a block come together in one task, or in one task per pair of
parts of the block, so no task grows with it. A tree is built over the classes in order of size: leaves hold a bitmap of
their classes' hashes, inner nodes the OR of their children's, each with the range of sizes and the largest number of
hashes that a bitmap hides by collisions. Two trees are walked together; a pair of nodes is left when the sizes can't fit
or the common bits plus the hidden hashes are fewer than the overlap needed. Pairs of leaves' classes that pass the same
bound by their own bitmaps are compared hash by hash. A pair that is connected already is skipped: components need no
second way. Links of all tasks then give the components.

Null and empty texts, and those without a word, have an empty set and no link. A text with fewer words than n has one
n-gram, all its words. Repeated rows and equal texts are members of one class. A null key takes part; the component is
named by the smallest key that isn't null. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bloom import build
from .common import col, discard, find_package, fresh, kept, map_arrow, plus, slices, small_batches, written
from .components import components

ROUNDS = 2
PART_TOKENS = 250_000
LEAF, FAN = 16, 8
#: Words are runs of other than ASCII blanks.
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
KNOWN_WORDS = 1 << 17  # hashes of words a worker keeps; others are found again
ROWS = 256  # texts that are cut into n-grams at a time


@dataclass(frozen=True)
class Similarity:
    """Sets of n-grams of `words` words are alike if den * |x & y| >= num * |x | y|."""

    words: int = 4
    num: int = 85
    den: int = 100

    def least_overlap(self, a: int | np.ndarray, b: int | np.ndarray) -> int | np.ndarray:
        return -(-self.num * (a + b) // (self.num + self.den))

    def least_partner(self, n):
        return -(-self.num * n // self.den)

    def extra(self, n):
        """l(n): how many of the first hashes two similar sets must share."""
        return (n - self.least_partner(n)) // 2 + 1

    def prefix(self, n: int) -> int:
        return n - self.least_partner(n) + self.extra(n)

    def least_shared(self, n: Column) -> Column:
        """l of the smallest possible partner."""
        partner = F.ceil(F.lit(self.num) * n / self.den)
        return F.floor((partner - F.ceil(F.lit(self.num) * partner / self.den)) / 2) + 1

    def smallest(self) -> int:
        """The smallest set that can be similar to a different one."""
        return next(n for n in range(1, 10_000) if self.den * n >= self.num * (n + 1))


class Shingles:
    """Hashes of n-grams of words; the hash of a word is found once and kept."""

    def __init__(self, words: int):
        self.words = words
        self.known: dict[bytes, int] = {}
        random = np.random.default_rng(words)
        self.factors = random.integers(1, 2**63, words, np.uint64) * np.uint64(2) + np.uint64(1)

    def of(self, text: str | None) -> np.ndarray:
        found = WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(LOWER))
        if not found:
            return np.empty(0, np.uint64)
        if len(self.known) > KNOWN_WORDS:
            self.known = {}
        known = self.known
        for w in (w for w in set(found) if w not in known):
            known[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        h = np.fromiter((known[w] for w in found), np.uint64, len(found))
        n = min(self.words, len(h))
        out = np.full(len(h) - n + 1, n, np.uint64)  # a short text differs from a longer one's n-gram
        for k in range(n):
            out = (out ^ h[k : len(h) - n + 1 + k]) * self.factors[k]
            out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        return np.unique(out ^ (out >> np.uint64(32)))


def shingles_of(words: int) -> Shingles:
    """One for each worker."""
    return kept(("shingles", words), lambda: Shingles(words))


def _outline(rule: Similarity, schema):
    """What a document shows of its set: size, identity, first hashes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, least = shingles_of(rule.words), rule.smallest()
        for batch in slices(batches, ROWS):
            digests, sizes, firsts = [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles.of(text)
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                sizes.append(len(s))
                firsts.append(s[: rule.prefix(len(s))].view(np.int64) if len(s) >= least else np.empty(0, np.int64))
            ends = np.cumsum([0, *map(len, firsts)])
            values = np.concatenate([np.empty(0, np.int64), *firsts])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
            columns = [batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), lists], schema.names
            )

    return rows


def _sets(rule: Similarity, schema):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = shingles_of(rule.words)
        for batch in slices(batches, ROWS):
            found = [shingles.of(t).tobytes() for t in batch.column("text").to_pylist()]
            columns = [batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.binary())], schema.names)

    return rows


class Tree:
    """Bitmaps over sets in order of size: level 0 has the sets, every next level the nodes over `fan` of the last."""

    def __init__(self, sets: list[np.ndarray], bits: int):
        self.sets = sets
        self.size = np.array([len(s) for s in sets])
        self.map = np.zeros((len(sets), bits // 64), np.uint64)
        for i, s in enumerate(sets):
            at = (s & np.uint64(bits - 1)).astype(np.int64)
            np.bitwise_or.at(self.map[i], at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        hidden = self.size - np.bitwise_count(self.map).sum(1).astype(np.int64)
        self.levels = [(self.map, self.size, self.size, hidden)]
        fan = LEAF
        while len(self.levels[-1][0]) > 1:
            maps, low, high, hide = self.levels[-1]
            cut = np.arange(0, len(maps), fan)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(maps, cut, axis=0), np.minimum.reduceat(low, cut),
                    np.maximum.reduceat(high, cut), np.maximum.reduceat(hide, cut),
                )
            )
            fan = FAN

    def children(self, level: int, node: int) -> np.ndarray:
        fan = LEAF if level == 1 else FAN
        return np.arange(node * fan, min((node + 1) * fan, len(self.levels[level - 1][0])))


def find(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def walk(left: Tree, right: Tree, same: bool, parent: list[int], shift: int, rule: Similarity) -> None:
    """Unites, in `parent`, the similar sets of two trees; those of the right one are numbered from `shift`."""
    start = min(len(left.levels), len(right.levels)) - 1
    tops = [(a, b) for a in range(len(left.levels[start][0])) for b in range(len(right.levels[start][0]))]
    todo = [(start, a, b) for a, b in tops if not same or a <= b]
    while todo:
        level, a, b = todo.pop()
        if level == 0:
            x, y = find(parent, a), find(parent, shift + b)
            if x != y:
                common = len(np.intersect1d(left.sets[a], right.sets[b], assume_unique=True))
                if common >= rule.least_overlap(len(left.sets[a]), len(right.sets[b])):
                    parent[max(x, y)] = min(x, y)
            continue
        la, lb = left.children(level, a), right.children(level, b)
        maps, low, high, hide = left.levels[level - 1]
        maps2, low2, high2, hide2 = right.levels[level - 1]
        need = rule.least_overlap(low[la][:, None], low2[lb][None, :])
        fits = (high2[lb][None, :] >= rule.least_partner(low[la])[:, None]) & (
            high[la][:, None] >= rule.least_partner(low2[lb])[None, :]
        )
        for i in np.flatnonzero(fits.any(1)):
            inside = np.flatnonzero(fits[i])
            common = np.bitwise_count(maps[la[i]] & maps2[lb[inside]]).sum(1).astype(np.int64)
            most = common + np.minimum(hide[la[i]], hide2[lb[inside]])
            for j in inside[most >= need[i][inside]]:
                x, y = int(la[i]), int(lb[j])
                if same and (x > y or (level == 1 and x == y)):
                    continue
                if level > 1 or find(parent, x) != find(parent, shift + y):
                    todo.append((level - 1, x, y))


def tree_links(rows: pd.DataFrame, rule: Similarity) -> pd.DataFrame:
    """Links a, b of the similar pairs of one block, or between two parts of a block: enough to connect them."""
    halves = [rows[rows["side"] == k].sort_values(["n", "node"]) for k in (0, 1)]
    sets = [[np.frombuffer(s, np.uint64) for s in half["grams"]] for half in halves]
    sizes = np.concatenate([half["n"].to_numpy() for half in halves])
    bits = 1 << int(np.clip(8 * np.median(sizes), 256, 1 << 16) - 1).bit_length()
    nodes = np.concatenate([half["node"].to_numpy() for half in halves])
    parent = list(range(len(nodes)))
    trees = [Tree(s, bits) for s in sets if s]
    if len(trees) == 1:
        walk(trees[0], trees[0], True, parent, 0, rule)
    else:
        walk(trees[0], trees[1], False, parent, len(sets[0]), rule)
    roots = np.array([find(parent, i) for i in range(len(nodes))])
    linked = roots != np.arange(len(nodes))
    return pd.DataFrame({"a": nodes[linked], "b": nodes[roots[linked]]})


def shared_prefixes(postings: DataFrame, rule: Similarity) -> DataFrame:
    """token, node, n of the hashes by which a class has to meet its partners, as far as it can have one.

    `weight` tells how many others a class meets in them, about.
    """
    rows, used = postings, []
    for _ in range(ROUNDS):
        counts = written(rows.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "token-counts")
        rows = rows.drop("df").join(counts, "token")
        own = Window.partitionBy("node")
        rows = rows.withColumn("shared", F.count("*").over(own)).where(F.col("shared") >= rule.least_shared(F.col("n")))
        rows = written(rows.drop("shared"), "shared-tokens")
        discard(counts, *used)
        used = [rows]
    own = Window.partitionBy("node")
    place = F.row_number().over(own.orderBy("df", "token"))
    rows = rows.withColumn("shared", F.count("*").over(own)).withColumn("place", place)
    rows = rows.where(F.col("place") <= F.col("shared") - rule.least_shared(F.col("n")) + 1)
    meeting = written(rows.select("token", "node", "n", F.sum("df").over(own).alias("weight")), "meeting-tokens")
    discard(*used)
    return meeting


def met_hubs(meeting: DataFrame) -> DataFrame:
    """node, hub: the hubs that a class meets others at. The hub of a hash is the class of most weight that has it."""
    most = F.max(F.struct("weight", "node"))["node"].alias("hub")
    hubs = written(meeting.groupBy("token").agg(most, F.count("*").alias("df")).where("df > 1").drop("df"), "hubs")
    met = written(meeting.join(hubs, "token").select("node", "hub").distinct(), "met-hubs")
    discard(hubs)
    return met


def blocks(members: DataFrame, met: DataFrame, part_tokens: int) -> DataFrame:
    """node, block, parts: where the set of each class goes; any two that meet in a hash are in a block together."""
    of = lambda total: F.ceil(F.col(total) / part_tokens).cast("int")
    totals = members.groupBy("grp").agg(F.sum("n").alias("total"))
    totals = written(totals.select("grp", "total", of("total").alias("parts")), "group-parts")
    large = totals.where("parts > 1")
    by_hub = members.join(large.select("grp"), "grp").join(met, "node").select("grp", "hub", "node", "n")
    hubs = by_hub.groupBy("grp", "hub").agg(F.sum("n").alias("total"))
    hubs = written(hubs.select("grp", "hub", "total", of("total").alias("parts")), "hub-parts")
    copied = hubs.groupBy("grp").agg(F.sum(F.col("total") * F.col("parts")).alias("copied"))
    split = written(large.join(copied, "grp").where(F.col("copied") < F.col("total") * F.col("parts")).select("grp"), "split-groups")
    whole = members.join(totals.join(split, "grp", "left_anti"), "grp").select("node", F.col("grp").alias("block"), "parts")
    by_hub = members.join(split, "grp").join(met, "node").join(hubs.select("hub", "parts"), "hub")
    placed = written(whole.unionByName(by_hub.select("node", F.col("hub").alias("block"), "parts")), "blocks")
    discard(totals, hubs, split)
    return placed


def exact_links(
    docs: DataFrame, classes: DataFrame, groups: DataFrame, met: DataFrame, rule: Similarity, part_tokens: int
) -> DataFrame:
    """a, b: verified links. docs: text and its hash; classes: node, n, and the hash of one of their texts."""
    members = written(
        groups.select("node", F.col("component").alias("grp")).join(classes.select("node", "n", "text_hash"), "node"), "members"
    )
    placed = blocks(members, met, part_tokens)
    places = placed.groupBy("node").agg(F.collect_list(F.struct("block", "parts")).alias("places"))
    wanted = members.drop("grp").join(places, "node")
    # a Bloom filter lets few other texts than those of members leave the scan
    hashes = written(members.select("text_hash").distinct(), "member-texts")
    likely = build(hashes, "text_hash", hashes.count()).flag(docs, "likely", F.col("text_hash")).where("likely")
    texts = likely.groupBy("text_hash").agg(F.first("text").alias("text"))
    source = wanted.join(texts, "text_hash").select("node", "n", "places", "text")
    schema = plus(source.drop("text").schema, ("grams", "binary"))
    sets = written(map_arrow(source, _sets(rule, schema), schema), "member-sets")
    discard(members, placed, hashes)
    dealt = sets.select("node", "n", "grams", F.explode("places").alias("at")).select("node", "n", "grams", "at.block", "at.parts")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = dealt.withColumn("other", other).select(
        "node", "n", "grams", "block", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"),
        (F.col("part") > F.col("other")).cast("int").alias("side"),
    )
    find_package(docs.sparkSession)
    links = dealt.groupBy("block", "p", "q").applyInPandas(lambda rows: tree_links(rows, rule), "a long, b long")
    links = written(links, "exact-links")
    discard(sets)
    return links


def grouped(df: DataFrame, key: str, text: str, rule: Similarity = Similarity(), part_tokens: int = PART_TOKENS) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id of every row, and whether the row names its component."""
    small_batches(df.sparkSession)
    docs = with_hash(df.select(col(key).alias("doc_id"), col(text).cast("string").alias("text")), "text", "text_hash")
    ordered = docs.select("doc_id", "text_hash", "text")
    schema = plus(ordered.drop("text").schema, ("digest", "binary"), ("n", "long"), ("first", "array<long>"))
    outlines = written(map_arrow(ordered, _outline(rule, schema), schema), "outlines")
    name = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")
    classes = outlines.where("n > 0").groupBy("digest").agg(
        F.first("n").alias("n"), F.first("first").alias("first"), F.min("text_hash").alias("text_hash"),
        F.min(name).alias("least"),
    )
    whole = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    outlines, heavy = written(outlines.drop("first"), "outline-sizes"), outlines
    discard(heavy)
    postings = whole.select("node", "n", F.explode("first").alias("token"))
    meeting = shared_prefixes(postings, rule)
    classes = written(whole.drop("first"), "class-sizes")
    discard(whole)
    met = met_hubs(meeting)
    discard(meeting)
    groups = components(met, "node", "hub")  # node, component: classes that meet in a hash, directly or by others
    links = exact_links(docs.select("text", "text_hash"), classes.select("node", "n", "text_hash"), groups, met, rule, part_tokens)
    labelled = classes.select("digest", "node", "least").join(components(links), "node", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "node"))
    least = written(labelled.groupBy("component").agg(F.min("least").alias("named")), "component-names")
    named = written(labelled.join(least, "component").select("digest", "named"), "class-names")
    rows = outlines.join(named, "digest", "left").withColumn("own", name)
    alone = F.col("n") == 0
    return rows.select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("named.doc_id")).alias("component_id"),
        (alone | F.col("own").eqNullSafe(F.col("named"))).alias("first"),
    )


def with_hash(df: DataFrame, text: str, name: str) -> DataFrame:
    return df.withColumn(name, F.xxhash64(F.coalesce(col(text), F.lit("")), F.length(col(text))))


def similar_groups(df: DataFrame, key: str, text: str, rule: Similarity = Similarity()) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    return grouped(df, key, text, rule).select("doc_id", "n_shingles", "component_id")


def drop_similar(df: DataFrame, key: str, text: str, rule: Similarity = Similarity()) -> DataFrame:
    """One document of each component, that with the smallest key; rows with equal key and text are one document.

    A Bloom filter of the documents to go lets most others pass without a shuffle.
    """
    k, h, both = (fresh(n, df.columns) for n in ("_k", "_h", "_both"))
    gone = grouped(df, key, text, rule).where("not first").select(F.col("doc_id").alias(k), F.col("text_hash").alias(h))
    gone = written(gone.distinct().withColumn(both, F.xxhash64(k, h)), "similar-ids")
    hashed, maybe = fresh("text_hash", df.columns), fresh("maybe", df.columns)
    rows = with_hash(df, text, hashed)
    rows = build(gone, both, gone.count()).flag(rows, maybe, F.xxhash64(col(key), F.col(hashed)))
    columns = [col(c) for c in df.columns]
    same = (F.col(hashed) == F.col(h)) & col(key).eqNullSafe(F.col(k))
    kept = rows.where(maybe).join(gone, same, "left_anti")
    return rows.where(~F.col(maybe)).select(*columns).unionByName(kept.select(*columns))
