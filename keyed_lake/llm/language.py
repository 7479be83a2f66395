"""Language by prediction by partial matching over bytes.

For every language a tree of byte contexts up to `order` bytes holds how often each byte followed. The code length of a
byte is that of a variable-order model with escapes (method C): in the longest known context a byte seen c times of n,
with u different ones, costs -log2(c / (n + u)); an unseen byte costs the escape -log2(u / (n + u)) and is tried in the
context one byte shorter; below the empty context all 256 bytes are alike. The counts are frozen after training, so a
byte's cost depends on the `order` bytes before it only, and the code length of a text is an exact sum. The language
with the shortest code wins.

Training takes at most `train_rows` texts of each language, those with the smallest hash of the key. Of each language's
contexts with their bytes the model keeps at most `max_grams`, shorter and more frequent ones first, whatever other
languages hold; that bounds what reaches the driver and the workers. How often a context occurred and how many
bytes followed it are counted before, so the costs of what is kept are exact. Everything else covers all rows and whole texts.

A text that is null, empty or without a letter is `und`, with score 0. Equal code lengths go to the language that comes
first in the alphabet. Without a single labelled row every text is `und`. Training rows with equal key, text and language count once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, fold, fresh, kept, map_arrow, plus, slices, small_batches, written

ORDER = 4
TRAIN_ROWS = 600
MAX_GRAMS = 250_000  # a language; 600 texts of the tables at hand have about 75,000
UNKNOWN = "und"
BLOCK = 1 << 18  # bytes whose costs are worked out at once
ROWS = 256  # rows of a batch that are taken at once: a worker holds the texts of so many beside the batch
PART = 1 << 14
LETTER = regex.compile(r"\p{L}")


def codes(data: np.ndarray, order: int) -> np.ndarray:
    """The byte and the `order` bytes before it as one number, for every place from `order` on."""
    out = np.zeros(len(data) - order, np.uint64)
    for k in range(order + 1):
        out = (out << np.uint64(8)) | data[k : len(data) - order + k]
    return out


def joined(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts behind one another, `order` line ends before each; where each begins and ends among the codes."""
    gap = b"\n" * order
    data = np.frombuffer(gap + gap.join(texts), np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    begin = np.concatenate([[0], np.cumsum(size + order)[:-1]]).astype(np.int64)
    return data, begin, begin + size


@dataclass
class Model:
    """Grams of `order` + 1 bytes and their costs in bits under each language; the counts behind them."""

    languages: list[str]
    order: int
    grams: list[np.ndarray]  # by length - 1: sorted codes
    counts: list[np.ndarray]  # (gram, language)
    followed: list[np.ndarray]  # (gram, language): how often another byte came after the gram
    followers: list[np.ndarray]  # (gram, language): how many different ones

    def prepare(self) -> Model:
        # by the length of a context; all of the bytes without one are kept
        self.totals = [self.counts[0].sum(0, dtype=np.int64)[None, :], *self.followed]
        self.kinds = [(self.counts[0] > 0).sum(0)[None, :], *self.followers]
        # an open table of the longest grams: a slot holds the gram that came last, the rest is found by search
        longest = self.grams[self.order]
        self.known_cost = np.zeros((len(longest), len(self.languages)), np.float32)
        for at in range(0, len(longest), PART):  # in parts: the chain of escapes needs many times the room of its result
            self.known_cost[at : at + PART] = self.exact(longest[at : at + PART])
        self.bits = max(12, int(2 * len(self.known_cost) + 1).bit_length())
        slot = self.slots(self.grams[self.order])
        self.table = np.full(1 << self.bits, len(self.known_cost), np.int32)
        self.table[slot] = np.arange(len(slot), dtype=np.int32)
        self.keys = np.append(self.grams[self.order], np.uint64(2**64 - 1))
        return self

    def slots(self, grams: np.ndarray) -> np.ndarray:
        return ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, k: int, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.grams[k]):
            return np.zeros(len(grams), np.int64), np.zeros(len(grams), bool)
        at = np.minimum(np.searchsorted(self.grams[k], grams), len(self.grams[k]) - 1)
        return at, self.grams[k][at] == grams

    def exact(self, grams: np.ndarray) -> np.ndarray:
        """The cost of the last byte of each gram under each language, by the whole chain of escapes."""
        cost = np.zeros((len(grams), len(self.languages)))
        pending = np.ones(cost.shape, bool)
        for k in range(self.order, -1, -1):
            gram = grams & np.uint64((1 << (8 * (k + 1))) - 1)
            if k:
                at, ok = self._find(k - 1, gram >> np.uint64(8))
                n, u = self.totals[k][at] * ok[:, None], self.kinds[k][at] * ok[:, None]
            else:
                n, u = np.broadcast_to(self.totals[0], cost.shape), np.broadcast_to(self.kinds[0], cost.shape)
            at, ok = self._find(k, gram)
            seen = self.counts[k][at] * ok[:, None] if len(self.grams[k]) else np.zeros(cost.shape)
            with np.errstate(divide="ignore", invalid="ignore"):
                hit = -np.log2(seen / (n + u.astype(np.int64)))
                escape = -np.log2(u / (n + u.astype(np.int64)))
            now = pending & (n > 0)
            cost += np.where(now & (seen > 0), hit, 0) + np.where(now & (seen == 0), escape, 0)
            pending &= ~(now & (seen > 0))
        return cost + 8.0 * pending

    def costs(self, grams: np.ndarray) -> np.ndarray:
        row = self.table[self.slots(grams)]
        lost = np.flatnonzero(self.keys[row] != grams)
        row[lost] = 0
        cost = self.known_cost[row] if len(self.known_cost) else np.zeros((len(grams), len(self.languages)), np.float32)
        if len(lost):
            rare, back = np.unique(grams[lost], return_inverse=True)
            cost[lost] = self.exact(rare)[back]
        return cost

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """The code length in bits of each text under each language. Works on about BLOCK bytes at a time."""
        out = np.zeros((len(texts), len(self.languages)))
        i = 0
        while i < len(texts):
            j, size = i, 0
            while j < len(texts) and (j == i or size + len(texts[j]) <= BLOCK):
                size += len(texts[j])
                j += 1
            data, begin, end = joined(texts[i:j], self.order)
            for at in range(0, len(data) - self.order, BLOCK):  # a text longer than a block comes in parts
                part = data[at : at + BLOCK + self.order]
                sums = np.zeros((len(part) - self.order + 1, len(self.languages)))
                np.cumsum(self.costs(codes(part, self.order)), axis=0, out=sums[1:])
                lo, hi = np.clip(begin - at, 0, len(sums) - 1), np.clip(end - at, 0, len(sums) - 1)
                out[i:j] += sums[hi] - sums[lo]
            i = j
        return out


def _count_grams(order: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist())
            texts = [t.encode() for t in batch.column(1).to_pylist()]
            for lang in np.unique(langs):
                data, begin, end = joined([t for t, x in zip(texts, langs) if x == lang], order)
                inside = np.zeros(len(data) - order + 1, np.int8)
                np.add.at(inside, begin, 1)
                np.add.at(inside, end, -1)
                full = codes(data, order)[np.cumsum(inside[:-1]) > 0]
                for k in range(order + 1):
                    gram, n = np.unique(full & np.uint64((1 << (8 * (k + 1))) - 1), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([str(lang)] * len(gram), pa.string()), pa.array([k] * len(gram), pa.int32()),
                            pa.array(gram.astype(np.int64)), pa.array(n.astype(np.int64)),
                        ],
                        ["lang", "k", "gram", "n"],
                    )

    return count


def train(
    labelled: DataFrame, key: str, text: str, lang: str, order: int = ORDER, train_rows: int = TRAIN_ROWS, max_grams: int = MAX_GRAMS
) -> Model:
    """A model of the rows whose language isn't null. Only texts with a letter teach anything."""
    rows = labelled.select(col(lang).cast("string").alias("lang"), col(text).cast("string").alias("text"), col(key).alias("key"))
    rows = rows.where("lang is not null and text rlike '\\\\p{L}'").withColumn("mix", F.xxhash64(F.col("key").cast("string"), "text"))
    # rows are chosen by their hashes: about twice as many as wanted by a threshold, then the smallest; only the chosen
    # texts leave the scan
    hashes = rows.select("lang", "mix")
    sizes = written(hashes.groupBy("lang").agg(F.count("*").alias("size")), "language-sizes")  # a row a language
    share = F.lit(2.0 * train_rows) / F.col("size")
    likely = hashes.join(sizes, "lang").where(F.pmod("mix", F.lit(1 << 30)) < share * (1 << 30))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("mix"))
    ids = likely.select("lang", "mix").distinct().withColumn("place", first).where(F.col("place") <= train_rows)
    ids = ids.select("lang", "mix")
    sample = rows.join(F.broadcast(written(ids, "language-ids")), ["lang", "mix"])  # train_rows a language at most
    sample = sample.groupBy("lang", "mix").agg(F.first("text").alias("text")).select("lang", "text")
    schema = plus(sample.select("lang").schema, ("k", "int"), ("gram", "long"), ("n", "long"))
    grams = map_arrow(sample, _count_grams(order), schema).groupBy("lang", "k", "gram").agg(F.sum("n").alias("n"))
    grams = written(grams, "language-grams")  # of the sample only
    contexts = grams.where("k > 0").groupBy("lang", (F.col("k") - 1).alias("k"), F.shiftright("gram", 8).alias("gram"))
    contexts = contexts.agg(F.sum("n").alias("followed"), F.count("*").alias("followers"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("k", F.desc("n"), "gram"))
    kept = grams.withColumn("place", place).where(F.col("place") <= max(max_grams, 256)).drop("place")
    found = kept.join(contexts, ["lang", "k", "gram"], "left").na.fill(0, ["followed", "followers"]).toArrow()
    languages = sorted(found["lang"].unique().to_pylist())
    number = pc.index_in(found["lang"], pa.array(languages, pa.string())).to_numpy()
    lengths, grams = found["k"].to_numpy(), found["gram"].to_numpy()
    facts = [found[c].to_numpy() for c in ("n", "followed", "followers")]
    keys: list[np.ndarray] = []
    tables: list[list[np.ndarray]] = [[], [], []]
    for k in range(order + 1):
        own = lengths == k
        distinct, at = np.unique(grams[own].astype(np.uint64), return_inverse=True)
        keys.append(distinct)
        for of, fact in zip(tables, facts if k < order else facts[:1]):  # nothing follows the longest
            table = np.zeros((len(distinct), len(languages)), np.uint32)  # of a bounded sample; half the size of a double
            table[at, number[own]] = fact[own]
            of.append(table)
    return Model(languages, order, keys, *tables)


def predict(df: DataFrame, text: str, model: Model, lang_name: str = "lang_pred", score_name: str = "score") -> DataFrame:
    """All columns and the two predicted ones, with underscores in front if their names are taken.

    The score is the winner's share if all languages are as likely before.
    """
    lang_name, score_name = fresh(lang_name, df.columns), fresh(score_name, df.columns)
    if not model.languages:
        return df.withColumns({lang_name: F.lit(UNKNOWN), score_name: F.lit(0.0)})
    small_batches(df.sparkSession)
    schema = plus(df.schema, (lang_name, "string"), (score_name, "double"))
    at = df.columns.index(text)
    shared = df.sparkSession.sparkContext.broadcast(model)  # max_grams a language at most

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept()
        known = shared.value.prepare()
        names = np.array([*known.languages, UNKNOWN], object)
        for batch in slices(batches, ROWS):
            texts = [t or "" for t in batch.column(at).to_pylist()]
            lettered = np.array([LETTER.search(t) is not None for t in texts], bool)
            bits = known.lengths([t.encode() for t in texts])
            best = bits.argmin(1)
            ahead = np.minimum(bits - bits.min(1, keepdims=True), 1000)
            score = np.where(lettered, 1 / np.exp2(-ahead).sum(1), 0.0)
            lang = names[np.where(lettered, best, len(names) - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang.tolist(), pa.string()), pa.array(score, pa.float64())], schema.names
            )

    return map_arrow(df, rate, schema)


def held_out(key: str, folds: int = 4, fold_no: int = 2) -> Column:
    return fold(key, folds) == fold_no


def entropy(bits: float, size: int) -> float:
    """Bits a byte; for reports."""
    return bits / size if size else math.nan
