"""Passages of benchmark items in documents, found by CGK embeddings, bit sampling and exact edit distance.

Texts are words: runs of letters and digits, in lower case. In scripts that are written without blanks (`UNSPACED`) every
letter is a word of its own, so an item is found inside a longer run of such letters, and a changed letter is one edit. In
other scripts a word that differs in a letter is one edit as well. A document holds an item of m words if some run of its words
is at most floor(`distance` * m) edits of whole words away from the item.

*Windows.* Items are sorted into classes of about equal size, and every place of a document gives a window of the class's
size. k edits leave at least m - q + 1 - q k of an item's q-grams, so a place whose next m + k words hold fewer grams of
the class's items is skipped; that loses nothing.

*Embedding.* A random walk reads a window three times as long as it is: in each step it emits the word it stands on, and a
random bit, drawn for the step and the word, says whether it moves on. Two strings that differ by few edits emit equal
words at most steps, so edit distance becomes Hamming distance. Each of `WALKS` walks samples `KEYS` times `SAMPLED`
emitted words as keys; a window meets an item if one key is equal. At the largest distance allowed this finds more than
99 of 100 items (measured in the tests); exact copies have all keys equal and are never missed.

*Verification.* Every pair that meets is decided by the exact edit distance between the item and the best run of words
around the window, with bit-parallel dynamic programming.

The items are a stated query set: they go to all tasks in blocks of about `BLOCK_ITEMS`, which bounds the broadcast;
documents are never shuffled. Walks are held for so many windows at a time that their steps come to `CELLS` numbers, so
long items need no more memory than short ones. Very long documents are read whole. Items without a word, and null ones, are found nowhere; equal items are all reported. Null
and empty documents hold nothing. Equal rows are separate documents. Of runs that are equally near to an item the first
found is reported. Added columns avoid the table's names with underscores in front. Empty tables give no hits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import col, fresh, kept, map_arrow, slices, small_batches

DISTANCE = 0.2
BLOCK_ITEMS = 20_000
WALKS, KEYS, SAMPLED = 8, 12, 3
CLASS_RATIO = 1.1
PART_DOCS = 256
CELLS = 1 << 20
#: Thai, Lao, Tibetan, Myanmar, Khmer; kana; Han with its extensions. Fixed values.
UNSPACED = "\u0e01-\u0eff\u0f40-\u0fbc\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
WORD = re.compile(rf"(?:(?![{UNSPACED}])[^\W_])+|(?:(?=[{UNSPACED}])[^\W_])")
PLAIN = re.compile(r"[^\W_]+")
RARE = re.compile(f"[{UNSPACED}]")


def words(text: str | None) -> list[str]:
    text = (text or "").lower()
    return (WORD if RARE.search(text) else PLAIN).findall(text)


def edits(m: int, distance: float = DISTANCE) -> int:
    return int(distance * m + 1e-9)


def gram_length(m: int, k: int) -> int:
    """The longest gram, up to three words, of which k edits leave at least one."""
    return next((q for q in (3, 2) if m - q + 1 - q * k >= 1), 1)


def best_run(item: list[int], text: list[int]) -> tuple[int, int]:
    """The least edit distance of the item to a run of the text, and where such a run ends. Bit-parallel."""
    m = len(item)
    masks: dict[int, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = m, 0
    for at, w in enumerate(text, 1):
        eq = masks.get(w, 0) if w else 0
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph, mh = down | ~(xh | up) & full, up & xh
        score += bool(ph & top) - bool(mh & top)
        ph, mh = (ph << 1) & full, (mh << 1) & full
        up, down = mh | ~(xv | ph) & full, ph & xv
        if score < best:
            best, end = score, at
    return best, end


class Index:
    """The items of a block: their words as numbers from 1, classes of sizes, grams and keys."""

    def __init__(self, items: list[tuple[object, str]], distance: float = DISTANCE, seed: int = 1):
        self.distance = distance
        self.vocabulary: dict[str, int] = {}
        self.ids: list[object] = []
        self.items: list[list[int]] = []
        for key, text in items:
            found = words(text)
            if found:
                self.ids.append(key)
                self.items.append([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in found])
        self.base = len(self.vocabulary) + 1
        self.known: dict[int, np.ndarray] = {}  # by length, the grams of all items
        random = np.random.default_rng(seed)
        self.classes = []
        order = sorted(range(len(self.items)), key=lambda i: len(self.items[i]))
        at = 0
        while at < len(order):
            m = len(self.items[order[at]])
            q = gram_length(m, edits(m, distance))
            end = at
            while end < len(order) and (n := len(self.items[order[end]])) <= m * CLASS_RATIO and gram_length(n, edits(n, distance)) == q:
                end += 1
            self.classes.append(SizeClass(self, order[at:end], m, q, random))
            at = end
        for q in {c.q for c in self.classes}:
            self.known[q] = np.unique(np.concatenate([c.known for c in self.classes if c.q == q]))

    def numbers(self, text: str | None) -> np.ndarray:
        get = self.vocabulary.get
        return np.array([get(w, 0) for w in words(text)], np.int64)

    def grams(self, x: np.ndarray, q: int) -> np.ndarray:
        """Codes of the q-grams; -1 where a word occurs in no item."""
        if len(x) < q:
            return np.empty(0, np.int64)
        code, known = np.zeros(len(x) - q + 1, np.int64), np.ones(len(x) - q + 1, bool)
        for j in range(q):
            part = x[j : len(x) - q + 1 + j]
            code = code * self.base + part
            known &= part > 0
        return np.where(known, code, -1)

    def hits(self, x: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
        """Where a gram of any item begins, and its code."""
        code = self.grams(x, q)
        at = np.flatnonzero(code >= 0)
        found = code[at]
        place = np.minimum(np.searchsorted(self.known[q], found), len(self.known[q]) - 1)
        same = self.known[q][place] == found
        return at[same], found[same]

    def scan(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        """For each text the items it holds: (item, edits, first word, word after the last)."""
        out: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        if not self.classes:
            return out
        gap = np.zeros(2 * max(len(i) for i in self.items) + 4, np.int64)
        parts, begin, place = [], [], 0
        for t in texts:
            x = self.numbers(t)
            begin.append(place)
            parts += [x, gap]
            place += len(x) + len(gap)
        if not parts:
            return out
        x = np.concatenate(parts)
        begin = np.array(begin)
        ends = begin + np.array([len(p) for p in parts[::2]])
        hits = {q: self.hits(x, q) for q in self.known}
        met = [np.empty((0, 3), np.int64)]
        for size in self.classes:
            starts = size.starts(*hits[size.q], len(x))
            docs = np.searchsorted(begin, starts, "right") - 1
            inside = starts < ends[docs]  # not between documents
            starts, docs = starts[inside], docs[inside]
            room = max(1, CELLS // (3 * size.m))  # windows whose walks are held at once
            for at in range(0, len(starts), room):
                window, item = size.meet(x, starts[at : at + room])
                met.append(np.stack([docs[at + window], item, starts[at + window]], axis=1))
        met = np.concatenate(met)
        # windows of an item that begin within its length of each other are decided together
        length = np.array([len(i) for i in self.items])
        met = met[np.lexsort((met[:, 2], met[:, 1], met[:, 0]))]
        _, first = np.unique(np.stack([met[:, 0], met[:, 1], met[:, 2] // length[met[:, 1]]], axis=1), axis=0, return_index=True)
        done: dict[tuple[int, int], tuple[int, int, int]] = {}
        for doc, item, start in met[first].tolist():
            m = len(self.items[item])
            k = edits(m, self.distance)
            known = done.get((doc, item))
            if known and known[0] == 0:
                continue
            lo, hi = max(start - k - 1, int(begin[doc])), min(start + 2 * m + k + 2, int(ends[doc]))
            d, end = best_run(self.items[item], x[lo:hi].tolist())
            if d <= k and (known is None or d < known[0]):
                done[doc, item] = (d, max(lo + end - m, lo), lo + end)
        for (doc, item), (d, a, b) in done.items():
            out[doc].append((item, d, int(a - begin[doc]), int(b - begin[doc])))
        return out


class SizeClass:
    """Items of m to m * CLASS_RATIO words, embedded by their first m words."""

    def __init__(self, index: Index, items: list[int], m: int, q: int, random: np.random.Generator):
        self.index, self.items, self.m, self.q = index, items, m, q
        longest = max(len(index.items[i]) for i in items)
        k = edits(longest, index.distance)
        self.span = longest + k - q + 1
        self.least = max(1, min(len(index.items[i]) - q + 1 - q * edits(len(index.items[i]), index.distance) for i in items))
        self.known = np.unique(np.concatenate([index.grams(np.array(index.items[i]), q) for i in items]))
        steps = 3 * m
        self.factor = random.integers(0, 2**63, (WALKS, steps), np.uint64) | np.uint64(1)
        self.sampled = random.integers(0, steps, (WALKS, KEYS, SAMPLED))
        self.mix = random.integers(0, 2**63, (WALKS, KEYS, SAMPLED), np.uint64) | np.uint64(1)
        first = np.array([index.items[i][:m] for i in items], np.int64).reshape(len(items), m)
        keys = self.keys(first)
        flat = keys.ravel()
        order = np.argsort(flat, kind="stable")
        self.sorted_keys, self.owner = flat[order], np.repeat(np.arange(len(items)), keys.shape[1])[order]

    def starts(self, at: np.ndarray, code: np.ndarray, size: int) -> np.ndarray:
        """Every place whose window can hold an item of the class, from the places and codes of known grams."""
        at = at[np.isin(code, self.known)]
        if not len(at):
            return at
        # hits in [s, s + span) for the places s up to `span` before a hit
        few = len(at) * self.span < size  # otherwise all places take less room
        around = np.unique((at[:, None] - np.arange(self.span)[None, :]).ravel()) if few else np.arange(size)
        around = around[(around >= 0) & (around < size)]
        count = np.searchsorted(at, around + self.span) - np.searchsorted(at, around)
        return around[count >= self.least]

    def keys(self, windows: np.ndarray) -> np.ndarray:
        """(window, key): hashes of the sampled words of the embeddings."""
        n, m = windows.shape
        padded = np.concatenate([windows, np.full((n, 1), -1)], axis=1).astype(np.int64)
        rows = np.arange(n)
        out = np.empty((n, WALKS * KEYS), np.uint64)
        for w in range(WALKS):
            place = np.zeros(n, np.int64)
            emitted = np.empty((3 * m, n), np.int64)
            for j in range(3 * m):
                here = padded[rows, place]
                emitted[j] = here
                bit = ((here + 2).astype(np.uint64) * self.factor[w, j]) >> np.uint64(40)
                bit = (bit * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(63)
                place = np.minimum(place + bit.astype(np.int64), m)
            for k in range(KEYS):
                h = np.full(n, w * KEYS + k + 1, np.uint64)
                for b in range(SAMPLED):
                    h = (h ^ (emitted[self.sampled[w, k, b]] + 2).astype(np.uint64)) * self.mix[w, k, b]
                    h ^= h >> np.uint64(31)
                out[:, w * KEYS + k] = h
        return out

    def meet(self, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows and items with an equal key, each pair once."""
        at = np.minimum(starts[:, None] + np.arange(self.m)[None, :], len(x) - 1)
        keys = self.keys(x[at]).ravel()
        low, high = np.searchsorted(self.sorted_keys, keys), np.searchsorted(self.sorted_keys, keys, "right")
        some = np.flatnonzero(high > low)
        count = high[some] - low[some]
        owner = np.repeat(low[some] - np.cumsum(count) + count, count) + np.arange(count.sum())
        window = np.repeat(some // (WALKS * KEYS), count)
        pairs = np.unique(window * len(self.items) + self.owner[owner])
        return pairs // len(self.items), np.array(self.items)[pairs % len(self.items)]


def scan(df: DataFrame, text: str, benchmark: DataFrame, item: str, item_text: str, name: str = "hits", distance: float = DISTANCE) -> DataFrame:
    """All columns and an array of what each document holds: item, edits, first word, word after the last."""
    spark = df.sparkSession
    small_batches(spark)
    kind = benchmark.select(col(item)).schema[0].dataType
    hit = T.StructType(
        [T.StructField("item", kind), T.StructField("edits", T.IntegerType()), T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]
    )
    rows = benchmark.select(col(item).alias("item"), col(item_text).cast("string").alias("text")).where("text is not null")
    rows = rows.distinct().withColumn("mix", F.xxhash64("text", F.col("item").cast("string")))
    blocks = max(1, -(-rows.count() // BLOCK_ITEMS))
    out, names = df, []
    for b in range(blocks):
        part = rows.where(F.pmod("mix", F.lit(blocks)) == b).orderBy("mix").select("item", "text").collect()
        shared = spark.sparkContext.broadcast([(r["item"], r["text"]) for r in part])  # about BLOCK_ITEMS
        names.append(fresh(name if blocks == 1 else f"{name}{b}", out.columns))
        out = map_arrow(out, _scan_rows(shared, out.columns.index(text), hit, distance, names[-1]), T.StructType([*out.schema.fields, T.StructField(names[-1], T.ArrayType(hit))]))
    if blocks == 1:
        return out
    return out.select(*[col(c) for c in df.columns], F.concat(*names).alias(fresh(name, df.columns)))


def _scan_rows(shared, at: int, hit: T.StructType, distance: float, name: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept()
        index = Index(shared.value, distance)
        for batch in slices(batches, PART_DOCS):
            found = []
            for hits in index.scan(batch.column(at).to_pylist()):
                found.append([{"item": index.ids[i], "edits": d, "begin": a, "end": b} for i, d, a, b in hits])
            array = pa.array(found, pa.list_(to_arrow_type(hit)))
            yield pa.RecordBatch.from_arrays([*batch.columns, array], [*batch.schema.names, name])

    return rows


def contamination_report(docs: DataFrame, key: str, text: str, benchmark: DataFrame, item: str, item_text: str) -> DataFrame:
    """doc_id, item_id, edits, begin_word, end_word of every document and item that it holds."""
    rows = docs.select(col(key).alias("doc_id"), col(text).cast("string").alias("_text"))
    found = scan(rows, "_text", benchmark, item, item_text).select("doc_id", F.explode("hits").alias("hit"))
    return found.select(
        "doc_id", F.col("hit.item").alias("item_id"), F.col("hit.edits").alias("edits"),
        F.col("hit.begin").alias("begin_word"), F.col("hit.end").alias("end_word"),
    )


def drop_contaminated(docs: DataFrame, text: str, benchmark: DataFrame, item: str, item_text: str) -> DataFrame:
    """The documents that hold no item, with their columns."""
    name = fresh("hits", docs.columns)
    return scan(docs, text, benchmark, item, item_text, name).where(F.size(col(name)) == 0).select(*[col(c) for c in docs.columns])
