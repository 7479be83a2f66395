"""Packing documents into token sequences by the sum-of-squares rule.

A document is its token ids and a final id 0. Only documents longer than a sequence are cut. A piece goes where the sum
over all gaps of the squared number of open sequences with that gap becomes smallest: into an open sequence, or a new
one. Pieces come longest first, which leaves the short ones to fill gaps; ties go to the smallest gap.

The rule needs one piece after another, so pieces are dealt to groups of about `group_rows` by a hash, packed each by
itself. A group costs a few sequences that stay open; with tens of thousands of pieces each that is a fraction of a
percent, whatever the input's size. Full pieces are sequences of their own.

A null text is empty: one piece, the final id alone. Equal rows are separate documents. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, find_package, kept, map_arrow, plus, small_batches, written

CAPACITY = 2048
GROUP_ROWS = 40_000
END = (0).to_bytes(4, "little")
CACHED = 1_500_000
# how the tokenizer splits, a fixed value; and characters that it neither composes nor takes for blanks
UNIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
PLAIN = regex.compile("[ -~\u00a1-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]*")


class Tokens:
    """Ids of texts as bytes; what the tokenizer makes of a chunk between blanks is found once and kept.

    The tokenizer lower-cases, splits by `UNIT` and never joins across a unit's border, so the ids of a chunk are those
    of its units. Units are encoded many at a time: every unit's ids end with one that closes a word. A chunk with other
    than `PLAIN` characters goes to the tokenizer as it is.
    """

    def __init__(self, file: str, limit: int = CACHED):
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(file), limit
        vocabulary = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closing[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn_units(self, units: list[str]) -> None:
        for at in range(0, len(units), 4000):
            block = units[at : at + 4000]
            data = self.encode(" ".join(block))
            ends = np.flatnonzero(self.closing[np.frombuffer(data, "<u4")]) + 1
            if len(ends) == len(block) and 4 * ends[-1] == len(data):
                starts = [0, *(4 * ends).tolist()]
                self.known.update((u, data[i:j]) for u, i, j in zip(block, starts, starts[1:]))
            else:
                self.known.update((u, self.encode(u)) for u in block)

    def _learn(self, chunks: set[str]) -> None:
        known, mixed, units = self.known, {}, set()
        for c in chunks:
            if not c.isprintable() or not (c.isascii() or PLAIN.fullmatch(c)):
                known[c] = self.encode(c)
                continue
            low = c.lower()
            if low.isalpha():
                parts = (low,)
            elif low[-1] in ",." and low[:-1].isalpha():
                parts = (low[:-1], low[-1])
            elif "<|" in c:
                known[c] = self.encode(c)
                continue
            else:
                parts = UNIT.findall(low)
            units.update(parts)
            if len(parts) != 1 or parts[0] != c:
                mixed[c] = parts
        self._learn_units([u for u in units if u not in known])
        known.update([(c, b"".join([known[u] for u in parts])) for c, parts in mixed.items()])

    def of(self, texts: list[str | None]) -> Iterator[bytes]:
        """Plain ASCII texts are looked up in lower case, others as they are."""
        for at in range(0, len(texts), 256):
            block = [(t or "").replace("\n", " ") for t in texts[at : at + 256]]
            split = [(t.lower() if t.isascii() and "<|" not in t else t).split(" ") for t in block]
            wanted = set().union(*split)
            new = {w for w in wanted if w not in self.known}
            if new and len(self.known) > self.limit:
                self.known = {"": b""}
                new = wanted - {""}
            if new:
                self._learn(new)
            known = self.known
            for words in split:
                yield b"".join([known[w] for w in words])


def tokens(file: str, limit: int = CACHED) -> Tokens:
    return kept(("tokens", file, limit), lambda: Tokens(file, limit))


def cut_pieces(
    df: DataFrame, key: str, text: str, tokenizer: str, capacity: int = CAPACITY, ids: bool = False, cached: int = CACHED
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, and the ids themselves if asked for.

    A worker keeps the ids of about `cached` chunks, 200 to 250 bytes each.
    """
    small_batches(df.sparkSession)
    source = df.select(col(key).alias("doc_id"), col(text).cast("string").alias("text"))
    numbers = [("piece", "int"), ("start", "long"), ("length", "long"), ("ids_crc32", "long")]
    schema = plus(source.select("doc_id").schema, *numbers, *[("ids", "binary")] * ids)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokens(tokenizer, cached)
        for batch in batches:
            row, piece, start, length, crc, parts = [], [], [], [], [], []
            for i, found in enumerate(known.of(batch.column(1).to_pylist())):
                found += END
                for k, at in enumerate(range(0, len(found), 4 * capacity)):
                    part = found[at : at + 4 * capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if ids:
                        parts.append(part)
            columns = [
                batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(parts, pa.binary())] if ids else []), schema.names)

    return map_arrow(source, cut, schema)


def sum_of_squares(lengths: list[int], capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the offset of each piece, placed in the order given.

    With n[g] open sequences of gap g, a piece of s in a sequence of gap g changes the sum by 2 (n[g-s] - n[g] + 1); one
    that it fills by 1 - 2 n[s]; a new one by 1 + 2 n[capacity-s].
    """
    n = np.zeros(capacity + 1, np.int64)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    never = np.iinfo(np.int64).max
    for i, s in enumerate(lengths):
        best, gap = (1 + 2 * int(n[capacity - s]), 0) if s < capacity else (0, 0)
        if s < capacity:
            here = n[s:capacity]
            change = np.where(here > 0, 2 * (n[: capacity - s] - here + 1), never)
            if n[s]:
                change[0] = 1 - 2 * n[s]
            at = int(change.argmin())
            if change[at] != never and change[at] <= best:
                gap = at + s
        if gap:
            k = waiting[gap].pop()
            n[gap] -= 1
        else:
            k, gap = made, capacity
            made += 1
        sequence[i], offset[i] = k, capacity - gap
        if gap - s:
            waiting[gap - s].append(k)
            n[gap - s] += 1
    return sequence, offset


def pack(
    df: DataFrame, key: str, text: str, tokenizer: str, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, cached: int = CACHED
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    pieces = cut_pieces(df, key, text, tokenizer, capacity, cached=cached).withColumn("row", F.monotonically_increasing_id())
    pieces = written(pieces, "pieces")
    groups = max(1, -(-pieces.count() // group_rows))
    pieces = pieces.withColumn("mixed", F.xxhash64("row", "length"))
    pieces = pieces.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int"))
    schema = plus(pieces.drop("row", "mixed", "group").schema, ("sequence_id", "long"), ("offset", "long"))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        short = rows["length"].where(rows["length"] <= capacity // 20, capacity)
        rows = rows.assign(short=short).sort_values(["short", "mixed", "row"], ascending=[False, True, True])
        sequence, offset = sum_of_squares(rows["length"].tolist(), capacity)
        return rows.assign(sequence_id=(int(rows["group"].iloc[0]) << 40) + sequence, offset=offset)[schema.names]

    find_package(df.sparkSession)
    return pieces.groupBy("group").applyInPandas(place, schema)
