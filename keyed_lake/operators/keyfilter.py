"""A Bloom filter of the keys of a batch, asked by the rows of a target before they are shuffled.

The filter is a table of 64-bit words. A key sets three bits of one word, so a row of the target needs one look-up in
one broadcast table. Rows without all three bits surely have no partner in the batch and can pass by a join. The size of
the broadcast is bounded by `max_bytes`; a batch with too many keys for that gets no filter, and the join goes on as without.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
LEAST_BITS_PER_KEY = 6  # below that the filter lets most rows through
WORD_BYTES = 32  # of a word in the broadcast table


@dataclass(frozen=True)
class KeyFilter:
    words: DataFrame
    n_words: int
    keys: tuple[str, ...]

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The rows that may have a partner, and those that have none (keys with a NULL among them)."""
        word, mask = _places(self.keys, self.n_words)
        marked = (
            df.withColumn("_word", word)
            .join(F.broadcast(self.words), "_word", "left")
            .withColumn("_maybe", F.coalesce(F.col("_bits").bitwiseAND(mask) == mask, F.lit(False)))
        )
        return tuple(marked.where(c).select(*df.columns) for c in (F.col("_maybe"), ~F.col("_maybe")))


def _places(keys: Sequence[str], n_words: int) -> tuple[Column, Column]:
    """The word of a key and its bits there; the word is NULL if a part of the key is."""
    h = F.xxhash64(*[F.col(k) for k in keys])
    one = lambda shift: F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64({names}), {shift}) & 63 as int))")
    names = ", ".join(f"`{k}`" for k in keys)
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    word = F.when(whole, F.pmod(F.shiftrightunsigned(h, 18), F.lit(n_words)))
    return word, one(0).bitwiseOR(one(6)).bitwiseOR(one(12))


def key_filter(updates: DataFrame, keys: Sequence[str], rows: int, max_bytes: int) -> KeyFilter | None:
    """A filter of the keys of `updates` (at most `rows`), or None if it would not fit `max_bytes`."""
    most = max_bytes // WORD_BYTES
    n_words = min(max(1, rows * BITS_PER_KEY // 64), most)
    if n_words < 1 or n_words * 64 < rows * LEAST_BITS_PER_KEY:
        return None
    word, mask = _places(keys, n_words)
    words = updates.select(word.alias("_word"), mask.alias("_mask")).where("_word IS NOT NULL")
    return KeyFilter(words.groupBy("_word").agg(F.bit_or("_mask").alias("_bits")), n_words, tuple(keys))
