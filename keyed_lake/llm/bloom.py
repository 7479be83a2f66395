"""Bloom filters as rows of 64-bit words, made and asked with DataFrame functions.

A filter never has more than `MAX_BITS` cells, so its words are at most `MAX_BITS / 64` rows of 16 bytes: that is the bound
of its broadcast. More rows than it was made for only mean more false positives.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, fresh, written

CELLS_PER_ROW = 16
MAX_BITS = 1 << 28


@dataclass(frozen=True)
class Filter:
    """The cells that are set, as rows (word, bits)."""

    words: DataFrame
    bits: int

    def flag(self, df: DataFrame, name: str, hashed: Column) -> DataFrame:
        """Adds a boolean: false only if the hash is surely not in the filter."""
        taken = [*df.columns, name]
        found = []
        out = df
        for i, cell in enumerate(cells(hashed, self.bits)):
            word, bits, place = (fresh(f"_{x}{i}", taken) for x in ("word", "bits", "place"))
            side = F.broadcast(self.words.select(col("word").alias(word), col("bits").alias(bits)))
            out = out.withColumn(place, cell).join(side, F.shiftright(F.col(place), 6) == F.col(word), "left")
            found.append((place, bits, word))
        hit = [F.coalesce(F.getbit(F.col(b), (F.col(p) % 64).cast("int")), F.lit(0)) == 1 for p, b, _ in found]
        return out.withColumn(name, hit[0] & hit[1]).drop(*[c for three in found for c in three])


def cells(hashed: Column, bits: int) -> list[Column]:
    """Two cells of a hash, from both halves of 64 bits."""
    h = F.xxhash64(hashed)
    return [h.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1))]


def filter_bits(rows: int, max_bits: int = MAX_BITS) -> int:
    """A power of two with `CELLS_PER_ROW` cells a row, 2**10 to `max_bits`."""
    return min(max_bits, 1 << max(10, (CELLS_PER_ROW * max(rows, 1) - 1).bit_length()))


def build(hashes: DataFrame, hashed: str, rows: int, least: int = 1, max_bits: int = MAX_BITS) -> Filter:
    """A filter of the cells that at least `least` rows set.

    Cells are counted before they are shuffled, so a hash with a third of all rows costs a row per task.
    """
    bits = filter_bits(rows, max_bits)
    cell = hashes.select(F.explode(F.array(*cells(col(hashed), bits))).alias("cell"))
    kept = cell.groupBy("cell").count().where(F.col("count") >= least)
    words = kept.groupBy(F.shiftright("cell", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(cell % 64 as int))")).alias("bits")
    )
    return Filter(written(words, "filter-words"), bits)
