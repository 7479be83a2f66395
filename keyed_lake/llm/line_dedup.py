"""Lines that many documents share stay in one of them.

Every line is normalised to a key (blanks off both ends, A to Z in lower case) and hashed. Per hash, the different
documents are counted and the smallest is noted. The positions of the lines to drop go back to their document, which is
put together again from the positions that stay.

A line travels as 128 bits of a SHA-256, its document and its place; texts are shuffled once, to meet their positions.
A key that holds more than a `HOT`th of all lines is looked up in a broadcast table, which can't have more than `HOT` rows;
no other key has enough lines to hold up a task. Counting drops repeats of a key within a document, then counts map-side.

Defined results: a null or empty text is one empty line. Short keys never count, so empty lines always stay. Rows with the
same document id are one document. A row without an id is no document: it makes no line repeated and loses none. Lines
that repeat within the smallest document all stay there. A row's own text bounds the positions it gathers, as they
are grouped by id and text; rows that repeat share them. A document that loses all lines has an empty text. An empty
table gives an empty result. Other columns are kept under their own names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, fresh, written

MIN_CHARS = 10
MIN_DOCUMENTS = 2
HOT = 1_000
_BLANKS = " \t\n\x0b\x0c\r"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_BLANKS)), _CAPITALS, _CAPITALS.lower())


def _whole(text: str) -> Column:
    return F.coalesce(col(text).cast("string"), F.lit(""))


def _digest(text: Column) -> Column:
    """128 bits of a SHA-256."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def line_hashes(df: DataFrame, key: str, text: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, digest (of the whole text), pos, line (hash of the key) of every line with a key that is long enough."""
    lines = df.where(col(key).isNotNull()).select(
        col(key).alias("doc_id"), _digest(_whole(text)).alias("digest"), F.posexplode(F.split(_whole(text), "\n")).alias("pos", "text")
    )
    keys = lines.select("doc_id", "digest", "pos", line_key(F.col("text")).alias("line"))
    return keys.where(F.char_length("line") >= min_chars).withColumn("line", _digest(F.col("line")))


def repeated_lines(lines: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """line, first (its smallest document), documents, n (lines) of the keys found in enough documents."""
    counted = lines.groupBy("line").agg(
        F.count_distinct("doc_id").alias("documents"), F.min("doc_id").alias("first"), F.count("*").alias("n")
    )
    return counted.where(F.col("documents") >= min_documents)


def dropped_positions(lines: DataFrame, repeated: DataFrame) -> DataFrame:
    """doc_id, digest, gone (an array of positions) of the documents that lose a line. Both tables must be stored."""
    least = lines.count() / HOT
    hot = repeated.where(F.col("n") > least).select("line", "first")
    rest = repeated.where(F.col("n") <= least).select("line", "first")
    found = lines.join(F.broadcast(hot), "line").unionByName(
        lines.join(F.broadcast(hot), "line", "left_anti").join(rest, "line")
    )
    return found.where("doc_id <> first").groupBy("doc_id", "digest").agg(F.collect_set("pos").alias("gone"))


def dedup_lines(
    df: DataFrame, key: str, text: str, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS,
    kept: str = "kept_text", before: str = "n_lines", dropped: str = "n_dropped",
) -> DataFrame:
    """All rows and columns, and the text that stays, its lines before, and those dropped.

    New names that are taken get underscores in front.
    """
    lines = written(line_hashes(df, key, text, min_chars), "line-hashes")
    gone = dropped_positions(lines, written(repeated_lines(lines, min_documents), "repeated-lines"))
    taken = list(df.columns)
    names = []
    for name in (kept, before, dropped, "digest", "gone", "lines", "gone_id"):
        names.append(fresh(name, [*taken, *names]))
    kept, before, dropped, digest, places, parts, owner = names
    gone = gone.select(F.col("doc_id").alias(owner), F.col("digest").alias(f"{digest}_"), F.col("gone").alias(places))
    same = (col(key) == F.col(owner)) & (F.col(digest) == F.col(f"{digest}_"))
    rows = df.withColumn(digest, _digest(_whole(text))).join(gone, same, "left").withColumn(parts, F.split(_whole(text), "\n"))
    n = F.size(parts)
    stay = F.array_except(F.sequence(F.lit(0), n - 1), F.col(places))
    joined = F.array_join(F.transform(stay, lambda i: F.get(F.col(parts), i)), "\n")
    return rows.select(
        *[col(c) for c in df.columns],
        F.when(F.col(places).isNull(), _whole(text)).otherwise(joined).alias(kept),
        n.cast("long").alias(before),
        F.coalesce(F.size(places), F.lit(0)).cast("long").alias(dropped),
    )
