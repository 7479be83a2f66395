"""Conversations in reply order, without the quotations in their messages.

A message's lines carry quote levels: `>` marks in front of a line, as in `> > text`. Consecutive lines of one level are
a passage. Quoted passages are normalised (marks, line breaks and runs of blanks become one blank, letters lower case)
and hashed. A message holds a passage if a run of its own consecutive lines, normalised alike, is the passage: one line,
some lines of a paragraph, several paragraphs or all of it, however the quotation is wrapped. Hashes of a message's
beginnings up to every line give the hash of any run; only runs of a length that is quoted in the conversation are
looked up. Within a conversation a quoted passage is joined to the latest earlier message that holds it. A message
answers the message that its outermost linked passage comes from, the latest of several; without a linked passage it
answers the message before it. A passage that is a part of a line, or that leaves out lines between, is not linked.

So the messages of a conversation form a tree. They are numbered along it: a message is followed by its answers' trees,
the uninterrupted course first, then the branches that quotations open, the oldest first. Every message comes after the
one it answers.

Quoted lines and the attribution line before them (`On ... wrote:`) are cut from the text. A null text stays null, and a
message that is all quotation becomes empty. Messages of the same conversation and turn are ordered by role and text;
equal rows are separate messages. Null conversations are one conversation; null turns come first. No step gathers a
conversation, or the copies of a frequent message, in one task. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, map_arrow, written
from .ordered import largest_before, position

MARKS = re.compile(r"^[ \t]*((?:>[ \t]?)+)")
ATTRIBUTION = re.compile(r"^.{0,200}\b(?:wrote|schrieb|écrit|a écrit|escribió)\s*:\s*$", re.I)
BLANKS = re.compile(r"\s+")
SHORTEST = 3  # letters and digits that a passage needs to be linked
#: A passage's bytes are the digits of a number; the hash is its remainder, mixed with the number of bytes.
PRIME, SIZE_FACTOR = 7259244897466041101, 0x9E3779B97F4A7C15
BLOCK = 64  # messages of a conversation that are joined to its quoted lengths at a time


def level(line: str) -> tuple[int, str]:
    m = MARKS.match(line)
    return (m[1].count(">"), line[m.end() :]) if m else (0, line)


def normalised(text: str) -> bytes:
    return BLANKS.sub(" ", text).strip().lower().encode("utf-8", "surrogatepass")


@lru_cache(100_000)
def shift(size: int) -> int:
    return pow(256, size, PRIME)


def passage_hash(text: str) -> int | None:
    """63 bits of a normalised passage; None for one with hardly a letter."""
    plain = normalised(text)
    if sum(c.isalnum() for c in plain.decode("utf-8", "surrogatepass")) < SHORTEST:
        return None
    return (int.from_bytes(plain, "big") + len(plain) * SIZE_FACTOR) % PRIME


def line_ends(own: str | None) -> tuple[list[int], list[int]]:
    """Where the lines of a normalised text end, blank ones left out, and the remainders of the text up to there."""
    ends, values, end, value = [], [], -1, 0
    for line in (own or "").split("\n"):
        plain = normalised(line)
        if plain:
            if ends:
                value = value * 256 + 32
            value = (value * shift(len(plain)) + int.from_bytes(plain, "big")) % PRIME
            end += len(plain) + 1
            ends.append(end)
            values.append(value)
    return ends, values


def run_hashes(ends: np.ndarray, values: list[int], sizes: np.ndarray) -> set[int]:
    """What `passage_hash` gives for every run of lines that has one of the sizes (sorted)."""
    starts = np.concatenate(([0], ends[:-1] + 1))
    found: set[int] = set()
    few = len(sizes) < len(ends)
    rows = max(1, 1_000_000 // max(1, min(len(sizes), len(ends))))  # lines at a time, to bound memory
    for at in range(0, len(starts), rows):
        part = starts[at : at + rows, None]
        if few:
            wanted = part + sizes
            last = np.searchsorted(ends, wanted)
            first, k = np.nonzero(ends[np.minimum(last, len(ends) - 1)] == wanted)
            last = last[first, k]
        else:
            first, last = np.nonzero(np.isin(ends - part, sizes))
        for i, j in zip((first + at).tolist(), last.tolist()):
            size = int(ends[j] - starts[i])
            before = (values[i - 1] * 256 + 32) * shift(size) if i else 0
            found.add((values[j] - before + size * SIZE_FACTOR) % PRIME)
    return found


def cut_blank_lines(lines: list[str]) -> None:
    while lines and not lines[-1].strip():
        lines.pop()


def split_quotes(text: str) -> tuple[str, list[tuple[int, str]]]:
    """A message without quotations; its quoted passages as (level, text)."""
    kept: list[str] = []
    quoted: list[tuple[int, list[str]]] = []
    last = 0
    for line in text.split("\n"):
        k, rest = level(line)
        if k == 0:
            kept.append(line)
        elif k == last:
            quoted[-1][1].append(rest)
        else:
            quoted.append((k, [rest]))
        if k and not last:
            cut_blank_lines(kept)
            if kept and ATTRIBUTION.match(kept[-1]):
                kept.pop()
                cut_blank_lines(kept)
        last = k
    own = "\n".join(kept).strip() if quoted else text
    return own, [(k, "\n".join(lines)) for k, lines in quoted]


def parse(text: str | None) -> tuple[str | None, list[tuple[int, int]], list[int]]:
    """A message without quotations; its quoted passages as (level, hash); the hashes of it, its paragraphs and lines."""
    if text is None:
        return None, [], []
    own, quoted = split_quotes(text)
    passages = [(k, h) for k, q in quoted if (h := passage_hash(q)) is not None]
    parts = {own, *re.split(r"\n\s*\n", own), *own.split("\n")}
    return own, passages, sorted({h for p in parts if (h := passage_hash(p)) is not None})


PASSAGE = T.StructType([T.StructField("level", T.IntegerType()), T.StructField("hash", T.LongType()), T.StructField("size", T.LongType())])


def _parsed(schema: T.StructType):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("level", pa.int32()), ("hash", pa.int64()), ("size", pa.int64())])
        for batch in batches:
            found = [(None, []) if t is None else split_quotes(t) for t in batch.column("text").to_pylist()]
            columns = [batch.column(k) for k in range(batch.num_columns - 1)]
            quoted = [
                [{"level": k, "hash": h, "size": len(normalised(q))} for k, q in passages if (h := passage_hash(q)) is not None]
                for _, passages in found
            ]
            lines = [line_ends(own) for own, _ in found]
            more = [
                pa.array([own for own, _ in found], pa.string()), pa.array(quoted, pa.list_(kind)),
                pa.array([e for e, _ in lines], pa.list_(pa.int64())), pa.array([v for _, v in lines], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([*columns, *more], schema.names)

    return rows


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """row, hash of the runs of lines. Columns: row, ends, values, sizes."""
    for batch in batches:
        rows, hashes = [], []
        for row, ends, values, sizes in zip(batch.column(0).to_pylist(), *batch.columns[1:]):
            new = run_hashes(np.asarray(ends.values), values.as_py(), np.asarray(sizes.values))
            rows += [row] * len(new)
            hashes += new
            if len(rows) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(hashes, pa.int64())], ["row", "hash"])
                rows, hashes = [], []
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(hashes, pa.int64())], ["row", "hash"])


def reply_order(df: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """conv_id, turn, role, text, n_quoted, n_linked, parent_turn, nesting, position of every message."""
    source = df.select(
        col(conversation).alias("conv_id"), col(turn).cast("long").alias("turn"), col(role).alias("role"), col(text).cast("string").alias("text"),
    ).withColumn("tie", F.xxhash64("role", "text")).select("conv_id", "turn", "role", "tie", "text")
    schema = T.StructType(
        [
            *source.schema.fields, T.StructField("quoted", T.ArrayType(PASSAGE)),
            T.StructField("ends", T.ArrayType(T.LongType())), T.StructField("values", T.ArrayType(T.LongType())),
        ]
    )
    parsed = map_arrow(source, _parsed(schema), schema).withColumn("row", F.monotonically_increasing_id())
    stored = written(parsed, "messages")
    # messages are known by their place in the conversation; their texts stay behind until the end
    order = [F.col("turn"), F.col("tie"), F.col("row")]
    light = position(stored.select("conv_id", "turn", "tie", "row"), ["conv_id"], order, "at")
    messages = written(light.drop("tie"), "placed-messages")

    # every quoted passage looks for the latest earlier message that holds it
    places = messages.select("row", "conv_id", "at")
    asked = stored.where(F.size("quoted") > 0).select("row", F.explode("quoted").alias("q"))
    asked = asked.join(places, "row").select("conv_id", "at", F.col("q.hash").alias("hash"), F.col("q.level").alias("level"), F.col("q.size").alias("size"))
    asked = written(asked, "quoted-passages")
    wanted = written(asked.select(F.col("hash").alias("h")).distinct(), "quoted-hashes")
    # the lengths quoted in a conversation, once for every BLOCK of its messages up to the last that quotes
    sizes = asked.groupBy("conv_id").agg(F.sort_array(F.collect_set("size")).alias("sizes"), F.max("at").alias("end"))
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("end") / BLOCK)))
    sizes = written(sizes.select("conv_id", "sizes", blocks.alias("block")), "quoted-sizes")
    near = _join(places.withColumn("block", F.floor(F.col("at") / BLOCK)), sizes.select("conv_id", "block"), ["conv_id", "block"], "inner")
    lines = stored.where(F.size("ends") > 0).select("row", "ends", "values").join(near, "row")
    lines = _join(lines, sizes, ["conv_id", "block"], "inner").select("row", "ends", "values", "sizes")
    own = map_arrow(lines, _runs, "row long, hash long")
    own = own.join(wanted, F.col("hash") == F.col("h"), "left_semi").join(places, "row")
    own = own.select("conv_id", "at", "hash", F.lit(None).cast("int").alias("level"))
    both = own.unionByName(asked.drop("size")).withColumn("source", F.when(F.col("level").isNull(), F.col("at")))
    # at one place the question comes first, so that no message answers itself
    found = largest_before(both, ["conv_id", "hash"], [F.col("at"), F.col("level").asc_nulls_last()], "source", "origin")
    found = found.where("level is not null and origin is not null and origin < at")
    links = found.groupBy("conv_id", "at").agg(F.max(F.struct(-F.col("level"), F.col("origin"))).alias("best"), F.count("*").alias("n_linked"))
    links = written(links.select("conv_id", "at", F.col("best.origin").alias("origin"), "n_linked"), "quote-links")

    # a link to another than the last message opens a branch, which runs to the next one
    opened = links.where("origin < at - 1").select("conv_id", "at", "origin")
    joined = _join(messages, links, ["conv_id", "at"])
    parent = F.coalesce("origin", F.when(F.col("at") > 0, F.col("at") - 1))
    marked = joined.withColumn("parent", parent).withColumn("head", F.when(F.col("origin") < F.col("at") - 1, F.col("at")))
    runs = largest_before(marked, ["conv_id"], [F.col("at")], "head", "last_head")
    runs = written(runs.withColumn("head", F.coalesce("head", "last_head", F.lit(0).cast("long"))).drop("last_head"), "branches")

    # the way to a branch: (place where it leaves, counted backwards; its first message) for every level above it
    heads = runs.select("conv_id", F.col("at").alias("origin"), F.col("head").alias("above"))
    todo = written(_join(opened, heads, ["conv_id", "origin"]).select("conv_id", F.col("at").alias("head"), "origin", "above"), "open-branches")
    step = F.struct((-F.col("origin")).alias("leaves"), F.col("head").alias("first"))
    ways = written(todo.where("above = 0").select("conv_id", "head", F.array(step).alias("way")), "ways")
    level_ways, rest = ways, todo.where("above > 0")
    while not level_ways.isEmpty():  # a round for each level of branches within branches
        known = level_ways.select("conv_id", F.col("head").alias("above"), F.col("way").alias("upper"))
        level_ways = _join(rest, known, ["conv_id", "above"], "inner")
        level_ways = written(level_ways.select("conv_id", "head", F.concat("upper", F.array(step)).alias("way")), "ways")
        ways = ways.unionByName(level_ways)
    placed = _join(runs, written(ways, "all-ways"), ["conv_id", "head"])
    way = F.coalesce("way", F.array().cast("array<struct<leaves:bigint,first:bigint>>"))
    here = F.struct(F.lit(-(2**62)).alias("leaves"), F.col("at").alias("first"))
    placed = placed.withColumn("nesting", F.size(way)).withColumn("path", F.concat(way, F.array(here)))
    numbered = position(placed.drop("way"), ["conv_id"], [F.col("path")], "position")
    turns = messages.select("conv_id", F.col("at").alias("parent"), F.col("turn").alias("parent_turn"))
    out = _join(numbered, turns, ["conv_id", "parent"]).select("row", "n_linked", "parent_turn", "nesting", "position")
    out = stored.join(out, "row")
    return out.select(
        "conv_id", "turn", "role", "text", F.size("quoted").cast("long").alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "parent_turn", "nesting", "position",
    )


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """A join in which null keys are equal; (conversation, place) is unique, so no key is hot."""
    named = right.select(*[F.col(k).alias(f"_j_{k}") if k in keys else F.col(k) for k in right.columns])
    same = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"_j_{k}"))
        same = one if same is None else same & one
    return left.join(named, same, how).drop(*[f"_j_{k}" for k in keys])
