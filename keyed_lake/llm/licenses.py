"""License notices in documents: MinHash bands over overlapping windows, then exact containment. DataFrame functions only.

A template is a set of T shingles (of five words, or all words if it has fewer). A document is scanned with windows of 2 T
shingles, one every T, so whatever run of T shingles a notice covers lies whole within one window. A window with at least
`share` of a template's shingles has a Jaccard similarity of at least share / (3 - share) with it. Each of `BANDS` bands
holds one minimum hash, so such a window misses all bands with probability (1 - share / (3 - share)) ** BANDS, about 1 in
130,000 at 0.8. Windows that meet a template in a band are decided by the exact share of its shingles that they contain.

Before that, texts and windows without any anchor are left out, as none can hold a notice: anchors are pieces of words
such that every template without its shingles that hold an anchor has fewer than `share` of its shingles left. A test
proves it for the templates below; with other templates all windows are looked at.

Templates are a fixed list, so their bands are a broadcast of fixed size. Texts are lower-cased and split into runs of
letters and digits. Null and empty texts hold nothing. Rows equal in key and text give one result each license. An empty
table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, written

SHINGLE, SHARE, BANDS = 5, 0.8, 38

#: Names and notices of common licenses, fixed values.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that",
    "bsd-3-clause": "Licensed under the BSD 3-Clause License.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "mit": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
#: Pieces of words; every template is lost without the shingles that hold one.
ANCHORS = ["licens", "reserved", "redistribut", "copyright", "permi", "software"]


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(words_column: Column, size: int) -> Column:
    """Hashes of all runs of `size` words, in order; empty if there are fewer words."""
    count = F.size(words_column) - (size - 1)
    run = lambda i: F.xxhash64(F.array_join(F.slice(words_column, i, size), " "))
    return F.when(count > 0, F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), run)).otherwise(
        F.array().cast("array<bigint>")
    )


def bands(hashes: Column) -> Column:
    """The minimum of the hashes under each of BANDS permutations (exclusive or with a constant) and its band."""
    masks = [(k * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64 for k in range(1, BANDS + 1)]
    signed = [m - 2**64 if m >= 2**63 else m for m in masks]

    def least(mask: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: h.bitwiseXOR(F.lit(mask))))

    return F.array(*[F.struct(F.lit(k).alias("band"), least(m).alias("least")) for k, m in enumerate(signed)])


def templates(spark: SparkSession, known: dict[str, str] = TEMPLATES) -> list[tuple[int, int, DataFrame]]:
    """(shingle size, T, rows of license and shingles) for each kind of template."""
    rows = [(name, " ".join(template_words(text)), len(template_words(text))) for name, text in sorted(known.items())]
    kinds: dict[tuple[int, int], list[tuple[str, str]]] = {}
    for name, text, n in rows:
        size = min(SHINGLE, n)
        kinds.setdefault((size, n - size + 1), []).append((name, text))
    out = []
    for (size, count), group in sorted(kinds.items()):
        table = spark.createDataFrame(group, "license string, text string")
        table = table.select("license", F.array_distinct(shingles(F.split("text", " "), size)).alias("template"))
        out.append((size, count, table))
    return out


def holds_anchor(text: Column) -> Column:
    out = F.lit(False)
    for a in ANCHORS:
        out = out | text.contains(a)
    return out


def _around(place: Column, size: int, count: int) -> Column:
    """Where the windows begin that have the word of a place: of all places 1 + k * count."""
    low = F.greatest(F.ceil((place - (2 * count + size - 1)) / count), F.lit(0)).cast("int")
    high = F.least(F.floor((place - 1) / count), F.floor((F.col("last") - 1) / count)).cast("int")
    return F.when(low <= high, F.transform(F.sequence(low, F.greatest(low, high)), lambda k: k * count + 1)).otherwise(
        F.array().cast("array<int>")
    )


def license_report(df: DataFrame, key: str, text: str, known: dict[str, str] = TEMPLATES, share: float = SHARE) -> DataFrame:
    """doc_id, license, share, begin_shingle of every license a document holds: the best window's share, the first such."""
    spark = df.sparkSession
    docs = df.select(col(key).alias("doc_id"), col(text).cast("string").alias("text")).where("text is not null")
    anchored = known is TEMPLATES
    if anchored:
        docs = docs.where(holds_anchor(F.lower("text")))
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("words"))
    if anchored:
        at = F.transform("words", lambda w, i: F.when(holds_anchor(w), i + 1))
        docs = docs.withColumn("anchors", F.filter(at, lambda i: i.isNotNull()))
    docs = written(docs, "licensed-words")
    found = None
    for size, count, table in templates(spark, known):
        last = F.greatest(F.size("words") - (size - 1) - count, F.lit(1))  # where the last window begins
        rows = docs.where(F.size("words") >= size).withColumn("all", shingles(F.col("words"), size)).withColumn("last", last)
        starts = F.sequence(F.lit(1), F.col("last"), F.lit(count))
        if anchored:
            starts = F.array_distinct(F.flatten(F.transform("anchors", lambda p: _around(p, size, count))))  # noqa: B023
        windows = rows.select("doc_id", "text_hash", "all", F.explode(starts).alias("begin"))
        windows = windows.select("doc_id", "text_hash", "begin", F.slice("all", F.col("begin"), 2 * count).alias("window"))
        keys = windows.select("*", F.explode(bands(F.col("window"))).alias("key"))
        asked = table.select("license", "template", F.explode(bands(F.col("template"))).alias("tkey"))
        meet = keys.join(F.broadcast(asked), F.col("key") == F.col("tkey"))  # BANDS rows a template
        # the exact share is the same in every band that meets, so repeats need no removal before it
        exact = F.size(F.array_intersect("window", "template")) / F.size("template")
        hits = meet.select("doc_id", "text_hash", "license", "begin", exact.alias("share")).where(F.col("share") >= share)
        found = hits if found is None else found.unionByName(hits)
    best = found.groupBy("doc_id", "text_hash", "license").agg(F.max(F.struct("share", -F.col("begin"))).alias("best"))
    return best.select(
        "doc_id", "license", F.col("best.share").alias("share"), (-F.col("best.col2") - 1).cast("long").alias("begin_shingle")
    )
