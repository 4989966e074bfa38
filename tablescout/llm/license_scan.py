"""License notices in documents.

Method: words are cut into overlapping windows, twice as long as the templates of a size class and half a window apart, so every
occurrence lies whole in some window. MinHash bands of the windows' five-word shingles meet those of the templates; the number of
bands follows from the least similarity that a match can have, so that a match is retrieved with probability TARGET at
least. A retrieved pair is verified by the exact share of the template's shingles in the window. Expressions and joins only.

Windows without any shingle of a template cannot share a MinHash value and are left out before they are signed; likewise documents
without one of the words that cover all template shingles. Templates are a bounded list of the caller (MAX_TEMPLATES at most).

Cases: words are runs of [a-z0-9] after lower-casing; templates under five words are refused; a null or empty text has no match; rows of equal id
are scanned one by one, equal matches once; other columns play no part; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablescout.llm.common import keyed
from tablescout.session import cut_lineage

WIDTH, TARGET, SEED_BASE, MAX_TEMPLATES = 5, 0.999, 1000, 2000

# Short notices by which texts name their licence.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


def words_of(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def shingles_of(text: str) -> list[str]:
    w = words_of(text)
    return sorted({" ".join(w[i:i + WIDTH]) for i in range(len(w) - WIDTH + 1)})


def size_class(n_words: int) -> int:
    return max(8, 1 << (n_words - 1).bit_length())


def bands(length: int, templates: list[tuple[str, str]], share: float) -> int:
    """Bands of one MinHash value with which the least similar match of a class is retrieved with probability TARGET."""
    least = min(m / (2 * length - WIDTH + 1 + t - m) for t in (len(shingles_of(x)) for _, x in templates) for m in [math.ceil(share * t - 1e-9)])
    return math.ceil(math.log(1 - TARGET) / math.log(1 - least))


def cover(templates: list[tuple[str, str]]) -> list[str]:
    """Words of which each template shingle holds one, long ones first."""
    left, chosen = {s for _, t in templates for s in shingles_of(t)}, []
    while left:
        count: dict[str, int] = {}
        for s in left:
            for w in set(s.split()):
                count[w] = count.get(w, 0) + 1
        best = max(count, key=lambda w: (count[w] * max(0, len(w) - 3), len(w), w))
        chosen.append(best)
        left = {s for s in left if best not in s.split()}
    return chosen


def shingle_hashes(words: Column) -> Column:
    n = F.size(words) - WIDTH + 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(F.array_join(F.slice(words, i + 1, WIDTH), " ")))).otherwise(F.array().cast("array<bigint>"))


def signature(hashes: Column, n_bands: int) -> Column:
    return F.transform(F.sequence(F.lit(SEED_BASE), F.lit(SEED_BASE + n_bands - 1)), lambda b: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, b))))


def template_table(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(n).alias("template"), F.lit(name).alias("license"), F.array(*map(F.lit, shingles_of(t))).alias("s")) for n, (name, t) in enumerate(templates)])
    return spark.range(1).select(F.inline(rows)).select("template", "license", F.transform("s", lambda x: F.xxhash64(x)).alias("set"))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = NOTICES, share: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license, containment, n_windows): the best containment of each licence in each document, from `share` on."""
    spark = docs.sparkSession
    if len(templates) > MAX_TEMPLATES or any(len(words_of(t)) < WIDTH for _, t in templates):
        raise ValueError(f"give at most {MAX_TEMPLATES} templates of at least {WIDTH} words")
    d = keyed(docs, id_col, text_col).select("_i", "_h", F.col(f"_row.`{id_col}`").alias("doc_id"), F.lower("_t").alias("t"))
    d = d.filter(reduce(lambda a, b: a | b, [F.contains("t", F.lit(w)) for w in cover(templates)]))
    d = d.select("_i", "_h", "doc_id", F.filter(F.split("t", "[^a-z0-9]+"), lambda x: x != "").alias("words"))
    every = template_table(spark, templates)
    any_known = sorted({h for r in every.select("set").collect() for h in r["set"]})  # of the templates
    # every size class reads the documents with a template's shingle: they are written once; in no other document does a window match
    d = d.select("_i", "_h", "doc_id", F.size("words").alias("n"), shingle_hashes(F.col("words")).alias("hashes"))
    # a filter would be pushed below the hashes and make them once more for each word: other documents lose their array instead
    d = cut_lineage(d.withColumn("hashes", F.when(F.arrays_overlap("hashes", F.array(*map(F.lit, any_known))), F.col("hashes")))).filter("hashes IS NOT NULL")
    parts = []
    for length in sorted({size_class(len(words_of(t))) for _, t in templates}):
        own = [n for n, (_, t) in enumerate(templates) if size_class(len(words_of(t))) == length]
        count = bands(length, [templates[n] for n in own], share)
        table = every.filter(F.col("template").isin(own))
        known = sorted({h for r in table.select("set").collect() for h in r["set"]})  # of the templates
        w = d.select("_i", "_h", "doc_id", "hashes", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.expr(f"(n - {length} - 1) div {length}").cast("int")))).alias("k"))
        w = w.select("_i", "_h", "doc_id", "k", F.array_distinct(F.slice("hashes", F.col("k") * length + 1, 2 * length - WIDTH + 1)).alias("win"))
        w = w.filter(F.arrays_overlap("win", F.array(*map(F.lit, known))))
        w = w.select("*", F.posexplode(signature(F.col("win"), count)).alias("band", "value"))
        t = table.select("template", "license", "set", F.posexplode(signature(F.col("set"), count)).alias("band", "value"))
        met = w.join(F.broadcast(t), ["band", "value"])  # at most MAX_TEMPLATES times the bands
        met = met.select("_i", "_h", "doc_id", "k", "license", "template", (F.size(F.array_intersect("win", "set")) / F.size("set")).alias("containment"))
        parts.append(met.filter(F.col("containment") >= share).withColumn("length", F.lit(length)))
    found = reduce(DataFrame.union, parts)
    return found.groupBy("_i", "_h", "doc_id", "license").agg(F.max("containment").alias("containment"), F.count_distinct("length", "k").alias("n_windows")).drop("_i", "_h")
