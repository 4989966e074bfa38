"""Repeated spans of consecutive sentences.

Method: from every sentence the run of exactly `min_sentences` sentences is hashed (128 bits). A longer repeated run is the union of
such runs, and none of them is a first occurrence unless the longer run is one, so its sentences are found whole, tails included. Runs
are counted over the corpus with their first occurrence, by document and position; joined back, every run that is not the first
one is a repeated span, and the sentences that such a span covers are removed. Counts and first occurrences are combined before
the shuffle; the join is a plain one whose hot keys Spark splits at run time.

Cases: sentences end at `.`, `!` or `?` before white space, or at a line break; words are lower-cased (A-Z) and separated by
[\\x20\\x09-\\x0D]; texts with fewer sentences have no run; runs may be short, no number of words is asked for; a null text is empty; rows of equal id and text are one document; a null
id counts as 0 in the order and is returned as null; a very long text is split whole in one task, where its runs are made one after the other; other columns play no part; an empty
table gives an empty result.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablescout.llm.common import arrow_map, keyed
from tablescout.session import cut_lineage

MIN_SENTENCES = 2
BREAK = re.compile(rb"(?<=[.!?])[\x20\x09-\x0d]+|\n+")


def sentence_spans(text: bytes) -> list[bytes]:
    return [s for s in BREAK.split(text) if s.strip()]


def runs(text: bytes, min_sentences: int) -> list[bytes]:
    """Content of the run of `min_sentences` sentences that starts at each sentence, as far as there are so many."""
    flat = [b" ".join(s.lower().split()) for s in sentence_spans(text)]
    return [b" ".join(flat[i:i + min_sentences]) for i in range(len(flat) - min_sentences + 1)]


def repeated_spans(docs: DataFrame, min_sentences: int = MIN_SENTENCES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_i, _h, doc_id, first, last, first_doc_id) of each repeated span, sentences counted from 0."""
    def kernel(batch: pa.RecordBatch) -> pa.Table:
        import struct
        from xxhash import xxh3_128_digest
        at, where, data = [], [], []
        for row, text in enumerate(batch.column(2)):
            for first, content in enumerate(runs(text.as_py(), min_sentences)):
                at.append(row)
                where.append(first)
                data.append(xxh3_128_digest(content))
        pairs = list(struct.iter_unpack("<qq", b"".join(data)))
        keys = [pa.array([p[c] for p in pairs], pa.int64()) for c in (0, 1)]
        at = pa.array(at, pa.int32())
        return pa.Table.from_arrays([*keys, *[batch.column(c).take(at) for c in (0, 1, 3)], pa.array(where, pa.int32())], names=["k1", "k2", "_i", "_h", "d", "at"])

    d = keyed(docs, id_col, text_col).select("_i", "_h", F.col("_t").cast("binary").alias("t"), F.col(f"_row.`{id_col}`").cast("long").alias("d"))
    r = arrow_map(d, kernel, "k1 long, k2 long, _i long, _h long, d long, at int")
    # equal runs of one document of equal rows are one: distinct places are counted by the first and the last of them
    place = F.struct("_i", "_h", "at", "d")
    often = r.groupBy("k1", "k2").agg(F.min(place).alias("low"), F.max(place).alias("high")).filter("low < high")
    # written first: Spark splits hot keys of a join only if both sides come straight from a shuffle
    often = cut_lineage(often.select("k1", "k2", "low"))
    found = r.join(often, ["k1", "k2"]).filter(place > F.col("low"))
    return found.select("_i", "_h", F.col("d").alias("doc_id"), F.col("at").alias("first"), (F.col("at") + (min_sentences - 1)).alias("last"),
                        F.col("low.d").alias("first_doc_id"), F.col("low._i").alias("first_i"))


def removed_sentences(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_spans, removed, first_doc_ids): sentences removed from each document that loses any, and where they stand first."""
    s = repeated_spans(docs, **options).distinct()
    g = s.groupBy("_i", "_h", "doc_id").agg(F.count_distinct("first").alias("n_spans"), F.array_sort(F.array_distinct(F.flatten(
        F.collect_list(F.sequence("first", "last"))))).alias("removed"), F.array_sort(F.collect_set(F.struct("first_i", "first_doc_id"))["first_doc_id"]).alias("first_doc_ids"))
    return g.select("doc_id", "n_spans", F.size("removed").alias("n_removed"), "removed", "first_doc_ids")
