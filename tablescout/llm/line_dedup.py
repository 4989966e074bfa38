"""Lines that many documents share.

Method: the hash of every line is range-partitioned together with its document, rows are sorted by position within, and
the first occurrence in each document streams through. What is kept comes back as one run-length coded bitmap for each
document; texts are never shuffled for the search, only once to apply the bitmaps.

Cases: a null or empty text is one empty line; lines without a visible character have no key and stay; rows of equal id and
text are one document, each of them is returned; a null id is a document of its own; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tablescout.llm.common import BLANKS, ascii_lower, keyed, unpack


def dropped_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
                 min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """(_i, _h, runs): runs of dropped lines, as (first, last) from 0; documents that keep all lines have no row.

    A key is dropped from `min_docs` documents on; with `keep_first` its first line of all, by document and position, stays.
    """
    k = keyed(docs, id_col, text_col)
    line = k.select("_i", "_h", F.posexplode(F.split("_t", "\n")).alias("pos", "line"))
    line = line.withColumn("key", ascii_lower(F.btrim("line", F.lit(BLANKS)))).filter(F.length("key") >= max(min_chars, 1))
    line = line.select(F.unhex(F.md5("key")).alias("key"), "_i", "_h", "pos")
    # ranges over (key, document): a key of very many documents spreads over tasks, a document's lines of it stay together
    ranged = line.repartitionByRange("key", "_i", "_h")
    streamed = ranged.withColumn("nth", F.row_number().over(Window.partitionBy("key", "_i", "_h").orderBy("pos")))
    often = streamed.groupBy("key").agg(F.count(F.when(F.col("nth") == 1, 1)).alias("n_docs"),
                                        F.min(F.struct("_i", "_h", "pos")).alias("first")).filter(F.col("n_docs") >= min_docs)
    gone = streamed.join(often.select("key", "first"), "key")
    if keep_first:
        gone = gone.filter(F.struct("_i", "_h", "pos") > F.col("first"))
    listed = gone.groupBy("_i", "_h").agg(F.array_sort(F.array_distinct(F.collect_list("pos"))).alias("p"))
    first = F.filter("p", lambda x, i: (i == 0) | (F.get("p", i - 1) < x - 1))
    last = F.filter("p", lambda x, i: (i == F.size("p") - 1) | (F.get("p", i + 1) > x + 1))
    return listed.select("_i", "_h", F.arrays_zip(first.alias("first"), last.alias("last")).alias("runs"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`_row` (all columns of `docs`), n_lines, n_dropped and kept, the text without the dropped lines."""
    runs = dropped_runs(docs, id_col, text_col, **options)
    d = keyed(docs, id_col, text_col).join(runs, ["_i", "_h"], "left")
    d = d.withColumn("lines", F.split("_t", "\n"))
    # what lies between two dropped runs, before the first and after the last
    start = F.transform("runs", lambda r: r["first"])
    stop = F.transform("runs", lambda r: r["last"])
    begin = F.concat(F.array(F.lit(0)), F.transform(stop, lambda x: x + 1))
    end = F.concat(start, F.array(F.size("lines")))
    kept = F.flatten(F.zip_with(begin, end, lambda b, e: F.slice("lines", b + 1, e - b)))
    gone = F.aggregate("runs", F.lit(0), lambda s, r: s + r["last"] - r["first"] + 1)
    return d.select("_row", F.size("lines").cast("long").alias("n_lines"),
                    F.coalesce(gone, F.lit(0)).cast("long").alias("n_dropped"),
                    F.when(F.col("runs").isNull(), F.col("_t")).otherwise(F.array_join(kept, "\n")).alias("kept"))


def without_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """`docs` with shortened texts; null texts without a dropped line stay null, `n_chars` follows the text."""
    d = drop_repeated_lines(docs, **options)
    text = F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("_row.text"))
    n_chars = F.when(F.col("n_dropped") > 0, F.length("kept")).otherwise(F.col("_row.n_chars")) if "n_chars" in docs.columns else None
    return unpack(d, docs.columns, text=text, **({"n_chars": n_chars.cast(docs.schema["n_chars"].dataType)} if n_chars is not None else {}))
