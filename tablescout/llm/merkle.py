"""Merkle manifest of a table: one tree of three-way runs for each group, one tree over the groups' roots.

Method: the leaves of a group are cut into aligned blocks of BLOCK = 3**DEPTH. A block holds each of its levels as one string of
64-digit hexadecimal hashes; the parents of a level are the hashes of its substrings of 192 digits (the last one may be shorter), and
the siblings of a node are the substrings to its left and right in its run. The tops of the blocks are the leaves of the next tier,
until a group has one block. The roots of the groups are the leaves of one more such tree. On the way down each tier appends the
sibling segments of the tier above it; rows are only unfolded at the end, so no join meets a hot group.

Cases: a null or empty table gives no rows; a null in a column enters its leaf as `-`; a null group is a group of its own and comes
first; a null id comes first in its group and is never tampered with; rows of equal id are ordered by their leaf, rows equal in all
columns keep one leaf each, which are interchangeable; a single leaf is its group's root and a single group's root is the root, both
without another hash. Very long texts are only hashed. Other columns of the table play no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablescout.llm.common import ranked
from tablescout.session import cut_lineage

DEPTH = 5  # levels that a block settles
BLOCK = 3**DEPTH  # leaves of a block
HEX = 64  # digits of a hash
FLANKS = "array<struct<l:string,r:string>>"


def digest(c: Column) -> Column:
    return F.sha2(c, 256)


def field(c: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon, the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    return digest(F.concat(*[field(c) for c in columns]))


def _parents(level: str) -> Column:
    run = 3 * HEX
    last = F.ceil(F.length(level) / run).cast("int") - 1
    return F.array_join(F.transform(F.sequence(F.lit(0), last), lambda j: digest(F.substring(F.col(level), j * run + 1, F.lit(run)))), "")


def _siblings(i: Column) -> Column:
    """(left, right) at each level that the block settles, for its i-th leaf."""
    def at(t: int) -> Column:
        k = (i / 3**t).cast("int")
        place = k % 3
        return F.struct(F.substring(F.col("lv")[t], (k - place) * HEX + 1, place * HEX).alias("l"),
                        F.substring(F.col("lv")[t], (k + 1) * HEX + 1, (2 - place) * HEX).alias("r"))
    return F.slice(F.array(*[at(t) for t in range(DEPTH)]), F.lit(1), F.col("levels"))


def tiers(nodes: DataFrame) -> list[DataFrame]:
    """Blocks tier by tier: (g, b, n, levels, items, lv, top). `nodes`: (g, pos, n, h, item)."""
    out, n = [], nodes.agg(F.max("n")).first()[0] or 0
    while True:
        d = nodes.groupBy("g", (F.col("pos") / BLOCK).cast("long").alias("b")).agg(
            F.sort_array(F.collect_list(F.struct("pos", "h", "item"))).alias("items"), F.max("n").alias("n"))
        settled = sum((F.col("n") > 3**t).cast("int") for t in range(DEPTH))
        d = d.withColumn("levels", settled).withColumn("s0", F.array_join(F.col("items.h"), ""))
        for t in range(DEPTH):
            d = d.withColumn(f"s{t + 1}", F.when(F.col("levels") > t, _parents(f"s{t}")).otherwise(F.col(f"s{t}")))
        d = cut_lineage(d.select("g", "b", "n", "levels", "items", F.array(*[f"s{t}" for t in range(DEPTH)]).alias("lv"), F.col(f"s{DEPTH}").alias("top")))
        out.append(d)
        if n <= BLOCK:
            return out
        n = -(-n // BLOCK)
        nodes = d.select("g", F.col("b").alias("pos"), F.ceil(F.col("n") / BLOCK).cast("long").alias("n"), F.col("top").alias("h"), F.lit(None).cast("string").alias("item"))


def unfold(blocks: list[DataFrame], above: DataFrame) -> DataFrame:
    """One row for each leaf: g, item, h, the columns of `above` (one row for each g), `flanks` from the leaf up to the root."""
    kept = [c for c in above.columns if c not in ("g", "flanks")]
    cur = above.withColumn("b", F.lit(0).cast("long"))
    for d in reversed(blocks):
        own = F.transform("items", lambda x, i: F.struct(x.pos.alias("pos"), x.h.alias("h"), x.item.alias("item"), _siblings(i).alias("own")))
        rows = d.join(cur, ["g", "b"]).select("g", *kept, "flanks", F.explode(own).alias("x"))
        cur = rows.select("g", F.col("x.pos").alias("b"), F.col("x.h").alias("h"), F.col("x.item").alias("item"), *kept, F.concat("x.own", "flanks").alias("flanks"))
        if d is not blocks[0]:
            cur = cur.drop("h", "item")
    return cur.drop("b")


def manifest(docs: DataFrame, columns: list[str], id_col: str = "doc_id", group_col: str = "source", changed: dict[str, Column] | None = None,
             tampered: Column | None = None) -> DataFrame:
    """(id_col, leaf, subroot, root, proof_sha256, folded_root, verified) for each row.

    `columns` enter the leaf in this order. `changed` gives other values of some columns and `tampered` the rows where they apply;
    `folded_root` is what a verifier gets from such a row and the siblings of the original.
    """
    at = lambda c: F.col(f"`{c}`")
    true = leaf([at(c) for c in columns])
    found = true if tampered is None else F.when(tampered, leaf([(changed or {}).get(c, at(c)) for c in columns])).otherwise(true)
    source = at(group_col).cast("string")
    rows = docs.select(F.coalesce(F.concat(F.lit("s"), source), F.lit("")).alias("g"), at(id_col).alias("id"), true.alias("h"), found.alias("found"))
    nodes = ranked(rows, ["g"], [F.col("id").asc_nulls_first(), F.col("h")])
    trees = tiers(nodes.select("g", "pos", "n", "h", F.struct("id", "found").alias("item")))
    subroots = ranked(trees[-1].select(F.lit("").alias("all"), "g", F.col("top").alias("h")), ["all"], [F.col("g")])
    crown = tiers(subroots.select(F.col("all").alias("g"), "pos", "n", "h", F.col("g").alias("item")))
    groups = unfold(crown, crown[-1].select("g", F.col("top").alias("root"), F.array().cast(FLANKS).alias("flanks")))
    groups = groups.select(F.col("item").alias("g"), F.col("h").alias("subroot"), "root", "flanks")
    d = unfold(trees, groups)
    segments = F.array_join(F.transform("flanks", lambda f: F.concat(f.l, f.r)), "")
    folded = F.aggregate("flanks", F.col("item.found"), lambda acc, f: digest(F.concat(f.l, acc, f.r)))
    d = d.select(F.col("item.id").alias(id_col), F.col("h").alias("leaf"), "subroot", "root", digest(segments).alias("proof_sha256"), folded.alias("folded_root"))
    return d.withColumn("verified", F.col("folded_root") == F.col("root"))
