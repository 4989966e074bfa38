"""Clusterings of a sparse similarity graph: affinity propagation and average linkage.

A graph is its undirected edges (a, b, sim); a pair without an edge has similarity 0 in average linkage and is no candidate in
affinity propagation. Every round is a fixed number of grouped aggregates and equi-joins over the edges, whose state is one row an
edge; nothing but one-row totals reaches the driver. Each round writes its state to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablescout.operators.grouping import attach, best_row
from tablescout.operators.splits import hash32
from tablescout.session import Rounds, cut_lineage

JITTER = 1e-7  # height of the fixed noise that tells equal similarities apart
SWEEP = (0.5, 0.7, 0.9)  # quantiles of the similarities tried as preference


def jitter(i: Column, k: Column) -> Column:
    """A number of the ordered pair in [0, JITTER)."""
    return hash32(F.concat_ws("|", i, k)) / F.lit(2.0**32) * F.lit(JITTER)


def preferences(edges: DataFrame, sweep: tuple[float, ...] = SWEEP) -> DataFrame:
    """(q, preference): quantiles of the similarities, taken at six digits so that the state of the aggregate is bounded."""
    at = F.percentile(F.round("sim", 6), F.array(*[F.lit(q) for q in sweep]))
    return edges.agg(F.arrays_zip(F.array(*[F.lit(q) for q in sweep]).alias("q"), at.alias("preference")).alias("z")).select(F.inline("z")).toDF("q", "preference")


def _messages(edges: DataFrame, sweep: tuple[float, ...]) -> DataFrame:
    """(q, i, k, s, r, a): both directions of each edge and a loop with the preference on each node, for each preference."""
    both = edges.select(F.col("a").alias("i"), F.col("b").alias("k"), "sim").union(edges.select("b", "a", "sim"))
    loops = both.select("i").distinct().select("i", F.col("i").alias("k"))
    pref = attach(loops, preferences(edges, sweep).agg(F.sort_array(F.collect_list(F.struct("q", "preference"))).alias("p")))
    pref = pref.select(F.inline("p"), "i", "k").select("q", "i", "k", F.col("preference").alias("sim"))
    links = both.select(F.explode(F.array(*[F.lit(q) for q in sweep])).alias("q"), "i", "k", "sim")
    return links.unionByName(pref).select("q", "i", "k", (F.col("sim") + jitter(F.col("i"), F.col("k"))).alias("s"), F.lit(0.0).alias("r"), F.lit(0.0).alias("a"))


def _round(m: DataFrame, damping: float) -> DataFrame:
    """One exchange of responsibilities and availabilities."""
    old, new = F.lit(damping), F.lit(1 - damping)
    v = F.col("a") + F.col("s")
    high = m.groupBy("q", "i").agg(F.max(v).alias("high"))
    seen = m.join(high, ["q", "i"])
    rows = seen.groupBy("q", "i").agg(F.max("high").alias("high"), F.sum((v == F.col("high")).cast("int")).alias("ties"), F.max(F.when(v < F.col("high"), v)).alias("next"))
    rival = F.when((v == F.col("high")) & (F.col("ties") == 1), F.col("next")).otherwise(F.col("high"))
    m = m.join(rows, ["q", "i"]).select("q", "i", "k", "s", (old * F.col("r") + new * (F.col("s") - rival)).alias("r"), "a")
    # a column's sum runs in an order that Spark chooses: rounding keeps the last digits from steering a tie
    good = F.when(F.col("i") != F.col("k"), F.greatest("r", F.lit(0.0))).otherwise(0.0)
    cols = m.groupBy("q", "k").agg(F.round(F.sum(good), 12).alias("support"), F.max(F.when(F.col("i") == F.col("k"), F.col("r"))).alias("own"))
    fresh = F.when(F.col("i") == F.col("k"), F.col("support")).otherwise(F.least(F.lit(0.0), F.col("own") + F.col("support") - F.greatest("r", F.lit(0.0))))
    return m.join(cols, ["q", "k"]).select("q", "i", "k", "s", "r", (old * F.col("a") + new * fresh).alias("a"))


def _nearest(m: DataFrame, exemplars: DataFrame) -> DataFrame:
    """(q, i, k): the most similar exemplar of each node that has one next to it; an exemplar takes itself."""
    near = m.join(exemplars, ["q", "k"]).withColumn("o", F.when(F.col("i") == F.col("k"), F.lit(float("-inf"))).otherwise(-F.col("s")))
    return best_row(near, ["q", "i"], ["o", "k"], ["k"])


def affinity_propagation(nodes: DataFrame, edges: DataFrame, node: str, sweep: tuple[float, ...] = SWEEP, damping: float = 0.5, rounds: int = 200, patience: int | None = 15) -> DataFrame:
    """(q, node, exemplar) for each preference quantile q.

    Rounds end when the exemplars of all preferences have stayed the same for `patience` rounds, or after `rounds`. As in the usual
    formulation the centre of each cluster is then moved to the member with the largest sum of similarities (preference included) and
    the nodes are dealt anew. A node with no exemplar next to it, or without an edge, is its own.
    """
    kept = Rounds(edges.sparkSession, "affinity")
    m = kept.put("m", _messages(cut_lineage(edges), sweep))
    self_made = (F.col("i") == F.col("k")) & (F.col("r") + F.col("a") > 0)
    seen, same = None, 0
    for n in range(rounds):
        m = kept.put("m", _round(m, damping))
        if patience is not None:
            now = tuple(m.filter(self_made).agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("q", "k"))).first())
            same = same + 1 if now == seen else 0
            seen = now
            if same >= patience:
                break
    first = kept.put("first", _nearest(m, m.filter(self_made).select("q", "k")).toDF("q", "i", "c"))
    inside = m.join(first, ["q", "i"]).join(first.select("q", F.col("i").alias("k"), F.col("c").alias("ck")), ["q", "k"]).filter("c = ck")
    sums = inside.groupBy("q", "c", "k").agg(F.round(F.sum("s"), 9).alias("o")).withColumn("o", -F.col("o"))
    moved = kept.put("moved", best_row(sums, ["q", "c"], ["o", "k"], ["k"]).select("q", "k"))
    found = _nearest(m, moved).toDF("q", node, "exemplar")
    every = nodes.select(node).distinct().select(F.explode(F.array(*[F.lit(q) for q in sweep])).alias("q"), node)
    return every.join(found, ["q", node], "left").select("q", node, F.coalesce("exemplar", node).alias("exemplar"))


def average_linkage(nodes: DataFrame, edges: DataFrame, node: str, threshold: float = 0.5, rounds: int | None = None) -> DataFrame:
    """(node, cluster): agglomeration by average linkage while the mean similarity of two clusters is `threshold` or more.

    Each round merges all pairs of clusters that are each other's nearest. Average linkage is reducible, so this gives the clusters of
    merging one best pair after the other (equal means go to the smallest names, where the order of merging may differ). A link between
    clusters keeps the sum of its similarities and the product of the sizes is divided in when means are compared; contraction adds
    the sums. A cluster is named after its smallest node. The number of rounds follows the height of the tree, not its size; `rounds`
    sets an end to it.
    """
    kept = Rounds(nodes.sparkSession, "linkage")
    size = kept.put("size", nodes.select(F.col(node).alias("c")).distinct().withColumn("n", F.lit(1).cast("long")))
    link = kept.put("link", edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("sim").alias("w")).groupBy("a", "b").agg(F.max("w").alias("w")))
    member = size.select(F.col("c").alias(node), F.col("c").alias("cluster"))
    done = 0
    while rounds is None or done < rounds:
        of = lambda c: size.select(F.col("c").alias(c), F.col("n").alias(f"n_{c}"))
        mean = F.round(F.col("w") / (F.col("n_a") * F.col("n_b")), 9)
        strong = kept.put("strong", link.join(of("a"), "a").join(of("b"), "b").withColumn("o", -mean).filter(F.col("o") <= -threshold).select("a", "b", "o"))
        ends = strong.select(F.col("a").alias("c"), "a", "b", "o").union(strong.select("b", "a", "b", "o"))
        best = best_row(ends, ["c"], ["o", "a", "b"], ["a", "b"])
        merge = kept.put("merge", best.groupBy("a", "b").agg(F.count(F.lit(1)).alias("votes")).filter("votes = 2").select("a", "b"))
        if rounds is None and merge.isEmpty():
            break
        to = merge.select(F.col("b").alias("c"), F.col("a").alias("into"))
        renamed = lambda d, c: d.join(to.toDF(c, "into"), c, "left").withColumn(c, F.coalesce("into", c)).drop("into")
        member = kept.put("member", renamed(member, "cluster"))
        size = kept.put("size", renamed(size, "c").groupBy("c").agg(F.sum("n").alias("n")))
        link = renamed(renamed(link, "a"), "b").filter("a <> b").groupBy(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).agg(F.sum("w").alias("w")).toDF("a", "b", "w")
        link = kept.put("link", link)
        done += 1
    return member


def chosen_clusters(nodes: DataFrame, edges: DataFrame, node: str, wanted: tuple[int, int] = (5, 25), target: int = 12, usable: tuple[int, int] = (3, 50),
                    threshold: float = 0.5, **options) -> DataFrame:
    """(node, cluster, method): the sweep whose number of clusters is nearest to `target` within `wanted`, the smallest quantile of equals.

    If none lies there, the sweep of most clusters is taken while their number is within `usable`, else average linkage.
    """
    swept = cut_lineage(affinity_propagation(nodes, edges, node, **options))
    counts = [(r.n, r.q) for r in swept.groupBy("q").agg(F.count_distinct("exemplar").alias("n")).collect()]  # one row for each quantile
    fit = sorted((abs(n - target), q) for n, q in counts if wanted[0] <= n <= wanted[1])
    most = min(counts, key=lambda c: (-c[0], c[1]), default=(0, 0.0))
    q = fit[0][1] if fit else most[1] if usable[0] <= most[0] <= usable[1] else None
    if q is not None:
        return swept.filter(F.col("q") == q).select(node, F.col("exemplar").alias("cluster"), F.lit(f"affinity_{q}").alias("method"))
    return average_linkage(nodes, edges, node, threshold).withColumn("method", F.lit("average_linkage"))
