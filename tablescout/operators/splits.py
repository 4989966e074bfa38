"""Leakage-safe, reproducible splits.

Order inside a split comes from a portable hash of the group key, not from a
random generator. Ranks over all groups are taken per hash slice: a first count
per (stratum, slice) gives every slice its starting rank, so no window sees
more than one slice of groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tablescout.operators.grouping import attach
from tablescout.session import cut_lineage

SLICES = 256


def hash32(c: Column) -> Column:
    """First 32 bits of md5 as a number; the same formula exists in any SQL engine."""
    return F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("long")


def bucket(c: Column, k: int) -> Column:
    return F.pmod(hash32(c), F.lit(k))


def global_rank(df: DataFrame, strata: list[str], hash_col: str, tie: str, out: str = "rank") -> DataFrame:
    """Row number per stratum by (hash, tie) without one task per stratum.

    Hashes are uniform, so slices of the 32-bit range are even; the slice
    totals are at most strata x 256 rows.
    """
    sliced = df.withColumn("_s", F.shiftright(F.col(hash_col), 24))
    totals = sliced.groupBy(*strata, "_s").agg(F.count("*").alias("_c"))
    before = W.partitionBy(*strata).orderBy("_s").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(*strata, "_s", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_b"))
    local = F.row_number().over(W.partitionBy(*strata, "_s").orderBy(hash_col, tie))
    return (sliced.join(starts, [*strata, "_s"])
            .withColumn(out, local + F.col("_b")).drop("_s", "_b"))


def stratified_group_split(rows: DataFrame, group: str, label: str, test_share: float) -> DataFrame:
    """(group, majority, split): the lowest hashes of each stratum form the test set."""
    groups = (rows.groupBy(group).agg(F.avg(F.col(label).cast("double")).alias("m"))
              .select(group, (F.col("m") >= 0.5).cast("int").alias("majority"))
              .withColumn("_h", hash32(F.col(group))))
    groups = cut_lineage(groups)  # one row per group, read three times below
    ranked = global_rank(groups, ["majority"], "_h", group)
    sizes = groups.groupBy("majority").agg(F.count("*").alias("_n"))
    return (ranked.join(sizes, "majority")
            .withColumn("split", F.when(F.col("rank") <= F.round(F.col("_n") * test_share), F.lit("holdout"))
                        .otherwise(F.lit("train")))
            .select(group, "majority", "split"))


def slice_guaranteed_split(rows: DataFrame, group: str, label: str, entity: str,
                           test_share: float = 0.18) -> DataFrame:
    """Group hold-out where every entity with two or more groups is represented.

    Each such entity forces its lowest-hash group into the hold-out; groups of
    one-group entities are forced to train (unless another entity forces them
    out); the remaining quota is filled per stratum by hash order.
    """
    h = hash32(F.col(group))
    g = (rows.groupBy(group).agg(F.avg(F.col(label).cast("double")).alias("m"))
         .select(group, (F.col("m") >= 0.5).cast("int").alias("majority")).withColumn("_h", h))
    pairs = rows.filter(F.col(label) == 1).select(entity, group).distinct()
    per = pairs.groupBy(entity).agg(F.count("*").alias("k"),
                                    F.min(F.struct(h.alias("h"), F.col(group).alias("g"))).alias("b"))
    out = per.filter("k >= 2").select(F.col("b.g").alias(group)).distinct().withColumn("_va", F.lit(True))
    stay = per.filter("k = 1").select(F.col("b.g").alias(group)).distinct().withColumn("_tr", F.lit(True))
    tagged = (g.join(out, group, "left").join(stay, group, "left")
              .withColumn("forced", F.when(F.col("_va"), F.lit("holdout")).when(F.col("_tr"), F.lit("train")))
              .drop("_va", "_tr"))
    tagged = cut_lineage(tagged)
    stats = tagged.agg(F.count("*").alias("_all"),
                       F.sum((F.col("forced") == "holdout").cast("long")).alias("_out"),
                       F.sum(F.col("forced").isNull().cast("long")).alias("_free"))
    free = tagged.filter("forced IS NULL")
    ranked = global_rank(free.drop("forced"), ["majority"], "_h", group)
    sizes = free.groupBy("majority").agg(F.count("*").alias("_n"))
    share = F.greatest(F.lit(0.01), F.least(F.lit(0.9), (
        F.round(F.col("_all") * test_share) - F.coalesce("_out", F.lit(0)))
        / F.greatest("_free", F.lit(1))))
    rest = (attach(ranked.join(sizes, "majority"), stats)
            .withColumn("split", F.when(F.col("rank") <= F.round(F.col("_n") * share), F.lit("holdout"))
                        .otherwise(F.lit("train"))).select(group, "majority", "split"))
    fixed = tagged.filter("forced IS NOT NULL").select(group, "majority", F.col("forced").alias("split"))
    return rest.unionByName(fixed)


def assign_split(rows: DataFrame, groups: DataFrame, group: str) -> DataFrame:
    return rows.join(groups.select(group, "split"), group)


def split_part(rows: DataFrame, groups: DataFrame, group: str, split: str) -> DataFrame:
    """Rows whose group belongs to the split (membership only, no columns added)."""
    return rows.join(groups.filter(F.col("split") == split).select(group), group, "left_semi")


def split_overlap(train: DataFrame, test: DataFrame, group: str) -> DataFrame:
    """Groups present on both sides; must be zero."""
    return (train.select(group).intersect(test.select(group)).agg(F.count("*").alias("overlap")))


def fold_of(group: Column, k: int) -> Column:
    return bucket(group, k).cast("int")


def fold_count(rows: DataFrame, entity: str, group: str, upper: int = 5) -> DataFrame:
    """max(2, min(upper, fewest groups of any class)) as a one-row table."""
    g = rows.groupBy(entity).agg(F.countDistinct(group).alias("k")).agg(F.min("k").alias("m"))
    return g.select(F.greatest(F.lit(2), F.least(F.lit(upper), F.col("m"))).cast("int").alias("n_splits"))


def balanced_folds(rows: DataFrame, group: str, k: int) -> DataFrame:
    """Folds of near-equal row counts: groups by falling size, each to the lightest fold (the first of equals).

    Groups of one size are ordered by hash. The rule is applied to the number of groups of each size, not to the groups: of groups of
    size n a fold of load l takes those whose turn is at load l, l + n, l + 2n, ..., so the turns of all folds repeat in cycles
    once the lighter ones have caught up. There are at most sqrt(2 rows) sizes, and at most k stretches of cycles for each.
    """
    sizes = cut_lineage(rows.groupBy(group).agg(F.count("*").alias("n")).withColumn("_h", hash32(F.col(group))))
    ranked = global_rank(sizes, ["n"], "_h", group, "_local")
    per = sizes.groupBy("n").agg(F.count("*").alias("c")).orderBy(F.desc("n")).collect()  # at most sqrt(2 rows)
    turns = rows.sparkSession.createDataFrame(fold_turns([(r.n, r.c) for r in per], k), "n long, _first long, _last long, _order array<int>")
    turns = F.broadcast(turns) if len(per) * k <= 100_000 else turns
    at = F.col("_local") - 1
    met = ranked.join(turns, "n").filter((at >= F.col("_first")) & (at < F.col("_last")))
    return met.select(group, "n", F.element_at("_order", (F.pmod(at - F.col("_first"), F.size("_order")) + 1).cast("int")).alias("fold"))


def fold_turns(histogram: list[tuple[int, int]], k: int) -> list[tuple[int, int, int, list[int]]]:
    """(size, first, last, folds): groups number first to last - 1 of this size go to these folds in turn.

    `histogram`: (size, number of groups) by falling size.
    """
    loads, out = [0] * k, []
    for n, count in histogram:
        low = min(loads)
        cycle = [(x - low) // n for x in loads]  # the cycle a fold joins in
        order = sorted(range(k), key=lambda f: ((loads[f] - low) % n, f))
        at, c = 0, 0
        while at < count:
            here = [f for f in order if cycle[f] <= c]
            later = [x for x in cycle if x > c]
            room = (min(later) - c) * len(here) if later else count - at
            take = min(room, count - at)
            out.append((n, at, at + take, here))
            for turn, f in enumerate(here):
                loads[f] += n * (take // len(here) + (turn < take % len(here)))
            at += take
            c = min(later, default=c)
    return out


def fold_training_rows(real: DataFrame, synthetic: DataFrame, fold: int, group: str,
                       parent: str) -> DataFrame:
    """Training rows of a fold: other folds' real rows and the children of their groups."""
    train = real.filter(F.col("fold") != fold)
    parents = train.select(F.col(group).alias(parent)).distinct()
    children = synthetic.join(parents, parent, "left_semi")
    return train.unionByName(children, allowMissingColumns=True)


def children_by_fold(synthetic: DataFrame, folds: DataFrame, parent: str, group: str, k: int) -> DataFrame:
    """(child rows, fold k they may train): every fold but the parent's own."""
    j = synthetic.join(folds.select(F.col(group).alias(parent), "fold"), parent)
    others = F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: i != F.col("fold"))
    return j.withColumn("trains_fold", F.explode(others)).drop("fold")


def leakage_key(base: Column, dataset: Column) -> Column:
    return F.concat_ws("||", F.coalesce(base, F.lit("")), F.coalesce(dataset, F.lit("")))
