"""Verdicts on urls: stated rules first, else a learned tree of path templates.

Method: the paths of each host form a tree of segments. Segments that vary (digits, long hexadecimal, or many children
under one parent of which each holds a small share) become wildcards; neighbouring branches under one parent whose rates of
bad urls do not differ significantly are merged; a merged branch is rejected if its smoothed labelled purity reaches a limit.
The labels are the verdicts of the rules, or any column of the caller. Only expressions, aggregates and joins are used; the
tree is built from the distinct templates with their counts, not from the urls.

Cases: a null url or one without `://` has an empty host and path; a path that lacks the leading slash fits no rule;
rows of equal id are judged one by one; other columns play no part; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablescout.llm.common import ascii_lower
from tablescout.session import cut_lineage

DEPTH = 3  # levels of the tree; what lies below the last level is one wildcard
MAX_CHILDREN = 16  # beyond it, children that hold less than 1 / MAX_CHILDREN of their parent become one wildcard
STRENGTH, PRIOR = 4.0, 0.5  # urls that the prior counts for, and its share of bad ones
REJECT = 0.8  # smoothed purity from which a template is rejected
SIGNIFICANT = 1.96  # standard errors


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, action) of the longest fitting rule; rules are ("block" or "allow", "host/path")."""
    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[0] != "block", r[1]))
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, text in reversed(ordered):
        h, _, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule, action = F.when(fits, text).otherwise(rule), F.when(fits, act).otherwise(action)
    return rule, action


def segments(path: Column) -> Column:
    """The first DEPTH segments, digits and long hexadecimal replaced, and `*` for all that follow."""
    s = F.filter(F.split(path, "/"), lambda x: x != "")
    s = F.transform(s, lambda x: F.regexp_replace(F.regexp_replace(x, "[0-9a-f]{12,}", "*"), "[0-9]+", "*"))
    return F.when(F.size(s) > DEPTH, F.concat(F.slice(s, 1, DEPTH), F.array(F.lit("*")))).otherwise(s)


def _generalise(t: DataFrame, level: int) -> DataFrame:
    """t: (host, seg, n, labelled, bad); the segment of this level becomes `*` where it varies."""
    deep = F.size("seg") >= level
    node = t.filter(deep).groupBy("host", F.slice("seg", 1, level - 1).alias("parent"), F.get("seg", F.lit(level - 1)).alias("child")).agg(F.sum("n").alias("n"))
    parent = node.groupBy("host", "parent").agg(F.count("*").alias("kids"), F.sum("n").alias("total")).filter(F.col("kids") > MAX_CHILDREN)
    t = t.withColumn("parent", F.when(deep, F.slice("seg", 1, level - 1))).withColumn("child", F.get("seg", F.lit(level - 1)))
    varied = node.join(parent, ["host", "parent"]).filter(F.col("n") * MAX_CHILDREN < F.col("total")).select("host", "parent", "child", F.lit(True).alias("varies"))
    t = t.join(varied, ["host", "parent", "child"], "left")
    seg = F.when(F.col("varies"), F.concat("parent", F.array(F.lit("*")), F.slice("seg", level + 1, DEPTH + 1))).otherwise(F.col("seg"))
    return t.select("host", "raw", seg.alias("seg"), "n", "labelled", "bad")


def templates(urls: DataFrame) -> DataFrame:
    """urls: (host, seg, bad), bad null where no label is known. Returns (host, raw, template, rejected) for each distinct raw path."""
    t = urls.groupBy("host", "seg").agg(F.count("*").alias("n"), F.count("bad").alias("labelled"), F.count(F.when(F.col("bad"), 1)).alias("bad"))
    t = cut_lineage(t.withColumn("raw", F.col("seg")))
    # every level reads the table of templates several times: it is written once for each
    t = reduce(lambda x, level: cut_lineage(_generalise(x, level)), range(1, DEPTH + 1), t)
    leaf = t.groupBy("host", "seg").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    # siblings in the order of their rate; a significant step starts the next branch
    up = F.slice("seg", 1, F.greatest(F.size("seg") - 1, F.lit(0)))
    rated = leaf.filter("labelled > 0").select("host", "seg", up.alias("parent"), "labelled", "bad",
                                               ((F.col("bad") + STRENGTH * PRIOR) / (F.col("labelled") + STRENGTH)).alias("rate"))
    order = Window.partitionBy("host", "parent").orderBy("rate", F.array_join("seg", "/"))
    noise = lambda p, n: p * (1 - p) / (n + STRENGTH)
    stepped = rated.withColumn("was", F.lag("rate").over(order)).withColumn("of", F.lag("labelled").over(order))
    stepped = stepped.withColumn("step", F.when(F.col("rate") - F.col("was") > SIGNIFICANT * F.sqrt(
        noise(F.col("rate"), F.col("labelled")) + noise(F.col("was"), F.col("of"))), 1).otherwise(0))
    merged = stepped.withColumn("branch", F.sum("step").over(order))
    pure = merged.groupBy("host", "parent", "branch").agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b"))
    bad = pure.filter((F.col("b") + STRENGTH * PRIOR) / (F.col("l") + STRENGTH) >= REJECT).select("host", "parent", "branch")
    bad = merged.join(bad, ["host", "parent", "branch"]).select("host", "seg", F.lit(True).alias("rejected"))
    return t.join(bad, ["host", "seg"], "left").select("host", "raw", F.array_join("seg", "/").alias("template"),
                                                     F.coalesce("rejected", F.lit(False)).alias("rejected"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
               label: Column | None = None) -> DataFrame:
    """(id, host, path, rule, verdict, template). `label`: true for bad urls, null where unknown; by default the rules' verdicts."""
    host, path = host_and_path(F.col(f"`{url_col}`"))
    p = pages.select(F.col(f"`{id_col}`").alias(id_col), host.alias("host"), path.alias("path"),
                     (F.lit(None).cast("boolean") if label is None else label).alias("given"))
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    p = p.withColumn("rule", rule).withColumn("action", action).withColumn("seg", segments(F.col("path")))
    p = p.withColumn("bad", F.col("action") == "block" if label is None else F.col("given"))
    judged = templates(p.select("host", "seg", "bad")).select("host", F.col("raw").alias("seg"), "template", "rejected")
    verdict = F.coalesce("action", F.when(F.col("rejected"), "block").otherwise("allow"))
    return p.join(judged, ["host", "seg"], "left").select(id_col, "host", "path", "rule", verdict.alias("verdict"), "template")
