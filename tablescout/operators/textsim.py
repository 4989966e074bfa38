"""Character-gram TF-IDF, exact nearest neighbours and name clustering.

Vectors stay sparse and long: an inverted index (gram, name) instead of a
matrix. `nearest_neighbours` finds the best catalogue name per query name:
slices of the names meet blocks of the catalogue, and in each such cell the
products of shared grams are summed for all its pairs, a bounded number at once.
The result is exact at any floor; work grows with names x catalogue, the shuffle
with the names times the blocks, memory not at all.

`similar_pairs` and `spanning_links` look up only the rarest grams of a name,
leaving out frequent ones while their joint norm `rem` stays small. A pair
sharing no looked-up gram has a cosine below `rem` (unit vectors,
Cauchy-Schwarz), and the true cosine of a found pair is at most its partial sum
plus `rem`; pairs that cannot reach the floor are dropped before they are scored
in full.

Frequent grams only reach a join for names made of little else; AQE splits
what skew remains.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tablescout.functions import text as T
from tablescout.functions.ratios import weighted_ratio
from tablescout.operators.grouping import attach, best_row, top_k
from tablescout.session import Rounds, cut_lineage



def word_grams(word: Column, lo: int, hi: int) -> Column:
    """Grams of one padded word; a word no longer than n gives one gram and ends."""
    sized = []
    for n in range(lo, hi + 1):
        count = F.length(word) - n
        grams = F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(0))),
                            lambda i: F.substring(word, i + 1, F.lit(n)))
        # sizes beyond the word's own length were already covered by the first short one
        needed = F.lit(True) if n == lo else F.length(word) > n - 1
        sized.append(F.when(needed, grams).otherwise(F.array().cast("array<string>")))
    return F.flatten(F.array(*sized))


def char_wb_grams(c: Column, lo: int = 2, hi: int = 4) -> Column:
    """All character grams inside the space-padded words of a name."""
    words = F.filter(F.split(F.lower(T.text(c)), r"(?U)\s+"), lambda w: w != "")
    return F.flatten(F.transform(words, lambda w: word_grams(F.concat(F.lit(" "), w, F.lit(" ")), lo, hi)))


def word_tokens(c: Column, hi: int = 2) -> Column:
    """Words of two letters or more, plus adjacent pairs up to `hi` words."""
    words = F.regexp_extract_all(F.lower(T.text(c)), F.lit(r"([\p{L}\p{N}_]{2,})"))
    if hi == 1:
        return words
    # each word beside the next; a lambda that named the list again would take the text apart for each of its words
    n = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b))
    return F.concat(words, F.coalesce(pairs, F.array().cast("array<string>")))


def term_counts(df: DataFrame, key: str, terms: Column) -> DataFrame:
    """(key, term, tf). The rows are dealt by key before they unfold, so the texts are shuffled and not their terms."""
    return (df.repartition(key).select(key, F.explode(terms).alias("term"))
            .groupBy(key, "term").agg(F.count("*").cast("double").alias("tf")))


def vocabulary(counts: DataFrame, key: str, n_docs: DataFrame, min_df: int = 1,
               max_features: int | None = None) -> DataFrame:
    """(term, df, idf) with idf = ln((1+N)/(1+df)) + 1."""
    g = counts.groupBy("term").agg(F.count("*").alias("df"),
                                   F.sum("tf").alias("total"))
    g = g.filter(F.col("df") >= min_df)
    if max_features is not None:
        g = g.orderBy(F.desc("total"), "term").limit(max_features)
    return attach(g, n_docs.agg(F.count("*").alias("N"))).select(
        "term", "df", (F.log((1 + F.col("N")) / (1 + F.col("df"))) + 1).alias("idf"))


def weighted_terms(counts: DataFrame, vocab: DataFrame, key: str) -> DataFrame:
    """(key, term, df, w) with unit-length vectors per key."""
    raw = counts.join(vocab, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norms = raw.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norms, key).select(key, "term", "df", (F.col("w") / F.col("norm")).alias("w"))


def tfidf(df: DataFrame, key: str, terms: Column, min_df: int = 1,
          max_features: int | None = None) -> DataFrame:
    """(key, term, df, w). Texts are taken apart once; counts and vocabulary are written and read again."""
    rounds = Rounds(df.sparkSession, "tfidf")
    counts = rounds.put("counts", term_counts(df, key, terms))
    return weighted_terms(counts, rounds.put("terms", vocabulary(counts, key, df, min_df, max_features)), key)


def _with_prefix(df: DataFrame, floor: float) -> DataFrame:
    """Adds `kept`, the rarest grams, and `rem`, the norm of those left out (< floor)."""
    start = F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("n"), F.lit(True).alias("open"))
    grown = lambda a, x: a["s"] + x["w"] * x["w"]
    state = F.aggregate(
        F.reverse("vec"), start,
        lambda a, x: F.when(a["open"] & (grown(a, x) < floor * floor * (1 - 1e-9)),
                            F.struct(grown(a, x).alias("s"), (a["n"] + 1).alias("n"), F.lit(True).alias("open")))
        .otherwise(F.struct(a["s"].alias("s"), a["n"].alias("n"), F.lit(False).alias("open"))))
    return (df.withColumn("_st", state).withColumn("rem", F.sqrt("_st.s"))
            .withColumn("kept", F.slice("vec", F.lit(1), F.size("vec") - F.col("_st.n"))).drop("_st"))


def _grams_of(df: DataFrame, key: str, col: str, weight: str, *extra: str) -> DataFrame:
    return df.select(key, *extra, F.explode(col).alias("g")).select(
        key, *extra, "g.term", F.col("g.w").alias(weight))


def _score(pairs: DataFrame, q: DataFrame, c: DataFrame) -> DataFrame:
    """Full cosine of the given pairs; each side brings its whole vector."""
    table = F.map_from_entries(F.transform("vec", lambda x: F.struct(x["term"], x["w"])))
    j = (pairs.join(q.select("q", F.col("vec").alias("qv")), "q")
         .join(c.select("c", table.alias("cm")), "c"))
    dot = F.aggregate("qv", F.lit(0.0), lambda s, x: s + x["w"] * F.coalesce(
        F.element_at("cm", x["term"]), F.lit(0.0)))
    return j.select(*pairs.columns, dot.alias("sim"))


def _sorted_vectors(docs: DataFrame, key: str, terms: Column) -> DataFrame:
    """Like `tfidf`, but one row per key; the norm is taken inside the array."""
    counts = term_counts(docs, key, terms)
    raw = counts.join(vocabulary(counts, key, docs), "term")
    g = raw.groupBy(key).agg(F.sort_array(F.collect_list(
        F.struct("df", "term", (F.col("tf") * F.col("idf")).alias("w")))).alias("raw"))
    g = g.withColumn("norm", F.sqrt(F.aggregate("raw", F.lit(0.0), lambda s, x: s + x["w"] * x["w"])))
    return g.select(key, F.transform("raw", lambda x: F.struct(
        x["df"].alias("df"), x["term"].alias("term"), (x["w"] / F.col("norm")).alias("w"))).alias("vec"))


PREFIX_NORM = 0.4  # left-out norm; smaller looks up more grams, larger prunes less


SLICE = 4096  # names that are compared in one cell
BLOCK = 8192  # catalogue names of a cell
PRODUCTS = 1 << 20  # products of weights that are held at once


def nearest_neighbours(queries: DataFrame, catalog: DataFrame, text: str = "light",
                       floor: float = 0.5, complete: bool = False) -> DataFrame:
    """(q, c, similarity) with similarity on a 0-100 scale.

    Names below the floor get no row unless `complete` is set: then every name that shares a gram with the catalogue gets one.
    The vocabulary is fitted on the distinct names of both sides together. Equal strings are neighbours at 100; equal scores (to 9
    digits) go to the smallest name.

    Names are dealt into slices and the catalogue into blocks; each cell, a slice with a block, gives one row per name, and the best
    row of a name's blocks counts. So the shuffle holds the vectors and one row per name and block, never a pair of names.
    """
    rounds = Rounds(queries.sparkSession, "neighbours")
    sides = (queries.select(F.concat(F.lit("q"), text).alias("k")).distinct()
             .unionByName(catalog.select(F.concat(F.lit("c"), text).alias("k")).distinct())
             .filter("length(k) > 1"))
    sides = rounds.put("sides", sides)
    in_catalog = F.startswith("k", F.lit("c"))
    size = sides.agg(F.ceil(F.count_if(~in_catalog) / SLICE), F.ceil(F.count_if(in_catalog) / BLOCK)).first()
    slices, blocks = max(size[0], 1), max(size[1], 1)
    vectors = _shared_vectors(sides, in_catalog, rounds)
    part = lambda n: F.pmod(F.xxhash64("k"), F.lit(n))
    cells = F.when(in_catalog, F.transform(F.sequence(F.lit(0), F.lit(slices - 1)), lambda i: i * blocks + part(blocks))).otherwise(
        F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda i: part(slices) * blocks + i))
    dealt = vectors.select(F.explode(cells).alias("cell"), in_catalog.alias("known"), F.substring("k", F.lit(2), F.length("k")).alias("name"), "ids", "ws")
    found = dealt.groupBy("cell").applyInArrow(_nearest_in_cell, "q string, c string, sim double")
    found = best_row(found.withColumn("_o", -F.round("sim", 9)), ["q"], ["_o", "c"], ["c", "sim"])
    found = found.withColumn("sim", F.when(F.col("sim") == SAME, 1.0).otherwise(F.col("sim")))
    return _as_percent(found if complete else found.filter(F.col("sim") >= floor))


def _shared_vectors(sides: DataFrame, in_catalog: Column, rounds: Rounds) -> DataFrame:
    """(k, ids, ws): unit vectors, of which only the grams that a catalogue name has are listed, the others count for the length."""
    counts = rounds.put("counts", term_counts(sides, "k", char_wb_grams(F.substring("k", F.lit(2), F.length("k")))))
    terms = counts.groupBy("term").agg(F.count("*").alias("df"), F.bool_or(in_catalog).alias("known"))
    idf = F.log((1 + F.col("N")) / (1 + F.col("df"))) + 1
    terms = attach(terms, sides.agg(F.count("*").alias("N"))).select("term", idf.alias("idf"), "known", F.monotonically_increasing_id().alias("id"))
    terms = rounds.put("terms", terms)  # the ids are given once
    w = F.col("tf") * F.col("idf")
    g = counts.join(terms, "term").groupBy("k").agg(
        F.sqrt(F.sum(w * w)).alias("norm"), F.collect_list(F.when(F.col("known"), F.struct("id", w.alias("w")))).alias("v"))
    return g.select("k", F.col("v.id").alias("ids"), F.transform("v", lambda x: x["w"] / F.col("norm")).alias("ws"))


SAME = 2.0  # similarity of equal strings while rows of several blocks are compared


def _nearest_in_cell(cell: pa.Table) -> pa.Table:
    """(q, c, sim): for each name of the cell the catalogue name of the highest cosine, if one shares a gram with it."""
    def flat(t):
        lists = t.column("ids").combine_chunks()
        return np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(), t.column("ws").combine_chunks().flatten().to_numpy()

    known = cell.column("known")
    c, q = cell.filter(known).sort_by("name"), cell.filter(pc.invert(known))
    names, asked = c.column("name").to_pylist(), q.column("name").to_pylist()
    sizes, ids, ws = flat(c)
    terms, term = np.unique(ids, return_inverse=True)
    order = np.argsort(term, kind="stable")
    posts, weights = np.repeat(np.arange(len(names)), sizes)[order], ws[order]
    starts = np.searchsorted(term[order], np.arange(len(terms) + 1))
    sizes, ids, ws = flat(q)
    row = np.repeat(np.arange(len(asked)), sizes)
    at = np.searchsorted(terms, ids)
    hit = at < len(terms)
    hit[hit] = terms[at[hit]] == ids[hit]
    row, at, ws = row[hit], at[hit], ws[hit]
    many = starts[at + 1] - starts[at]
    work = np.cumsum(np.bincount(row, many, len(asked)) + len(names))  # products and cells of the table
    place = {x: i for i, x in enumerate(names)}
    got_q, got_c, got_sim, a = [], [], [], 0
    while a < len(asked) and names:
        b = max(a + 1, int(np.searchsorted(work, (work[a - 1] if a else 0) + PRODUCTS)))
        i, j = np.searchsorted(row, [a, b])
        n = many[i:j]
        one = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - starts[at[i:j]], n)  # postings of each gram of each name
        dots = np.bincount(np.repeat((row[i:j] - a) * len(names), n) + posts[one], np.repeat(ws[i:j], n) * weights[one], (b - a) * len(names))
        dots = dots.reshape(b - a, len(names))
        for k in range(a, b):
            if (same := place.get(asked[k])) is not None and dots[k - a, same] > 0:
                dots[k - a, same] = SAME
        best = np.round(dots, 9).argmax(axis=1)  # the first of equals, and names ascend
        sim = dots[np.arange(b - a), best]
        for k in np.flatnonzero(sim > 0):
            got_q.append(asked[a + k])
            got_c.append(names[best[k]])
            got_sim.append(sim[k])
        a = b
    return pa.table({"q": pa.array(got_q, pa.string()), "c": pa.array(got_c, pa.string()), "sim": pa.array(got_sim, pa.float64())})


def _as_percent(nn: DataFrame) -> DataFrame:
    return nn.select("q", "c", (F.col("sim") * 100).alias("similarity"))


def similar_pairs(names: DataFrame, text: str, floor: float) -> DataFrame:
    """Undirected edges (a < b) between names with cosine at or above the floor."""
    docs = names.select(F.col(text).alias("t")).filter("t <> ''").distinct()
    v = _with_prefix(cut_lineage(_sorted_vectors(docs, "t", char_wb_grams(F.col("t")))), min(floor, PREFIX_NORM))
    q, c = v.withColumnRenamed("t", "q"), v.select(F.col("t").alias("c"), "vec")
    parts = (_grams_of(q, "q", "kept", "wq", "rem").join(_grams_of(c, "c", "vec", "wc"), "term").filter("q < c")
             .groupBy("q", "rem", "c").agg(F.sum(F.col("wq") * F.col("wc")).alias("part"))
             .filter(F.col("part") + F.col("rem") >= floor - 1e-9).select("q", "c"))
    return _score(parts, q, c).filter(F.col("sim") >= floor).select(F.col("q").alias("a"), F.col("c").alias("b"), "sim")


def connected_components(nodes: DataFrame, edges: DataFrame, node: str) -> DataFrame:
    """(node, component) where the component is its smallest node.

    Large-star and small-star rounds alternate; both only group by node with a
    combinable minimum, edges shrink towards stars, and the number of rounds
    grows with the logarithm of the longest chain. Each round is written out.
    """
    rounds = Rounds(edges.sparkSession, "components")
    e = rounds.put("e", edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .filter("u <> v").distinct())
    fingerprint = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        low2 = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(low2, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
                 .unionByName(low2.select("u", F.col("m").alias("v"))).distinct())
        e = rounds.put("e", small)
        stats = e.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if (stats.n, stats.h) == fingerprint:
            break
        fingerprint = (stats.n, stats.h)
    return (nodes.select(F.col(node)).distinct()
            .join(e.groupBy("u").agg(F.min("v").alias("v")), F.col(node) == F.col("u"), "left")
            .select(node, F.coalesce("v", node).alias("component")))


TRIES = 2  # comparisons with other components that each first component may make in the first round


def spanning_links(names: DataFrame, text: str, floor: float) -> DataFrame:
    """(a, b, sim): links with cosine at or above the floor whose connected components are those of all such pairs.

    Names that differ by a trailing number only are compared with the smallest of them; those at the floor or above start as one
    component. From then on a name is held against components, not names: with the largest weight that each gram has in a component
    an upper bound of its similarity to any member follows, and what stays below the floor ends there. Of what is left each first
    component makes the comparisons of the highest bounds, one link joins a pair of components and ends it, and pairs that are still
    apart follow in growing numbers until none is left, so that no link is lost. A round has at most `tries` links for each first
    component: the links grow with the names, not with their square.
    """
    docs = names.select(F.col(text).alias("t")).filter("t <> ''").distinct()
    vectors = cut_lineage(_sorted_vectors(docs, "t", char_wb_grams(F.col("t"))))
    rounds = Rounds(names.sparkSession, "links")
    v = rounds.put("v", _with_prefix(vectors, min(floor, PREFIX_NORM)))
    q, c = v.withColumnRenamed("t", "q"), v.select(F.col("t").alias("c"), "vec")
    family = v.select("t", F.regexp_replace("t", r"\s*\p{Nd}+$", "").alias("family"))
    first = family.groupBy("family").agg(F.min("t").alias("low"))
    star = _score(family.join(first, "family").filter("t <> low").select(F.col("t").alias("q"), F.col("low").alias("c")), q, c)
    star = rounds.put("star", star.filter(F.col("sim") >= floor).select("q", "c", "sim"))
    home = rounds.put("home", v.select("t").join(star.select(F.col("q").alias("t"), F.col("c").alias("first")), "t", "left")
                      .select("t", F.coalesce("first", "t").alias("home")))
    grams = lambda col, weight: v.join(home, "t").select("t", "home", "rem", F.explode(col).alias("g")).select("t", "home", "rem", "g.term", F.col("g.w").alias(weight))
    most = grams("vec", "w").groupBy("term", F.col("home").alias("other")).agg(F.max("w").alias("most"))
    bound = (grams("kept", "w").join(most, "term").filter("home < other").groupBy("t", "home", "rem", "other")
             .agg((F.sum(F.col("w") * F.col("most")) + F.col("rem")).alias("bound")).filter(F.col("bound") >= floor - 1e-9))
    open_ = rounds.put("open", bound.select("t", "home", "other", F.round("bound", 9).alias("bound")))
    links, now, tries = star.select(F.col("c").alias("a"), F.col("q").alias("b"), "sim"), home.select("home").distinct().withColumn("part", F.col("home")), TRIES
    while not open_.isEmpty():
        tried = rounds.put("tried", top_k(open_, ["home"], [F.desc("bound"), F.col("other"), F.col("t")], tries).drop("rn"))
        members = home.select(F.col("t").alias("c"), F.col("home").alias("other"))
        pairs = tried.select(F.col("t").alias("q"), "home", "other").join(members, "other")
        found = _score(pairs, q, c).filter(F.col("sim") >= floor).withColumn("o", -F.round("sim", 9))
        found = rounds.put(f"found{tries}", best_row(found, ["home", "other"], ["o", "q", "c"], ["q", "c", "sim"]))
        links = links.union(found.select(F.least("q", "c").alias("a"), F.greatest("q", "c").alias("b"), "sim"))
        joined = found.join(now.select("home", F.col("part").alias("a")), "home").join(now.select(F.col("home").alias("other"), F.col("part").alias("b")), "other").select("a", "b")
        parts = connected_components(now.select("part"), joined, "part").withColumnRenamed("component", "to")
        now = rounds.put("now", now.join(parts, "part").select("home", F.col("to").alias("part")))
        apart = (open_.join(tried.select("t", "other"), ["t", "other"], "left_anti").join(now.select("home", F.col("part").alias("p1")), "home")
                 .join(now.select(F.col("home").alias("other"), F.col("part").alias("p2")), "other").filter("p1 <> p2"))
        open_ = rounds.put("open", apart.select("t", "home", "other", "bound"))
        tries *= 8
    return links


def name_clusters(names: DataFrame, text: str, floor: float = 0.5) -> DataFrame:
    """Connected components of the similarity graph."""
    return connected_components(names.select(text).filter(F.col(text) != ""),
                                spanning_links(names, text, floor), text)


def cluster_labels(members: DataFrame, text: str, cluster: str = "component") -> DataFrame:
    """A word per cluster: first word of its heaviest one/two-word TF-IDF term.

    The TF-IDF is fitted inside each cluster; a singleton takes its first token.
    """
    docs = members.select(cluster, F.col(text).alias("doc"))
    sizes = docs.groupBy(cluster).agg(F.count("*").alias("size"), F.min("doc").alias("one"))
    tf = (docs.select(cluster, "doc", F.explode(word_tokens(F.col("doc"))).alias("term"))
          .groupBy(cluster, "doc", "term").agg(F.count("*").cast("double").alias("tf")))
    df = tf.groupBy(cluster, "term").agg(F.count("*").alias("df"))
    w = (tf.join(df, [cluster, "term"]).join(sizes.select(cluster, "size"), cluster)
         .withColumn("w", F.col("tf") * (F.log((1 + F.col("size")) / (1 + F.col("df"))) + 1)))
    norm = w.groupBy(cluster, "doc").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    total = (w.join(norm, [cluster, "doc"]).groupBy(cluster, "term")
             .agg(F.round(F.sum(F.col("w") / F.col("norm")), 9).alias("s")))
    top = best_row(total.withColumn("_o", -F.col("s")), [cluster], ["_o", "term"], ["term"])
    first = F.split(F.trim("one"), " ")[0]
    label = F.when(F.col("size") == 1, first).otherwise(F.split(F.col("term"), " ")[0])
    return (sizes.join(top, cluster, "left")
            .select(cluster, "size", F.when(label != "", label)
                    .otherwise(F.concat(F.lit("cluster_"), F.col(cluster))).alias("label")))


def token_overlap(names: DataFrame, dictionary: DataFrame, name: str, entry: str) -> DataFrame:
    """Best token-set Jaccard (0-100) of each name against a dictionary of any size.

    Joined on shared tokens instead of all pairs; Spark broadcasts the tokens
    where their measured size allows it.
    """
    words = lambda c: F.array_distinct(F.filter(F.split(c, r"\s+"), lambda t: t != ""))
    # one row per name before anything is taken apart; read twice below
    once = Rounds(names.sparkSession, "names").put("names", names.select(name).distinct())
    q = once.select(name, words(T.base_entity(F.col(name))).alias("qs"))
    d = dictionary.select(F.col(entry).alias("d"), words(F.col(entry)).alias("ds")).distinct()
    hits = (q.select(name, F.size("qs").alias("nq"), F.explode("qs").alias("t"))
            .join(d.select("d", F.size("ds").alias("nd"), F.explode("ds").alias("t")), "t")
            .groupBy(name, "nq", "d", "nd").agg(F.count("*").alias("i"))
            .groupBy(name).agg(F.max(100.0 * F.col("i") / (F.col("nq") + F.col("nd") - F.col("i"))).alias("s")))
    return q.select(name).join(hits, name, "left").select(
        name, F.round(F.coalesce("s", F.lit(0.0)), 6).alias("fuzzy_score"))


def best_weighted_ratio(names: DataFrame, dictionary: DataFrame, name: str, entry: str) -> DataFrame:
    """Highest weighted ratio (0-100) of each distinct name, in its base form, against a dictionary of stated size (a top-n list).

    The list is attached as one row and walked once for each distinct base form; nulls and names without a word score 0. Few bytes
    mean much work here, so the forms are dealt to a fixed number of tasks, which adaptive execution leaves alone.
    """
    parts = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    q = names.select(name, T.base_entity(F.col(name)).alias("base")).distinct()
    entries = dictionary.agg(F.sort_array(F.collect_set(entry)).alias("entries"))
    best = F.aggregate("entries", F.lit(0.0), lambda s, e: F.when(s >= 100, s).otherwise(F.greatest(s, weighted_ratio(F.col("base"), e))))
    scored = attach(q.select("base").distinct().filter("base <> ''").repartition(parts, "base"), entries).select("base", best.alias("s"))
    return q.join(scored, "base", "left").select(name, F.round(F.coalesce("s", F.lit(0.0)), 6).alias("fuzzy_score"))


def edit_ratio(a: Column, b: Column) -> Column:
    """Levenshtein similarity on a 0-100 scale."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(0.0)).otherwise(100.0 * (longest - F.levenshtein(a, b)) / longest)
