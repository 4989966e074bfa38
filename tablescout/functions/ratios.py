"""Weighted ratio of two strings (0-100) as column expressions.

Built on the longest common subsequence (LCS) of code points, found bit-parallel: the shorter string is a word of bits, and each
character of the longer one costs an addition and three bit operations. Strings that both exceed WORD characters use several words
with a carry. Expressions that are used more than once are bound by `let`, since lambda bodies are evaluated as written.

ratio           2 LCS / (both lengths)
partial         highest ratio of the shorter string with a window of its length in the longer one, cut at the ends; for equal
                lengths in both directions
token sort      ratio of the sorted words
token set       words of both, then what each has beyond them; 100 if one has nothing beyond
weighted        lengths within 1.5: max(ratio, 0.95 token sort, 0.95 token set); else, scaled by 0.9 (0.6 beyond a factor of 8),
                the partial forms instead of the token forms. 0 if a string has no word, null if one is null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

WORD = 62  # bits of a word: a sum of two words and a carry stays below 2^63


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def chars(c: Column) -> Column:
    return F.filter(F.split(c, ""), lambda x: x != "")


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int"))


def _masks(a: Column, start: Column, stop: Column) -> Column:
    """character -> bits of its places from `start` up to `stop`"""
    places = lambda ch: F.aggregate(F.sequence(start, stop - 1), F.lit(0).cast("long"), lambda s, i: F.when(
        F.get(a, i) == ch, s.bitwiseOR(_bit(i - start))).otherwise(s))
    return F.map_from_entries(F.transform(F.array_distinct(F.slice(a, start + 1, stop - start)), lambda ch: F.struct(ch, places(ch))))


def _one_word(mask: Column, n: Column, b: Column) -> Column:
    """LCS of a string of n <= WORD characters, given by its masks, with b."""
    full = _bit(n) - 1

    def step(s: Column, ch: Column) -> Column:
        m = F.coalesce(F.try_element_at(mask, ch), F.lit(0).cast("long"))
        return (s + s.bitwiseAND(m)).bitwiseOR(s.bitwiseAND(F.bitwise_not(m))).bitwiseAND(full)

    return F.aggregate(b, full, step, lambda s: n - F.bit_count(s))


def _many_words(a: Column, b: Column) -> Column:
    starts = F.sequence(F.lit(0), F.size(a) - 1, F.lit(WORD))
    words = F.transform(starts, lambda s: let(F.least(s + WORD, F.size(a)), lambda e: F.struct(
        (_bit(e - s) - 1).alias("full"), _masks(a, s, e).alias("mask"))))

    def step(words: Column):
        def run(s: Column, ch: Column) -> Column:
            empty = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<long>").alias("out"))

            def add(acc: Column, w: Column) -> Column:
                old, m = F.get(s, w), F.coalesce(F.try_element_at(F.get(words, w)["mask"], ch), F.lit(0).cast("long"))
                return let(F.struct(old.alias("old"), m.alias("m"), (old + old.bitwiseAND(m) + acc["carry"]).alias("x")), lambda t: F.struct(
                    F.shiftright(t["x"], WORD).alias("carry"),
                    F.concat(acc["out"], F.array(t["x"].bitwiseOR(t["old"].bitwiseAND(F.bitwise_not(t["m"]))).bitwiseAND(F.get(words, w)["full"]))).alias("out")))

            return F.aggregate(F.sequence(F.lit(0), F.size(words) - 1), empty, add, lambda acc: acc["out"])
        return run

    return let(words, lambda ws: F.aggregate(b, F.transform(ws, lambda w: w["full"]), step(ws), lambda s: F.size(a) - F.aggregate(
        s, F.lit(0), lambda total, w: total + F.bit_count(w))))


def lcs(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two arrays of characters."""
    def of(p: Column) -> Column:
        n = F.size(p["s"])
        return (F.when(n == 0, F.lit(0))
                .when(n <= WORD, let(_masks(p["s"], F.lit(0), n), lambda m: _one_word(m, n, p["l"])))
                .otherwise(_many_words(p["s"], p["l"])))
    return let(F.struct(a.alias("a"), b.alias("b")), lambda t: let(F.when(F.size(t["a"]) <= F.size(t["b"]), F.struct(
        t["a"].alias("s"), t["b"].alias("l"))).otherwise(F.struct(t["b"].alias("s"), t["a"].alias("l"))), of))


def _share(distance: Column, total: Column) -> Column:
    return F.when(total == 0, F.lit(100.0)).otherwise(F.lit(100.0) * (total - distance) / total)


def _ratio(a: Column, b: Column) -> Column:
    return let(F.struct(a.alias("a"), b.alias("b")), lambda t: _share(
        F.size(t["a"]) + F.size(t["b"]) - 2 * lcs(t["a"], t["b"]), F.size(t["a"]) + F.size(t["b"])))


def _within(s: Column, l: Column) -> Column:
    """Highest ratio of s with a window of l, s no longer than l and not empty."""
    n = F.size(s)
    ends = F.sequence(F.lit(1), F.size(l) + n - 1)
    window = lambda e: F.slice(l, F.greatest(e - n, F.lit(0)) + 1, F.least(e, F.size(l)) - F.greatest(e - n, F.lit(0)))
    score = lambda common, w: F.lit(200.0) * common / (n + F.size(w))
    short = let(_masks(s, F.lit(0), n), lambda m: F.array_max(F.transform(ends, lambda e: let(window(e), lambda w: score(_one_word(m, n, w), w)))))
    return F.when(n <= WORD, short).otherwise(F.array_max(F.transform(ends, lambda e: let(window(e), lambda w: score(lcs(s, w), w)))))


def _partial(a: Column, b: Column) -> Column:
    def of(t: Column) -> Column:
        x, y = t["a"], t["b"]
        return (F.when((F.size(x) == 0) | (F.size(y) == 0), F.when(F.size(x) == F.size(y), F.lit(100.0)).otherwise(F.lit(0.0)))
                .when(F.size(x) < F.size(y), _within(x, y)).when(F.size(x) > F.size(y), _within(y, x))
                .otherwise(F.greatest(_within(x, y), _within(y, x))))
    return let(F.struct(a.alias("a"), b.alias("b")), of)


def ratio(a: Column, b: Column) -> Column:
    return _ratio(chars(a), chars(b))


def partial_ratio(a: Column, b: Column) -> Column:
    return _partial(chars(a), chars(b))


def _words(c: Column) -> Column:
    return F.sort_array(F.filter(F.split(c, r"(?U)\s+"), lambda w: w != ""))


def _joined(words: Column) -> Column:
    return F.array_join(words, " ")


def _token_set(both: Column, left: Column, right: Column) -> Column:
    """Of the words of both strings and those of one only."""
    size = lambda w: F.length(_joined(w))
    gap = F.when(F.size(both) > 0, F.lit(1)).otherwise(F.lit(0))
    def of(t: Column) -> Column:
        with_left, with_right = t["s"] + t["gap"] + t["a"], t["s"] + t["gap"] + t["b"]
        beyond = let(F.struct(chars(_joined(left)).alias("a"), chars(_joined(right)).alias("b")), lambda c: _share(
            t["a"] + t["b"] - 2 * lcs(c["a"], c["b"]), with_left + with_right))
        return (F.when(t["gap"] == 0, beyond).when((t["a"] == 0) | (t["b"] == 0), F.lit(100.0))
                .otherwise(F.greatest(beyond, _share(t["gap"] + t["a"], t["s"] + with_left), _share(t["gap"] + t["b"], t["s"] + with_right))))
    return let(F.struct(gap.alias("gap"), size(both).alias("s"), size(left).alias("a"), size(right).alias("b")), of)


def weighted_ratio(a: Column, b: Column) -> Column:
    def of(t: Column) -> Column:
        x, y, tx, ty = t["x"], t["y"], t["tx"], t["ty"]
        return let(F.struct(F.array_intersect(tx, ty).alias("both"), F.array_except(tx, ty).alias("left"), F.array_except(ty, tx).alias("right"),
                            (F.greatest(F.size(x), F.size(y)) / F.least(F.size(x), F.size(y))).alias("factor"), _ratio(x, y).alias("plain")), lambda w: scored(t, w))

    def scored(t: Column, w: Column) -> Column:
        in_order = (chars(_joined(t["tx"])), chars(_joined(t["ty"])))
        tokens = F.greatest(_ratio(*in_order), _token_set(w["both"], w["left"], w["right"]))
        some = F.when(F.size(w["both"]) > 0, F.lit(100.0)).otherwise(F.greatest(_partial(*in_order), _partial(chars(_joined(w["left"])), chars(_joined(w["right"])))))
        scale = F.when(w["factor"] <= 8, F.lit(0.9)).otherwise(F.lit(0.6))
        return (F.when(w["factor"] < 1.5, F.greatest(w["plain"], 0.95 * tokens))
                .otherwise(F.greatest(w["plain"], scale * _partial(t["x"], t["y"]), 0.95 * scale * some)))

    return let(F.struct(chars(a).alias("x"), chars(b).alias("y"), _words(a).alias("tx"), _words(b).alias("ty")), lambda t: F.when(
        t["x"].isNull() | t["y"].isNull(), F.lit(None).cast("double")).when((F.size(t["tx"]) == 0) | (F.size(t["ty"]) == 0), F.lit(0.0)).otherwise(of(t)))
