"""Rule lists turned into single column expressions.

A rule list is plain data: (entity, patterns[, anti patterns]). Patterns of one
entity are merged into one alternation, so a row costs one regex test per
entity at most, and the `when` chain stops at the first hit.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F

from tablescout.functions import text as T, vocabulary as V


def _alternation(patterns, ignore_case: bool) -> str:
    return ("(?i)" if ignore_case else "") + "(?U)" + "|".join(patterns)


def _literal_words(words) -> str:
    """Words as one alternation, so a key is looked at once per rule."""
    return "|".join(re.escape(w).replace("\\ ", " ") for w in words)


def _chain(pairs, default: Column) -> Column:
    """First true condition wins."""
    (cond, value), *rest = pairs
    out = F.when(cond, value)
    for cond, value in rest:
        out = out.when(cond, value)
    return out.otherwise(default)


def first_match(name: Column, rules=V.ENTITY_RULES, guard: Column | None = None,
                ignore_case: bool = True, default: str | None = V.OTHER_PII) -> Column:
    """Ordered rules, first match wins; null where the guard is false."""
    pairs = [(name.rlike(_alternation(p, ignore_case)), F.lit(e)) for e, p in rules]
    out = _chain(pairs, F.lit(default).cast("string"))
    return out if guard is None else F.when(guard, out)


def all_matches(name: Column, rules=V.ENTITY_RULES) -> Column:
    """Every entity whose patterns hit, in rule order."""
    return F.array_compact(F.array(*[
        F.when(name.rlike(_alternation(p, True)), F.lit(e)) for e, p in rules]))


def match_summary(matches: Column) -> Column:
    """No match: null; one: its entity; more: the ambiguity marker."""
    return (F.when(F.size(matches) == 1, F.element_at(matches, 1))
            .when(F.size(matches) > 1, F.lit(V.AMBIGUOUS)))


def keyword_match(key: Column, rules, normalize_patterns: bool = False,
                  allowed: list[str] | None = None, other_than: Column | None = None) -> Column:
    """First entity with a positive substring and no anti substring, else null.

    `other_than` skips rules whose entity equals that column.
    """
    fix = (lambda w: w.replace("_", " ")) if normalize_patterns else (lambda w: w)
    pairs = []
    for entity, positive, *anti in rules:
        if allowed is not None and entity not in allowed:
            continue
        cond = key.rlike(_literal_words([fix(w) for w in positive]))
        if anti and anti[0]:
            cond = cond & ~key.rlike(_literal_words([fix(w) for w in anti[0]]))
        if other_than is not None:
            cond = cond & ~F.coalesce(other_than == entity, F.lit(False))
        pairs.append((cond, F.lit(entity)))
    return _chain(pairs, F.lit(None).cast("string")) if pairs else F.lit(None).cast("string")


def padded(*cols: Column) -> Column:
    """Cells joined by spaces with a space on both ends."""
    out = [F.lit(" ")]
    for c in cols:
        out += [c, F.lit(" ")]
    return F.concat(*out)


def spaced(c: Column) -> Column:
    return F.replace(F.coalesce(c, F.lit("")), F.lit("_"), F.lit(" "))


def label_by_rules(flat: Column, rules=V.LABELLING_RULES) -> tuple[Column, Column]:
    """(entity, matched patterns) of a padded normal form; empty strings where no rule applies."""
    entity_pairs, motive_pairs = [], []
    for entity, positive, anti in rules:
        cond = flat.rlike(_alternation(positive, False))
        if anti:
            cond = cond & ~flat.rlike(_alternation(anti, False))
        hits = F.array_compact(F.array(*[
            F.when(flat.rlike("(?U)" + p), F.lit(p)) for p in positive]))
        entity_pairs.append((cond, F.lit(entity)))
        motive_pairs.append((cond, F.array_join(hits, ",")))
    return _chain(entity_pairs, F.lit("")), _chain(motive_pairs, F.lit(""))


def is_system_field(full: Column, last: Column) -> Column:
    listed = full.isin(V.SYSTEM_FIELDS) | last.isin(V.SYSTEM_FIELDS)
    return listed & ~T.contains_any(full, V.SYSTEM_FIELD_GUARDS)


def is_exact_key(fixed_full: Column, fixed_last: Column) -> Column:
    """Both arguments with typos fixed (text.fix_typo)."""
    return fixed_full.isin(V.EXACT_KEYS) | fixed_last.isin(V.EXACT_KEYS)


def focus_tags(norm: Column) -> Column:
    hits = F.array_compact(F.array(*[
        F.when(norm.rlike("(?U)" + p), F.lit(p)) for p in V.FOCUS_PATTERNS]))
    return F.when(F.size(hits) == 0, F.lit("otra")).otherwise(F.array_join(hits, ","))


def tier_of(entity: Column) -> Column:
    pairs = [(entity.isin(members), F.lit(tier)) for tier, members in V.TIERS.items()]
    return _chain(pairs, F.lit(V.TIER_UNKNOWN))


def canonical_entity(word: Column, blob: Column, by_keyword: Column) -> tuple[Column, Column]:
    """(canonical entity, how it was found): dictionary, keywords, fallback."""
    table = F.create_map(*[F.lit(x) for kv in V.CANONICAL_EXACT.items() for x in kv])
    exact = word.isin(list(V.CANONICAL_EXACT))
    number = word.isin(V.CANONICAL_NUMBER_WORDS) & blob.contains("num")
    canon = (F.when(exact, F.element_at(table, word))
             .when(by_keyword.isNotNull(), by_keyword)
             .when(number, F.lit("numero")).otherwise(F.lit("otros")))
    method = (F.when(exact, F.lit("exact"))
              .when(by_keyword.isNotNull(), F.lit("exemplar"))
              .otherwise(F.lit("fallback")))
    return canon, method


def search_filter(cols: list[Column], query: str, only_pii: Column | None = None) -> Column:
    """Case-insensitive substring in any of the columns, optionally PII rows only."""
    q = query.strip().lower()
    hit = F.lit(True) if not q else reduce(
        lambda a, b: a | b,
        [F.lower(F.coalesce(c, F.lit(""))).contains(q) for c in cols])
    return hit if only_pii is None else hit & only_pii
