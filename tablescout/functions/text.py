"""Name normalisers as Column -> Column expressions.

Every function returns one expression, so Catalyst keeps the whole chain in a
single projection next to the scan; nothing here needs a Python worker.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column, functions as F

from tablescout.functions import vocabulary as V

SPACE = r"(?U)\s+"
SEPARATORS = r"[_\-/|;:.]+"


def _accent_table() -> tuple[str, str]:
    """Accented letters with their bare letters, then the combining marks.

    Derived from canonical decomposition. `translate` deletes characters that
    have no counterpart, so the marks at the end disappear.
    """
    src, dst, marks = [], [], []
    for code in range(0x80, 0x110000):
        if 0xD800 <= code < 0xE000:
            continue
        letter = chr(code)
        if unicodedata.category(letter) == "Mn":
            marks.append(letter)
            continue
        bare = "".join(x for x in unicodedata.normalize("NFD", letter)
                       if unicodedata.category(x) != "Mn")
        if bare != letter and len(bare) == 1:
            src.append(letter)
            dst.append(bare)
    return "".join(src + marks), "".join(dst)


_ACCENTED, _BARE = _accent_table()


def text(c) -> Column:
    """The column as a string, null read as the empty string."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(""))


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, SPACE, " "))


def strip_accents(c: Column) -> Column:
    return F.translate(c, _ACCENTED, _BARE)


def contains_any(c: Column, words) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words], F.lit(False))


def normalize_light(c) -> Column:
    """Lower case, no accents, single spaces; digits stay."""
    return squeeze(strip_accents(F.lower(text(c))))


join_key = normalize_light


def strip_trailing_number(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s*\p{Nd}+$", ""))


def name_norm(c) -> Column:
    return strip_trailing_number(normalize_light(c))


def group_id(c) -> Column:
    """Near-duplicate key: normal form without spaces, hyphens and underscores."""
    return F.regexp_replace(name_norm(c), r"[\s\-_]", "")


def split_roots(c: Column, roots=V.GLUED_ROOTS) -> Column:
    """Put spaces around glued word roots, longest root first.

    Names that contain no root (nearly all) skip the replacement chain.
    """
    out = c
    for root in sorted(roots, key=len, reverse=True):
        out = F.regexp_replace(out, f"(?<=[a-z])({root})(?=[a-z])", " $1 ")
        out = F.regexp_replace(out, f"(?<=[a-z])({root})$", " $1")
        out = F.regexp_replace(out, f"^({root})(?=[a-z])", "$1 ")
    return F.when(c.rlike("|".join(roots)), squeeze(out)).otherwise(squeeze(c))


def normalize_aggr(c) -> Column:
    return split_roots(name_norm(c))


def normalize_light_split(c) -> Column:
    return split_roots(normalize_light(c))


def split_camel(c: Column) -> Column:
    c = F.regexp_replace(c, r"(?<=[a-z0-9])(?=[A-Z])", " ")
    return F.regexp_replace(c, r"(?<=[A-Z])(?=[A-Z][a-z])", " ")


def normalize_name(c) -> Column:
    """Camel case and separators to spaces, one trailing number dropped."""
    s = strip_accents(F.lower(split_camel(text(c))))
    s = squeeze(F.regexp_replace(s, SEPARATORS, " "))
    s = F.regexp_replace(s, r"(?<=[a-z])(\p{Nd}+)$", " $1")
    s = F.regexp_replace(s, r"(?<=[a-z])(\p{Nd}+)(?=\s)", " $1 ")
    s = squeeze(s)
    return squeeze(F.regexp_replace(s, r"[\s_\-]*\p{Nd}+\s*$", ""))


def clean_name(c) -> Column:
    """Lower case with separators as spaces; accents stay."""
    return squeeze(F.regexp_replace(F.lower(text(c)), SEPARATORS, " "))


def base_entity(c) -> Column:
    s = clean_name(c)
    s = F.regexp_replace(s, r"\s+ict\p{Nd}*\s*$", "")
    s = F.regexp_replace(s, r"\s+(test|dummy|prueba|flag|ind|marca)\p{Nd}*\s*$", "")
    return F.trim(F.regexp_replace(s, r"\s+\p{Nd}+\s*$", ""))


def expand_abbreviations(c: Column, pairs=V.ABBREVIATIONS) -> Column:
    """Word-wise expansion in list order; identity entries need no work."""
    steps = [(a, b) for a, b in pairs if a != b]
    out = F.concat(F.lit(" "), c, F.lit(" "))
    for short, full in steps:
        out = F.regexp_replace(out, rf"(?U)\b{short}\b", full)
    return F.when(c.rlike("|".join(a for a, _ in steps)), squeeze(out)).otherwise(squeeze(c))


def clean_dotted(c) -> Column:
    """Letters, digits, underscore and dots only; lower case, no accents."""
    s = F.regexp_replace(text(c), r"(?U)[^\p{L}\p{N}_\s.]", " ")
    return squeeze(F.lower(strip_accents(s)))


def dotted_parts(clean: Column) -> Column:
    """Non-empty segments of a cleaned dotted name."""
    return F.filter(F.transform(F.split(clean, r"\."), lambda p: F.trim(p)), lambda p: p != "")


def fix_typo(c: Column, fixes=V.TYPO_FIXES) -> Column:
    key = F.trim(F.replace(F.coalesce(c, F.lit("")), F.lit("_"), F.lit(" ")))
    table = F.create_map(*[F.lit(x) for kv in fixes.items() for x in kv])
    return F.when(key.isin(list(fixes)), F.element_at(table, key)).otherwise(key)


def spoken_name(c) -> Column:
    return F.lower(F.trim(F.replace(text(c), F.lit("_"), F.lit(" "))))


def token_count(c: Column) -> Column:
    return F.when(c == "", F.lit(0)).otherwise(F.size(F.split(c, r"\s+")))


def has_trailing_number(c: Column) -> Column:
    return c.rlike(r"\p{Nd}+$").cast("int")


def numeric_features(c: Column) -> dict[str, Column]:
    """Length, tokens, digits and one 0/1 flag per keyword or suffix pattern."""
    out = {
        "longitud": F.length(c),
        "n_tokens": token_count(c),
        "tiene_digito": c.rlike(r"\p{Nd}").cast("int"),
        "n_digitos": F.regexp_count(c, F.lit(r"\p{Nd}")),
    }
    for key, pattern in V.KEYWORD_FLAGS + V.SUFFIX_FLAGS:
        out[f"rgx_{key}"] = c.rlike("(?U)" + pattern).cast("int")
    return out


def has_description(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.rlike(c, F.lit(r"(?U)\S")), F.lit(False))


def is_metadata_name(c) -> Column:
    return clean_name(c).rlike("(?U)" + "|".join(V.METADATA_QUALIFIERS))


def truthy(c: Column, dialect: str) -> Column:
    """One of the five ways the feeding systems spell a positive label."""
    words = V.TRUTHY_WORDS[dialect]
    value = text(c)
    if dialect in ("gold", "prepared"):
        value = F.trim(value) if dialect == "gold" else value
    return (value if dialect == "verdict" else F.upper(value)).isin(words)


def number_token(c) -> Column:
    return F.regexp_replace(text(c), r"\p{Nd}+", "<num>")
