"""Expression text for the DuckDB side of the checks.

The fixed value lists are shared with the library; the formulas are written a
second time, in SQL, so that a wrong formula on either side shows.
"""

from __future__ import annotations

from tablescout.functions import vocabulary as V

WS = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
W = r"\p{L}\p{N}_"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strs(items) -> str:
    return ", ".join(q(x) for x in items)


def txt(x):
    return f"coalesce(CAST({x} AS VARCHAR), '')"


def rep(x, pattern, to, g=True):
    return f"regexp_replace({x}, {q(pattern)}, {q(to)}{', ' + q('g') if g else ''})"


def squeeze(x):
    return f"trim({rep(x, WS + '+', ' ')})"


def light(x):
    return squeeze(f"strip_accents(lower({txt(x)}))")


def untrail(x):
    return f"trim({rep(x, r'\s*\p{Nd}+$', '', False)})"


def norm(x):
    return untrail(light(x))


def gid(x):
    return rep(norm(x), r"[\s\-_]", "")


def roots(x):
    out = x
    for r in sorted(V.GLUED_ROOTS, key=len, reverse=True):
        for _ in range(2):
            out = rep(out, f"([a-z])({r})([a-z])", r"\1 \2 \3")
        out = rep(out, f"([a-z])({r})$", r"\1 \2", False)
        out = rep(out, f"^({r})([a-z])", r"\1 \2", False)
    return squeeze(out)


def camel(x):
    return rep(rep(x, "([a-z0-9])([A-Z])", r"\1 \2"), "([A-Z])([A-Z][a-z])", r"\1 \2")


def name3(x):
    s = f"strip_accents(lower({camel(txt(x))}))"
    s = squeeze(rep(s, r"[_\-/|;:.]+", " "))
    s = rep(s, r"([a-z])(\p{Nd}+)$", r"\1 \2", False)
    s = rep(s, r"([a-z])(\p{Nd}+)(\s)", r"\1 \2 \3")
    return squeeze(rep(squeeze(s), r"[\s_\-]*\p{Nd}+\s*$", "", False))


def clean(x):
    return squeeze(rep(f"lower({txt(x)})", r"[_\-/|;:.]+", " "))


def base(x):
    s = rep(clean(x), r"\s+ict\p{Nd}*\s*$", "", False)
    s = rep(s, r"\s+(test|dummy|prueba|flag|ind|marca)\p{Nd}*\s*$", "", False)
    return f"trim({rep(s, r'\s+\p{Nd}+\s*$', '', False)})"


def expand(x):
    s = f"' ' || {x} || ' '"
    for a, b in V.ABBREVIATIONS:
        if a != b:
            for _ in range(2):
                s = rep(s, f"(^|[^{W}]){a}($|[^{W}])", rf"\1{b}\2")
    return squeeze(s)


def dotted(x):
    return squeeze(f"lower(strip_accents({rep(txt(x), '[^' + W + '.' + WS[1:], ' ')}))")


def parts(clean_expr):
    return f"list_filter(list_transform(string_split({clean_expr}, '.'), lambda p: trim(p)), lambda p: p <> '')"


def full(x):
    return f"CASE WHEN len({parts(dotted(x))}) > 0 THEN array_to_string({parts(dotted(x))}, ' ') ELSE {dotted(x)} END"


def last(x):
    return f"CASE WHEN len({parts(dotted(x))}) > 0 THEN {parts(dotted(x))}[-1] ELSE {dotted(x)} END"


def typo(x):
    k = f"trim(replace(coalesce({x}, ''), '_', ' '))"
    arms = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in V.TYPO_FIXES.items())
    return f"CASE {k} {arms} ELSE {k} END"


def tokens(x):
    return f"CASE WHEN {x} = '' THEN 0 ELSE len(string_split_regex({x}, '\\s+')) END"


def bound(p: str) -> str:
    """A pattern with word boundaries, spelled for an engine with ASCII-only ones."""
    pre = p.startswith(r"\b")
    core = p[2:] if pre else p
    post = core.endswith(r"\b")
    core = core[:-2] if post else core
    return (f"(?:^|[^{W}])" if pre else "") + core + (f"(?:$|[^{W}])" if post else "")


def match(x, patterns, nocase=False):
    return f"regexp_matches({x}, {q(('(?i)' if nocase else '') + '|'.join(bound(p).replace(chr(92) + 'd', chr(92) + 'p{Nd}') for p in patterns))})"


def first_match(x, rules=V.ENTITY_RULES, nocase=True, default=q(V.OTHER_PII)):
    return "CASE " + " ".join(f"WHEN {match(x, p, nocase)} THEN {q(e)}" for e, p in rules) + f" ELSE {default} END"


def matches(x, rules=V.ENTITY_RULES):
    cells = ", ".join(f"CASE WHEN {match(x, p, True)} THEN {q(e)} END" for e, p in rules)
    return f"list_filter([{cells}], lambda m: m IS NOT NULL)"


def summary(m):
    return f"CASE WHEN len({m}) = 1 THEN {m}[1] WHEN len({m}) > 1 THEN {q(V.AMBIGUOUS)} END"


def any_of(x, words):
    return "(" + " OR ".join(f"contains({x}, {q(w)})" for w in words) + ")" if words else "false"


def keyword(x, rules, spaced=False, allowed=None, other_than=None):
    fix = (lambda w: w.replace("_", " ")) if spaced else (lambda w: w)
    arms = []
    for e, pos, *anti in rules:
        if allowed is not None and e not in allowed:
            continue
        cond = any_of(x, [fix(w) for w in pos])
        if anti and anti[0]:
            cond += f" AND NOT {any_of(x, [fix(w) for w in anti[0]])}"
        if other_than:
            cond += f" AND NOT coalesce({other_than} = {q(e)}, false)"
        arms.append(f"WHEN {cond} THEN {q(e)}")
    return "CASE " + " ".join(arms) + " END"


def h32(x):
    return f"CAST(('0x' || substr(md5(CAST({x} AS VARCHAR)), 1, 8)) AS BIGINT)"


def tier(x):
    return "CASE " + " ".join(f"WHEN {x} IN ({strs(m)}) THEN {q(t)}" for t, m in V.TIERS.items()) + f" ELSE {q(V.TIER_UNKNOWN)} END"


def truthy(x, dialect):
    v = txt(x)
    if dialect == "gold":
        v = f"trim({v})"
    return f"{v if dialect == 'verdict' else f'upper({v})'} IN ({strs(V.TRUTHY_WORDS[dialect])})"


def bucket_of(x):
    return f"CASE WHEN {x} >= 90 THEN {q(V.BUCKET_STRONG)} WHEN {x} >= 50 THEN {q(V.BUCKET_PARTIAL)} ELSE {q(V.BUCKET_NONE)} END"


def months(past, ref):
    return (f"greatest(coalesce((year({ref}) - year({past})) * 12 + month({ref}) - month({past}) "
            f"- CASE WHEN day({ref}) < day({past}) THEN 1 ELSE 0 END, 0), 0)")


def ratio(a, b):
    return f"CASE WHEN ({b}) > 0 THEN CAST({a} AS DOUBLE) / ({b}) ELSE 0.0 END"


def grams(src: str, key: str, text: str, lo=2, hi=4, name="grams") -> str:
    """CTEs <name>_w and <name>: (key, g), one row per gram occurrence."""
    ns = ", ".join(f"({n})" for n in range(lo, hi + 1))
    return f"""{name}_w AS (SELECT {key} AS k, ' ' || w || ' ' AS w FROM
  (SELECT {key}, unnest(string_split_regex(lower({text}), {q(WS + '+')})) AS w FROM {src}) WHERE w <> ''),
{name} AS (SELECT k, substr(w, i, n) AS g FROM
  (SELECT k, w, n, unnest(generate_series(1, greatest(length(w) - n + 1, 1))) AS i
   FROM {name}_w, (VALUES {ns}) v(n) WHERE n = {lo} OR length(w) > n - 1))"""


def vectors(grams_name: str, docs: str, name="vec") -> str:
    """CTE <name>: (k, g, df, w) unit-length vectors over (k, g) occurrences."""
    return f"""{name}_tf AS (SELECT k, g, CAST(count(*) AS DOUBLE) AS tf FROM {grams_name} GROUP BY k, g),
{name}_df AS (SELECT g, count(*) AS df, ln((1 + (SELECT count(*) FROM {docs})) / CAST(1 + count(*) AS DOUBLE)) + 1 AS idf FROM {name}_tf GROUP BY g),
{name}_raw AS (SELECT k, g, df, tf * idf AS w FROM {name}_tf JOIN {name}_df USING (g)),
{name}_n AS (SELECT k, sqrt(sum(w * w)) AS norm FROM {name}_raw GROUP BY k),
{name} AS (SELECT k, g, df, w / norm AS w FROM {name}_raw JOIN {name}_n USING (k))"""


def fill(sql: str, **slots: str) -> str:
    """Replace @NAME@ marks; braces stay free for regular expressions."""
    for k, v in slots.items():
        sql = sql.replace(f"@{k}@", v)
    return sql
