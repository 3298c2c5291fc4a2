"""The named queries again as DuckDB SQL, for an independent check.

Scores use a bit-parallel longest common subsequence over lists; the match
scores every pair of names that can reach 90, found by edit distance, shared
tokens or containment over the full product of names.
"""

from __future__ import annotations

from ..functions import catalogue
from ..functions.text import WHITESPACE
from . import people
from .queries import DECISION_MAKERS, DIGITS, INSURERS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(map(_text, values)) + "]"


def _pick(values: list[str], index: str) -> str:
    return f"({_list(values)})[(({index}) % {len(values)} + 1)::INT]"


def _last(key: str) -> str:
    mixed = f"((({key}) * 48271) % {people.NAME_SPACE})"
    return " || ".join(_pick(people.SYLLABLES, f"{mixed} // {20**i}") for i in range(4))


def _first(key: str) -> str:
    return _pick(people.FIRST_NAMES, f"({key}) * 7")


def _strip(value: str) -> str:
    return f"trim({value}, {_text(WHITESPACE)})"


def _name(last: str, first: str) -> str:
    return f"{_strip(f'upper({last})')} || ', ' || {_strip(first)}"


def _registrant_last(key: str) -> str:
    own = _last(key)
    return f"""CASE WHEN {key} % 4 = 1 THEN substring({own}, 1, 2) || substring({own}, 4)
        WHEN {key} % 4 = 2 THEN '  ' || upper(substring({own}, 1, 1)) || substring({own}, 2) || chr(160)
        WHEN {key} % 4 = 3 THEN {_last(f"{key} + {people.STRANGER}")} ELSE {own} END"""


def _named_as() -> str:
    return f"(CASE WHEN s_suppkey % 10 = 0 THEN s_suppkey ELSE s_suppkey + {people.SUPPLIER_SHIFT} END)"


PEOPLE = f"""
connections_raw AS (
  SELECT {_first("o_custkey")} AS "First Name",
    CASE WHEN o_custkey % 97 <> 0 THEN {_last("o_custkey")} END AS "Last Name",
    'p' || o_custkey || '@example.org' AS "Email Address",
    {_pick(people.COMPANIES, "o_custkey")} AS "Company",
    CASE WHEN o_custkey % 41 <> 0 THEN {_pick(people.TITLES, "o_custkey")} END AS "Position",
    'https://example.org/in/' || o_custkey AS "URL",
    o_orderkey AS source_row
  FROM orders),
connections AS (
  SELECT "First Name", "Last Name", "Email Address", "Company", "Position", "URL",
    {_name('"Last Name"', '"First Name"')} AS "Name", min(source_row) AS source_row
  FROM connections_raw WHERE "Last Name" IS NOT NULL GROUP BY ALL),
congress AS (
  SELECT upper({_last(_named_as())}) || ', ' || {_first(_named_as())} AS "Name",
    {_strip(_pick(people.TITLES, "s_suppkey"))} AS "Position",
    {_pick(people.COMPANIES, "s_suppkey + 3")} AS "Company", s_suppkey AS source_row
  FROM supplier),
united AS (
  SELECT *, 0 AS source FROM connections UNION ALL BY NAME SELECT *, 1 AS source FROM congress),
contacts AS (
  SELECT * EXCLUDE (source, source_row),
    row_number() OVER (ORDER BY source, source_row) - 1 AS contact_pos
  FROM united),
registrants_raw AS (
  SELECT 'r' || c_custkey || '@example.org' AS "Email", {_registrant_last("c_custkey")} AS "Nom",
    {_first("c_custkey")} AS "Prénom", c_mktsegment AS "Company",
    {_pick(people.TITLES, "c_custkey + 5")} AS "Job title"
  FROM customer),
registrants AS (
  SELECT "Email", {_name('"Nom"', '"Prénom"')} AS "Name", "Company", "Job title" FROM registrants_raw)"""

PAIRS = f"""
pairs AS (
  SELECT o_orderkey AS pair, {_name(_last("o_custkey"), _first("o_custkey"))} AS a,
    CASE o_orderkey % 4
      WHEN 0 THEN {_name(_registrant_last("o_custkey"), _first("o_custkey"))}
      WHEN 1 THEN {_name(_last("o_orderkey"), _first("o_custkey"))}
      WHEN 2 THEN {_first("o_custkey")} || ' ' || upper({_last("o_custkey")}) || ','
      ELSE upper(substring({_last("o_custkey")}, 1, 6)) END AS b
  FROM orders)"""


# --- scores ----------------------------------------------------------------------------


def _common(source: str, name: str) -> str:
    """CTEs giving ``name(u, v, lcs)`` for the distinct text pairs of ``source(u, v)``."""
    bits = "list_transform(range(1, len(cu) + 1), lambda i: CASE WHEN cu[i] = ch THEN 1::BIGINT << (i - 1)::INT ELSE 0 END)"
    full = "((1::BIGINT << len(cu)::INT) - 1)"
    step = f"(((v1 + (v1 & m)) | (v1 - (v1 & m))) & {full})"
    return f"""
{name}_chars AS (SELECT u, v, string_split(u, '') AS cu, string_split(v, '') AS cv
  FROM (SELECT DISTINCT u, v FROM {source} WHERE u <> '' AND v <> '')),
{name}_masks AS (SELECT u, v, cu, list_transform(cv, lambda ch: list_sum({bits})::BIGINT) AS masks FROM {name}_chars),
{name} AS (SELECT u, v, length(u) - bit_count(list_reduce(masks, lambda v1, m: {step}, {full})) AS lcs FROM {name}_masks
  UNION ALL SELECT u, v, 0 FROM (SELECT DISTINCT u, v FROM {source} WHERE u = '' OR v = ''))"""


def _ratio(u: str, v: str, lcs: str) -> str:
    total = f"(length({u}) + length({v}))"
    return f"(CASE WHEN {total} = 0 THEN 100.0 ELSE (1.0::DOUBLE - ({total} - 2 * {lcs}) / {total}::DOUBLE) * 100.0 END)"


_WORDS = "list_sort(list_filter(string_split_regex({}, '\\s+'), lambda x: x <> ''))"

FORMS = f"""
forms AS (
  SELECT a, b, array_to_string(wa, ' ') AS sa, array_to_string(wb, ' ') AS sb,
    array_to_string(shared, ' ') AS shared, len(shared) AS n_shared, len(oa) AS n_oa, len(ob) AS n_ob,
    array_to_string(oa, ' ') AS oa, array_to_string(ob, ' ') AS ob,
    array_to_string(list_concat(shared, oa), ' ') AS ia, array_to_string(list_concat(shared, ob), ' ') AS ib,
    greatest(length(a), length(b)) / least(length(a), length(b))::DOUBLE AS spread
  FROM (SELECT *, list_filter(ka, lambda x: list_contains(kb, x)) AS shared,
      list_filter(ka, lambda x: NOT list_contains(kb, x)) AS oa,
      list_filter(kb, lambda x: NOT list_contains(ka, x)) AS ob
    FROM (SELECT *, list_sort(list_distinct(wa)) AS ka, list_sort(list_distinct(wb)) AS kb
      FROM (SELECT a, b, {_WORDS.format("a")} AS wa, {_WORDS.format("b")} AS wb FROM (SELECT DISTINCT a, b FROM candidates)))))"""

TOKEN_SCORES = f"""{FORMS},
texts AS (SELECT a AS u, b AS v FROM forms UNION SELECT sa, sb FROM forms UNION SELECT ia, ib FROM forms
  UNION SELECT shared, ia FROM forms UNION SELECT shared, ib FROM forms),
{_common("texts", "common")},
scored AS (
  SELECT f.*, {_ratio("f.a", "f.b", "p.lcs")} AS plain, {_ratio("f.sa", "f.sb", "s.lcs")} AS token_sort,
    CASE WHEN n_shared > 0 AND (n_oa = 0 OR n_ob = 0) THEN 100.0
      WHEN n_shared = 0 THEN {_ratio("ia", "ib", "i.lcs")}
      ELSE greatest({_ratio("ia", "ib", "i.lcs")}, {_ratio("f.shared", "ia", "l.lcs")}, {_ratio("f.shared", "ib", "r.lcs")})
    END AS token_set
  FROM forms f JOIN common p ON p.u = f.a AND p.v = f.b JOIN common s ON s.u = f.sa AND s.v = f.sb
    JOIN common i ON i.u = f.ia AND i.v = f.ib JOIN common l ON l.u = f.shared AND l.v = f.ia
    JOIN common r ON r.u = f.shared AND r.v = f.ib)"""

_WINDOWS = """
{name}_sides AS (SELECT DISTINCT x, y, needle, hay FROM (
  SELECT {x} AS x, {y} AS y, CASE WHEN length({x}) <= length({y}) THEN {x} ELSE {y} END AS needle,
    CASE WHEN length({x}) <= length({y}) THEN {y} ELSE {x} END AS hay FROM {source}
  UNION ALL SELECT {x}, {y}, {y}, {x} FROM {source} WHERE length({x}) = length({y}))),
{name}_cuts AS (SELECT x, y, needle AS u, unnest(list_distinct(list_concat(
    list_transform(range(1, length(hay) + 1), lambda e: substring(hay, greatest(1, e - length(needle) + 1)::BIGINT, least(e, length(needle))::BIGINT)),
    list_transform(range(length(hay) - length(needle) + 2, length(hay) + 1), lambda s: substring(hay, s::BIGINT))))) AS v
  FROM {name}_sides),
{common},
{name} AS (SELECT c.x, c.y, max({ratio}) AS score FROM {name}_cuts c JOIN {name}_lcs k ON k.u = c.u AND k.v = c.v GROUP BY c.x, c.y)"""


def _partial(source: str, x: str, y: str, name: str) -> str:
    return _WINDOWS.format(
        source=source, x=x, y=y, name=name, common=_common(f"{name}_cuts", f"{name}_lcs"),
        ratio=_ratio("c.u", "c.v", "k.lcs"),
    )


_CANDIDATE_PAIRS = "candidates AS (SELECT DISTINCT a, b FROM pairs)"
_ROUND = f"round({{}}, {DIGITS})"


def _score_check(expression: str) -> str:
    return f"""WITH {PAIRS}, {_CANDIDATE_PAIRS}, {TOKEN_SCORES}
SELECT pair, {_ROUND.format(expression)} AS score FROM pairs JOIN scored USING (a, b)"""


_PARTIALS = f"""{TOKEN_SCORES}, {_partial("forms", "a", "b", "inside")}, {_partial("forms", "sa", "sb", "tokens_inside")},
{_partial("forms", "oa", "ob", "own_inside")},
all_scores AS (SELECT f.*, i.score AS part,
    CASE WHEN n_shared > 0 THEN 100.0 ELSE greatest(t.score, o.score) END AS part_token
  FROM scored f JOIN inside i ON i.x = f.a AND i.y = f.b JOIN tokens_inside t ON t.x = f.sa AND t.y = f.sb
    LEFT JOIN own_inside o ON o.x = f.oa AND o.y = f.ob)"""


def _partial_check(expression: str) -> str:
    return f"""WITH {PAIRS}, {_CANDIDATE_PAIRS}, {_PARTIALS}
SELECT pair, {_ROUND.format(expression)} AS score FROM pairs JOIN all_scores USING (a, b)"""


_NEAR_SCORE = "greatest(plain, 0.95 * greatest(token_sort, token_set))"
_WEIGHT = "(CASE WHEN spread <= 8 THEN 0.9 ELSE 0.6 END)"
_WEIGHTED = f"""CASE WHEN spread < 1.5 THEN {_NEAR_SCORE}
  ELSE greatest(plain, {_WEIGHT} * part, 0.95 * {_WEIGHT} * part_token) END"""


# --- match -----------------------------------------------------------------------------


_NAMES = """
r AS (SELECT DISTINCT "Name" AS a FROM registrants WHERE "Name" <> ''),
c AS (SELECT "Name" AS b, min(contact_pos) AS pos FROM contacts WHERE "Name" <> '' GROUP BY "Name")"""

_TOP = """
top AS (SELECT a, b, score, pos FROM best JOIN c USING (b) WHERE score >= {cutoff}
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, pos) = 1),
matched AS (SELECT r0."Name" AS "Name registrant", top.b AS "Name fuzzy matched", score AS "Score", pos AS "Index"
  FROM registrants r0 LEFT JOIN top ON top.a = r0."Name")"""


def _match(cutoff: float) -> str:
    """CTEs up to ``matched``; every pair that can score 90 or more is a candidate."""
    plain_a, plain_b = "strip_accents(a)", "strip_accents(b)"
    return f"""WITH {PEOPLE},{_NAMES},
rw AS (SELECT a, strip_accents(array_to_string({_WORDS.format("a")}, ' ')) AS ta FROM r),
cw AS (SELECT b, strip_accents(array_to_string({_WORDS.format("b")}, ' ')) AS tb FROM c),
rt AS (SELECT a, unnest({_WORDS.format("a")}) AS word FROM r),
ct AS (SELECT b, unnest({_WORDS.format("b")}) AS word FROM c),
candidates AS (
  SELECT a, b FROM rw, cw WHERE levenshtein({plain_a}, {plain_b}) <= 0.1 * (length(a) + length(b)) + 1e-9
    OR levenshtein(ta, tb) <= 0.06 * (length(ta) + length(tb))
  UNION SELECT a, b FROM rt JOIN ct USING (word)
  UNION SELECT a, b FROM r, c WHERE contains(a, b) OR contains(b, a)),
{TOKEN_SCORES},
best AS (
  SELECT a, b, CASE WHEN spread < 1.5 THEN {_NEAR_SCORE}
    WHEN spread <= 8 AND (contains(a, b) OR contains(b, a)) THEN greatest(plain, 90.0) ELSE plain END AS score
  FROM scored),{_TOP.format(cutoff=cutoff)}"""


def _loose_match(cutoff: float) -> str:
    """The same for lower cutoffs: all pairs, but for those with too few characters in common, whatever their order, and no token."""
    counts = "list_transform(chars, lambda x: length({0}) - length(replace({0}, x, '')))"
    share, shortest = cutoff / 100, "least(length(a), length(b))"
    return f"""WITH {PEOPLE},{_NAMES},
letters AS (SELECT list(DISTINCT ch) AS chars FROM (
  SELECT unnest(string_split(a, '')) AS ch FROM r UNION ALL SELECT unnest(string_split(b, '')) FROM c)),
rc AS (SELECT a, {counts.format("a")} AS na, {_WORDS.format("a")} AS wa FROM r, letters),
cc AS (SELECT b, {counts.format("b")} AS nb, {_WORDS.format("b")} AS wb FROM c, letters),
crossed AS (
  SELECT a, b, wa, wb, list_sum(list_transform(list_zip(na, nb), lambda z: least(z[1], z[2]))) AS common FROM rc, cc),
candidates AS (
  SELECT a, b FROM crossed WHERE len(list_filter(wa, lambda x: list_contains(wb, x))) > 0
    OR common >= {share} * CASE WHEN greatest(length(a), length(b)) < 1.5 * {shortest} THEN (length(a) + length(b)) / 2.0
      ELSE {shortest} END - 1e-6),
{TOKEN_SCORES},
far AS (SELECT * FROM forms WHERE spread >= 1.5 AND spread <= 8), {_partial("far", "a", "b", "inside")},
{_partial("far", "sa", "sb", "tokens_inside")},
best AS (
  SELECT s.a, s.b, CASE WHEN spread < 1.5 THEN {_NEAR_SCORE}
    ELSE greatest(plain, 0.9 * coalesce(i.score, 0), 0.855 * CASE WHEN n_shared > 0 THEN 100.0 ELSE coalesce(t.score, 0) END)
    END AS score
  FROM scored s LEFT JOIN inside i ON i.x = s.a AND i.y = s.b LEFT JOIN tokens_inside t ON t.x = s.sa AND t.y = s.sb
  WHERE spread <= 8),{_TOP.format(cutoff=cutoff)}"""


def _match_check(cutoff: float) -> str:
    return f"""{_match(cutoff) if cutoff >= 90 else _loose_match(cutoff)}
SELECT "Name registrant", "Name fuzzy matched", {_ROUND.format('"Score"')} AS "Score", "Index" FROM matched"""


# --- classifiers -----------------------------------------------------------------------


def _pattern(words: list[str], free: list[str]) -> str:
    edge = r"[^\p{L}\p{N}_]"
    text = "|".join([f"(^|{edge})({'|'.join(words)})({edge}|$)", *free])
    return _text(text.replace("[\\s\\-]", "[\\s-]"))


def _searches(value: str, words: list, free: dict) -> str:
    return " ".join(
        f"WHEN regexp_matches({value}, {_pattern(w, free.get(c, []))}, 'i') THEN {_text(c)}" for c, w in words
    )


def _position(value: str) -> str:
    return f"""CASE WHEN {value} IS NULL OR {_strip(value)} = '' THEN ''
  {_searches(value, catalogue.POSITION_WORDS, catalogue.POSITION_FREE)} ELSE {_text(catalogue.POSITION_DEFAULT)} END"""


def _company(value: str) -> str:
    folded = f"lower({_strip(value)})"
    exact = " ".join(f"WHEN list_contains({_list(n)}, {folded}) THEN {_text(c)}" for c, n in catalogue.KNOWN_COMPANIES)
    partial = " ".join(
        f"WHEN len(list_filter({_list(n)}, lambda k: contains({folded}, k) OR contains(k, {folded}))) > 0 THEN {_text(c)}"
        for c, n in catalogue.KNOWN_COMPANIES
    )
    return f"""CASE WHEN {value} IS NULL OR {_strip(value)} = '' THEN '' {exact} {partial}
  {_searches(value, catalogue.COMPANY_WORDS, {})} ELSE {_text(catalogue.COMPANY_DEFAULT)} END"""


# --- audience --------------------------------------------------------------------------


def _audience(on: str = 'k."Name" = m."Name fuzzy matched"') -> str:
    return f"""{_match(90.0)},
audience AS (SELECT k."Name", m."Name registrant", k."URL", k."Email Address", k."Company",
    {_strip('k."Position"')} AS "Position" FROM contacts k JOIN matched m ON {on})"""


def _classified() -> str:
    position, company = "coalesce(\"Position\", 'nan')", "coalesce(\"Company\", 'nan')"
    return f"""{_audience()},
classified AS (SELECT *, {_position(position)} AS "Category_position", {_company(company)} AS "Category_company" FROM audience)"""


def _filtered(positions: list[str] | None, companies: list[str] | None) -> str:
    tests = ["true"]
    if positions is not None:
        tests.append(f'list_contains({_list(positions)}, "Category_position")')
    if companies is not None:
        tests.append(f'list_contains({_list(companies)}, "Category_company")')
    return f"{_classified()} SELECT * FROM classified WHERE {' AND '.join(tests)}"


CHECKS: dict[str, str] = {
    "build_name": f'WITH {PEOPLE} SELECT "Email", "Name" FROM registrants',
    "strip_unicode": f'WITH {PEOPLE} SELECT "Email", {_strip(chr(34) + "Nom" + chr(34))} AS stripped FROM registrants_raw',
    "registrants_fr": f'WITH {PEOPLE} SELECT * FROM registrants',
    "registrants_en": f'WITH {PEOPLE} SELECT "Email", "Name", "Company", "Job title" AS "Position" FROM registrants',
    "connections_normalize": f"WITH {PEOPLE} SELECT * FROM connections",
    "congress_normalize": f"WITH {PEOPLE} SELECT * FROM congress",
    "build_contacts": f"WITH {PEOPLE} SELECT * FROM contacts",
    "ratio": _score_check("plain"),
    "token_sort_ratio": _score_check("token_sort"),
    "token_set_ratio": _score_check("token_set"),
    "token_ratio": _score_check("greatest(token_sort, token_set)"),
    "partial_ratio": _partial_check("part"),
    "partial_token_ratio": _partial_check("part_token"),
    "weighted_ratio": _partial_check(_WEIGHTED),
    "fuzzy_match_exact": _match_check(100.0),
    "fuzzy_match_95": _match_check(95.0),
    "fuzzy_match_90": _match_check(90.0),
    "fuzzy_match_80": _match_check(80.0),
    "enrich_by_name": f"{_audience()} SELECT * FROM audience",
    "enrich_by_position": f"""{_audience('k.contact_pos = m."Index"')} SELECT * FROM audience""",
    "enrich_classified": f"{_classified()} SELECT * FROM classified",
    "classify_position": f'WITH {PEOPLE} SELECT source_row, "Position", {_position(chr(34) + "Position" + chr(34))} AS category FROM connections_raw',
    "classify_company": f'WITH {PEOPLE} SELECT source_row, "Company", {_company(chr(34) + "Company" + chr(34))} AS category FROM connections_raw',
    "classify_company_joined": f'WITH {PEOPLE} SELECT source_row, "Company", {_company(chr(34) + "Company" + chr(34))} AS category FROM connections_raw',
    "match_counts": f"""{_audience()}, n AS (SELECT (SELECT count(*) FROM registrants) AS r, (SELECT count(*) FROM audience) AS m)
SELECT r AS n_registered, m AS n_matched, r - m AS n_unmatched,
  CASE WHEN r > 0 THEN round(100.0 * m / r, 2) ELSE 0 END::DOUBLE AS pct_matched,
  CASE WHEN r > 0 THEN round(100.0 * (r - m) / r, 2) ELSE 0 END::DOUBLE AS pct_unmatched FROM n""",
    "unmatched_names": f"""{_audience()} SELECT "Name" FROM registrants WHERE "Name" IS NOT NULL
EXCEPT SELECT "Name registrant" FROM audience""",
    "filter_none": _filtered(None, None),
    "filter_position": _filtered(DECISION_MAKERS, None),
    "filter_company": _filtered(None, INSURERS),
    "filter_audience": _filtered(DECISION_MAKERS, INSURERS),
}
