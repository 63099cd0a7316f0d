"""Independent DuckDB SQL for every registered query (the correctness gate).

Written as plain SQL against the driver's views: CASE chains for cascades and
argmax, ``row_number`` for keep-first and per-group top-k, ``unnest`` for
explode, RE2 regexes. Only rule *data* is shared with the Spark side (word
lists from the rule tables; the Unicode fold table is built here from
``unicodedata``); the logic is restated here in SQL.

DuckDB's ``\\b`` is ASCII-only while Java's (and Python's) is Unicode, so
word boundaries on accented text are spelled out with ``\\p{L}`` classes;
on folded (ASCII) text plain ``\\b`` is used.
"""

from __future__ import annotations

import functools
import re
import unicodedata

from ..functions import rules as R
from ..functions.text import SECTION_HEADERS, normalize_keyword
from . import driver_rules as TR

WS = "[\\t\\n\\x0B\\f\\r\\x1C-\\x20\\x{85}\\xA0\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
NW = "[^\\p{L}\\p{N}_]"  # not a word character (Unicode)


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def re2_escape(s: str) -> str:
    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", s)


# ------------------------------------------------------------- pieces -----

def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def decode(x: str) -> str:
    """The entities that the driver's tables hold (these six names, nested up
    to three times; the operator itself knows all of them and decodes to the
    end, see tests/test_text.py). These names are legacy HTML entities, so the
    trailing semicolon is optional."""
    one = x
    for _ in range(3):
        for ent, ch in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
            one = f"regexp_replace({one}, '&{ent};?', {lit(ch)}, 'g')"
    return one


@functools.cache
def ascii_folds() -> dict[str, str]:
    """Every non-ASCII character that NFKD turns into some ASCII characters."""
    chars = (chr(cp) for cp in range(0x80, 0x110000) if not 0xD800 <= cp < 0xE000)
    folds = ((ch, "".join(c for c in unicodedata.normalize("NFKD", ch) if c < "\x80")) for ch in chars)
    return {ch: to for ch, to in folds if to}


def fold(x: str) -> str:
    """T5: lower, NFKD to ASCII via ``ascii_folds``, collapse, trim."""
    one = {ch: to for ch, to in ascii_folds().items() if len(to) == 1}
    multi = {ch: to for ch, to in ascii_folds().items() if len(to) > 1}
    src, dst = "".join(one), "".join(one.values())
    low = f"lower(coalesce({x}, ''))"
    multi_cls = "[" + "".join(multi) + "]"
    mapping = "MAP {" + ", ".join(f"{lit(k)}: {lit(v)}" for k, v in multi.items()) + "}"
    expanded = (f"CASE WHEN regexp_matches({low}, {lit(multi_cls)}) THEN array_to_string(list_transform("
                f"string_split({low}, ''), lambda c: coalesce({mapping}[c], c)), '') ELSE {low} END")
    t = f"translate({expanded}, {lit(src)}, {lit(dst)})"
    t = f"regexp_replace({t}, '[^\\x00-\\x7F]', '', 'g')"
    t = f"regexp_replace({t}, '[\\t\\n\\x0B\\f\\r\\x1C-\\x20]+', ' ', 'g')"
    return f"trim({t})"


def norm(x: str) -> str:
    return f"lower({fold(x)})"


def kw_hit(n: str, kw: str) -> str:
    return f"regexp_matches({n}, {lit(chr(92) + 'b' + re2_escape(normalize_keyword(kw)) + chr(92) + 'b')})"


def score_cols(n: str, taxonomy: R.Taxonomy, prefix: str) -> str:
    return ", ".join(
        "(" + " + ".join(f"{kw_hit(n, kw)}::INT" for kw in kws) + f") AS {prefix}{i}"
        for i, (_, kws) in enumerate(taxonomy.categories)
    )


def argmax_sql(prefix: str, taxonomy: R.Taxonomy, multi: bool = False) -> str:
    names = taxonomy.names
    cols = [f"{prefix}{i}" for i in range(len(names))]
    top = f"greatest({', '.join(cols)})" if len(cols) > 1 else cols[0]
    case = f"CASE WHEN {top} <= 0 THEN 'unknown' " + " ".join(
        f"WHEN {c} = {top} THEN {lit(n)}" for c, n in zip(cols, names)) + " END"
    if multi and len(cols) > 1:
        second = f"list_sort([{', '.join(cols)}], 'DESC')[2]"
        case = f"CASE WHEN {top} >= 2 AND {second} >= 2 AND {top} - {second} <= 1 THEN 'multi_sector' ELSE {case} END"
    return case


def weighted_sql(tp: str, dp: str, taxonomy: R.Taxonomy, weight: int = 2) -> str:
    n = len(taxonomy.names)
    comb = [f"({dp}{i} + {weight} * {tp}{i})" for i in range(n)]
    top = f"greatest({', '.join(comb)})"
    first = " ".join(f"WHEN {comb[i]} = {top} AND {dp}{i} > 0 THEN {lit(taxonomy.names[i])}" for i in range(n))
    second = " ".join(f"WHEN {comb[i]} = {top} THEN {lit(taxonomy.names[i])}" for i in range(n))
    return f"CASE WHEN {top} <= 0 THEN 'unknown' {first} {second} END"


def cascade_sql(t: str, cascade: R.Cascade) -> str:
    def any_of(terms):
        return "(" + " OR ".join(f"contains({t}, {lit(x)})" for x in terms) + ")"

    parts = [f"CASE WHEN {t} IS NULL THEN NULL"]
    for rule in cascade.rules:
        if rule.mode == "equals":
            cond = f"{t} IN ({', '.join(lit(x) for x in rule.groups[0])})"
        elif rule.mode == "any":
            cond = any_of(rule.groups[0])
        else:
            cond = "(" + " AND ".join(any_of(g) for g in rule.groups) + ")"
        parts.append(f"WHEN {cond} THEN {lit(rule.output)}")
    parts.append(f"ELSE {lit(cascade.default)} END")
    return " ".join(parts)


def py_to_re2(p: str) -> str:
    """Python pattern -> RE2 with Unicode word boundaries (existence test)."""
    p = p.replace("\\s", "\x00WS\x00")
    word = r"[0-9A-Za-z_]"
    out, i = [], 0
    while i < len(p):
        if p.startswith("\\b", i):
            prev = p[i - 1] if i > 0 else ""
            nxt = p[i + 2] if i + 2 < len(p) else ""
            if prev in ("", "(", ":", "|") and nxt and re.match(word, nxt):
                out.append(f"(?:^|{NW})")
            elif nxt in ("", ")", "|"):
                out.append(f"(?:{NW}|$)")
            elif prev and re.match(word, prev) and nxt == "[":
                pass  # a non-word class follows: the boundary is implied
            else:
                raise ValueError(f"unsupported \\b position in {p!r}")
            i += 2
            continue
        out.append(p[i])
        i += 1
    s = "".join(out)
    # \s inside a class gets the class body, outside the whole class
    s = re.sub(r"\[([^\]]*)\x00WS\x00", lambda m: "[" + m.group(1) + WS[1:-1], s)
    return s.replace("\x00WS\x00", WS)


def skills_sql(low: str, patterns: R.SkillPatterns) -> str:
    items = []
    for skill, ps in patterns.skills:
        cond = " OR ".join(f"regexp_matches({low}, {lit(py_to_re2(p))})" for p in ps)
        items.append(f"CASE WHEN {cond} THEN {lit(skill)} END")
    return f"list_sort(list_filter([{', '.join(items)}], lambda x: x IS NOT NULL))"


def clean_text_sql(x: str) -> str:
    t = decode(x)
    t = f"replace({t}, chr(160), ' ')"
    t = f"regexp_replace({t}, '(?i)<br{WS}*/?>', chr(10), 'g')"
    t = f"regexp_replace({t}, '(?i)</p{WS}*>', chr(10), 'g')"
    t = f"regexp_replace({t}, '(?i)<p{WS}*>', '', 'g')"
    t = f"regexp_replace({t}, '<[^>]+>', ' ', 'g')"
    t = f"replace({t}, '***', chr(10))"
    t = f"replace({t}, '•', chr(10) || '- ')"
    t = f"replace({t}, '¿', ' ')"
    t = f"replace({t}, '…', '...')"
    t = f"regexp_replace({t}, '([.:;!?])([A-ZÀ-ÖØ-Þ])', '\\1 \\2', 'g')"
    t = f"regexp_replace({t}, '(\\))([A-ZÀ-ÖØ-Þ])', '\\1 \\2', 'g')"
    for h in SECTION_HEADERS:
        t = f"regexp_replace({t}, {lit('(' + h + WS + '*:?)')}, chr(10) || '\\1', 'g')"
    t = f"regexp_replace({t}, '[ \\t]+', ' ', 'g')"
    t = f"regexp_replace({t}, '\\n[ \\t]+', chr(10), 'g')"
    t = f"regexp_replace({t}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return strip(t)


def clean_title_sql(x: str) -> str:
    t = f"lower(replace({decode(x)}, chr(160), ' '))"
    for _ in range(2):
        t = f"regexp_replace({t}, '(^|{NW})(h/f|f/h)({NW}|$)', '\\1\\3', 'g')"
    t = f"regexp_replace({t}, '(?i)\\((h/f|f/h)\\)', '', 'g')"
    t = f"regexp_replace({t}, '(?i)\\({WS}*f{WS}*/{WS}*m{WS}*/{WS}*d{WS}*\\)', '(f/m/d)', 'g')"
    t = f"regexp_replace({t}, '\\({WS}*\\)', '', 'g')"
    t = f"regexp_replace({t}, '{WS}*-{WS}*', ' - ', 'g')"
    t = f"regexp_replace({t}, '{WS}*/{WS}*', ' / ', 'g')"
    t = f"regexp_replace({t}, '( - ){{2,}}', ' - ', 'g')"
    t = f"regexp_replace({t}, '{WS}+', ' ', 'g')"
    t = strip(f"regexp_replace({t}, '[.,;:]+$', '')")
    return f"nullif({t}, '')"


def clean_company_sql(x: str) -> str:
    t = f"replace({decode(x)}, chr(160), ' ')"
    t = strip(f"regexp_replace({t}, '{WS}+', ' ', 'g')")
    t = strip(f"regexp_replace({t}, '[.,;:]+$', '')")
    return f"nullif({t}, '')"


def prepared(t: str) -> str:
    return f"lower({strip(t)})"


# ------------------------------------------------------------ frames ------

PP = (f"pp AS (SELECT p_partkey, p_brand, {cascade_sql(prepared('p_name'), TR.PART_CASCADE)} AS role_family, "
      "p_type AS type_role, string_split(p_name, ' ') AS skills FROM part)")
RSD = ("rsd AS (SELECT role_family, skill, count(*) AS demand FROM (SELECT type_role AS role_family, "
       "unnest(skills) AS skill FROM pp WHERE type_role IS NOT NULL AND type_role <> 'other') "
       "WHERE skill IS NOT NULL GROUP BY 1, 2)")
SD = "sd AS (SELECT skill, count(*) AS demand FROM (SELECT unnest(skills) AS skill FROM pp) WHERE skill IS NOT NULL GROUP BY 1)"
RD = ("rd AS (SELECT role_family, count(*) AS demand FROM pp WHERE role_family IS NOT NULL "
      "AND role_family <> 'other' GROUP BY 1)")
OP = ("op AS (SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'other' ELSE o_orderpriority END AS role_family, "
      "CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE o_orderstatus END AS seniority_level, "
      "CASE WHEN o_totalprice >= 200000 THEN 'high' WHEN o_totalprice >= 50000 THEN 'mid' ELSE 'unknown' END AS domain_focus, "
      "o_orderdate AS created_at FROM orders)")
BY_SEN = ("bs AS (SELECT role_family, seniority_level, count(*) AS demand FROM op WHERE role_family IS NOT NULL "
          "AND role_family <> 'other' AND seniority_level IS NOT NULL AND seniority_level <> 'unknown' GROUP BY 1, 2)")
BY_DOM = ("bd AS (SELECT role_family, domain_focus, count(*) AS demand FROM op WHERE role_family IS NOT NULL "
          "AND role_family <> 'other' AND domain_focus IS NOT NULL AND domain_focus <> 'unknown' GROUP BY 1, 2)")
RTM = ("rtm AS (SELECT CAST(date_trunc('month', created_at) AS TIMESTAMP) AS month, role_family, count(*) AS demand "
       "FROM op WHERE created_at IS NOT NULL AND role_family IS NOT NULL AND role_family <> 'other' GROUP BY 1, 2)")
LST = ("lst AS (SELECT CAST(date_trunc('month', l.l_shipdate) AS TIMESTAMP) AS month, s.skill, count(*) AS demand "
       "FROM lineitem l JOIN (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS skill FROM part) s "
       "ON l.l_partkey = s.p_partkey WHERE l.l_shipdate IS NOT NULL AND s.skill IS NOT NULL GROUP BY 1, 2)")
ES = ("es AS (SELECT CAST(ts AS DATE) AS dt, event_type AS role_family, "
      "list_transform(json_keys(props), lambda k: k || '=' || json_extract_string(props, '$.' || k)) AS skills FROM events)")
DT = "DATE '2024-01-15'"
FIRST_LINE = "split_part(text, chr(10), 1)"
DN = f"dn AS (SELECT doc_id, {norm(FIRST_LINE)} AS tn, {norm('text')} AS bn FROM documents)"
LANG_S = (f"ls AS (SELECT doc_id, {score_cols('tn', TR.LANG_TAXONOMY, 't')}, "
          f"{score_cols('bn', TR.LANG_TAXONOMY, 'b')} FROM dn)")
PAGES = ("pg AS (SELECT page_id, html, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title, "
         "regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1) AS heading FROM pages)")
LD = ("ld AS (SELECT d.doc_id, d.lang, l.quality, l.toxic, d.text AS title_clean, "
      "CASE WHEN l.quality = 1 THEN 'good' WHEN l.quality = 0 THEN 'other' END AS role_family, "
      "CASE WHEN l.toxic = 1 THEN NULL ELSE d.source END AS company_name_clean "
      "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)")



def _pick(terms, factor: int, shift: int = 0) -> str:
    return f"[{', '.join(lit(t) for t in terms)}][(p_partkey * {factor} + {shift}) % {len(terms)} + 1]"


def _when(divisor: int, x: str) -> str:
    return f"CASE WHEN p_partkey % {divisor} = 0 THEN {x} ELSE '' END"


# part as raw postings: terms of the posting rules, picked by the part key
POSTINGS = (
    "po AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name || ' ' || " + _pick(TR.ROLE_TERMS, 1)
    + " || " + _when(5, "' / ' || " + _pick(TR.ROLE_TERMS, 31, 11)) + " || " + _when(3, "' - ' || " + _pick(TR.SENIORITY_TERMS, 7))
    + " || " + _when(2, "' (H/F)'") + " AS intitule, "
    + "'<p>' || " + _pick(TR.INDUSTRY_TERMS, 1) + " || ', ' || " + _pick(TR.INDUSTRY_TERMS, 1, 1) + " || ', ' || " + _pick(TR.INDUSTRY_TERMS, 3, 1)
    + " || '</p><br/>' || " + _pick(TR.DOMAIN_TERMS, 5) + " || ' &amp; ' || " + _pick(TR.DOMAIN_TERMS, 11, 3)
    + " || " + _when(4, "'; ' || " + _pick(TR.SENIORITY_TERMS, 13)) + " || ' <b>' || " + _pick(TR.SKILL_TERMS, 1)
    + " || '</b>, ' || " + _pick(TR.SKILL_TERMS, 17, 5) + " || '. ' || p_type AS description, "
    "CASE WHEN p_partkey % 6 = 0 THEN 'unknown' ELSE strftime(DATE '2024-01-01' + CAST(p_partkey % 90 AS INTEGER), '%Y-%m-%dT%H:%M:%S') || 'Z' END AS created, "
    "CASE WHEN p_partkey % 8 <> 0 THEN p_brand END AS place, "
    "CASE WHEN p_partkey % 9 <> 0 AND p_partkey % 7 <> 0 THEN p_brand || " + _when(4, "' &amp;amp; Co.'") + " END AS company, "
    "CASE WHEN p_partkey % 4 <> 0 THEN " + _when(3, "p_brand") + " END AS salary, CASE WHEN p_partkey % 4 <> 0 THEN p_type END AS salary_more FROM part)")


def populated(x: str) -> str:
    return f"coalesce(regexp_matches({x}, '[^{WS[1:-1]}]'), false)"


RELEVANT = "role_family IS NOT NULL AND role_family NOT IN ('other', 'false_positive')"


def metrics_sql(src: str, by: str = "") -> str:
    """Q2–Q5 long table over ``src`` (optionally per ``by``)."""
    k = f"{by}, " if by else ""
    g = f"GROUP BY {by}" if by else ""
    pct = "round(100.0 * sum(CASE WHEN {c} THEN 1 ELSE 0 END) / count(*), 2)"
    wide = (f"SELECT {k}CAST(count(*) AS DOUBLE) AS total_rows, "
            f"{pct.format(c=populated('title_clean'))} AS title_pct, "
            f"{pct.format(c=RELEVANT)} AS role_pct, "
            f"{pct.format(c=populated('company_name_clean'))} AS company_pct FROM {src} {g}")
    return (
        f"SELECT {k}metric, value, CASE metric WHEN 'total_rows' THEN value > 0 "
        "WHEN 'title_clean_populated_pct' THEN value >= 95 WHEN 'relevant_role_family_pct' THEN value >= 60 END AS passed "
        f"FROM (SELECT {k}'total_rows' AS metric, total_rows AS value FROM w UNION ALL "
        f"SELECT {k}'title_clean_populated_pct', title_pct FROM w UNION ALL "
        f"SELECT {k}'relevant_role_family_pct', role_pct FROM w UNION ALL "
        f"SELECT {k}'company_name_clean_populated_pct', company_pct FROM w)"
    ).replace(" FROM w", " FROM (" + wide + ")")


def unique_sql(col: str) -> str:
    return (f"SELECT '{col}' AS \"column\", count(*) AS duplicated_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS failing_rows, "
            f"count(*) = 0 AS passed FROM (SELECT {col}, count(*) AS n FROM documents WHERE {col} IS NOT NULL "
            f"GROUP BY 1 HAVING count(*) > 1)")


def sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["role_demand"] = f"WITH {PP}, {RD} SELECT * FROM rd"
    q["role_distribution"] = f"WITH {PP} SELECT role_family, count(*) AS nb_offers FROM pp GROUP BY 1"
    q["skill_demand"] = f"WITH {PP}, {SD} SELECT * FROM sd"
    q["role_skill_demand"] = f"WITH {PP}, {RSD} SELECT * FROM rsd"
    q["skill_demand_by_role"] = q["role_skill_demand"]
    q["role_skill_distinct"] = (
        f"WITH {PP} SELECT role_family, skill, count(DISTINCT p_brand) AS demand FROM (SELECT type_role AS role_family, "
        "p_brand, unnest(skills) AS skill FROM pp WHERE type_role IS NOT NULL AND type_role <> 'other') "
        "WHERE skill IS NOT NULL GROUP BY 1, 2")
    q["lake_role_skill"] = (f"WITH {PP} SELECT role_family, skill, count(*) AS nb FROM (SELECT role_family, "
                            "unnest(skills) AS skill FROM pp) WHERE skill IS NOT NULL GROUP BY 1, 2")
    q["lake_skill_distribution"] = f"WITH {PP}, {SD} SELECT skill, demand AS nb_offers FROM sd"
    q["top_skills_per_role"] = (
        f"WITH {PP}, {RSD} SELECT role_family, skill, demand FROM (SELECT *, row_number() OVER "
        "(PARTITION BY role_family ORDER BY demand DESC, skill ASC) AS rn FROM rsd) WHERE rn <= 5")
    q["topk_skills"] = f"WITH {PP}, {SD} SELECT * FROM sd ORDER BY demand DESC, skill LIMIT 5"
    q["topk_roles"] = f"WITH {PP}, {RD} SELECT * FROM rd ORDER BY demand DESC, role_family LIMIT 3"
    q["role_top_skills"] = (f"WITH {PP}, {RSD} SELECT * FROM rsd WHERE role_family = 'PROMO' "
                            "ORDER BY demand DESC, skill LIMIT 10")
    q["kpis"] = (
        f"WITH {PP}, {RD}, {SD}, {RSD} SELECT 'unique_roles' AS metric, count(DISTINCT role_family) AS value FROM rd "
        "UNION ALL SELECT 'unique_skills', count(DISTINCT skill) FROM sd "
        "UNION ALL SELECT 'role_skill_pairs', count(*) FROM rsd")
    q["dataset_summary"] = (
        f"WITH {PP}, {SD}, rc AS (SELECT role_family, count(*) AS value FROM pp GROUP BY 1) "
        "SELECT 'total' AS section, 'offers' AS key, count(*) AS value FROM pp "
        "UNION ALL SELECT 'total', 'unique_roles', count(DISTINCT role_family) FROM pp "
        "UNION ALL SELECT 'total', 'unique_skills', count(*) FROM sd "
        "UNION ALL (SELECT 'top_roles', role_family, value FROM rc WHERE role_family IS NOT NULL "
        "ORDER BY value DESC, role_family LIMIT 5) "
        "UNION ALL (SELECT 'top_skills', skill, demand FROM sd ORDER BY demand DESC, skill LIMIT 5)")
    q["role_selector"] = f"WITH {PP}, {RD} SELECT DISTINCT role_family FROM rd WHERE role_family IS NOT NULL"

    q["demand_by_seniority"] = f"WITH {OP}, {BY_SEN} SELECT * FROM bs"
    q["demand_by_domain"] = f"WITH {OP}, {BY_DOM} SELECT * FROM bd"
    q["domains_of_role"] = f"WITH {OP}, {BY_DOM} SELECT * FROM bd WHERE role_family = '1-URGENT'"
    q["seniority_ladder"] = (
        f"WITH {OP}, {BY_SEN} SELECT *, CASE seniority_level "
        + " ".join(f"WHEN {lit(v)} THEN {i}" for i, v in enumerate(TR.STATUS_LADDER))
        + " END AS ladder_rank FROM bs WHERE role_family = '2-HIGH'")
    q["role_trends_by_month"] = f"WITH {OP}, {RTM} SELECT * FROM rtm"
    q["skill_trends_by_month"] = f"WITH {LST} SELECT * FROM lst"
    q["skill_trends_by_order_month"] = (
        "SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month, skill, count(*) AS demand FROM "
        "(SELECT o_orderdate, unnest(string_split(o_orderpriority, '-')) AS skill FROM orders "
        "WHERE o_orderdate IS NOT NULL) WHERE skill IS NOT NULL GROUP BY 1, 2")
    q["topskill_trends"] = (
        f"WITH {LST}, {PP}, {RSD} SELECT * FROM lst WHERE skill IN (SELECT skill FROM rsd "
        "WHERE role_family = 'PROMO' ORDER BY demand DESC, skill LIMIT 5)")
    q["monthly_role_trend_of_role"] = f"WITH {OP}, {RTM} SELECT * FROM rtm WHERE role_family = '3-MEDIUM'"

    q["weekly_role_trends"] = f"WITH {ES} SELECT dt, role_family, count(*) AS nb_offers FROM es GROUP BY 1, 2"
    weeks = "wk AS (SELECT CAST(date_trunc('week', dt) AS DATE) AS dt, role_family, skills FROM es)"
    q["lake_trends_incremental"] = (
        f"WITH {ES}, {weeks} SELECT dt, 'role' AS kind, role_family AS key, count(*) AS nb_offers FROM wk GROUP BY 1, 3 "
        "UNION ALL SELECT dt, 'skill', skill, count(*) FROM (SELECT dt, unnest(skills) AS skill FROM wk) WHERE skill IS NOT NULL GROUP BY 1, 3")

    def placed(report: str, key: str, order: str, source: str) -> str:
        return f"SELECT '{report}' AS report, row_number() OVER (ORDER BY {order}) AS position, {key} AS key FROM {source}"

    es_skills = ("(SELECT dt, skill, count(*) AS n FROM (SELECT dt, unnest(skills) AS skill FROM es) WHERE skill IS NOT NULL GROUP BY 1, 2)")
    q["report_orders"] = f"WITH {PP}, {SD}, {RSD}, {OP}, {BY_SEN}, {RTM}, {ES} " + " UNION ALL ".join([
        placed("by_demand", "skill", "demand DESC, skill", "sd"),
        placed("by_role_then_demand", "role_family || '|' || skill", "role_family, demand DESC, skill", "rsd"),
        placed("by_levels", "role_family || '|' || seniority_level", "demand DESC, role_family, seniority_level", "bs"),
        placed("by_snapshot", "strftime(dt, '%Y-%m-%d') || '|' || skill", "dt DESC, n DESC, skill", es_skills),
        placed("by_month", "strftime(month, '%Y-%m-%d') || '|' || role_family", "month, demand DESC, role_family", "rtm")])
    q["weekly_skill_trends"] = (f"WITH {ES} SELECT dt, skill, count(*) AS nb_offers FROM "
                                "(SELECT dt, unnest(skills) AS skill FROM es) WHERE skill IS NOT NULL GROUP BY 1, 2")
    q["lake_roles_latest_only"] = (
        "WITH e AS (SELECT user_id, CAST(ts AS DATE) AS dt, event_type AS role_family FROM events), "
        "m AS (SELECT user_id, max(dt) AS dt FROM e WHERE user_id IS NOT NULL GROUP BY user_id) "
        "SELECT role_family, count(*) AS nb_offers FROM (SELECT e.* FROM e JOIN m ON e.user_id = m.user_id "
        "AND e.dt = m.dt UNION ALL SELECT * FROM e WHERE user_id IS NULL OR dt IS NULL) GROUP BY 1")
    q["dt_sanity_count"] = f"WITH {ES} SELECT count(*) AS nb_rows FROM es WHERE dt = {DT}"
    q["dt_sanity_roles"] = (f"WITH {ES} SELECT role_family, count(*) AS nb_offers FROM es WHERE dt = {DT} "
                            "GROUP BY 1")
    q["dt_sanity_skills"] = (f"WITH {ES} SELECT skill, count(*) AS nb_offers FROM (SELECT unnest(skills) AS skill "
                             f"FROM es WHERE dt = {DT}) WHERE skill IS NOT NULL GROUP BY 1")
    dim = " UNION ALL ".join(f"SELECT {lit(k)} AS keyword" for k in TR.EVENT_KEYWORDS)
    q["ingestion_summary"] = (
        f"WITH dim AS ({dim}), c AS (SELECT event_type AS keyword, count(*) AS n FROM events GROUP BY 1) "
        "SELECT dim.keyword, CAST(coalesce(c.n, 0) AS BIGINT) AS n_rows FROM dim LEFT JOIN c ON dim.keyword = c.keyword "
        "UNION ALL SELECT '__total__', count(*) FROM events")
    ev = ("ev AS (SELECT CAST(ts AS DATE) AS dt, props AS title_clean, "
          "CASE WHEN event_type = 'error' THEN 'other' ELSE event_type END AS role_family, "
          "CASE WHEN event_type = 'view' THEN ' ' ELSE event_type END AS company_name_clean FROM events)")
    q["quality_by_dt"] = (
        f"WITH {ev}, m AS ({metrics_sql('ev', 'dt')}) SELECT *, round(value - previous, 2) AS change FROM "
        "(SELECT *, lag(value) OVER (PARTITION BY metric ORDER BY dt) AS previous FROM m)")
    q["distinct_values"] = "SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL"
    q["bag_union"] = ("SELECT o_orderstatus, count(*) AS n FROM (SELECT * FROM orders WHERE o_orderstatus = 'F' "
                      "UNION ALL SELECT * FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F') GROUP BY 1")
    q["preview"] = ("SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders "
                    "ORDER BY o_orderkey LIMIT 15")
    iso = "strftime(ts, '%Y-%m-%dT%H:%M:%S')"
    q["safe_timestamp"] = (
        f"SELECT event_type, count(created_at) AS parsed, count(*) AS n, min(created_at) AS first_ts, "
        f"max(created_at) AS last_ts FROM (SELECT event_type, TRY_CAST(regexp_replace(txt, "
        f"'(Z|[+-][0-9][0-9]:[0-9][0-9])$', '') AS TIMESTAMP) AS created_at FROM (SELECT event_type, "
        f"CASE WHEN event_type = 'error' THEN 'garbage-' || event_id WHEN event_type = 'click' THEN {iso} || 'Z' "
        f"WHEN event_type = 'view' THEN {iso} || '.000+02:00' ELSE {iso} END AS txt FROM events)) GROUP BY 1")
    q["coalesce_fallback"] = (
        "SELECT coalesce(nullif(lib, ''), com) AS salary_label, count(*) AS n FROM (SELECT "
        "CASE WHEN event_type = 'view' THEN '' WHEN event_type = 'error' THEN NULL ELSE props END AS lib, "
        "CASE WHEN event_type = 'click' THEN NULL ELSE event_type END AS com FROM events) GROUP BY 1")
    q["flatten_json"] = (
        "SELECT event_type, CAST(sum(k) AS BIGINT) AS k_sum, max(k) AS k_max, count(k) AS k_n FROM "
        "(SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY 1")

    q["dedupe_keep_first"] = (
        "SELECT doc_id, lang, source, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY text "
        "ORDER BY source, doc_id) AS rn FROM documents) WHERE rn = 1")
    q["dedupe_counts"] = (
        "SELECT count(*) AS raw_rows, count(DISTINCT text) + max(CASE WHEN text IS NULL THEN 1 ELSE 0 END) "
        "AS deduped_rows, count(*) - count(DISTINCT text) - max(CASE WHEN text IS NULL THEN 1 ELSE 0 END) "
        "AS duplicates_removed FROM documents")
    lt = TR.LANG_TAXONOMY
    q["infer_category"] = f"WITH {DN}, {LANG_S} SELECT doc_id, {argmax_sql('b', lt)} AS category FROM ls"
    q["infer_category_multi"] = f"WITH {DN}, {LANG_S} SELECT doc_id, {argmax_sql('b', lt, True)} AS category FROM ls"
    q["score_categories"] = (
        f"WITH {DN}, {LANG_S} SELECT doc_id, concat_ws(',', "
        + ", ".join(f"CASE WHEN b{i} > 0 THEN {lit(c + ':')} || b{i} END" for i, c in enumerate(lt.names))
        + ") AS scores FROM ls")
    allowed = ", ".join(lit(x) for x in TR.LANG_FROM_BODY)
    q["infer_with_priority"] = (
        f"WITH {DN}, {LANG_S} SELECT doc_id, CASE WHEN t <> 'unknown' THEN t WHEN b IN ({allowed}) THEN b "
        f"ELSE 'unknown' END AS category FROM (SELECT doc_id, {argmax_sql('t', lt)} AS t, {argmax_sql('b', lt)} AS b FROM ls)")
    q["weighted_domain"] = f"WITH {DN}, {LANG_S} SELECT doc_id, {weighted_sql('t', 'b', lt)} AS category FROM ls"
    q["match_terms_categories"] = q["infer_category"]
    q["language_demand"] = (f"WITH {DN}, {LANG_S} SELECT role_family, count(*) AS demand FROM (SELECT "
                            f"{argmax_sql('b', lt)} AS role_family FROM ls) GROUP BY 1")
    ds = f"ds AS (SELECT doc_id, {skills_sql('lower(text)', TR.DOC_PATTERNS)} AS skills FROM documents)"
    q["extract_skills"] = f"WITH {ds} SELECT doc_id, array_to_string(skills, ',') AS skills FROM ds"
    q["skills_exploded"] = (f"WITH {ds} SELECT skill, count(*) AS demand FROM (SELECT unnest(skills) AS skill FROM ds) "
                            "WHERE skill IS NOT NULL GROUP BY 1")
    q["normalize_text"] = (f"SELECT doc_id, length(n) AS n_chars, md5(n) AS md5 FROM "
                           f"(SELECT doc_id, {fold('text')} AS n FROM documents)")

    q["clean_text"] = (f"WITH {PAGES} SELECT page_id, length(c) AS n_chars, md5(coalesce(c, chr(0) || 'null')) AS md5 "
                       f"FROM (SELECT page_id, {clean_text_sql('html')} AS c FROM pg)")
    q["clean_title"] = f"WITH {PAGES} SELECT page_id, {clean_title_sql('title')} AS title_clean FROM pg"
    q["clean_company"] = f"WITH {PAGES} SELECT page_id, {clean_company_sql('heading')} AS company_name_clean FROM pg"

    q["quality_metrics"] = f"WITH {LD} {metrics_sql('ld')}"
    q["quality_gate"] = f"WITH {LD} SELECT metric, passed FROM ({metrics_sql('ld')}) WHERE passed IS NOT NULL"
    nn = ["doc_id", "title_clean", "role_family", "quality", "toxic"]
    q["not_null_tests"] = f"WITH {LD} " + " UNION ALL ".join(
        f"SELECT {lit(c)} AS \"column\", CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS failing_rows, "
        f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) = 0 AS passed FROM ld" for c in nn)
    q["unique_tests"] = unique_sql("doc_id") + " UNION ALL " + unique_sql("text")
    q["coverage"] = f"WITH {LD} " + " UNION ALL ".join(
        f"SELECT {lit(c)} AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM ld GROUP BY 2"
        for c in ["lang", "role_family", "quality"])

    q["reference_role_family"] = (
        f"WITH {POSTINGS} SELECT role_family, count(*) AS nb_offers FROM (SELECT "
        f"{cascade_sql(prepared('tc'), R.ROLE_CASCADE)} AS role_family FROM (SELECT "
        f"{clean_title_sql('intitule')} AS tc FROM po)) GROUP BY 1")
    rs = f"rs AS (SELECT {skills_sql('lower(description)', R.SKILLS)} AS skills FROM po)"
    q["reference_skills"] = (f"WITH {POSTINGS}, {rs} SELECT skill, count(*) AS demand FROM (SELECT unnest(skills) AS skill FROM rs) "
                             "WHERE skill IS NOT NULL GROUP BY 1")
    ref_scores = (f"sc AS (SELECT {score_cols('bn', R.INDUSTRY, 'i')}, {score_cols('tn', R.SENIORITY, 'st')}, "
                  f"{score_cols('bn', R.SENIORITY, 'sd')}, {score_cols('tn', R.DOMAIN, 'dt')}, "
                  f"{score_cols('bn', R.DOMAIN, 'dd')} FROM dn)")
    allowed_sen = ", ".join(lit(x) for x in R.DESCRIPTION_SENIORITY)
    enrich_cols = (
        f"{argmax_sql('i', R.INDUSTRY, True)} AS hiring_industry, "
        f"CASE WHEN ({argmax_sql('st', R.SENIORITY)}) <> 'unknown' THEN ({argmax_sql('st', R.SENIORITY)}) "
        f"WHEN ({argmax_sql('sd', R.SENIORITY)}) IN ({allowed_sen}) THEN ({argmax_sql('sd', R.SENIORITY)}) "
        f"ELSE 'unknown' END AS seniority_level, {weighted_sql('dt', 'dd', R.DOMAIN)} AS domain_focus")
    ref_scores = ref_scores.replace("FROM dn)", "FROM sn)").replace("sc AS (SELECT ", "sc AS (SELECT sn.*, ")
    flat = (f"st AS (SELECT *, {clean_title_sql('intitule')} AS title_clean, {clean_company_sql('company')} AS company_name_clean, "
            f"{clean_text_sql('description')} AS description_clean FROM po)")
    sn = (f"sn AS (SELECT *, {cascade_sql(prepared('title_clean'), R.ROLE_CASCADE)} AS role_family, "
          f"{skills_sql('lower(description_clean)', R.SKILLS)} AS skills, "
          f"{norm('title_clean')} AS tn, {norm('description_clean')} AS bn FROM st)")
    staged = f"WITH {POSTINGS}, {flat}, {sn}, {ref_scores}, en AS (SELECT *, {enrich_cols} FROM sc)"
    q["reference_enrichment"] = f"{staged} SELECT hiring_industry, seniority_level, domain_focus, count(*) AS n FROM en GROUP BY 1, 2, 3"
    created = "TRY_CAST(regexp_replace(created, 'Z$', '') AS TIMESTAMP)"
    q["stage_postings"] = (
        f"{staged} SELECT id AS offer_id, title_clean, role_family, {created} AS created_at, place AS department_or_location, "
        "company_name_clean, coalesce(nullif(salary, ''), salary_more) AS salary_label, md5(description_clean) AS description_md5, "
        f"array_to_string(skills, ',') AS skills, hiring_industry, seniority_level, domain_focus, {lit(R.SOURCE_NAME)} AS source FROM en")
    day = ("CASE WHEN p_partkey % 6 <> 0 THEN DATE '2024-01-01' + CAST(p_partkey % 90 AS INTEGER) END")
    q["posting_views"] = (
        f"WITH {PP}, kept AS (SELECT *, {day} AS day FROM pp WHERE role_family IS NOT NULL AND role_family <> 'other') "
        "SELECT 'mart_role_demand' AS view, role_family AS key, count(*) AS demand FROM kept GROUP BY 2 "
        "UNION ALL SELECT 'mart_skill_demand', skill, count(*) FROM (SELECT unnest(skills) AS skill FROM pp) GROUP BY 2 "
        "UNION ALL SELECT 'mart_role_trends_by_month', strftime(day, '%Y-%m') || ' ' || role_family, count(*) FROM kept "
        "WHERE day IS NOT NULL GROUP BY 2 "
        "UNION ALL SELECT 'mart_role_demand_by_seniority', role_family || ' ' || type_role, count(*) FROM kept WHERE type_role <> 'PROMO' GROUP BY 2 "
        "UNION ALL SELECT 'mart_role_demand_by_domain_focus', role_family || ' ' || p_brand, count(*) FROM kept GROUP BY 2 "
        + "".join(f"UNION ALL SELECT '{view}', role_family || ' ' || skill, count(*) FROM (SELECT role_family, unnest(skills) AS skill FROM kept) "
                  "GROUP BY 2 " for view in ("mart_role_skill_demand", "mart_skill_demand_by_role"))
        + "UNION ALL SELECT 'mart_skill_trends_by_month', strftime(day, '%Y-%m') || ' ' || skill, count(*) "
        f"FROM (SELECT {day} AS day, unnest(skills) AS skill FROM pp) WHERE day IS NOT NULL GROUP BY 2 "
        f"UNION ALL SELECT 'stg_offres_view', coalesce(strftime({day}, '%Y-%m-%d'), 'none'), count(*) FROM pp GROUP BY 2")
    q["match_terms_reference"] = f"WITH {POSTINGS}, nd AS (SELECT id, {norm('description')} AS bn FROM po), " + ", ".join(
        f"{p} AS (SELECT id, {score_cols('bn', t, p)} FROM nd)" for p, t in (("i", R.INDUSTRY), ("s", R.SENIORITY), ("d", R.DOMAIN))
    ) + " " + " UNION ALL ".join(
        f"SELECT {lit(name)} AS taxonomy, id, {argmax_sql(p, t)} AS category FROM {p}"
        for name, p, t in (("industry", "i", R.INDUSTRY), ("seniority", "s", R.SENIORITY), ("domain", "d", R.DOMAIN)))
    pages = (f"st AS (SELECT *, {clean_title_sql('title')} AS title_clean, {clean_company_sql('heading')} AS company_name_clean, "
             f"{clean_text_sql('html')} AS description_clean FROM pg)")
    q["stage_pages"] = (
        f"WITH {PAGES}, {pages}, {sn}, {ref_scores} SELECT CAST(page_id AS VARCHAR) AS offer_id, company_name_clean, "
        f"array_to_string(skills, ',') AS skills, role_family, {enrich_cols} FROM sc")
    return q
