"""Rule-based enrichment E1–E6 as Column expressions generated from rule tables.

The rules are folded into literals at plan time: no shuffle, no UDF, one pass
over each row. Ties are resolved by comparing structs with ``greatest``:
``struct(score, -tie_group, -ord, category)`` orders by score, then by the
earliest position, which is exactly "first in dictionary order wins".

Functions named ``*_norm`` expect a column already passed through
``text.normalize_for_match``; compute it once in its own ``select`` so the
many keyword predicates read it instead of re-normalising.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rules as R
from .text import (ASCII_WORD, PY_WORD, WS, bounded, keyword_match, lit_array, normalize_for_match, normalize_keyword,
                   py_regex, required_literal, sql_lit)

UNKNOWN = "unknown"
MULTI = "multi_sector"


# ------------------------------------------------------ SQL builders ------
# When the inputs are named columns, each generated rule expression is handed
# to Spark as one SQL string (one parse) instead of being assembled from
# hundreds of Column calls; the expression is the same either way.

def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lits(values) -> str:
    return ", ".join(sql_lit(v) for v in values)


def _kw_match_sql(norm: str, keyword: str) -> str:
    kw = normalize_keyword(keyword)
    return f"(contains({norm}, {sql_lit(kw)}) AND {norm} RLIKE {sql_lit(bounded(kw, ASCII_WORD))})"


def _argmax_sql(scores: list[str], names: list[str], ties: list[str] | None = None) -> str:
    keyed = [
        f"named_struct('score', {sc}, 'tie', {ties[i] if ties else '0'}, 'ord', {-i}, 'category', {sql_lit(n)})"
        for i, (sc, n) in enumerate(zip(scores, names))
    ]
    return keyed[0] if len(keyed) == 1 else "greatest(" + ", ".join(keyed) + ")"


# ---------------------------------------------------------------- E1 ------

# Normalised text is lower-case ASCII, where a word character is [a-z0-9_]:
# a keyword made only of word characters matches ``\bkw\b`` exactly when it
# is one of the text's tokens.
_ASCII_WORD = re.compile(r"[a-z0-9_]+")
_ASCII_WORD_RUN = "[a-z0-9_]+"


def _single_words(taxonomies) -> list[str]:
    words = {
        normalize_keyword(kw)
        for tax in taxonomies for _, kws in tax.categories for kw in kws
    }
    return sorted(w for w in words if _ASCII_WORD.fullmatch(w))


def keyword_presence(norm: Column, *taxonomies: R.Taxonomy) -> Column:
    """The single-word keywords of ``taxonomies`` present in a normalised
    text: one tokenisation and one hash intersection per row, instead of one
    scan of the text per keyword."""
    words = _single_words(taxonomies)
    if not words:
        return F.array().cast("array<string>")
    tokens = F.regexp_extract_all(norm, F.lit(_ASCII_WORD_RUN), 0)
    return F.array_intersect(tokens, lit_array(words))


def category_scores(norm: Column, taxonomy: R.Taxonomy, present: Column | None = None) -> list[Column]:
    """Per category: number of keywords present (0/1 each, as listed).

    Single-word keywords are counted with one ``array_intersect`` against the
    present set per category (a word listed k times after normalisation
    counts k times); phrases keep their own boundary test.
    """
    if present is None:
        present = keyword_presence(norm, taxonomy)
    out = []
    for _, kws in taxonomy.categories:
        weights: dict[str, int] = {}
        phrases = []
        for kw in kws:
            kwn = normalize_keyword(kw)
            if _ASCII_WORD.fullmatch(kwn):
                weights[kwn] = weights.get(kwn, 0) + 1
            else:
                phrases.append(kw)
        s = F.lit(0)
        once = sorted(w for w, k in weights.items() if k == 1)
        if once:
            s = F.size(F.array_intersect(present, lit_array(once)))
        for w, k in sorted(weights.items()):
            if k > 1:
                s = s + F.array_contains(present, w).cast("int") * k
        for kw in phrases:
            s = s + keyword_match(norm, kw).cast("int")
        out.append(s)
    return out


def _score_array_sql(norm: str, taxonomy: R.Taxonomy, present: str) -> str:
    n, p = _q(norm), _q(present)
    cats = []
    for _, kws in taxonomy.categories:
        weights: dict[str, int] = {}
        phrases = []
        for kw in kws:
            kwn = normalize_keyword(kw)
            if _ASCII_WORD.fullmatch(kwn):
                weights[kwn] = weights.get(kwn, 0) + 1
            else:
                phrases.append(kw)
        parts = []
        once = sorted(w for w, k in weights.items() if k == 1)
        if once:
            parts.append(f"size(array_intersect({p}, array({_lits(once)})))")
        parts += [f"CAST(array_contains({p}, {sql_lit(w)}) AS INT) * {k}"
                  for w, k in sorted(weights.items()) if k > 1]
        parts += [f"CAST({_kw_match_sql(n, kw)} AS INT)" for kw in phrases]
        cats.append("(" + (" + ".join(parts) or "0") + ")")
    return "array(" + ", ".join(cats) + ")"


def score_array(norm: Column | str, taxonomy: R.Taxonomy, present: Column | str | None = None) -> Column:
    """E1 as ``array<int>``, one score per category in dictionary order.

    Keep it in its own projection (see ``with_scores``): Spark splits the
    code of a large ``array(...)`` into helper methods, so long dictionaries
    stay under the 64 KB method limit and inside whole-stage codegen.
    Named-column inputs are compiled from one SQL string.
    """
    if isinstance(norm, str) and isinstance(present, str):
        return F.expr(_score_array_sql(norm, taxonomy, present))
    norm = F.col(norm) if isinstance(norm, str) else norm
    present = F.col(present) if isinstance(present, str) else present
    return F.array(*category_scores(norm, taxonomy, present))


def with_presence(df: DataFrame, norm: str, out: str, *taxonomies: R.Taxonomy) -> DataFrame:
    return df.withColumn(out, keyword_presence(F.col(norm), *taxonomies))


def with_scores(df: DataFrame, norm: str, taxonomy: R.Taxonomy, out: str) -> DataFrame:
    tmp = f"__{out}_present"
    return (with_presence(df, norm, tmp, taxonomy)
            .withColumn(out, score_array(norm, taxonomy, tmp)).drop(tmp))


def scores_as_structs(scores: Column, taxonomy: R.Taxonomy) -> Column:
    """``array<struct<category, ord, score>>`` of the positive scores."""
    arr = F.array(*[
        F.struct(F.lit(cat).alias("category"), F.lit(i).alias("ord"), scores[i].alias("score"))
        for i, cat in enumerate(taxonomy.names)
    ])
    return F.filter(arr, lambda x: x["score"] > 0)


def score_categories_norm(norm: Column, taxonomy: R.Taxonomy) -> Column:
    """E1 in one expression (empty text -> empty array)."""
    return scores_as_structs(score_array(norm, taxonomy), taxonomy)


def score_categories(text: Column, taxonomy: R.Taxonomy) -> Column:
    return score_categories_norm(normalize_for_match(text), taxonomy)


# ---------------------------------------------------------------- E2 ------

def _argmax(scores: list[Column], names: list[str], tie_groups: list[Column] | None = None) -> Column:
    keyed = [
        F.struct(
            s.alias("score"),
            (-tie_groups[i] if tie_groups is not None else F.lit(0)).alias("tie"),
            F.lit(-i).alias("ord"),
            F.lit(name).alias("category"),
        )
        for i, (s, name) in enumerate(zip(scores, names))
    ]
    return keyed[0] if len(keyed) == 1 else F.greatest(*keyed)


def _category_sql(scores: str, taxonomy: R.Taxonomy, multi: bool = False) -> str:
    sc = _q(scores)
    n = len(taxonomy.names)
    best = _argmax_sql([f"{sc}[{i}]" for i in range(n)], taxonomy.names)
    result = f"CASE WHEN ({best}).score <= 0 THEN 'unknown' ELSE ({best}).category END"
    if multi and n > 1:
        top, second = f"sort_array({sc}, false)[0]", f"sort_array({sc}, false)[1]"
        result = (f"CASE WHEN {top} >= 2 AND {second} >= 2 AND {top} - {second} <= 1 "
                  f"THEN 'multi_sector' ELSE {result} END")
    return result


def category_from_scores(scores: Column | str, taxonomy: R.Taxonomy, multi: bool = False) -> Column:
    """E2 on a ``score_array`` column: highest score, ties to the earlier
    category, none -> ``unknown``; with ``multi``: top and runner-up both
    >= 2 and at most 1 apart -> ``multi_sector``."""
    if isinstance(scores, str):
        return F.expr(_category_sql(scores, taxonomy, multi))
    n = len(taxonomy.names)
    best = _argmax([scores[i] for i in range(n)], taxonomy.names)
    result = F.when(best["score"] <= 0, F.lit(UNKNOWN)).otherwise(best["category"])
    if multi and n > 1:
        ranked = F.sort_array(scores, asc=False)
        top, second = ranked[0], ranked[1]
        result = F.when((top >= 2) & (second >= 2) & (top - second <= 1), F.lit(MULTI)).otherwise(result)
    return result


def infer_category_norm(norm: Column, taxonomy: R.Taxonomy, multi: bool = False) -> Column:
    """E2 in one expression (relies on subexpression elimination for the
    shared score array; prefer ``with_category`` for long dictionaries)."""
    return category_from_scores(score_array(norm, taxonomy), taxonomy, multi)


def infer_category(text: Column, taxonomy: R.Taxonomy, multi: bool = False) -> Column:
    return infer_category_norm(normalize_for_match(text), taxonomy, multi)


def with_category(df: DataFrame, norm: str, taxonomy: R.Taxonomy, out: str, multi: bool = False) -> DataFrame:
    """DataFrame form of E2: scores in one projection, category in the next."""
    tmp = f"__{out}_scores"
    return with_scores(df, norm, taxonomy, tmp).withColumn(
        out, category_from_scores(tmp, taxonomy, multi)).drop(tmp)


# ---------------------------------------------------------------- E3 ------

def priority_from_scores(
    title_scores: Column | str, desc_scores: Column | str, taxonomy: R.Taxonomy = R.SENIORITY,
    allowed_from_description=tuple(R.DESCRIPTION_SENIORITY),
) -> Column:
    """The title's category if known; else the description's, only when
    it is one of ``allowed_from_description``; else ``unknown``."""
    if isinstance(title_scores, str) and isinstance(desc_scores, str):
        t, d = _category_sql(title_scores, taxonomy), _category_sql(desc_scores, taxonomy)
        return F.expr(f"CASE WHEN ({t}) <> 'unknown' THEN ({t}) WHEN ({d}) IN ({_lits(allowed_from_description)}) "
                      f"THEN ({d}) ELSE 'unknown' END")
    title_scores = F.col(title_scores) if isinstance(title_scores, str) else title_scores
    desc_scores = F.col(desc_scores) if isinstance(desc_scores, str) else desc_scores
    t = category_from_scores(title_scores, taxonomy)
    d = category_from_scores(desc_scores, taxonomy)
    return F.when(t != UNKNOWN, t).when(d.isin(*allowed_from_description), d).otherwise(F.lit(UNKNOWN))


def infer_with_priority_norm(
    title_norm: Column, desc_norm: Column, taxonomy: R.Taxonomy = R.SENIORITY,
    allowed_from_description=tuple(R.DESCRIPTION_SENIORITY),
) -> Column:
    return priority_from_scores(score_array(title_norm, taxonomy), score_array(desc_norm, taxonomy),
                                taxonomy, allowed_from_description)


# ---------------------------------------------------------------- E4 ------

def weighted_from_scores(title_scores: Column | str, desc_scores: Column | str,
                         taxonomy: R.Taxonomy = R.DOMAIN, title_weight: int = 2) -> Column:
    """score = description + weight x title; argmax; ties go to the
    categories found in the description (dictionary order), then to the
    title-only ones (dictionary order); nothing -> ``unknown``."""
    n = len(taxonomy.names)
    if isinstance(title_scores, str) and isinstance(desc_scores, str):
        t, d = _q(title_scores), _q(desc_scores)
        comb = [f"({d}[{i}] + {title_weight} * {t}[{i}])" for i in range(n)]
        ties = [f"CASE WHEN {d}[{i}] > 0 THEN 0 ELSE -1 END" for i in range(n)]
        best = _argmax_sql(comb, taxonomy.names, ties)
        return F.expr(f"CASE WHEN ({best}).score <= 0 THEN 'unknown' ELSE ({best}).category END")
    title_scores = F.col(title_scores) if isinstance(title_scores, str) else title_scores
    desc_scores = F.col(desc_scores) if isinstance(desc_scores, str) else desc_scores
    combined = [desc_scores[i] + F.lit(title_weight) * title_scores[i] for i in range(n)]
    groups = [F.when(desc_scores[i] > 0, F.lit(0)).otherwise(F.lit(1)) for i in range(n)]
    best = _argmax(combined, taxonomy.names, groups)
    return F.when(best["score"] <= 0, F.lit(UNKNOWN)).otherwise(best["category"])


def weighted_category_norm(
    title_norm: Column, desc_norm: Column, taxonomy: R.Taxonomy = R.DOMAIN, title_weight: int = 2
) -> Column:
    return weighted_from_scores(score_array(title_norm, taxonomy), score_array(desc_norm, taxonomy),
                                taxonomy, title_weight)


# ---------------------------------------------------------------- E5 ------

def _any_contains(t: Column, terms) -> Column:
    cond = t.contains(terms[0])
    for x in terms[1:]:
        cond = cond | t.contains(x)
    return cond


def _rule_condition(t: Column, rule: R.Rule) -> Column:
    if rule.mode == "equals":
        return t.isin(*rule.groups[0])
    if rule.mode == "any":
        return _any_contains(t, rule.groups[0])
    if rule.mode == "all":
        cond = F.lit(True)
        for group in rule.groups:
            cond = cond & _any_contains(t, group)
        return cond
    raise ValueError(f"unknown rule mode {rule.mode!r}")


def prepare_title(title: Column) -> Column:
    """What the cascade matches against: stripped and lower-cased."""
    return F.lower(F.regexp_replace(title, f"^{WS}+|{WS}+\\z", ""))


def _classify_sql(t: str, cascade: R.Cascade) -> str:
    t = _q(t)

    def any_of(terms):
        return "(" + " OR ".join(f"contains({t}, {sql_lit(x)})" for x in terms) + ")"

    parts = [f"CASE WHEN {t} IS NULL THEN CAST(NULL AS STRING)"]
    for rule in cascade.rules:
        if rule.mode == "equals":
            cond = f"{t} IN ({_lits(rule.groups[0])})"
        elif rule.mode == "any":
            cond = any_of(rule.groups[0])
        elif rule.mode == "all":
            cond = " AND ".join(any_of(g) for g in rule.groups)
        else:
            raise ValueError(f"unknown rule mode {rule.mode!r}")
        parts.append(f"WHEN {cond} THEN {sql_lit(rule.output)}")
    parts.append(f"ELSE {sql_lit(cascade.default)} END")
    return " ".join(parts)


def classify_prepared(t: Column | str, cascade: R.Cascade = R.ROLE_CASCADE) -> Column:
    """E5 on a ``prepare_title`` column: ordered cascade, first rule that
    fires gives the output; none -> ``cascade.default``; null -> null."""
    if isinstance(t, str):
        return F.expr(_classify_sql(t, cascade))
    expr = F.when(t.isNull(), F.lit(None).cast("string"))
    for rule in cascade.rules:
        expr = expr.when(_rule_condition(t, rule), F.lit(rule.output))
    return expr.otherwise(F.lit(cascade.default))


def classify(title: Column, cascade: R.Cascade = R.ROLE_CASCADE) -> Column:
    """E5 on a raw column; the title is prepared once inside a lambda."""
    return F.transform(F.array(prepare_title(title)), lambda t: classify_prepared(t, cascade))[0]


def with_classification(df: DataFrame, title: str, out: str, cascade: R.Cascade = R.ROLE_CASCADE) -> DataFrame:
    """DataFrame form of E5: the prepared title lives in its own projection."""
    tmp = f"__{out}_t"
    return (
        df.withColumn(tmp, prepare_title(F.col(title)))
        .withColumn(out, classify_prepared(tmp, cascade))
        .drop(tmp)
    )


# ---------------------------------------------------------------- E6 ------

_SIMPLE = re.compile(r"^\\b([^\\\[\](){}.*+?^$|]+)\\b$")
_UNICODE_WORD_RUN = f"[{PY_WORD}]+"


def _simple_word(pattern: str) -> str | None:
    m = _SIMPLE.match(pattern)
    return m.group(1) if m and _ASCII_WORD.fullmatch(m.group(1)) else None


def skill_presence(low: Column, patterns: R.SkillPatterns) -> Column:
    """Words of the ``\\bword\\b`` patterns present in a lower-cased text
    (one tokenisation, one hash intersection)."""
    words = sorted({w for _, ps in patterns.skills for p in ps if (w := _simple_word(p))})
    if not words:
        return F.array().cast("array<string>")
    tokens = F.regexp_extract_all(low, F.lit(_UNICODE_WORD_RUN), 0)
    return F.array_intersect(tokens, lit_array(words))


def _pattern_match(c: Column, pattern: str, present: Column) -> Column:
    word = _simple_word(pattern)
    if word is not None:
        return F.array_contains(present, word)
    hit = c.rlike(py_regex(pattern))
    # a match must contain this literal: a byte search first skips the regex
    # on all rows without it
    needle = required_literal(pattern)
    return (c.contains(needle) & hit) if needle else hit


def _skills_sql(lowered: str, patterns: R.SkillPatterns, present: str) -> str:
    low, p = _q(lowered), _q(present)
    hits = []
    for skill, ps in patterns.skills:
        words = sorted({w for q in ps if (w := _simple_word(q))})
        conds = [f"arrays_overlap({p}, array({_lits(words)}))"] if words else []
        for q in ps:
            if _simple_word(q) is not None:
                continue
            needle = required_literal(q)
            hit = f"{low} RLIKE {sql_lit(py_regex(q))}"
            conds.append(f"(contains({low}, {sql_lit(needle)}) AND {hit})" if needle else f"({hit})")
        hits.append(f"CASE WHEN {' OR '.join(conds) or 'false'} THEN {sql_lit(skill)} END")
    return (f"CASE WHEN {low} IS NULL THEN CAST(array() AS ARRAY<STRING>) "
            f"ELSE array_sort(filter(array({', '.join(hits)}), x -> x IS NOT NULL)) END")


def extract_skills(text: Column | str, patterns: R.SkillPatterns = R.SKILLS,
                   present: Column | str | None = None) -> Column:
    """Sorted skills with any pattern found in the lower-cased text; null ->
    empty array. Columns given by name hold the text lower-cased already and
    the words found in it (``skill_presence``)."""
    if isinstance(text, str) and isinstance(present, str):
        return F.expr(_skills_sql(text, patterns, present))
    text = F.col(text) if isinstance(text, str) else text
    present = F.col(present) if isinstance(present, str) else present
    low = F.lower(text)
    if present is None:
        present = skill_presence(low, patterns)
    hits = []
    for skill, ps in patterns.skills:
        words = sorted({w for p in ps if (w := _simple_word(p))})
        cond = F.arrays_overlap(present, lit_array(words)) if words else F.lit(False)
        for p in ps:
            if _simple_word(p) is None:
                cond = cond | _pattern_match(low, p, present)
        hits.append(F.when(cond, F.lit(skill)))
    found = F.filter(F.array(*hits), lambda x: x.isNotNull())
    return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(F.array_sort(found))


def with_skills(df: DataFrame, text: str, out: str = "skills", patterns: R.SkillPatterns = R.SKILLS) -> DataFrame:
    """DataFrame form of E6: lower-casing and the token intersection each in
    their own projection, once a row."""
    low, tmp = f"__{out}_low", f"__{out}_present"
    return (df.withColumn(low, F.lower(F.col(text))).withColumn(tmp, skill_presence(F.col(low), patterns))
            .withColumn(out, extract_skills(low, patterns, tmp)).drop(low, tmp))


# ---------------------------------------------------------------- E7 ------

def enrich_frame(
    df: DataFrame,
    title: str = "title_clean",
    description: str = "description_clean",
    *,
    industry: R.Taxonomy = R.INDUSTRY,
    seniority: R.Taxonomy = R.SENIORITY,
    domain: R.Taxonomy = R.DOMAIN,
    skills: R.SkillPatterns = R.SKILLS,
    cascade: R.Cascade = R.ROLE_CASCADE,
) -> DataFrame:
    """Add role_family, skills, hiring_industry, seniority_level,
    domain_focus.

    Plan shape: normalised title/description once; then one projection of
    score arrays per (taxonomy, text); then the cheap argmax projections.
    Helper columns are dropped at the end.
    """
    tn, dn, rt = "__title_norm", "__desc_norm", "__role_t"
    staged = df.withColumns({
        tn: normalize_for_match(F.col(title)),
        dn: normalize_for_match(F.col(description)),
        rt: prepare_title(F.col(title)),
        "__low": F.lower(F.col(description)),
    })
    staged = staged.withColumns({
        "__tp": keyword_presence(F.col(tn), seniority, domain),
        "__dp": keyword_presence(F.col(dn), industry, seniority, domain),
        "__sp": skill_presence(F.col("__low"), skills),
    })
    staged = staged.withColumns({
        "__ind_d": score_array(dn, industry, "__dp"),
        "__sen_t": score_array(tn, seniority, "__tp"),
        "__sen_d": score_array(dn, seniority, "__dp"),
        "__dom_t": score_array(tn, domain, "__tp"),
        "__dom_d": score_array(dn, domain, "__dp"),
    })
    out = staged.withColumns({
        "role_family": classify_prepared(rt, cascade),
        "skills": extract_skills("__low", skills, "__sp"),
        "hiring_industry": category_from_scores("__ind_d", industry, multi=True),
        "seniority_level": priority_from_scores("__sen_t", "__sen_d", seniority),
        "domain_focus": weighted_from_scores("__dom_t", "__dom_d", domain),
    })
    return out.drop(tn, dn, rt, "__low", "__tp", "__dp", "__sp", "__ind_d", "__sen_t", "__sen_d", "__dom_t", "__dom_d")
