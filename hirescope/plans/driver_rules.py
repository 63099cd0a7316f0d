"""Rule tables for running the operators on the driver's tables.

The driver tables are not job postings, so the posting rules find almost
nothing there. Every operator takes its rules as a parameter; these are the
parameters that make the same operators produce real rows (with ties,
unknowns and multi-category cases) on parts, orders, events and documents.
"""

from __future__ import annotations

import re

from ..functions import rules as R
from ..functions.rules import Cascade, SkillPatterns, Taxonomy

# part.p_name stands in for a job title ("red bolt", "old gizmo", ...).
PART_CASCADE = Cascade.of([
    ("other", "any", [["old"]]),
    ("other", "equals", [["hot rod", "cold ring"]]),
    ("gear_maker", "any", [["gear", "gizmo"]]),
    ("widget_maker", "any", [["widget"]]),
    ("metal_worker", "all", [["red", "blue"], ["bolt", "rod", "plate"]]),
    ("tool_smith", "all", [["large", "small"], ["anvil", "ring"]]),
], default="other")

# documents: a stop-word taxonomy; "de" and "una" are shared on purpose so
# French / Spanish texts produce ties.
LANG_TAXONOMY = Taxonomy.from_mapping("lang", {
    "en": ["the", "and", "of", "with", "this"],
    "fr": ["de", "la", "et", "les", "une", "pour"],
    "de": ["der", "und", "nicht", "mit", "für", "ein"],
    "es": ["de", "el", "los", "las", "una", "para"],
})

# Levels the body alone may assign in the priority rule (E3b stand-in).
LANG_FROM_BODY = ["en", "fr"]

# documents: a regex dictionary in Python syntax.
DOC_PATTERNS = SkillPatterns.from_mapping({
    "license": [r"\blicen[cs]e[sd]?\b"],
    "mit": [r"\bmit license\b", r"\bmit\b"],
    "token": [r"\btokens?\b"],
    "test": [r"\btest\b"],
    "email": [r"[a-z0-9._-]+@[a-z0-9-]+(?:\.[a-z0-9-]+)+"],
    "secret": [r"\bapi[_-]?key\b", r"\bsecret\b", r"\bpassword\b"],
    "released": [r"\breleased\s+under\b"],
})

# events: event types as search keywords, in ingestion order; "refund" has
# no rows, so the summary must list it with 0.
EVENT_KEYWORDS = ["view", "click", "purchase", "signup", "error", "refund"]

# orders: order status as a seniority ladder ("P" stands for unknown).
STATUS_LADDER = ["O", "F"]

# part as raw postings: the terms of the posting rules in the order of their
# lists; a part's key picks from each list, so that all of them occur.
ROLE_TERMS = [term for rule in R.ROLE_CASCADE.rules for group in rule.groups for term in group]
INDUSTRY_TERMS = [kw for _, kws in R.INDUSTRY.categories for kw in kws]
SENIORITY_TERMS = [kw for _, kws in R.SENIORITY.categories for kw in kws]
DOMAIN_TERMS = [kw for _, kws in R.DOMAIN.categories for kw in kws]
# a skill's first pattern that is a plain word or phrase, else its name
SKILL_TERMS = [next((w[0] for p in patterns if (w := re.findall(r"^\\b([a-z0-9 ]+)\\b$", p))), skill.replace("_", " "))
               for skill, patterns in R.SKILLS.skills]
