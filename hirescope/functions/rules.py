"""Rule tables as ordered data.

Every enrichment operator takes its rules as a parameter. A rule table is
small (hundreds of terms) and is folded into Column literals at plan time;
``match.py`` holds the join-based path for dictionaries too large for that.

Order is part of the contract everywhere: categories are tried in table
order and ties go to the earlier entry.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Taxonomy:
    """Ordered ``category -> [keyword]``; keywords are literal phrases."""

    name: str
    categories: tuple[tuple[str, tuple[str, ...]], ...]

    @classmethod
    def from_mapping(cls, name: str, mapping: Mapping[str, Sequence[str]]) -> "Taxonomy":
        return cls(name, tuple((c, tuple(kws)) for c, kws in mapping.items()))

    @classmethod
    def from_table(cls, df: DataFrame, name: str) -> "Taxonomy":
        """Build from a rule table ``(taxonomy, cat_ord, category, kw_ord, keyword)``.

        Rule tables are dimensions of a few hundred rows, so reading them on
        the driver is bounded by the rules, not by the data.
        """
        rows = (
            df.where(df.taxonomy == name)
            .select("cat_ord", "category", "kw_ord", "keyword")
            .orderBy("cat_ord", "kw_ord")
            .collect()
        )
        cats: dict[str, list[str]] = {}
        for r in rows:
            cats.setdefault(r.category, []).append(r.keyword)
        return cls.from_mapping(name, cats)

    def rows(self) -> list[tuple[str, int, str, int, str]]:
        return [
            (self.name, ci, cat, ki, kw)
            for ci, (cat, kws) in enumerate(self.categories)
            for ki, kw in enumerate(kws)
        ]

    @property
    def names(self) -> list[str]:
        return [c for c, _ in self.categories]


@dataclass(frozen=True)
class Rule:
    """One cascade step.

    mode ``any``: any term of ``groups[0]`` is a substring;
    ``equals``: the text equals one of ``groups[0]``;
    ``all``: every group has at least one substring hit.
    """

    output: str
    mode: str
    groups: tuple[tuple[str, ...], ...]


@dataclass(frozen=True)
class Cascade:
    rules: tuple[Rule, ...]
    default: str = "other"

    @classmethod
    def of(cls, steps: Iterable[tuple[str, str, Sequence[Sequence[str]]]], default: str = "other") -> "Cascade":
        return cls(tuple(Rule(o, m, tuple(tuple(g) for g in gs)) for o, m, gs in steps), default)

    @classmethod
    def from_table(cls, df: DataFrame, default: str = "other") -> "Cascade":
        """Build from ``(ord, output, mode, groups array<array<string>>)``."""
        rows = df.orderBy("ord").collect()
        return cls.of(((r.output, r.mode, r.groups) for r in rows), default)


@dataclass(frozen=True)
class SkillPatterns:
    """Ordered ``skill -> [regex]`` (Python regex syntax, as written by users)."""

    skills: tuple[tuple[str, tuple[str, ...]], ...]

    @classmethod
    def from_mapping(cls, mapping: Mapping[str, Sequence[str]]) -> "SkillPatterns":
        return cls(tuple((s, tuple(ps)) for s, ps in mapping.items()))

    @classmethod
    def from_table(cls, df: DataFrame) -> "SkillPatterns":
        """Build from ``(skill, pattern)``; first appearance fixes the order."""
        out: dict[str, list[str]] = {}
        for r in df.select("skill", "pattern").collect():
            out.setdefault(r.skill, []).append(r.pattern)
        return cls.from_mapping(out)


# ---------------------------------------------------------------------------
# FIXED VALUES — the posting rules. These must equal the reference's rule
# files and classifier term lists for identical results; kept verbatim, in
# their natural order.
# ---------------------------------------------------------------------------

ENRICHMENT_RULES: dict[str, dict[str, list[str]]] = {
    "hiring_industry": {
        "banking_finance": ["banque", "bancaire", "services financiers", "financial services",
                            "marches financiers", "gestion d'actifs", "asset management", "trading", "crypto"],
        "insurance": ["assurance", "assureur", "mutuelle", "sinistre"],
        "retail_ecommerce": ["retail", "distribution", "e-commerce", "ecommerce", "magasin", "order-book"],
        "consulting_services": ["cabinet de conseil", "consulting", "esn", "services numeriques",
                                "mission chez un client", "clients grands comptes"],
        "travel_hospitality": ["tourisme", "vacances", "hospitality", "resort", "club med",
                               "pierre et vacances", "center parcs"],
        "public_sector": ["secteur public", "administration", "ministere", "collectivite", "fonction publique"],
        "health_research": ["sante", "medical", "pharma", "biologie", "hopital", "clinique", "inserm"],
        "aerospace_defense": ["aeronautique", "aerospatial", "defense", "aviation", "safran"],
        "manufacturing_industry": ["nucleaire", "centrales", "usine", "manufacturing"],
        "tech_product": ["saas", "startup", "plateforme technologique", "digital product", "produit digital"],
    },
    "seniority_level": {
        "intern_apprentice": ["stagiaire", "alternance", "apprentissage", "intern"],
        "junior": ["junior", "debutant", "premiere experience"],
        "mid": ["2 ans d'expérience", "3 ans d'expérience", "4 ans d'expérience", "3 ans minimum",
                "4 ans minimum", "3 à 5 ans", "3-5 ans", "experience confirmee", "expérience confirmée",
                "experience significative", "expérience significative", "premiere experience en entreprise",
                "first experience", "first professional experience"],
        "senior": ["senior", "experimente", "confirme"],
        "lead": ["tech lead", "lead tech", "team lead"],
        "manager": ["engineering manager", "data manager", "manager data", "manager analytics", "chef de projet"],
        "architect_principal": ["architecte", "principal", "design authority"],
    },
    "domain_focus": {
        "data_platform": ["data factory", "data platform", "etl", "elt", "datalake", "data warehouse",
                          "bigquery", "databricks", "spark", "pyspark", "airflow", "dataform", "sqlx", "pipeline"],
        "bi_reporting": ["power bi", "tableau", "looker", "looker studio", "business intelligence", "sap bi"],
        "ml_ai": ["machine learning", "tensorflow", "keras", "pytorch", "mlflow", "vertex ai"],
        "genai_llm": ["llm", "genai", "intelligence artificielle generative", "rag", "langchain",
                      "langfuse", "flowise", "n8n"],
        "data_governance_quality": ["data quality", "qualite des donnees", "data governance", "gouvernance",
                                    "catalogue de donnees", "data steward"],
        "cloud_devops": ["terraform", "kubernetes", "helm", "ci/cd", "gitlab ci", "github actions", "docker",
                         "prometheus", "grafana", "devops"],
        "analytics_product": ["data product", "people analytics", "analytics engineer"],
        "embedded_iot": ["embarque", "temps reel", "iot", "robotique"],
    },
}

SKILL_DICTIONARY: dict[str, list[str]] = {
    "python": [r"\bpython\b"],
    "sql": [r"\bsql\b"],
    "pyspark": [r"\bpyspark\b"],
    "spark": [r"\bspark\b"],
    "scala": [r"\bscala\b"],
    "r": [r"\brstudio\b", r"\bshiny\b", r"\btidyverse\b", r"\bggplot2\b", r"\bdplyr\b", r"\bcaret\b",
          r"\blangage r\b", r"\br language\b",
          r"(?:(?:python|sql|tableau|power bi)[\s,;/()\-]+r\b)",
          r"(?:\br\b[\s,;/()\-]+(?:python|sql|tableau|power bi))"],
    "airflow": [r"\bairflow\b"],
    "dbt": [r"\bdbt\b"],
    "kafka": [r"\bkafka\b"],
    "snowflake": [r"\bsnowflake\b"],
    "bigquery": [r"\bbigquery\b"],
    "redshift": [r"\bredshift\b"],
    "databricks": [r"\bdatabricks\b"],
    "aws": [r"\baws\b", r"\bamazon web services\b"],
    "azure": [r"\bazure\b"],
    "gcp": [r"\bgcp\b", r"\bgoogle cloud\b", r"\bgoogle cloud platform\b"],
    "terraform": [r"\bterraform\b"],
    "docker": [r"\bdocker\b"],
    "kubernetes": [r"\bkubernetes\b", r"\bk8s\b"],
    "git": [r"\bgit\b", r"\bgithub\b", r"\bgitlab\b"],
    "tableau": [r"\btableau\b"],
    "power_bi": [r"\bpower\s*bi\b", r"\bpowerbi\b"],
    "looker": [r"\blooker\b", r"\blooker studio\b"],
    "tensorflow": [r"\btensorflow\b"],
    "pytorch": [r"\bpytorch\b"],
    "scikit_learn": [r"\bscikit-learn\b", r"\bsklearn\b"],
    "langchain": [r"\blangchain\b"],
    "mlflow": [r"\bmlflow\b"],
    "java": [r"\bjava\b"],
    "go": [r"\bgo\b", r"\bgolang\b"],
    "rust": [r"\brust\b"],
    "javascript": [r"\bjavascript\b", r"\bjs\b"],
    "typescript": [r"\btypescript\b", r"\bts\b"],
    "spring": [r"\bspring\b", r"\bspring boot\b"],
    "node": [r"\bnode\b", r"\bnodejs\b"],
    "fastapi": [r"\bfastapi\b"],
    "django": [r"\bdjango\b"],
    "flask": [r"\bflask\b"],
    "grpc": [r"\bgrpc\b"],
    "rest_api": [r"\brest api\b", r"\brestful\b"],
    "graphql": [r"\bgraphql\b"],
    "trino": [r"\btrino\b"],
    "presto": [r"\bpresto\b"],
    "hadoop": [r"\bhadoop\b"],
    "flink": [r"\bflink\b"],
    "huggingface": [r"\bhuggingface\b"],
    "llamaindex": [r"\bllamaindex\b"],
    "helm": [r"\bhelm\b"],
    "prometheus": [r"\bprometheus\b"],
    "grafana": [r"\bgrafana\b"],
}

# Role-family cascade: (output, mode, groups), tried top to bottom, first hit
# wins, default "other". Terms are matched against the cleaned title.
ROLE_CASCADE_STEPS: list[tuple[str, str, list[list[str]]]] = [
    ("other", "any", [[
        "data center", "géotechnicien", "geotechnicien", "nucleaire", "nucléaire", "dessinateur projeteur",
        "hardware", "bâtiment", "batiment", "poste de travail", "robotique industrielle", "technicien eia",
        "planificateur nucléaire", "expert vol", "génomique", "genomique", "géotech", "geotech"]]),
    ("other", "equals", [["ide", "cdi ide", "idec", "expert"]]),
    ("machine_learning_engineer", "any", [[
        "machine learning engineer", "ml engineer", "ingénieur machine learning", "ingenieur machine learning",
        "devops machine learning"]]),
    ("ai_engineer", "any", [[
        "ai engineer", "ia engineer", "ingénieur ia", "ingenieur ia", "développeur intelligence artificielle",
        "developpeur intelligence artificielle", "développeur ia", "developpeur ia", "spécialiste ia",
        "specialiste ia", "datascientist expert en ia", "consultant data / ia",
        "alternance ingénieur en intelligence artificielle", "alternance ingenieur en intelligence artificielle",
        "alternance développeur ia", "alternance developpeur ia", "prompt engineering", "genai", "llm",
        "agentique", "data & ai", "intelligence artificielle"]]),
    ("devops_engineer", "any", [[
        "ingénieur devops", "ingenieur devops", "devops engineer", "devops microsoft",
        "ingénieur.e d'études devops", "ingenieur.e d'études devops", "ingénieur build cloud",
        "ingenieur build cloud", "cloud public", "devops plateforme ia", "exploitation mainframe",
        "systèmes linux", "systemes linux", "intégrateur systèmes linux", "integrateur systemes linux"]]),
    ("analytics_engineer", "any", [["analytics engineer"]]),
    ("data_scientist", "any", [["data scientist"]]),
    ("data_analyst", "any", [[
        "data analyst", "analyste data", "analyste de données", "analyste de donnees", "analyste de donnée",
        "analyste de donnee", "web analyst"]]),
    ("bi_analytics", "any", [[
        "business intelligence", "bi analyst", "analyste bi", "bi developer", "développeur bi",
        "developpeur bi", "consultant bi", "data visualisation", "data visualization", "power bi", "sap bo"]]),
    ("data_engineer", "any", [[
        "data engineer", "data - engineer", "data ingénieur", "ingenieur data", "ingénieur data",
        "tech lead data", "manager data factory", "développeur etl", "developpeur etl", "mdm",
        "ingénieur opex data", "ingenieur opex data", "analyste production informatique data"]]),
    ("data_governance", "any", [[
        "data gouvernance", "data governance", "data quality", "master data", "data steward",
        "contrôleur de données", "controleur de donnees", "protect data"]]),
    ("data_architect", "any", [["architecte data", "data architect", "data platform", "platform engineer"]]),
    ("backend_engineer", "any", [[
        "backend engineer", "backend developer", "ingénieur backend", "ingenieur backend",
        "développeur backend", "developpeur backend", "java backend"]]),
    ("software_architect", "any", [[
        "architecte logiciel", "architecte logiciels", "architecte solution", "architecte solutions",
        "architecte fonctionnel", "architecte apps", "architecte applicatif"]]),
    ("software_engineer", "any", [[
        "software engineer", "software developer", "ingénieur logiciel", "ingenieur logiciel",
        "ingénieur software", "ingenieur software", "ingénieur développement logiciel",
        "ingenieur développement logiciel", "ingénieur / ingénieure développement logiciel",
        "ingénieur de développement logiciel", "ingénieur / ingénieure d'étude logiciel informatique",
        "développeur logiciel", "developpeur logiciel", "concepteur logiciel",
        "concepteur développeur d'applications", "concepteur developpeur d'applications",
        "concepteur / conceptrice d'application informatique", "concepteur / conceptrice logiciel informatique",
        "développeur / développeuse d'application", "developpeur / developpeuse d'application",
        "développeur / développeuse logiciel ou d'application", "developpeur / developpeuse logiciel ou d'application",
        "développeur informatique", "developpeur informatique", "developpeur applicatif",
        "informaticien / informaticienne d'application", "programmeur", "lead developer", "développeur java",
        "developpeur java", "développeur .net", "developpeur .net", "développeur c++", "developpeur c++",
        "développeur drupal", "developpeur drupal", "développeur windev", "developpeur windev",
        "développeur expérimenté", "developpeur expérimenté", "développeur fullstack", "developpeur fullstack",
        "tech lead java", "responsable développement - java", "responsable developpement - java",
        "chef de projet logiciel", "gestionnaire applicatif", "responsable activité logiciel",
        "responsable activite logiciel", "responsable d'application", "responsable d'application informatique",
        "logiciel embarqué", "logiciel embarque", "expert logiciel embarqué", "expert logiciel embarque",
        "qualification et validation logiciel", "qualité logiciel", "qualite logiciel",
        "responsable technique logiciel embarqué", "responsable technique logiciel embarque",
        "ingénieur qualité logiciel", "ingenieur qualite logiciel"]]),
    ("data_management", "any", [[
        "head of data", "data manager", "manager data optimisation", "manager data optimization",
        "manager data & ai"]]),
    ("data_project", "any", [["chef de projet data"]]),
    ("data_analyst", "all", [["analyste"], ["donnée", "donnee", "donnees", "données"]]),
    ("software_engineer", "all", [["ingénieur", "ingenieur"], ["logiciel", "software"]]),
    ("software_engineer", "all", [["développeur", "developpeur"], ["java", ".net", "c++"]]),
    ("devops_engineer", "all", [["devops", "cloud"], ["ingénieur", "ingenieur", "architecte"]]),
]

# Search keywords in ingestion order; the rank decides which duplicate of an
# offer is kept (earliest keyword wins).
SEARCH_KEYWORDS: list[str] = [
    "data engineer", "ingénieur data",
    "data scientist", "machine learning engineer", "ingénieur machine learning", "ml engineer",
    "ai engineer", "ingénieur ia",
    "data analyst", "analyste data", "bi analyst", "analyste bi", "bi developer", "développeur bi",
    "business intelligence", "data visualization", "data visualisation",
    "backend engineer", "backend developer", "ingénieur backend", "développeur backend",
    "software engineer", "software developer", "ingénieur logiciel", "développeur logiciel",
    "analytics engineer",
]

SENIORITY_LADDER: list[str] = [
    "intern_apprentice", "junior", "mid", "senior", "lead", "manager", "architect_principal",
]

# Levels a description alone may assign (the title may assign any level).
DESCRIPTION_SENIORITY: list[str] = ["junior", "intern_apprentice", "mid", "senior"]

# Role values that do not count as a relevant classification.
IRRELEVANT_ROLES: list[str] = ["other", "false_positive"]

# Data-quality acceptance thresholds (percent, except the row count).
QUALITY_THRESHOLDS: dict[str, tuple[str, float]] = {
    "total_rows": (">", 0.0),
    "title_clean_populated_pct": (">=", 95.0),
    "relevant_role_family_pct": (">=", 60.0),
}

SOURCE_NAME = "francetravail"

# ---------------------------------------------------------------------------

INDUSTRY = Taxonomy.from_mapping("hiring_industry", ENRICHMENT_RULES["hiring_industry"])
SENIORITY = Taxonomy.from_mapping("seniority_level", ENRICHMENT_RULES["seniority_level"])
DOMAIN = Taxonomy.from_mapping("domain_focus", ENRICHMENT_RULES["domain_focus"])
SKILLS = SkillPatterns.from_mapping(SKILL_DICTIONARY)
ROLE_CASCADE = Cascade.of(ROLE_CASCADE_STEPS)


def rule_tables(spark) -> dict[str, DataFrame]:
    """The fixed rules as the small dimension tables named in FIXTURES.md."""
    tax = spark.createDataFrame(
        INDUSTRY.rows() + SENIORITY.rows() + DOMAIN.rows(),
        "taxonomy string, cat_ord int, category string, kw_ord int, keyword string",
    )
    skills = spark.createDataFrame(
        [(s, p) for s, ps in SKILLS.skills for p in ps], "skill string, pattern string"
    )
    cascade = spark.createDataFrame(
        [(i, r.output, r.mode, [list(g) for g in r.groups]) for i, r in enumerate(ROLE_CASCADE.rules)],
        "ord int, output string, mode string, groups array<array<string>>",
    )
    keywords = spark.createDataFrame(list(enumerate(SEARCH_KEYWORDS)), "rank int, keyword string")
    ladder = spark.createDataFrame(list(enumerate(SENIORITY_LADDER)), "rank int, level string")
    return {
        "taxonomy_rules": tax,
        "skill_patterns": skills,
        "role_cascade": cascade,
        "search_keywords": keywords,
        "seniority_ladder": ladder,
    }
