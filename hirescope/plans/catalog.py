"""Registered queries: every inventory operator run over the driver tables.

Each entry is ``(spark, sf_dir) -> DataFrame`` and calls the library
operators (marts, reports, enrichment, quality, ...) with column names and
rule tables as parameters. Stand-ins
follow SURVEY §5.3: part names are titles and two-word skill lists, orders
give roles x levels and months, events give daily snapshots, documents and
pages give the text operators.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import enrich as E
from ..functions import rules as R
from ..functions import text as X
from ..operators import dedupe as D
from ..operators import lake as L
from ..operators import marts as M
from ..operators import quality as Q
from ..operators import reports as P
from ..session import shared_dir, spread
from ..sources import offers as S
from ..sources.snapshots import commit, write_attempt
from . import driver_rules as TR
from . import lake_counts as LC

Query = Callable[[SparkSession, str], DataFrame]
SNAPSHOT = "2024-01-15"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------ stand-ins ---

def part_postings(spark, sf_dir) -> DataFrame:
    """part as postings: title -> role via the test cascade, name words as
    skills, type as a second role column, brand as the posting id."""
    p = table(spark, sf_dir, "part")
    return E.with_classification(p, "p_name", "role_family", TR.PART_CASCADE).select(
        "p_partkey", "p_brand", "role_family",
        F.col("p_type").alias("type_role"),
        F.split(F.col("p_name"), " ").alias("skills"),
    )


def part_by_type(spark, sf_dir) -> DataFrame:
    return part_postings(spark, sf_dir).select(
        "p_partkey", "p_brand", F.col("type_role").alias("role_family"), "skills"
    )


def order_postings(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("other")).otherwise(F.col("o_orderpriority")).alias("role_family"),
        F.when(F.col("o_orderstatus") == "P", F.lit("unknown")).otherwise(F.col("o_orderstatus")).alias("seniority_level"),
        F.when(F.col("o_totalprice") >= 200000, F.lit("high"))
        .when(F.col("o_totalprice") >= 50000, F.lit("mid"))
        .otherwise(F.lit("unknown")).alias("domain_focus"),
        F.col("o_orderdate").alias("created_at"),
    )


def event_snapshots(spark, sf_dir) -> DataFrame:
    """events as a lake: dt = day, role = event type, skills = key=value
    pairs of the JSON props."""
    e = table(spark, sf_dir, "events")
    props = F.from_json(F.col("props"), "map<string,string>")
    return e.select(
        F.to_date("ts").alias("dt"),
        F.col("event_type").alias("role_family"),
        F.transform(F.map_entries(props), lambda kv: F.concat(kv["key"], F.lit("="), kv["value"])).alias("skills"),
    )


def doc_texts(spark, sf_dir) -> DataFrame:
    """documents with their normalised title (first line) and body, each
    computed once in its own projection."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select(
        "doc_id",
        X.normalize_for_match(F.substring_index(F.col("text"), "\n", 1)).alias("title_norm"),
        X.normalize_for_match(F.col("text")).alias("body_norm"),
    )


def page_parts(spark, sf_dir) -> DataFrame:
    pg = table(spark, sf_dir, "pages")
    return pg.select(
        "page_id", "html",
        F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1).alias("title"),
        F.regexp_extract("html", "(?is)<h1[^>]*>(.*?)</h1>", 1).alias("heading"),
    )


def md5_of(c: Column) -> Column:
    return F.md5(F.coalesce(c, F.lit("\u0000null")))


# ----------------------------------------------------------- part marts ---

def q_role_demand(spark, sf_dir):
    return M.role_demand(part_postings(spark, sf_dir))


def q_role_distribution(spark, sf_dir):
    return L.role_distribution(part_postings(spark, sf_dir))


def q_skill_demand(spark, sf_dir):
    return M.skill_demand(part_postings(spark, sf_dir))


def q_role_skill_demand(spark, sf_dir):
    return M.role_skill_demand(part_by_type(spark, sf_dir))


def q_skill_demand_by_role(spark, sf_dir):
    return M.skill_demand_by_role(part_by_type(spark, sf_dir))


def q_role_skill_distinct(spark, sf_dir):
    return M.role_skill_demand_distinct(part_by_type(spark, sf_dir), key="p_brand")


def q_lake_role_skill(spark, sf_dir):
    return L.role_skill_distribution(part_postings(spark, sf_dir))


def q_lake_skill_distribution(spark, sf_dir):
    return L.skill_distribution(part_postings(spark, sf_dir))


def q_top_skills_per_role(spark, sf_dir):
    dem = M.role_skill_demand(part_by_type(spark, sf_dir))
    return P.top_k(dem, 5, P.by_demand("skill"), by=["role_family"])


def q_topk_skills(spark, sf_dir):
    return P.top_k(M.skill_demand(part_postings(spark, sf_dir)), 5, P.by_demand("skill"))


def q_topk_roles(spark, sf_dir):
    return P.top_k(M.role_demand(part_postings(spark, sf_dir)), 3, P.by_demand("role_family"))


def q_role_top_skills(spark, sf_dir):
    dem = M.role_skill_demand(part_by_type(spark, sf_dir))
    return P.top_skills_of_role(dem, "PROMO", k=10)


def q_kpis(spark, sf_dir):
    posts = part_postings(spark, sf_dir)
    return P.kpis(M.role_demand(posts), M.skill_demand(posts), M.role_skill_demand(part_by_type(spark, sf_dir)))


def q_dataset_summary(spark, sf_dir):
    return P.dataset_summary(part_postings(spark, sf_dir))


def q_role_selector(spark, sf_dir):
    return P.distinct_sorted(M.role_demand(part_postings(spark, sf_dir)), "role_family")


# --------------------------------------------------------- order marts ----

def q_demand_by_seniority(spark, sf_dir):
    return P.ordered(M.role_demand_by_seniority(order_postings(spark, sf_dir)), P.by_role_then_demand("seniority_level"))


def q_demand_by_domain(spark, sf_dir):
    return M.role_demand_by_domain_focus(order_postings(spark, sf_dir))


def q_domains_of_role(spark, sf_dir):
    dem = M.role_demand_by_domain_focus(order_postings(spark, sf_dir))
    return P.role_levels(dem, "1-URGENT", "domain_focus")


def q_seniority_ladder(spark, sf_dir):
    dem = M.role_demand_by_seniority(order_postings(spark, sf_dir))
    return P.role_levels(dem, "2-HIGH", "seniority_level", ladder=TR.STATUS_LADDER)


def q_role_trends_by_month(spark, sf_dir):
    return P.ordered(M.role_trends_by_month(order_postings(spark, sf_dir)), P.by_month("month", "role_family"))


def lineitem_skill_trends(spark, sf_dir) -> DataFrame:
    """A7 at volume: line items (by ship month) x the words of the part name.

    Line items are first counted per (month, part) — map-side combined, so a
    hot part costs nothing extra — and only those counts meet ``part`` in the
    join; the explode then runs on one row per (month, part).
    """
    li = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate").isNotNull())
    per_part = li.groupBy(M.month_of("l_shipdate").alias("month"), F.col("l_partkey")).agg(
        F.count(F.lit(1)).alias("n"))
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.split(F.col("p_name"), " ").alias("skills"))
    joined = per_part.join(parts, "l_partkey")
    exploded = M.explode_terms(joined.select("month", "n", "skills"), "skills", "skill")
    return exploded.groupBy("month", "skill").agg(F.sum("n").cast("long").alias("demand"))


def q_skill_trends_by_month(spark, sf_dir):
    return lineitem_skill_trends(spark, sf_dir)


def q_skill_trends_by_order_month(spark, sf_dir):
    """A7 through the generic mart: orders as postings, priority words as skills."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("created_at"), F.split(F.col("o_orderpriority"), "-").alias("skills"))
    return M.skill_trends_by_month(o)


def q_topskill_trends(spark, sf_dir):
    trends = lineitem_skill_trends(spark, sf_dir)
    dem = M.role_skill_demand(part_by_type(spark, sf_dir))
    return P.top_skill_trends(trends, dem, "PROMO", k=5)


def q_monthly_role_trend_of_role(spark, sf_dir):
    """A31 for one role (the dashboard line for one series)."""
    return P.for_value(M.role_trends_by_month(order_postings(spark, sf_dir)), "role_family", "3-MEDIUM")


# ---------------------------------------------------------- event lake ----

def q_weekly_role_trends(spark, sf_dir):
    return P.ordered(L.snapshot_role_trends(event_snapshots(spark, sf_dir)), P.by_snapshot("dt", "role_family"))


def q_weekly_skill_trends(spark, sf_dir):
    return P.ordered(L.snapshot_skill_trends(event_snapshots(spark, sf_dir)), P.by_snapshot("dt", "skill"))


def q_lake_trends_incremental(spark, sf_dir):
    """A17 / A18 from counts kept per snapshot: a lake of weekly snapshots, of
    which the first ones are counted, one is then replaced and the others are
    added, before the counts are refreshed."""
    lake, counts = (f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}" for name in ("lake", "lake-counts"))
    e = event_snapshots(spark, sf_dir).withColumn("dt", F.date_trunc("week", "dt").cast("date"))
    weeks = [str(r.dt) for r in e.select("dt").distinct().orderBy("dt").collect()]  # one row a snapshot
    commit(spark, [write_attempt(L.one_snapshot(e, w).where("role_family <> 'click'"), lake, w) for w in weeks[:2]])
    LC.refresh(spark, lake, counts)
    commit(spark, [write_attempt(L.one_snapshot(e, w), lake, w) for w in weeks])
    LC.refresh(spark, lake, counts)
    roles = LC.role_trends(spark, counts).select("dt", F.lit("role").alias("kind"), F.col("role_family").alias("key"), "nb_offers")
    return roles.unionByName(LC.skill_trends(spark, counts).select("dt", F.lit("skill").alias("kind"), F.col("skill").alias("key"), "nb_offers"))


def q_report_orders(spark, sf_dir):
    """Where every row of the sorted reports stands, in the written result."""
    part, orders, events = part_by_type(spark, sf_dir), order_postings(spark, sf_dir), event_snapshots(spark, sf_dir)
    reports = {
        "by_demand": (M.skill_demand(part), P.by_demand("skill"), ["skill"]),
        "by_role_then_demand": (M.role_skill_demand(part), P.by_role_then_demand("skill"), ["role_family", "skill"]),
        "by_levels": (M.role_demand_by_seniority(orders), P.by_demand(["role_family", "seniority_level"]), ["role_family", "seniority_level"]),
        "by_snapshot": (L.snapshot_skill_trends(events), P.by_snapshot("dt", "skill"), ["dt", "skill"]),
        "by_month": (M.role_trends_by_month(orders), P.by_month("month", "role_family"), ["month", "role_family"]),
    }
    placed = []
    for name, (df, order, key) in reports.items():
        keys = [F.date_format(k, "yyyy-MM-dd") if k in ("dt", "month") else F.col(k) for k in key]
        placed.append(P.with_position(P.ordered(df, order)).select(
            F.lit(name).alias("report"), "position", F.concat_ws("|", *keys).alias("key")))
    return P.bag_union(placed)


def q_lake_roles_latest_only(spark, sf_dir):
    """A14 with ``latest_only``: each user (standing for a posting) counted in
    its most recent snapshot only."""
    e = table(spark, sf_dir, "events").select(
        "user_id", F.to_date("ts").alias("dt"), F.col("event_type").alias("role_family"))
    return L.role_distribution(L.latest_snapshot_only(e, key="user_id"))


def q_dt_sanity_count(spark, sf_dir):
    return L.snapshot_row_count(event_snapshots(spark, sf_dir), F.lit(SNAPSHOT).cast("date"))


def q_dt_sanity_roles(spark, sf_dir):
    return L.role_distribution(L.one_snapshot(event_snapshots(spark, sf_dir), F.lit(SNAPSHOT).cast("date")))


def q_dt_sanity_skills(spark, sf_dir):
    return L.skill_distribution(L.one_snapshot(event_snapshots(spark, sf_dir), F.lit(SNAPSHOT).cast("date")))


def q_ingestion_summary(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("search_keyword"))
    dim = spark.createDataFrame([(k,) for k in TR.EVENT_KEYWORDS], "keyword string")
    return P.keyword_summary(e, dim)


def q_quality_by_dt(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("dt"),
        F.col("props").alias("title_clean"),
        F.when(F.col("event_type") == "error", F.lit("other")).otherwise(F.col("event_type")).alias("role_family"),
        F.when(F.col("event_type") == "view", F.lit(" ")).otherwise(F.col("event_type")).alias("company_name_clean"),
    )
    return Q.metrics_over_snapshots(e)


def q_distinct_values(spark, sf_dir):
    return P.distinct_sorted(table(spark, sf_dir, "events"), "event_type")


def q_bag_union(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    finished = F.col("o_orderstatus").eqNullSafe("F")
    united = P.bag_union([o.where(finished), o.where(~finished)])
    return M.demand(united, ["o_orderstatus"], name="n")


def q_preview(spark, sf_dir):
    return P.preview(table(spark, sf_dir, "orders"),
                     ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"], ["o_orderkey"], 15)


def q_safe_timestamp(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("garbage-"), F.col("event_id").cast("string")))
        .when(F.col("event_type") == "click", F.concat(iso, F.lit("Z")))
        .when(F.col("event_type") == "view", F.concat(iso, F.lit(".000+02:00")))
        .otherwise(iso)
    )
    parsed = e.select("event_type", S.safe_timestamp(text).alias("created_at"))
    return parsed.groupBy("event_type").agg(
        F.count("created_at").alias("parsed"),
        F.count(F.lit(1)).alias("n"),
        F.min("created_at").alias("first_ts"),
        F.max("created_at").alias("last_ts"),
    )


def q_coalesce_fallback(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    libelle = (F.when(F.col("event_type") == "view", F.lit(""))
               .when(F.col("event_type") == "error", F.lit(None).cast("string"))
               .otherwise(F.col("props")))
    commentaire = F.when(F.col("event_type") == "click", F.lit(None).cast("string")).otherwise(F.col("event_type"))
    return M.demand(e.select(S.salary_fallback(libelle, commentaire).alias("salary_label")), ["salary_label"], name="n")


def q_flatten_json(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_type", F.from_json("props", "k bigint").alias("p"))
    return e.groupBy("event_type").agg(
        F.sum("p.k").alias("k_sum"), F.max("p.k").alias("k_max"), F.count("p.k").alias("k_n"))


# ----------------------------------------------------------- documents ----

def q_dedupe_keep_first(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    kept = D.dedupe_first(d, "text", ["source", "doc_id"], "doc_id")
    return kept.select("doc_id", "lang", "source", "n_chars")


def q_dedupe_counts(spark, sf_dir):
    return D.dedupe_counts(table(spark, sf_dir, "documents"), "text")


def lang_scores(spark, sf_dir) -> DataFrame:
    """Score arrays of title and body, each in its own projection."""
    d = doc_texts(spark, sf_dir).withColumns({
        "tp": E.keyword_presence(F.col("title_norm"), TR.LANG_TAXONOMY),
        "bp": E.keyword_presence(F.col("body_norm"), TR.LANG_TAXONOMY),
    })
    return d.withColumns({
        "title_scores": E.score_array("title_norm", TR.LANG_TAXONOMY, "tp"),
        "body_scores": E.score_array("body_norm", TR.LANG_TAXONOMY, "bp"),
    })


def q_infer_category(spark, sf_dir):
    d = E.with_category(doc_texts(spark, sf_dir), "body_norm", TR.LANG_TAXONOMY, "category")
    return d.select("doc_id", "category")


def q_infer_category_multi(spark, sf_dir):
    d = E.with_category(doc_texts(spark, sf_dir), "body_norm", TR.LANG_TAXONOMY, "category", multi=True)
    return d.select("doc_id", "category")


def q_score_categories(spark, sf_dir):
    d = lang_scores(spark, sf_dir)
    scores = E.scores_as_structs(F.col("body_scores"), TR.LANG_TAXONOMY)
    as_text = F.array_join(F.transform(scores, lambda s: F.concat(s["category"], F.lit(":"), s["score"].cast("string"))), ",")
    return d.select("doc_id", as_text.alias("scores"))


def q_infer_with_priority(spark, sf_dir):
    d = lang_scores(spark, sf_dir)
    return d.select("doc_id", E.priority_from_scores(
        "title_scores", "body_scores", TR.LANG_TAXONOMY, TR.LANG_FROM_BODY).alias("category"))


def q_weighted_domain(spark, sf_dir):
    d = lang_scores(spark, sf_dir)
    return d.select("doc_id", E.weighted_from_scores(
        "title_scores", "body_scores", TR.LANG_TAXONOMY).alias("category"))


def q_language_demand(spark, sf_dir):
    """E2 feeding a mart: category -> documents (A1 shape on enriched text)."""
    d = E.with_category(doc_texts(spark, sf_dir), "body_norm", TR.LANG_TAXONOMY, "role_family")
    return M.demand(d, ["role_family"])


def q_match_terms_categories(spark, sf_dir):
    """J4 join path: the stop-word taxonomy as a dictionary table, matched by
    a window join; same result as ``infer_category``."""
    from ..operators import match as J
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    dictionary = J.prepare_dictionary(J.taxonomy_table(spark, TR.LANG_TAXONOMY))
    return J.infer_category_by_join(d, "doc_id", "text", dictionary)


def doc_skills(spark, sf_dir, patterns) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return E.with_skills(d, "text", "skills", patterns).select("doc_id", "skills")


def q_extract_skills(spark, sf_dir):
    return doc_skills(spark, sf_dir, TR.DOC_PATTERNS).select("doc_id", F.array_join("skills", ",").alias("skills"))


def q_skills_exploded(spark, sf_dir):
    return M.skill_demand(doc_skills(spark, sf_dir, TR.DOC_PATTERNS))


def q_normalize_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    n = X.normalize_text(F.col("text"))
    return d.select("doc_id", F.length(n).cast("long").alias("n_chars"), F.md5(n).alias("md5"))


# --------------------------------------------------------------- pages ----

def q_clean_text(spark, sf_dir):
    pg = page_parts(spark, sf_dir)
    c = X.clean_text(F.col("html"))
    return pg.select("page_id", F.length(c).cast("long").alias("n_chars"), md5_of(c).alias("md5"))


def q_clean_title(spark, sf_dir):
    pg = page_parts(spark, sf_dir)
    return pg.select("page_id", X.clean_title(F.col("title")).alias("title_clean"))


def q_clean_company(spark, sf_dir):
    pg = page_parts(spark, sf_dir)
    return pg.select("page_id", X.clean_company(F.col("heading")).alias("company_name_clean"))


# ------------------------------------------------------------- quality ----

def labelled_docs(spark, sf_dir) -> DataFrame:
    """documents left-joined to labels (partial cover -> real nulls), shaped
    like staged postings: text = title, label = role, source = company."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    lb = table(spark, sf_dir, "labels")
    j = d.join(lb, "doc_id", "left")
    return j.select(
        "doc_id", "lang", "quality", "toxic",
        F.col("text").alias("title_clean"),
        F.when(F.col("quality") == 1, F.lit("good")).when(F.col("quality") == 0, F.lit("other")).alias("role_family"),
        F.when(F.col("toxic") == 1, F.lit(None).cast("string")).otherwise(F.col("source")).alias("company_name_clean"),
    )


def q_quality_metrics(spark, sf_dir):
    return Q.metrics(labelled_docs(spark, sf_dir))


def q_quality_gate(spark, sf_dir):
    m = Q.metrics(labelled_docs(spark, sf_dir))
    return m.where(F.col("passed").isNotNull()).select("metric", "passed")


def q_not_null_tests(spark, sf_dir):
    return Q.not_null_tests(labelled_docs(spark, sf_dir), ["doc_id", "title_clean", "role_family", "quality", "toxic"])


def q_unique_tests(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return P.bag_union([Q.unique_test(d, "doc_id"), Q.unique_test(d, "text")])


def q_coverage(spark, sf_dir):
    return P.coverage(labelled_docs(spark, sf_dir), ["lang", "role_family", "quality"])


# ------------------------------------------- the posting rules, whole ----

def raw_postings(spark, sf_dir) -> DataFrame:
    """part as raw postings in the landed shape: titles and descriptions hold
    terms of the posting rules, picked from their lists by the part key (see
    ``driver_rules``), so that every rule occurs. The rules are heavy in each
    row, a file of narrow rows is a task or two."""
    p = spread(table(spark, sf_dir, "part"))
    k = F.col("p_partkey").cast("long")

    def pick(terms, factor, shift=0):
        return F.element_at(X.lit_array(terms), ((k * factor + shift) % len(terms) + 1).cast("int"))

    def when(divisor, c):
        return F.when(k % divisor == 0, c).otherwise(F.lit(""))

    title = F.concat(F.col("p_name"), F.lit(" "), pick(TR.ROLE_TERMS, 1), when(5, F.concat(F.lit(" / "), pick(TR.ROLE_TERMS, 31, 11))),
                     when(3, F.concat(F.lit(" - "), pick(TR.SENIORITY_TERMS, 7))), when(2, F.lit(" (H/F)")))
    body = F.concat(
        F.lit("<p>"), pick(TR.INDUSTRY_TERMS, 1), F.lit(", "), pick(TR.INDUSTRY_TERMS, 1, 1), F.lit(", "), pick(TR.INDUSTRY_TERMS, 3, 1),
        F.lit("</p><br/>"), pick(TR.DOMAIN_TERMS, 5), F.lit(" &amp; "), pick(TR.DOMAIN_TERMS, 11, 3), when(4, F.concat(F.lit("; "), pick(TR.SENIORITY_TERMS, 13))),
        F.lit(" <b>"), pick(TR.SKILL_TERMS, 1), F.lit("</b>, "), pick(TR.SKILL_TERMS, 17, 5), F.lit(". "), F.col("p_type"))
    company = F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.col("p_brand"), when(4, F.lit(" &amp;amp; Co."))))
    date = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (k % 90).cast("int")), "yyyy-MM-dd'T'HH:mm:ss")
    none = F.lit(None).cast("string")
    return p.select(
        k.cast("string").alias("id"), title.alias("intitule"), body.alias("description"),
        none.alias("romeCode"), none.alias("romeLibelle"),
        F.when(k % 6 == 0, F.lit("unknown")).otherwise(F.concat(date, F.lit("Z"))).alias("dateCreation"), none.alias("dateActualisation"),
        F.when(k % 8 != 0, F.struct(F.col("p_brand").alias("libelle"))).alias("lieuTravail"),
        F.when(k % 9 != 0, F.struct(company.alias("nom"))).alias("entreprise"),
        F.when(k % 4 != 0, F.struct(when(3, F.col("p_brand")).alias("libelle"), F.col("p_type").alias("commentaire"))).alias("salaire"),
        none.alias("typeContrat"), none.alias("typeContratLibelle"), none.alias("search_keyword"))


def staged_postings(spark, sf_dir) -> DataFrame:
    """The landed shape through flatten, enrichment and the staging view."""
    return S.staging_view(S.stage_offers(S.flatten_offer(raw_postings(spark, sf_dir))))


def q_stage_postings(spark, sf_dir):
    """Every staged column that has a value, skills joined."""
    return staged_postings(spark, sf_dir).select(
        "offer_id", "title_clean", "role_family", "created_at", "department_or_location", "company_name_clean", "salary_label",
        F.md5("description_clean").alias("description_md5"), F.array_join("skills", ",").alias("skills"),
        "hiring_industry", "seniority_level", "domain_focus", "source")


def q_posting_views(spark, sf_dir):
    """The registered views over a staged table (parts with their type as
    level and their brand as domain), read by SQL."""
    k = F.col("p_partkey").cast("long")
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (k % 90).cast("int")), "yyyy-MM-dd'T'HH:mm:ss")
    S.register_views(part_postings(spark, sf_dir).select(
        "role_family", "skills", F.when(F.col("type_role") == "PROMO", "unknown").otherwise(F.col("type_role")).alias("seniority_level"),
        F.col("p_brand").alias("domain_focus"), F.when(k % 6 == 0, "unknown").otherwise(day).alias("created_at"),
        F.lit(None).cast("string").alias("updated_at")))
    return spark.sql("""
        SELECT 'mart_role_demand' AS view, role_family AS key, demand FROM mart_role_demand
        UNION ALL SELECT 'mart_skill_demand', skill, demand FROM mart_skill_demand
        UNION ALL SELECT 'mart_role_trends_by_month', concat(date_format(month, 'yyyy-MM'), ' ', role_family), demand FROM mart_role_trends_by_month
        UNION ALL SELECT 'mart_role_demand_by_seniority', concat(role_family, ' ', seniority_level), demand FROM mart_role_demand_by_seniority
        UNION ALL SELECT 'mart_role_demand_by_domain_focus', concat(role_family, ' ', domain_focus), demand FROM mart_role_demand_by_domain_focus
        UNION ALL SELECT 'mart_role_skill_demand', concat(role_family, ' ', skill), demand FROM mart_role_skill_demand
        UNION ALL SELECT 'mart_skill_demand_by_role', concat(role_family, ' ', skill), demand FROM mart_skill_demand_by_role
        UNION ALL SELECT 'mart_skill_trends_by_month', concat(date_format(month, 'yyyy-MM'), ' ', skill), demand FROM mart_skill_trends_by_month
        UNION ALL SELECT 'stg_offres_view', coalesce(date_format(created_at, 'yyyy-MM-dd'), 'none'), count(*) FROM stg_offres_view GROUP BY 2""")


def q_reference_role_family(spark, sf_dir):
    """E5 with the full posting cascade."""
    d = raw_postings(spark, sf_dir).select(X.clean_title(F.col("intitule")).alias("title_clean"))
    return L.role_distribution(E.with_classification(d, "title_clean", "role_family", R.ROLE_CASCADE))


def q_reference_skills(spark, sf_dir):
    """E6 with the full skills dictionary."""
    return M.skill_demand(E.with_skills(raw_postings(spark, sf_dir), "description", "skills", R.SKILLS))


def q_reference_enrichment(spark, sf_dir):
    """E3a / E3b / E4 with the posting taxonomies."""
    flat = S.flatten_offer(raw_postings(spark, sf_dir))
    return M.demand(E.enrich_frame(flat), ["hiring_industry", "seniority_level", "domain_focus"], name="n")


def q_match_terms_reference(spark, sf_dir):
    """J4 with the three posting taxonomies: the category of each description
    by the dictionary join (the same as by expressions)."""
    from ..operators import match as J
    flat = raw_postings(spark, sf_dir).select("id", "description")
    found = [J.infer_category_by_join(flat, "id", "description", J.prepare_dictionary(J.taxonomy_table(spark, t))).select(
        F.lit(name).alias("taxonomy"), "id", "category")
        for name, t in (("industry", R.INDUSTRY), ("seniority", R.SENIORITY), ("domain", R.DOMAIN))]
    return P.bag_union(found)


def stage_pages(spark, sf_dir) -> DataFrame:
    """E7 on pages taken as postings (title, heading as company, HTML body as
    description)."""
    pg = page_parts(spark, sf_dir)
    flat = pg.select(
        F.col("page_id").cast("string").alias("offer_id"),
        X.clean_title(F.col("title")).alias("title_clean"),
        X.clean_company(F.col("heading")).alias("company_name_clean"),
        X.clean_text(F.col("html")).alias("description_clean"),
    )
    return E.enrich_frame(flat)


def q_stage_pages(spark, sf_dir):
    return stage_pages(spark, sf_dir).select(
        "offer_id", "company_name_clean", F.array_join("skills", ",").alias("skills"), "role_family", "hiring_industry",
        "seniority_level", "domain_focus")


QUERIES: dict[str, Query] = {
    "role_demand": q_role_demand,
    "role_distribution": q_role_distribution,
    "skill_demand": q_skill_demand,
    "role_skill_demand": q_role_skill_demand,
    "skill_demand_by_role": q_skill_demand_by_role,
    "role_skill_distinct": q_role_skill_distinct,
    "lake_role_skill": q_lake_role_skill,
    "lake_skill_distribution": q_lake_skill_distribution,
    "top_skills_per_role": q_top_skills_per_role,
    "topk_skills": q_topk_skills,
    "topk_roles": q_topk_roles,
    "role_top_skills": q_role_top_skills,
    "kpis": q_kpis,
    "dataset_summary": q_dataset_summary,
    "role_selector": q_role_selector,
    "demand_by_seniority": q_demand_by_seniority,
    "demand_by_domain": q_demand_by_domain,
    "domains_of_role": q_domains_of_role,
    "seniority_ladder": q_seniority_ladder,
    "role_trends_by_month": q_role_trends_by_month,
    "skill_trends_by_month": q_skill_trends_by_month,
    "skill_trends_by_order_month": q_skill_trends_by_order_month,
    "topskill_trends": q_topskill_trends,
    "monthly_role_trend_of_role": q_monthly_role_trend_of_role,
    "weekly_role_trends": q_weekly_role_trends,
    "weekly_skill_trends": q_weekly_skill_trends,
    "lake_roles_latest_only": q_lake_roles_latest_only,
    "lake_trends_incremental": q_lake_trends_incremental,
    "report_orders": q_report_orders,
    "dt_sanity_count": q_dt_sanity_count,
    "dt_sanity_roles": q_dt_sanity_roles,
    "dt_sanity_skills": q_dt_sanity_skills,
    "ingestion_summary": q_ingestion_summary,
    "quality_by_dt": q_quality_by_dt,
    "distinct_values": q_distinct_values,
    "bag_union": q_bag_union,
    "preview": q_preview,
    "safe_timestamp": q_safe_timestamp,
    "coalesce_fallback": q_coalesce_fallback,
    "flatten_json": q_flatten_json,
    "dedupe_keep_first": q_dedupe_keep_first,
    "dedupe_counts": q_dedupe_counts,
    "infer_category": q_infer_category,
    "infer_category_multi": q_infer_category_multi,
    "score_categories": q_score_categories,
    "infer_with_priority": q_infer_with_priority,
    "weighted_domain": q_weighted_domain,
    "language_demand": q_language_demand,
    "match_terms_categories": q_match_terms_categories,
    "extract_skills": q_extract_skills,
    "skills_exploded": q_skills_exploded,
    "normalize_text": q_normalize_text,
    "clean_text": q_clean_text,
    "clean_title": q_clean_title,
    "clean_company": q_clean_company,
    "quality_metrics": q_quality_metrics,
    "quality_gate": q_quality_gate,
    "not_null_tests": q_not_null_tests,
    "unique_tests": q_unique_tests,
    "coverage": q_coverage,
    "reference_role_family": q_reference_role_family,
    "reference_skills": q_reference_skills,
    "reference_enrichment": q_reference_enrichment,
    "match_terms_reference": q_match_terms_reference,
    "stage_pages": q_stage_pages,
    "stage_postings": q_stage_postings,
    "posting_views": q_posting_views,
}


def main(argv=None) -> None:
    """``python -m hirescope.plans.catalog QUERY [SF_DIR]``: print the
    formatted physical plan of a registered query (nothing is executed)."""
    import sys

    from ..session import local_session

    args = list(sys.argv[1:] if argv is None else argv)
    if not args or args[0] not in QUERIES:
        print("queries:", ", ".join(QUERIES))
        return
    spark = local_session()
    QUERIES[args[0]](spark, args[1] if len(args) > 1 else "/root/testdata/sf0.01").explain("formatted")


if __name__ == "__main__":
    main()
