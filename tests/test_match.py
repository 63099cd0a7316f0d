"""J4 join path agrees with the expression path, including phrase keywords."""

from pyspark.sql import functions as F

from hirescope.functions import enrich as E
from hirescope.functions import rules as R
from hirescope.functions.rules import Taxonomy
from hirescope.operators import match as J

TAX = Taxonomy.from_mapping("t", {
    "ops": ["ci/cd", "gitlab ci", "devops"],
    "data": ["etl", "data warehouse", "3-5 ans", "2 ans d'expérience"],
    "shop": ["e-commerce", "retail"],
})

TEXTS = [
    "CI/CD avec GitLab CI et DevOps", "ci cd", "etl_x etlx data-warehouse", "Data  Warehouse, ETL!",
    "3-5 ans ou 2 ans d'Expérience", "e-commerce retail", "ecommerce", "", None, "devops devops ci/cd/ci",
]


def test_join_path_equals_expression_path(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    by_join = {r.id: r.category for r in J.infer_category_by_join(
        df, "id", "text", J.prepare_dictionary(J.taxonomy_table(spark, TAX))).collect()}
    by_expr = {r.id: r.c for r in df.select("id", E.infer_category(F.col("text"), TAX).alias("c")).collect()}
    assert by_join == by_expr
    assert by_join[0] == "ops" and by_join[1] == "unknown" and by_join[3] == "data"


def test_posting_taxonomies_agree_with_expressions(spark):
    """Keywords that collide after normalisation count as often as listed."""
    texts = TEXTS + ["senior confirmé, expérience confirmée", "3 ans d'experience", "experience significative expérience significative"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for taxonomy in (R.INDUSTRY, R.SENIORITY, R.DOMAIN):
        by_join = {r.id: r.category for r in J.infer_category_by_join(
            df, "id", "text", J.prepare_dictionary(J.taxonomy_table(spark, taxonomy))).collect()}
        by_expr = {r.id: r.c for r in df.select("id", E.infer_category(F.col("text"), taxonomy).alias("c")).collect()}
        assert by_join == by_expr
        if taxonomy is R.SENIORITY:
            assert by_join[len(TEXTS)] == "mid"


def test_keywords_with_non_word_ends(spark):
    """A boundary beside a non-word character needs a word character there."""
    tax = Taxonomy.from_mapping("t", {"ms": [".net"], "c": ["c++", "++"]})
    texts = ["asp.net", ".net", "asp .net", "c++", "c++x", "a c++b", "x++y", "++", "asp..net", "asp.net."]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    by_join = {r.id: r.category for r in J.infer_category_by_join(df, "id", "text", J.prepare_dictionary(J.taxonomy_table(spark, tax))).collect()}
    by_expr = {r.id: r.c for r in df.select("id", E.infer_category(F.col("text"), tax).alias("c")).collect()}
    assert by_join == by_expr == {0: "ms", 1: "unknown", 2: "unknown", 3: "unknown", 4: "c", 5: "c", 6: "c", 7: "unknown", 8: "unknown", 9: "ms"}


def test_empty_dictionary_matches_nothing(spark):
    none = spark.createDataFrame([], "category string, cat_ord int, keyword string")
    df = spark.createDataFrame([(1, "a b")], "id int, text string")
    assert [r.category for r in J.infer_category_by_join(df, "id", "text", J.prepare_dictionary(none)).collect()] == ["unknown"]


def test_a_dictionary_of_100_000_terms(spark):
    """Terms of one to four words under one anchor each: the same hits as by
    looking every term up in every text, from places around anchors only."""
    import random

    rng = random.Random(7)
    vocab = [f"v{i}" for i in range(3000)]
    terms = sorted({" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 4))) for _ in range(101_000)} | {"c++", ".net", "++", "a/b"})[:100_000]
    texts = [" ".join(rng.choice(vocab + ["plain"] * 9000) for _ in range(120)) for _ in range(60)] + ["asp.net and c++ a/b", "", None, "x++y"]
    for i in range(20):
        texts.append(" ".join(["plain"] * 5 + [rng.choice(terms)] + ["words"] * 5))
    dictionary = J.prepare_dictionary(spark.createDataFrame([(t, "c", 0) for t in terms], "keyword string, category string, cat_ord int"))
    df = spark.createDataFrame(list(enumerate(texts)), "id int, norm string")
    got = {r.id: r.score for r in J.match_scores(df, "id", "norm", dictionary).collect()}
    import re

    want, known = {}, set(terms)
    for i, t in enumerate(texts):
        runs = re.findall("[a-z0-9_]+|[^a-z0-9_]+", t or "")
        hits = set()
        for a in range(len(runs)):
            for b in range(a + 1, min(a + 8, len(runs)) + 1):
                term = "".join(runs[a:b])
                opens, closes = re.match("[a-z0-9_]", term) or a > 0, re.match("[a-z0-9_]", runs[b - 1]) or b < len(runs)
                if term in known and opens and closes:
                    hits.add(term)
        if hits:
            want[i] = len(hits)
    assert got == want and len(want) > 30
    anchors = J.with_anchors(dictionary)
    places = J.text_places(df, "id", "norm", J._bitmap(anchors), 6, 6)
    found = places.join(anchors.select("anchor").distinct(), "anchor").count()
    total = sum(len((t or "").split()) for t in texts)
    assert places.count() <= found + total // 4  # few places that are no anchor's
    assert max(len(r.around) for r in places.select("around").collect()) <= 15


def test_what_comes_of_the_texts_is_never_broadcast(spark, tmp_path, monkeypatch):
    """Small files hold texts with many places: their size says nothing."""
    spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string").write.parquet(str(tmp_path / "texts"))
    df = spark.read.parquet(str(tmp_path / "texts"))
    terms = J.prepare_dictionary(J.taxonomy_table(spark, TAX))

    def run():
        out = J.infer_category_by_join(df, "id", "text", terms)
        rows = sorted(out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
        return rows, plan.partition("Initial Plan")[0]

    rows, plan = run()
    assert "SortMergeJoin [id" in plan and "BuildLeft" not in plan and "LeftOuter, BuildRight" not in plan
    monkeypatch.setattr(J, "MAX_BROADCAST", 0)
    assert run()[0] == rows
