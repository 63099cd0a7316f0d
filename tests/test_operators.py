"""Marts, dedupe, reports and quality: properties from SURVEY §5.2."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from hirescope.operators import dedupe as D
from hirescope.operators import lake as L
from hirescope.operators import marts as M
from hirescope.operators import quality as Q
from hirescope.operators import reports as P
from hirescope.plans import catalog as C


def _rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_role_demand_sums_to_filtered_rows(spark):
    posts = C.part_postings(spark, SF_SMALL)
    total = M.role_demand(posts).agg(F.sum("demand")).first()[0]
    assert total == posts.where(M.classified("role_family")).count()


def test_distinct_equals_rows_on_unique_ids(spark):
    posts = C.part_by_type(spark, SF_SMALL)
    a3 = M.role_skill_demand(posts)
    a13 = M.role_skill_demand_distinct(posts, key="p_partkey")
    assert _rows(a3, "role_family", "skill") == _rows(a13, "role_family", "skill")


def test_lake_restricted_by_role_filter_equals_a3(spark):
    posts = C.part_postings(spark, SF_SMALL)
    a16 = L.role_skill_distribution(posts).where(M.classified("role_family")).withColumnRenamed("nb", "demand")
    assert _rows(a16, "role_family", "skill") == _rows(M.role_skill_demand(posts), "role_family", "skill")


def test_explode_drops_null_and_empty(spark):
    df = spark.createDataFrame([(1, ["a", None]), (2, []), (3, None), (4, ["a", "b"])], "id int, xs array<string>")
    assert _rows(M.skill_demand(df, "xs"), "skill") == [("a", 2), ("b", 1)]


def test_dedupe_keep_first_and_idempotent(spark):
    df = spark.createDataFrame(
        [("k", 2, "late"), ("k", 1, "early"), (None, 5, "n1"), (None, 3, "n2"), ("j", 1, "only")],
        "key string, rank int, v string")
    once = D.dedupe_first(df, "key", ["rank"])
    assert _rows(once, "key") == [(None, 3, "n2"), ("j", 1, "only"), ("k", 1, "early")]
    assert _rows(D.dedupe_first(once, "key", ["rank"]), "key") == _rows(once, "key")
    counts = D.dedupe_counts(df, "key").first()
    assert (counts.raw_rows, counts.deduped_rows, counts.duplicates_removed) == (5, 3, 2)


def test_dedupe_hot_key_has_no_window(spark):
    """Keep-first is an aggregate (map-side combined), not a window."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = D.dedupe_first(docs, "text", ["source", "doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Aggregate" in plan


def test_top_k_per_group_total_order(spark):
    dem = spark.createDataFrame([("r", "b", 2), ("r", "a", 2), ("r", "c", 1), ("s", "z", 9)],
                                "role_family string, skill string, demand long")
    got = _rows(P.top_k(dem, 2, P.by_demand("skill"), by=["role_family"]), "role_family", "skill")
    assert got == [("r", "a", 2), ("r", "b", 2), ("s", "z", 9)]
    assert [r.skill for r in P.top_k(dem, 2, P.by_demand("skill")).collect()] == ["z", "a"]


def test_ladder_order(spark):
    df = spark.createDataFrame([("senior", 1), ("intern_apprentice", 5), ("zzz", 9), ("mid", 2)], "lvl string, n int")
    assert [r.lvl for r in P.in_ladder_order(df, "lvl").collect()] == ["intern_apprentice", "mid", "senior", "zzz"]


def test_quality_metrics_and_gate(spark):
    df = spark.createDataFrame(
        [("a", "data_engineer", "x"), (" ", "other", None), (None, None, "y"), ("b", "false_positive", "z")],
        "title_clean string, role_family string, company_name_clean string")
    m = {r.metric: (r.value, r.passed) for r in Q.metrics(df).collect()}
    assert m["total_rows"] == (4.0, True)
    assert m["title_clean_populated_pct"] == (50.0, False)
    assert m["relevant_role_family_pct"] == (25.0, False)
    assert m["company_name_clean_populated_pct"] == (75.0, None)
    Q.gate(df)
    try:
        Q.gate(df.limit(0))
        raise AssertionError("empty output must fail the gate")
    except Q.QualityError:
        pass


def test_not_null_and_unique(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2), ("b", 3)], "k string, v int")
    nn = {r.column: r.failing_rows for r in Q.not_null_tests(df, ["k", "v"]).collect()}
    assert nn == {"k": 1, "v": 1}
    u = Q.unique_test(df, "k").first()
    assert (u.duplicated_keys, u.failing_rows, u.passed) == (1, 2, False)


def test_schema_changes():
    from pyspark.sql import types as T
    a = T.StructType([T.StructField("x", T.StringType()), T.StructField("y", T.IntegerType())])
    b = T.StructType([T.StructField("x", T.StringType()), T.StructField("y", T.LongType()), T.StructField("z", T.StringType())])
    assert Q.schema_changes(a, b) == [("y", "int", "bigint"), ("z", None, "string")]


def test_coverage_counts_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 1)], "s string, n int")
    got = sorted(((r.column, r.value, r.n) for r in P.coverage(df, ["s", "n"]).collect()), key=str)
    assert got == sorted([("s", "a", 2), ("s", None, 1), ("n", "1", 2), ("n", None, 1)], key=str)


def test_keyword_summary_lists_missing_keywords(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "search_keyword string")
    dim = spark.createDataFrame([("a",), ("b",), ("c",)], "keyword string")
    got = {r.keyword: r.n_rows for r in P.keyword_summary(df, dim).collect()}
    assert got == {"a": 2, "b": 1, "c": 0, "__total__": 3}


def test_configure_keeps_cluster_values(spark):
    from hirescope.session import configure

    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256m")
    configure(spark)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "256m"
    assert spark.conf.get("spark.checkpoint.dir")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")


def test_latest_snapshot_only(spark):
    import datetime as dtm
    d1, d2 = dtm.date(2024, 1, 1), dtm.date(2024, 1, 8)
    df = spark.createDataFrame(
        [("a", d1, "x"), ("a", d2, "y"), ("b", d1, "z"), (None, d1, "n1"), (None, d2, "n2"), ("c", d2, "w"), ("c", d2, "v")],
        "offer_id string, dt date, role_family string")
    got = sorted(((r.offer_id, str(r.dt), r.role_family) for r in L.latest_snapshot_only(df).collect()), key=str)
    assert got == sorted([("a", "2024-01-08", "y"), ("b", "2024-01-01", "z"), ("c", "2024-01-08", "w"),
                          ("c", "2024-01-08", "v"), (None, "2024-01-01", "n1"), (None, "2024-01-08", "n2")], key=str)
