"""S1–S9, P1–P6, D1 and E7 end to end on the invented JSONL postings."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import FIXTURES
from hirescope.operators.quality import QualityError
from hirescope.plans import weekly as W
from hirescope.sources import offers as S

DT = "2024-03-04"


def _raw_dir(tmp):
    d = os.path.join(tmp, "raw", f"dt={DT}")
    os.makedirs(d)
    with open(os.path.join(FIXTURES, "raw_offers.jsonl"), encoding="utf-8") as src, \
            open(os.path.join(d, "offers.jsonl"), "w", encoding="utf-8") as dst:
        dst.write(src.read())
    return os.path.join(tmp, "raw")


def test_weekly_run_end_to_end(spark):
    tmp = tempfile.mkdtemp(prefix="hirescope-test-")
    raw = _raw_dir(tmp)
    report = W.run(spark, raw, os.path.join(tmp, "stage"), os.path.join(tmp, "analytics"), DT)
    assert report.dedupe == {"raw_rows": 9, "deduped_rows": 7, "duplicates_removed": 2}

    stage = S.read_stage(spark, os.path.join(tmp, "stage"), DT)
    assert stage.columns[:22] == S.STAGE_COLUMNS
    rows = {r.offer_id: r for r in stage.collect()}
    assert len(rows) == 7
    # earliest search keyword wins (data engineer ranks before ingénieur data)
    assert rows["A1"].title == "Data Engineer (H/F) duplicate"
    assert rows["A1"].search_keyword == "data engineer"
    # null ids form one group; its first keyword wins
    assert rows[None].title_clean == "technicien data center" and rows[None].role_family == "other"
    b2 = rows["B2"]
    assert b2.role_family == "software_engineer" and b2.salary_label == "45k"
    assert b2.skills == ["docker", "git", "kubernetes", "spring"]
    assert b2.seniority_level == "senior" and b2.domain_focus == "cloud_devops"
    assert b2.department_or_location is None
    c3 = rows["C3"]
    assert c3.title_clean is None and c3.role_family is None and c3.skills == []
    d4 = rows["D4"]
    assert d4.role_family == "ai_engineer" and d4.company_name_clean is None
    assert d4.description_clean == "A&B LLM RAG et LangChain, pipeline Airflow."
    assert d4.skills == ["airflow", "langchain"] and d4.domain_focus == "genai_llm"
    e5 = rows["E5"]
    assert e5.skills == ["power_bi", "r", "tableau"] and e5.seniority_level == "mid"
    assert rows["F6"].role_family == "machine_learning_engineer"

    view = S.staging_view(stage)
    ts = {r.offer_id: r.created_at for r in view.select("offer_id", "created_at").collect()}
    assert str(ts["B2"]) == "None" and str(ts["E5"]) == "2024-01-31 23:59:59"

    steps = {(st, m): v for st, m, v in report.steps}
    assert steps[("role_demand", "rows_in")] == 7.0
    assert steps[("role_demand", "rows_classified")] == 5.0
    assert steps[("role_demand_out", "output_rows")] == 5.0

    q = {m["metric"]: m for m in report.quality}
    assert q["total_rows"]["value"] == 7.0
    for name in ("skill_demand", "role_demand", "role_demand_by_seniority",
                 "role_demand_by_domain_focus", "role_skill_demand"):
        out = spark.read.parquet(os.path.join(tmp, "analytics", name, "v1"))
        assert out.where(F.col("dt") == DT).count() > 0


def test_rerun_replaces_only_its_snapshot(spark):
    tmp = tempfile.mkdtemp(prefix="hirescope-test-")
    raw = _raw_dir(tmp)
    stage_path = os.path.join(tmp, "stage")
    staged = W.stage(S.read_raw_offers(spark, raw, DT))
    for dt in (DT, "2024-03-11", DT):
        S.write_stage(staged, stage_path, dt)
    lake = S.lake_table(spark, stage_path)
    assert lake.count() == 14
    assert S.read_stage(spark, stage_path, "2024-03-11").count() == 7


def test_register_views(spark):
    tmp = tempfile.mkdtemp(prefix="hirescope-test-")
    raw = _raw_dir(tmp)
    staged = W.stage(S.read_raw_offers(spark, raw, DT))
    views = S.register_views(staged)
    assert len(views) == 9
    got = {r.role_family: r.demand for r in spark.sql("select * from mart_role_demand").collect()}
    assert got["data_engineer"] == 1 and "other" not in got
    months = spark.sql("select * from mart_role_trends_by_month").schema["month"].dataType.simpleString()
    assert months == "timestamp_ntz"


def test_land_offers_tags_and_unions(spark):
    tmp = tempfile.mkdtemp(prefix="hirescope-test-")
    page = spark.createDataFrame([("X1", "t1"), ("X2", "t2")], "id string, intitule string")
    S.land_offers({"data engineer": page, "data scientist": page.limit(1)}, os.path.join(tmp, "raw"), DT)
    raw = S.read_raw_offers(spark, os.path.join(tmp, "raw"), DT)
    assert sorted((r.id, r.search_keyword) for r in raw.collect()) == [
        ("X1", "data engineer"), ("X1", "data scientist"), ("X2", "data engineer")]


def _run_lines(spark, tmp, lines, dt=DT):
    d = os.path.join(tmp, "raw", f"dt={dt}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "offers.jsonl"), "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
    return W.run(spark, os.path.join(tmp, "raw"), os.path.join(tmp, "stage"), os.path.join(tmp, "out"), dt)


def test_empty_snapshot_blocks_before_any_write(spark):
    tmp = tempfile.mkdtemp(prefix="hirescope-test-")
    with pytest.raises(QualityError):
        _run_lines(spark, tmp, [""])
    assert not os.path.exists(os.path.join(tmp, "stage"))
    _run_lines(spark, tmp, ['{"id": "a", "intitule": "data engineer"}'])
    with pytest.raises(QualityError):  # not on the rows of the last run
        _run_lines(spark, tmp, [""])
    assert S.read_stage(spark, os.path.join(tmp, "stage"), DT).count() == 1


def test_empty_dataset_replaces_its_snapshot(spark):
    tmp = tempfile.mkdtemp(prefix="hirescope-test-")
    first = _run_lines(spark, tmp, ['{"id": "a", "intitule": "data engineer", "description": "python"}'])
    again = _run_lines(spark, tmp, ['{"id": "a", "intitule": "data engineer"}'])  # no skill any more
    assert {m: v for s, m, v in first.steps if s == "skill_demand_out"} == {"output_rows": 1.0}
    assert {m: v for s, m, v in again.steps if s == "skill_demand_out"} == {"output_rows": 0.0}
    assert spark.read.parquet(again.outputs["skill_demand"]).count() == 0
    assert spark.read.parquet(again.outputs["role_demand"]).count() == 1


def test_first_line_wins_without_sequence(spark):
    tmp = tempfile.mkdtemp(prefix="hirescope-test-")
    _run_lines(spark, tmp, ['{"id": "a", "intitule": "z first", "search_keyword": "data"}', '{"id": "a", "intitule": "a second", "search_keyword": "data"}'])
    assert [r.title for r in S.read_stage(spark, os.path.join(tmp, "stage"), DT).collect()] == ["z first"]


def test_landing_again_replaces_the_day(spark):
    tmp = tempfile.mkdtemp(prefix="hirescope-test-")
    page = spark.createDataFrame([("X1", "t1"), ("X2", "t2")], "id string, intitule string")
    S.land_offers({"data engineer": page}, tmp, DT)
    S.land_offers({"data engineer": page.limit(1)}, tmp, DT)
    S.land_offers({"data engineer": page}, tmp, "2024-03-11")
    assert S.read_raw_offers(spark, tmp, DT).count() == 1 and S.read_raw_offers(spark, tmp).count() == 3
    with pytest.raises(ValueError):  # the day folder itself holds no days to choose from
        S.read_raw_offers(spark, os.path.join(tmp, f"dt={DT}"), "1999-01-01")


def test_malformed_line_fails(spark):
    tmp = tempfile.mkdtemp(prefix="hirescope-test-")
    d = os.path.join(tmp, f"dt={DT}")
    os.makedirs(d)
    with open(os.path.join(d, "bad.jsonl"), "w") as fh:
        fh.write('{"id": "ok"}\n{not json\n')
    try:
        S.read_raw_offers(spark, tmp).count()
        raise AssertionError("a malformed line must fail the read")
    except Exception as e:  # noqa: BLE001
        assert "AssertionError" not in type(e).__name__


def test_load_warehouse_reconciles(spark):
    tmp = tempfile.mkdtemp(prefix="hirescope-test-")
    staged = W.stage(S.read_raw_offers(spark, _raw_dir(tmp), DT))
    assert S.load_warehouse(staged, "stg_offres_test") == 7
    assert S.load_warehouse(staged.limit(3), "stg_offres_test") == 3  # replaced, not appended
    spark.sql("DROP TABLE stg_offres_test")


def test_rules_round_trip_through_tables(spark):
    from hirescope.functions import rules as R

    tables = S.load_rules(spark)
    tax = R.Taxonomy.from_table(tables["taxonomy_rules"], "seniority_level")
    assert tax == R.SENIORITY
    assert R.Cascade.from_table(tables["role_cascade"]) == R.ROLE_CASCADE
    assert R.SkillPatterns.from_table(tables["skill_patterns"]).skills[:3] == R.SKILLS.skills[:3]
    assert [r.keyword for r in tables["search_keywords"].orderBy("rank").collect()] == R.SEARCH_KEYWORDS


def test_lake_sql_as_written(spark):
    """The lake queries run as SQL over the registered view."""
    tmp = tempfile.mkdtemp(prefix="hirescope-test-")
    stage_path = os.path.join(tmp, "stage")
    staged = W.stage(S.read_raw_offers(spark, _raw_dir(tmp), DT))
    S.write_stage(staged, stage_path, DT)
    S.register_lake_view(spark, stage_path, "offers_lake")
    by_role = {r.role_family: r.nb_offers for r in spark.sql(
        "SELECT role_family, COUNT(*) AS nb_offers FROM offers_lake GROUP BY role_family").collect()}
    assert by_role["other"] == 1 and by_role[None] == 1
    weekly = spark.sql(
        "SELECT dt, skill, COUNT(*) AS nb_offers FROM offers_lake LATERAL VIEW explode(skills) t AS skill "
        "GROUP BY dt, skill ORDER BY dt DESC, nb_offers DESC, skill").collect()
    assert weekly[0].skill == "airflow" and str(weekly[0].dt) == DT


def test_weekly_cli(spark, capsys):
    import json

    tmp = tempfile.mkdtemp(prefix="hirescope-test-")
    raw = _raw_dir(tmp)
    W.main(["--raw", raw, "--stage", os.path.join(tmp, "stage"), "--analytics", os.path.join(tmp, "out"), "--dt", DT])
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["dedupe"]["deduped_rows"] == 7
    assert set(report["outputs"]) == set(W.ANALYTICS)
