"""S1 pruning, S3/S5 replaced in one step, S6 load beside and swap, and the
lake counts that are kept day by day (A14-A18)."""

import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from hirescope.operators import lake as L
from hirescope.operators import reports as P
from hirescope.plans import lake_counts as LC
from hirescope.plans import weekly as W
from hirescope.sources import offers as S
from hirescope.sources import snapshots as N

DAY, NEXT = "2024-03-04", "2024-03-11"


def _tmp():
    return tempfile.mkdtemp(prefix="hirescope-test-")


def _rows(spark, n, role="a"):
    return spark.range(n).select("id", F.lit(role).alias("role_family"), F.array(F.lit("x"), F.concat(F.lit("y"), F.col("id") % 2)).alias("skills"))


def _failing(spark, n):
    """A frame whose last task fails after others have written."""
    return spark.range(0, n, 1, 4).select(
        F.when(F.col("id") < n - 1, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")).alias("id"),
        F.lit("b").alias("role_family"), F.array(F.lit("z")).alias("skills"))


# ------------------------------------------------------------------ S1 ----

def _land(root, dt, *lines):
    os.makedirs(f"{root}/dt={dt}")
    with open(f"{root}/dt={dt}/part.jsonl", "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_raw_day_is_a_partition_filter(spark):
    raw = _tmp()
    _land(raw, DAY, '{"id": "a", "intitule": "x"}', '{"id": "b"}')
    _land(raw, NEXT, '{"id": "c"', "not json")  # must not be opened
    day = S.read_raw_offers(spark, raw, DAY)
    assert dict(day.dtypes)["dt"] == "date"
    assert sorted((r.id, str(r.dt)) for r in day.collect()) == [("a", DAY), ("b", DAY)]
    plan = day._jdf.queryExecution().executedPlan().toString()
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "dt#" in filters.split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(Exception):
        S.read_raw_offers(spark, raw).collect()


# ------------------------------------------------------------ S3 and S5 ----

def test_failed_write_keeps_the_old_snapshot(spark):
    root = _tmp()
    S.write_stage(_rows(spark, 5), root, DAY)
    S.write_stage(_rows(spark, 2), root, NEXT)
    before = S.read_stage(spark, root)
    with pytest.raises(Exception):
        S.write_stage(_failing(spark, 100), root, DAY)
    assert S.read_stage(spark, root, DAY).count() == 5 and S.read_stage(spark, root).count() == 7
    S.write_stage(_rows(spark, 3), root, DAY)
    assert before.count() == 7  # a reader that started before keeps its files
    assert S.read_stage(spark, root).count() == 5
    S.write_stage(_rows(spark, 0), root, DAY)  # an empty snapshot replaces its day
    assert S.read_stage(spark, root, DAY).count() == 0 and S.read_stage(spark, root).count() == 2
    assert S.read_stage(spark, root, "2030-01-01").count() == 0
    # the failed attempt and all but the last two are gone
    assert len(os.listdir(f"{root}/dt={DAY}")) == 2
    N.vacuum(spark, root)
    assert len(os.listdir(f"{root}/dt={DAY}")) == 1 and S.read_stage(spark, root).count() == 2


def test_an_attempt_is_not_read_before_its_commit(spark):
    root = _tmp()
    S.write_stage(_rows(spark, 1), root, DAY)
    made = [N.write_attempt(_rows(spark, 4), root, d) for d in (DAY, NEXT)]
    assert S.read_stage(spark, root).count() == 1 and N.read_attempt(spark, made[1]).count() == 4
    N.commit(spark, made)
    assert S.read_stage(spark, root).count() == 8
    assert len([f for f in os.listdir(f"{root}/_log/commits") if f.endswith(".json")]) == 2  # one file a commit


def test_folders_without_a_log_are_read_and_taken_over(spark):
    root = _tmp()
    for dt, n in ((DAY, 3), (NEXT, 4)):
        _rows(spark, n).write.parquet(f"{root}/dt={dt}")
    assert S.read_stage(spark, root).count() == 7 and S.read_stage(spark, root, DAY).count() == 3
    S.write_stage(_rows(spark, 1), root, DAY)
    assert S.read_stage(spark, root).count() == 5 and S.read_stage(spark, root, NEXT).count() == 4
    S.write_stage(_rows(spark, 2), root, DAY)
    assert S.read_stage(spark, root).count() == 6


def test_a_failing_dataset_leaves_the_last_run_whole(spark, monkeypatch):
    tmp = _tmp()
    _land(f"{tmp}/raw", DAY, '{"id": "a", "intitule": "data engineer", "description": "python"}')
    first = W.run(spark, f"{tmp}/raw", f"{tmp}/stage", f"{tmp}/out", DAY)
    shutil.rmtree(f"{tmp}/raw")
    _land(f"{tmp}/raw", DAY, '{"id": "a", "intitule": "data scientist"}', '{"id": "b", "intitule": "data scientist"}')
    monkeypatch.setitem(W.ANALYTICS, "role_skill_demand", lambda df: df.select(F.raise_error(F.lit("lost")).alias("x")))
    with pytest.raises(Exception):
        W.run(spark, f"{tmp}/raw", f"{tmp}/stage", f"{tmp}/out", DAY)
    assert [r.title_clean for r in S.read_stage(spark, f"{tmp}/stage", DAY).collect()] == ["data engineer"]
    assert [r.role_family for r in S.read_analytics(spark, f"{tmp}/out", "role_demand", DAY).collect()] == ["data_engineer"]
    assert spark.read.parquet(first.outputs["role_demand"]).count() == 1


# ------------------------------------------------------------------ S6 ----

def test_a_wrong_load_keeps_the_old_table(spark, monkeypatch):
    table = "stg_offres_swap"
    assert S.load_warehouse(_rows(spark, 4), table) == 4
    plain = spark.table

    def changed(name):  # one value differs, the count does not
        df = plain(name)
        return df.withColumn("id", F.when(F.col("id") == 2, 99).otherwise(F.col("id"))) if "__load_" in name else df

    monkeypatch.setattr(type(spark), "table", lambda self, name: changed(name))
    with pytest.raises(ValueError, match="differs"):
        S.load_warehouse(_rows(spark, 6), table)
    monkeypatch.undo()
    assert spark.table(table).count() == 4
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(table)] == [table]
    assert S.load_warehouse(_rows(spark, 6), table) == 6 and S.load_warehouse(_rows(spark, 0), table) == 0
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(table)] == [table]
    spark.sql(f"DROP TABLE {table}")


def test_checksum_is_of_rows_not_of_their_order(spark):
    from hirescope.operators.quality import checksum

    def total(df):
        return df.agg(checksum(df)).first()[0]

    df = spark.range(100).select("id", F.create_map(F.lit("k"), F.col("id")).alias("m"), F.lit(None).cast("string").alias("s"))
    assert total(df) == total(df.orderBy(F.desc("id")).repartition(3)) != total(df.where("id <> 5"))
    assert total(df) != total(df.withColumn("s", F.when(F.col("id") == 5, "")))


# ------------------------------------------------------------- A14-A18 ----

def _same(a, b):
    return sorted(map(repr, a.select(sorted(a.columns)).collect())) == sorted(map(repr, b.select(sorted(b.columns)).collect()))


def test_lake_counts_read_new_and_replaced_days_only(spark):
    lake, counts = _tmp(), _tmp()
    days = ["2024-03-04", "2024-03-05", "2024-03-06"]
    for i, d in enumerate(days[:2]):
        S.write_stage(_rows(spark, 10 + i, f"r{i}"), lake, d)
    assert LC.refresh(spark, lake, counts) == days[:2]
    assert LC.refresh(spark, lake, counts) == []
    hidden = f"{lake}-hidden"
    os.rename(f"{lake}/dt={days[0]}", hidden)  # a day that was counted is not opened
    S.write_stage(_rows(spark, 7, "r1"), lake, days[2])
    assert LC.refresh(spark, lake, counts) == days[2:]
    os.rename(hidden, f"{lake}/dt={days[0]}")
    S.write_stage(_rows(spark, 3, "other"), lake, days[1])  # replaced: counted again
    assert LC.refresh(spark, lake, counts) == [days[1]]
    whole = S.lake_table(spark, lake)
    assert _same(LC.role_trends(spark, counts), L.snapshot_role_trends(whole))
    assert _same(LC.skill_trends(spark, counts), L.snapshot_skill_trends(whole))
    assert _same(LC.role_distribution(spark, counts), L.role_distribution(whole))
    assert _same(LC.skill_distribution(spark, counts), L.skill_distribution(whole))
    assert _same(LC.role_skill_distribution(spark, counts), L.role_skill_distribution(whole))
    assert {str(r.dt): r.nb_offers for r in LC.role_trends(spark, counts).collect()} == dict(zip(days, (10, 3, 7)))


def test_counts_of_an_empty_lake(spark):
    counts = _tmp()
    assert LC.refresh(spark, _tmp(), counts) == []
    assert LC.role_trends(spark, counts).collect() == [] and LC.skill_trends(spark, counts).collect() == []


# --------------------------------------------------------------- D3-D7 ----

def test_positions_are_those_of_the_written_rows(spark):
    df = spark.range(0, 5000, 1, 7).select("id", (F.col("id") % 13).alias("demand"))
    order = P.by_demand("id")
    want = [r.id for r in df.orderBy(*order).collect()]
    got = P.with_position(P.ordered(df, order))
    assert [r.id for r in sorted(got.collect(), key=lambda r: r.position)] == want
    assert sorted(r.position for r in got.collect()) == list(range(1, 5001))
    shuffled = P.with_position(P.ordered(df, order).repartition(5, "id"))
    assert [r.id for r in sorted(shuffled.collect(), key=lambda r: r.position)] != want
    assert P.with_position(P.ordered(df.limit(0), order)).count() == 0


# ------------------------------------------------------------------ D1 ----

def test_kept_rows_are_fetched_late(spark):
    from hirescope.operators.dedupe import dedupe_first

    df = spark.range(0, 3000, 1, 6).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise((F.col("id") % 400).cast("string")).alias("key"),
        (F.col("id") * 7919 % 1009).alias("rank"), F.repeat(F.lit("text "), 50).alias("text"))
    late = dedupe_first(df, "key", ["rank", "id"], "id")
    assert sorted(late.collect()) == sorted(dedupe_first(df, "key", ["rank", "id"]).collect())
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan.split("ShuffledHashJoin")[0] and "ShuffledHashJoin" in plan
    assert all("text" not in line for line in plan.splitlines() if "Aggregate" in line)
