"""What is not moved: rows that a bitmap rules out, sets and texts beside them."""

import os
import time

from pyspark.sql import functions as F

import corpus_pipeline as P
from hirescope.llm import circulant, common, jaccard


def test_split_has_every_row_once_and_moves_few(spark):
    rows = spark.range(2000).selectExpr("nullif(id, 7) as k", "repeat('x', 50) as text").unionByName(
        spark.range(3).selectExpr("cast(5 as bigint) as k", "'again' as text"))
    keys = spark.createDataFrame([(5,), (11,), (999_999,)], "k long")
    held, rest = common.split_by_bloom(rows, "k", keys, "test-split")
    assert sorted(held.unionByName(rest).collect(), key=str) == sorted(rows.collect(), key=str)
    assert {5, 11} <= {r.k for r in held.collect()} and held.count() < 100
    assert not {5, 11} & {r.k for r in rest.collect()}
    assert "Exchange hashpartitioning" not in rest._jdf.queryExecution().executedPlan().toString()
    held, rest = common.split_by_bloom(rows, "k", keys.where("false"), "test-split")
    assert held.count() == 0 and rest.count() == 2003


def test_rare_shingles_are_counted_without_moving_sets(spark, monkeypatch):
    """The sets of mixed buckets are read where they are (op12)."""
    seen = []
    plain = circulant.split_by_bloom

    def spied(df, key, keys, name):
        out = plain(df, key, keys, name)
        seen.append((df.columns, out[0]._jdf.queryExecution().executedPlan().toString()))
        return out

    monkeypatch.setattr(circulant, "split_by_bloom", spied)
    base = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(base[:i] + [f"z{i}"] + base[i + 1:])) for i in range(30)]
    got = {r.doc_id: r.component_id for r in circulant.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert len(got) == 30
    assert [c for c, _ in seen] == [["c", "set"]] and "Exchange hashpartitioning" not in seen[0][1]


def test_pipeline_moves_only_texts_that_may_go(spark, monkeypatch):
    moved = []
    plain = P.split_by_bloom

    def spied(df, key, keys, name):
        out = plain(df, key, keys, name)
        moved.append(out[0].count())
        return out

    monkeypatch.setattr(P, "split_by_bloom", spied)
    rows = [(i, " ".join(f"t{i}x{j}" for j in range(30)), "en", "s", 9) for i in range(200)]
    rows += [(1000 + i, rows[i][1], "en", "s", 9) for i in range(3)] + [rows[50], (None, rows[60][1], "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = P.near_duplicate_stage(spark, docs, "")
    assert sorted(r.doc_id for r in got.collect()) == list(range(200))
    assert moved and max(moved) < 50


def shuffle_files(spark):
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_when_a_table_is_stored(spark):
    before, setting = shuffle_files(spark), spark.conf.get(common._CLEANUP, "false")
    rows = spark.range(5000, numPartitions=3).groupBy((F.col("id") % 100).alias("k")).count()
    out = common.stored(rows, "test-shuffled")
    for _ in range(50):  # the files are removed beside
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= before and spark.conf.get(common._CLEANUP, "false") == setting
    assert out.count() == 100 and rows.count() == 100 == len(rows.collect())


def test_discarded_tables_are_removed_and_others_stay(spark):
    one, two = (common.stored(spark.range(9), "test-table") for _ in range(2))
    path = common._path_of[one].removeprefix("file:")
    assert os.path.isdir(path) and common._path_of[one] in common._tables
    common.discard(one, spark.range(3))  # a frame that is no stored table is left alone
    assert not os.path.exists(path) and two.count() == 9
    common.discard(one)


def test_near_duplicates_leaves_few_tables(spark):
    """Prefixes, posts and labels are as large as the input: they go as soon as
    what is made from them is written (op10)."""
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(words[:i] + [f"z{i}"] + words[i + 1:])) for i in range(30)] + [(99, None)]
    known = set(common._tables)
    got = jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert len(got.collect()) == 31 == got.count()
    left = {os.path.basename(p).rpartition("-")[0] for p in common._tables if p not in known}
    assert not left & {"jaccard-signed", "jaccard-prefixes", "jaccard-posts", "jaccard-labelled", "jaccard-apart", "jaccard-able",
                       "jaccard-crowd", "jaccard-rare", "jaccard-candidates", "jaccard-rare-lists"}
    assert {"jaccard-rows", "jaccard-components"} <= left
