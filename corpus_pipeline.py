"""Corpus pipeline: language ID, line dedup, near-duplicate removal, benchmark
decontamination, SentencePiece encoding (part of the ``llm`` subpackage).

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written and read again as the next one's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.llm import decontaminate, jaccard, language, line_dedup, nbest
from hirescope.llm.common import fresh_path, release, split_by_bloom, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Chunks that an encoding worker remembers: it may still hold them when another
#: run's stages need the executor's memory.
MEMO = 150_000


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null, no letter) or with an ambiguous one
    go; a missing ``lang`` becomes the predicted one. Without labelled rows to
    learn from nothing is known about any document, and all stay."""
    model = language.train(docs)
    if not model["langs"]:
        return docs.select(COLUMNS)
    out = language.identify(docs, model).where("lang_pred <> 'und' and not ambiguous")
    return out.withColumn("lang", F.coalesce("lang", "lang_pred")).select(COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines are cut; a document that had nothing else goes."""
    out = line_dedup.drop_repeated_lines(docs)
    out = out.where(~((F.col("n_dropped") > 0) & (F.trim(F.translate("text", "\n\r\t", "   ")) == "")))
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def _keyed(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a key of its own for every row (``row_key``), written: equal
    rows and rows without a doc_id are told apart, and the key stays the same
    however often the rows are read."""
    return stored(docs.select(F.monotonically_increasing_id().alias("row_key"), *COLUMNS), name)


def _by_key(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("row_key").alias("doc_id"), "text")


def _without(docs: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """The rows of ``docs`` whose ``row_key`` is not in ``keys``. Only rows that may
    go are moved, so that the texts of those that stay are not shuffled."""
    keys = stored(keys, name)
    held, rest = split_by_bloom(docs, "row_key", keys, f"{name}-bloom")
    return held.join(keys, "row_key", "left_anti").unionByName(rest).select(COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies exactly one row stays: that of the smallest
    doc_id (null counts as the largest; ties to a digest of the row)."""
    docs = _keyed(docs, "stage-near-rows")
    groups = jaccard.near_duplicates(_by_key(docs)).select(F.col("doc_id").alias("row_key"), "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text", "lang", "source", "n_chars"), "row_key")
    groups = stored(docs.select("row_key", order.alias("at")).join(groups, "row_key").select("row_key", "at", "component_id"), "stage-near-groups")
    first = groups.groupBy("component_id").agg(F.min_by("row_key", "at").alias("row_key")).select("row_key")
    return _without(docs, groups.select("row_key").join(first, "row_key", "left_anti"), "stage-near")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a window of a benchmark item go, each by its own text."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs = _keyed(docs, "stage-leak-rows")
    leaks = decontaminate.contamination(_by_key(docs), benchmark).where("contaminated").select(F.col("doc_id").alias("row_key"))
    return _without(docs, leaks, "stage-leaks")


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the best segmentation of every document, what each further
    one of the n best changes in them (``nbest.rebuilt`` gives their ids), and
    their scores."""
    return nbest.segmented(docs, as_patches=True, memo=MEMO)


def _after(stage):
    """``stage``, which first removes the tables of the stages before it: their
    results have been written and read again."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("language ID", language_stage),
    ("line dedup", _after(line_stage)),
    ("n-gram Jaccard join", _after(near_duplicate_stage)),
    ("benchmark decontamination", _after(decontamination_stage)),
    ("SentencePiece encoding", _after(encoding_stage)),
]

#: Models and tokenizer cannot be expressed in SQL; the stages are tested
#: against brute force instead (tests/llm).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(COLUMNS)
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
