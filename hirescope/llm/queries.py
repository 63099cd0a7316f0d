"""The registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, circulant, decontaminate, jaccard, language, line_dedup, nbest, quality, runs, secrets, sharding,
               topk, warc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleaved_shards(_table(spark, sf_dir, "documents")).drop("source")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_repeated_lines(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", "n_lines", "n_dropped")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.drop("items")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.secrets_of(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
                      "spans", "n_added")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_of(_table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op7_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbest.segmented(_table(spark, sf_dir, "documents"), with_ids=False)


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(_table(spark, sf_dir, "embeddings"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_of(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


def planted_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in documents whose CRC-32 of the id ends in 0, the words
    from one word on repeat those of a period (both drawn from the CRC)."""
    h = F.crc32(F.col("doc_id").cast("string"))
    drawn = docs.select("doc_id", "text", F.expr("crc32(cast(doc_id as string)) div 10").alias("g"),
                        F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit("[^\\x20\\x09-\\x0D]+"), 0)).alias("words"))
    n = F.size("words")
    a = F.col("g") % n
    period = 1 + F.floor((n - a) / (3 + F.col("g") % 8))
    cut = drawn.where("size(words) > 0").select("doc_id", "words", a.cast("int").alias("a"), period.cast("int").alias("p"))
    cut = cut.select("doc_id", F.array_join(F.transform(
        F.sequence(F.lit(0), F.size("words") - 1),
        lambda i: F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")))), " ").alias("text"))
    return cut.unionByName(drawn.where("not coalesce(size(words) > 0, false)").select("doc_id", "text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(planted_repeats(_table(spark, sf_dir, "documents")))
    best = F.get(F.array_sort("runs", lambda x, y: F.when(x["length"] * y["period"] > y["length"] * x["period"], -1)
                              .when(x["length"] * y["period"] < y["length"] * x["period"], 1)
                              .when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1))
                              .when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0)), 0)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "collapsed", best.alias("best"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
    ).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        "runs_sha256", F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_circulant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant.kept_first(circulant.near_duplicates(_table(spark, sf_dir, "documents")))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.scored_alignments(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_sharding, op2_secrets, op3_line_dedup, op4_language, op5_warc, op6_decontamination, op7_nbest, op8_top_k, op9_quality, op10_jaccard,
    op11_periodic_runs, op12_circulant, op13_alignment)}
