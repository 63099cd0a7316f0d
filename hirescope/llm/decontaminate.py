"""Benchmark decontamination by winnowing (native).

Texts become lower-case words; every k-gram of words is hashed, and of each
run of ``w`` neighbouring hashes the smallest is a fingerprint. With
``w + k - 1`` equal to the window length, two texts that share a window share
a fingerprint inside it, wherever the window stands. Documents whose
fingerprints meet one of the benchmark are candidates; around each meeting
k-gram the windows that contain it are compared word for word, so the result
is exact.

Items shorter than a window are a window of their own length. They have no
winnowing guarantee, so they are found by an anchor instead: their longest
word, looked up among the distinct words of each document, then compared in
place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, bloom, maybe_in, stored

#: All of ASCII that is neither digit nor letter ends a word.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of ``text``, A-Z lower-cased; null has none."""
    plain = F.octet_length(text) == F.char_length(text)  # ASCII only: lower() then changes A-Z alone
    low = F.when(plain, F.lower(text)).otherwise(ascii_lower(text))
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), SEPARATORS), "")


def _grams(df: DataFrame, k: int) -> DataFrame:
    """Adds ``grams``: hashes of the k-grams of ``words``, by position."""
    return df.withColumn("grams", F.expr(
        f"case when size(words) >= {k} then transform(sequence(1, size(words) - {k - 1}), i -> xxhash64(slice(words, i, {k}))) "
        "else cast(array() as array<bigint>) end"))


def _fingerprints(df: DataFrame, w: int) -> DataFrame:
    """Replaces ``grams`` by ``fps``: the distinct minima of runs of ``w``."""
    return df.withColumn("fps", F.expr(
        f"case when size(grams) >= {w} then array_distinct(transform(sequence(1, size(grams) - {w - 1}), "
        f"i -> array_min(slice(grams, i, {w})))) else cast(array() as array<bigint>) end")).drop("grams")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, k: int = 5) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items.

    One row for each row of ``docs``. Null or wordless texts have zero words
    and no hits; null or wordless items occur nowhere; items that repeat an
    item_id count once; a null item_id counts as the empty string. A row that
    repeats a doc_id is judged by its own text. An empty benchmark leaves
    every document clean.

    Benchmark tables are written first, so Spark knows their size when it
    plans the joins: it broadcasts them while they are below its threshold and
    shuffles the fingerprints (two of ``w + 1`` positions on average) else.
    """
    w = window - k + 1
    row = F.xxhash64(F.col("doc_id"), F.col("text"))
    keyed = docs.select("doc_id", "text", row.alias("row"))

    # benchmark: windows by text, with the items that hold them
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("words"))
    items = items.where(F.size("words") > 0)
    cut = items.withColumn("len", F.least(F.size("words"), F.lit(window)))
    held = stored(
        cut.withColumn("at", F.explode(F.expr("sequence(1, size(words) - len + 1)")))
        .select("item", "len", F.expr("array_join(slice(words, at, len), ' ')").alias("window")).distinct(), "bench-windows")
    fps = stored(_fingerprints(_grams(items.where(F.size("words") >= window), k), w)
                 .select(F.explode("fps").alias("fp")).distinct(), "bench-fps")

    # every document: words, fingerprints (one pass over the texts)
    base = stored(_fingerprints(_grams(keyed.select("doc_id", "row", words(F.col("text")).alias("words")), k), w)
                  .select("doc_id", "row", F.size("words").cast("long").alias("n_words"), "fps"), "doc-fps")
    met = stored(base.select("row", F.explode("fps").alias("fp")).join(fps, "fp", "left_semi")
                 .groupBy("row").agg(F.collect_set("fp").alias("met")), "doc-met")

    # extend: windows around each meeting k-gram, compared as words
    near = _grams(_fetch(keyed, met), k).select("row", "words", F.explode(F.expr(
        f"array_distinct(flatten(transform(filter(sequence(1, size(grams)), p -> array_contains(met, grams[p - 1])), "
        f"p -> sequence(greatest(1, p - {w - 1}), least(p, size(words) - {window - 1})))))")).alias("at"))
    near = near.select("row", "at", F.lit(window).alias("len"), F.expr(f"array_join(slice(words, at, {window}), ' ')").alias("window"))
    hits = near.join(held.where(F.col("len") == window).select("window").distinct(), "window", "left_semi")

    short = held.where(F.col("len") < window).select("window", "len").distinct()
    if not short.isEmpty():
        hits = hits.unionByName(_short_hits(keyed, short))
    hits = stored(hits.distinct(), "doc-hits")

    covered = hits.select("row", F.explode(F.expr("sequence(at, at + len - 1)")).alias("at")).distinct()
    n_hit = covered.groupBy("row").agg(F.count("*").alias("n_hit"))
    found = (
        hits.select("row", "window").distinct().join(held.select("window", "item"), "window").select("row", "item").distinct()
        .groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items")))
    out = base.select("doc_id", "row", "n_words").join(n_hit, "row", "left").join(found, "row", "left")
    items_of = F.coalesce(F.col("items"), F.expr("cast(array() as array<string>)"))
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_of, ",").cast("binary"), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"), items_of.alias("items"))


def _fetch(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """Words of the rows in ``wanted``, thinned by a bounded bitmap before
    their texts are shuffled."""
    bitmap = stored(bloom(wanted, "row"), "doc-bloom")
    bits = bitmap.agg(F.max("n_bits")).first()[0] or 1
    return (maybe_in(keyed, "row", bitmap, bits)
            .join(wanted, "row").withColumn("words", words(F.col("text"))).drop("text", "doc_id"))


def _short_hits(keyed: DataFrame, short: DataFrame) -> DataFrame:
    """Occurrences of items shorter than a window, found by their longest
    word and compared in place."""
    parts = short.withColumn("parts", F.split("window", " "))
    anchor = F.expr("array_sort(transform(parts, (p, i) -> struct(-char_length(p) as a, p as p, i as i)))[0]")
    short = stored(parts.withColumn("anchor", anchor).select(
        "window", "len", F.col("anchor.p").alias("word"), F.col("anchor.i").alias("off")), "bench-short")
    anchors = short.select("word").distinct()
    rows = keyed.select("row", words(F.col("text")).alias("words"))
    met = stored(rows.select("row", F.explode(F.array_distinct("words")).alias("word")).join(anchors, "word", "left_semi")
                 .groupBy("row").agg(F.collect_set("word").alias("met")), "doc-anchors")
    at = _fetch(keyed, met).withColumn("i", F.explode(F.expr(
        "filter(sequence(1, greatest(size(words), 1)), p -> array_contains(met, get(words, p - 1)))")))
    at = at.withColumn("word", F.expr("get(words, i - 1)")).join(short, "word")
    at = at.withColumn("at", F.col("i") - F.col("off"))
    return at.where("at >= 1 and at + len - 1 <= size(words) and array_join(slice(words, greatest(at, 1), len), ' ') = window").select(
        "row", "at", "len", "window")
