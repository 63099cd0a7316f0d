"""Sharding by proportional stratified interleaving (native).

Rows are shuffled by a seeded hash within each source, ranked there, and
placed by their fractional rank ``(2 * rank - 1) / (2 * n_source)``: at every
point of that order each source has used up the same share of its rows, so
every contiguous cut has the mixture of the whole. Cutting the order into
``n_shards`` runs whose lengths differ by one at most gives the shards (law
``rows``).

Ranks are never computed over a whole source or the whole table in one task:
both orders are split into ``buckets`` ranges (of the hash, which is uniform;
of the fractional rank, which is uniform as well), rows are numbered within a
range, and the range's offset is a running sum over the counts - a source
with a third of all rows is spread over all of its ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored


def interleaved_shards(docs: DataFrame, n_shards: int = 16, seed: int = 17, buckets: int = 4096) -> DataFrame:
    """doc_id, source, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the UTF-8 length of the text (null: 0) plus 1; ``slot`` counts
    from 0 within a shard without gaps, in interleaved order. Null sources form
    a source of their own; null texts have size 1 and the checksum of no
    bytes; a null doc_id hashes as the empty string; rows that repeat a doc_id
    are kept, ordered by size and checksum. An empty table gives no rows.
    Only ids, sources, sizes and checksums are shuffled, never texts.
    """
    if not 0 < buckets <= 4096:
        raise ValueError("buckets: 1 to 4096 (three hexadecimal digits of the hash)")
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    stratum = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), "source"))
    hashed = docs.select("doc_id", "source", "text", stratum.alias("stratum"), order.alias("ord")).withColumn(
        "range", (F.conv(F.substring("ord", 1, 3), 16, 10).cast("int") * buckets / 4096).cast("int"))

    # offsets of the hash ranges: one row for each source and range
    per_range = hashed.groupBy("stratum", "range").agg(F.count("*").alias("n"))
    along = Window.partitionBy("stratum").orderBy("range")
    offsets = per_range.select(
        "stratum", "range",
        (F.sum("n").over(along) - F.col("n")).alias("before"),
        F.sum("n").over(Window.partitionBy("stratum")).alias("n_source"))

    sized = hashed.select(
        "doc_id", "source", "stratum", "ord", "range",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    within = Window.partitionBy("stratum", "range").orderBy("ord", "doc_id", "size", "text_crc32")
    ranked = sized.withColumn("rank", F.row_number().over(within)).join(offsets, ["stratum", "range"])
    rank = F.col("before") + F.col("rank")
    ranked = stored(
        ranked.withColumn("at", (2 * rank - 1).cast("double") / (2 * F.col("n_source")).cast("double"))
        .withColumn("cell", F.least(F.floor(F.col("at") * buckets), F.lit(buckets - 1)).cast("int"))
        .select("doc_id", "source", "stratum", "ord", "size", "text_crc32", "at", "cell"), "shard-ranked")

    # the same once more over the fractional ranks: at most ``buckets`` rows
    cells = ranked.groupBy("cell").agg(F.count("*").alias("n"))
    starts = cells.select(
        "cell",
        (F.sum("n").over(Window.partitionBy().orderBy("cell")) - F.col("n")).alias("before"),
        F.sum("n").over(Window.partitionBy()).alias("total"))
    within = Window.partitionBy("cell").orderBy("at", "stratum", "ord", "doc_id", "size", "text_crc32")
    placed = ranked.withColumn("nth", F.row_number().over(within)).join(starts, "cell")
    place = F.col("before") + F.col("nth") - 1
    shard = F.expr(f"cast((before + nth - 1) * {n_shards} div total as int)")
    first = F.expr(f"cast((shard * total + {n_shards - 1}) div {n_shards} as long)")
    return placed.withColumn("shard", shard).select(
        "doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (place - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
