"""Helpers shared by the training-data operators: tables in the shared folder,
bounded Bloom bitmaps, connected components, by-value pickling.
"""

from __future__ import annotations

import contextlib
import functools
import sys
import tempfile
import types
import uuid
import weakref

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ship(module: str) -> None:
    """Pickle the functions of ``module`` by value, so that workers need not
    have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def worker_cache(name: str, key, make):
    """``make()``, kept by a Python worker for its further tasks (one value a
    name: another key replaces it). Only for what depends on the key alone."""
    held = sys.modules.setdefault("_hirescope_worker_cache", types.ModuleType("_hirescope_worker_cache")).__dict__
    if held.get(name, (None,))[0] != key:
        held[name] = (key, make())
    return held[name][1]


@functools.cache
def _scratch() -> str:
    return tempfile.mkdtemp(prefix="hirescope-llm-")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Only a local session (one process, as in tests) gets a scratch folder
    where the setting is missing; on a cluster the setting is required.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and not spark.conf.get("spark.master", "").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return (path or _scratch()).rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


#: Tables that ``stored`` has written and that are not removed yet, and the
#: frames that read them.
_tables: list[str] = []
_path_of: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def _shuffles_removed(spark: SparkSession):
    """The shuffle files of what runs inside go when it ends, not when the driver
    happens to collect its garbage. (Should a stage be tried again, Spark makes
    them anew.)"""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage
    durably, so that a lost executor never replays what came before."""
    path = fresh_path(df.sparkSession, name)
    with _shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    _tables.append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _path_of[out] = path
    return out


def _remove(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``stored`` gave, for an operator that has written all
    that it makes from them."""
    for table in tables:
        path = _path_of.pop(table, None)
        if path in _tables:
            _tables.remove(path)
            _remove(table.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Remove the tables stored so far, for a caller who has written what was
    made from them (a pipeline between two stages)."""
    while _tables:
        _remove(spark, _tables.pop())


def texts(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only: further columns, also clashing ones, are none
    of an operator's business."""
    return df.select(*names)


# ------------------------------------------------------------- Bloom bitmap --

#: Most bits of a Bloom bitmap: 32 MB, the bound of what is broadcast.
MAX_BLOOM_BITS = 1 << 28
_CHUNK = 32768  # bits in one row of the bitmap functions


def bloom(keys: DataFrame, key: str) -> DataFrame:
    """Bitmap of the 64-bit ``key`` column as rows (bucket, bits) of 4 KB.

    At least sixteen bits a key (to a power of two), never above
    ``MAX_BLOOM_BITS``; a full bitmap only passes more rows, it never loses
    one.
    """
    n = keys.count()
    bits = _CHUNK
    while bits < min(16 * n, MAX_BLOOM_BITS):
        bits *= 2
    slot = F.pmod(F.xxhash64(F.col(key)), F.lit(bits)) + 1
    rows = keys.select(slot.alias("slot"))
    out = rows.groupBy(F.expr("bitmap_bucket_number(slot)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits"))
    return out.withColumn("n_bits", F.lit(bits))


def _looked_up(df: DataFrame, key: str, bitmap: DataFrame, n_bits: int, how: str) -> DataFrame:
    """``df`` joined to its keys' rows of the bitmap, with ``__may``."""
    bitmap = bitmap.select(F.col("bucket").alias("__bucket"), F.col("bits").alias("__bits"))
    slot = F.pmod(F.xxhash64(F.col(key)), F.lit(n_bits))
    bit = slot % _CHUNK
    byte = F.conv(F.hex(F.expr("substring(__bits, cast(__bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    return (
        df.withColumn("__bucket", (slot / _CHUNK).cast("long") + 1)
        .withColumn("__bit", bit)
        .join(F.broadcast(bitmap), "__bucket", how)
        .withColumn("__may", byte.bitwiseAND(F.expr("shiftleft(1, cast(__bit % 8 as int))")) != 0)
    )


def maybe_in(df: DataFrame, key: str, bitmap: DataFrame, n_bits: int) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be in the bitmap (no false negatives)."""
    return _looked_up(df, key, bitmap, n_bits, "inner").where("__may").select(df.columns)


def split_by_bloom(df: DataFrame, key: str, keys: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """``df`` in two: the rows whose ``key`` may be one of ``keys``, for an exact
    join, and those of which a bounded bitmap tells that it is none. Wide rows
    that have no partner are not shuffled so."""
    bitmap = stored(bloom(keys, key), name)
    n_bits = bitmap.agg(F.max("n_bits")).first()[0]
    if n_bits is None:
        return df.where(F.lit(False)), df
    rest = _looked_up(df, key, bitmap, n_bits, "left").where("not coalesce(__may, false)").select(df.columns)
    return maybe_in(df, key, bitmap, n_bits), rest


def semi_by_bloom(df: DataFrame, key: str, keys: DataFrame, name: str) -> DataFrame:
    """Rows of ``df`` whose columns named as those of ``keys`` are a row of it
    (``keys`` has no row twice), thinned by a bounded bitmap of its 64-bit
    ``key`` before the exact join. That is an inner join: Spark moves a semi-join
    below the bitmap's, and then shuffles all of ``df``."""
    bitmap = stored(bloom(keys, key), name)
    n_bits = bitmap.agg(F.max("n_bits")).first()[0]
    if n_bits is None:
        return df.where(F.lit(False))
    return maybe_in(df, key, bitmap, n_bits).join(keys, keys.columns).select(df.columns)


# ----------------------------------------------------- connected components --

def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of the links (a, b): rows (id, comp) for every id
    that occurs, ``comp`` being the smallest id reachable.

    Every round hooks each id to its smallest neighbour, follows the pointers
    to their roots by doubling, and contracts the links to links between
    roots; each round at least halves the ids that still have a link. All
    state is in tables of the shared folder; the driver sees counts only.
    """
    spark = edges.sparkSession
    both = edges.select("a", "b").where("a <> b")
    both = stored(both.union(both.select("b", "a")).distinct(), f"{name}-links")
    labels = None
    while not both.isEmpty():
        point = both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("a"), F.min("b")).alias("comp"))
        point = stored(point, f"{name}-hook")
        while True:
            up = point.select(F.col("id").alias("comp"), F.col("comp").alias("up"))
            jumped = stored(point.join(up, "comp", "left").select(
                "id", F.coalesce("up", "comp").alias("comp"),
                (F.coalesce("up", "comp") != F.col("comp")).alias("moved")), f"{name}-jump")
            moved = not jumped.where("moved").isEmpty()
            point = jumped.select("id", "comp")
            if not moved:
                break
        if labels is None:
            labels = point
        else:
            up = point.select(F.col("id").alias("comp"), F.col("comp").alias("up"))
            labels = stored(labels.join(up, "comp", "left").select("id", F.coalesce("up", "comp").alias("comp")),
                            f"{name}-labels")
        to = point.select(F.col("id").alias("a"), F.col("comp").alias("ca"))
        to_b = point.select(F.col("id").alias("b"), F.col("comp").alias("cb"))
        both = stored(both.join(to, "a").join(to_b, "b").where("ca <> cb")
                      .select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), f"{name}-links")
    if labels is None:
        return edges.where(F.lit(False)).select(F.col("a").alias("id"), F.col("b").alias("comp"))
    return labels


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def arrow_batches(spark: SparkSession, rows: int = 256) -> None:
    """Bound the rows of one Arrow batch, as texts can be very long (Spark bounds
    its bytes by spark.sql.execution.arrow.maxBytesPerBatch)."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
