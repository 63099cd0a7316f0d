"""Keep-first deduplication D1 and its counts D2.

``dedupe_first`` keeps, per key, the row that is smallest in ``order``. It is an
aggregate (``min_by``) rather than a ``row_number`` window: the aggregate is
combined map-side, so a key that holds a third of all rows is reduced to one
row per task before the shuffle, whereas a window would pull every copy of
that key into one task.

String keys are grouped and compared by their SHA-256 digest, so long texts
are never sorted by; with a row key they are not carried either. Null keys form one group (as in pandas
``drop_duplicates``). Payload columns may be of any type, maps included.
``order`` must be a total order within a key for a deterministic result;
descending numeric order is expressed by negating the column.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _digest(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    return F.sha2(c.cast("binary"), 256) if isinstance(df.schema[name].dataType, T.StringType) else c


def dedupe_first(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column],
                 row_key: str | None = None) -> DataFrame:
    """D1. With ``row_key``, a column that differs between any two rows and is the
    same whenever the frame is read (an id, a place in a file), only key digests,
    order and row keys are aggregated, and the rows are fetched by the row keys
    kept: no payload, such as a long text, is ever sorted or held in a buffer.
    Without one, whole rows go through the aggregate."""
    keys = [key] if isinstance(key, str) else list(key)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order_cols)])
    groups = [_digest(df, k).alias(f"__k{i}") for i, k in enumerate(keys)]
    if row_key is None:
        row = F.struct(*[F.col(c) for c in df.columns])
        return df.groupBy(*groups).agg(F.min_by(row, rank).alias("__row")).select("__row.*")
    first = F.min(F.struct(rank.alias("rank"), F.col(row_key).alias("row"))).alias("first")
    kept = df.groupBy(*groups).agg(first).select(F.col("first.row").alias(row_key))
    # hashed on the side of the narrow rows, so that the wide ones are not sorted
    return df.join(kept.hint("shuffle_hash"), row_key, "left_semi")


def dedupe_counts(df: DataFrame, key: str) -> DataFrame:
    """Raw rows, rows after keep-first dedupe, rows removed (one pass).

    ``count(DISTINCT key)`` ignores null while dedupe keeps one null-key row,
    hence the extra ``max(key is null)``.
    """
    agg = df.select(_digest(df, key).alias("k")).agg(
        F.count(F.lit(1)).alias("raw_rows"),
        (F.count_distinct("k") + F.max(F.col("k").isNull().cast("long"))).alias("deduped_rows"),
    )
    return agg.select(
        "raw_rows",
        F.coalesce(F.col("deduped_rows"), F.lit(0)).cast("long").alias("deduped_rows"),
        (F.col("raw_rows") - F.coalesce(F.col("deduped_rows"), F.lit(0))).cast("long").alias("duplicates_removed"),
    )
