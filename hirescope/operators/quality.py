"""Data-quality operators Q1–Q10.

All percentages and null counts come from a single ``agg`` pass; results are
long tables ``(metric, value, passed)`` so new checks are new rows, not new
columns.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import QUALITY_THRESHOLDS
from ..functions.text import populated
from .marts import relevant


class QualityError(ValueError):
    pass


def _pct(cond: Column) -> Column:
    # round(100 * n / total, 2); null instead of an error on empty input
    return F.round(F.try_divide(F.lit(100.0) * F.sum(cond.cast("long")), F.count(F.lit(1))), 2)


def _passed(metric: Column, value: Column, thresholds: Mapping[str, tuple[str, float]]) -> Column:
    expr = F.lit(None).cast("boolean")
    for name, (op, limit) in thresholds.items():
        check = value > F.lit(limit) if op == ">" else value >= F.lit(limit)
        expr = F.when(metric == F.lit(name), check).otherwise(expr)
    return expr


def metrics(
    df: DataFrame,
    title: str = "title_clean",
    role: str = "role_family",
    company: str = "company_name_clean",
    by: Sequence[str] = (),
    thresholds: Mapping[str, tuple[str, float]] = QUALITY_THRESHOLDS,
) -> DataFrame:
    """Q2–Q5: row count, populated title %, relevant role %, populated
    company %, each with a pass/fail verdict where a threshold exists."""
    aggs = [
        F.count(F.lit(1)).cast("double").alias("total_rows"),
        _pct(populated(F.col(title))).alias("title_clean_populated_pct"),
        _pct(relevant(role)).alias("relevant_role_family_pct"),
        _pct(populated(F.col(company))).alias("company_name_clean_populated_pct"),
    ]
    names = ["total_rows", "title_clean_populated_pct", "relevant_role_family_pct", "company_name_clean_populated_pct"]
    wide = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    long = wide.select(
        *by,
        F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])).alias("m"),
    ).select(*by, "m.metric", "m.value")
    return long.withColumn("passed", _passed(F.col("metric"), F.col("value"), thresholds))


def gate(df: DataFrame, label: str = "") -> None:
    """Q1: raise when the output is empty. Reads until the first row only, so
    it can stand before the write that it guards."""
    if df.isEmpty():
        raise QualityError(f"no rows produced {label}".strip())


def not_null_tests(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q6: failing (null) rows per column, one pass: (column, failing_rows, passed)."""
    wide = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in columns])
    long = wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c), F.lit(0)).alias("failing_rows")) for c in columns
    ])).alias("t")).select("t.column", "t.failing_rows")
    return long.withColumn("passed", F.col("failing_rows") == 0)


def unique_test(df: DataFrame, key: str) -> DataFrame:
    """Q7: keys seen more than once (nulls ignored) and the rows involved."""
    digest = F.sha2(F.col(key).cast("string").cast("binary"), 256)  # long keys move as 64 characters
    dup = df.where(F.col(key).isNotNull()).groupBy(digest).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return dup.agg(
        F.count(F.lit(1)).alias("duplicated_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("failing_rows"),
    ).select(F.lit(key).alias("column"), "duplicated_keys", "failing_rows",
             (F.col("duplicated_keys") == 0).alias("passed"))


def checksum(df: DataFrame) -> Column:
    """Q8: the sum of the rows' 64-bit hashes, an aggregate that does not depend
    on the order of rows; a changed value changes it though the count is equal."""
    cols = [F.sort_array(F.map_entries(f.name)) if isinstance(f.dataType, T.MapType) else F.col(f.name) for f in df.schema.fields]
    return F.sum(F.xxhash64(*cols).cast("decimal(20,0)"))


def reconcile(expected, loaded) -> bool:
    """Q8: post-load reconciliation of counts (and checksums)."""
    return expected == loaded


def schema_changes(old: T.StructType, new: T.StructType) -> list[tuple[str, str | None, str | None]]:
    """Q9: columns added, dropped or retyped between two snapshots
    (metadata only, no data read)."""
    a = {f.name: f.dataType.simpleString() for f in old.fields}
    b = {f.name: f.dataType.simpleString() for f in new.fields}
    out = []
    for name in sorted(set(a) | set(b)):
        if a.get(name) != b.get(name):
            out.append((name, a.get(name), b.get(name)))
    return out


def metrics_over_snapshots(df: DataFrame, dt: str = "dt", **kw) -> DataFrame:
    """Q10: Q2–Q5 per snapshot with the previous snapshot's value and the
    change. The window runs over the per-snapshot metric rows (one per dt
    and metric), never over postings."""
    per = metrics(df, by=[dt], **kw)
    w = Window.partitionBy("metric").orderBy(dt)
    return per.withColumn("previous", F.lag("value").over(w)).withColumn(
        "change", F.round(F.col("value") - F.col("previous"), 2)
    )


def observe_step(df: DataFrame, step: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Attach named metrics (e.g. ``rows=F.count(F.lit(1))``) to a step.

    They are computed while the step runs for its own action (a write), so a
    summary never costs another pass over the data.
    """
    obs = Observation(step)
    return df.observe(obs, *[m.alias(k) for k, m in metrics.items()]), obs


def observed(obs: Observation, metric: str) -> int:
    """A count of a finished observation; 0 where the step had no rows to
    count (the optimizer may drop an empty step together with its metrics)."""
    try:
        return obs.get.get(metric) or 0
    except AssertionError:
        return 0


def step_summary(rows_in: int, rows_classified: int, outputs: Mapping[str, DataFrame]) -> list[tuple[str, str, float]]:
    """``(step, metric, value)`` rows: what went into every dataset, and the
    rows it was written with (a count of the written Parquet footers)."""
    out = []
    for step, df in outputs.items():
        out += [(step, "rows_classified", float(rows_classified)), (step, "rows_in", float(rows_in)),
                (f"{step}_out", "output_rows", float(df.count()))]
    return out
