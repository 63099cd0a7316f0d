"""Day snapshots that are replaced in one step.

Layout: ``<root>/dt=YYYY-MM-DD/<attempt>/part-*.parquet`` and the log
``<root>/_log/commits``. A write goes into a folder of its own (an attempt);
nothing reads it until a row of the log names it as the day's current one. The
log row is one appended file, which Spark's output commit makes visible whole,
so a reader has the old snapshot or the new one, and a job that dies on the
way changes nothing. A day has one writer at a time.

Readers that started before a commit keep their files: the attempt that was
current before is removed by the day's next commit only (or by ``vacuum``).
Folders that were written without a log are read as they are; their days enter
the log with the first commit beside them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = "seq long, dt string, attempt string, source string"
_PLAIN = "."  # the attempt of a day that was written without a log


@dataclass(frozen=True)
class Attempt:
    """A written snapshot that is not current yet. ``source`` names what it was
    made from, for incremental readers."""

    root: str
    dt: str
    name: str
    source: str | None = None

    @property
    def path(self) -> str:
        return f"{self.root}/dt={self.dt}" if self.name == _PLAIN else f"{self.root}/dt={self.dt}/{self.name}"


def _fs(spark: SparkSession, path: str):
    """Hadoop's file system of ``path``, and the path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _listed(spark: SparkSession, path: str) -> list:
    fs, at = _fs(spark, path)
    return list(fs.listStatus(at)) if fs.exists(at) else []


def _current(spark: SparkSession, root: str) -> tuple[int, dict[str, Attempt]]:
    """(last sequence number, day -> current attempt)."""
    path = f"{root}/_log/commits"
    if not _listed(spark, path):
        return 0, {}
    latest = F.max_by(F.struct("seq", "attempt", "source"), F.struct("seq", "attempt")).alias("a")
    rows = spark.read.schema(LOG_SCHEMA).json(path).groupBy("dt").agg(latest).collect()  # one row a day
    return max(r.a.seq for r in rows), {r.dt: Attempt(root, r.dt, r.a.attempt, r.a.source) for r in rows}


def committed(spark: SparkSession, root: str) -> dict[str, Attempt]:
    """The current attempt of every day in the log."""
    return _current(spark, root.rstrip("/"))[1]


def write_attempt(df: DataFrame, root: str, dt, source: str | None = None) -> Attempt:
    """Write ``df`` (without its ``dt``) as an attempt at the day; an empty one
    is written too, with its schema."""
    made = Attempt(root.rstrip("/"), str(dt), f"attempt-{uuid.uuid4().hex[:12]}", source)
    df.drop("dt").write.parquet(made.path)
    return made


def commit(spark: SparkSession, attempts: Sequence[Attempt]) -> None:
    """Make the attempts current: one log file for all days of a root."""
    for root in dict.fromkeys(a.root for a in attempts):
        last, now = _current(spark, root)
        mine = [a for a in attempts if a.root == root]
        rows = [(last + 1, a.dt, a.name, a.source) for a in mine]
        if not last:
            rows = [(0, dt, _PLAIN, None) for dt in _plain_days(spark, root)] + rows
        spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").json(f"{root}/_log/commits")
        for a in mine:  # what was current stays for its readers, older ones go
            keep = {a.name, now[a.dt].name if a.dt in now else _PLAIN}
            _remove_others(spark, root, a.dt, keep)


def _plain_days(spark: SparkSession, root: str) -> list[str]:
    days = []
    for folder in _listed(spark, root):
        name = folder.getPath().getName()
        if folder.isDirectory() and name.startswith("dt=") and any(
                f.isFile() and f.getPath().getName().endswith(".parquet") for f in _listed(spark, f"{root}/{name}")):
            days.append(name[3:])
    return sorted(days)


def _remove_others(spark: SparkSession, root: str, dt: str, keep: set[str]) -> None:
    for entry in _listed(spark, f"{root}/dt={dt}"):
        name = entry.getPath().getName() if entry.isDirectory() else _PLAIN
        if name not in keep:
            _fs(spark, root)[0].delete(entry.getPath(), True)


def vacuum(spark: SparkSession, root: str) -> None:
    """Remove all attempts but the current ones (no reader may be running)."""
    root = root.rstrip("/")
    for dt, a in committed(spark, root).items():
        _remove_others(spark, root, dt, {a.name})


def read_attempt(spark: SparkSession, attempt: Attempt) -> DataFrame:
    """What an attempt wrote, with its ``dt``; also before it is current."""
    df = spark.read.parquet(attempt.path)
    return df.withColumn("dt", F.lit(attempt.dt).cast("date"))


def read_snapshots(spark: SparkSession, root: str, dt=None) -> DataFrame:
    """The current snapshots of all days, or of one: only their folders are
    listed. A day that is not there gives no rows."""
    root = root.rstrip("/")
    now = committed(spark, root)
    chosen = [now[str(dt)]] if dt is not None and str(dt) in now else list(now.values())
    df = spark.read.option("basePath", root).parquet(*([a.path for a in chosen] or [root]))
    if not isinstance(df.schema["dt"].dataType, T.DateType):
        df = df.withColumn("dt", F.col("dt").cast("date"))
    return df if dt is None else df.where(F.col("dt") == F.lit(dt).cast("date"))
