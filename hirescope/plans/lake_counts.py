"""Lake trends kept day by day (A14-A18 without rescanning the lake).

``refresh`` compares the snapshots of the lake that are current with those that
were counted, and reads only the others: new days and replaced ones. A day's
counts are a snapshot of their own table, committed with the name of the
lake's attempt they were made from, so a refresh that dies half-way leaves
some days counted and the rest for the next one. Every lake query is then a
small aggregation over the counts, and equals the same query over the lake.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lake as L
from ..sources.snapshots import commit, committed, read_attempt, read_snapshots, write_attempt

COUNTS_SCHEMA = "kind string, role_family string, skill string, n long"


def day_counts(day: DataFrame, role: str = "role_family", skills: str = "skills") -> DataFrame:
    """``(kind, role_family, skill, n)`` of one snapshot: rows by role (kind
    ``role``) and elements by role and skill (kind ``skill``)."""
    by_role = L.role_distribution(day, role, "n").select(
        F.lit("role").alias("kind"), F.col(role).alias("role_family"), F.lit(None).cast("string").alias("skill"), "n")
    by_skill = L.role_skill_distribution(day, role, skills, "skill", "n").select(
        F.lit("skill").alias("kind"), F.col(role).alias("role_family"), "skill", "n")
    return by_role.unionByName(by_skill)


def refresh(spark: SparkSession, lake: str, counts: str, role: str = "role_family", skills: str = "skills") -> list[str]:
    """Count the days of ``lake`` whose current snapshot is not the one counted;
    returns these days."""
    have, done = committed(spark, lake), committed(spark, counts)
    days = sorted(dt for dt, a in have.items() if dt not in done or done[dt].source != a.name)
    for dt in days:
        counted = day_counts(read_attempt(spark, have[dt]), role, skills)
        commit(spark, [write_attempt(counted, counts, dt, source=have[dt].name)])
    return days


def _kind(spark: SparkSession, counts: str, kind: str) -> DataFrame:
    if not committed(spark, counts):
        return spark.createDataFrame([], COUNTS_SCHEMA + ", dt date")
    return read_snapshots(spark, counts).where(F.col("kind") == kind)


def _total(df: DataFrame, *keys: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("n").alias(name))


def role_trends(spark: SparkSession, counts: str) -> DataFrame:
    """A17 from the counts."""
    return _total(_kind(spark, counts, "role"), "dt", "role_family", name=L.NB)


def skill_trends(spark: SparkSession, counts: str) -> DataFrame:
    """A18 from the counts."""
    return _total(_kind(spark, counts, "skill"), "dt", "skill", name=L.NB)


def role_distribution(spark: SparkSession, counts: str) -> DataFrame:
    """A14 from the counts."""
    return _total(_kind(spark, counts, "role"), "role_family", name=L.NB)


def skill_distribution(spark: SparkSession, counts: str) -> DataFrame:
    """A15 from the counts."""
    return _total(_kind(spark, counts, "skill"), "skill", name=L.NB)


def role_skill_distribution(spark: SparkSession, counts: str) -> DataFrame:
    """A16 from the counts."""
    return _total(_kind(spark, counts, "skill"), "role_family", "skill", name="nb")
