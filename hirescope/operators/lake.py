"""Lake queries A14–A21 over the table of every snapshot (``dt`` partition).

A posting present in several snapshots is counted once per snapshot, as the
lake holds one copy per ``dt``. Filters on ``dt`` are partition filters and
prune whole folders at the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .marts import demand

NB = "nb_offers"


def role_distribution(df: DataFrame, role: str = "role_family", name: str = NB) -> DataFrame:
    """Every role value, ``other`` and null included."""
    return demand(df.select(role), [role], name=name)


def skill_distribution(df: DataFrame, skills: str = "skills", skill: str = "skill", name: str = NB) -> DataFrame:
    """A15 / A21."""
    return demand(df.select(skills), [skill], explode=(skills, skill), name=name)


def role_skill_distribution(
    df: DataFrame, role: str = "role_family", skills: str = "skills", skill: str = "skill", name: str = "nb"
) -> DataFrame:
    """Role x skill, no role filter."""
    return demand(df.select(role, skills), [role, skill], explode=(skills, skill), name=name)


def snapshot_role_trends(df: DataFrame, dt: str = "dt", role: str = "role_family", name: str = NB) -> DataFrame:
    """Per snapshot and role."""
    return demand(df.select(dt, role), [dt, role], name=name)


def snapshot_skill_trends(
    df: DataFrame, dt: str = "dt", skills: str = "skills", skill: str = "skill", name: str = NB
) -> DataFrame:
    """Per snapshot and skill."""
    return demand(df.select(dt, skills), [dt, skill], explode=(skills, skill), name=name)


def one_snapshot(df: DataFrame, value, dt: str = "dt") -> DataFrame:
    """keep a single snapshot (a partition filter on the lake table)."""
    return df.where(F.col(dt) == F.lit(value))


def snapshot_row_count(df: DataFrame, value, dt: str = "dt", name: str = "nb_rows") -> DataFrame:
    """Rows of one snapshot, as a one-row frame."""
    return one_snapshot(df, value, dt).agg(F.count(F.lit(1)).alias(name))


def latest_snapshot_only(df: DataFrame, key: str = "offer_id", dt: str = "dt") -> DataFrame:
    """``latest_only`` for the lake queries: keep each posting's rows from its
    most recent snapshot only. Rows without a key cannot be followed across
    snapshots, rows without a snapshot not be placed in time: both are kept as
    they are.

    The per-key latest snapshot is a group-by (combined map-side, so a hot key
    costs one row per task), and the rows are kept with a semi-join on
    ``(key, dt)``, which AQE can split when a key is skewed — no window that
    would pull every copy of a key into one task.
    """
    keyed = df.where(F.col(key).isNotNull() & F.col(dt).isNotNull())
    latest = keyed.groupBy(key).agg(F.max(dt).alias(dt))
    return keyed.join(latest, on=[key, dt], how="left_semi").unionByName(df.where(F.col(key).isNull() | F.col(dt).isNull()))
