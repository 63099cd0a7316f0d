"""Demand marts A1–A13 and the explode family J1–J3.

One generic ``demand`` builds every mart: optional filter, optional explode of
an array column, group by the keys, count rows (or distinct ids). Catalyst
pushes the filter into the Parquet scan, prunes the wide text columns and
plans partial + final aggregation, so each mart is one scan and one shuffle
of pre-aggregated rows. Hot keys are harmless: map-side partial aggregation
reduces any key to one row per task before the shuffle.

Marts do not sort; ordering belongs to the report layer (``reports``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import IRRELEVANT_ROLES

UNKNOWN = "unknown"


# ------------------------------------------------------------ predicates --

def classified(role: str | Column) -> Column:
    """role present and not ``other``."""
    c = F.col(role) if isinstance(role, str) else role
    return c.isNotNull() & (c != F.lit("other"))


def known(level: str | Column, unknown: str = UNKNOWN) -> Column:
    """level present and not ``unknown``."""
    c = F.col(level) if isinstance(level, str) else level
    return c.isNotNull() & (c != F.lit(unknown))


def relevant(role: str | Column) -> Column:
    """role present and not in the irrelevant set."""
    c = F.col(role) if isinstance(role, str) else role
    return c.isNotNull() & ~c.isin(*IRRELEVANT_ROLES)


def month_of(ts: str | Column) -> Column:
    """Month bucket, kept as ``timestamp_ntz`` (date_trunc returns an
    LTZ timestamp even for NTZ input)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_trunc("month", c).cast("timestamp_ntz")


# --------------------------------------------------------------- explode --

def explode_terms(df: DataFrame, array_col: str, out: str) -> DataFrame:
    """One row per array element; null and empty arrays vanish,
    null elements are dropped (F4, F5).

    Written as ``explode_outer`` + a filter on the element: same rows as an
    inner explode, but Catalyst infers no ``size(array) > 0`` predicate, which
    it would push below projections and repartitions with the (possibly very
    expensive) array expression inlined into it.
    """
    keep = [c for c in df.columns if c != array_col]
    return df.select(*keep, F.explode_outer(F.col(array_col)).alias(out)).where(F.col(out).isNotNull())


# ---------------------------------------------------------------- demand --

def demand(
    df: DataFrame,
    keys: Sequence[str | Column],
    *,
    where: Column | None = None,
    explode: tuple[str, str] | None = None,
    distinct: str | None = None,
    name: str = "demand",
) -> DataFrame:
    """Group-count: ``keys -> name`` (bigint).

    ``explode=(array_col, alias)`` flattens an array first; ``distinct``
    counts distinct values of that column instead of rows.
    """
    if where is not None:
        df = df.where(where)
    if explode is not None:
        arr, alias = explode
        df = explode_terms(df, arr, alias)
    measure = F.count(F.lit(1)) if distinct is None else F.count_distinct(F.col(distinct))
    return df.groupBy(*keys).agg(measure.alias(name))


# ------------------------------------------------------------- the marts --

def role_demand(df: DataFrame, role: str = "role_family") -> DataFrame:
    """A1 / A10."""
    return demand(df, [role], where=classified(role))


def skill_demand(df: DataFrame, skills: str = "skills", skill: str = "skill") -> DataFrame:
    """Every posting counts, whatever its role."""
    return demand(df.select(skills), [skill], explode=(skills, skill))


def role_skill_demand(df: DataFrame, role: str = "role_family", skills: str = "skills", skill: str = "skill") -> DataFrame:
    """A3 (and A4, the same query under a second name): rows per role x skill."""
    return demand(df.select(role, skills), [role, skill], where=classified(role), explode=(skills, skill))


skill_demand_by_role = role_skill_demand


def role_skill_demand_distinct(
    df: DataFrame, role: str = "role_family", skills: str = "skills", key: str = "offer_id", skill: str = "skill"
) -> DataFrame:
    """Distinct postings per role x skill (null ids are not counted)."""
    return demand(
        df.select(role, skills, key), [role, skill], where=classified(role), explode=(skills, skill), distinct=key
    )


def role_demand_by(df: DataFrame, level: str, role: str = "role_family", unknown: str = UNKNOWN) -> DataFrame:
    """Role x level with both classified."""
    return demand(df, [role, level], where=classified(role) & known(level, unknown))


def role_demand_by_seniority(df: DataFrame, role: str = "role_family", level: str = "seniority_level") -> DataFrame:
    return role_demand_by(df, level, role)


def role_demand_by_domain_focus(df: DataFrame, role: str = "role_family", level: str = "domain_focus") -> DataFrame:
    return role_demand_by(df, level, role)


def skill_trends_by_month(
    df: DataFrame, time: str = "created_at", skills: str = "skills", skill: str = "skill"
) -> DataFrame:
    """Month x skill over all roles (F6: time present)."""
    staged = df.where(F.col(time).isNotNull()).select(month_of(time).alias("month"), F.col(skills))
    return demand(staged, ["month", skill], explode=(skills, skill))


def role_trends_by_month(df: DataFrame, time: str = "created_at", role: str = "role_family") -> DataFrame:
    """Month x classified role."""
    staged = df.where(F.col(time).isNotNull() & classified(role)).select(month_of(time).alias("month"), F.col(role))
    return demand(staged, ["month", role])
