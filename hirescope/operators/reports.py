"""Report layer: ordering, top-k, parameter filters and summaries
(D3–D14, A22–A32).

Every limit is taken on a total order (ties broken by the key) so results are
deterministic. Global top-k plans as TakeOrderedAndProject (each task keeps
k rows); per-group top-k as a ``row_number`` window that Spark turns into a
partial WindowGroupLimit before the shuffle, so a group never ships more
than k rows per task.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import SENIORITY_LADDER
from ..session import shared_dir
from .marts import skill_demand


def _cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def top_k(df: DataFrame, k: int, order: Sequence[str | Column], by: Sequence[str] | None = None) -> DataFrame:
    """D8 (global) / D9 (per group ``by``): the first ``k`` rows in ``order``."""
    if not by:
        return df.orderBy(*_cols(order)).limit(k)
    w = Window.partitionBy(*by).orderBy(*_cols(order))
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k).drop("__rn")


def by_demand(key: str | Sequence[str], measure: str = "demand") -> list[Column]:
    """D3: demand descending, then the key ascending (a total order)."""
    keys = [key] if isinstance(key, str) else list(key)
    return [F.col(measure).desc(), *[F.col(k).asc() for k in keys]]


def by_role_then_demand(level: str, role: str = "role_family", measure: str = "demand") -> list[Column]:
    """Role, demand descending, then the level (total order)."""
    return [F.col(role).asc(), F.col(measure).desc(), F.col(level).asc()]


def by_snapshot(time: str, key: str, measure: str = "nb_offers") -> list[Column]:
    """Newest snapshot first, count descending, key."""
    return [F.col(time).desc(), F.col(measure).desc(), F.col(key).asc()]


def by_month(time: str, key: str, measure: str = "demand") -> list[Column]:
    """Month ascending, demand descending, key."""
    return [F.col(time).asc(), F.col(measure).desc(), F.col(key).asc()]


def ordered(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Apply a report order (a range-partitioned global sort)."""
    return df.orderBy(*_cols(order))


def with_position(df: DataFrame, position: str = "position") -> DataFrame:
    """The place (from 1) at which a sorted result stands, taken from the result
    as it was written: rows are numbered within each of its range partitions, and
    the partitions' sizes are summed up (one row each). ``df`` is written once to
    the shared folder, so the numbers do not depend on a second sort."""
    path = f"{shared_dir(df.sparkSession)}/ordered-{uuid.uuid4().hex[:12]}"
    df.withColumn("__at", F.monotonically_increasing_id()).write.parquet(path)
    written = df.sparkSession.read.parquet(path).withColumn("__part", F.shiftright("__at", 33))
    sizes = written.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")
    place = F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return written.join(sizes.select("__part", before.alias("__before")), "__part").select(*df.columns, place.alias(position))


def for_value(df: DataFrame, column: str, value) -> DataFrame:
    """F8: keep one parameter value (e.g. the selected role)."""
    return df.where(F.col(column) == F.lit(value))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values, sorted."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def ladder_rank(level: str | Column, ladder: Sequence[str] = SENIORITY_LADDER) -> Column:
    """Position in a fixed categorical order (null when not listed)."""
    c = F.col(level) if isinstance(level, str) else level
    expr = None
    for i, v in enumerate(ladder):
        expr = (F.when(c == F.lit(v), F.lit(i)) if expr is None else expr.when(c == F.lit(v), F.lit(i)))
    return expr.otherwise(F.lit(None).cast("int"))


def in_ladder_order(df: DataFrame, level: str, ladder: Sequence[str] = SENIORITY_LADDER) -> DataFrame:
    return df.withColumn("ladder_rank", ladder_rank(level, ladder)).orderBy(
        F.col("ladder_rank").asc_nulls_last(), F.col(level)
    )


def bag_union(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; duplicates kept."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def preview(df: DataFrame, columns: Sequence[str], order: Sequence[str | Column], n: int = 15) -> DataFrame:
    """First ``n`` rows of a projection, on a stated total order."""
    return df.select(*columns).orderBy(*_cols(order)).limit(n)


# ------------------------------------------------------- dashboard data ---

def kpis(role_dem: DataFrame, skill_dem: DataFrame, role_skill_dem: DataFrame,
         role: str = "role_family", skill: str = "skill") -> DataFrame:
    """Unique roles, unique skills, role-skill pairs, as (metric, value)."""
    return bag_union([
        role_dem.agg(F.count_distinct(role).alias("value")).select(F.lit("unique_roles").alias("metric"), "value"),
        skill_dem.agg(F.count_distinct(skill).alias("value")).select(F.lit("unique_skills").alias("metric"), "value"),
        role_skill_dem.agg(F.count(F.lit(1)).alias("value")).select(F.lit("role_skill_pairs").alias("metric"), "value"),
    ])


def top_skills_of_role(role_skill_dem: DataFrame, role_value: str, k: int = 10,
                       role: str = "role_family", skill: str = "skill") -> DataFrame:
    """Top-k skills for one role."""
    return top_k(for_value(role_skill_dem, role, role_value), k, by_demand(skill))


def role_levels(role_level_dem: DataFrame, role_value: str, level: str,
                role: str = "role_family", ladder: Sequence[str] | None = None) -> DataFrame:
    """A28 (ladder order) / A29 (demand order) for one role."""
    one = for_value(role_level_dem, role, role_value)
    if ladder is not None:
        return in_ladder_order(one, level, ladder)
    return one.orderBy(*by_demand(level))


def top_skill_trends(skill_trends: DataFrame, role_skill_dem: DataFrame, role_value: str, k: int = 5,
                     role: str = "role_family", skill: str = "skill") -> DataFrame:
    """The monthly trend (over all roles) of one role's top-k skills.

    The top-k list has at most k rows, so broadcasting it is bounded by k.
    """
    top = top_skills_of_role(role_skill_dem, role_value, k, role, skill).select(skill)
    return skill_trends.join(F.broadcast(top), on=skill, how="left_semi")


def dataset_summary(df: DataFrame, role: str = "role_family", skills: str = "skills", k: int = 5) -> DataFrame:
    """Totals and top-k roles / skills as (section, key, value).

    Every posting gives one row for itself, one for its role and one for each
    skill; their counts per (section, key) are the only aggregation over the
    input, and totals and ranks are read off these counts (both branches share
    the one exchange).
    """
    one = F.struct(F.lit("offers").alias("section"), F.lit(None).cast("string").alias("key"))
    of_role = F.struct(F.lit("top_roles").alias("section"), F.col(role).cast("string").alias("key"))
    of_skill = F.transform(F.coalesce(F.col(skills), F.array().cast("array<string>")),
                           lambda x: F.struct(F.lit("top_skills").alias("section"), x.alias("key")))
    counts = (df.select(F.explode(F.concat(F.array(one, of_role), of_skill)).alias("r"))
              .groupBy("r.section", "r.key").agg(F.count(F.lit(1)).alias("value")))
    known = F.col("key").isNotNull()
    wide = counts.agg(
        F.coalesce(F.sum(F.when(F.col("section") == "offers", F.col("value"))), F.lit(0)).alias("offers"),
        F.count_if((F.col("section") == "top_roles") & known).alias("unique_roles"),
        F.count_if((F.col("section") == "top_skills") & known).alias("unique_skills"))
    totals = wide.select(F.explode(F.array(*[
        F.struct(F.lit("total").alias("section"), F.lit(n).alias("key"), F.col(n).cast("long").alias("value"))
        for n in ("offers", "unique_roles", "unique_skills")])).alias("t")).select("t.*")
    # value counts ignore postings without a role (and null skills)
    rank = F.row_number().over(Window.partitionBy("section").orderBy((~known), F.desc("value"), "key"))
    top = counts.withColumn("rank", rank).where((F.col("section") != "offers") & known & (F.col("rank") <= k))
    return totals.unionByName(top.drop("rank"))


def coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Value counts with nulls for several columns in one pass:
    ``(column, value, n)``; unpivot then one group-by, one shuffle."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("__p")
    return (
        df.select(pairs)
        .select("__p.column", "__p.value")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


TOTAL = "__total__"


def keyword_summary(df: DataFrame, keywords: DataFrame, keyword: str = "search_keyword",
                    dim_key: str = "keyword") -> DataFrame:
    """Rows per search keyword, keywords without rows listed with 0,
    plus a total row (null keywords included). The counts per keyword and in
    total come from one rollup; the keyword dimension drives a left join against
    them (one row per keyword on each side)."""
    rolled = df.rollup(keyword).agg(F.count(F.lit(1)).alias("n"), F.grouping(keyword).alias("all"))
    counts = rolled.select(F.when(F.col("all") == 1, F.lit(TOTAL)).otherwise(F.col(keyword)).alias(dim_key), "n")
    listed = bag_union([keywords.select(dim_key), keywords.sparkSession.createDataFrame([(TOTAL,)], f"{dim_key} string")])
    return listed.join(counts, on=dim_key, how="left").select(
        F.col(dim_key), F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n_rows"))
