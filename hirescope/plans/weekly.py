"""The weekly batch as one Spark application.

raw JSON (one dt) -> keep-first dedupe -> flatten + clean -> enrich ->
quality metrics -> staged Parquet -> five analytics datasets.

Dedupe runs before enrichment (enrichment is row-wise, so the result is the
same and the expensive text work is done once per posting). The staged
snapshot is written first and every downstream dataset reads the written
Parquet: lineage is cut at a durable table, so losing an executor never
replays the text pipeline, and each mart scans only the columns it needs. The
staged snapshot and the datasets become current together, once all are
written; a run that fails before leaves what the last one wrote.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators import marts as M
from ..operators import quality as Q
from ..operators.dedupe import dedupe_first
from ..operators.reports import ladder_rank
from ..sources import offers as S
from ..sources.snapshots import commit, read_attempt, write_attempt


def keyword_rank(c, keywords=R.SEARCH_KEYWORDS):
    """Position of the search keyword in the ingestion order (unknown last)."""
    return F.coalesce(ladder_rank(c, keywords), F.lit(len(keywords)))


def dedupe_raw(raw: DataFrame, keywords=R.SEARCH_KEYWORDS) -> DataFrame:
    """D1 on landed postings: per id keep the row of the earliest keyword, then
    the smallest landing sequence, then the first in file order."""
    ranked = raw.withColumn("__kw_rank", keyword_rank(F.col("search_keyword"), keywords))
    order = [F.col("__kw_rank"), F.coalesce(F.col("_seq"), F.lit(0))] + ([F.col("_line")] if "_line" in raw.columns else [])
    return dedupe_first(ranked, "id", order, "_line" if "_line" in raw.columns else None).drop("__kw_rank", "_line")


def stage(raw: DataFrame, **rules) -> DataFrame:
    """Raw postings -> staged postings (22 columns, plus dt when present)."""
    return S.stage_offers(S.flatten_offer(dedupe_raw(raw)), **rules)


ANALYTICS = {
    "skill_demand": lambda df: M.skill_demand(df),
    "role_demand": lambda df: M.role_demand(df),
    "role_demand_by_seniority": lambda df: M.role_demand_by_seniority(df),
    "role_demand_by_domain_focus": lambda df: M.role_demand_by_domain_focus(df),
    "role_skill_demand": lambda df: M.role_skill_demand_distinct(df),
}


@dataclass
class RunReport:
    dedupe: dict
    quality: list
    outputs: dict
    steps: list


def run(spark: SparkSession, raw_path: str, stage_path: str, analytics_path: str, dt: str) -> RunReport:
    landed = S.read_raw_offers(spark, raw_path, dt)
    # Q1 blocks before anything is written: deduplication keeps a row of any
    # landed rows, so an empty snapshot shows here
    Q.gate(landed, f"for dt={dt}")
    raw, raw_obs = Q.observe_step(landed, "raw", rows=F.count(F.lit(1)))
    deduped, dd_obs = Q.observe_step(dedupe_raw(raw), "deduped", rows=F.count(F.lit(1)))
    staged = write_attempt(S.stage_offers(S.flatten_offer(deduped)), stage_path, dt)
    # D2 from the counts observed during the write (no second pass over raw)
    n_raw, n_dedup = Q.observed(raw_obs, "rows"), Q.observed(dd_obs, "rows")
    counts = {"raw_rows": n_raw, "deduped_rows": n_dedup, "duplicates_removed": n_raw - n_dedup}

    snapshot = read_attempt(spark, staged)
    quality = [r.asDict() for r in Q.metrics(snapshot).collect()]  # four rows
    seen = snapshot.agg(F.count(F.lit(1)).alias("n"), F.count_if(M.classified("role_family")).alias("classified")).first()

    datasets = {name: write_attempt(build(snapshot), S.analytics_root(analytics_path, name), dt, staged.name)
                for name, build in ANALYTICS.items()}
    # all parts of the run are written: now, and only now, they become current
    commit(spark, [staged, *datasets.values()])
    outputs = {name: made.path for name, made in datasets.items()}
    written = {name: read_attempt(spark, made) for name, made in datasets.items()}
    return RunReport(counts, quality, outputs, Q.step_summary(seen["n"], seen["classified"], written))


def main(argv=None) -> None:
    """``python -m hirescope.plans.weekly --raw R --stage S --analytics A --dt D``"""
    import argparse
    import datetime
    import json

    from ..session import configure

    ap = argparse.ArgumentParser(description="weekly posting staging and demand datasets")
    ap.add_argument("--raw", required=True)
    ap.add_argument("--stage", required=True)
    ap.add_argument("--analytics", required=True)
    ap.add_argument("--dt", default=datetime.date.today().isoformat())
    args = ap.parse_args(argv)
    spark = configure(SparkSession.builder.appName("hirescope-weekly").getOrCreate())
    report = run(spark, args.raw, args.stage, args.analytics, args.dt)
    print(json.dumps({"dedupe": report.dedupe, "quality": report.quality, "steps": report.steps,
                      "outputs": report.outputs}, default=str))


if __name__ == "__main__":
    main()
