"""Readers and writers S1–S9 and the staging projections P1–P6.

Layout: ``<root>/dt=YYYY-MM-DD/...``; ``dt`` is a partition column, never
stored in the files, declared as DATE on read so partition filters prune
folders. Staged and analytics tables are replaced day by day in one step
(``sources.snapshots``).
"""

from __future__ import annotations

import uuid
from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from ..functions import text as X
from ..functions.enrich import enrich_frame
from .snapshots import commit, read_snapshots, write_attempt

# Raw posting as landed (JSON lines). Unknown fields are ignored.
RAW_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("intitule", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("romeCode", T.StringType()),
    T.StructField("romeLibelle", T.StringType()),
    T.StructField("dateCreation", T.StringType()),
    T.StructField("dateActualisation", T.StringType()),
    T.StructField("lieuTravail", T.StructType([T.StructField("libelle", T.StringType())])),
    T.StructField("entreprise", T.StructType([T.StructField("nom", T.StringType())])),
    T.StructField("salaire", T.StructType([
        T.StructField("libelle", T.StringType()), T.StructField("commentaire", T.StringType()),
    ])),
    T.StructField("typeContrat", T.StringType()),
    T.StructField("typeContratLibelle", T.StringType()),
    T.StructField("search_keyword", T.StringType()),
    T.StructField("_seq", T.LongType()),
])

STAGE_COLUMNS = [
    "offer_id", "title", "title_clean", "role_family", "rome_code", "rome_label", "created_at", "updated_at",
    "department_or_location", "company_name", "company_name_clean", "contract_type", "contract_label",
    "salary_label", "description", "description_clean", "skills", "hiring_industry", "seniority_level",
    "domain_focus", "search_keyword", "source",
]


def _dt_filter(df: DataFrame, dt) -> DataFrame:
    """One day: a filter on the partition column (folder names are dates, which
    Spark reads as DATE)."""
    return df if dt is None else df.where(F.col("dt").cast("date") == F.lit(dt).cast("date"))


# ------------------------------------------------------------------ S1 ----

def read_raw_offers(spark: SparkSession, path: str, dt=None) -> DataFrame:
    """JSON lines with a declared schema; blank lines are skipped and a
    malformed line fails the job (FAILFAST), as a bad record should.

    ``_line`` is each row's place in file order (file, split, row within the
    split), so that keep-first is defined for files without ``_seq``. A ``dt``
    can only be chosen where the path is the root of the day folders.
    """
    df = spark.read.schema(RAW_SCHEMA).option("mode", "FAILFAST").json(path)
    if "dt" in df.columns:
        # below the row numbers, which no filter passes: only the chosen day's
        # folder is listed, opened and parsed
        df = _dt_filter(df, dt).withColumn("dt", F.col("dt").cast("date"))
    elif dt is not None:
        raise ValueError(f"{path} has no dt=... folders to choose {dt} from")
    return df.select("*", F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row")).alias("_line"))


# ------------------------------------------------------------------ S2 ----

def land_offers(pages: Mapping[str, DataFrame], path: str, dt: str) -> None:
    """S2 + D12: tag each keyword's results with the keyword and a sequence
    number, union them (duplicates kept) and replace the day's raw files, so
    that a rerun neither doubles rows nor keeps withdrawn postings."""
    if not pages:
        raise ValueError("no keyword results to land")
    frames = []
    for keyword, df in pages.items():
        frames.append(
            df.withColumn("search_keyword", F.lit(keyword))
            .withColumn("_seq", F.monotonically_increasing_id())
        )
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    out.write.mode("overwrite").json(f"{path}/dt={dt}")


# ---------------------------------------------------------------- P1–P4 ---

def salary_fallback(libelle: Column, commentaire: Column) -> Column:
    """``libelle`` unless empty/null, else ``commentaire``."""
    return F.coalesce(F.nullif(libelle, F.lit("")), commentaire)


def flatten_offer(raw: DataFrame, source: str = R.SOURCE_NAME) -> DataFrame:
    """Nested raw posting -> flat columns, cleaned text included.

    HTML decoding (the only Python step) runs once per text column here;
    enrichment then reads the cleaned columns.
    """
    extra = [c for c in ("dt",) if c in raw.columns]
    return raw.select(
        F.col("id").alias("offer_id"),
        F.col("intitule").alias("title"),
        X.clean_title(F.col("intitule")).alias("title_clean"),
        F.col("romeCode").alias("rome_code"),
        F.col("romeLibelle").alias("rome_label"),
        F.col("dateCreation").alias("created_at"),
        F.col("dateActualisation").alias("updated_at"),
        F.col("lieuTravail.libelle").alias("department_or_location"),
        F.col("entreprise.nom").alias("company_name"),
        X.clean_company(F.col("entreprise.nom")).alias("company_name_clean"),
        F.col("typeContrat").alias("contract_type"),
        F.col("typeContratLibelle").alias("contract_label"),
        salary_fallback(F.col("salaire.libelle"), F.col("salaire.commentaire")).alias("salary_label"),
        F.col("description"),
        X.clean_text(F.col("description")).alias("description_clean"),
        F.col("search_keyword"),
        F.lit(source).alias("source"),
        *extra,
    )


def stage_offers(flat: DataFrame, **rules) -> DataFrame:
    """E7 on flattened postings, columns in the staged order."""
    extra = [c for c in ("dt",) if c in flat.columns]
    return enrich_frame(flat, "title_clean", "description_clean", **rules).select(*STAGE_COLUMNS, *extra)


# ------------------------------------------------------------------ P5/P6 -

def safe_timestamp(c: Column) -> Column:
    """Text -> timestamp_ntz, null when unparseable (never an error);
    a zone suffix is dropped and the wall clock kept."""
    return c.try_cast(T.TimestampNTZType())


def staging_view(stage: DataFrame) -> DataFrame:
    """P5: the staging view — same columns, timestamps typed."""
    return stage.withColumns({
        "created_at": safe_timestamp(F.col("created_at")),
        "updated_at": safe_timestamp(F.col("updated_at")),
    })


# ------------------------------------------------------------- S3–S7 ------

def write_stage(df: DataFrame, path: str, dt) -> None:
    """S3: the snapshot ``dt`` as Parquet; a rerun replaces that day, also when
    the new snapshot is empty, and no other. Readers see the old snapshot until
    the new one is whole (``sources.snapshots``)."""
    commit(df.sparkSession, [write_attempt(df, path, dt)])


def read_stage(spark: SparkSession, path: str, dt=None) -> DataFrame:
    """The staged table, one snapshot or all (only their folders are listed)."""
    return read_snapshots(spark, path, dt)


lake_table = read_stage


def analytics_root(base: str, name: str, version: str = "v1") -> str:
    return f"{base}/{name}/{version}"


def write_analytics(df: DataFrame, base: str, name: str, dt, version: str = "v1") -> None:
    """``<base>/<name>/<version>/dt=...``, one snapshot replaced as in S3."""
    commit(df.sparkSession, [write_attempt(df, analytics_root(base, name, version), dt)])


def read_analytics(spark: SparkSession, base: str, name: str, dt=None, version: str = "v1") -> DataFrame:
    """A dataset of S5, one snapshot or all."""
    return read_snapshots(spark, analytics_root(base, name, version), dt)


def load_warehouse(df: DataFrame, table: str = "stg_offres") -> int:
    """S6 + Q8: load the snapshot beside the table, reconcile, then swap.

    Row count and an order-independent checksum of all rows are observed while
    the write runs (the input is computed once) and compared with what the
    loaded table holds. A load that differs is dropped and the old table stays.
    """
    from ..operators.quality import checksum, observe_step, observed, reconcile

    spark = df.sparkSession
    beside = f"{table}__load_{uuid.uuid4().hex[:8]}"
    sums = {"rows": F.count(F.lit(1)), "checksum": checksum(df)}
    watched, obs = observe_step(df, beside, **sums)
    watched.write.saveAsTable(beside)
    loaded = spark.table(beside)
    got = loaded.agg(F.count(F.lit(1)).alias("rows"), checksum(loaded).alias("checksum")).first()
    expected = (observed(obs, "rows"), observed(obs, "checksum"))
    if not reconcile(expected, (got["rows"], got["checksum"] or 0)):
        spark.sql(f"DROP TABLE {beside}")
        raise ValueError(f"load of {table} differs from its input: rows and checksum {expected} != {(got['rows'], got['checksum'])}")
    swap_table(spark, beside, table)
    return got["rows"]


def swap_table(spark: SparkSession, new: str, table: str) -> None:
    """Give ``new`` the name ``table``; the table of that name goes once the new
    one stands, and comes back if that fails."""
    old = f"{table}__old_{uuid.uuid4().hex[:8]}" if spark.catalog.tableExists(table) else None
    if old:
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    except Exception:
        if old:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        raise
    if old:
        spark.sql(f"DROP TABLE {old}")


# ------------------------------------------------------------------ S8/S9 -

def register_views(stage: DataFrame) -> dict[str, DataFrame]:
    """The staging view and the eight mart views as temp views."""
    from ..operators import marts as M

    view = staging_view(stage)
    views = {
        "stg_offres_view": view,
        "mart_role_demand": M.role_demand(view),
        "mart_skill_demand": M.skill_demand(view),
        "mart_role_skill_demand": M.role_skill_demand(view),
        "mart_skill_demand_by_role": M.skill_demand_by_role(view),
        "mart_role_demand_by_seniority": M.role_demand_by_seniority(view),
        "mart_role_demand_by_domain_focus": M.role_demand_by_domain_focus(view),
        "mart_skill_trends_by_month": M.skill_trends_by_month(view),
        "mart_role_trends_by_month": M.role_trends_by_month(view),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views


def register_lake_view(spark: SparkSession, path: str, name: str = "offers_lake") -> DataFrame:
    """S7 as SQL: every snapshot of the staged table under one view name, so
    lake queries run as written (``SELECT ... FROM offers_lake CROSS JOIN
    UNNEST``-style queries become ``LATERAL VIEW explode``)."""
    df = lake_table(spark, path)
    df.createOrReplaceTempView(name)
    return df


def load_rules(spark: SparkSession) -> dict[str, DataFrame]:
    """The rule tables as small DataFrames."""
    return R.rule_tables(spark)
