"""Continuous staging of the landing folder with Structured Streaming.

New raw files (``<landing>/dt=YYYY-MM-DD/*.jsonl``) are picked up by a file
stream. Keep-first dedupe needs the whole snapshot, so a micro-batch does not
stage its own rows: it only tells which snapshots received files, and each of
those snapshots is re-staged from the landing folder by the batch plan, which
replaces the snapshot's folder. All new files make one micro-batch unless a
limit is given, so a trigger stages a day once, however many files it got.
Re-running a micro-batch after a failure rewrites the same folders, so the
sink is idempotent and the checkpointed stream gives exactly-once results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans import weekly as W
from ..session import checkpoint_dir
from ..sources import offers as S

STREAM_SCHEMA = T.StructType(S.RAW_SCHEMA.fields + [T.StructField("dt", T.DateType())])


def restage_snapshots(spark: SparkSession, landing: str, stage_path: str, batch: DataFrame) -> list:
    """Re-stage every snapshot that has rows in ``batch``; returns the dates."""
    days = [r.dt for r in batch.select("dt").where(F.col("dt").isNotNull()).distinct().collect()]
    for dt in sorted(days):
        S.write_stage(W.stage(S.read_raw_offers(spark, landing, dt)), stage_path, dt)
    return days


def start(spark: SparkSession, landing: str, stage_path: str, checkpoint: str | None = None,
          available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; ``available_now`` drains what is there and stops. The
    offsets are kept in ``checkpoint``, or in the shared checkpoint folder."""
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/landing-stage"
    reader = spark.readStream.schema(STREAM_SCHEMA).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.json(landing)
    writer = (
        src.select("dt").writeStream
        .foreachBatch(lambda batch, _epoch: restage_snapshots(spark, landing, stage_path, batch))
        .option("checkpointLocation", ckpt)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
