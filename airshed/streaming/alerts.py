"""T3 / T4: sliding-window failure counts and duplicate suppression on streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.functions import labels as L

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
])


def runs_stream(spark: SparkSession, events_path: str, pipeline_name: str | Column = "main", max_files_per_trigger: int | None = None) -> DataFrame:
    """Run log as a stream from event files (an ``error`` event is a failed run).

    The watermark needs a TIMESTAMP column, so the TIMESTAMP_NTZ event time is
    cast (session time zone UTC). ``pipeline_name`` may be an expression over the event."""
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    ev = reader.parquet(events_path)
    return ev.select(
        (pipeline_name if isinstance(pipeline_name, Column) else F.lit(pipeline_name)).alias("pipeline_name"),
        F.when(F.col("event_type") == "error", L.RUN_FAILED).otherwise(L.RUN_SUCCEEDED).alias("status"),
        F.col("ts").cast("timestamp").alias("time_generated"),
        "event_id",
    )


def failure_alerts(runs: DataFrame, length: str = "5 minutes", slide: str = "1 minute",
                   watermark: str = "10 minutes") -> DataFrame:
    """Failed runs per sliding window; every emitted row is an alert (count > 0).

    The watermark bounds the window state: a window is finalised (append mode)
    once the watermark passes its end, and later rows for it are dropped.
    """
    failed = runs.filter(F.col("status") == L.RUN_FAILED).withWatermark("time_generated", watermark)
    s = failed.groupBy(F.window("time_generated", length, slide).alias("w")).agg(
        F.count(F.lit(1)).alias("failed_runs"))
    return s.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "failed_runs")


def alert_episodes(runs: DataFrame, quiet: str = "5 minutes", watermark: str = "10 minutes") -> DataFrame:
    """Life of the alerts of each pipeline: one opens at a failure, goes on while the next comes within ``quiet`` of the last, and closes after that.

    A row (pipeline_name, opened_at, last_failure, closed_at, failed_runs) is emitted once, when the watermark passes ``closed_at``;
    failures may come in any order before that, in any micro-batch, and may join two episodes that were open. A failure exactly ``quiet`` after
    the last still belongs to the episode. State: one session for each open episode. A busy pipeline ships few rows where
    ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` is on: its sessions are then merged before the shuffle too.
    """
    failed = runs.filter(F.col("status") == L.RUN_FAILED).withWatermark("time_generated", watermark)
    s = failed.groupBy("pipeline_name", F.session_window("time_generated", quiet).alias("w")).agg(
        F.max("time_generated").alias("last_failure"), F.count(F.lit(1)).alias("failed_runs"))
    return s.select("pipeline_name", F.col("w.start").alias("opened_at"), "last_failure", F.col("w.end").alias("closed_at"), "failed_runs")


def drop_duplicate_runs(runs: DataFrame, keys=("event_id",), watermark: str = "10 minutes",
                        time_col: str = "time_generated") -> DataFrame:
    """Suppress repeated deliveries of the same record within the watermark delay
    (state per key is dropped once the watermark passes it)."""
    return runs.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark(list(keys))
