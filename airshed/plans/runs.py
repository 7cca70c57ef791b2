"""Run-history monitoring: failure rate, circuit breaker, failure windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.functions import labels as L
from airshed.functions.numeric import percent
from airshed.plans.common import count_rows


def latest_run_time(runs: DataFrame) -> Column:
    return runs.agg(F.max("time_generated")).scalar()


def _now(runs: DataFrame, now) -> Column:
    if now is None:
        return latest_run_time(runs)
    return now if isinstance(now, Column) else F.lit(now)


def run_failure_rate(runs: DataFrame, pipeline: str = "main", now=None,
                     alert_percent: float = L.FAILURE_RATE_ALERT_PERCENT) -> DataFrame:
    """Runs, failed runs and failure % of one pipeline in the hour before
    ``now`` (exclusive), kept only when the rate is above ``alert_percent``."""
    cutoff = _now(runs, now) - F.expr("INTERVAL 1 HOUR")
    r = runs.filter((F.col("pipeline_name") == pipeline) & (F.col("time_generated") > cutoff))
    s = r.agg(count_rows().alias("total_runs"),
              F.count_if(F.col("status") == L.RUN_FAILED).alias("failed_runs"))
    s = s.withColumn("failure_rate", percent(F.col("failed_runs"), F.col("total_runs")))
    return s.filter(F.col("failure_rate") > alert_percent)


def circuit_breaker(runs: DataFrame, pipeline: str = "main", now=None,
                    max_failures: int = L.CIRCUIT_BREAKER_MAX_FAILURES) -> DataFrame:
    """Failed runs of one pipeline since one hour before ``now`` (inclusive),
    and whether the next run may proceed (fewer than ``max_failures``)."""
    cutoff = _now(runs, now) - F.expr("INTERVAL 1 HOUR")
    r = runs.filter((F.col("pipeline_name") == pipeline) & (F.col("status") == L.RUN_FAILED)
                    & (F.col("time_generated") >= cutoff))
    s = r.agg(count_rows().alias("failure_count"))
    return s.select("failure_count", (F.col("failure_count") < max_failures).alias("should_proceed"))


def failure_windows(runs: DataFrame, length: str = "5 minutes", slide: str = "1 minute",
                    pipeline: str | None = None) -> DataFrame:
    """Failed runs per sliding window (batch twin of the streaming alert).

    Each failure falls into length / slide windows; windows without failures
    are absent, so every row is an alert (count > 0).
    """
    r = runs.filter(F.col("status") == L.RUN_FAILED)
    if pipeline is not None:
        r = r.filter(F.col("pipeline_name") == pipeline)
    s = r.groupBy(F.window("time_generated", length, slide).alias("w")).agg(
        count_rows().alias("failed_runs"))
    return s.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "failed_runs")
