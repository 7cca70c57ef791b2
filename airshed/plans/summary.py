"""Executive summary (8.1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.functions import labels as L
from airshed.functions.bands import DEFAULT_LIMITS, Limits
from airshed.functions.numeric import percent, r2
from airshed.plans.common import count_rows, window_days


def executive_summary(gold: DataFrame, as_of=None, limits: Limits = DEFAULT_LIMITS,
                      days: int = 30) -> DataFrame:
    """Three metric rows over the last ``days`` days.

    - Overall Health: share of rows at or under ``limits.summary_good``; GOOD above 85 %.
    - Highest Risk Location: the location with the highest mean, and that mean.
    - Days Over Limit: distinct dates with any row above the flat limit.

    One conditional aggregate gives the first and third line; the worst
    location is a distributed top-1 over the per-location means, read as a
    scalar subquery. The one-row aggregate is turned into three rows with
    ``inline``, so the answer has three rows even on an empty window.
    """
    g = window_days(gold, as_of, days)
    worst = (g.groupBy("location").agg(F.avg("avg_value").alias("_m"))
             .orderBy(F.desc("_m"), "location").limit(1)
             .select(F.struct(F.col("location").alias("loc"), r2("_m").alias("mean"))).scalar())
    s = g.agg(
        F.count_if(F.col("avg_value") <= limits.summary_good).alias("_ok"),
        count_rows().alias("_n"),
        F.count_distinct(F.when(F.col("avg_value") > limits.flat, F.col("date"))).alias("_days"),
    )
    pct = r2(percent(F.col("_ok"), F.col("_n")))

    def row(metric, status, percentage):
        return F.struct(F.lit(metric).alias("metric"), status.cast("string").alias("status"),
                        percentage.cast("double").alias("percentage"))

    return s.select(F.inline(F.array(
        row(L.METRIC_OVERALL_HEALTH, F.when(pct > 85, L.GOOD).otherwise(L.NEEDS_ATTENTION), pct),
        row(L.METRIC_HIGHEST_RISK, worst.getField("loc"), worst.getField("mean")),
        row(L.METRIC_DAYS_OVER_LIMIT, F.col("_days"), F.lit(None)),
    )))
