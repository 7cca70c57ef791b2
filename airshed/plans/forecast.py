"""Forecasting-prep reports (7.1, 7.2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed.functions import labels as L
from airshed.functions.numeric import r2, r4, safe_div
from airshed.plans.common import count_rows, window_days


def volatility(gold: DataFrame, as_of=None, days: int = 90) -> DataFrame:
    """Per series: mean, stdev, coefficient of variation and its level
    (< 0.15 STABLE, < 0.30 MODERATE, else - including undefined - VOLATILE)."""
    s = window_days(gold, as_of, days).groupBy("location", "pollutant_type").agg(
        F.avg("avg_value").alias("_mean"),
        F.stddev_samp("avg_value").alias("_sd"),
        F.count_distinct("date").alias("data_points"),
    )
    cv = safe_div(F.col("_sd"), F.col("_mean"))
    return s.select(
        "location", "pollutant_type",
        r2("_mean").alias("mean_value"),
        r2("_sd").alias("std_dev"),
        r2(cv).alias("coefficient_of_variation"),
        F.when(cv < 0.15, L.STABLE).when(cv < 0.30, L.MODERATE).otherwise(L.VOLATILE)
         .alias("volatility_level"),
        "data_points",
    )


def trend_slope(gold: DataFrame, as_of=None, days: int = 90) -> DataFrame:
    """Least-squares slope of the daily mean against the day index (1, 2, ...)
    per series; > 0.01 INCREASING, < -0.01 DECREASING, else STABLE.

    The slope is ``regr_slope`` (exact least squares; the written formula
    averages an integer index, which truncates in T-SQL). A one-row series has
    no slope and is STABLE.
    """
    w = Window.partitionBy("location", "pollutant_type").orderBy("date", "zone")
    ranked = window_days(gold, as_of, days).select(
        "location", "pollutant_type", "avg_value",
        F.row_number().over(w).cast("double").alias("_day"))
    s = ranked.groupBy("location", "pollutant_type").agg(
        count_rows().alias("data_points"),
        r2(F.avg("avg_value")).alias("avg_value"),
        F.regr_slope("avg_value", "_day").alias("_slope"),
    )
    slope = F.col("_slope")
    return s.select(
        "location", "pollutant_type", "data_points", "avg_value",
        r4(slope).alias("trend_slope"),
        F.when(slope > 0.01, L.INCREASING).when(slope < -0.01, L.DECREASING)
         .otherwise(L.STABLE).alias("trend_direction"),
    )
