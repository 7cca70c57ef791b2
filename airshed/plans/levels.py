"""Pollution levels and trends (2.1 - 2.4) and the quick-start / alert queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed.functions import labels as L
from airshed.functions.bands import DEFAULT_LIMITS, Limits, health_status, over_moderate, over_unhealthy
from airshed.functions.calendar import as_of_col, last_days
from airshed.functions.numeric import r2, safe_div
from airshed.plans.common import latest_date, window_days

SERIES = ("location", "pollutant_type")


def current_levels(gold: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Rows of the latest day in Gold, rounded, with their health band."""
    g = gold.filter(F.col("date") == latest_date(gold))
    return g.select(
        "location", "date", "pollutant_type",
        r2("avg_value").alias("avg_level"),
        r2("min_value").alias("min_level"),
        r2("max_value").alias("max_level"),
        F.col("record_count").alias("measurement_count"),
        health_status(limits).alias("health_status"),
    )


def daily_trend(gold: DataFrame, as_of=None, days: int = 7, warmup_days: int = 0) -> DataFrame:
    """Last ``days`` days: level, previous day's level, % change and direction.

    The day window is applied first, so the first day of each series has no
    previous value (STABLE), as in the reference. ``warmup_days`` reads that
    many extra days before the window so the first days get their real
    previous value; only the window's rows are returned. ``zone`` breaks ties
    when a location reports the same date under two zones.
    """
    g = window_days(gold, as_of, days + warmup_days)
    w = Window.partitionBy(*SERIES).orderBy("date", "zone")
    prev = F.lag("avg_value").over(w)
    v = F.col("avg_value")
    out = g.select(
        "location", "pollutant_type", "date",
        r2(v).alias("avg_level"),
        F.lag(r2(v)).over(w).alias("previous_day_avg"),
        r2(safe_div(v - prev, prev) * 100).alias("percent_change"),
        F.when(v > prev, L.WORSENING).when(v < prev, L.IMPROVING).otherwise(L.STABLE).alias("trend"),
    )
    return out.filter(last_days("date", as_of, days)) if warmup_days else out


def top_exceedances(gold: DataFrame, limits: Limits = DEFAULT_LIMITS, n: int = 20) -> DataFrame:
    """The ``n`` latest rows above their pollutant's moderate limit, highest peak
    first within a day. Distributed top-k: each task keeps its own best ``n``."""
    g = gold.filter(over_moderate(limits))
    top = g.orderBy(F.desc("date"), F.desc("max_value"), "location", "pollutant_type", "zone").limit(n)
    return top.select(
        "date", "location", "pollutant_type",
        r2("max_value").alias("max_level"),
        r2("avg_value").alias("avg_level"),
        "record_count",
        health_status(limits).alias("health_rating"),
    )


def monthly_levels(gold: DataFrame) -> DataFrame:
    """Per year, month and pollutant: locations, mean, min, max and stdev."""
    return gold.groupBy(
        F.year("date").alias("year"), F.month("date").alias("month"), "pollutant_type"
    ).agg(
        F.count_distinct("location").alias("locations_monitored"),
        r2(F.avg("avg_value")).alias("avg_monthly_level"),
        r2(F.min("min_value")).alias("monthly_min"),
        r2(F.max("max_value")).alias("monthly_max"),
        r2(F.stddev_samp("avg_value")).alias("volatility"),
    )


def latest_status(gold: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Latest day: one flat limit, UNHEALTHY above it, else HEALTHY."""
    g = gold.filter(F.col("date") == latest_date(gold))
    return g.select(
        "location", "pollutant_type", "avg_value",
        F.when(F.col("avg_value") > limits.flat, L.UNHEALTHY).otherwise(L.HEALTHY).alias("status"),
    )


def recent_levels(gold: DataFrame, as_of=None, days: int = 7) -> DataFrame:
    """Plain listing of the last ``days`` days."""
    return window_days(gold, as_of, days).select("location", "pollutant_type", "date", "avg_value")


def health_alerts(gold: DataFrame, as_of=None, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Rows of the report day above their pollutant's unhealthy limit."""
    g = gold.filter((F.col("date") == as_of_col(as_of)) & over_unhealthy(limits))
    return g.select("location", "pollutant_type", "avg_value", F.lit(L.ALERT).alias("status"))
