"""Time-based reports (5.1 - 5.3) and the weekday policy comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed.functions.calendar import last_months, policy_day_label, season, weekday_name, weekend_flag
from airshed.functions.numeric import r2, safe_div
from airshed.plans.common import count_rows, window_days


def weekday_pattern(gold: DataFrame, as_of=None, days: int = 90) -> DataFrame:
    """Per weekday and pollutant: name, weekend flag, locations, mean, peak, rows."""
    s = window_days(gold, as_of, days).groupBy(
        F.dayofweek("date").alias("_dow"), "pollutant_type"
    ).agg(
        F.count_distinct("location").alias("locations_monitored"),
        r2(F.avg("avg_value")).alias("avg_level"),
        r2(F.max("max_value")).alias("peak_level"),
        count_rows().alias("observation_count"),
    )
    dow = F.col("_dow")
    return s.select(weekday_name(dow).alias("day_of_week"), weekend_flag(dow).alias("is_weekend"),
                    "pollutant_type", "locations_monitored", "avg_level", "peak_level",
                    "observation_count")


def seasonal_levels(gold: DataFrame) -> DataFrame:
    """Per year, month and pollutant with a season label (Dec-Feb is Winter of
    the same calendar year)."""
    s = gold.groupBy(
        F.year("date").alias("year"), F.month("date").alias("month"), "pollutant_type"
    ).agg(
        F.count_distinct("location").alias("locations_monitored"),
        r2(F.avg("avg_value")).alias("avg_level"),
        r2(F.stddev_samp("avg_value")).alias("volatility"),
        count_rows().alias("measurement_days"),
    )
    return s.select(season(F.col("month")).alias("season"), "year", "month", "pollutant_type",
                    "locations_monitored", "avg_level", "volatility", "measurement_days")


def month_over_month(gold: DataFrame) -> DataFrame:
    """Monthly mean per pollutant (rounded), previous month's, absolute and % change.

    The window runs over the monthly aggregate (months x pollutants rows), not
    over Gold.
    """
    monthly = gold.groupBy(
        F.year("date").alias("year"), F.month("date").alias("month"), "pollutant_type"
    ).agg(r2(F.avg("avg_value")).alias("avg_level"))
    w = Window.partitionBy("pollutant_type").orderBy("year", "month")
    prev = F.lag("avg_level").over(w)
    cur = F.col("avg_level")
    return monthly.select(
        "year", "month",
        F.make_date("year", "month", F.lit(1)).alias("month_start"),
        "pollutant_type", "avg_level",
        prev.alias("previous_month_avg"),
        r2(cur - prev).alias("absolute_change"),
        r2(safe_div(cur - prev, prev) * 100).alias("percent_change"),
    )


def policy_weekday_compare(gold: DataFrame, as_of=None, pollutant: str = "NO2",
                           months: int = 6, literal: bool = False) -> DataFrame:
    """Mean of one pollutant per weekday over the last ``months`` months.

    The default names every weekday; ``literal=True`` uses the guide's labels
    (a marked Tuesday, no label for Saturday and Sunday).
    """
    g = gold.filter((F.col("pollutant_type") == pollutant) & last_months("date", as_of, months))
    s = g.groupBy(F.dayofweek("date").alias("_dow")).agg(r2(F.avg("avg_value")).alias("avg_level"))
    dow = F.col("_dow")
    label = policy_day_label(dow) if literal else weekday_name(dow)
    return s.select(label.alias("day"), "avg_level")
