"""Statistical reports (4.1, 4.2) and the sensor-failure screen."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed.functions import labels as L
from airshed.functions.calendar import last_days
from airshed.functions.numeric import r2, r4, safe_div
from airshed.plans.common import window_days

PERCENTILES = (("p10", 0.10), ("p25", 0.25), ("median", 0.50), ("p75", 0.75), ("p90", 0.90))


def rolling_frame(partition, rows: int = 30, range_days: bool = False):
    """The last ``rows`` rows up to the current one (the reference's frame).

    ``range_days=True`` uses a calendar frame of ``rows`` days instead, so a
    gap does not stretch the window (ordered on the day number).
    """
    if range_days:
        return (Window.partitionBy(*partition)
                .orderBy(F.unix_date(F.col("date"))).rangeBetween(-(rows - 1), 0))
    return Window.partitionBy(*partition).orderBy("date", "zone").rowsBetween(-(rows - 1), 0)


def anomalies(gold: DataFrame, as_of=None, days: int = 60, rows: int = 30,
              range_days: bool = False, warmup_days: int = 0) -> DataFrame:
    """Days whose mean is more than 1.5 rolling standard deviations away from
    the rolling mean of the series; > 2.5 ANOMALY, > 2 UNUSUAL, else NORMAL.

    Windows partition by series, so a task holds one series' days (bounded by
    the calendar, however many raw rows fed them). The frame starts cold at
    the window start, as in the reference; ``warmup_days`` feeds that many
    earlier days into the frames and returns only the window's rows.
    """
    w = rolling_frame(("location", "pollutant_type"), rows, range_days)
    s = window_days(gold, as_of, days + warmup_days).select(
        "location", "pollutant_type", "date", "avg_value",
        F.avg("avg_value").over(w).alias("_mean"),
        F.stddev_samp("avg_value").over(w).alias("_sd"),
    )
    if warmup_days:
        s = s.filter(last_days("date", as_of, days))
    z = safe_div(F.abs(F.col("avg_value") - F.col("_mean")), F.col("_sd"))
    return s.filter(F.col("_sd").isNotNull() & (z > 1.5)).select(
        "date", "location", "pollutant_type",
        r2("avg_value").alias("observed_value"),
        r2("_mean").alias("expected_30row_avg"),
        r2("_sd").alias("volatility"),
        r2(z).alias("standard_deviations"),
        F.when(z > 2.5, L.ANOMALY).when(z > 2, L.UNUSUAL).otherwise(L.NORMAL).alias("anomaly_status"),
    )


def percentile_profile(gold: DataFrame, as_of=None, days: int = 90, collapse: bool = True,
                       approx: bool = False) -> DataFrame:
    """P10, P25, median, P75, P90 and mean of the daily means per series.

    ``collapse=True``: one row per series over all its rows (one exact
    percentile aggregate computing all five fractions at once).
    ``collapse=False`` follows the literal query, which groups by the value as
    well: statistics over the *distinct* values, one row per distinct value.
    """
    g = window_days(gold, as_of, days)
    fracs = [f for _, f in PERCENTILES]
    if collapse:
        pct = (F.percentile_approx("avg_value", fracs, 10000) if approx
               else F.percentile("avg_value", fracs))
        s = g.groupBy("location", "pollutant_type").agg(
            pct.alias("_p"), F.avg("avg_value").alias("_mean"))
    else:
        w = Window.partitionBy("location", "pollutant_type")
        s = g.select("location", "pollutant_type", "avg_value").distinct().select(
            "location", "pollutant_type",
            F.percentile("avg_value", fracs).over(w).alias("_p"),
            F.avg("avg_value").over(w).alias("_mean"))
    return s.select("location", "pollutant_type",
                    *[r2(F.col("_p")[i]).alias(name) for i, (name, _) in enumerate(PERCENTILES)],
                    r2("_mean").alias("mean"))


def sensor_failure_candidates(gold: DataFrame, pollutant: str = "PM2.5", n: int = 5,
                              rows: int = 30) -> DataFrame:
    """The ``n`` highest daily means of one pollutant with their rolling mean per
    location (30 rows); above 3x the rolling mean is a likely equipment failure,
    above 2x worth investigating. The rolling mean is rounded to 4 places."""
    one = gold.filter(F.col("pollutant_type") == pollutant).select("location", "date", "zone", "avg_value")
    # the n rows are chosen by their own value: n rows per task are merged, and only
    # the history of their locations enters the window
    order = (F.desc("avg_value"), F.desc("date"), F.asc("location"), F.asc("zone"))
    chosen = one.orderBy(*order).limit(n).select(F.col("location").alias("_location")).distinct()
    w = Window.partitionBy("location").orderBy("date", "zone").rowsBetween(-(rows - 1), 0)
    top = (one.join(chosen, F.col("location").eqNullSafe(F.col("_location")), "left_semi")
           .withColumn("_roll", F.avg("avg_value").over(w)).orderBy(*order).limit(n))
    v, m = F.col("avg_value"), F.col("_roll")
    return top.select(
        "location", "date", "avg_value",
        r4(m).alias("rolling_30row_avg"),
        F.when(v > m * 3, L.LIKELY_EQUIPMENT_FAILURE).when(v > m * 2, L.INVESTIGATE)
         .otherwise(L.NORMAL).alias("alert"),
    )


def rolling_stats(gold: DataFrame, rows: int = 30, range_days: bool = False) -> DataFrame:
    """Every Gold row with the rolling mean and sample stdev of its series
    (last ``rows`` rows), over the whole table, rounded to 4 places."""
    w = rolling_frame(("location", "pollutant_type"), rows, range_days)
    return gold.select(
        "date", "location", "pollutant_type", "zone", "avg_value",
        r4(F.avg("avg_value").over(w)).alias("rolling_avg"),
        r4(F.stddev_samp("avg_value").over(w)).alias("rolling_stddev"),
    )
