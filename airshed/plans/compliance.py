"""Compliance and regulatory reports (6.1, 6.2, 8.2) and the quarter audit."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.functions import labels as L
from airshed.functions.bands import DEFAULT_LIMITS, Limits, in_moderate_band, over_unhealthy
from airshed.functions.calendar import as_of_col
from airshed.functions.numeric import percent, r2
from airshed.plans.common import count_few, count_rows, window_days


def days_over_limit(gold: DataFrame, as_of=None, limits: Limits = DEFAULT_LIMITS,
                    days: int = 90) -> DataFrame:
    """Per location, zone, pollutant: rows above the unhealthy limit, rows in
    the moderate band (inclusive ends), days tracked, exceedance % of days."""
    s = window_days(gold, as_of, days).groupBy("location", "zone", "pollutant_type").agg(
        F.count_if(over_unhealthy(limits)).alias("unhealthy_days"),
        F.count_if(in_moderate_band(limits)).alias("moderate_days"),
        F.count_distinct("date").alias("total_days_tracked"),
    )
    return s.select("location", "zone", "pollutant_type", "unhealthy_days", "moderate_days",
                    "total_days_tracked",
                    r2(percent(F.col("unhealthy_days"), F.col("total_days_tracked")))
                    .alias("exceedance_percent"))


def compliance_status(gold: DataFrame, as_of=None, limits: Limits = DEFAULT_LIMITS,
                      days: int = 90) -> DataFrame:
    """One row: report date, locations, days, share of rows at or under the
    flat limit, unhealthy rows, and COMPLIANT / MOSTLY COMPLIANT / NON-COMPLIANT."""
    s = window_days(gold, as_of, days).agg(
        F.count_distinct("location").alias("locations_monitored"),
        count_few("date").alias("data_days"),
        F.count_if(F.col("avg_value") <= limits.flat).alias("_ok"),
        count_rows().alias("_n"),
        F.count_if(over_unhealthy(limits)).alias("violation_days"),
    )
    rate = r2(percent(F.col("_ok"), F.col("_n")))
    return s.select(
        as_of_col(as_of).alias("report_date"),
        "locations_monitored", "data_days",
        rate.alias("compliance_rate"),
        "violation_days",
        F.when(rate >= 95, L.COMPLIANT).when(rate >= 85, L.MOSTLY_COMPLIANT)
         .otherwise(L.NON_COMPLIANT).alias("compliance_status"),
    )


def _month_stats(gold: DataFrame, limits: Limits) -> DataFrame:
    return gold.groupBy(F.trunc("date", "month").alias("month_start")).agg(
        F.count_distinct("location").alias("locations"),
        count_few("date").alias("data_days"),
        r2(F.avg("avg_value")).alias("avg_level"),
        F.max("max_value").alias("peak_level"),
        F.count_if(F.col("avg_value") > limits.flat).alias("exceedance_days"),
        count_rows().alias("_n"),
        count_few("pollutant_type").alias("pollutants"),
    )


def monthly_compliance(gold: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Per month: locations, days, mean, peak (unrounded), rows above the flat
    limit and their share, pollutants."""
    s = _month_stats(gold, limits)
    return s.select(
        F.col("month_start").alias("report_month"),
        F.col("locations").alias("monitoring_locations"),
        F.col("data_days").alias("days_of_data"),
        F.col("avg_level").alias("avg_pollution_level"),
        "peak_level", "exceedance_days",
        r2(percent(F.col("exceedance_days"), F.col("_n"))).alias("exceedance_rate"),
        F.col("pollutants").alias("pollutants_tracked"),
    )


def quarter_bounds(as_of) -> tuple:
    """[first day of the quarter of ``as_of``, first day of the next quarter)."""
    start = F.trunc(as_of_col(as_of), "quarter")
    return start, F.add_months(start, 3)


def quarter_audit(gold: DataFrame, start=None, end=None, as_of=None,
                  limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Monthly compliance restricted to ``start <= date < end`` (a date range,
    which the scan can prune, rather than YEAR()/MONTH() predicates). Without
    bounds: the calendar quarter of ``as_of``."""
    if start is None or end is None:
        start, end = quarter_bounds(as_of)
    else:
        start, end = as_of_col(start), as_of_col(end)
    g = gold.filter((F.col("date") >= start) & (F.col("date") < end))
    s = _month_stats(g, limits)
    return s.select(
        F.col("month_start").alias("month"),
        "locations", "data_days", "exceedance_days",
        r2(percent(F.col("exceedance_days"), F.col("_n"))).alias("exceedance_rate"),
    )
