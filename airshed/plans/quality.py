"""Data quality and completeness reports (1.1 - 1.3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed.functions import labels as L
from airshed.functions.calendar import as_of_col
from airshed.functions.numeric import percent, r2, r4, safe_div
from airshed.plans.common import count_few, count_rows, window_days


def quality_summary(gold: DataFrame, as_of=None, days: int = 90, approx: bool = False) -> DataFrame:
    """One row: distinct days / locations / pollutants, first and last date,
    covered span, rows, and rows / (days x locations x pollutants).

    Days of the window and pollutants are few and counted as sets; locations are
    an exact distinct count, or with ``approx=True`` a HyperLogLog sketch (fixed memory, ~1% error).
    """
    g = window_days(gold, as_of, days)
    distinct = F.approx_count_distinct if approx else F.count_distinct
    s = g.agg(
        count_few("date").alias("unique_days"),
        distinct("location").alias("unique_locations"),
        count_few("pollutant_type").alias("pollutant_types"),
        F.min("date").alias("earliest_date"),
        F.max("date").alias("latest_date"),
        count_rows().alias("total_records"),
    )
    expected = F.col("unique_days") * F.col("unique_locations") * F.col("pollutant_types")
    return s.select(
        "unique_days", "unique_locations", "pollutant_types", "earliest_date", "latest_date",
        (F.datediff("latest_date", "earliest_date") + 1).cast("bigint").alias("coverage_days"),
        "total_records",
        r4(safe_div(F.col("total_records"), expected)).alias("completion_rate"),
    )


def location_coverage(gold: DataFrame) -> DataFrame:
    """Per location: days with data, pollutants, first/last date and coverage %."""
    s = gold.groupBy("location").agg(
        F.count_distinct("date").alias("days_of_data"),
        count_few("pollutant_type").alias("available_pollutants"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )
    potential = (F.datediff("last_date", "first_date") + 1).cast("bigint")
    return s.select(
        "location", "days_of_data", "available_pollutants", "first_date", "last_date",
        potential.alias("potential_days"),
        r2(percent(F.col("days_of_data"), potential)).alias("coverage_percent"),
    )


def _gaps(gold: DataFrame, bounds: tuple | None) -> DataFrame:
    """location, pollutant_type, gap_start, gap_end: the holes of each series between
    its observed dates and up to the first and last date of all Gold."""
    lo, hi = (F.lit(b).cast("date") for b in bounds) if bounds else (gold.agg(f("date")).scalar() for f in (F.min, F.max))
    # one shuffle by series serves both the distinct and the window
    days = (gold.select("date", "location", "pollutant_type")
            .repartition("location", "pollutant_type").distinct())
    w = Window.partitionBy("location", "pollutant_type").orderBy("date")
    before = F.struct(lo.alias("gap_start"), F.date_sub("date", 1).alias("gap_end"))
    after = F.struct(F.date_add("date", 1).alias("gap_start"), F.coalesce(F.date_sub(F.lead("date").over(w), 1), hi).alias("gap_end"))
    first = F.lag("date").over(w).isNull()
    around = days.select("location", "pollutant_type", F.when(first, F.array(before, after)).otherwise(F.array(after)).alias("gaps"))
    return around.select("location", "pollutant_type", F.inline("gaps")).filter("gap_start <= gap_end")


def missing_series_runs(gold: DataFrame, bounds: tuple | None = None) -> DataFrame:
    """Runs of days without data per (location, pollutant): one row per hole,
    however long it is, so the answer grows with the holes and not with their days."""
    return _gaps(gold, bounds).withColumn("days", (F.datediff("gap_end", "gap_start") + 1).cast("bigint"))


def missing_series_days(gold: DataFrame, as_of=None, bounds: tuple | None = None) -> DataFrame:
    """(date, location, pollutant) combinations absent from Gold, where the
    dates are those observed anywhere and the series those observed anywhere.

    No date x series product is built: the holes of each series (a window per
    series, bounded by its number of days) are expanded into calendar days, and an
    equi-join with the distinct observed dates keeps the days that count. Work is
    proportional to the answer. ``bounds`` = (first, last) observed date, else a scalar subquery.
    """
    dates = gold.select("date").distinct()
    missing = _gaps(gold, bounds).select(
        "location", "pollutant_type", F.explode(F.sequence("gap_start", "gap_end")).alias("date")).join(dates, "date")
    return missing.select(
        "date", "location", "pollutant_type",
        F.lit(L.MISSING).alias("data_status"),
        F.datediff(as_of_col(as_of), F.col("date")).cast("bigint").alias("days_ago"),
    )
