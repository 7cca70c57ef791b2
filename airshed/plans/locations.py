"""Location-based reports (3.1 - 3.3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed.functions import labels as L
from airshed.functions.bands import DEFAULT_LIMITS, Limits, location_grade
from airshed.functions.numeric import r2
from airshed.operators.quantiles import exact_percentiles
from airshed.plans.common import window_days


def location_ranking(gold: DataFrame, as_of=None, k: int = 5, days: int = 30) -> DataFrame:
    """Top ``k`` cleanest and dirtiest (location, zone) per pollutant over the
    last ``days`` days, ranked on the unrounded mean.

    Each direction is its own ``row_number() <= k`` filter, which Spark plans as
    a WindowGroupLimit before and after the shuffle: a pollutant holding most
    rows still ships only ``k`` rows per task.
    """
    stats = window_days(gold, as_of, days).groupBy("location", "zone", "pollutant_type").agg(
        F.avg("avg_value").alias("_mean"),
        r2(F.max("max_value")).alias("max_level"),
        F.count_distinct("date").alias("data_days"),
    )

    def ranked(label: str, order) -> DataFrame:
        w = Window.partitionBy("pollutant_type").orderBy(order, "location", "zone")
        return (stats.withColumn("rank", F.row_number().over(w))
                .filter(F.col("rank") <= k)
                .select(F.lit(label).alias("ranking"), "location", "zone", "pollutant_type",
                        r2("_mean").alias("avg_level"), "max_level", "data_days",
                        F.col("rank").cast("bigint").alias("rank")))

    return ranked(L.CLEANEST, F.asc("_mean")).unionByName(ranked(L.DIRTIEST, F.desc("_mean")))


def zone_comparison(gold: DataFrame, as_of=None, days: int = 90, approx: bool = False) -> DataFrame:
    """Per zone and pollutant: locations, days, mean, min, max, stdev, median.

    The median is exact and never gathers a zone in one task, however large its
    share of all rows (``operators.quantiles.exact_percentiles``);
    ``approx=True`` takes a bounded sketch instead.
    """
    keys = ["zone", "pollutant_type"]
    g = window_days(gold, as_of, days)
    aggs = [
        F.count_distinct("location").alias("locations_in_zone"),
        F.count_distinct("date").alias("days_of_data"),
        r2(F.avg("avg_value")).alias("avg_level"),
        r2(F.min("min_value")).alias("min_level"),
        r2(F.max("max_value")).alias("max_level"),
        r2(F.stddev_samp("avg_value")).alias("volatility"),
    ]
    if approx:
        return g.groupBy(*keys).agg(
            *aggs, r2(F.percentile_approx("avg_value", 0.5, 10000)).alias("median"))
    med = exact_percentiles(g, keys, "avg_value", [0.5], out="_p")
    return (g.groupBy(*keys).agg(*aggs)
            .join(med.select(*keys, r2(F.col("_p")[0]).alias("median")), keys, "left"))


def location_scorecard(gold: DataFrame, as_of=None, limits: Limits = DEFAULT_LIMITS,
                       days: int = 30) -> DataFrame:
    """Per location and zone: mean of each banded pollutant (pivot by
    conditional average), overall mean, days, and a grade on the rounded means."""
    aggs = [r2(F.avg(F.when(F.col("pollutant_type") == b.pollutant, F.col("avg_value"))))
            .alias(f"{b.slug}_avg") for b in limits.bands]
    s = window_days(gold, as_of, days).groupBy("location", "zone").agg(
        *aggs,
        r2(F.avg("avg_value")).alias("overall_avg"),
        F.count_distinct("date").alias("data_points"),
    )
    means = {b.pollutant: F.col(f"{b.slug}_avg") for b in limits.bands}
    return s.select("location", "zone", *[f"{b.slug}_avg" for b in limits.bands],
                    "overall_avg", "data_points",
                    location_grade(means, limits).alias("air_quality_grade"))
