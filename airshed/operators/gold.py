"""Silver -> Gold: the daily aggregate per date, location, pollutant and zone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.schema import GOLD_KEYS


def daily_gold(silver: DataFrame) -> DataFrame:
    """Mean, max, min and non-null count of ``value`` per Gold key.

    Rows with a NULL key are dropped first (a pandas group-by drops them; Spark
    would keep a NULL group). The aggregate is partial on the map side, so the
    shuffle carries at most one row per key and task, however hot a key is.
    """
    keys = list(GOLD_KEYS)
    return (silver.dropna(subset=keys)
            .groupBy(*keys)
            .agg(F.avg("value").alias("avg_value"),
                 F.max("value").alias("max_value"),
                 F.min("value").alias("min_value"),
                 F.count("value").alias("record_count")))


def sorted_gold(gold: DataFrame) -> DataFrame:
    """Gold in (date, location, pollutant_type, zone) order, for writing.

    A global sort is a range-partitioned exchange plus a local sort: sampled
    bounds, no single task sees all rows.
    """
    return gold.orderBy(*GOLD_KEYS)
