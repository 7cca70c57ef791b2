"""Adapters that derive the library's inputs from the driver's tables.

Measurements come from ``lineitem`` (location = supplier nation, zone =
region, pollutant = return flag) with defects fixed by ``l_orderkey``; run
history comes from ``events``. The mapping rules are the test-data contract
(FIXTURES.md §4-§5), stated here as plain expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.functions import labels as L
from airshed.sources.tables import read_table


def supplier_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier -> (s_suppkey, n_nationkey, n_name, r_name).

    Plain equi-joins without hints: nation and region are fixed-size dimensions
    that the planner broadcasts on its own byte estimate; supplier grows with the
    data, so the join with lineitem is chosen by the planner's statistics and
    re-planned by adaptive execution from the measured sizes (a skewed supplier is split).
    """
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name")
    return supplier.join(geo, supplier.s_nationkey == geo.n_nationkey).select(
        "s_suppkey", "n_nationkey", "n_name", "r_name")


def raw_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw measurement rows (all ten raw columns, text date) from lineitem."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")
    geo = supplier_geography(spark, sf_dir)
    j = li.join(geo, li.l_suppkey == geo.s_suppkey)
    k = F.col("l_orderkey")
    q = F.col("l_quantity")
    return j.select(
        F.when(k % 101 == 0, F.lit("invalid-date"))
         .otherwise(F.col("l_shipdate").cast("date").cast("string")).alias("date"),
        F.col("n_name").alias("location"),
        F.when(k % 97 == 0, F.lit(999.0))
         .otherwise(((F.col("n_nationkey") * 7) % 180 - 90).cast("double")).alias("latitude"),
        F.when(k % 89 == 0, F.lit(500.0))
         .otherwise(((F.col("n_nationkey") * 13) % 360 - 180).cast("double")).alias("longitude"),
        F.when(F.col("l_linestatus") == "F", "urban").otherwise("rural").alias("site_type"),
        F.when(k % 83 == 0, F.lit(None).cast("string")).otherwise(F.col("r_name")).alias("zone"),
        F.when(F.col("l_returnflag") == "A", "PM2.5")
         .when(F.col("l_returnflag") == "N", "NO2").otherwise("O3").alias("pollutant_type"),
        F.when(k % 53 == 0, F.lit(None).cast("double"))
         .when(k % 59 == 0, -q)
         .when(F.col("l_returnflag") == "N", q * 5)
         .otherwise(q).alias("value"),
        F.lit("ug/m3").alias("unit"),
        F.lit("valid").alias("status"),
    )


def run_history(spark: SparkSession, sf_dir: str, pipeline_name: str = "main") -> DataFrame:
    """Pipeline run log from events: an ``error`` event is a failed run."""
    ev = read_table(spark, sf_dir, "events").select("event_type", "ts")
    return ev.select(
        F.lit(pipeline_name).alias("pipeline_name"),
        F.when(F.col("event_type") == "error", L.RUN_FAILED)
         .otherwise(L.RUN_SUCCEEDED).alias("status"),
        F.col("ts").alias("time_generated"),
    )
