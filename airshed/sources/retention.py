"""S15: retention of layers that lie in folders by day or month.

A folder that lies wholly before the cutoff is removed by its name; the one the cutoff falls into is written again with the rows that
stay, and no other folder is opened.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.sources.layers_io import (LOAD, MONTH, path_exists, remove_folder, rename_folder, subfolders, write_partitions)

ARRIVAL = "arrival_day"


def write_by_arrival(bronze: DataFrame, path: str, load_id: str) -> None:
    """A load of Bronze in folders by the day its rows arrived, below the folder of the load; a repeated load replaces the days it has."""
    d = bronze.withColumns({LOAD: F.lit(load_id), ARRIVAL: F.to_date("ingestion_timestamp")})
    write_partitions(d.hint("rebalance", F.col(ARRIVAL)), path, [LOAD, ARRIVAL])


def expire_bronze(spark: SparkSession, path: str, days: int, as_of: _dt.datetime) -> list[str]:
    """Remove the rows of Bronze (``write_by_arrival``) that arrived more than ``days`` days before ``as_of``; returns the removed folders.
    Rows without an arrival time stay."""
    cutoff = as_of - _dt.timedelta(days=days)
    folders = [(f"{load}/{day}", day.partition("=")[2]) for load in subfolders(spark, path) if load.startswith(f"{LOAD}=")
               for day in _own(subfolders(spark, f"{path}/{load}"), ARRIVAL)]
    return _expire(spark, path, folders, cutoff.date().isoformat(), F.col("ingestion_timestamp") >= F.lit(cutoff))


def expire_months_exactly(spark: SparkSession, path: str, days: int, as_of: _dt.date) -> list[str]:
    """Remove the rows of a layer in month folders (Silver, Gold) dated more than ``days`` days before ``as_of``; returns the removed folders."""
    cutoff = as_of - _dt.timedelta(days=days)
    folders = [(month, month.partition("=")[2]) for month in _own(subfolders(spark, path), MONTH)]
    below = [(f"{m}/{load}", value) for m, value in folders for load in _own(subfolders(spark, f"{path}/{m}"), LOAD)]
    return _expire(spark, path, below or folders, f"{cutoff.year * 100 + cutoff.month}", F.col("date") >= F.lit(cutoff))


def _own(names: list[str], column: str) -> list[str]:
    """Folders of a column's values, and those a failed run has set aside in their place."""
    return sorted({n.removeprefix("_kept-") for n in names if n.removeprefix("_kept-").startswith(f"{column}=") and not n.endswith("=__HIVE_DEFAULT_PARTITION__")})


def _expire(spark: SparkSession, path: str, folders: list[tuple[str, str]], boundary: str, keep: Column) -> list[str]:
    gone = []
    for folder, value in folders:
        if value < boundary:
            remove_folder(spark, f"{path}/{folder}")
            gone.append(folder)
        elif value == boundary:
            _rewrite(spark, f"{path}/{folder}", keep)
    return gone


def _rewrite(spark: SparkSession, folder: str, keep: Column) -> None:
    """A folder with the rows that stay: written beside it under a name that readers pass over, then put in its place. A run
    that ended in between is finished: the set-aside folder is whole once it has its success mark."""
    above, _, name = folder.rpartition("/")
    aside = f"{above}/_kept-{name}"
    if path_exists(spark, folder):
        rows = spark.read.parquet(folder)
        if rows.filter(~F.coalesce(keep, F.lit(True))).isEmpty():
            remove_folder(spark, aside)
            return
        rows.filter(F.coalesce(keep, F.lit(True))).write.mode("overwrite").option("compression", "snappy").parquet(aside)
        remove_folder(spark, folder)
    if path_exists(spark, f"{aside}/_SUCCESS"):
        rename_folder(spark, aside, folder)
