"""Reading the driver's Parquet tables (one Parquet file or folder per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


_SCANS: dict[tuple[str, str], DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; column pruning and filter pushdown are left to Catalyst.

    The input tables are read-only, so the scan (file listing and footer
    schema) is resolved once per session and reused by every query plan.
    """
    path = table_path(sf_dir, name)
    key = (spark.sparkContext.applicationId, os.path.abspath(path))
    df = _SCANS.get(key)
    if df is None:
        df = _SCANS[key] = spark.read.parquet(path)
    return df
