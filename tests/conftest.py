"""Shared fixtures: one local session, the reference's small layer tables."""

from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from airshed.schema import BRONZE_SCHEMA, SILVER_SCHEMA  # noqa: E402
from airshed.session import BASE_CONF, checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"

RAW_ROWS = [
    ("2024-01-01", "London", 51.5074, -0.1278, "urban", "south", "PM2.5", 35.5, "µg/m³", "valid"),
    ("2024-01-01", "London", 51.5074, -0.1278, "urban", "south", "NO2", 42.3, "µg/m³", "valid"),
    ("2024-01-02", "Manchester", 53.4808, -2.2426, "urban", "north", "PM2.5", 38.2, "µg/m³", "valid"),
    ("2024-01-02", "Manchester", 53.4808, -2.2426, "urban", "north", "NO2", 45.1, "µg/m³", "valid"),
    ("2024-01-03", "London", 51.5074, -0.1278, "urban", "south", "PM2.5", 36.8, "µg/m³", "valid"),
    ("2024-01-03", "Manchester", 53.4808, -2.2426, "urban", "north", "NO2", 43.9, "µg/m³", "valid"),
]
HEADER = "date,location,latitude,longitude,site_type,zone,pollutant_type,value,unit,status"
RUN_TS = dt.datetime(2024, 1, 4, 8, 0, 0)


@pytest.fixture(scope="session")
def spark():
    b = SparkSession.builder.master("local[*]").appName("airshed-tests") \
        .config("spark.sql.shuffle.partitions", "8")
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # the shared folder named by spark.checkpoint.dir; a scratch one only if unset
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture
def tmp_data_dir(tmp_path):
    dirs = {"root": tmp_path}
    for name in ("landing", "bronze", "silver", "gold"):
        p = tmp_path / name
        p.mkdir()
        dirs[name] = p
    return dirs


def _csv_text(rows, header=HEADER):
    out = [header]
    for r in rows:
        out.append(",".join("" if v is None else str(v) for v in r))
    return "\n".join(out) + "\n"


@pytest.fixture
def sample_raw_csv(tmp_data_dir):
    p = tmp_data_dir["landing"] / "weather_raw.csv"
    p.write_text(_csv_text(RAW_ROWS), encoding="utf-8")
    return p, RAW_ROWS


def bronze_df(spark, rows):
    return spark.createDataFrame([r + (RUN_TS, "weather_raw.csv") for r in rows], BRONZE_SCHEMA)


@pytest.fixture
def sample_bronze_parquet(spark, tmp_data_dir):
    p = str(tmp_data_dir["bronze"] / "weather_bronze.parquet")
    bronze_df(spark, RAW_ROWS).coalesce(1).write.parquet(p)
    return p, RAW_ROWS


@pytest.fixture
def sample_silver_parquet(spark, tmp_data_dir):
    rows = [
        ("London", 51.5074, -0.1278, "urban", "south", "PM2.5", 35.5, "µg/m³", "valid", RUN_TS, "weather_raw.csv", dt.date(2024, 1, 1)),
        ("London", 51.5074, -0.1278, "urban", "south", "NO2", 42.3, "µg/m³", "valid", RUN_TS, "weather_raw.csv", dt.date(2024, 1, 1)),
        ("Manchester", 53.4808, -2.2426, "urban", "north", "PM2.5", 38.2, "µg/m³", "valid", RUN_TS, "weather_raw.csv", dt.date(2024, 1, 2)),
        ("Manchester", 53.4808, -2.2426, "urban", "north", "NO2", 45.1, "µg/m³", "valid", RUN_TS, "weather_raw.csv", dt.date(2024, 1, 2)),
        ("London", 51.5074, -0.1278, "urban", "south", "PM2.5", 36.8, "µg/m³", "valid", RUN_TS, "weather_raw.csv", dt.date(2024, 1, 3)),
    ]
    p = str(tmp_data_dir["silver"] / "weather_silver.parquet")
    spark.createDataFrame(rows, SILVER_SCHEMA).coalesce(1).write.parquet(p)
    return p, rows


INVALID_ROWS = [
    ("2024-01-01", "London", 51.5074, -0.1278, "urban", "south", "PM2.5", 35.5, "µg/m³", "valid"),
    ("2024-01-01", "London", 51.5074, -0.1278, "urban", "south", "NO2", 42.3, "µg/m³", "valid"),
    ("invalid-date", "Manchester", 999.0, -2.2426, "urban", "north", "PM2.5", 38.2, "µg/m³", "valid"),
    ("2024-01-02", "Manchester", 53.4808, 500.0, "urban", "north", "NO2", -5.1, "µg/m³", "valid"),
    ("2024-01-03", "London", 51.5074, -0.1278, "urban", "south", "PM2.5", None, "µg/m³", "valid"),
    ("2024-01-03", "Manchester", 53.4808, -2.2426, "urban", "north", "NO2", 43.9, "µg/m³", "valid"),
]


@pytest.fixture
def bronze_with_invalid_data(spark, tmp_data_dir):
    p = str(tmp_data_dir["bronze"] / "weather_bronze_invalid.parquet")
    bronze_df(spark, INVALID_ROWS).coalesce(1).write.parquet(p)
    return p, INVALID_ROWS


@pytest.fixture
def empty_parquet(tmp_data_dir):
    """A Parquet file with no rows and no columns."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    p = str(tmp_data_dir["bronze"] / "empty.parquet")
    pq.write_table(pa.table({}), p, compression="snappy")
    return p
