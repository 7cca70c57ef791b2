"""Retention by folders, and loads whose schemas differ."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.layers import LayerPaths, run_incremental
from airshed.schema import RAW_SCHEMA, SILVER_SCHEMA
from airshed.sources import retention
from airshed.sources.layers_io import read_by_month, write_by_month
from airshed.sources.schema_ledger import load_schemas, merged, read_loads, wider, write_load
from tests.conftest import RAW_ROWS, RUN_TS

AS_OF = dt.datetime(2024, 6, 30, 12)


def bronze(spark, times):
    return spark.createDataFrame([(f"v{i}", t) for i, t in enumerate(times)], "value string, ingestion_timestamp timestamp")


def folders(path):
    return sorted(f"{a}/{b}" for a in os.listdir(path) if "=" in a for b in os.listdir(f"{path}/{a}") if "=" in b)


def test_bronze_expires_by_day_folder_and_row_at_the_boundary(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "bronze")
    times = [AS_OF - dt.timedelta(days=d) for d in (200, 91, 89, 0)] + [AS_OF - dt.timedelta(days=90, hours=h) for h in (1, 0, -1)] + [None]
    retention.write_by_arrival(bronze(spark, times), path, "one")
    retention.write_by_arrival(bronze(spark, times[:1]), path, "two")
    opened = []
    rewrite = retention._rewrite
    monkeypatch.setattr(retention, "_rewrite", lambda s, folder, keep: opened.append(folder) or rewrite(s, folder, keep))
    gone = retention.expire_bronze(spark, path, 90, AS_OF)
    assert gone == ["load_id=one/arrival_day=2023-12-13", "load_id=one/arrival_day=2024-03-31", "load_id=two/arrival_day=2023-12-13"]
    assert opened == [f"{path}/load_id=one/arrival_day=2024-04-01"]
    left = spark.read.parquet(path)
    assert {r["ingestion_timestamp"] for r in left.collect()} == {t for t in times if t is None or t >= AS_OF - dt.timedelta(days=90)}
    assert retention.expire_bronze(spark, path, 90, AS_OF) == [] and left.count() == 5


def test_a_rewrite_that_failed_is_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "bronze")
    retention.write_by_arrival(bronze(spark, [AS_OF - dt.timedelta(days=90, hours=h) for h in (2, -2)]), path, "one")
    with monkeypatch.context() as m:
        m.setattr(retention, "rename_folder", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            retention.expire_bronze(spark, path, 90, AS_OF)
    retention.expire_bronze(spark, path, 90, AS_OF)
    assert folders(path) == ["load_id=one/arrival_day=2024-04-01"] and spark.read.parquet(path).count() == 1


@pytest.mark.parametrize("load_id", ["batch", None])
def test_months_expire_row_exactly(spark, tmp_path, load_id):
    path = str(tmp_path / "silver")
    dates = [dt.date(2023, 12, 31), dt.date(2024, 1, 9), dt.date(2024, 1, 10), dt.date(2024, 2, 1)]
    rows = spark.createDataFrame([("L", 1.0, 1.0, "urban", "z", "NO2", 1.0, "u", "valid", RUN_TS, "f", d) for d in dates], SILVER_SCHEMA)
    write_by_month(rows, path, ["date"], load_id)
    retention.expire_months_exactly(spark, path, 22, dt.date(2024, 2, 1))
    assert sorted(r["date"] for r in read_by_month(spark, path).collect()) == dates[2:]


@pytest.mark.parametrize("a, b, both", [
    (T.IntegerType(), T.LongType(), T.LongType()), (T.DoubleType(), T.IntegerType(), T.DoubleType()), (T.FloatType(), T.LongType(), T.DoubleType()),
    (T.NullType(), T.StringType(), T.StringType()), (T.StringType(), T.LongType(), None), (T.DateType(), T.TimestampType(), None), (T.BooleanType(), T.IntegerType(), None)])
def test_types_widen_safely_or_not_at_all(a, b, both):
    assert wider(a, b) == wider(b, a) == both


def test_loads_of_three_schemas_are_read_whole(spark, tmp_path):
    path, ledger = str(tmp_path / "bronze"), str(tmp_path / "schemas")
    write_load(spark, spark.createDataFrame([("a", 1)], "name string, n int"), path, ledger, "1")
    write_load(spark, spark.createDataFrame([(2**40, "b", 0.5)], "n long, name string, `x.y` double"), path, ledger, "2")
    write_load(spark, spark.createDataFrame([(1.5,)], "n double"), path, ledger, "3")
    with pytest.raises(ValueError, match="name: string and int"):
        write_load(spark, spark.createDataFrame([(7, 1)], "name int, n int"), path, ledger, "4")
    assert not os.path.exists(f"{path}/load_id=4") and list(load_schemas(spark, ledger)) == ["1", "2", "3"]
    got = read_loads(spark, path, ledger)
    assert got.columns == ["name", "n", "x.y", "load_id"] and got.schema["n"].dataType == T.DoubleType()
    assert {tuple(r) for r in got.collect()} == {("a", 1.0, None, "1"), ("b", float(2**40), 0.5, "2"), (None, 1.5, None, "3")}
    write_load(spark, spark.createDataFrame([], "n double"), path, ledger, "5")
    write_load(spark, spark.createDataFrame([(9,)], "n int"), path, ledger, "2")  # a repeated load, now without a column
    assert {tuple(r) for r in read_loads(spark, path, ledger).select("n", "load_id").collect()} == {(1.0, "1"), (9.0, "2"), (1.5, "3")}
    assert read_loads(spark, path, ledger).columns == ["name", "n", "load_id"]
    assert read_loads(spark, path, ledger, ["1"]).schema["n"].dataType == T.IntegerType()


def test_a_gained_column_reaches_silver(spark, tmp_path):
    paths, marks = LayerPaths(str(tmp_path)), str(tmp_path / "marks")
    rows = spark.createDataFrame(RAW_ROWS, RAW_SCHEMA)
    run_incremental(spark, paths, rows, marks, as_of="2024-01-02")
    run_incremental(spark, paths, rows.withColumn("humidity", F.lit("40")), marks, as_of="2024-01-03")
    silver = spark.read.option("mergeSchema", True).parquet(paths.silver)
    assert {(r["date"].day, r["humidity"]) for r in silver.collect()} == {(1, None), (2, None), (3, "40")}
