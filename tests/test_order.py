"""Positions in a whole order, without a window over all rows in one task."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from airshed.plans.order import REPORT_ORDER, key_columns, with_positions


@pytest.mark.parametrize("partitions", [1, 7])
def test_positions_equal_a_sorted_list(spark, tmp_path, partitions):
    rng = random.Random(partitions)
    rows = [(i, rng.choice([None, 1, 1, 1, 2, 3]), rng.random()) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, hot long, x double").repartition(partitions)
    sort = [F.col("hot").desc_nulls_last(), F.col("x").asc_nulls_last(), F.col("id").asc_nulls_last()]
    out = with_positions(df, sort, str(tmp_path / "p"))
    assert out.columns == ["id", "hot", "x", "position"]
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[2], r[0]))
    assert [(r["position"], r["id"]) for r in out.orderBy("position").collect()] == [(i + 1, r[0]) for i, r in enumerate(want)]
    # no row reaches one task beyond a count for each range: the window reads the aggregate
    assert with_positions(df.limit(0), sort, str(tmp_path / "none")).count() == 0


def test_every_ordered_report_has_a_key():
    assert all(key_columns(n) for n in REPORT_ORDER)
    assert key_columns("weekday_pattern") == ["day_of_week", "pollutant_type"]
    assert key_columns("trend_slope") == ["location", "pollutant_type"]
