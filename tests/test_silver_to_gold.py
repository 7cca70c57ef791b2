"""Silver -> Gold (the reference's fourteen cases, every group checked)."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from airshed.layers import write_gold
from airshed.operators.checks import aggregate_violations
from airshed.operators.gold import daily_gold
from airshed.schema import GOLD_SCHEMA, SILVER_SCHEMA
from airshed.sources.layers_io import read_by_month, read_layer

GOLD_COLS = [f.name for f in GOLD_SCHEMA.fields]


def _gold(spark, silver_path, tmp_data_dir):
    out = str(tmp_data_dir["gold"] / "gold.parquet")
    n = write_gold(spark, silver_path, out)
    return read_by_month(spark, out), n


def test_silver_to_gold_happy_path(spark, sample_silver_parquet, tmp_data_dir):
    df, n = _gold(spark, sample_silver_parquet[0], tmp_data_dir)
    assert n == df.count() == 5


def test_silver_to_gold_aggregation_columns(spark, sample_silver_parquet, tmp_data_dir):
    df, _ = _gold(spark, sample_silver_parquet[0], tmp_data_dir)
    assert df.columns == GOLD_COLS
    assert df.schema == GOLD_SCHEMA


def test_silver_to_gold_grouping_columns(spark, sample_silver_parquet, tmp_data_dir):
    df, _ = _gold(spark, sample_silver_parquet[0], tmp_data_dir)
    assert df.groupBy("date", "location", "pollutant_type", "zone").count().filter("count > 1").count() == 0


def test_silver_to_gold_aggregation_accuracy(spark, sample_silver_parquet, tmp_data_dir):
    p, rows = sample_silver_parquet
    df, _ = _gold(spark, p, tmp_data_dir)
    groups = defaultdict(list)
    for r in rows:
        groups[(r[11], r[0], r[5], r[4])].append(r[6])
    got = {(r.date, r.location, r.pollutant_type, r.zone): r for r in df.collect()}
    assert set(got) == set(groups)
    for k, vals in groups.items():
        g = got[k]
        assert g.avg_value == pytest.approx(sum(vals) / len(vals))
        assert g.max_value == max(vals) and g.min_value == min(vals) and g.record_count == len(vals)


def test_silver_to_gold_sorting(spark, sample_silver_parquet, tmp_data_dir):
    df, _ = _gold(spark, sample_silver_parquet[0], tmp_data_dir)
    keys = [(r.date, r.location, r.pollutant_type, r.zone) for r in df.collect()]
    assert keys == sorted(keys)


def test_silver_to_gold_no_null_aggregations(spark, sample_silver_parquet, tmp_data_dir):
    df, _ = _gold(spark, sample_silver_parquet[0], tmp_data_dir)
    for c in GOLD_COLS:
        assert df.filter(F.col(c).isNull()).count() == 0


def test_silver_to_gold_count_aggregation(spark, sample_silver_parquet, tmp_data_dir):
    df, _ = _gold(spark, sample_silver_parquet[0], tmp_data_dir)
    assert df.agg(F.sum("record_count")).collect()[0][0] == 5
    assert df.filter("record_count <= 0").count() == 0


def test_silver_to_gold_missing_input_file(spark, tmp_data_dir):
    with pytest.raises(FileNotFoundError):
        write_gold(spark, str(tmp_data_dir["silver"] / "nope"), str(tmp_data_dir["gold"] / "g"))


def test_silver_to_gold_empty_input(spark, empty_parquet, tmp_data_dir):
    with pytest.raises(ValueError):
        write_gold(spark, empty_parquet, str(tmp_data_dir["gold"] / "g"))


def test_silver_to_gold_output_format(spark, sample_silver_parquet, tmp_data_dir):
    _gold(spark, sample_silver_parquet[0], tmp_data_dir)
    assert read_layer(spark, str(tmp_data_dir["gold"] / "gold.parquet")).count() == 5


def test_silver_to_gold_creates_output_directory(spark, sample_silver_parquet, tmp_data_dir):
    out = tmp_data_dir["root"] / "x" / "y" / "gold.parquet"
    write_gold(spark, sample_silver_parquet[0], str(out))
    assert out.exists()


def test_silver_to_gold_min_max_relationship(spark, sample_silver_parquet, tmp_data_dir):
    df, _ = _gold(spark, sample_silver_parquet[0], tmp_data_dir)
    assert aggregate_violations(df).count() == 0


def test_silver_to_gold_multiple_locations(spark, sample_silver_parquet, tmp_data_dir):
    df, _ = _gold(spark, sample_silver_parquet[0], tmp_data_dir)
    assert {r.location for r in df.select("location").distinct().collect()} == {"London", "Manchester"}


def test_silver_to_gold_multiple_pollutants(spark, sample_silver_parquet, tmp_data_dir):
    df, _ = _gold(spark, sample_silver_parquet[0], tmp_data_dir)
    assert {r.pollutant_type for r in df.select("pollutant_type").distinct().collect()} == {"PM2.5", "NO2"}


def test_null_keys_are_dropped(spark):
    base = ("London", 1.0, 1.0, "urban", "south", "PM2.5", 10.0, "u", "valid", None, "f",
            dt.date(2024, 1, 1))
    rows = [base, base[:4] + (None,) + base[5:], (None,) + base[1:]]
    g = daily_gold(spark.createDataFrame(rows, SILVER_SCHEMA)).collect()
    assert len(g) == 1 and g[0].record_count == 1


def test_aggregate_violations_detects_bad_rows(spark):
    rows = [(dt.date(2024, 1, 1), "A", "PM2.5", "z", 5.0, 4.0, 3.0, 2),
            (dt.date(2024, 1, 1), "B", "PM2.5", "z", 3.0, 4.0, 2.0, 0),
            (dt.date(2024, 1, 1), "C", "PM2.5", "z", 3.0, 4.0, 2.0, 2)]
    bad = aggregate_violations(spark.createDataFrame(rows, GOLD_SCHEMA))
    assert sorted(r.location for r in bad.collect()) == ["A", "B"]
