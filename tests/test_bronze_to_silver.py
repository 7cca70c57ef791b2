"""Bronze -> Silver (the reference's thirteen cases, plus quarantine and rules)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.layers import write_silver
from airshed.sources.layers_io import read_by_month
from airshed.operators import clean
from airshed.sources.layers_io import read_layer
from tests.conftest import RAW_ROWS, bronze_df


def _silver(spark, bronze_path, tmp_data_dir):
    out = str(tmp_data_dir["silver"] / "out.parquet")
    q = str(tmp_data_dir["root"] / "quarantine")
    write_silver(spark, bronze_path, out, q, run_date=dt.date(2024, 1, 4))
    return read_by_month(spark, out), out, q


def test_bronze_to_silver_happy_path(spark, sample_bronze_parquet, tmp_data_dir):
    p, rows = sample_bronze_parquet
    df, out, _ = _silver(spark, p, tmp_data_dir)
    assert 0 < df.count() <= len(rows)


def test_bronze_to_silver_date_parsing(spark, sample_bronze_parquet, tmp_data_dir):
    df, _, _ = _silver(spark, sample_bronze_parquet[0], tmp_data_dir)
    assert df.schema["date"].dataType == T.DateType()


def test_bronze_to_silver_null_removal(spark, sample_bronze_parquet, tmp_data_dir):
    df, _, _ = _silver(spark, sample_bronze_parquet[0], tmp_data_dir)
    for c in ("date", "value", "latitude", "longitude"):
        assert df.filter(F.col(c).isNull()).count() == 0


def test_bronze_to_silver_invalid_data_removal(spark, bronze_with_invalid_data, tmp_data_dir):
    p, rows = bronze_with_invalid_data
    df, _, q = _silver(spark, p, tmp_data_dir)
    kept = sorted((r.location, r.pollutant_type, r.value) for r in df.collect())
    expect = sorted((rows[i][1], rows[i][6], rows[i][7]) for i in (0, 1, 5))
    assert kept == expect
    reasons = {r.value if r.value is not None else "null": sorted(r.reject_reasons)
               for r in spark.read.parquet(q).collect()}
    assert reasons == {
        38.2: ["date_unparseable", "latitude_out_of_range"],
        -5.1: ["longitude_out_of_range", "value_negative"],
        "null": ["value_missing"],
    }


def test_bronze_to_silver_coordinate_validation(spark, sample_bronze_parquet, tmp_data_dir):
    df, _, _ = _silver(spark, sample_bronze_parquet[0], tmp_data_dir)
    assert df.filter(~F.col("latitude").between(-90, 90) | ~F.col("longitude").between(-180, 180)).count() == 0


def test_bronze_to_silver_positive_values(spark, sample_bronze_parquet, tmp_data_dir):
    df, _, _ = _silver(spark, sample_bronze_parquet[0], tmp_data_dir)
    assert df.filter(F.col("value") < 0).count() == 0


def test_bronze_to_silver_missing_input_file(spark, tmp_data_dir):
    with pytest.raises(FileNotFoundError):
        read_layer(spark, str(tmp_data_dir["bronze"] / "missing.parquet"))


def test_bronze_to_silver_empty_input(spark, empty_parquet):
    with pytest.raises(ValueError):
        read_layer(spark, empty_parquet)


def test_bronze_to_silver_column_drop(spark, sample_bronze_parquet, tmp_data_dir):
    df, _, _ = _silver(spark, sample_bronze_parquet[0], tmp_data_dir)
    assert clean.PARSED_DATE not in df.columns
    assert df.columns[-1] == "date"
    assert df.columns.count("date") == 1


def test_bronze_to_silver_metadata_preserved(spark, sample_bronze_parquet, tmp_data_dir):
    df, _, _ = _silver(spark, sample_bronze_parquet[0], tmp_data_dir)
    assert "ingestion_timestamp" in df.columns and "source_file" in df.columns


def test_bronze_to_silver_output_format(spark, sample_bronze_parquet, tmp_data_dir):
    _, out, _ = _silver(spark, sample_bronze_parquet[0], tmp_data_dir)
    import pyarrow.parquet as pq
    assert pq.read_table(out).num_rows == 6


def test_bronze_to_silver_creates_output_directory(spark, sample_bronze_parquet, tmp_data_dir):
    out = tmp_data_dir["root"] / "a" / "b" / "silver.parquet"
    write_silver(spark, sample_bronze_parquet[0], str(out), str(tmp_data_dir["root"] / "q"))
    assert out.exists()


def test_bronze_to_silver_data_integrity(spark, sample_bronze_parquet, tmp_data_dir):
    p, rows = sample_bronze_parquet
    df, _, _ = _silver(spark, p, tmp_data_dir)
    manual = [r for r in rows if r[7] is not None and r[7] >= 0 and -90 <= r[2] <= 90 and -180 <= r[3] <= 180]
    assert df.count() == len(manual)


@pytest.mark.parametrize("text,ok", [
    ("2024-01-05", True), ("2024-1-5", True), ("2024-01-05 10:00:00", False),
    ("2024-02-30", False), ("20240105", False), (" 2024-01-05", False), ("invalid-date", False),
    ("0000-01-01", False),
])
def test_date_format_rules(spark, text, ok):
    row = ("x",) + RAW_ROWS[0][1:]
    df = bronze_df(spark, [(text,) + row[1:]])
    assert clean.to_silver(df).count() == (1 if ok else 0)


def test_fast_date_parse_equals_pattern_parse(spark):
    texts = ["2024-01-05", "2024-1-5", "2024-12-31", "1999-2-28", "2024-02-29", "2023-02-29",
             "2024-02-30", "2024-13-01", "2024-00-10", "2024-01-00", "2024-1-32", "2024-01-05 10:00:00",
             "2024-01-05T10:00", "20240105", "2024/01/05", " 2024-01-05", "2024-01-05 ", "2024-01",
             "2024", "24-01-05", "02024-01-05", "+2024-01-05", "-2024-01-05", "2024-001-05",
             "2024-01-005", "abcd-ef-gh", "", "invalid-date", "9999-12-31", "1000-01-01", "0001-01-01",
             "0000-01-01"]
    df = spark.createDataFrame([(t,) for t in texts], "date string")
    out = df.select("date", clean.parse_date("date").cast("string").alias("fast"),
                    F.try_to_date("date", clean.DATE_FORMAT).cast("string").alias("pattern")).collect()
    # the pattern parser also takes a signed year, year 0 and three-digit
    # months or days; the reference's '%Y-%m-%d' takes none of them
    lax = {"-2024-01-05", "2024-001-05", "2024-01-005", "0000-01-01"}
    for r in out:
        if r.date in lax:
            assert r.fast is None
        else:
            assert r.fast == r.pattern, r


def test_nan_rejected_infinity_kept(spark):
    rows = [RAW_ROWS[0][:7] + (float("nan"),) + RAW_ROWS[0][8:],
            RAW_ROWS[0][:7] + (float("inf"),) + RAW_ROWS[0][8:]]
    out = clean.to_silver(bronze_df(spark, rows)).collect()
    assert [r.value for r in out] == [float("inf")]


def test_reject_counts_one_pass(spark, bronze_with_invalid_data):
    p, _ = bronze_with_invalid_data
    r = clean.reject_counts(spark.read.parquet(p)).collect()[0].asDict()
    assert r == {"total_rows": 6, "date_unparseable": 1, "value_missing": 1, "value_negative": 1,
                 "latitude_out_of_range": 1, "longitude_out_of_range": 1,
                 "rejected_rows": 3, "valid_rows": 3}


def test_extra_range_rule(spark):
    rows = [RAW_ROWS[0], RAW_ROWS[0][:7] + (600.0,) + RAW_ROWS[0][8:]]
    rules = clean.default_rules() + [clean.range_rule("value", 0, 500)]
    assert clean.to_silver(bronze_df(spark, rows), rules).count() == 1


def test_replay_round_trip(spark, bronze_with_invalid_data):
    p, _ = bronze_with_invalid_data
    b = spark.read.parquet(p)
    q = clean.to_quarantine(b, run_date=dt.date(2024, 1, 4))
    fixed = clean.replay(q).withColumn("value", F.abs(F.coalesce("value", F.lit(1.0)))) \
        .withColumn("date", F.lit("2024-01-02")).withColumn("latitude", F.lit(1.0)) \
        .withColumn("longitude", F.lit(1.0))
    assert clean.to_silver(fixed).count() == 3
    assert fixed.columns == b.columns


def test_opt_in_dedupe(spark):
    df = bronze_df(spark, [RAW_ROWS[0], RAW_ROWS[0], RAW_ROWS[1]])
    assert clean.to_silver(df).count() == 3
    assert clean.to_silver(df, dedupe_keys=["date", "location", "pollutant_type", "zone", "value"]).count() == 2


def test_rules_without_date_rule_keep_parse_semantics(spark):
    rows = [("2024-01-05 10:00",) + RAW_ROWS[0][1:], RAW_ROWS[0]]
    rules = [r for r in clean.default_rules() if r.name != clean.DATE_RULE]
    out = sorted((r.date is None) for r in clean.to_silver(bronze_df(spark, rows), rules).collect())
    assert out == [False, True]  # the time-stamped text is kept but does not parse
