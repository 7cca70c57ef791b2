"""Raw CSV -> Bronze (the reference's nine ingestion cases, plus CSV traps)."""

from __future__ import annotations

import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from airshed.sources.csv_ingest import ingest_csv, read_raw_csv
from tests.conftest import HEADER, RAW_ROWS

RAW_NAMES = ["date", "location", "latitude", "longitude", "site_type", "zone",
             "pollutant_type", "value", "unit", "status"]


def _parquet_files(path):
    import glob
    return sorted(glob.glob(f"{path}/*.parquet"))


def test_ingest_csv_happy_path(spark, sample_raw_csv, tmp_data_dir):
    src, rows = sample_raw_csv
    out = str(tmp_data_dir["bronze"] / "ingested.parquet")
    df = ingest_csv(spark, str(src), out)
    assert _parquet_files(out)
    assert df.count() == len(rows)
    assert "ingestion_timestamp" in df.columns and "source_file" in df.columns
    assert set(df.columns) - {"ingestion_timestamp", "source_file"} == set(RAW_NAMES)


def test_ingest_csv_parquet_format(spark, sample_raw_csv, tmp_data_dir):
    src, _ = sample_raw_csv
    out = str(tmp_data_dir["bronze"] / "format_test.parquet")
    ingest_csv(spark, str(src), out)
    table = pq.read_table(out)
    assert table.num_rows > 0


def test_ingest_csv_source_file_metadata(spark, sample_raw_csv, tmp_data_dir):
    src, _ = sample_raw_csv
    df = ingest_csv(spark, str(src), str(tmp_data_dir["bronze"] / "m.parquet"))
    assert {r.source_file for r in df.select("source_file").collect()} == {"weather_raw.csv"}
    assert df.select("ingestion_timestamp").distinct().count() == 1


def test_ingest_csv_missing_file(spark, tmp_data_dir):
    with pytest.raises(FileNotFoundError):
        ingest_csv(spark, str(tmp_data_dir["landing"] / "nope.csv"), str(tmp_data_dir["bronze"] / "x"))


@pytest.mark.parametrize("content", ["", "date,location,latitude,longitude,site_type,zone,pollutant_type,value,unit,status\n"])
def test_ingest_csv_empty_file(spark, tmp_data_dir, content):
    p = tmp_data_dir["landing"] / "empty.csv"
    p.write_text(content)
    with pytest.raises(ValueError):
        ingest_csv(spark, str(p), str(tmp_data_dir["bronze"] / "x"))


def test_ingest_csv_data_types_preserved(spark, sample_raw_csv, tmp_data_dir):
    src, _ = sample_raw_csv
    df = ingest_csv(spark, str(src), str(tmp_data_dir["bronze"] / "t.parquet"))
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    for c in ("latitude", "longitude", "value"):
        assert types[c] == T.DoubleType()
    for c in ("date", "location", "site_type", "zone", "pollutant_type", "unit", "status", "source_file"):
        assert types[c] == T.StringType()
    assert types["ingestion_timestamp"] == T.TimestampType()
    assert df.filter("unit = 'µg/m³'").count() == 6


def test_ingest_csv_column_count(spark, sample_raw_csv, tmp_data_dir):
    src, _ = sample_raw_csv
    df = ingest_csv(spark, str(src), str(tmp_data_dir["bronze"] / "c.parquet"))
    assert len(df.columns) == 12
    assert df.columns[:10] == RAW_NAMES


def test_ingest_csv_creates_output_directory(spark, sample_raw_csv, tmp_data_dir):
    src, _ = sample_raw_csv
    out = tmp_data_dir["root"] / "nested" / "deep" / "bronze.parquet"
    ingest_csv(spark, str(src), str(out))
    assert out.exists()


def test_ingest_csv_snappy_compression(spark, sample_raw_csv, tmp_data_dir):
    src, _ = sample_raw_csv
    out = str(tmp_data_dir["bronze"] / "snappy.parquet")
    ingest_csv(spark, str(src), out)
    for f in _parquet_files(out):
        meta = pq.ParquetFile(f).metadata
        for rg in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                assert meta.row_group(rg).column(c).compression == "SNAPPY"


def test_na_tokens_become_null_in_every_column(spark, tmp_data_dir):
    p = tmp_data_dir["landing"] / "na.csv"
    p.write_text("date,location,latitude,longitude,site_type,zone,pollutant_type,value,unit,status\n"
                 "2024-01-01,NA,N/A,null,,NULL,PM2.5,NaN,n/a,valid\n")
    r = read_raw_csv(spark, str(p)).collect()[0]
    assert r.location is None and r.latitude is None and r.longitude is None
    assert r.site_type is None and r.zone is None and r.value is None and r.unit is None


def test_header_order_binds_by_name(spark, tmp_data_dir):
    p = tmp_data_dir["landing"] / "reordered.csv"
    p.write_text("value,date,location,latitude,longitude,site_type,zone,pollutant_type,unit,status\n"
                 "12.5,2024-01-01,London,51.5,-0.12,urban,south,PM2.5,ug,valid\n")
    r = read_raw_csv(spark, str(p)).collect()[0]
    assert r.value == 12.5 and r.date == "2024-01-01" and r.latitude == 51.5


def test_non_numeric_token_fails(spark, tmp_data_dir):
    p = tmp_data_dir["landing"] / "bad.csv"
    p.write_text("date,location,latitude,longitude,site_type,zone,pollutant_type,value,unit,status\n"
                 "2024-01-01,London,north,-0.12,urban,south,PM2.5,1,ug,valid\n")
    with pytest.raises(Exception, match="could not convert"):
        read_raw_csv(spark, str(p)).collect()


def test_infinity_is_a_number(spark, tmp_data_dir):
    p = tmp_data_dir["landing"] / "inf.csv"
    p.write_text("date,location,latitude,longitude,site_type,zone,pollutant_type,value,unit,status\n"
                 "2024-01-01,London,51.5,-0.12,urban,south,PM2.5,Infinity,ug,valid\n")
    assert read_raw_csv(spark, str(p)).collect()[0].value == float("inf")


def test_missing_required_column_raises(spark, tmp_data_dir):
    p = tmp_data_dir["landing"] / "short.csv"
    p.write_text("date,location\n2024-01-01,London\n")
    with pytest.raises(ValueError, match="required"):
        read_raw_csv(spark, str(p))


def test_many_files_one_read(spark, sample_raw_csv, tmp_data_dir):
    src, rows = sample_raw_csv
    second = tmp_data_dir["landing"] / "weather_raw_2.csv"
    second.write_text(src.read_text(encoding="utf-8"), encoding="utf-8")
    df = read_raw_csv(spark, str(tmp_data_dir["landing"] / "*.csv"))
    counts = {r.source_file: r["count"] for r in df.groupBy("source_file").count().collect()}
    assert counts == {"weather_raw.csv": len(rows), "weather_raw_2.csv": len(rows)}


def test_files_of_unlike_headers_are_bound_by_name(spark, tmp_path):
    names = HEADER.split(",")
    order = list(reversed(range(len(names))))
    (tmp_path / "a.csv").write_text(HEADER + "\n" + ",".join(map(str, RAW_ROWS[0])) + "\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text(",".join(names[i] for i in order) + "\n" + ",".join(str(RAW_ROWS[1][i]) for i in order) + "\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text(HEADER + ",station\n" + ",".join(map(str, RAW_ROWS[2])) + ",S1\n", encoding="utf-8")
    got = {r.source_file: r for r in read_raw_csv(spark, str(tmp_path / "*.csv")).collect()}
    for name, row in zip(("a.csv", "b.csv", "c.csv"), RAW_ROWS, strict=False):
        assert tuple(got[name][n] for n in names) == row
    assert got["c.csv"].station == "S1" and got["a.csv"].station is None


@pytest.mark.parametrize("token", ["5d", "5f", "5.D", "x"])
def test_suffixed_numbers_are_not_numbers(spark, tmp_path, token):
    bad = list(RAW_ROWS[0])
    bad[7] = token
    (tmp_path / "a.csv").write_text(HEADER + "\n" + ",".join(map(str, bad)) + "\n", encoding="utf-8")
    with pytest.raises(Exception, match="could not convert"):
        read_raw_csv(spark, str(tmp_path / "a.csv")).collect()
