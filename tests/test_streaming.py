"""Streaming forms: file landing, Gold kept current, sliding-window alerts,
duplicate suppression - each checked against its batch twin."""

from __future__ import annotations

import os
import shutil

import pytest
from pyspark.sql import functions as F

from airshed.operators.clean import to_silver
from airshed.operators.gold import daily_gold
from airshed.plans import runs as runmon
from airshed.sources import adapter
from airshed.sources.layers_io import read_by_month
from airshed.streaming import alerts, gold_refresh, landing
from tests.conftest import HEADER, RAW_ROWS, SF_SMALL


def _csv(path, rows, header=HEADER):
    with open(path, "w", encoding="utf-8") as f:
        f.write(header + "\n")
        for r in rows:
            f.write(",".join("" if v is None else str(v) for v in r) + "\n")


def _sorted(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_landing_to_bronze_exactly_once(spark, tmp_path):
    land, bronze, ckpt = tmp_path / "landing", tmp_path / "bronze", tmp_path / "ckpt"
    land.mkdir()
    _csv(land / "day1.csv", RAW_ROWS[:3])
    q = landing.start_landing_to_bronze(spark, str(land), str(bronze), str(ckpt))
    q.awaitTermination()
    assert spark.read.parquet(str(bronze)).count() == 3
    _csv(land / "day2.csv", RAW_ROWS[3:])
    q = landing.start_landing_to_bronze(spark, str(land), str(bronze), str(ckpt))
    q.awaitTermination()
    b = spark.read.parquet(str(bronze))
    assert b.count() == 6  # day1 not read again
    counts = {r.source_file: r["count"] for r in b.groupBy("source_file").count().collect()}
    assert counts == {"day1.csv": 3, "day2.csv": 3}
    assert dict(b.dtypes)["value"] == "double"


def test_landing_rejects_other_header_order(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    cols = HEADER.split(",")
    swapped = ",".join([cols[1], cols[0]] + cols[2:])
    _csv(land / "bad.csv", [(r[1], r[0]) + r[2:] for r in RAW_ROWS[:1]], header=swapped)
    q = landing.start_landing_to_bronze(spark, str(land), str(tmp_path / "b"), str(tmp_path / "c"))
    with pytest.raises(Exception):
        q.awaitTermination()


def test_gold_stream_equals_batch_and_absorbs_late_rows(spark, tmp_path):
    raw = adapter.raw_measurements(spark, SF_SMALL)
    bronze = raw.withColumn("ingestion_timestamp", F.current_timestamp()) \
        .withColumn("source_file", F.lit("lineitem"))
    # two months, so the date-partitioned tables stay small; bad dates included
    bronze = bronze.filter(F.col("date").between("1996-01-01", "1996-02-29") | (F.col("date") == "invalid-date"))
    early = bronze.filter(F.col("date") < "1996-02-01")
    late = bronze.filter(~(F.col("date") < "1996-02-01"))
    bdir, sdir, gdir, ckpt = (str(tmp_path / n) for n in ("bronze", "silver", "gold", "ckpt"))
    early.write.parquet(bdir)
    gold_refresh.start_bronze_to_gold(spark, bdir, sdir, gdir, ckpt).awaitTermination()
    late.write.mode("append").parquet(bdir)
    # a late row for an old day as well
    old_day = early.filter(F.col("date").startswith("1996-01-1")).limit(1)
    old_day.write.mode("append").parquet(bdir)
    gold_refresh.start_bronze_to_gold(spark, bdir, sdir, gdir, ckpt).awaitTermination()
    cols = ["date", "location", "pollutant_type", "zone", "avg_value", "max_value", "min_value", "record_count"]
    batch = daily_gold(to_silver(bronze.unionByName(old_day)))
    streamed = read_by_month(spark, gdir)
    assert _sorted(streamed, cols) == _sorted(batch, cols)


def test_failure_alert_stream_equals_batch(spark, tmp_path):
    # a file stream reads a folder: give the events file one
    ev = str(tmp_path / "events")
    os.makedirs(ev)
    shutil.copy(os.path.join(SF_SMALL, "events.parquet"), ev)
    stream = alerts.failure_alerts(alerts.runs_stream(spark, ev))
    q = (stream.writeStream.outputMode("complete").format("memory").queryName("failure_alerts_t")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("SELECT * FROM failure_alerts_t")
    batch = runmon.failure_windows(adapter.run_history(spark, SF_SMALL))
    cols = ["window_start", "window_end", "failed_runs"]
    norm = lambda rows: sorted((a.replace(tzinfo=None), b.replace(tzinfo=None), c) for a, b, c in rows)
    assert norm(_sorted(got, cols)) == norm(_sorted(batch, cols))
    assert got.count() > 0


def test_duplicate_suppression(spark, tmp_path):
    src = tmp_path / "events"
    ev = spark.read.parquet(os.path.join(SF_SMALL, "events.parquet")).limit(200)
    ev.unionByName(ev.limit(50)).write.parquet(str(src))
    s = alerts.drop_duplicate_runs(alerts.runs_stream(spark, str(src)))
    q = s.writeStream.format("memory").queryName("dedup_t").trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.sql("SELECT * FROM dedup_t")
    assert got.count() == got.select("event_id").distinct().count() == 200
