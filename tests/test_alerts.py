"""Alert episodes, and stream state that lives over several micro-batches."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from airshed.streaming import alerts


def at(minutes, seconds=0):
    return dt.datetime(2024, 1, 1, 10) + dt.timedelta(minutes=minutes, seconds=seconds)


def write(spark, path, events):
    rows = [(i, t, u, kind, 0.0) for i, t, u, kind in events]
    spark.createDataFrame(rows, alerts.EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def run(spark, tmp_path):
    landed, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def once(events, make):
        write(spark, landed, events)
        name = F.concat(F.lit("p"), F.col("user_id").cast("string"))
        make(alerts.runs_stream(spark, landed, name)).writeStream.format("parquet").option("checkpointLocation", state) \
            .trigger(availableNow=True).start(out).awaitTermination()
        return spark.read.schema(make(alerts.runs_stream(spark, landed, name)).schema).parquet(out)
    return once


def test_an_alert_opens_goes_on_and_closes(run):
    def failures(minutes, user=1):
        return [(m, at(m), user, "error") for m in minutes]
    assert run(failures([0, 3]) + [(90, at(1), 1, "click")], alerts.alert_episodes).count() == 0  # open
    run(failures([12], 2) + failures([8]), alerts.alert_episodes)  # exactly five minutes after: goes on
    run(failures([14, 11]) + failures([17], 2), alerts.alert_episodes)  # out of order
    run(failures([25, 30], 2), alerts.alert_episodes)
    out = run([(99, at(1000), 9, "error")], alerts.alert_episodes)
    assert Counter((r["pipeline_name"], r["opened_at"], r["last_failure"], r["closed_at"], r["failed_runs"]) for r in out.collect()) == Counter([
        ("p1", at(0), at(14), at(19), 5), ("p2", at(12), at(17), at(22), 2), ("p2", at(25), at(30), at(35), 2)])


def test_a_late_failure_joins_two_open_episodes(run):
    run([(1, at(0), 1, "error"), (2, at(8), 1, "error")], alerts.alert_episodes)
    run([(3, at(4), 1, "error")], alerts.alert_episodes)
    out = run([(99, at(1000), 9, "error")], alerts.alert_episodes)
    assert [(r["opened_at"], r["closed_at"], r["failed_runs"]) for r in out.collect()] == [(at(0), at(13), 3)]


def test_duplicates_in_a_later_run_are_suppressed(run):
    first = [(1, at(0), 1, "error"), (2, at(1), 1, "click")]
    run(first, alerts.drop_duplicate_runs)
    run(first + [(3, at(2), 1, "click")], alerts.drop_duplicate_runs)
    assert Counter(r["event_id"] for r in run(first, alerts.drop_duplicate_runs).collect()) == Counter([1, 2, 3])
