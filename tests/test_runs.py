"""Run-history monitoring on a hand-made run log."""

from __future__ import annotations

import datetime as dt

from airshed.plans import runs
from airshed.schema import RUNS_SCHEMA

NOW = dt.datetime(2024, 1, 1, 12, 0, 0)


def log(spark, spec):
    return spark.createDataFrame(
        [("main", status, NOW - dt.timedelta(minutes=m)) for m, status in spec], RUNS_SCHEMA)


def test_failure_rate_alerts_above_half(spark):
    spec = [(m, "Failed") for m in (0, 5, 10, 15, 20, 25)] + [(m, "Succeeded") for m in (30, 35, 40, 45)]
    spec += [(60, "Failed"), (90, "Succeeded")]  # exactly one hour back (excluded) and older
    r = runs.run_failure_rate(log(spark, spec)).collect()
    assert [(x.total_runs, x.failed_runs, x.failure_rate) for x in r] == [(10, 6, 60.0)]


def test_failure_rate_quiet_when_low(spark):
    spec = [(0, "Failed")] + [(m, "Succeeded") for m in (1, 2, 3)]
    assert runs.run_failure_rate(log(spark, spec)).count() == 0


def test_circuit_breaker(spark):
    spec = [(m, "Failed") for m in (0, 10, 20, 30, 60)] + [(61, "Failed")]
    r = runs.circuit_breaker(log(spark, spec)).collect()[0]
    assert (r.failure_count, r.should_proceed) == (5, False)  # >= now - 1h includes minute 60
    r = runs.circuit_breaker(log(spark, spec[:4])).collect()[0]
    assert (r.failure_count, r.should_proceed) == (4, True)


def test_failure_windows(spark):
    spec = [(0, "Failed"), (2, "Failed"), (30, "Succeeded")]
    out = runs.failure_windows(log(spark, spec)).collect()
    # each failure lies in 5 one-minute-aligned windows; they share 3
    assert len(out) == 7 and sum(r.failed_runs for r in out) == 10
    assert max(r.failed_runs for r in out) == 2
