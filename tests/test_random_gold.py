"""Randomised cross-engine check: adversarial Gold tables (ties, a location
in two zones, gaps, exact limits, repeated values) through every Gold report
in Spark and through the oracle's report statements in DuckDB."""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from airshed.oracle import ORACLES
from airshed.plans import (calendar_reports as cal, compliance, forecast, levels, locations,
                           quality, stats, summary)
from airshed.schema import GOLD_SCHEMA

REPORTS = {
    "quality_summary": lambda g, d: quality.quality_summary(g, as_of=d),
    "location_coverage": lambda g, d: quality.location_coverage(g),
    "missing_series_days": lambda g, d: quality.missing_series_days(g, as_of=d),
    "current_levels": lambda g, d: levels.current_levels(g),
    "daily_trend": lambda g, d: levels.daily_trend(g, as_of=d),
    "top_exceedances": lambda g, d: levels.top_exceedances(g),
    "monthly_levels": lambda g, d: levels.monthly_levels(g),
    "location_ranking": lambda g, d: locations.location_ranking(g, as_of=d),
    "zone_comparison": lambda g, d: locations.zone_comparison(g, as_of=d),
    "location_scorecard": lambda g, d: locations.location_scorecard(g, as_of=d),
    "anomalies": lambda g, d: stats.anomalies(g, as_of=d),
    "percentile_profile": lambda g, d: stats.percentile_profile(g, as_of=d),
    "percentile_profile_literal": lambda g, d: stats.percentile_profile(g, as_of=d, collapse=False),
    "weekday_pattern": lambda g, d: cal.weekday_pattern(g, as_of=d),
    "seasonal_levels": lambda g, d: cal.seasonal_levels(g),
    "month_over_month": lambda g, d: cal.month_over_month(g),
    "days_over_limit": lambda g, d: compliance.days_over_limit(g, as_of=d),
    "compliance_status": lambda g, d: compliance.compliance_status(g, as_of=d),
    "volatility": lambda g, d: forecast.volatility(g, as_of=d),
    "trend_slope": lambda g, d: forecast.trend_slope(g, as_of=d),
    "executive_summary": lambda g, d: summary.executive_summary(g, as_of=d),
    "monthly_compliance": lambda g, d: compliance.monthly_compliance(g),
    "health_alerts": lambda g, d: levels.health_alerts(g, as_of=d),
    "quarter_audit": lambda g, d: compliance.quarter_audit(g, as_of=d),
    "policy_weekday_compare": lambda g, d: cal.policy_weekday_compare(g, as_of=d),
    "sensor_failure_candidates": lambda g, d: stats.sensor_failure_candidates(g),
    "latest_status": lambda g, d: levels.latest_status(g),
    "recent_levels": lambda g, d: levels.recent_levels(g, as_of=d),
    "rolling_stats": lambda g, d: stats.rolling_stats(g),
}

VALUES = [0.0, 5.0, 12.0, 12.5, 20.0, 35.4, 36.0, 40.0, 100.0, 150.0, 200.0, 250.0]


def random_gold(seed: int):
    rng = np.random.default_rng(seed)
    start = dt.date(2023, 10, 1)
    days = [start + dt.timedelta(days=int(x)) for x in sorted(rng.choice(200, 120, replace=False))]
    zones_of = {"L0": ["Z0"], "L1": ["Z0", "Z1"], "L2": ["Z1"], "L3": ["Z2"], "L4": ["Z2"], "L5": ["Z0"]}
    rows = []
    for loc, zones in zones_of.items():
        for pol in ("PM2.5", "NO2", "O3"):
            if rng.random() < 0.15:
                continue  # series absent
            for day in days:
                if rng.random() < 0.3:
                    continue  # gap
                for zone in zones:
                    if len(zones) > 1 and rng.random() < 0.5:
                        continue
                    avg = float(rng.choice(VALUES) if rng.random() < 0.6 else rng.integers(0, 300) / 2)
                    lo = avg - float(rng.integers(0, 5))
                    hi = avg + float(rng.integers(0, 5))
                    rows.append((day, loc, pol, zone, avg, hi, lo, int(rng.integers(1, 6))))
    return rows


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((x is None, str(type(x)) if not isinstance(x, (int, float)) else "n",
                  x if not isinstance(x, (int, float)) else float(x)) for x in row)


@pytest.mark.parametrize("seed", [1, 2])
def test_reports_equal_duckdb_on_random_gold(spark, seed):
    rows = random_gold(seed)
    gold = spark.createDataFrame(rows, GOLD_SCHEMA).cache()
    as_of = max(r[0] for r in rows)
    cols = list(zip(*rows))
    table = pa.table({
        "date": pa.array(cols[0], pa.date32()), "location": pa.array(cols[1]),
        "pollutant_type": pa.array(cols[2]), "zone": pa.array(cols[3]),
        "avg_value": pa.array(cols[4], pa.float64()), "max_value": pa.array(cols[5], pa.float64()),
        "min_value": pa.array(cols[6], pa.float64()), "record_count": pa.array(cols[7], pa.int64()),
    })
    con = duckdb.connect()
    con.register("gold_weather", table)
    failures = []
    for name, fn in REPORTS.items():
        df = fn(gold, as_of)
        got = sorted((tuple(_norm(v) for v in r) for r in df.collect()), key=_key)
        res = con.execute(ORACLES[name].over_gold())
        ocols = [d[0] for d in res.description]
        idx = [ocols.index(c) for c in df.columns]
        want = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=_key)
        if got != want:
            failures.append((name, len(got), len(want)))
    assert not failures
