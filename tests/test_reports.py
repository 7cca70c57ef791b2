"""Hand-computed answers of the reports on a small Gold table with edge cases:
exact limits (12, 35.4, 100, 200), a gap day, a previous value of 0, a third
pollutant without a band, a one-row series, a constant series, a location
reported under two zones."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest

from airshed.plans import (calendar_reports as cal, compliance, forecast, levels, locations,
                           quality, stats, summary)
from airshed.schema import GOLD_SCHEMA

AS_OF = dt.date(2024, 3, 31)


def d(day, month=3):
    return dt.date(2024, month, day)


def g(day, loc, pol, zone, v, month=3):
    return (d(day, month), loc, pol, zone, float(v), float(v), float(v), 1)


LONDON_PM = [(25, 10.0), (26, 12.0), (27, 12.0), (28, 35.4), (29, 40.0), (31, 20.0)]
LONDON_NO2 = [(28, 250.0), (29, 0.0), (30, 100.0), (31, 200.0)]
ROWS = ([g(day, "London", "PM2.5", "south", v) for day, v in LONDON_PM]
        + [g(day, "London", "NO2", "south", v) for day, v in LONDON_NO2]
        + [g(31, "Paris", "O3", "west", 50.0)]
        + [g(day, "Berlin", "PM2.5", "east", 5.0) for day in (29, 30, 31)]
        + [g(31, "Madrid", "PM2.5", "south", 30.0), g(31, "Madrid", "PM2.5", "west", 32.0)])


@pytest.fixture(scope="module")
def gold(spark):
    return spark.createDataFrame(ROWS, GOLD_SCHEMA).cache()


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_current_levels_bands(gold):
    out = rows(levels.current_levels(gold), "location", "pollutant_type", "avg_level", "health_status")
    assert out == [("Berlin", "PM2.5", 5.0, "HEALTHY"), ("London", "NO2", 200.0, "MODERATE"),
                   ("London", "PM2.5", 20.0, "MODERATE"), ("Madrid", "PM2.5", 30.0, "MODERATE"),
                   ("Madrid", "PM2.5", 32.0, "MODERATE"), ("Paris", "O3", 50.0, "HEALTHY")]


def test_daily_trend(gold):
    out = {(r.location, r.pollutant_type, r.date): (r.previous_day_avg, r.percent_change, r.trend)
           for r in levels.daily_trend(gold, as_of=AS_OF).collect()}
    assert out[("London", "PM2.5", d(25))] == (None, None, "STABLE")
    assert out[("London", "PM2.5", d(26))] == (10.0, 20.0, "WORSENING")
    assert out[("London", "PM2.5", d(27))] == (12.0, 0.0, "STABLE")
    assert out[("London", "PM2.5", d(29))] == (35.4, 12.99, "WORSENING")
    assert out[("London", "PM2.5", d(31))] == (40.0, -50.0, "IMPROVING")
    assert out[("London", "NO2", d(29))] == (250.0, -100.0, "IMPROVING")
    assert out[("London", "NO2", d(30))] == (0.0, None, "WORSENING")  # previous value 0


def test_daily_trend_window_is_inclusive(gold):
    # as_of - 7 .. as_of: 2024-03-24 .. 2024-03-31, all 16 rows
    assert levels.daily_trend(gold, as_of=AS_OF).count() == len(ROWS)
    assert levels.daily_trend(gold, as_of=d(31), days=2).filter("date < '2024-03-29'").count() == 0


def test_missing_series_days(gold):
    out = rows(quality.missing_series_days(gold, as_of=AS_OF), "location", "pollutant_type", "date", "days_ago")
    expect = [("London", "PM2.5", d(30), 1)]
    expect += [("London", "NO2", d(x), 31 - x) for x in (25, 26, 27)]
    expect += [("Paris", "O3", d(x), 31 - x) for x in range(25, 31)]
    expect += [("Berlin", "PM2.5", d(x), 31 - x) for x in range(25, 29)]
    expect += [("Madrid", "PM2.5", d(x), 31 - x) for x in range(25, 31)]
    assert out == sorted(expect)


def test_missing_series_days_only_observed_dates(spark):
    # 03-02 is observed nowhere: it is not "missing" for anyone
    r = [g(1, "A", "NO2", "z", 1), g(3, "A", "NO2", "z", 1), g(1, "B", "NO2", "z", 1)]
    out = rows(quality.missing_series_days(spark.createDataFrame(r, GOLD_SCHEMA), as_of=d(3)),
               "location", "date")
    assert out == [("B", d(3))]


def test_days_over_limit_inclusive_band(gold):
    out = {(r.location, r.pollutant_type): (r.unhealthy_days, r.moderate_days, r.total_days_tracked,
                                            r.exceedance_percent)
           for r in compliance.days_over_limit(gold, as_of=AS_OF).collect()}
    assert out[("London", "PM2.5")] == (1, 4, 6, 16.67)
    assert out[("London", "NO2")] == (1, 2, 4, 25.0)
    assert out[("Paris", "O3")] == (0, 0, 1, 0.0)


def test_compliance_status(gold):
    r = compliance.compliance_status(gold, as_of=AS_OF).collect()[0]
    assert (r.report_date, r.locations_monitored, r.data_days, r.compliance_rate, r.violation_days,
            r.compliance_status) == (AS_OF, 4, 7, 68.75, 2, "NON-COMPLIANT")


def test_location_scorecard(gold):
    out = {(r.location, r.zone): (r.pm25_avg, r.no2_avg, r.air_quality_grade)
           for r in locations.location_scorecard(gold, as_of=AS_OF).collect()}
    assert out[("London", "south")] == (21.57, 137.5, "MODERATE")
    assert out[("Paris", "west")] == (None, None, "GOOD")
    assert out[("Berlin", "east")] == (5.0, None, "GOOD")
    assert out[("Madrid", "west")] == (32.0, None, "MODERATE")


def test_volatility_levels(gold):
    out = {(r.location, r.pollutant_type): (r.std_dev, r.coefficient_of_variation, r.volatility_level)
           for r in forecast.volatility(gold, as_of=AS_OF).collect()}
    assert out[("Paris", "O3")] == (None, None, "VOLATILE")
    assert out[("Berlin", "PM2.5")] == (0.0, 0.0, "STABLE")


def test_trend_slope(gold):
    out = {(r.location, r.pollutant_type): (r.data_points, r.trend_slope, r.trend_direction)
           for r in forecast.trend_slope(gold, as_of=AS_OF).collect()}
    slope = np.polyfit(np.arange(1, 7), [v for _, v in LONDON_PM], 1)[0]
    assert out[("London", "PM2.5")] == (6, round(slope, 4), "INCREASING")
    assert out[("Berlin", "PM2.5")] == (3, 0.0, "STABLE")
    assert out[("Paris", "O3")] == (1, None, "STABLE")
    # the location in two zones has two rows on one day: day index 1 and 2
    assert out[("Madrid", "PM2.5")] == (2, 2.0, "INCREASING")


def test_location_ranking(gold):
    out = rows(locations.location_ranking(gold, as_of=AS_OF), "ranking", "pollutant_type", "rank", "location", "zone")
    pm_clean = [r[3:] for r in out if r[0] == "CLEANEST" and r[1] == "PM2.5"]
    pm_dirty = [r[3:] for r in out if r[0] == "DIRTIEST" and r[1] == "PM2.5"]
    assert pm_clean == [("Berlin", "east"), ("London", "south"), ("Madrid", "south"), ("Madrid", "west")]
    assert pm_dirty == list(reversed(pm_clean))
    assert len(out) == 12


def test_location_ranking_top_k(spark):
    r = [g(31, f"L{i:02d}", "NO2", "z", i) for i in range(12)]
    out = rows(locations.location_ranking(spark.createDataFrame(r, GOLD_SCHEMA), as_of=AS_OF),
               "ranking", "rank", "location")
    assert out == sorted([("CLEANEST", k + 1, f"L{k:02d}") for k in range(5)]
                         + [("DIRTIEST", k + 1, f"L{11 - k:02d}") for k in range(5)])


def test_executive_summary(gold):
    out = {r.metric: (r.status, r.percentage) for r in summary.executive_summary(gold, as_of=AS_OF).collect()}
    assert out == {"Overall Health": ("NEEDS ATTENTION", 62.5),
                   "Highest Risk Location": ("London", 67.94),
                   "Days Over Limit (Last 30d)": ("4", None)}


def test_executive_summary_empty_window_keeps_three_rows(gold):
    out = summary.executive_summary(gold, as_of=d(1, 12)).collect()  # window starts in November
    assert [r.metric for r in out] == ["Overall Health", "Highest Risk Location", "Days Over Limit (Last 30d)"]
    assert out[1].status is None and out[2].status == "0"


def test_percentiles(spark):
    r = [g(day, "A", "NO2", "z", v) for day, v in zip(range(1, 6), [3, 1, 5, 2, 4])]
    r.append(g(6, "A", "NO2", "z", 3))
    gold = spark.createDataFrame(r, GOLD_SCHEMA)
    p = stats.percentile_profile(gold, as_of=d(6)).collect()[0]
    v = np.array([3, 1, 5, 2, 4, 3], dtype=float)
    assert (p.p10, p.p25, p.median, p.p75, p.p90, p.mean) == tuple(
        round(float(x), 2) for x in list(np.percentile(v, [10, 25, 50, 75, 90])) + [v.mean()])
    lit = stats.percentile_profile(gold, as_of=d(6), collapse=False).collect()
    assert len(lit) == 5 and lit[0].median == 3.0 and lit[0].mean == 3.0  # distinct values 1..5


def test_anomalies(spark):
    r = [g(day, "A", "NO2", "z", 10) for day in range(1, 11)] + [g(11, "A", "NO2", "z", 100)]
    out = stats.anomalies(spark.createDataFrame(r, GOLD_SCHEMA), as_of=d(11)).collect()
    assert len(out) == 1
    x = np.array([10.0] * 10 + [100.0])
    z = abs(100 - x.mean()) / x.std(ddof=1)
    assert out[0].date == d(11) and out[0].standard_deviations == round(z, 2)
    assert out[0].anomaly_status == "ANOMALY"


def test_anomalies_zero_stdev_vanishes(gold):
    assert stats.anomalies(gold, as_of=AS_OF).filter("location = 'Berlin'").count() == 0


def test_weekday_and_season_labels(gold):
    out = rows(cal.weekday_pattern(gold, as_of=AS_OF).filter("pollutant_type = 'O3'"),
               "day_of_week", "is_weekend")
    assert out == [("Sunday", "Weekend")]
    s = rows(cal.seasonal_levels(gold), "season", "year", "month")
    assert set(s) == {("Spring", 2024, 3)}


def test_month_over_month_previous_zero(spark):
    r = [g(1, "A", "NO2", "z", 0, month=1), g(1, "A", "NO2", "z", 10, month=2),
         g(1, "A", "NO2", "z", 15, month=3)]
    out = rows(cal.month_over_month(spark.createDataFrame(r, GOLD_SCHEMA)), "month", "previous_month_avg",
               "absolute_change", "percent_change")
    assert out == [(1, None, None, None), (2, 0.0, 10.0, None), (3, 10.0, 5.0, 50.0)]


def test_quarter_audit_range(gold):
    out = rows(compliance.quarter_audit(gold, as_of=AS_OF), "month", "data_days", "exceedance_days")
    assert out == [(d(1), 7, 5)]
    assert compliance.quarter_audit(gold, start="2024-04-01", end="2024-07-01").count() == 0


def test_health_alerts_and_latest_status(gold):
    assert rows(levels.health_alerts(gold, as_of=d(29)), "location", "pollutant_type") == [("London", "PM2.5")]
    st = rows(levels.latest_status(gold), "location", "pollutant_type", "status")
    assert ("London", "NO2", "UNHEALTHY") in st and ("Berlin", "PM2.5", "HEALTHY") in st


def test_top_exceedances_order_and_limit(gold):
    out = levels.top_exceedances(gold, n=3).collect()
    assert [(r.date, r.location, r.max_level) for r in out] == [
        (d(31), "London", 200.0), (d(31), "Madrid", 32.0), (d(31), "Madrid", 30.0)]


def test_sensor_failure_candidates(spark):
    r = [g(day, "A", "PM2.5", "z", 10) for day in range(1, 10)] + [g(10, "A", "PM2.5", "z", 100)]
    out = stats.sensor_failure_candidates(spark.createDataFrame(r, GOLD_SCHEMA)).collect()
    assert out[0].avg_value == 100.0 and out[0].rolling_30row_avg == 19.0
    assert out[0].alert == "LIKELY EQUIPMENT FAILURE"
    assert len(out) == 5


def test_policy_weekday_compare(gold):
    out = rows(cal.policy_weekday_compare(gold, as_of=AS_OF), "day", "avg_level")
    # NO2 rows: Thu 28 (250), Fri 29 (0), Sat 30 (100), Sun 31 (200)
    assert out == [("Friday", 0.0), ("Saturday", 100.0), ("Sunday", 200.0), ("Thursday", 250.0)]
    lit = rows(cal.policy_weekday_compare(gold, as_of=AS_OF, literal=True).fillna("-"), "day", "avg_level")
    assert lit == [("-", 100.0), ("-", 200.0), ("Friday", 0.0), ("Thursday", 250.0)]


def test_quality_summary_and_coverage(gold):
    q = quality.quality_summary(gold, as_of=AS_OF).collect()[0]
    assert (q.unique_days, q.unique_locations, q.pollutant_types, q.coverage_days, q.total_records) == (7, 4, 3, 7, 16)
    assert q.completion_rate == round(16 / (7 * 4 * 3), 4)
    cov = {r.location: (r.days_of_data, r.potential_days, r.coverage_percent)
           for r in quality.location_coverage(gold).collect()}
    assert cov["London"] == (7, 7, 100.0) and cov["Berlin"] == (3, 3, 100.0)


def test_zone_comparison_median(gold):
    out = {(r.zone, r.pollutant_type): (r.locations_in_zone, r.median)
           for r in locations.zone_comparison(gold, as_of=AS_OF).collect()}
    assert out[("south", "PM2.5")] == (2, 20.0)  # 10, 12, 12, 20, 30, 35.4, 40
    assert out[("west", "PM2.5")] == (1, 32.0)


def test_rounding_is_half_up_on_decimal(spark):
    r = [g(1, "A", "NO2", "z", 1.005), g(1, "A", "PM2.5", "z", 2.675)]
    out = rows(levels.current_levels(spark.createDataFrame(r, GOLD_SCHEMA)), "pollutant_type", "avg_level")
    assert out == [("NO2", 1.01), ("PM2.5", 2.68)]


def test_zone_comparison_median_is_the_exact_percentile(gold):
    from pyspark.sql import functions as F
    from airshed.functions.numeric import r2
    from airshed.plans.common import window_days
    got = rows(locations.zone_comparison(gold, as_of=AS_OF), "zone", "pollutant_type", "median")
    merged = window_days(gold, AS_OF, 90).groupBy("zone", "pollutant_type").agg(r2(F.percentile("avg_value", 0.5)).alias("median"))
    assert got == rows(merged, "zone", "pollutant_type", "median")


def test_infinite_values_are_not_rounded_away(spark):
    r = [g(1, "A", "NO2", "z", float("inf")), g(1, "B", "NO2", "z", 1e300)]
    out = rows(levels.current_levels(spark.createDataFrame(r, GOLD_SCHEMA)), "location", "avg_level")
    assert out == [("A", float("inf")), ("B", 1e300)]


def test_gaps_as_runs_hold_the_days(gold):
    from pyspark.sql import functions as F
    runs = quality.missing_series_runs(gold)
    days = runs.select("location", "pollutant_type", F.explode(F.sequence("gap_start", "gap_end")).alias("date"))
    observed = gold.select("date").distinct()
    assert rows(days.join(observed, "date"), "location", "pollutant_type", "date") == rows(
        quality.missing_series_days(gold, as_of=AS_OF), "location", "pollutant_type", "date")
    assert all(r.days == (r.gap_end - r.gap_start).days + 1 for r in runs.collect())


def test_reports_in_their_order(gold):
    from airshed.plans.order import REPORT_ORDER, in_report_order
    from airshed.plans.sql_reports import REPORT_SQL, run_report_sql
    slopes = [abs(r.trend_slope) for r in in_report_order(forecast.trend_slope(gold, as_of=AS_OF), "trend_slope").collect() if r.trend_slope is not None]
    assert len(slopes) > 1 and slopes == sorted(slopes, reverse=True)
    trend = [(r.location, r.pollutant_type, -r.date.toordinal()) for r in in_report_order(levels.daily_trend(gold, as_of=AS_OF), "daily_trend").collect()]
    assert trend == sorted(trend)
    assert set(REPORT_ORDER) <= set(REPORT_SQL)
    for name in REPORT_ORDER:
        text = run_report_sql(gold.sparkSession, gold, name, as_of=AS_OF, ordered=True)
        frame = in_report_order(run_report_sql(gold.sparkSession, gold, name, as_of=AS_OF), name)
        assert [tuple(r) for r in text.collect()] == [tuple(r) for r in frame.collect()], name


def test_quality_summary_approx(gold):
    a = quality.quality_summary(gold, as_of=AS_OF).first()
    b = quality.quality_summary(gold, as_of=AS_OF, approx=True).first()
    assert (a.unique_days, a.unique_locations, a.pollutant_types) == (b.unique_days, b.unique_locations, b.pollutant_types)


def test_daily_trend_warmup(gold):
    # window 03-29..03-31; with a warm-up the first day sees its real previous day
    cold = {(r.location, r.pollutant_type, r.date): r.previous_day_avg
            for r in levels.daily_trend(gold, as_of=AS_OF, days=2).collect()}
    warm = {(r.location, r.pollutant_type, r.date): r.previous_day_avg
            for r in levels.daily_trend(gold, as_of=AS_OF, days=2, warmup_days=5).collect()}
    assert set(cold) == set(warm)
    assert cold[("London", "PM2.5", d(29))] is None and warm[("London", "PM2.5", d(29))] == 35.4
    assert warm[("London", "NO2", d(29))] == 250.0


def test_anomalies_warmup(spark):
    r = [g(day, "A", "NO2", "z", 10 + (day % 2)) for day in range(1, 21)] + [g(21, "A", "NO2", "z", 100)]
    gold = spark.createDataFrame(r, GOLD_SCHEMA)
    cold = stats.anomalies(gold, as_of=d(21), days=1).collect()
    warm = stats.anomalies(gold, as_of=d(21), days=1, warmup_days=30).collect()
    assert cold == []  # two rows in the frame: no outlier by 1.5 sd
    assert [x.date for x in warm] == [d(21)] and warm[0].anomaly_status == "ANOMALY"
