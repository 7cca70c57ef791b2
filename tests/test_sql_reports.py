"""The SQL statements give the same rows as the DataFrame reports."""

from __future__ import annotations

import math

import pytest

from airshed import catalog
from airshed.plans import compliance, forecast, levels, locations, quality, summary
from airshed.schema import GOLD_SCHEMA
from airshed.plans.sql_reports import REPORT_SQL, run_report_sql
from tests.conftest import SF_SMALL
from tests.test_reports import AS_OF, ROWS

DF_REPORTS = {name: fn for name, fn in catalog.QUERIES.items() if name in REPORT_SQL}


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_report_has_a_statement():
    assert len(REPORT_SQL) == 21 and set(REPORT_SQL) == set(DF_REPORTS)


@pytest.mark.parametrize("name", sorted(REPORT_SQL))
def test_sql_equals_dataframe_on_driver_tables(spark, name):
    df = DF_REPORTS[name](spark, SF_SMALL)
    gold = catalog.gold_table(spark, SF_SMALL)
    sql = run_report_sql(spark, gold, name, as_of=catalog.report_date(gold))
    assert sql.columns == df.columns
    assert _norm(sql.collect()) == _norm(df.collect())


EDGE = {
    "daily_trend": lambda g: levels.daily_trend(g, as_of=AS_OF),
    "missing_series_days": lambda g: quality.missing_series_days(g, as_of=AS_OF),
    "location_scorecard": lambda g: locations.location_scorecard(g, as_of=AS_OF),
    "executive_summary": lambda g: summary.executive_summary(g, as_of=AS_OF),
    "volatility": lambda g: forecast.volatility(g, as_of=AS_OF),
    "trend_slope": lambda g: forecast.trend_slope(g, as_of=AS_OF),
    "location_ranking": lambda g: locations.location_ranking(g, as_of=AS_OF),
    "days_over_limit": lambda g: compliance.days_over_limit(g, as_of=AS_OF),
    "current_levels": lambda g: levels.current_levels(g),
}


@pytest.mark.parametrize("name", sorted(EDGE))
def test_sql_equals_dataframe_on_edge_cases(spark, name):
    gold = spark.createDataFrame(ROWS, GOLD_SCHEMA)
    df = EDGE[name](gold)
    sql = run_report_sql(spark, gold, name, as_of=AS_OF, view="gold_edge")
    assert sql.columns == df.columns
    assert _norm(sql.collect()) == _norm(df.collect())
