"""Small helpers shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.functions.calendar import last_days


def latest_date(gold: DataFrame) -> Column:
    """``(SELECT max(date) FROM gold)`` as a scalar subquery Column."""
    return gold.agg(F.max("date")).scalar()


def window_days(gold: DataFrame, as_of, days: int) -> DataFrame:
    """Rows of the last ``days`` days up to ``as_of`` (inclusive lower bound)."""
    return gold.filter(last_days("date", as_of, days))


def count_rows() -> Column:
    return F.count(F.lit(1))


def count_few(col: str) -> Column:
    """``COUNT(DISTINCT col)`` for a column of few values (pollutants, the days of a
    bounded window): the set itself is the partial result, so no row is expanded."""
    return F.size(F.collect_set(col)).cast("bigint")
