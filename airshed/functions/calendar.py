"""Calendar expressions: report dates, windows of days, weekday and season labels."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from airshed.functions import labels as L


def as_of_col(as_of) -> Column:
    """The reporting date as a Column.

    ``None`` means today (``current_date()``); a ``date`` or ISO string becomes
    a literal, which Spark folds into a pushed-down scan filter; a Column (for
    instance a scalar subquery such as ``max(date)``) is used as is.
    """
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.date()
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def last_days(date_col: Column | str, as_of, days: int) -> Column:
    """``date >= as_of - days`` (inclusive, so days + 1 calendar dates up to as_of)."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return c >= F.date_sub(as_of_col(as_of), days)


def last_months(date_col: Column | str, as_of, months: int) -> Column:
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return c >= F.add_months(as_of_col(as_of), -months)


def weekday_name(dow: Column) -> Column:
    """Name for ``dayofweek`` numbers (Sunday = 1)."""
    expr = None
    for num, name in enumerate(L.WEEKDAY_NAMES, start=1):
        expr = F.when(dow == num, name) if expr is None else expr.when(dow == num, name)
    return expr


def weekend_flag(dow: Column) -> Column:
    return F.when(dow.isin(*L.WEEKEND_DAYS), L.WEEKEND).otherwise(L.WEEKDAY)


def season(month: Column) -> Column:
    expr = None
    for name, months in L.SEASONS:
        cond = month.isin(*months)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr


def policy_day_label(dow: Column) -> Column:
    expr = None
    for num, name in L.POLICY_DAY_LABELS:
        expr = F.when(dow == num, name) if expr is None else expr.when(dow == num, name)
    return expr
