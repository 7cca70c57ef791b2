"""Incremental loads, retention, and month-wise Gold refresh."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.functions.calendar import as_of_col
from airshed.operators.gold import daily_gold
from airshed.schema import GOLD_KEYS
from airshed.sources.layers_io import (MONTH, drop_partition, month_of, path_exists, read_by_month,
                                       write_by_month)

MARK_SCHEMA = T.StructType([
    T.StructField("pipeline_name", T.StringType(), False),
    T.StructField("last_date", T.DateType(), True),
    T.StructField("recorded_at", T.TimestampType(), True),
])


def since_mark(df: DataFrame, mark, as_of=None, date_col: str = "date") -> DataFrame:
    """Rows after the last processed date and up to the report date:
    ``mark < date <= as_of``. A NULL mark (first run) takes everything up to as_of; a NULL date is never taken.
    Rows that arrive late, with a date up to the mark, are not taken; a refresh of their
    month (``refresh_gold``) or the stream (``streaming.gold_refresh``) takes them in."""
    d = F.col(date_col)
    m = as_of_col(mark) if mark is not None else F.lit(None).cast("date")
    return df.filter((m.isNull() | (d > m)) & (d <= as_of_col(as_of)))


def read_mark(spark: SparkSession, path: str, pipeline: str = "main"):
    """The high-water mark of one pipeline, the last recorded, as a scalar-subquery
    Column (NULL if none). Only a missing mark table means a first run; any other error is raised."""
    if not path_exists(spark, path):
        return F.lit(None).cast("date")
    marks = spark.read.schema(MARK_SCHEMA).parquet(path)
    return marks.filter(F.col("pipeline_name") == pipeline).agg(F.max_by("last_date", "recorded_at")).scalar()


def default_load_id(spark: SparkSession, path: str, pipeline: str = "main") -> str:
    """The name of the load that starts at the pipeline's last recorded mark: a failed run is repeated
    under the same name, and a run after the next recorded mark has another, however soon it follows."""
    if path_exists(spark, path):
        marks = spark.read.schema(MARK_SCHEMA).parquet(path).filter(F.col("pipeline_name") == pipeline)
        last = marks.agg(F.max_by(F.struct("last_date", F.unix_micros("recorded_at").alias("at")), "recorded_at").alias("m")).first()["m"]
        if last is not None:
            return f"load-{pipeline}-after-{last['last_date']}-{last['at']}"
    return f"load-{pipeline}-first"


def write_mark(spark: SparkSession, loaded: DataFrame, path: str, pipeline: str = "main",
               date_col: str = "date", undated: bool = False) -> None:
    """Record ``max(date)`` of what was just loaded as the pipeline's mark.

    The mark table only grows, by one row for each load; nothing of it is ever
    rewritten, so a failed write loses no mark of this or another pipeline. A load without rows records nothing, and
    one of rows without a date only with ``undated`` (a NULL mark: everything is still to be loaded).
    """
    some = F.count(F.lit(1)) if undated else F.count(date_col)
    new = loaded.agg(F.max(date_col).alias("last_date"), some.alias("n")).filter("n > 0").select(
        F.lit(pipeline).alias("pipeline_name"), "last_date", F.lit(_dt.datetime.now()).cast("timestamp").alias("recorded_at"))
    new.coalesce(1).write.mode("append").parquet(path)


def retention_split(df: DataFrame, days: int, as_of=None, date_col: str = "date"):
    """(keep, expire): rows from the last ``days`` days up to as_of, and older rows."""
    cutoff = F.date_sub(as_of_col(as_of), days)
    d = F.col(date_col)
    return df.filter(d >= cutoff), df.filter(d < cutoff)


def expire_months(spark: SparkSession, path: str, days: int, as_of: _dt.date) -> list[int]:
    """Remove the month folders of a layer that lie wholly before the last
    ``days`` days; returns them. Rows of the month the cutoff falls into stay."""
    cutoff = as_of - _dt.timedelta(days=days)
    first = cutoff.year * 100 + cutoff.month
    old = [r[0] for r in spark.read.parquet(path).filter(F.col(MONTH) < first).select(MONTH).distinct().collect()]
    for month in old:
        drop_partition(spark, path, MONTH, month)
    return sorted(old)


def touched_months(rows: DataFrame) -> list[int]:
    """The months of a frame's dates: twelve values a year, whatever its rows."""
    return sorted(r[0] for r in rows.select(month_of("date").alias(MONTH)).distinct().collect() if r[0] is not None)


def refresh_gold(spark: SparkSession, silver_path: str, months: list[int], gold_path: str) -> None:
    """Recompute Gold for the given months from all Silver rows of those months
    and replace just these month folders.

    The months are a literal filter on the folder column, so only those folders of
    Silver are read. A month that has no Silver rows any more loses its Gold folder. Late rows for
    an old day need no streaming state: their month is computed again.
    """
    if not months:
        return
    silver = read_by_month(spark, silver_path, months)
    kept = touched_months(silver.dropna(subset=list(GOLD_KEYS)))
    if kept:
        write_by_month(daily_gold(silver), gold_path, list(GOLD_KEYS), replace_months=True)
    for month in set(months) - set(kept):
        drop_partition(spark, gold_path, MONTH, month)
