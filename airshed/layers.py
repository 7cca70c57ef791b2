"""Batch run of the layers: raw -> Bronze -> Silver (+ quarantine) -> Gold.

Each stage is a pure DataFrame function (``airshed.operators``); this module
is the thin read/write shell around them. Row counts are collected with
``observe`` while each layer is written, so no stage is scanned twice just to
count it. The run log (one row per stage) replaces the HTTP status bodies of
the hosted version.
"""

from __future__ import annotations

import datetime as _dt
import os
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.functions import labels as L
from airshed.operators import clean
from airshed.operators.checks import schema_diff
from airshed.operators.gold import daily_gold
from airshed.schema import BRONZE_SCHEMA, GOLD_KEYS
from airshed.sources.csv_ingest import read_raw_csv, to_bronze
from airshed.sources.incremental import (default_load_id, read_mark, refresh_gold, since_mark, touched_months,
                                         write_mark)
from airshed.sources.layers_io import (BATCH_LOAD, LOAD, MONTH, drop_partition, partition_folder, partitions_with_load,
                                       path_exists, read_layer, write_by_month, write_layer, write_partitions)


@dataclass(frozen=True)
class LayerPaths:
    root: str

    @property
    def bronze(self) -> str:
        return os.path.join(self.root, "bronze")

    @property
    def silver(self) -> str:
        return os.path.join(self.root, "silver")

    @property
    def quarantine(self) -> str:
        return os.path.join(self.root, "quarantine")

    @property
    def gold(self) -> str:
        return os.path.join(self.root, "gold")


RUN_LOG_SCHEMA = "stage string, status string, rows bigint, output_path string, error string"


def write_bronze(spark: SparkSession, raw: DataFrame, path: str,
                 run_ts: _dt.datetime | None = None) -> int:
    obs = Observation("bronze")
    rows = to_bronze(raw, run_ts).observe(obs, F.count(F.lit(1)).alias("rows"))
    write_layer(rows.withColumn(LOAD, F.lit(BATCH_LOAD)), path, [LOAD])
    return obs.get["rows"]


def _bronze(spark: SparkSession, path: str) -> DataFrame:
    """Bronze with all columns of all its loads (a column that a load lacks is NULL in its rows; types that differ between loads raise). Declared columns have to be there with their
    types (``schema_diff``); undeclared ones go through to Silver."""
    bronze = read_layer(spark, path, merge=True).drop(LOAD)
    wrong = [r for r in schema_diff(spark, bronze.schema, BRONZE_SCHEMA).collect() if r["problem"] != "unexpected"]
    if wrong:
        raise ValueError(f"{path} differs from the declared schema: {[(r['column'], r['problem']) for r in wrong]}")
    return bronze


def write_silver(spark: SparkSession, bronze_path: str, silver_path: str, quarantine_path: str,
                 run_date: _dt.date | None = None, rules=None, load_id: str = BATCH_LOAD,
                 bronze: DataFrame | None = None, replace_load: bool = False) -> tuple[int, int]:
    bronze = _bronze(spark, bronze_path) if bronze is None else bronze
    run_date = run_date or _dt.date.today()
    s_obs, q_obs = Observation("silver"), Observation("quarantine")
    write_by_month(clean.to_silver(bronze, rules).observe(s_obs, F.count(F.lit(1)).alias("rows")),
                   silver_path, ["date"], load_id, replace_months=replace_load)
    q = clean.to_quarantine(bronze, rules, run_date=run_date).withColumn(LOAD, F.lit(load_id))
    # one folder per run date and load; a rerun of the same load and day replaces its own folder only
    write_partitions(q.observe(q_obs, F.count(F.lit(1)).alias("rows")), quarantine_path, ["run_date", LOAD])
    stale = set(partitions_with_load(spark, quarantine_path, "run_date", load_id)) if replace_load else {run_date.isoformat()}
    if _observed(q_obs):  # else nothing was written, so nothing was replaced either
        stale -= {run_date.isoformat()}
    for day in stale:  # with replace_load also of another day, on which the same load had failed
        drop_partition(spark, quarantine_path, "run_date", day, LOAD, load_id)
    return _observed(s_obs), _observed(q_obs)


def _observed(obs: Observation) -> int:
    """The observed rows of a finished write. Where there are none, adaptive execution
    may replace the plan by an empty one, whose observation has no value."""
    try:
        return obs.get["rows"]
    except Py4JJavaError as e:
        if e.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return 0


def write_gold(spark: SparkSession, silver_path: str, gold_path: str) -> int:
    silver = read_layer(spark, silver_path)
    obs = Observation("gold")
    write_by_month(daily_gold(silver).observe(obs, F.count(F.lit(1)).alias("rows")), gold_path, list(GOLD_KEYS))
    return obs.get["rows"]


def run_incremental(spark: SparkSession, paths: LayerPaths, raw: DataFrame, mark_path: str, pipeline: str = "main",
                    as_of=None, load_id: str | None = None, run_date: _dt.date | None = None, rules=None) -> list[int]:
    """Load the rows after the pipeline's mark, up to ``as_of``, and refresh Gold for
    the months they touch; returns these months.

    Bronze keeps each load in a folder of its own, named after the mark that the load starts at
    (``default_load_id``) or by a ``load_id`` that no recorded load has had. The mark is recorded last: a run
    that failed is repeated under the same ``load_id`` and replaces what it had written. ``raw`` is the source as
    it stands. Rows up to the mark are not part of the load (see ``since_mark``); rows whose date does not
    parse have no place before or after a mark and go to Bronze and quarantine with the first load that
    sees them (``new_undated``).
    """
    load_id = load_id or default_load_id(spark, mark_path, pipeline)
    mark = read_mark(spark, mark_path, pipeline)
    dated = raw.withColumn("_date", clean.parse_date("date"))
    rows = since_mark(dated, mark, as_of, "_date").drop("_date").unionByName(
        new_undated(spark, dated.filter("_date IS NULL").drop("_date"), paths.bronze, load_id))
    run_ts = _dt.datetime.now()
    write_partitions(to_bronze(rows, run_ts).withColumn(LOAD, F.lit(load_id)), paths.bronze, [LOAD])
    if not path_exists(spark, f"{paths.bronze}/{partition_folder(spark, LOAD, load_id)}"):
        return []
    # the load's folder alone: a column that the source has gained is in its files, and not in those of earlier loads
    bronze = spark.read.parquet(f"{paths.bronze}/{partition_folder(spark, LOAD, load_id)}")
    # without rows the write replaces nothing, and the folder may hold those of a failed run
    if bronze.filter(F.col("ingestion_timestamp") == F.lit(run_ts).cast("timestamp")).isEmpty():
        return []  # nothing after the mark, and no new row without a date
    write_silver(spark, paths.bronze, paths.silver, paths.quarantine, run_date, rules, load_id, bronze, replace_load=True)
    months = [int(m) for m in partitions_with_load(spark, paths.silver, MONTH, load_id)]
    kept = touched_months(clean.to_silver(bronze, rules))
    for month in set(months) - set(kept):  # written by a failed run of this load whose rows reached further
        drop_partition(spark, paths.silver, MONTH, month, LOAD, load_id)
    refresh_gold(spark, paths.silver, months, paths.gold)
    loaded = bronze.select(F.coalesce(clean.parse_date("date"), mark).alias("date"))
    write_mark(spark, loaded, mark_path, pipeline, undated=True)
    return months


def new_undated(spark: SparkSession, undated: DataFrame, bronze_path: str, load_id: str) -> DataFrame:
    """The rows without a date that no other load has brought to Bronze yet.

    Equal rows are counted: of n in the source and m in Bronze, n - m are new. The
    file a row came from is part of it, so equal rows of two files are both taken.
    """
    if not path_exists(spark, bronze_path):
        return undated
    # Bronze under the source's columns: a column that the source has gained is NULL in older loads
    columns = T.StructType([T.StructField(f.name, f.dataType) for f in undated.schema] + [T.StructField(LOAD, T.StringType())])
    before = spark.read.schema(columns).parquet(bronze_path).filter(
        (F.col(LOAD) != load_id) & clean.parse_date("date").isNull()).drop(LOAD)
    return undated.exceptAll(before)


def run_layers(spark: SparkSession, paths: LayerPaths, raw: DataFrame | None = None,
               csv_input=None, run_date: _dt.date | None = None) -> DataFrame:
    """Run all stages; returns the run log. Stops at the first failing stage,
    which is logged with its error (later stages are not attempted)."""
    log = []
    stage = "bronze"
    try:
        if raw is None:
            raw = read_raw_csv(spark, csv_input)
            if raw.isEmpty():
                raise ValueError(f"no rows in {csv_input}")
        log.append((stage, "success", write_bronze(spark, raw, paths.bronze), paths.bronze, None))
        stage = "silver"
        s_rows, q_rows = write_silver(spark, paths.bronze, paths.silver, paths.quarantine, run_date)
        log.append((stage, "success", s_rows, paths.silver, None))
        log.append(("quarantine", "success", q_rows, paths.quarantine, None))
        stage = "gold"
        log.append((stage, "success", write_gold(spark, paths.silver, paths.gold), paths.gold, None))
    except Exception as e:  # the run log records the failure, then it is re-raised by the caller's choice
        log.append((stage, "error", None, None, f"{type(e).__name__}: {e}"))
    return spark.createDataFrame(log, RUN_LOG_SCHEMA)


def as_run_history(log: DataFrame, pipeline: str = "main", finished: _dt.datetime | None = None) -> DataFrame:
    """A run log as one row of run history, as ``plans.runs`` reads it: Failed if
    any stage failed. Append it to the run table after each run."""
    failed = F.bool_or(F.col("status") != "success")
    return log.agg(F.when(failed, L.RUN_FAILED).otherwise(L.RUN_SUCCEEDED).alias("status")).select(
        F.lit(pipeline).alias("pipeline_name"), "status",
        F.lit(finished or _dt.datetime.now()).cast("timestamp").alias("time_generated"))
