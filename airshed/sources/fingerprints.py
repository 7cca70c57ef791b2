"""Incremental loads that take late, changed and withdrawn rows, by multiset fingerprints of months.

A month's rows are summed up, in any order, to their count and the sum and xor of their hashes. The source's fingerprints are compared with
those a ledger holds of Bronze; only months that differ are read from Bronze, and compared row by row as counted multisets.
Each such month gets a new folder in Bronze (month, load), and the ledger tells which folder is the month's own.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.functions.calendar import as_of_col
from airshed.operators import clean
from airshed.sources.csv_ingest import to_bronze
from airshed.sources.incremental import refresh_gold
from airshed.sources.layers_io import (LOAD, MONTH, drop_partition, month_of, partition_folder, partitions_with_load, path_exists,
                                       remove_folder, subfolders, write_by_month, write_partitions)

#: The month of rows whose date does not parse.
UNDATED = 0
METADATA = ("ingestion_timestamp", "source_file")
LEDGER_SCHEMA = "seq long, load_id string, month int, n long, total decimal(38,0), parity long"
#: Equal rows that one task writes out of a counted one.
COPIES = 1 << 16


def row_hash(columns: list[str]) -> Column:
    """A hash of a row's values; a mask of the NULLs tells them from values that are left out."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(nulls, *[F.col(c) for c in columns])


def source_month() -> Column:
    return F.coalesce(month_of(clean.parse_date("date")), F.lit(UNDATED)).cast("int")


def fingerprints(rows: DataFrame, columns: list[str]) -> DataFrame:
    """month, n, total and parity of ``rows`` (with a ``month``): one partial row for each month and task is shuffled."""
    h = row_hash(columns)
    return rows.groupBy(MONTH).agg(F.count("*").alias("n"), F.sum(h.cast("decimal(20,0)")).cast("decimal(38,0)").alias("total"), F.bit_xor(h).alias("parity"))


def current_months(spark: SparkSession, ledger: str) -> DataFrame:
    """The last entry of each month in the ledger; a month that the source has lost has n = 0."""
    if not path_exists(spark, ledger):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    entries = spark.read.schema(LEDGER_SCHEMA).parquet(ledger)
    last = F.max_by(F.struct("seq", LOAD, "n", "total", "parity"), "seq").alias("last")
    return entries.groupBy(MONTH).agg(last).select("last.seq", f"last.{LOAD}", MONTH, "last.n", "last.total", "last.parity")


def changed_months(spark: SparkSession, source: DataFrame, ledger: str, columns: list[str], also: list[int] = ()) -> list:
    """Rows (month, n, total, parity, load_id) of the months whose rows are not those in Bronze, and of those in ``also``: load_id is that of the month's
    present folder or None, n is 0 where the source has no row. Twelve a year reach the driver, whatever they hold."""
    now, had = fingerprints(source, columns), current_months(spark, ledger).filter("n > 0")
    had = had.select(MONTH, LOAD, *[F.col(c).alias(f"had_{c}") for c in ("n", "total", "parity")])
    same = F.col("n").eqNullSafe(F.col("had_n")) & F.col("total").eqNullSafe(F.col("had_total")) & F.col("parity").eqNullSafe(F.col("had_parity"))
    return (now.join(had, MONTH, "full_outer").filter(~same | F.col(MONTH).isin(list(also)))
            .select(MONTH, F.coalesce("n", F.lit(0)).alias("n"), "total", "parity", LOAD).orderBy(MONTH).collect())


def read_months(spark: SparkSession, bronze: str, folders: list[tuple[int, str]], schema: T.StructType) -> DataFrame:
    """The rows of these (month, load) folders of Bronze under ``schema``, with their month; no other folder is listed or opened."""
    paths = [f"{bronze}/{partition_folder(spark, MONTH, month)}/{partition_folder(spark, LOAD, load_id)}" for month, load_id in folders]
    with_folders = T.StructType([*schema.fields, T.StructField(MONTH, T.IntegerType()), T.StructField(LOAD, T.StringType())])
    return spark.read.option("basePath", bronze).schema(with_folders).parquet(*paths).drop(LOAD)


def copies(rows: DataFrame, n: str) -> DataFrame:
    """Each row as many times as its column ``n`` says. A row that stands for very many is divided between tasks first."""
    parts = rows.withColumn("_at", F.explode(F.expr(f"sequence(0L, {n} - 1, {COPIES}L)"))).withColumn("_k", F.least(F.lit(COPIES), F.col(n) - F.col("_at")))
    return parts.hint("rebalance").withColumn("_one", F.explode(F.expr("sequence(1L, _k)"))).drop("_at", "_k", "_one", n)


def counted_changes(source: DataFrame, bronze: DataFrame, columns: list[str]) -> DataFrame:
    """month, ``columns`` and ``more``: how many more equal rows the source has than Bronze (fewer: negative; equal ones are left out)."""
    keys = [MONTH, *columns]
    both = source.select(*keys, F.lit(1).alias("one")).unionByName(bronze.select(*keys, F.lit(-1).alias("one")))
    return both.groupBy(*keys).agg(F.sum("one").alias("more")).filter("more <> 0")


def sync_layers(spark: SparkSession, paths, raw: DataFrame, ledger: str, load_id: str | None = None, as_of=None,
                run_date: _dt.date | None = None, rules=None) -> list[int]:
    """Bring Bronze, Silver, quarantine and Gold to the source as it stands (rows up to ``as_of``, and rows without a date); returns the months that changed.

    Late rows, corrected values and withdrawn rows are taken whatever their date. Rows that a month keeps also keep their ingestion time and
    file; a row that comes again counts as often as the source has it. The default ``load_id`` is the number of the next ledger entry, so a run that failed
    is repeated under the same name and replaces what it wrote; the ledger is written last, then superseded folders are removed.
    A table without rows empties the layers; without changes nothing is written. Columns that the source has gained are part of every row's hash: all
    months count as changed once.
    """
    columns = [c for c in raw.columns if c not in METADATA]
    files = F.col("source_file") if "source_file" in raw.columns else F.lit(None).cast("string")
    source = raw.select(*columns, files.alias("source_file")).withColumn(MONTH, source_month())
    source = source.filter((F.col(MONTH) == UNDATED) | (clean.parse_date("date") <= as_of_col(as_of)))
    seq = (current_months(spark, ledger).agg(F.max("seq")).first()[0] or 0) + 1
    load_id = load_id or f"sync-{seq}"
    # folders of this load were left by a run of it that failed: their months are written again, whatever the source has now
    left = [int(m) for m in partitions_with_load(spark, paths.bronze, MONTH, load_id)]
    changed = changed_months(spark, source, ledger, columns, left)
    gone = [Row(month=m, n=0, total=None, parity=None, load_id=None) for m in left if m not in {r[MONTH] for r in changed}]
    changed += gone
    if not changed:
        return []
    months = [r[MONTH] for r in changed]
    for r in changed:
        if not r["n"]:
            drop_partition(spark, paths.bronze, MONTH, r[MONTH], LOAD, load_id)
    _write_months(spark, paths.bronze, source.filter(F.col(MONTH).isin(months)), [(r[MONTH], r[LOAD]) for r in changed if r[LOAD]], columns, load_id)
    fresh = [(r[MONTH], load_id) for r in changed if r["n"]]
    _write_silver(spark, paths, fresh, months, raw, load_id, run_date or _dt.date.today(), rules)
    refresh_gold(spark, paths.silver, [m for m in months if m != UNDATED], paths.gold)
    entries = [(seq, load_id, r[MONTH], r["n"], r["total"], r["parity"]) for r in changed]
    spark.createDataFrame(entries, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(ledger)
    for r in changed:
        if r[LOAD] and r[LOAD] != load_id:
            drop_partition(spark, paths.bronze, MONTH, r[MONTH], LOAD, r[LOAD])
    return months


def _write_months(spark: SparkSession, bronze: str, source: DataFrame, folders: list[tuple[int, str]], columns: list[str], load_id: str) -> None:
    """New folders of the changed months: what Bronze has and the source still has, and what the source has more. The changes of months that
    Bronze had are kept as a table beside it (``bronze_changes``: month, the source's columns, ``more``), one folder a load."""
    run_ts, had = _dt.datetime.now(), [m for m, _ in folders]
    new = to_bronze(source.filter(~F.col(MONTH).isin(had)).drop(MONTH), run_ts).withColumn(MONTH, source_month())
    if folders:
        known = source.filter(F.col(MONTH).isin(had))
        old = read_months(spark, bronze, folders, to_bronze(source.drop(MONTH)).schema)
        path = f"{bronze}_changes/{partition_folder(spark, LOAD, load_id)}"
        counted_changes(known, old, columns).write.mode("overwrite").parquet(path)
        changes = spark.read.parquet(path)
        keys = [MONTH, *columns]

        def on(a: DataFrame, b: DataFrame) -> Column:
            return reduce(and_, [a[c].eqNullSafe(b[c]) for c in keys])
        fewer, more = changes.filter("more < 0").drop("more"), changes.filter("more > 0")
        kept = old.join(fewer, on(old, fewer), "left_anti")
        # of equal rows of which some are withdrawn, those left are written with their first time and file
        lost = changes.filter("more < 0").select(*[F.col(c).alias(f"_{c}") for c in keys], "more")
        counts = old.groupBy(*keys).agg(F.count("*").alias("have"), F.min(F.struct(*METADATA)).alias("first"))
        rest = counts.join(lost, reduce(and_, [counts[c].eqNullSafe(lost[f"_{c}"]) for c in keys]))
        rest = rest.select(*keys, (F.col("have") + F.col("more")).alias("left"), "first").filter("left > 0")
        names = known.groupBy(*keys).agg(F.min("source_file").alias("source_file"))
        added = more.join(names, on(more, names)).select(*[more[c] for c in keys], "more", "source_file")
        new = (new.unionByName(kept).unionByName(copies(rest, "left").select(*keys, "first.*"))
               .unionByName(to_bronze(copies(added, "more").drop(MONTH), run_ts).withColumn(MONTH, source_month())))
    write_partitions(new.withColumn(LOAD, F.lit(load_id)).hint("rebalance", F.col(MONTH)), bronze, [MONTH, LOAD])


def _write_silver(spark: SparkSession, paths, fresh: list[tuple[int, str]], months: list[int], raw: DataFrame, load_id: str, run_date: _dt.date, rules) -> None:
    """Silver and quarantine of the changed months, each from the month's new Bronze folder alone."""
    schema = to_bronze(raw.select(*[c for c in raw.columns if c not in METADATA], F.lit(None).cast("string").alias("source_file"))).schema
    for month in months:  # what a run of this load that failed has written
        drop_partition(spark, paths.silver, MONTH, month, LOAD, load_id)
        for day in subfolders(spark, f"{paths.quarantine}/{partition_folder(spark, MONTH, month)}"):
            remove_folder(spark, f"{paths.quarantine}/{partition_folder(spark, MONTH, month)}/{day}/{partition_folder(spark, LOAD, load_id)}")
    if fresh:
        bronze = read_months(spark, paths.bronze, fresh, schema).drop(MONTH)
        write_by_month(clean.to_silver(bronze, rules), paths.silver, ["date"], load_id, replace_months=True)
        rejects = clean.to_quarantine(bronze, rules, run_date=run_date).withColumn(MONTH, source_month()).withColumn(LOAD, F.lit(load_id))
        write_partitions(rejects, paths.quarantine, [MONTH, "run_date", LOAD])
    for month in months:  # folders of the loads before
        _only(spark, f"{paths.silver}/{partition_folder(spark, MONTH, month)}", load_id)
        _only_days(spark, f"{paths.quarantine}/{partition_folder(spark, MONTH, month)}", run_date, load_id)


def _only(spark: SparkSession, month: str, load_id: str) -> None:
    for name in subfolders(spark, month):
        if name != partition_folder(spark, LOAD, load_id):
            remove_folder(spark, f"{month}/{name}")


def _only_days(spark: SparkSession, month: str, run_date: _dt.date, load_id: str) -> None:
    for day in subfolders(spark, month):
        if day == partition_folder(spark, "run_date", run_date):
            _only(spark, f"{month}/{day}", load_id)
        else:
            remove_folder(spark, f"{month}/{day}")
