"""S13: quarantined rows repaired by a table of rules and loaded again, once.

A replay takes the quarantine folders that its table of repairs has not seen yet. Rows that pass after the repair go to Bronze and Silver as a load of
their own, and Gold is refreshed for their months; the others stay in quarantine as they are, under that load. The ledger, written
after these, says which folders the replay has taken in the place of which; then the folders taken are removed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from airshed.operators import clean
from airshed.sources.incremental import refresh_gold
from airshed.sources.layers_io import (LOAD, MONTH, partition_folder, partitions_with_load, path_exists, remove_folder, subfolders,
                                       write_by_month, write_partitions)

LEDGER_SCHEMA = "name string, seq int, folder string, taken boolean, load_id string"


@dataclass(frozen=True)
class Repair:
    """In rows rejected for ``reason``, ``column`` becomes ``value`` (an expression over the row)."""
    reason: str
    column: str
    value: Column


def repaired(quarantine: DataFrame, repairs: list[Repair]) -> DataFrame:
    """Quarantined rows with all repairs applied to the values they had when they were rejected; reasons and folder columns stay."""
    new: dict[str, Column] = {}
    for r in repairs:
        new[r.column] = F.when(F.array_contains(clean.REJECT_REASONS, r.reason), r.value).otherwise(new.get(r.column, F.col(r.column)))
    return quarantine.withColumns(new)


def _ledger(spark: SparkSession, path: str) -> list:
    """The entries, one for each folder of quarantine a replay has seen: as many as loads with rejects."""
    return spark.read.schema(LEDGER_SCHEMA).parquet(path).collect() if path_exists(spark, path) else []


def replay_quarantine(spark: SparkSession, paths, repairs: list[Repair], ledger: str, name: str, rules=None) -> int:
    """Replay what the repairs called ``name`` have not seen; returns the number of rows that re-entered the layers.

    A replay that is repeated finds nothing to do; one that failed is repeated under the same load and replaces what it wrote. Other repairs, under another
    name, try again what is still in quarantine. Rows rejected for several reasons have to pass all rules after all repairs. An empty or missing quarantine
    is nothing to do. Bronze keeps the rows as they were delivered too, in the loads that brought them.
    """
    seen = _ledger(spark, ledger)
    for e in seen:  # of a replay that ended between its entries and here
        if e["taken"]:
            remove_folder(spark, f"{paths.quarantine}/{e['folder']}")
    own = [e for e in seen if e["name"] == name]
    seq = max((e["seq"] for e in own), default=0) + 1
    load_id = f"replay-{name}-{seq}"
    mine = partition_folder(spark, LOAD, load_id)
    folders = [f"{day}/{load}" for day in subfolders(spark, paths.quarantine) for load in subfolders(spark, f"{paths.quarantine}/{day}")
               if load != mine and f"{day}/{load}" not in {e["folder"] for e in own}]
    if not folders:
        return 0
    rows = (spark.read.option("basePath", paths.quarantine).option("mergeSchema", True)
            .parquet(*[f"{paths.quarantine}/{f}" for f in folders]).withColumns({"run_date": F.col("run_date").cast("date"), LOAD: F.lit(load_id)}))
    rows = rows.withColumn("_rejected", F.struct(*rows.columns))
    rows = clean.with_parsed_date(repaired(rows, repairs))
    passes = clean.passes(clean.default_rules() if rules is None else rules)

    count = Observation("replayed")
    fixed = clean.replay(rows.filter(passes).drop("_rejected", clean.PARSED_DATE)).observe(count, F.count(F.lit(1)).alias("rows"))
    write_partitions(fixed.withColumn(LOAD, F.lit(load_id)), paths.bronze, [LOAD])
    write_partitions(rows.filter(~passes).select("_rejected.*"), paths.quarantine, ["run_date", LOAD])
    bronze_load = f"{paths.bronze}/{mine}"
    if path_exists(spark, bronze_load):
        bronze = spark.read.parquet(bronze_load)
        write_by_month(clean.to_silver(bronze, rules), paths.silver, ["date"], load_id, replace_months=True)
        refresh_gold(spark, paths.silver, [int(m) for m in partitions_with_load(spark, paths.silver, MONTH, load_id)], paths.gold)
    left = [f"{day}/{mine}" for day in subfolders(spark, paths.quarantine) if mine in subfolders(spark, f"{paths.quarantine}/{day}")]
    entries = [(name, seq, f, True, load_id) for f in folders] + [(name, seq, f, False, load_id) for f in left]
    spark.createDataFrame(entries, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(ledger)
    for f in folders:
        remove_folder(spark, f"{paths.quarantine}/{f}")
    return count.get["rows"] if path_exists(spark, bronze_load) else 0
