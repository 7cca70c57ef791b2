"""Data-quality checks between layers (row counts, schemas, aggregate sanity)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.schema import GOLD_KEYS


def reconcile(raw: DataFrame, silver: DataFrame, quarantine: DataFrame,
              gold: DataFrame) -> DataFrame:
    """One row of layer counts and the invariants between them.

    Silver + quarantine must equal the input, Silver can only shrink, and Gold
    must have exactly one row for each non-null key of Silver. Each count is one distributed aggregate
    (scalar subquery); nothing but the counts reaches the driver.
    """
    keys = list(GOLD_KEYS)
    silver_rows = silver.agg(F.count(F.lit(1))).scalar()
    quarantined_rows = quarantine.agg(F.count(F.lit(1))).scalar()
    gold_rows = gold.agg(F.count(F.lit(1))).scalar()
    gold_keys = gold.select(*keys).distinct().agg(F.count(F.lit(1))).scalar()
    silver_keys = silver.select(*keys).dropna().distinct().agg(F.count(F.lit(1))).scalar()
    base = raw.agg(F.count(F.lit(1)).alias("raw_rows"))
    return base.select(
        "raw_rows",
        silver_rows.alias("silver_rows"),
        quarantined_rows.alias("quarantined_rows"),
        gold_rows.alias("gold_rows"),
        (silver_rows <= F.col("raw_rows")).alias("silver_within_raw"),
        ((silver_rows + quarantined_rows) == F.col("raw_rows")).alias("split_complete"),
        (gold_keys == gold_rows).alias("gold_keys_unique"),
        (gold_keys == silver_keys).alias("gold_complete"),
    )


def run_log_checks(log: DataFrame) -> DataFrame:
    """Invariants between the row counts a layer run observed (its run log):
    every stage succeeded, Silver <= Bronze, Silver + quarantine = Bronze, and
    0 < Gold <= Silver. One row per check; no layer is scanned again."""
    counts = log.groupBy().pivot("stage", ["bronze", "silver", "quarantine", "gold"]).agg(
        F.first("rows"))
    ok_all = log.agg(F.bool_and(F.col("status") == "success")).scalar()
    b, s, q, g = (F.col(c) for c in ("bronze", "silver", "quarantine", "gold"))
    checks = [
        ("all_stages_succeeded", ok_all),
        ("silver_within_bronze", s <= b),
        ("split_complete", (s + q) == b),
        ("gold_within_silver", (g > 0) & (g <= s)),
    ]
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("check"), F.coalesce(cond, F.lit(False)).alias("ok"))
        for name, cond in checks])))


def aggregate_violations(gold: DataFrame) -> DataFrame:
    """Gold rows breaking min <= avg <= max, count > 0, or holding a NULL."""
    ok = (F.col("min_value") <= F.col("avg_value")) & (F.col("avg_value") <= F.col("max_value")) \
        & (F.col("record_count") > 0)
    for c in list(GOLD_KEYS) + ["avg_value", "max_value", "min_value", "record_count"]:
        ok = ok & F.col(c).isNotNull()
    return gold.filter(~F.coalesce(ok, F.lit(False)))


def schema_diff(spark: SparkSession, actual: T.StructType, expected: T.StructType) -> DataFrame:
    """Differences between a layer's schema and its declared one: missing
    columns, unexpected columns, and type changes (metadata only, no data scan)."""
    act = {f.name: f.dataType for f in actual.fields}
    exp = {f.name: f.dataType for f in expected.fields}
    rows = []
    for name, dt in exp.items():
        if name not in act:
            rows.append((name, dt.simpleString(), None, "missing"))
        elif act[name] != dt:
            rows.append((name, dt.simpleString(), act[name].simpleString(), "type_changed"))
    for name, dt in act.items():
        if name not in exp:
            rows.append((name, None, dt.simpleString(), "unexpected"))
    schema = "column string, expected_type string, actual_type string, problem string"
    return spark.createDataFrame(rows, schema)

