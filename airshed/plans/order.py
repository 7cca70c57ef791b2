"""The order each report is read in.

Reports return unordered rows; a sort belongs to whoever shows or writes them.
``in_report_order`` adds it, with the remaining key columns so that ties have one order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# report -> sort terms, as SQL text that both the DataFrame and the SQL forms use
REPORT_ORDER = {
    "location_coverage": ("coverage_percent DESC", "location"),
    "missing_series_days": ("date DESC", "location", "pollutant_type"),
    "current_levels": ("location", "pollutant_type"),
    "daily_trend": ("location", "pollutant_type", "date DESC"),
    "top_exceedances": ("date DESC", "max_level DESC", "location", "pollutant_type"),
    "monthly_levels": ("year DESC", "month DESC", "pollutant_type"),
    "location_ranking": ("ranking", "rank", "pollutant_type"),
    "zone_comparison": ("zone", "pollutant_type"),
    "location_scorecard": ("overall_avg DESC", "location", "zone"),
    "anomalies": ("date DESC", "standard_deviations DESC", "location", "pollutant_type"),
    "weekday_pattern": ("array_position(array('Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday'), day_of_week)", "pollutant_type"),
    "seasonal_levels": ("year DESC", "month DESC", "pollutant_type"),
    "month_over_month": ("year DESC", "month DESC", "pollutant_type"),
    "days_over_limit": ("exceedance_percent DESC", "location", "pollutant_type"),
    "volatility": ("coefficient_of_variation DESC", "location", "pollutant_type"),
    "trend_slope": ("abs(trend_slope) DESC", "location", "pollutant_type"),
    "monthly_compliance": ("report_month DESC",),
}

#: Sort terms that are measures: with the other terms, the keys, they place a row but do not name it.
_MEASURES = ("coverage_percent", "max_level", "overall_avg", "standard_deviations", "exceedance_percent", "coefficient_of_variation",
             "abs(trend_slope)")


def key_columns(name: str) -> list[str]:
    """The columns among a report's sort terms that name its rows."""
    plain = [t.removesuffix(" DESC") for t in REPORT_ORDER[name]]
    return ["day_of_week" if t.endswith("day_of_week)") else t for t in plain if t not in _MEASURES]


def _sort(name: str) -> list:
    return [F.expr(t.removesuffix(" DESC")).desc_nulls_last() if t.endswith(" DESC") else F.expr(t).asc_nulls_last()
            for t in REPORT_ORDER.get(name, ())]


def with_positions(df: DataFrame, sort: list, path: str) -> DataFrame:
    """``df`` with ``position``, the place of each row (from 1) in the whole order ``sort``.

    Rows are dealt in ranges of the order, sorted inside each and written to ``path`` with their range and place in
    it: the ranges are drawn from a sample, and what is written keeps its numbers. The rows of each range are then counted, and
    the sums of the ranges before (a row for each range) added. Rows that tie in all terms lie in one range, in any order.
    """
    spark, bits = df.sparkSession, 33  # monotonically_increasing_id: partition in the upper 31 bits, place in the lower 33
    at = F.col("_at")
    ranged = df.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("_at", F.monotonically_increasing_id())
    (ranged.withColumn("_range", F.shiftright(at, bits)).withColumn("_place", at.bitwiseAND(F.lit((1 << bits) - 1))).drop("_at")
     .write.mode("overwrite").parquet(path))
    rows = spark.read.parquet(path)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("_range").agg(F.count("*").alias("n")).select(
        "_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    return rows.join(offsets, "_range").withColumn("position", F.col("_before") + F.col("_place") + 1).drop("_range", "_place", "_before")


def report_positions(df: DataFrame, name: str, path: str) -> DataFrame:
    """report, position and key (the key columns as text, joined by ``|``) of the rows of report ``name`` in its order."""
    keys = [F.col(c).cast("string") for c in key_columns(name)]
    return with_positions(df, _sort(name), path).select(F.lit(name).alias("report"), "position", F.concat_ws("|", *keys).alias("key"))


def in_report_order(df: DataFrame, name: str) -> DataFrame:
    """``df``, the rows of report ``name``, in its order (a range-partitioned sort)."""
    sort = _sort(name)
    return df.orderBy(*sort) if sort else df


def order_by(name: str) -> str:
    """The same order as an ORDER BY clause, empty for a report of one row."""
    terms = [f"{t} NULLS LAST" for t in REPORT_ORDER.get(name, ())]
    return f"\nORDER BY {', '.join(terms)}" if terms else ""
