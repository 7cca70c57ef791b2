"""Size-balanced shards by sampled splitters.

Rows are ordered by ``(key, uid)``; ``uid`` numbers the rows of the written
input and is unique, so any run of equal keys, however long, can be cut. A
size-weighted sample of that order gives quantile boundaries; rows are
range-partitioned by them; ranges that turn out overfull are subdivided by
boundaries sampled inside them. The measured totals of the ranges and the
running sum inside each range then give every row its exact byte position, and
the shard is the ``n_shards``-th part of all bytes that the row's middle lies in. Two shards therefore differ by about one row's size, whatever the sample.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airshed.llm.common import table, texts, utf8_bytes, written

#: A range is sorted by one task; one that holds more rows is subdivided.
MAX_RANGE_ROWS = 500_000
RANGES_PER_SHARD = 4
SAMPLE_PER_RANGE = 32
SEED = 20_011


def _range_of(keys: np.ndarray, uids: np.ndarray):
    """A column function: the number of splitters at or below ``(key, uid)``."""
    @F.pandas_udf("int")
    def lookup(key: pd.Series, uid: pd.Series) -> pd.Series:
        k, u = key.to_numpy(), uid.to_numpy()
        low, high = np.searchsorted(keys, k, "left"), np.searchsorted(keys, k, "right")
        for first in np.unique(low[low < high]):  # keys that several splitters cut
            rows = (low == first) & (high > first)
            end = high[rows][0]
            high[rows] = first + np.searchsorted(uids[first:end], u[rows], "right")
        return pd.Series(high.astype("int32"))
    return lookup


def _sampled(rows: DataFrame, probability: Column) -> list:
    """Rows drawn independently with the given probability (at most 1), decided
    by a hash of their number: a repeated task draws the same rows."""
    draw = F.pmod(F.xxhash64("uid", F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.filter(draw < probability).select("key", "uid", "size").collect()


def _quantiles(sample: list, least: float, n: int) -> list[tuple[int, int]]:
    """n - 1 boundaries of equal weight; a drawn row stands for ``least`` bytes or its own size."""
    if not sample:
        return []
    sample = sorted((r["key"], r["uid"], max(float(r["size"]), least)) for r in sample)
    reached = np.cumsum([x[2] for x in sample])
    at = np.searchsorted(reached, reached[-1] * np.arange(1, n) / n)
    return [sample[i][:2] for i in np.unique(at)]


def shard_by_splitters(rows: DataFrame, n_shards: int, key: str = "key", size: str = "size",
                       ranges_per_shard: int = RANGES_PER_SHARD, max_range_rows: int = MAX_RANGE_ROWS) -> DataFrame:
    """Add ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from 0 in each shard) to every row.

    ``rows``: any columns, packed away while the operator works, so that no name
    can clash; columns called ``shard`` or ``slot`` are replaced. ``key`` orders
    the rows (a long; rows with equal or nearby keys share a shard except where
    a boundary falls between them; null sorts as the smallest long). ``size`` is the weight
    (null or below 1 counts as 1). Repeated rows are rows of their own. An empty table gives no rows.

    Driver memory: the sample, about ``SAMPLE_PER_RANGE`` rows for each range,
    where the number of ranges is ``max(ranges_per_shard * n_shards, rows / max_range_rows * 2)``.
    """
    spark = rows.sparkSession
    rows = rows.drop("shard", "slot")
    base = written(rows.select(
        F.coalesce(rows[key].cast("long"), F.lit(-(1 << 63))).alias("key"),
        F.greatest(F.coalesce(rows[size].cast("long"), F.lit(1)), F.lit(1)).alias("size"),
        F.monotonically_increasing_id().alias("uid"), F.struct("*").alias("row")), "shard-rows")
    n_rows, total = base.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    n_ranges = max(ranges_per_shard * n_shards, -(-2 * n_rows // max_range_rows))
    least = max(total, 1) / (n_ranges * SAMPLE_PER_RANGE)
    splitters = _quantiles(_sampled(base, F.col("size") / F.lit(least)), least, n_ranges)

    while True:
        order = sorted(splitters)
        keys = np.array([k for k, _ in order], dtype="int64")
        uids = np.array([u for _, u in order], dtype="int64")
        placed = base.withColumn("range", _range_of(keys, uids)("key", "uid"))
        filled = {r["range"]: (r["n"], r["b"]) for r in
                  placed.groupBy("range").agg(F.count("*").alias("n"), F.sum("size").alias("b")).collect()}
        over = {r: n for r, (n, _) in filled.items() if n > max_range_rows}
        if not over:
            break
        # subdivide: boundaries drawn evenly from the rows of each overfull range
        share = F.element_at(F.create_map(*[x for r, n in over.items() for x in (F.lit(r), F.lit(256.0 / n))]), F.col("range"))
        drawn = _sampled(placed.filter(F.col("range").isin(list(over))), share * F.lit(1.0))
        splitters = sorted({*splitters, *((r["key"], r["uid"]) for r in drawn)})

    starts, at_row, at_byte = [], 0, 0
    for r in sorted(filled):
        starts.append((r, at_row, at_byte))
        at_row, at_byte = at_row + filled[r][0], at_byte + filled[r][1]
    # one row per range, so bounded like the splitters themselves
    offsets = F.broadcast(spark.createDataFrame(starts, "range int, row_0 long, byte_0 long"))
    inside = Window.partitionBy("range").orderBy("key", "uid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    twice_middle = 2 * (F.col("byte_0") + F.sum("size").over(inside)) - F.col("size")
    at = written(placed.join(offsets, "range").select(
        "row", (F.col("row_0") + F.count("*").over(inside) - 1).alias("at_row"), twice_middle.alias("twice_middle")).select(
        "row", "at_row", F.expr(f"cast(least(twice_middle * {n_shards} div {2 * max(total, 1)}, {n_shards - 1}) as int)").alias("shard")),
        "shard-places")
    first = {r["shard"]: r["f"] for r in at.groupBy("shard").agg(F.min("at_row").alias("f")).collect()}
    firsts = F.create_map(*[x for s in range(n_shards) for x in (F.lit(s), F.lit(first.get(s, 0)).cast("long"))])
    return at.select("row.*", "shard", (F.col("at_row") - F.element_at(firsts, F.col("shard"))).alias("slot"))


def op1_sampled_splitters(spark, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near-equal bytes. The key is a hash of the
    text: equal texts are neighbours, and stay in one shard unless a boundary cuts them.
    A null text has no bytes, CRC 0 and the hash of the empty text."""
    d = texts(table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    rows = d.select("doc_id", (utf8_bytes(F.col("text")) + 16).alias("size"),
                    F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("key"))
    return shard_by_splitters(rows, 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
