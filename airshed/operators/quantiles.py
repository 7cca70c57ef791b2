"""Exact interpolated percentiles (PERCENTILE_CONT) that stay distributed
when one group holds a large share of the rows.

The plain ``percentile`` aggregate merges one value -> count map per group in a
single task, so its memory grows with the group. Here:

1. a bounded-memory sketch (``percentile_approx``) brackets each target rank
   per group, with a margin of twice its rank error;
2. rows below the bracket are only counted; rows inside it are counted per
   distinct value (an aggregation keyed by the value, so a hot group is spread
   over many tasks) - a group/fraction then holds at most the distinct values
   of a narrow rank band;
3. a running sum over that small band locates the two ranks around
   ``(n - 1) * f`` and interpolates between them, exactly as PERCENTILE_CONT.

A group whose bracket misses a target rank (not expected given the sketch's
guarantee) is answered by the exact merged aggregate, so the result is always
exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_ACCURACY = 10_000


def exact_percentiles(df: DataFrame, keys: list[str], value: str, fractions: list[float],
                      accuracy: int = DEFAULT_ACCURACY, out: str = "percentiles",
                      fallback: bool = True) -> DataFrame:
    """Per group of ``keys``: array of PERCENTILE_CONT(f) of ``value`` for each
    fraction, in order. Groups whose values are all NULL are absent.
    (``fallback=False`` returns only the groups the brackets answered; tests.)"""
    keys = list(keys)
    v = F.col(value)
    base = df.select(*keys, v.cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    margin = 2.0 / accuracy
    lo_f = [max(f - margin, 0.0) for f in fractions]
    hi_f = [min(f + margin, 1.0) for f in fractions]

    # 1. size and rank brackets per group and fraction
    sketch = base.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_v", lo_f, accuracy).alias("_lo"),
        F.percentile_approx("_v", hi_f, accuracy).alias("_hi"))
    fr = F.array(*[F.lit(float(f)) for f in fractions])
    brackets = sketch.select(
        *keys, "_n", F.posexplode(F.arrays_zip("_lo", "_hi")).alias("_i", "_b")
    ).select(*keys, "_n", "_i", fr[F.col("_i")].alias("_f"),
             F.col("_b._lo").alias("_a"), F.col("_b._hi").alias("_z"))
    h = (F.col("_n") - 1) * F.col("_f")
    brackets = brackets.withColumns({"_h": h, "_klo": F.floor(h), "_khi": F.ceil(h)})

    # 2. per group and fraction: rows below the bracket (counted), the nearest
    #    values just outside it, and the distinct values inside it (counted)
    j = base.join(brackets.select(*keys, "_i", "_a", "_z"), keys)
    vv, a, z = F.col("_v"), F.col("_a"), F.col("_z")
    edges = j.groupBy(*keys, "_i").agg(
        F.count_if(vv < a).alias("_below"),
        F.count_if((vv >= a) & (vv <= z)).alias("_inn"),
        F.max(F.when(vv < a, vv)).alias("_prev"),
        F.min(F.when(vv > z, vv)).alias("_next"))
    inside = (j.filter((vv >= a) & (vv <= z))
              .groupBy(*keys, "_i", "_v").agg(F.count(F.lit(1)).alias("_c")))

    # 3. running count over the band -> the values at ranks klo and khi
    w = Window.partitionBy(*keys, "_i").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    band = (inside.join(edges.select(*keys, "_i", "_below"), keys + ["_i"])
            .join(brackets.select(*keys, "_i", "_klo", "_khi"), keys + ["_i"])
            .withColumn("_cum", F.col("_below") + F.sum("_c").over(w)))
    start = F.col("_cum") - F.col("_c")

    def at(rank):
        return F.max(F.when((start <= F.col(rank)) & (F.col(rank) < F.col("_cum")), F.col("_v")))

    in_band = band.groupBy(*keys, "_i").agg(at("_klo").alias("_blo"), at("_khi").alias("_bhi"))
    picked = brackets.join(edges, keys + ["_i"]).join(in_band, keys + ["_i"], "left")

    def resolve(rank, found):
        # one rank below or above the band: the nearest value outside it
        return (F.when(F.col(found).isNotNull(), F.col(found))
                .when(F.col(rank) == F.col("_below") - 1, F.col("_prev"))
                .when(F.col(rank) == F.col("_below") + F.col("_inn"), F.col("_next")))

    vlo, vhi = resolve("_klo", "_blo"), resolve("_khi", "_bhi")
    picked = picked.withColumn("_p", vlo + (F.col("_h") - F.col("_klo")) * (vhi - vlo))
    found = picked.groupBy(*keys).agg(
        F.count("_p").alias("_found"),
        F.transform(F.array_sort(F.collect_list(F.struct("_i", "_p"))), lambda s: s["_p"]).alias(out))
    found = found.filter(F.col("_found") == len(fractions)).drop("_found")

    if not fallback:
        return found
    # groups the brackets missed: exact merged aggregate (expected to be none)
    missed = sketch.select(*keys).join(found.select(*keys), keys, "left_anti")
    fallback = (base.join(missed, keys, "left_semi").groupBy(*keys)
                .agg(F.percentile("_v", [float(f) for f in fractions]).alias(out)))
    return found.unionByName(fallback)
