"""Print plan features of every registered measurement query: shuffles, join strategies,
window group limits, and the filters pushed into each Parquet scan.

Usage: python scripts/plan_review.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from airshed.catalog import QUERIES  # noqa: E402
from airshed.session import build_session  # noqa: E402


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    print("| query | exchanges | broadcast hash joins | sort-merge joins | nested-loop / cartesian | "
          "window group limits | expand | pushed scan filters |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in QUERIES.items():
        if names and name not in names:
            continue
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()  # final adaptive plan
        p = plan_text(df)
        feats = {
            "exchanges": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobin", p)),
            "bhj": p.count("BroadcastHashJoin"),
            "smj": p.count("SortMergeJoin"),
            "nlj": p.count("BroadcastNestedLoopJoin") + p.count("CartesianProduct"),
            "wgl": p.count("WindowGroupLimit"),
            "expand": p.count("Expand "),
        }
        pushed = sorted(set(re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", p)))
        pushed = [x for x in pushed if x and x not in ("IsNotNull(date)",)]
        print("| " + " | ".join([name] + [str(feats[k]) for k in feats]
                                + ["; ".join(x[:90] for x in pushed)]) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
