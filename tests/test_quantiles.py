"""Distributed exact percentiles equal the merged exact aggregate."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from airshed.operators.quantiles import exact_percentiles

FRACS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    rows = []
    # a hot group with heavy duplicates, a normal group, a one-row group, a two-row group
    rows += [("hot", float(x)) for x in rng.integers(0, 50, 20000)]
    rows += [("hot", 7.0)] * 5000
    rows += [("mid", float(x)) for x in rng.normal(100, 15, 3000).round(3)]
    rows += [("one", 42.0), ("two", 1.0), ("two", 2.0), ("nulls", None)]
    return spark.createDataFrame(rows, "g string, v double")


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_equals_merged_percentile(data, accuracy):
    got = {r.g: r.percentiles for r in exact_percentiles(data, ["g"], "v", FRACS, accuracy).collect()}
    want = {r.g: r.p for r in data.groupBy("g").agg(F.percentile("v", FRACS).alias("p"))
            .filter(F.col("p").isNotNull()).collect()}
    assert set(got) == set(want)
    for g in want:
        assert got[g] == pytest.approx(want[g], rel=1e-12, abs=1e-9), g


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_brackets_answer_every_group(data, accuracy):
    got = exact_percentiles(data, ["g"], "v", FRACS, accuracy, fallback=False)
    assert sorted(r.g for r in got.collect()) == ["hot", "mid", "one", "two"]


def test_matches_numpy_linear(data):
    got = {r.g: r.percentiles for r in exact_percentiles(data, ["g"], "v", [0.5, 0.9], 50).collect()}
    vals = np.array([r.v for r in data.filter("g = 'mid'").collect()])
    assert got["mid"] == pytest.approx(list(np.percentile(vals, [50, 90])))
