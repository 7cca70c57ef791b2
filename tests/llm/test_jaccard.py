"""What near duplicates keep on disk: one step's shuffle, one part of the keys, rows shuffled once, and whole sets only of classes that are close."""

from __future__ import annotations

import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from airshed.llm import jaccard, linking
from airshed.llm.common import forget, scratch_tables, written
from airshed.llm.linking import Rule
from tests.llm.fixtures import corpus, documents, words
from tests.llm.test_operators import _components


def test_a_finished_write_leaves_no_shuffle(spark):
    shuffles = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    first = spark.sparkContext._jsc.sc().newShuffleId()
    out = written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "shuffled")
    last, until = spark.sparkContext._jsc.sc().newShuffleId(), time.time() + 10
    while (left := [i for i in range(first + 1, last) if shuffles.contains(i)]) and time.time() < until:
        time.sleep(0.1)
    forget(out)
    assert last > first + 1 and not left


def test_keys_are_dealt_in_parts(spark):
    rows = [(c, [c // 2 + 10 * i for i in range(9)], [c // 4 - 1000]) for c in range(20)]
    with scratch_tables():
        keyed = spark.createDataFrame(rows, "c long, home array<long>, next array<long>")
        parts = [{tuple(r) for r in jaccard._bucketed(keyed, part).select("key", "c", "next", "size").collect()} for part in range(jaccard.KEY_PARTS)]
    sizes = Counter(k for _, home, after in rows for k in home + after)
    assert set.union(*parts) == {(k, c, i == 1, sizes[k]) for c, *both in rows for i, keys in enumerate(both) for k in keys if sizes[k] > 1}
    assert all({k % jaccard.KEY_PARTS for k, *_ in part} == {i} for i, part in enumerate(parts))


def test_first_documents_shuffles_the_rows_once(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = jaccard.first_documents(documents(spark, corpus()))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert sum("Exchange hashpartitioning" in line and "row#" not in line for line in plan.splitlines()) == 2  # the rows by key, the firsts by key
        kept = Counter((r["doc_id"], r["text"]) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert max(kept.values()) == 1
    firsts = {c for _, n, c in _components(corpus(), Rule()) if n}
    assert {i for i, t in kept if (t or "").split()} == firsts
    assert {i for i, t in kept if not (t or "").split()} == {i for i, t in corpus() if not (t or "").split()}


def _with_boilerplate(seed: int, n: int):
    """Unlike texts with a common passage, and pairs of near copies among them."""
    rng = random.Random(seed)
    common, rows = words(rng, 30), []
    for i in range(n):
        own = words(rng, 60, 10 ** 6)
        rows.append((2 * i, " ".join(common + own)))
        if i % 5 == 0:
            rows.append((2 * i + 1, " ".join(common + own[:-1] + ["changed"])))
    return rows


def test_only_close_classes_are_searched(spark, monkeypatch):
    rule, rows = Rule(), _with_boilerplate(3, 60)
    monkeypatch.setattr(linking, "SMALL", 3)
    monkeypatch.setattr(linking, "CENTRES", 1)
    monkeypatch.setattr(jaccard, "_blocks", lambda rule, band: (600, 1, 200))  # so many blocks that the passage fills some alone: large buckets
    monkeypatch.setattr(linking, "HELD_SHINGLES", 1000)
    seen = {}
    monkeypatch.setattr(linking, "written", lambda df, name, make=linking.written: seen.setdefault(name, make(df, name)))
    with scratch_tables():
        out = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard._near_duplicates(documents(spark, rows), rule).collect())
        searched, opened = seen["linking-rows"].count(), seen["linking-open"].select("c").distinct().count()
    assert out == _components(rows, rule)
    assert opened >= 60 and searched <= 24  # all of them before; the near copies are 24


@pytest.mark.parametrize("tile", [1, 300, 1 << 23])
def test_close_classes_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(jaccard, "TILE_BYTES", tile)
    monkeypatch.setattr(jaccard, "TILE_PAIRS", 7)
    monkeypatch.setattr(jaccard, "HEAD_WORDS", 1)
    rule, rng = Rule(), random.Random(5)
    sets = []
    for _ in range(12):
        base = [rng.getrandbits(64) for _ in range(rng.randrange(40, 120))]
        sets += [np.unique(np.array(base[:len(base) - cut] + [rng.getrandbits(64) for _ in range(cut)], dtype=np.uint64)) for cut in (0, 1, 4, 12, 30)]
    clusters = [int(i % 20 > 9) for i in range(len(sets))]
    components = [i if i % 3 else i // 10 * 10 for i in range(len(sets))]
    parity = []
    for c, s in enumerate(sets):
        band = jaccard._band(rule, len(s))
        reaches = jaccard._reaches_next(rule, len(s), band)
        parity.append((c, len(s), band, bytearray(jaccard._parity(s, rule, band)), bytearray(jaccard._parity(s, rule, band + 1) if reaches else b"")))
    rows = spark.createDataFrame([(k, c, g) for c, (k, g) in enumerate(zip(clusters, components, strict=True))], "cluster long, c long, component long")
    table = spark.createDataFrame(parity, "c long, n long, band long, home_bits binary, next_bits binary")
    got = {r["c"] for r in jaccard._close(rows, table, rule).collect()}

    def may_link(u, v):
        (_, n, p, *_), (_, m, q, *_) = parity[u], parity[v]
        if rule.den * min(n, m) < rule.num * max(n, m):
            return False
        top = max(p, q)
        a, b = (bytes(parity[x][3 if parity[x][2] == top else 4]) for x in (u, v))
        return jaccard._distance(a, b) <= rule.difference(n + m)
    pairs = [(u, v) for v in range(len(sets)) for u in range(v) if clusters[u] == clusters[v] and components[u] != components[v] and may_link(u, v)]
    # a pair is also compared by the bits of the next band, by which it may be close too
    assert {c for p in pairs for c in p} <= got
    linked = {c for v in range(len(sets)) for u in range(v) if clusters[u] == clusters[v] and components[u] != components[v]
              and len(np.setxor1d(sets[u], sets[v])) <= rule.difference(len(sets[u]) + len(sets[v])) for c in (u, v)}
    assert 0 < len(linked) and linked <= got and len(got) < len(sets)


def test_empty_tiles():
    schema = pa.schema([(x, pa.int64()) for x in ("cluster", "band", "a", "b", "side", "c", "component", "n")] + [("bits", pa.binary())])
    one_side = pa.RecordBatch.from_pylist([{"cluster": 1, "band": 2, "a": 0, "b": 1, "side": 0, "c": c, "component": c, "n": 9, "bits": b"x" * 8} for c in range(3)], schema=schema)
    assert [b.num_rows for b in jaccard._closing(Rule())(iter([one_side, one_side.slice(0, 0)]))] == [0]
