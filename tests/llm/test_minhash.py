"""HyperMinHash: registers, estimates and whole components against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
import xxhash

from airshed.llm import hashing, jaccard, linking, minhash
from airshed.llm.common import scratch_tables
from airshed.llm.linking import Rule
from tests.llm.fixtures import corpus, documents, words
from tests.llm.test_operators import _components

RULE = Rule(3, 85, 100)


def test_registers_are_floating_point_numbers():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.integers(0, 2**64, 20_000, dtype=np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64), np.array([0, 2**64 - 1], dtype=np.uint64)])
    expected = []
    for v in x.tolist():
        zeros = min(64 - v.bit_length(), 53)
        expected.append(zeros << 10 | (v << min(zeros + 1, 63)) % 2**64 >> 54)
    assert minhash.compressed(x).tolist() == expected


@pytest.mark.parametrize("n", [6, 7, 20, 150, 3000])
def test_similar_sets_meet_and_their_estimate_is_right(n):
    rng, bands = np.random.default_rng(n), minhash.least_bands(RULE)
    assert bands.bands == 32
    errors = []
    for _ in range(100):
        base = rng.integers(0, 2**64, 2 * n, dtype=np.uint64)
        shift = int(n * 0.15 / 1.85)
        a, b = np.sort(base[:n]), np.sort(base[shift:n + shift] if shift else base[:n - 1])
        similarity = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        r = [minhash.registers(s, bands.registers) for s in (a, b)]
        assert (r[0] == r[1]).reshape(bands.bands, bands.rows).all(axis=1).any()
        errors.append(minhash.estimated(r[0][None], r[1][None], np.array([len(a)]), np.array([len(b)]))[0] - similarity)
        other = minhash.registers(np.sort(base[n:]), bands.registers)
        assert shift or abs(minhash.estimated(r[0][None], other[None], np.array([n]), np.array([n]))[0]) < 0.05
    assert abs(np.mean(errors)) < 0.015 and max(map(abs, errors)) < 0.2


def test_collisions_are_corrected():
    rng, n = np.random.default_rng(3), 160
    agree = [(minhash.registers(rng.integers(0, 2**64, 800, dtype=np.uint64), n) == minhash.registers(rng.integers(0, 2**64, 800, dtype=np.uint64), n)).mean()
             for _ in range(2000)]
    assert abs(np.mean(agree) - minhash.collisions(np.array([5.0]), np.array([5.0]))[0]) < 1e-4


def _near_copies(seed: int, n: int, edits: int):
    rng = random.Random(seed)
    base, rows = words(rng, 150), []
    for i in range(n):
        copy = list(base)
        for _ in range(rng.randrange(0, edits)):
            copy[rng.randrange(150)] = f"w{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(copy[:rng.randrange(130, 151)])))
    return rows


@pytest.mark.parametrize("rule", [RULE, Rule()])
def test_components_equal_brute_force(spark, rule):
    rows = corpus() + [(2000 + i, t) for i, t in _near_copies(8, 150, 14)]
    out = minhash.near_duplicates(documents(spark, rows), rule).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out) == _components(rows, rule)


def test_search_over_blocks_and_parts(spark, monkeypatch):
    monkeypatch.setattr(linking, "HELD_SHINGLES", 3000)
    monkeypatch.setattr(linking, "CENTRES", 1)
    rows = _near_copies(9, 200, 16)
    out = minhash.near_duplicates(documents(spark, rows), RULE).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out) == _components(rows, RULE)


def test_query_keeps_one_of_each_component(spark, tmp_path):
    from airshed.llm.catalog import QUERIES
    rows = [(i, t) for i, t in corpus() if i is not None]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op13_hyper_minhash"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert Counter(tuple(r) for r in got.collect()) == Counter({(*x, x[0] == x[2]): n for x, n in _components(rows, RULE).items()})


def test_empty_table(spark):
    assert minhash.near_duplicates(documents(spark, []), RULE).collect() == []


def test_search_sends_classes_only_to_sizes_that_may_link(spark, monkeypatch):
    sizes = {c: 80 if c < 10 else 100 if c < 20 else 4000 for c in range(30)}
    shingles = {c: [c % 2 * 10**6 + i for i in range(n)] if c < 20 else [c * 10**7 + i for i in range(n)] for c, n in sizes.items()}
    sets = spark.createDataFrame([(c, n, shingles[c]) for c, n in sizes.items()], "c long, n long, shingles array<long>")
    buckets = spark.createDataFrame([(1, c) for c in sizes], "key long, c long")
    centred = spark.createDataFrame([(1, [(99,)])], "key long, centres array<struct<c:long>>")
    member = spark.createDataFrame([], "node long, component long")
    monkeypatch.setattr(linking, "HELD_SHINGLES", 1000)
    with scratch_tables():
        found = {tuple(r) for r in linking._search(buckets, centred, member, sets, Rule(5, 80, 100)).collect()}
        assert all(u % 2 == v % 2 and v < 20 for u, v in found)  # 80 of 100 is a link
        for odd in (0, 1):
            joined, edges = {odd}, {e for e in found if e[0] % 2 == odd}
            for _ in range(20):
                joined |= {x for e in edges if joined & set(e) for x in e}
            assert joined == {c for c in range(20) if c % 2 == odd}

        def sent(rule):
            def rows(batches):
                for b in batches:
                    yield pa.RecordBatch.from_arrays([b.column(4), pa.compute.add(pa.compute.multiply(b.column(1), 1000), b.column(2))], names=["u", "v"])
            return rows
        monkeypatch.setattr(linking, "_searched", sent)
        rows = linking._search(buckets, centred, member, sets, Rule(5, 80, 100)).filter("u < 20").groupBy("u").count().agg({"count": "max"}).first()[0]
        assert rows <= 8  # sent to the blocks of every size: more than forty


def test_small_buckets_are_compared_whole_and_larger_ones_by_centres(spark, monkeypatch):
    monkeypatch.setattr(linking, "SMALL", 4)
    buckets = spark.createDataFrame([(1, c, 4) for c in range(4)] + [(2, c, 6) for c in range(6)], "key long, c long, size long")
    centred = linking.centres(buckets, ["c"])
    found = {r["key"]: [x["c"] for x in r["centres"]] for r in centred.collect()}
    assert sorted(found[1]) == [0, 1, 2, 3] and 1 <= len(found[2]) <= linking.CENTRES
    pairs = {(r["u"], r["v"]) for r in linking.star_pairs(buckets.filter("key = 1"), centred, ["c"]).collect()}
    assert pairs == {(a, b) for b in range(4) for a in range(b)}
    # whole sets are made of the members of larger buckets that are no centres, and of the pairs: not of every class that shares a bucket
    near = spark.createDataFrame([(10, 11)], "u long, v long")
    assert {r["c"] for r in linking.compared(linking.larger(buckets), centred, near).collect()} == {10, 11} | set(range(6)) - set(found[2])


@pytest.mark.parametrize("small", [0, 3])
def test_components_whatever_buckets_are_small(spark, monkeypatch, small):
    monkeypatch.setattr(linking, "SMALL", small)
    rows = _near_copies(5, 12, 4) + [(100 + i, t) for i, t in _near_copies(6, 9, 14)]
    got = jaccard.near_duplicates(documents(spark, rows), RULE).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == _components(rows, RULE)


def test_word_hashes_hold_no_words():
    held = [b"a", b"", "\u00fc".encode(), b"a", b"x" * 5000]
    assert hashing.word_hashes(held).tolist() == [xxhash.xxh3_64_intdigest(w) for w in held]
    assert hashing.word_hashes([]).dtype == np.uint64 and not any(isinstance(x, dict) for n, x in vars(hashing).items() if n[:2] != "__")
