"""The pipeline: each stage on its own input, the chain, and the registration."""

from __future__ import annotations

import os
import random

import pytest

import __spark_entry__
import corpus_pipeline
from airshed.llm import decontamination, quality
from airshed.llm.jaccard import Rule
from tests.llm.fixtures import CLASHING, corpus, documents, words
from tests.llm.test_operators import _components, _flag, _quality


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A data folder whose documents hold the awkward cases, benchmark passages and secrets."""
    rng = random.Random(11)
    items = [(i, " ".join(words(rng, 30))) for i in range(5)]
    rows = [r for r in corpus() if r[0] != 88]
    rows += [(300 + i, " ".join(words(rng, 40) + t.split() + words(rng, 40))) for i, t in items]
    rows += [(310, " ".join(words(rng, 900)) + " " + items[0][1]), (311, " ".join(words(rng, 50)) + " password: hunter2000 " + " ".join(words(rng, 20)))]
    path = str(tmp_path_factory.mktemp("tables"))
    documents(spark, rows).write.parquet(os.path.join(path, "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(os.path.join(path, "benchmark.parquet"))
    return path, rows, items


def test_stages_and_chain(spark, tables, tmp_path):
    path, rows, items = tables
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "benchmark_decontamination", "secret_scans", "packing"]
    stage, docs, left = dict(corpus_pipeline.STAGES), spark.read.parquet(os.path.join(path, "documents.parquet")), rows

    def step(name):
        out = stage[name](spark, docs, path)
        if name != "packing":
            assert out.columns == ["doc_id", "text", *CLASHING]
        out.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    docs = step("quality_rules")
    left = [r for r in left if not any(eval(quality.RULES[n][1], {}, _quality(r[1])) for n in quality.POLICIES["corpus-2"])]
    assert sorted(map(str, docs.select("doc_id", "text").collect())) == sorted(map(str, spark.createDataFrame(left, "doc_id long, text string").collect()))

    docs = step("near_duplicates")
    firsts = {c for _, n, c in _components(left, Rule())}
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(kept) == firsts and docs.count() == len(firsts)
    left = list(kept.items())

    docs = step("benchmark_decontamination")
    windows = {}
    for item, text in items:
        w = decontamination.words_of(text)
        for i in range(len(w) - 12):
            windows.setdefault(tuple(w[i:i + 13]), set()).add(str(item))
    left = [r for r in left if not _flag(r[1], windows)]
    assert {r["doc_id"] for r in docs.collect()} == {i for i, _ in left} and 310 in kept and not {300, 301, 302, 303, 304} & {i for i, _ in left}

    docs = step("secret_scans")
    after = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(after) == {i for i, _ in left}
    assert "hunter2000" not in after[311] and "[SECRET]" in after[311]
    assert all(after[i] == t for i, t in left if i != 311)

    pieces = step("packing").collect()
    assert {p["doc_id"] for p in pieces} == set(after)
    chain = corpus_pipeline.run(spark, path)
    plain = lambda rows: sorted((p["doc_id"] is not None, p["doc_id"], p["start"], p["length"], p["ids_crc32"]) for p in rows)
    assert plain(chain.collect()) == plain(pieces)


def test_registered(spark):
    names = __spark_entry__.queries()
    for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert names["pipeline"] is corpus_pipeline.run
    assert set(__spark_entry__.oracle_sql()) <= set(names)
