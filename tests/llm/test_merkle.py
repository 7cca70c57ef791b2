"""The Merkle manifest against trees built in plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from airshed.llm import merkle
from tests.llm.fixtures import CLASHING

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def _h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([_h(levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
    proofs = []
    for i in range(len(leaves)):
        steps = []
        for nodes in levels[:-1]:
            first = i // 16 * 16
            steps.append((i - first, nodes[first:i] + nodes[i + 1:first + 16]))
            i //= 16
        proofs.append(steps)
    return levels[-1][0], proofs


def _brute(rows):
    def leaf(row):
        return _h([_encoded(x) for x in row])
    by_source: dict = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for held in by_source.values():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = [_tree([leaf(r) for r in by_source[s]]) for s in names]
    root, above = _tree([t[0] for t in trees])
    out = []
    for name, (subroot, proofs), up in zip(names, trees, above, strict=True):
        for row, own in zip(by_source[name], proofs, strict=True):
            proof, shown = own + up, row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                shown = (*row[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[4]))
            digest = leaf(shown)
            for place, others in proof:
                digest = _h([*others[:place], digest, *others[place:]])
            out.append((row[0], leaf(row), subroot, root, _h([d for _, others in proof for d in others]), digest, digest == root))
    return out


def _rows(sizes):
    rng = random.Random(5)
    return [(rng.randrange(10_000), source, rng.choice(["en", "fr", None]), rng.choice([None, i]), rng.choice(["Text É", "plain", "", None, "A" * 40]))
            for source, n in sizes.items() for i in range(n)]


AWKWARD = _rows({"src": 1, "b": 16, "": 17, "é": 256, "zz": 257, "hot": 4200, None: 3}) + 2 * [(None, "b", None, None, None), (7, "b", "en", 1, "Same")]


@pytest.mark.parametrize("rows", [AWKWARD, _rows({"only": 40}), _rows({"one": 1}), _rows({f"s{i:03}": 2 for i in range(300)})])
def test_query_against_plain_trees(spark, tmp_path, rows):
    from airshed.llm.catalog import QUERIES
    d = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("extra") for c in (*CLASHING, "g", "idx", "block", "part", "place", "order", "proof")})
    d.repartition(7).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op12_time_forward"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(tuple(r) for r in got.collect()) == Counter(_brute(rows))


def test_proofs_are_real_outputs(spark):
    leaves = spark.createDataFrame([(i, "a" if i % 3 else "b", f"t{i}") for i in range(700)], "id long, source string, text string")
    out = merkle.manifest(leaves.withColumn("digest", merkle.leaf_digest(F.col("text"))), "source", "id").collect()
    assert len(out) == 700 and {r["root"] for r in out} == {merkle.folded(r["digest"], bytes(r["proof"])) for r in out}
    assert all(merkle.folded(hashlib.sha256(b"other").digest(), bytes(r["proof"])) != r["root"] for r in out)


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, source string, digest binary")
    assert merkle.manifest(none, "source", "doc_id").collect() == []
