"""Fill-in-middle over skip lists: cuts, pieces and the rebuilt text against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from airshed.llm import infill
from tests.llm.fixtures import corpus, documents

ODD = [(1000, "has <P> inside"), (1001, "<S>"), (1002, "x<M>y"), (1003, "<P"), (1004, "a<b>c<"), (1005, "é\U0001F600\r\n" * 40), (1006, "x"), (None, "tail <S")]


def _plain_cuts(text, draw, pattern):
    ends = list(range(1, len(text) + 1)) if pattern is None else [m.end() for m in pattern.finditer(text) if m.end() > m.start()]
    if (ends[-1] if ends else 0) < len(text):
        ends.append(len(text))
    a, b = sorted(draw(len(ends)))
    return len(ends), ([0] + ends)[a], ([0] + ends)[b]


def _brute(doc_id, text, form=infill.Format(), pattern=None):
    text = text or ""
    h = hashlib.sha256(f"{form.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n, a, b = _plain_cuts(text, lambda n: (h1 % (n + 1), h2 % (n + 1)), pattern)
    if not text or any(m in text for m in (form.prefix, form.suffix, form.middle)) or h3 % 100 >= form.rate:
        return doc_id, n, "plain", None, None, text
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h4 % 100 < form.spm_rate:
        return doc_id, n, "spm", a, b - a, form.suffix + suf + form.prefix + pre + form.middle + mid
    return doc_id, n, "psm", a, b - a, form.prefix + pre + form.suffix + suf + form.middle + mid


@pytest.mark.parametrize("pattern", [None, re.compile(r"\S+"), re.compile(r"[^\n]*\n"), re.compile("x*")])
def test_skip_list_finds_every_cut(pattern):
    rng = random.Random(3)
    for n in [*range(0, 200, 7), 63, 64, 65, 4096, 50_000]:
        text = "".join(rng.choice("ab é日\U0001F600\nx") for _ in range(n))
        units = _plain_cuts(text, lambda n: (0, n), pattern)[0]
        for cut in {(0, units), (units, 0), (units // 2, units // 2), (rng.randrange(units + 1), rng.randrange(units + 1))}:
            assert infill.cuts(text, lambda n, cut=cut: cut, pattern) == _plain_cuts(text, lambda n, cut=cut: cut, pattern)


def test_lanes_carry_both_widths():
    listed = infill.SkipList(infill._matches(re.compile(r"\w+"))("één woord " * 5000))
    assert len(listed.lanes) > 3 and len(listed.lanes[-1][0]) <= infill.LANE_STEP
    for units, points, _ in listed.lanes:
        assert (sum(units), sum(points)) == (listed.units, listed.points) == (10_001, 50_000)
    for (_, upper, starts), (_, lower, _) in zip(listed.lanes[1:], listed.lanes, strict=False):
        assert [sum(lower[a:b]) for a, b in zip(starts, [*starts[1:], len(lower)], strict=True)] == upper


@pytest.mark.parametrize("units", [None, r"\S+"])
def test_documents_are_transformed_and_restored(spark, units):
    rows = corpus() + ODD
    form = infill.Format(seed="7", rate=80, spm_rate=50)
    out = infill.fill_in_middle(documents(spark, rows), form, units)
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = out.withColumn("text", infill.restored(F.col("form"), F.col("output"), form)).collect()
    want = [(*_brute(i, t, form, units and re.compile(units)), t or "") for i, t in rows]
    assert Counter(tuple(r) for r in got) == Counter(want)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_query_columns_against_brute_force(spark, tmp_path):
    from airshed.llm.catalog import QUERIES
    rows = corpus() + ODD
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op11_indexable_skip_list"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]

    def digest(t):
        return hashlib.sha256(t.encode()).hexdigest()
    assert Counter(tuple(r) for r in got.collect()) == Counter((*(b := _brute(i, t))[:5], digest(b[5]), digest(t or "")) for i, t in rows)


def test_empty_table(spark):
    assert infill.fill_in_middle(documents(spark, [])).collect() == []
