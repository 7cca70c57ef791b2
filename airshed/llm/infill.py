"""Fill-in-middle transformation over indexable skip lists.

A text is a row of units: single code points, or the matches of a pattern. Its skip list keeps one bottom
node for every few units and express lanes above; each link of each lane carries how many units and how many code
points it passes. A cut at a given unit is found from the top lane down: a link is followed while the units
it passes do not reach beyond the cut, and the code points passed add up to the place of the cut in the text.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import table, texts

#: Units of a bottom node; a link one lane up passes about LANE_STEP links of the lane below.
NODE_UNITS, LANE_STEP = 64, 4
#: An output batch ends after so many characters or rows.
BATCH_CHARS, BATCH_ROWS = 4_000_000, 2_000


@dataclass(frozen=True)
class Format:
    """How cuts are drawn and pieces written. ``seed`` and the id give each document its cuts whatever the partitioning;
    ``rate`` of 100 documents are transformed, ``spm_rate`` of 100 of these suffix first. A text that holds a mark stays plain."""
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    seed: str = "1"
    rate: int = 90
    spm_rate: int = 20


class SkipList:
    """Widths of runs of units, in order, with express lanes over them."""

    def __init__(self, widths: Iterator[tuple[int, int]]) -> None:
        """``widths``: units and code points of each bottom node."""
        # a lane: for each of its links the units and code points it passes and the link below at which it starts
        bottom = list(widths)
        self.lanes = [([u for u, _ in bottom], [c for _, c in bottom], range(len(bottom)))]
        lift = 0
        while len(self.lanes[-1][0]) > LANE_STEP:
            units, points, _ = self.lanes[-1]
            starts = [0] + [i for i in range(1, len(units)) if _coin(lift, i)]
            ends = starts[1:] + [len(units)]
            if len(starts) == len(units):  # no link was merged: the coins of the next lane are others
                lift += 1
                continue
            self.lanes.append(([sum(units[a:b]) for a, b in zip(starts, ends, strict=True)],
                               [sum(points[a:b]) for a, b in zip(starts, ends, strict=True)], starts))
            lift += 1
        self.units, self.points = sum(self.lanes[-1][0]), sum(self.lanes[-1][1])

    def descend(self, cut: int) -> tuple[int, int]:
        """Units and code points before the bottom node that holds the unit number ``cut`` (or before the end)."""
        at, passed, points = 0, 0, 0
        for lane in range(len(self.lanes) - 1, -1, -1):
            units, widths, starts = self.lanes[lane]
            while at < len(units) and passed + units[at] <= cut:
                passed, points, at = passed + units[at], points + widths[at], at + 1
            if lane:
                at = starts[at] if at < len(units) else len(self.lanes[lane - 1][0])
        return passed, points


def _coin(lane: int, link: int) -> bool:
    """Whether a link of a lane also starts one of the lane above (one in LANE_STEP does)."""
    return zlib.crc32(b"%d %d" % (lane, link)) % LANE_STEP == 0


def _code_points(text: str) -> Iterator[tuple[int, int]]:
    """Bottom nodes of a text whose units are its code points."""
    for at in range(0, len(text), NODE_UNITS):
        n = min(NODE_UNITS, len(text) - at)
        yield n, n


def _matches(pattern: re.Pattern) -> Callable[[str], Iterator[tuple[int, int]]]:
    """Bottom nodes of a text whose units are the ends of a pattern's matches, left to right: a unit is a match with what lies
    between it and the one before; what follows the last match is a unit too. Empty matches are none."""
    def nodes(text: str) -> Iterator[tuple[int, int]]:
        ends, at = (m.end() for m in pattern.finditer(text) if m.end() > m.start()), 0
        while run := list(islice(ends, NODE_UNITS)):
            yield len(run), run[-1] - at
            at = run[-1]
        if at < len(text):
            yield 1, len(text) - at
    return nodes


def cuts(text: str, draw: Callable[[int], tuple[int, int]], pattern: re.Pattern | None = None) -> tuple[int, int, int]:
    """The number n of units of a text and the code points before its two cuts, which ``draw(n)`` gives in units."""
    if pattern is None:
        listed = SkipList(_code_points(text))
    else:
        listed = SkipList(_matches(pattern)(text))
    places = []
    for cut in sorted(draw(listed.units)):
        passed, points = listed.descend(cut)
        if pattern is None:
            points += cut - passed
        elif cut > passed:  # inside a node: its units are matched again
            ends = (m.end() for m in pattern.finditer(text, points) if m.end() > m.start())
            points = next(islice(ends, cut - passed - 1, None))
        places.append(points)
    return listed.units, places[0], places[1]


_OUT = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                  ("middle_chars", pa.int64()), ("output", pa.string())])


def _transformed(doc_id: int | None, text: str, form: Format, pattern: re.Pattern | None) -> tuple:
    drawn = hashlib.sha256(f"{form.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(drawn[i:i + 8], 16) for i in range(0, 32, 8))
    n, a, b = cuts(text, lambda n: (h1 % (n + 1), h2 % (n + 1)), pattern)
    p, s, m = form.prefix, form.suffix, form.middle
    if not text or p in text or s in text or m in text or h3 % 100 >= form.rate:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < form.spm_rate:
        return doc_id, n, "spm", a, b - a, f"{s}{text[b:]}{p}{text[:a]}{m}{text[a:b]}"
    return doc_id, n, "psm", a, b - a, f"{p}{text[:a]}{s}{text[b:]}{m}{text[a:b]}"


def fill_in_middle(docs: DataFrame, form: Format = Format(), units: str | None = None) -> DataFrame:
    """doc_id, n (units), form (plain, psm, spm), prefix_chars, middle_chars and output of every row of ``docs`` (doc_id, text).

    ``units``: a regular expression whose matches end the units, or None for code points. A null text counts as
    empty; an empty text and one that holds a mark are plain. A null doc_id draws as an empty number, so such rows and
    rows that repeat a doc_id draw alike, each from its own text. Texts of any length are cut whole, row by row and without a
    shuffle; further columns are left behind; an empty table gives no rows.
    """
    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = None if units is None else re.compile(units)
        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(*batch.columns, strict=True):
                rows.append(_transformed(doc_id.as_py(), text.as_py() or "", form, pattern))
                held += len(rows[-1][5])
                if held >= BATCH_CHARS or len(rows) >= BATCH_ROWS:
                    yield _batch(rows)
                    rows, held = [], 0
            yield _batch(rows)
    return texts(docs).mapInArrow(transform, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in _OUT]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _OUT.types, strict=True)], schema=_OUT)


def restored(form: Column, output: Column, written: Format = Format()) -> Column:
    """The text that an output was made from. The text of a transformed document holds no mark, so each mark
    stands once in its output and parts the pieces."""
    p, s, m = written.prefix, written.suffix, written.middle

    def between(first: str, last: str) -> Column:
        return F.substring_index(F.substring_index(output, last, 1), first, -1)
    middle = F.substring_index(output, m, -1)
    return (F.when(form == "psm", F.concat(between(p, s), middle, between(s, m)))
            .when(form == "spm", F.concat(between(p, m), middle, between(s, p))).otherwise(output))


def op11_indexable_skip_list(spark, sf_dir: str) -> DataFrame:
    """Every document cut at two code points and written with marks, and the text rebuilt from what was written.
    Null and empty texts, repeated rows and null ids: see ``fill_in_middle``."""
    out = fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(restored(F.col("form"), F.col("output")).cast("binary"), 256).alias("restored_sha256"))


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (SELECT doc_id, t, length(t) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
cut AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
pieces AS (SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1) AS s FROM cut)
SELECT doc_id, n, form, if(form = 'plain', NULL, a) AS prefix_chars, if(form = 'plain', NULL, b - a) AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM pieces
"""
