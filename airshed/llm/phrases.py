"""Substring dedup with repeated-phrase automata.

Each window of 35 words has an anchor, the run of 8 words in it with the least hash; equal
windows have equal anchors, and consecutive windows mostly share theirs, so a document falls into
segments of windows with one anchor, about a fifteenth of its words in number. Only segments
whose anchor occurs again can hold a recurring window. Of these, equal segments are
counted together, windows of segments that differ are counted by a 128-bit hash, and the
recurring phrases of each shard of anchors are compiled into an Aho-Corasick automaton, through which
the shard's segments of all documents are streamed. What it finds is carried to the places of each segment.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import slices, table, texts, written
from airshed.llm.hashing import grams, mixed, word_hashes

WINDOW, ANCHOR = 35, 8
#: Segments in a shard, and occurrences of one anchor beyond which its segments are dealt to several groups.
SHARD_SEGMENTS, HOT_ANCHOR = 5000, 20_000
#: Marks a number of windows (at most 28).
TWICE = 32
#: The base of a window's second hash.
_SECOND = 0xD6E8FEB86659FD93


def anchored(words: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window and number of windows of each segment of a document (word hashes).
    ``TWICE`` is added to the number where the anchor stands at several places of the segment."""
    if len(words) < window:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    g = mixed(grams(words, anchor))
    width, least, size = window - anchor + 1, np.arange(len(g)), 1
    def lower(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(g[a] <= g[b], a, b)  # the leftmost of equal ones
    while size * 2 <= width:
        least, size = lower(least[:-size], least[size:]), size * 2
    if size < width:
        least = lower(least[:len(least) - (width - size)], least[width - size:])
    chosen = g[least]
    change = np.concatenate([[True], chosen[1:] != chosen[:-1]])
    # a hash that repeats within a window's reach goes on for longer; pieces have at most ``width`` windows
    start = np.flatnonzero(change)
    since = np.arange(len(chosen)) - np.repeat(start, np.diff(np.append(start, len(chosen))))
    first = np.flatnonzero(since % width == 0)
    n = np.diff(np.append(first, len(chosen)))
    return chosen[first].view(np.int64), first, n + TWICE * (least[first] != least[first + n - 1])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _flushed(rows: Iterator[tuple], schema: pa.Schema, step: int) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= step:
            yield _batch(held, schema)
            held = []
    yield _batch(held, schema)


def _bytes(batch: pa.RecordBatch, at: int) -> list[pa.Array]:
    """A batch's columns, the texts in one of them as their UTF-8 bytes."""
    return [c.cast(pa.binary()) if i == at else c for i, c in enumerate(batch.columns)]


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


_LONGS = pa.list_(pa.int64())
_DOCS = pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("n_words", pa.int64()), ("whole", pa.string()),
                   ("anchors", _LONGS), ("firsts", _LONGS), ("counts", _LONGS)])


def _read_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for doc_id, k1, k2, text in zip(*_bytes(batch, 3), strict=True):
                words = text.as_py().split()
                yield (doc_id.as_py(), k1.as_py(), k2.as_py(), len(words), _sha(words), *anchored(word_hashes(words)))
    with np.errstate(over="ignore"):
        yield from _flushed(rows(), _DOCS, 500)


_PLACES = pa.schema([("s1", pa.int64()), ("s2", pa.int64()), ("anchor", pa.int64()), ("occurs", pa.int64()), ("k1", pa.int64()),
                     ("k2", pa.int64()), ("at", pa.int64()), ("windows", pa.int64()), ("times", pa.int64())])


def _window_hashes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return mixed(grams(words, WINDOW)), mixed(grams(words, WINDOW, _SECOND))


def _name_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per segment of (k1, k2, text, rows, anchors, occurs, ats, windows). Its name is made of the hashes of its
    first and last windows, which together hold all its words, and their distance."""
    with np.errstate(over="ignore"):
        for batch in batches:
            for a, b in slices(batch.num_rows, 200):
                columns: list[list[np.ndarray]] = [[] for _ in _PLACES]
                for k1, k2, text, rows, anchors, occurs, ats, windows in zip(*(c.slice(a, b - a) for c in _bytes(batch, 2)), strict=True):
                    at, marked = (np.array(x.as_py(), dtype=np.int64) for x in (ats, windows))
                    n = marked % TWICE
                    names = [mixed(w[at] * np.uint64(0x9E3779B97F4A7C15) + mixed(w[at + n - 1] + n.astype(np.uint64))).view(np.int64)
                             for w in _window_hashes(word_hashes(text.as_py().split()))]
                    fixed = [np.full(len(at), x.as_py(), dtype=np.int64) for x in (k1, k2, rows)]
                    for column, values in zip(columns, (*names, np.array(anchors.as_py()), np.array(occurs.as_py()), fixed[0], fixed[1], at, marked, fixed[2]), strict=True):
                        column.append(values)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], schema=_PLACES)


_WINDOWS = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("offset", pa.int32()), ("times", pa.int64())])


def _cut_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both hashes of every window of the segments listed with each text."""
    with np.errstate(over="ignore"):
        for batch in batches:
            for a, b in slices(batch.num_rows, 100):
                columns: list[list[np.ndarray]] = [[] for _ in _WINDOWS]
                for text, segments in zip(*(c.slice(a, b - a) for c in _bytes(batch, 0)), strict=True):
                    w1, w2 = _window_hashes(word_hashes(text.as_py().split()))
                    s1, s2, at, n, times = (np.array(x, dtype=np.int64) for x in zip(
                        *((s["s1"], s["s2"], s["at"], s["windows"] % TWICE, s["times"]) for s in segments.as_py()), strict=True))
                    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    place = np.repeat(at, n) + offset
                    for column, values in zip(columns, (w1[place].view(np.int64), w2[place].view(np.int64), np.repeat(s1, n), np.repeat(s2, n),
                                                        offset.astype(np.int32), np.repeat(times, n)), strict=True):
                        column.append(values)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], schema=_WINDOWS)


_TEXTS = pa.schema([("shard", pa.int32()), ("salt", pa.int32()), ("salts", pa.int32()), ("s1", pa.int64()), ("s2", pa.int64()),
                    ("segment", pa.binary()), ("offsets", pa.list_(pa.int32())), ("whole", pa.bool_())])


def _cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each segment listed with each text, with its phrases and its group."""
    def rows():
        for batch in batches:
            for text, segments in zip(*_bytes(batch, 0), strict=True):
                words = text.as_py().split()
                for s in segments.as_py():
                    yield (s["shard"], s["salt"], s["salts"], s["s1"], s["s2"], b" ".join(words[s["at"]:s["at"] + s["windows"] % TWICE + WINDOW - 1]),
                           s["offsets"], s["whole"])
    yield from _flushed(rows(), _TEXTS, 5000)


class _Letters(dict):
    """A letter for each word, a new one for a new word."""

    def __missing__(self, word: bytes) -> str:
        n = len(self) + 2
        letter = self[word] = chr(n if n < 0xD800 else n + 0x800)
        return letter


class Automaton:
    """An Aho-Corasick automaton over words: a word of its phrases is one letter, any other word a letter in no phrase."""

    def __init__(self):
        self.letters, self.found, self.empty = _Letters(), ahocorasick.Automaton(), True

    def spell(self, words: list[bytes]) -> str:
        """Words as letters, with new letters for new words."""
        return "".join(map(self.letters.__getitem__, words))

    def add(self, phrase: str) -> None:
        self.found.add_word(phrase, len(phrase))
        self.empty = False

    def compile(self) -> None:
        self.found.make_automaton()

    def read(self, words: list[bytes]) -> str:
        return "".join(map(self.letters.get, words, repeat("\x01")))

    def ranges(self, spelled: str) -> list[tuple[int, int]]:
        """The merged stretches of words that occurrences of phrases cover."""
        out: list[tuple[int, int]] = []
        if self.empty:
            return out
        for last, n in self.found.iter(spelled):
            start = last + 1 - n
            while out and out[-1][1] >= start:
                start = min(start, out.pop()[0])
            out.append((start, last + 1))
        return out


_RANGES = pa.schema([("s1", pa.int64()), ("s2", pa.int64()), ("starts", _LONGS), ("ends", _LONGS)])


def _search(group: list[dict]) -> Iterator[tuple]:
    """One group: its phrases are compiled, then all its segments streamed through the automaton."""
    automaton = Automaton()
    for row in group:
        row["words"] = row["segment"].split()
        if row["whole"] or row["offsets"]:
            row["spelled"] = spelled = automaton.spell(row["words"])
            if row["whole"]:
                automaton.add(spelled)
            for at in row["offsets"] or ():
                automaton.add(spelled[at:at + WINDOW])
    automaton.compile()
    for row in group:
        if not row["guest"] and (found := automaton.ranges(row.get("spelled") or automaton.read(row["words"]))):
            yield row["s1"], row["s2"], [r[0] for r in found], [r[1] for r in found]


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, salt, guest, s1, s2, segment, offsets, whole) sorted by shard and salt; a guest only brings its phrases."""
    def rows():
        now, group = None, []
        for batch in batches:
            for a, b in slices(batch.num_rows, 2000):
                for row in batch.slice(a, b - a).to_pylist():
                    if (row["shard"], row["salt"]) != now:
                        yield from _search(group)
                        now, group = (row["shard"], row["salt"]), []
                    group.append(row)
        yield from _search(group)
    yield from _flushed(rows(), _RANGES, 5000)


_KEPT = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("kept_text", pa.string())])


def _remove(with_text: bool):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for k1, k2, text, spans in zip(*_bytes(batch, 2), strict=True):
                    words = text.as_py().split()
                    change = np.zeros(len(words) + 1, dtype=np.int64)
                    for s in spans.as_py():
                        change[s["start"]] += 1
                        change[s["end"]] -= 1
                    keep = np.flatnonzero(np.cumsum(change[:-1]) == 0)
                    kept = [words[i] for i in keep]
                    yield (k1.as_py(), k2.as_py(), len(words) - len(kept), _sha(kept), b" ".join(kept).decode() if with_text else None)
        yield from _flushed(rows(), _KEPT, 500)
    return remove


def remove_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, unless ``with_text=False``, kept_text
    (null where nothing is removed) of every row of ``docs`` (doc_id, text).

    Every word covered by a window of 35 words that starts at another place too, of any row, is removed.
    A null text has no words; texts of fewer than 35 words lose nothing; repeated rows repeat each
    other's windows; null doc_ids are as good as any. An empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    # 128 bits that name a row's id and text: rows that share them share their result
    d = texts(docs).select("doc_id", *[F.xxhash64(F.lit(i), F.coalesce("doc_id", F.lit(-1)), F.col("doc_id").isNull(), text).alias(f"k{i}") for i in (1, 2)],
                           text.alias("text"))
    longs = "array<long>"
    base = written(d.mapInArrow(_read_documents, f"doc_id long, k1 long, k2 long, n_words long, whole string, anchors {longs}, firsts {longs}, counts {longs}")
                   .withColumn("uid", F.monotonically_increasing_id()), "phrase-documents")

    # segments whose anchor occurs again; counts are summed before they are shuffled
    places = base.select("uid", F.explode(F.arrays_zip(F.col("anchors").alias("anchor"), F.col("firsts").alias("at"), F.col("counts").alias("windows"))).alias("p")).select(
        "uid", "p.anchor", (F.col("p.at") * 64 + F.col("p.windows")).alias("place"))
    again = places.groupBy("anchor").agg(F.sum(F.when(F.col("place") % 64 > TWICE, 2).otherwise(1)).alias("occurs")).filter("occurs > 1")
    chosen = places.join(again, "anchor").groupBy("uid").agg(F.collect_list(F.struct("anchor", "occurs", "place")).alias("p"))
    chosen = base.select("uid", "k1", "k2").join(chosen, "uid").groupBy("k1", "k2").agg(F.first("p").alias("p"), F.count("*").alias("rows")).select(
        "k1", "k2", "rows", "p.anchor", "p.occurs", F.expr("transform(p.place, x -> x div 64)").alias("ats"), F.expr("transform(p.place, x -> x % 64)").alias("windows"))
    # the texts that hold such segments
    held = written(d.select("k1", "k2", "text").join(chosen, ["k1", "k2"]).dropDuplicates(["k1", "k2"]), "phrase-texts")
    found_at = written(held.select("k1", "k2", "text", "rows", "anchor", "occurs", "ats", "windows").mapInArrow(
        _name_segments, "s1 long, s2 long, anchor long, occurs long, k1 long, k2 long, at long, windows long, times long"), "phrase-places")
    body = held.select("k1", "k2", "text")

    # different segments, each with one of its places; where an anchor has several, or one that may repeat
    # a window itself, windows are compared
    segments = written(found_at.groupBy("s1", "s2").agg(F.min(F.struct("k1", "k2", "at")).alias("place"), F.first("windows").alias("windows"),
                                                        F.first("anchor").alias("anchor"), F.first("occurs").alias("occurs"), F.sum("times").alias("times"))
                       .select("s1", "s2", "place.*", "windows", "anchor", "occurs", "times"), "phrase-segments")
    several = segments.groupBy("anchor").agg(F.count("*").alias("kinds"), F.max("windows").alias("most")).filter(f"kinds > 1 or most > {TWICE}").select("anchor")
    listed = segments.join(several, "anchor", "left_semi").groupBy("k1", "k2").agg(F.collect_list(F.struct("s1", "s2", "at", "windows", "times")).alias("segments"))
    windows = body.join(listed, ["k1", "k2"]).select("text", "segments").mapInArrow(_cut_windows, "w1 long, w2 long, s1 long, s2 long, offset int, times long")
    # a recurring window is a phrase of the first segment that holds it
    phrases = written(windows.groupBy("w1", "w2").agg(F.sum("times").alias("times"), F.min(F.struct("s1", "s2", "offset")).alias("place")).filter("times > 1")
                      .groupBy("place.s1", "place.s2").agg(F.collect_list("place.offset").alias("offsets")), "phrase-phrases")

    # automata: one for each shard of anchors; a hot anchor's segments are dealt to several groups, and its phrases to all of them
    n_shards = segments.count() // SHARD_SEGMENTS + 1
    salts = (F.col("occurs") / HOT_ANCHOR).cast("int") + 1
    grouped = (segments.join(several.withColumn("mixed", F.lit(True)), "anchor", "left").join(phrases, ["s1", "s2"], "left").select(
        "k1", "k2", F.struct(F.pmod("anchor", F.lit(n_shards)).cast("int").alias("shard"), F.pmod(F.xxhash64("s1", "s2"), salts).cast("int").alias("salt"),
                             salts.alias("salts"), "s1", "s2", "at", "windows", "offsets", (F.col("mixed").isNull() & (F.col("times") > 1)).alias("whole")).alias("s"))
        .groupBy("k1", "k2").agg(F.collect_list("s").alias("segments")))
    search = body.join(grouped, ["k1", "k2"]).select("text", "segments").mapInArrow(
        _cut_texts, "shard int, salt int, salts int, s1 long, s2 long, segment binary, offsets array<int>, whole boolean")
    # to its own group a segment goes whole; to its anchor's other groups it goes as a guest if it has phrases
    to = F.when((F.col("salts") > 1) & (F.col("whole") | F.col("offsets").isNotNull()), F.sequence(F.lit(0), F.col("salts") - 1)).otherwise(F.array("salt"))
    search = search.withColumn("to", F.explode(to)).select("shard", F.col("to").alias("salt"), (F.col("to") != F.col("salt")).alias("guest"),
                                                           "s1", "s2", "segment", "offsets", "whole")
    ranges = written(search.repartition("shard", "salt").sortWithinPartitions("shard", "salt")
                     .mapInArrow(_stream, f"s1 long, s2 long, starts {longs}, ends {longs}"), "phrase-ranges")

    spans = (found_at.join(ranges, ["s1", "s2"])
             .select("k1", "k2", "at", F.explode(F.arrays_zip("starts", "ends")).alias("r"))
             .groupBy("k1", "k2").agg(F.collect_list(F.struct((F.col("at") + F.col("r.starts")).alias("start"), (F.col("at") + F.col("r.ends")).alias("end"))).alias("spans")))
    kept = (body.join(spans, ["k1", "k2"]).select("k1", "k2", "text", "spans")
            .mapInArrow(_remove(with_text), "k1 long, k2 long, n_removed long, kept string, kept_text string"))
    out = base.select("doc_id", "k1", "k2", "n_words", "whole").join(kept, ["k1", "k2"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("kept", "whole").alias("kept_sha256"), "kept_text")
    return out if with_text else out.drop("kept_text")


def op5_phrase_automata(spark, sf_dir: str) -> DataFrame:
    """All documents without the windows of 35 words that occur more than once."""
    return remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (SELECT r, unnest(list_transform(range(1, len(words) - 33), lambda i: {'i': i, 'w': md5(array_to_string(words[i:i + 34], ' '))})) AS x
  FROM d WHERE len(words) >= 35),
repeated AS (SELECT r, x.i AS i FROM windows QUALIFY count(*) OVER (PARTITION BY x.w) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM repeated),
words AS (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS s FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
