"""Benchmark decontamination with an FM-index for each shard of documents.

A shard is a bounded stretch of the documents one task reads. Its words become
numbers of the benchmark's vocabulary; a word outside of it can be in no occurrence
of a window, so it only separates, and runs shorter than the shortest window are
left out of the index. Every window of the benchmark is searched backward in the
shard's FM-index, its occurrences are located, and their spans merged.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import scratch, table, texts
from airshed.llm.fmindex import FMIndex
from airshed.llm.warc import open_path

WINDOW = 13
#: Text bytes of one shard's index (a longer document is a shard of its own), and benchmark words in one block.
SHARD_BYTES, BLOCK_WORDS = 8 << 20, 1_000_000

#: Bytes that make words (digits, a to z, all of a non-ASCII character) stay, A to Z become a to z, the rest blank.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD_BYTES).split()


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        return 0


def _compile(items: list[tuple[str, str | None]]) -> dict:
    """A block of items as arrays: vocabulary, distinct windows right-aligned, and the items of each window."""
    numbers, windows = _Numbers(), {}
    for item, text in items:
        ids = [numbers.setdefault(w, len(numbers) + 1) for w in words_of(text)]
        for i in range(max(1, len(ids) - WINDOW + 1) if ids else 0):
            windows.setdefault(tuple(ids[i:i + WINDOW]), set()).add(item)
    patterns = np.zeros((len(windows), WINDOW), dtype=np.int64)
    for row, w in zip(patterns, windows, strict=True):
        row[WINDOW - len(w):] = w
    return {"numbers": numbers, "patterns": patterns, "lengths": np.array([len(w) for w in windows], dtype=np.int64),
            "items": [sorted(x) for x in windows.values()]}


def compile_benchmark(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> list[str]:
    """Write the benchmark's windows to the shared folder in blocks of about
    ``BLOCK_WORDS`` words, whole items each, and return their paths. The driver and
    every task hold one block at a time, however large the benchmark is.

    A null item id counts as the id "null"; rows with equal ids are one item
    where both are in a window's list; items without words have no window.
    """
    items = benchmark.select(F.coalesce(benchmark[id_col].cast("string"), F.lit("null")).alias("item"), benchmark[text_col].cast("string").alias("text"))
    n_words = items.agg(F.coalesce(F.sum(F.length("text") / 4), F.lit(0))).first()[0]
    n_blocks = int(n_words // BLOCK_WORDS) + 1
    folder, paths = scratch(benchmark.sparkSession, "benchmark-blocks"), []
    where, root = open_path(folder)
    where.create_dir(root, recursive=True)
    for b in range(n_blocks):
        block = items.filter(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == b)
        with where.open_output_stream(f"{root}/{b}") as out:
            out.write(pickle.dumps(_compile([(r["item"], r["text"]) for r in block.collect()])))
        paths.append(f"{folder}/{b}")
    return paths


@lru_cache(maxsize=1)
def _block(path: str) -> dict:
    where, name = open_path(path)
    with where.open_input_stream(name) as source:
        return pickle.loads(source.read())


def _occurrences(block: dict, docs: list[list[bytes]], starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word position (documents end to end, one blank after each) and window of every occurrence in the shard."""
    numbers, lengths = block["numbers"], block["lengths"]
    none = np.zeros(0, dtype=np.int64)
    if not len(lengths):
        return none, none
    ids = np.zeros(starts[-1], dtype=np.int64)
    for start, words in zip(starts, docs, strict=False):
        ids[start:start + len(words)] = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))
    edges = np.flatnonzero(np.diff(np.concatenate([[0], (ids != 0).astype(np.int8), [0]])))
    runs = edges.reshape(-1, 2)
    runs = runs[runs[:, 1] - runs[:, 0] >= lengths.min()]
    if not len(runs):
        return none, none
    size = runs[:, 1] - runs[:, 0] + 1  # with the blank that closes each run
    origin = np.repeat(runs[:, 0] - np.cumsum(size) + size, size) + np.arange(size.sum())
    index = FMIndex(ids[origin], len(numbers) + 1)
    first, end = index.search(block["patterns"], lengths)
    found = np.flatnonzero(end > first)
    n = end[found] - first[found]
    rows = np.repeat(first[found] - np.cumsum(n) + n, n) + np.arange(n.sum())
    return origin[index.locate(rows)], np.repeat(found, n)


def _merged(hit: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))).reshape(-1, 2)


def _search(paths: list[str], ids: list, found_texts: list) -> pa.RecordBatch:
    """One shard: all blocks of windows against the shard's documents."""
    docs = [words_of(t) for t in found_texts]
    n = np.array([len(d) for d in docs], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(n + 1)])
    change, items = np.zeros(starts[-1] + 1, dtype=np.int64), [set() for _ in docs]
    for path in paths:
        block = _block(path)
        at, window = _occurrences(block, docs, starts)
        np.add.at(change, at, 1)
        np.add.at(change, at + block["lengths"][window], -1)
        pairs = np.unique(np.stack([np.searchsorted(starts, at, "right") - 1, window]), axis=1) if len(at) else np.zeros((2, 0), dtype=np.int64)
        for doc, w in pairs.T:
            items[doc].update(block["items"][w])
    hit = np.cumsum(change) > 0
    rows = []
    for i, doc_id in enumerate(ids):
        spans = _merged(hit[starts[i]:starts[i] + n[i]]) if items[i] else ()
        places = [m.span() for m in _WORD.finditer(found_texts[i])] if items[i] else ()
        rows.append((doc_id, int(n[i]), sum(int(e - s) for s, e in spans), sorted(items[i]),
                     [{"start": places[s][0], "end": places[e - 1][1]} for s, e in spans]))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _SCHEMA.types, strict=True)], schema=_SCHEMA)


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                     ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def _shards(ids: list, found_texts: Iterator) -> Iterator[tuple[list, list]]:
    shard_ids, shard, size = [], [], 0
    for doc_id, text in zip(ids, found_texts, strict=True):
        shard_ids.append(doc_id)
        shard.append(text.as_py() or "")
        size += len(shard[-1])
        if size >= SHARD_BYTES:
            yield shard_ids, shard
            shard_ids, shard, size = [], [], 0
    if shard_ids:
        yield shard_ids, shard


def _contaminated(n_hit, n_words):
    return (n_hit > 0) & (20 * n_hit >= n_words)


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, items, spans and contaminated of every row of ``docs``.

    items: ids (sorted strings) with a window that occurs in the document; spans:
    the merged stretches to remove, in code points, end exclusive. contaminated: at least a twentieth of
    the words are hit. A null or empty text has no words, a null doc_id or repeated row is a row like
    any other, an empty benchmark hits nothing. Documents are read once and never shuffled.
    """
    paths = compile_benchmark(benchmark)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, shard in _shards(batch.column(0).to_pylist(), batch.column(1)):
                yield _search(paths, ids, shard)

    schema = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start: long, end: long>>"
    return texts(docs).mapInArrow(search, schema).withColumn("contaminated", _contaminated(F.col("n_hit"), F.col("n_words")))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any further columns, kept as they are) that are not contaminated."""
    paths, at = compile_benchmark(benchmark), docs.columns.index("text")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [not _contaminated(hit, n) for ids, shard in _shards(list(range(batch.num_rows)), batch.column(at))
                    for found in [_search(paths, ids, shard)] for n, hit in zip(found["n_words"].to_pylist(), found["n_hit"].to_pylist(), strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(search, docs.schema)


def op4_fm_index(spark, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


ORACLE = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
bw AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
bs AS (SELECT item, words, least(len(words), 13) AS n, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i FROM bw WHERE len(words) > 0),
bwin AS (SELECT DISTINCT item, n, array_to_string(words[i:i + n - 1], ' ') AS w FROM bs),
lens AS (SELECT DISTINCT n FROM bwin),
dwin AS (SELECT doc_id, n, unnest(list_transform(range(1, len(words) - n + 2), lambda i: {'i': i, 'w': array_to_string(words[i:i + n - 1], ' ')})) AS x
  FROM dw, lens WHERE len(words) >= n),
hits AS (SELECT doc_id, x.i AS i, dwin.n AS n, item FROM dwin JOIN bwin ON x.w = bwin.w AND dwin.n = bwin.n),
n_hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM dw LEFT JOIN n_hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""
