"""Packing by power-of-two decomposition.

A document's ids are cut into full sequences of the maximal length and, for the
rest, one piece for each set bit of its length, longest first. Each piece is a
sequence of its own, so no sequence crosses documents and none is padded;
sequences of equal length form a bucket.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed.llm.common import slices, table, texts, written
from airshed.llm.tokens import BYTE_BPE, encoder

MAX_LENGTH = 2048
#: Closes each document.
END_ID = 1

PIECE_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                          ("doc_tokens", pa.int64()), ("task", pa.int32()), ("nth", pa.int64()), ("ids", pa.list_(pa.int32()))])


def piece_lengths(n: int, longest: int = MAX_LENGTH) -> list[int]:
    """``longest`` (a power of two) as often as it fits, then the binary digits of the rest."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer: str = BYTE_BPE, longest: int = MAX_LENGTH, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, unless ``with_ids=False``, ids.

    A null or empty text is the end id alone; null doc_ids and repeated rows are
    documents of their own; an empty table gives no rows. ``bucket`` is the binary logarithm of
    the length; sequence ids are gapless, a bucket's ids follow the shorter buckets'.

    Documents never meet: tasks number the pieces of each length they make, the pieces
    are written, and only the counts per (task, length) are added up afterwards.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, made, task = encoder(tokenizer), Counter(), TaskContext.get().partitionId()
        for batch in batches:
            for a, b in slices(batch.num_rows, 500):
                rows = []
                for doc_id, text in zip(batch.column(0).slice(a, b - a).to_pylist(), batch.column(1).slice(a, b - a).to_pylist(), strict=True):
                    ids = np.append(ids_of(text or "").astype("<u4"), np.array([end_id], "<u4"))
                    start = 0
                    for length in piece_lengths(len(ids), longest):
                        piece = ids[start:start + length]
                        rows.append((doc_id, start, length, zlib.crc32(piece), len(ids), task, made[length], piece if with_ids else None))
                        made[length] += 1
                        start += length
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), PIECE_SCHEMA.types, strict=True)],
                                                 schema=PIECE_SCHEMA)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task int, nth long, ids array<int>"
    pieces = written(texts(docs).mapInArrow(cut, schema), "pieces")
    # two sums over (task, length), a row for each task and bucket: those of shorter buckets, and of earlier tasks in the bucket
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    buckets = counts.groupBy("length").agg(F.sum("n").alias("n"))
    shorter = Window.orderBy("length").rowsBetween(Window.unboundedPreceding, -1)  # at most one row per power of two
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = (counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
            .join(buckets.select("length", F.coalesce(F.sum("n").over(shorter), F.lit(0)).alias("bucket_0")), "length"))
    # the counts (a row for each task and bucket) go to the pieces: the ids are not shuffled
    out = pieces.join(F.broadcast(base), ["length", "task"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("bucket_0") + F.col("before") + F.col("nth")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), F.log2("length").cast("int").alias("bucket"), "ids")
    return out if with_ids else out.drop("ids")


def op3_power_of_two(spark, sf_dir: str) -> DataFrame:
    """All documents as sequences of at most 2048 tokens, none of them padded."""
    return pack(table(spark, sf_dir, "documents"), with_ids=False)
