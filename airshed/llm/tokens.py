"""Token counts with a digest cache, and the tokenizer the operators share.

The cache is a Parquet table of (tokenizer digest, content digest, count). A
call joins the digests of its contents to it, encodes one text for each
digest that is missing, and appends those counts.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.common import forget, scratch, slices, table, texts, utf8_bytes, written

BYTE_BPE = "byte_bpe_50k.json"
#: Texts with a longer run of white space go to the tokenizers library, whose matcher needs no stack for it.
LONG_BLANK = re.compile(r"\s{1000}")
CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens long"


@lru_cache(maxsize=2)
def encoder(name: str):
    """A function from a text to its ids (numpy uint32), without added begin or
    end tokens; strings of special tokens inside a text count as the library's default has it.

    A plain byte-level BPE file is run by tiktoken on the same vocabulary and
    merges (same ids, four times as fast; the tests compare the two); any
    other file by its own library.
    """
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: np.array(model.encode(text), dtype=np.uint32)
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(path)
    plain = lambda text: np.array(library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    ranks = _ranks(spec)
    if ranks is None:
        return plain
    import tiktoken
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    fast = tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: plain(text) if LONG_BLANK.search(text) else fast.encode_to_numpy(text, allowed_special="all")


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """Token bytes to ids of a byte-level BPE whose merges make its tokens in
    the order of their ids; None for any other model."""
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    if (model["type"] != "BPE" or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex")
            or spec["normalizer"] or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"])):
        return None
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    added = {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
    made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    return ranks if made == sorted(made) and len(made) == len(set(made)) else None


def tokenizer_digest(name: str) -> str:
    """What a cached count depends on besides the text: the tokenizer file's SHA-256."""
    with open(public_tokenizers.path(name), "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def read_cache(spark: SparkSession, path: str) -> DataFrame | None:
    """The cache table, or None while nothing was ever written to it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema(CACHE_SCHEMA).parquet(path)


def count_tokens(docs: DataFrame, cache: str, tokenizer: str = BYTE_BPE) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row of ``docs`` (doc_id, text).

    Normalised content is the text itself, null as the empty text: nothing else
    keeps the counts of every tokenizer. Null doc_ids and repeated rows are rows of
    their own. The digests that the cache lacks are found without the texts; only if there are any, texts are shuffled. Each
    digest's text is encoded once, whichever and however many rows hold it: texts are
    reduced to one for each digest before and after the shuffle, so a text that a third of
    all rows share is no hot key. Two runs at a time may both encode
    and append a digest; the counts are equal and the join reads distinct rows.
    """
    spark, version = docs.sparkSession, tokenizer_digest(tokenizer)
    text = F.coalesce("text", F.lit(""))
    d = texts(docs).select("doc_id", text.alias("text"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))
    missing = d.select("digest").distinct()
    if (known := read_cache(spark, cache)) is not None:
        missing = missing.join(known.filter(F.col("tokenizer") == version).select("digest"), "digest", "left_anti")
    missing = written(missing, "token-missing")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = encoder(tokenizer)
        for batch in batches:
            counts = [len(ids(t)) for a, b in slices(batch.num_rows, 500) for t in batch.column(1).slice(a, b - a).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([version] * len(counts)), batch.column(0), pa.array(counts, pa.int64())],
                                             names=["tokenizer", "digest", "n_tokens"])

    if known is None or not missing.isEmpty():
        wanted = d.groupBy("digest").agg(F.first("text").alias("text")).join(missing, "digest", "left_semi")
        wanted.select("digest", "text").mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(cache)
    forget(missing)
    counts = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("tokenizer") == version).select("digest", "n_tokens").distinct()
    return d.select("doc_id", "digest", utf8_bytes(F.col("text")).alias("n_bytes")).join(counts, "digest").select("doc_id", "n_bytes", "n_tokens")


def op7_digest_cache(spark, sf_dir: str, cache: str | None = None) -> DataFrame:
    """Token counts of all documents, read through the cache: the first pass stores what it lacks, the second
    finds all digests in it and encodes nothing."""
    docs, cache = table(spark, sf_dir, "documents"), cache or scratch(spark, "token-cache")
    count_tokens(docs, cache)
    counts = count_tokens(docs, cache)
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)
