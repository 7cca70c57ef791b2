"""Near duplicates by HyperMinHash.

Each shingle of a document falls into one of N buckets by its hash; a bucket's register keeps the smallest further hash that
fell into it as a floating-point number: the count of its leading zeros and the MANTISSA bits behind the first one. An empty
bucket borrows the register of a filled one, the same for every document in which that one is the first filled by the bucket's own order. Registers of
two documents agree about as often as their shingles, so bands of a few registers are keys under which similar documents
meet. Of the pairs that meet, those whose estimated similarity, corrected for registers that agree by collision, is too low are
left out, and the others are verified on the whole sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.llm import linking
from airshed.llm.common import settled, table, texts, written
from airshed.llm.hashing import mixed
from airshed.llm.linking import Rule, shingle_set

#: A register has 16 bits: six for the leading zeros and ten behind the first one.
MANTISSA = 10


@dataclass(frozen=True)
class Bands:
    """``bands`` keys of ``rows`` registers. Two documents of similarity s share no key with a probability of about (1 - s ** rows) ** bands;
    the estimate of s leaves a pair out only ``sigmas`` standard deviations below the rule's threshold."""
    bands: int = 32
    rows: int = 5
    sigmas: float = 6.0

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def least_bands(rule: Rule, miss: float = 1e-8) -> Bands:
    """Bands of five registers by which a pair at the rule's threshold is missed with a probability of at most ``miss``."""
    hit = (rule.num / rule.den) ** 5
    return Bands(bands=1 if hit == 1 else math.ceil(math.log(miss) / math.log1p(-hit)))


@lru_cache(maxsize=2)
def _orders(n: int) -> np.ndarray:
    """For each bucket its own order of all buckets, as ranks to be minimised."""
    with np.errstate(over="ignore"):
        return mixed(np.arange(1, n * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(n, n)


def compressed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as leading-zero counts and mantissas; larger hashes have no larger count."""
    # a float's exponent tells the leading zeros; rounding up at the mantissa's end is avoided by clearing the bits behind
    high = (x >> np.uint64(11)).astype(np.float64)
    zeros = (53 - np.frexp(high)[1]).astype(np.uint64)
    zeros = np.where(high == 0, np.uint64(53), np.minimum(zeros, np.uint64(53)))
    behind = (x << np.minimum(zeros + np.uint64(1), np.uint64(63))) >> np.uint64(64 - MANTISSA)
    return ((zeros << np.uint64(MANTISSA)) | behind).astype(np.uint16)


def registers(s: np.ndarray, n: int) -> np.ndarray:
    """The n registers of a set of shingle hashes that is not empty."""
    least = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
    filled = np.zeros(n, dtype=bool)
    at = (s % np.uint64(n)).astype(np.int64)
    filled[at] = True
    np.minimum.at(least, at, mixed(s ^ np.uint64(0xD6E8FEB86659FD93)))
    out = compressed(least)
    if not filled.all():
        places = np.flatnonzero(filled)
        out[~filled] = out[places[_orders(n)[~filled][:, places].argmin(axis=1)]]
    return out


def collisions(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How likely the registers of two different smallest hashes agree, given the shingles a bucket holds on average
    in each of the sets (at least one, as empty ones borrow): the chance that both fall into one cell, added up over the counts of zeros."""
    a, b = np.maximum(a, 1.0), np.maximum(b, 1.0)
    zeros = np.arange(54)[:, None]
    width = 2.0 ** -(zeros + 1 + MANTISSA)
    within = np.exp(-(a + b) * 2.0 ** -(zeros + 1.0)) - np.exp(-(a + b) * 2.0 ** -zeros.astype(float))
    return np.minimum((width * within).sum(axis=0) * a * b / (a + b), 0.5)


def estimated(u: np.ndarray, v: np.ndarray, n_u: np.ndarray, n_v: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of pairs of register rows, corrected for collisions."""
    agree = (u == v).mean(axis=1)
    by_chance = collisions(n_u / u.shape[1], n_v / u.shape[1])
    return (agree - by_chance) / (1 - by_chance)


_SKETCH = pa.schema([("doc_id", pa.int64()), ("text_digest", pa.binary()), ("n", pa.int64()), ("digest", pa.binary()), ("registers", pa.binary())])


def _sketches(rule: Rule, bands: Bands):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                n, digests, held = [], [], []
                for text in batch.column(2):
                    s = shingle_set(text.as_py(), rule.words)
                    n.append(len(s))
                    digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    held.append(registers(s, bands.registers).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.binary()), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                                                  pa.array(held, pa.binary())], schema=_SKETCH)
    return sketch


def _likely(rule: Rule, bands: Bands):
    """(u, v, n_u, n_v, r_u, r_v) -> the pairs (u, v) whose sizes allow a link and whose estimate is not too low for one."""
    t = rule.num / rule.den
    least = t - bands.sigmas * math.sqrt(max(t * (1 - t), 0.0) / bands.registers)

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            u, v, n_u, n_v = (batch.column(i).to_numpy() for i in range(4))
            r_u, r_v = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint16).reshape(len(batch), -1) for i in (4, 5))
            near = (estimated(r_u, r_v, n_u, n_v) >= least) & (rule.den * np.minimum(n_u, n_v) >= rule.num * np.maximum(n_u, n_v))
            yield pa.RecordBatch.from_arrays([pa.array(u[near]), pa.array(v[near])], names=["u", "v"])
    return likely


def band_keys(registers: Column, bands: Bands) -> Column:
    """The keys of a row's bands (array); a band's number is part of its key. Unequal bands with equal keys are compared in vain."""
    size = 2 * bands.rows
    return F.transform(F.sequence(F.lit(0), F.lit(bands.bands - 1)),
                       lambda i: F.xxhash64(F.call_function("substring", registers, i * size + 1, F.lit(size)), i))


def near_duplicates(docs: DataFrame, rule: Rule = Rule(), bands: Bands | None = None) -> DataFrame:
    """doc_id, text_digest, n_shingles, component_id and ``first`` of every row of ``docs`` (doc_id, text).

    component_id: the smallest doc_id in the component of links (null only where all ids in it are null);
    first: this row's (doc_id, text) is the component's first (smallest doc_id, null last; then smallest digest).
    A null text or one without words has an empty set, is linked with nothing and a component of its own.
    Repeated rows and texts with equal sets are in one component whatever their registers. Letters A to Z count as a to z; further columns
    are left behind; an empty table gives no rows. A link at the threshold is missed with a probability of at most 1e-8 (``least_bands``).
    """
    return settled(lambda: _near_duplicates(docs, rule, bands or least_bands(rule)), "minhash-components")


def _near_duplicates(docs: DataFrame, rule: Rule, bands: Bands) -> DataFrame:
    d = texts(docs).select("doc_id", F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("text_digest"), "text")
    sketched = written(d.mapInArrow(_sketches(rule, bands), "doc_id long, text_digest binary, n long, digest binary, registers binary"), "minhash-sketches")
    classes = written(sketched.filter("n > 0").groupBy("digest").agg(
        F.min("text_digest").alias("text_digest"), F.first("n").alias("n"), F.first("registers").alias("registers"))
        .withColumn("c", F.monotonically_increasing_id()), "minhash-classes")

    # only a set of which one more shingle leaves enough in common can link with another
    rows = classes.filter(F.lit(rule.den - rule.num) * F.col("n") >= rule.num).select("c", F.explode(band_keys(F.col("registers"), bands)).alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    buckets = written(rows.join(shared, "key"), "minhash-buckets")
    centred = written(linking.centres(buckets, ["c"]), "minhash-centres")
    pairs = linking.star_pairs(buckets, centred, ["c"])
    for side in ("v", "u"):
        own = classes.select(F.col("c").alias(side), F.col("n").alias(f"n_{side}"), F.col("registers").alias(f"r_{side}"))
        pairs = pairs.join(own, side)
    likely = written(pairs.select("u", "v", "n_u", "n_v", "r_u", "r_v").mapInArrow(_likely(rule, bands), "u long, v long"), "minhash-likely")

    # one text of each class whose whole set may be read; copies of a text are one before the shuffle
    wanted = linking.compared(linking.larger(buckets), centred, likely).join(classes.select("c", "text_digest"), "c")
    body = d.groupBy("text_digest").agg(F.first("text").alias("text"))
    sets = written(body.join(wanted, "text_digest").select("c", "text").mapInArrow(linking.whole_sets(rule), "c long, n long, shingles array<long>"), "minhash-sets")
    verdicts = written(linking.verify(likely, sets, rule), "minhash-verdicts")
    member = linking.members(linking.larger(buckets), centred, verdicts.filter("linked").select("u", "v"), sets, rule)
    return linking.labelled(sketched.select("doc_id", "text_digest", "n", "digest"), classes, member)


def op13_hyper_minhash(spark, sf_dir: str) -> DataFrame:
    """Components of all documents that share 0.85 of their three-word shingles, and whether a document is its component's first.
    Null, empty and repeated rows: see ``near_duplicates``; ``kept`` of a null id is true where all ids of the component are null."""
    out = near_duplicates(table(spark, sf_dir, "documents"), Rule(words=3, num=85, den=100))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents),
shingles AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(words) - 2, 1) + 1), lambda i: md5(array_to_string(words[i:i + 2], ' ')))) AS s
  FROM d WHERE len(words) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN sizes a ON x = a.doc_id JOIN sizes b ON y = b.doc_id WHERE 100 * n_both >= 85 * (a.n + b.n - n_both)),
reached AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY x) LEFT JOIN sizes USING (doc_id)
"""
