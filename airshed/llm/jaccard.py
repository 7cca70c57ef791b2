"""N-gram Jaccard join over parity sketches.

A document's set of shingles is hashed into blocks; a block's sketch is the XOR of what
its shingles hash to, so a shingle that only one of two documents has changes one block of
one of them, and the blocks (and the parity bits) in which two sketches differ are at most as many as
the symmetric difference. Linked documents of one size band differ in at most d shingles, so of
d + 1 + x blocks at least x + 1 are equal: documents are joined on equal blocks (pigeonhole).

Documents with equal sets form a class first. In a bucket of equal blocks each class is compared with a few
centres (in a small one all with all), first by the Hamming distance of their parity bits, then on the whole sets; the links give components, and what lies
in several components of one bucket, and is close enough by its parity bits to a class of another one, is searched against an index of whole sets (``linking``).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.llm import linking
from airshed.llm.common import forget, settled, table, texts, written
from airshed.llm.hashing import mixed
from airshed.llm.linking import Rule, shingle_set

#: Bits of a bucket's key; unequal blocks that share a key are compared in vain, and nothing else.
KEY_BITS = 48
#: Parity bits of a block.
PARITY_BITS = 16
#: Parts of the keys that are dealt into buckets one after another: on disk lies the shuffle of one of them at a time.
KEY_PARTS = 4
#: Bytes of parity bits of a tile, pairs that are compared at once, and words of parity bits that are compared first.
TILE_BYTES, TILE_PAIRS, HEAD_WORDS = 1 << 23, 1 << 15, 24


@lru_cache(maxsize=4)
def _bands(rule: Rule) -> list[int]:
    """First sizes of the bands: sizes that may link are in one band or in neighbouring ones.
    A band spans the least power of 1 / similarity of at least 1.25: wider bands need more
    blocks, narrower ones make more sets emit blocks for the next band too."""
    firsts, power = [1], 1
    while (rule.den / rule.num) ** power < 1.25:
        power += 1
    while firsts[-1] < 1 << 40:
        end = firsts[-1]
        for _ in range(power):
            end = end * rule.den // rule.num + 1
        firsts.append(end)
    return firsts


def _reaches_next(rule: Rule, n: int, band: int) -> bool:
    """Whether a set of n shingles may link with one of the next band."""
    return rule.den * n >= rule.num * _bands(rule)[band + 1]


@lru_cache(maxsize=4096)
def _blocks(rule: Rule, band: int) -> tuple[int, int, int]:
    """Number of blocks for pairs whose larger set is in ``band``, the size below which a
    block is light, and the number x of light blocks a set may leave out. 0 blocks: only equal sets link."""
    firsts = _bands(rule)
    d = rule.difference(2 * (firsts[band + 1] - 1))
    if d < 1:
        return 0, 0, 0
    for light in (4, 3, 2, 1):
        x = 0
        for _ in range(8):
            mean = max(1, firsts[band] * rule.num / rule.den) / (d + 1 + x)
            part = math.exp(-mean) * sum(mean ** i / math.factorial(i) for i in range(light))
            x = math.ceil((d + 1 + x) * part + 2 * math.sqrt((d + 1 + x) * part))
        if x <= 0.1 * (d + 1) + 1 or light == 1:
            return d + 1 + min(x, d + 1), light, min(x, d + 1)
    raise AssertionError


def _places(s: np.ndarray, n_blocks: int) -> np.ndarray:
    return ((s >> np.uint64(32)) % np.uint64(n_blocks)).astype(np.int64)


def _keys(s: np.ndarray, rule: Rule, band: int) -> np.ndarray:
    """Bucket keys of the blocks a set emits for pairs whose larger set is in ``band``.

    A block without a differing shingle has the same content in both sets. At least
    x + 1 blocks are such; if either set has at most x light ones, both emit a heavy one of these,
    and otherwise both emit all their blocks: no link is lost."""
    n_blocks, light, spare = _blocks(rule, band)
    if not n_blocks:
        return np.zeros(0, dtype=np.int64)
    at = _places(s, n_blocks)
    size = np.bincount(at, minlength=n_blocks)
    sketch = np.zeros(n_blocks, dtype=np.uint64)
    np.bitwise_xor.at(sketch, at, mixed(s ^ np.uint64(0x5851F42D4C957F2D)))
    j = np.flatnonzero(size >= light)
    if n_blocks - len(j) > spare:
        j = np.arange(n_blocks)
    with np.errstate(over="ignore"):
        place = (np.uint64(band) << np.uint64(48)) + (j.astype(np.uint64) << np.uint64(24)) + size[j].astype(np.uint64)
        return (mixed(sketch[j] + mixed(place)) >> np.uint64(64 - KEY_BITS)).view(np.int64)


def _parity(s: np.ndarray, rule: Rule, band: int) -> bytes:
    """The set's parity bits: each shingle flips one bit of its block. Filled up to whole words of 64 bits."""
    n_blocks = -(-_blocks(rule, band)[0] * PARITY_BITS // 64) * 64 // PARITY_BITS
    if not n_blocks:
        return b""
    bit = _places(s, _blocks(rule, band)[0]) * PARITY_BITS + (s % np.uint64(PARITY_BITS)).astype(np.int64)
    return np.packbits((np.bincount(bit, minlength=PARITY_BITS * n_blocks) & 1).astype(np.uint8)).tobytes()


def _band(rule: Rule, n: int) -> int:
    return int(np.searchsorted(_bands(rule), n, "right")) - 1


_DIGESTS = pa.schema([("doc_id", pa.int64()), ("text_digest", pa.binary()), ("n", pa.int64()), ("digest", pa.binary())])


def _digests(rule: Rule):
    """The size and digest of each text's set."""
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                sets = (shingle_set(text.as_py(), rule.words) for text in batch.column(2))
                n, made = zip(*((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest()) for s in sets), strict=True) if len(batch) else ((), ())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.binary()), pa.array(n, pa.int64()), pa.array(made, pa.binary())],
                                                 schema=_DIGESTS)
    return digests


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


_KEYED = pa.schema([("c", pa.int64()), ("n", pa.int64()), ("band", pa.int64()), ("home", pa.list_(pa.int64())), ("next", pa.list_(pa.int64())),
                    ("home_bits", pa.binary()), ("next_bits", pa.binary())])


def _keyed(rule: Rule):
    """Bucket keys and parity bits of the classes in (c, text)."""
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for at in range(0, len(batch), 500):
                    rows = []
                    for c, text in zip(*batch.slice(at, 500).columns, strict=True):
                        s = shingle_set(text.as_py(), rule.words)
                        band = _band(rule, len(s))
                        reaches = _reaches_next(rule, len(s), band)
                        rows.append((c.as_py(), len(s), band, _keys(s, rule, band), _keys(s, rule, band + 1) if reaches else [],
                                     _parity(s, rule, band), _parity(s, rule, band + 1) if reaches else b""))
                    yield _batch(rows, _KEYED)
    return keyed


def _distance(a: bytes, b: bytes) -> int:
    """Hamming distance; sketches of unlike lengths belong to different bands and met by a chance collision of keys."""
    if len(a) != len(b):
        return 1 << 60
    return int(np.bitwise_count(np.frombuffer(a, np.uint8) ^ np.frombuffer(b, np.uint8)).sum(dtype=np.int64))


def _within(rule: Rule):
    """The pairs (u, v, n_u, n_v, bits_u, bits_v) whose sizes and parity bits allow a link."""
    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v, n_u, n_v = (batch.column(i).to_numpy() for i in range(4))
            far = np.array([_distance(a.as_py(), b.as_py()) for a, b in zip(batch.column(4), batch.column(5), strict=True)], dtype=np.int64)
            near = (far <= rule.difference(n_u + n_v)) & (rule.den * np.minimum(n_u, n_v) >= rule.num * np.maximum(n_u, n_v))
            yield pa.RecordBatch.from_arrays([pa.array(u[near]), pa.array(v[near])], names=["u", "v"])
    return within


def _near_pairs(starred: DataFrame, parity: DataFrame, rule: Rule) -> DataFrame:
    for side in ("v", "u"):
        own = parity.select(F.col("c").alias(side), F.col("n").alias(f"n_{side}"), "home_bits", "next_bits")
        starred = starred.join(own, side).withColumn(f"bits_{side}", F.when(F.col(f"next_{side}"), F.col("next_bits")).otherwise(F.col("home_bits"))).drop(
            "home_bits", "next_bits")
    return starred.select("u", "v", "n_u", "n_v", "bits_u", "bits_v").mapInArrow(_within(rule), "u long, v long").distinct()


class _Tile:
    """Some rows (c, component, n, bits) of a cluster; their parity bits are of one length."""

    def __init__(self, rows: pa.Table) -> None:
        self.c, self.component, self.n = (rows.column(name).to_numpy() for name in ("c", "component", "n"))
        bits = b"".join(rows.column("bits").to_pylist())
        self.words = np.ascontiguousarray(np.frombuffer(bits, np.uint64).reshape(len(self.c), len(bits) // 8 // max(1, len(self.c))).T)

    def close(self, other: _Tile, rule: Rule) -> np.ndarray:
        """The c of both that have one of another component in the other tile, of a size and parity bits that allow a link."""
        near_own, near_other = np.zeros(len(self.c), dtype=bool), np.zeros(len(other.c), dtype=bool)
        head = max(HEAD_WORDS, -(-len(self.words) // 5))  # of the words; they tell most pairs
        step = max(1, TILE_PAIRS // max(1, len(other.c)))
        for at in range(0, len(self.c), step):
            # in a tile itself each pair once
            own, met = slice(at, at + step), slice(at if other is self else 0, None)
            n_u, n_v = self.n[own, None], other.n[None, met]
            far, most = _ones(self.words[:head, own, None], other.words[:head, None, met]), rule.difference(n_u + n_v)
            near = (far <= most) & (rule.den * np.minimum(n_u, n_v) >= rule.num * np.maximum(n_u, n_v))
            u, v = np.nonzero(near & (self.component[own, None] != other.component[None, met]))
            for part in range(0, len(u), TILE_PAIRS):
                i, j = u[part:part + TILE_PAIRS], v[part:part + TILE_PAIRS]
                near = far[i, j] + _ones(self.words[head:, at + i], other.words[head:, met.start + j]) <= most[i, j]
                near_own[at + i[near]] = True
                near_other[met.start + j[near]] = True
        return np.unique(np.concatenate([self.c[near_own], other.c[near_other]]))


def _ones(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The bits in which arrays of words differ, added up over their first axis."""
    out = np.zeros(np.broadcast_shapes(a.shape, b.shape)[1:], dtype=np.int32)
    for x, y in zip(a, b, strict=True):
        out += np.bitwise_count(x ^ y)
    return out


def _closing(rule: Rule):
    """(cluster, band, a, b, side, c, component, n, bits) sorted by the first four -> c of the classes close to one of the other side of their group,
    which is two tiles a and b of a cluster's band; a tile with itself has one side."""
    def found(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        side = rows.column("side").to_numpy()
        one, other = (_Tile(rows.filter(pa.array(side == s))) for s in (0, 1))
        same = rows.column("a")[0] == rows.column("b")[0]
        c = one.close(one if same else other, rule) if same or len(one.c) and len(other.c) else []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64())], names=["c"])

    def closing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            group = np.stack([batch.column(i).to_numpy() for i in range(4)])
            edges = np.flatnonzero((np.diff(group) != 0).any(axis=0)) + 1
            for x, y in zip([0, *edges], [*edges, len(batch)], strict=True):
                if x == y:
                    continue
                if (own := tuple(group[:, x].tolist())) != now:
                    if held:
                        yield found(held)
                    now, held = own, []
                held.append(batch.slice(x, y - x))
        if held:
            yield found(held)
    return closing


def _close(rows: DataFrame, parity: DataFrame, rule: Rule) -> DataFrame:
    """The classes c of ``rows`` (cluster, c, component) that have, in their cluster, one of another component from which
    their sizes and parity bits are not too far for a link. Parity bits are a thirteenth of a set or so; they are compared in tiles of bounded size."""
    own = rows.select("cluster", "c", "component").join(parity, "c")
    own = own.select("cluster", "c", "component", "n", F.explode(F.array(*[
        F.struct((F.col("band") + i).alias("band"), F.col(bits).alias("bits")) for i, bits in enumerate(("home_bits", "next_bits"))])).alias("of")).select(
        "cluster", "c", "component", "n", "of.*").filter(F.octet_length("bits") > 0)
    sizes = own.groupBy("cluster", "band").agg((F.floor(F.sum(F.octet_length("bits")) / TILE_BYTES) + 1).alias("tiles"))
    own = own.join(sizes, ["cluster", "band"]).withColumn("own", F.pmod(F.xxhash64("c"), F.col("tiles")))
    own = own.withColumn("met", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    own = own.select("cluster", "band", F.least("own", "met").alias("a"), F.greatest("own", "met").alias("b"), (F.col("own") > F.col("met")).cast("long").alias("side"),
                     "c", "component", "n", "bits")
    return own.repartition("cluster", "band", "a", "b").sortWithinPartitions("cluster", "band", "a", "b").mapInArrow(_closing(rule), "c long").distinct()


def _bucketed(keyed: DataFrame, part: int) -> DataFrame:
    """key, c, next (whether the block is for the next band) and size of the buckets of several, of one part of the keys."""
    # c and whether the block is for the next band, in one number
    rows = keyed.select((F.col("c") * 2).alias("entry"), F.explode("home").alias("key")).unionByName(
        keyed.select((F.col("c") * 2 + 1).alias("entry"), F.explode("next").alias("key"))).filter(F.pmod("key", F.lit(KEY_PARTS)) == part)
    shared = written(rows.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "jaccard-keys")
    out = written(rows.join(shared, "key").select("key", F.expr("entry div 2").alias("c"), (F.col("entry") % 2 == 1).alias("next"), "size"),
                  "jaccard-bucketed")
    forget(shared)
    return out


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, text_digest, n_shingles, component_id and ``first`` of every row of ``docs`` (doc_id, text).

    component_id: the smallest doc_id in the component of links (null only where all ids in it are null);
    first: this row's (doc_id, text) is the component's first (smallest doc_id, null last; then smallest digest).
    A null text or one without words has an empty set, is linked with nothing and a component of its own.
    Repeated rows are in one component. Letters A to Z count as a to z; an empty table gives no rows.
    """
    return settled(lambda: _near_duplicates(docs, rule), "jaccard-components")


def _near_duplicates(docs: DataFrame, rule: Rule) -> DataFrame:
    d = texts(docs).select("doc_id", F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("text_digest"), "text")
    documents = written(d.mapInArrow(_digests(rule), "doc_id long, text_digest binary, n long, digest binary"), "jaccard-documents")
    classes = written(documents.filter("n > 0").groupBy("digest").agg(F.min("text_digest").alias("text_digest"))
                      .withColumn("c", F.monotonically_increasing_id()), "jaccard-classes")
    # one text of each class; copies of a text are one before the shuffle
    body = d.groupBy("text_digest").agg(F.first("text").alias("text")).join(classes.select("c", "text_digest"), "text_digest").select("c", "text")
    keyed = written(body.mapInArrow(_keyed(rule), "c long, n long, band long, home array<long>, next array<long>, home_bits binary, next_bits binary"), "jaccard-keyed")

    parts = [_bucketed(keyed, part) for part in range(KEY_PARTS)]
    buckets = written(reduce(DataFrame.unionByName, parts), "jaccard-buckets")
    parity = written(keyed.select("c", "n", "band", "home_bits", "next_bits").join(buckets.select("c").distinct(), "c", "left_semi"), "jaccard-parity")
    for done in (keyed, *parts):
        forget(done)
    centred = written(linking.centres(buckets, ["c", "next"]), "jaccard-centres")
    starred = written(linking.star_pairs(buckets, centred, ["c", "next"]), "jaccard-pairs")

    # pairs whose parity bits are too far apart are no links; whole sets are made only of the others and of what may be searched
    near = written(_near_pairs(starred, parity, rule), "jaccard-near")
    forget(starred)
    sets = written(body.join(linking.compared(linking.larger(buckets), centred, near), "c", "left_semi").mapInArrow(
        linking.whole_sets(rule), "c long, n long, shingles array<long>"), "jaccard-sets")
    verdicts = written(linking.verify(near, sets, rule), "jaccard-verdicts")
    member = linking.members(linking.larger(buckets), centred, verdicts.filter("linked").select("u", "v"), sets, rule,
                             lambda rows: _close(rows, parity, rule))
    return linking.labelled(documents, classes, member)


def first_documents(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row of ``docs`` (doc_id, text and any further columns, kept as they are) for each component.
    Rows that share their doc_id and text are one document; documents without words all stay."""
    def row_key(doc_id: Column, digest: Column) -> Column:
        return F.concat(digest, F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    first = near_duplicates(docs, rule).filter("first").select(row_key(F.col("doc_id"), F.col("text_digest")).alias("key")).distinct()
    digest = F.unhex(F.sha2(F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary"), 256))
    # one key without nulls: the rows are shuffled once, for both the copies and the join (an inner one, which is not pushed below the copies)
    d = docs.select(F.struct("*").alias("row"), row_key(docs["doc_id"].cast("long"), digest).alias("key"))
    return d.dropDuplicates(["key"]).join(first, "key").select("row.*")


def op8_parity_sketch(spark, sf_dir: str) -> DataFrame:
    """Components of all documents that share nine tenths of their three-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), Rule(words=3, num=90, den=100)).select("doc_id", "n_shingles", "component_id")


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents),
shingles AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(words) - 2, 1) + 1), lambda i: md5(array_to_string(words[i:i + 2], ' ')))) AS s
  FROM d WHERE len(words) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN sizes a ON x = a.doc_id JOIN sizes b ON y = b.doc_id WHERE 100 * n_both >= 90 * (a.n + b.n - n_both)),
reached AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY x) LEFT JOIN sizes USING (doc_id)
"""
