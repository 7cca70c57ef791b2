"""Merkle manifest of a dataset by time-forward processing.

Every node of the trees has a label, its place in the order of time: the group of rows, the level, and the number within the level.
Sweeping up, each node sends its digest to its parent's label; sweeping back, each node sends what
its children lack of their proofs. Spark's sorted shuffle is the external queue that carries these messages
between blocks of labels, a heap ordered by label carries them inside a block, and a block holds FANOUT ** LEVELS
nodes and their ancestors, however large a group of rows is. Groups make trees of their own; their roots, in the order of the groups,
are the leaves of the last tree, which the same two sweeps handle.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from airshed.llm.common import forget, table, written

#: Children of a node, and levels that a block of nodes is swept over before its root is sent on.
FANOUT, LEVELS = 16, 2
BLOCK = FANOUT ** LEVELS
#: Leaves of an output batch.
BATCH_ROWS = 1_000


def encoded(value: Column) -> Column:
    """A value as part of a leaf: ``-`` if null, else its UTF-8 byte count, a colon and itself (integers decimal)."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """The digest (32 bytes) of a row's values."""
    return F.unhex(F.sha2(F.concat(*[encoded(v) for v in values]).cast("binary"), 256))


def node_digest(children: list[bytes]) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


# ranks

def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with their task and their place among the task's rows of the same group."""
    part, at, n = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        places = []
        for g in batch.column(batch.schema.get_field_index("g")).to_pylist():
            at, n = (at, n + 1) if g == at else (g, 0)
            places.append(n)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())],
                                         names=[*batch.schema.names, "part", "place"])


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (g, not null, and others) with idx, their place in their group by ``order``, and n, the group's size.

    Rows are sorted over all tasks, each task counts its own, and only a count for each task and group is summed up, so that
    a group may hold any share of the rows. Rows that agree in ``order`` come in any order. The result is written.
    """
    spread = F.xxhash64(F.monotonically_increasing_id())  # parts rows that agree in all else
    d = rows.withColumn("spread", spread)
    d = d.repartitionByRange("g", *order, "spread").sortWithinPartitions("g", *order).drop("spread")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema) + ", part int, place long"
    placed = written(d.mapInArrow(_counted, schema), "merkle-placed")
    counts = placed.groupBy("g", "part").agg((F.max("place") + 1).alias("k"))
    by_group = Window.partitionBy("g")
    counts = counts.select("g", "part", F.sum("k").over(by_group).alias("n"),
                           (F.sum("k").over(by_group.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("k")).alias("before"))
    out = written(placed.join(counts, ["g", "part"]).withColumn("idx", F.col("before") + F.col("place")).drop("part", "place", "before"), "merkle-ranked")
    forget(placed)
    return out


# sweeps inside a block

def _sweep_up(digests: list[bytes], n: int) -> tuple[list[list[bytes]], int]:
    """The levels of a block of consecutive nodes, itself first, in a group of n nodes, and how many nodes the last of these levels has
    in the whole group. Messages leave the heap in the order of their labels: when a label's last one has come, its node is sent on."""
    above, sizes = 0, [n]
    while above < LEVELS and sizes[-1] > 1:
        above, sizes = above + 1, [*sizes, -(-sizes[-1] // FANOUT)]
    levels: list[list[bytes]] = [digests] + [[] for _ in range(above)]
    if above:
        queue = [((1, i // FANOUT), i, d) for i, d in enumerate(digests)]
        heapq.heapify(queue)
        while queue:
            label, children = queue[0][0], []
            while queue and queue[0][0] == label:
                children.append(heapq.heappop(queue)[2])
            digest, (level, i) = node_digest(children), label
            levels[level].append(digest)
            if level < above:
                heapq.heappush(queue, ((level + 1, i // FANOUT), i, digest))
    return levels, sizes[-1]


def _sweep_back(levels: list[list[bytes]], suffix: bytes) -> list[bytes]:
    """The proofs of a block's first level, given the proof suffix of its root: the reversed order of labels."""
    proofs: list[bytes] = [b""] * len(levels[0])
    queue = [((1 - len(levels), i), suffix) for i in range(len(levels[-1]))]
    heapq.heapify(queue)
    while queue:
        (level, i), known = heapq.heappop(queue)
        level = -level
        if not level:
            proofs[i] = known
            continue
        children = levels[level - 1][i * FANOUT:(i + 1) * FANOUT]
        for at in range(len(children)):
            step = bytes([at, len(children) - 1]) + b"".join(children[:at] + children[at + 1:])
            heapq.heappush(queue, ((1 - level, i * FANOUT + at), step + known))
    return proofs


def proof_steps(proof: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """A proof's levels, from the leaf up: the place in the run and the digests of the run's others."""
    at = 0
    while at < len(proof):
        place, others = proof[at], proof[at + 1]
        yield place, [proof[at + 2 + 32 * i:at + 34 + 32 * i] for i in range(others)]
        at += 2 + 32 * others


def folded(leaf: bytes, proof: bytes) -> bytes:
    """The root that a leaf and its proof lead to."""
    for place, others in proof_steps(proof):
        leaf = node_digest([*others[:place], leaf, *others[place:]])
    return leaf


def siblings_digest(proof: bytes) -> bytes:
    return node_digest([d for _, others in proof_steps(proof) for d in others])


# sweeps over blocks

def _by_block(rows: Iterator[dict]) -> Iterator[tuple[tuple, list[dict]]]:
    now, held = None, []
    for row in rows:
        if (key := (row["g"], row["block"])) != now:
            if held:
                yield now, held
            now, held = key, []
        held.append(row)
    if held:
        yield now, held


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, len(batch), BATCH_ROWS):
            yield from batch.slice(at, BATCH_ROWS).to_pylist()


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH_ROWS:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    yield pa.RecordBatch.from_pylist(held, schema=schema)


_NODE = pa.schema([("g", pa.string()), ("n", pa.int64()), ("idx", pa.int64()), ("digest", pa.binary())])


def _up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, n, block, idx, digest) sorted by label: the root of each block as a node of the next round."""
    def roots():
        for (g, block), held in _by_block(_rows(batches)):
            levels, n = _sweep_up([r["digest"] for r in held], held[0]["n"])
            yield {"g": g, "n": n, "idx": block, "digest": levels[-1][0]}
    yield from _batches(roots(), _NODE)


def _back(carried: list[str], schema: pa.Schema):
    """The nodes of a round, each block behind the message (idx -1) that its root has got: every node with its proof and what the message tells of its group."""
    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def proofs():
            for (g, _), held in _by_block(_rows(batches)):
                message, nodes = held[0], held[1:]
                levels, _ = _sweep_up([r["digest"] for r in nodes], nodes[0]["n"])
                for r, proof in zip(nodes, _sweep_back(levels, message["proof"]), strict=True):
                    yield {"g": g, "idx": r["idx"], "digest": r["digest"], "root": message["root"], "subroot": message["subroot"], "proof": proof,
                           **{c: r[c] for c in carried}}
        yield from _batches(proofs(), schema)
    return back


def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"idx div {BLOCK}"))


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartition("g", "block").sortWithinPartitions("g", "block", "idx")


class Forest:
    """The trees over ``ranked`` leaves (g, n, idx, digest and columns to carry); ``tops`` (g, digest) are their roots."""

    def __init__(self, leaves: DataFrame) -> None:
        self.rounds, self.tops, now = [leaves], leaves.filter("n = 1").select("g", "digest"), leaves
        while not (now := now.filter("n > 1")).isEmpty():  # a round for every LEVELS levels
            now = written(_sorted(_blocks(now.select("g", "n", "idx", "digest"))).mapInArrow(_up, "g string, n long, idx long, digest binary"), "merkle-nodes")
            self.rounds.append(now)
            self.tops = self.tops.unionByName(now.filter("n = 1").select("g", "digest"))

    def proofs(self, tops: DataFrame) -> DataFrame:
        """The leaves' columns with root, subroot and proof, given (g, root, subroot, proof) of every tree's top."""
        got = None
        for nodes in reversed(self.rounds):
            own = nodes.filter("n = 1").drop("n").join(tops, "g")
            if got is not None:
                own = own.unionByName(_delivered(nodes.filter("n > 1"), written(got, "merkle-messages")))
            got = own
        return got


def _delivered(nodes: DataFrame, messages: DataFrame) -> DataFrame:
    """A round's nodes with their proofs, from the messages (g, idx, root, subroot, proof) that their blocks' roots have got."""
    carried = [c for c in nodes.columns if c not in ("g", "n", "idx", "digest")]
    told = {c: F.lit(None).cast("binary") for c in ("root", "subroot", "proof")}
    sent = messages.select("g", F.col("idx").alias("block"), F.lit(-1).cast("long").alias("idx"), *told)
    schema = nodes.limit(0).drop("n").withColumns(told).schema
    order = ["g", "idx", "digest", "root", "subroot", "proof", *carried]
    rows = _sorted(_blocks(nodes).withColumns(told).unionByName(sent, allowMissingColumns=True))
    out = ", ".join(f"`{c}` {schema[c].dataType.simpleString()}" for c in order)
    return rows.mapInArrow(_back(carried, to_arrow_schema(T.StructType([schema[c] for c in order]))), out)


def manifest(leaves: DataFrame, group: str, order: str, carried: tuple[str, ...] = ()) -> DataFrame:
    """``order``, digest, ``carried``, subroot, root and proof of every row of ``leaves`` (``group``, ``order``, digest).

    Leaves ascend by ``order`` in their group, null first, rows that share it by their digest; equal rows are leaves of their own. A null group is a
    group, the first. A proof holds, level by level from the leaf to the root, the leaf's place in its run and the others' digests
    (``proof_steps``, ``folded``). Further columns are left behind; an empty table gives no rows.
    """
    kept = leaves.select(encoded(leaves[group]).alias("g"), F.col(order).alias("order"), "digest", *[F.col(c).alias(f"carried_{c}") for c in carried])
    trees = Forest(ranked(written(kept, "merkle-leaves"), ["order", "digest"]))
    name = F.when(F.col("g") != "-", F.expr("substring(g, locate(':', g) + 1)"))
    above = Forest(ranked(written(trees.tops.select(F.lit("").alias("g"), F.col("g").alias("member"), name.alias("name"), "digest"), "merkle-subroots"), ["name"]))
    top = above.tops.select("g", F.col("digest").alias("root"), F.col("digest").alias("subroot"), F.lit(b"").alias("proof"))
    tops = written(above.proofs(top).select(F.col("member").alias("g"), "root", F.col("digest").alias("subroot"), "proof"), "merkle-tops")
    return trees.proofs(tops).select(F.col("order").alias(order), "digest", *[F.col(f"carried_{c}").alias(c) for c in carried], "subroot", "root", "proof")


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, proof) -> the digest of the proof's siblings and the root that the digest leads to."""
    for batch in batches:
        digest, proof = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("shown", "proof"))
        rest = [(c, i) for i, c in enumerate(batch.schema.names) if c not in ("shown", "proof")]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(i) for _, i in rest], pa.array([siblings_digest(p) for p in proof], pa.binary()),
             pa.array([folded(d, p) for d, p in zip(digest, proof, strict=True)], pa.binary())], names=[*[c for c, _ in rest], "proof_digest", "folded"])


def verified(proofs: DataFrame, shown: Column) -> DataFrame:
    """The rows of ``manifest`` with proof_digest, folded (the root that the digest ``shown`` leads to) and verified, without the proof."""
    rows = proofs.withColumn("shown", shown)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name not in ("shown", "proof"))
    return rows.mapInArrow(_verified, f"{schema}, proof_digest binary, folded binary").withColumn("verified", F.col("folded") == F.col("root"))


def op12_time_forward(spark, sf_dir: str) -> DataFrame:
    """The manifest of all documents by source, each document's proof folded again, a fifth of them from a lower-cased text. Null columns, repeated
    rows and an empty table: see ``manifest``; a null doc_id is not tampered with."""
    d = table(spark, sf_dir, "documents")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaves = d.select("doc_id", "source", leaf_digest(*[F.col(c) for c in columns]).alias("digest"),
                      F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, leaf_digest(*[F.col(c) for c in columns[:-1]], low)).alias("altered"))
    out = verified(manifest(leaves, "source", "doc_id", ("altered",)), F.coalesce("altered", "digest"))

    def text(c: str) -> Column:
        return F.lower(F.hex(c))
    return out.select("doc_id", text("digest").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"), text("proof_digest").alias("proof_sha256"),
                      text("folded").alias("folded_root"), "verified")


ORACLE = r"""
WITH RECURSIVE crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8),
    lambda c, k: if(c % 2 = 1, xor(3988292384, c // 2), c // 2))) AS t),
d AS (SELECT row_number() OVER () AS r, doc_id, source, lang, n_chars, text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    (4294967295 - list_reduce([4294967295::BIGINT] || list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: ascii(substr(CAST(doc_id AS VARCHAR), i::INT, 1))::BIGINT),
     lambda c, b: xor(t[xor(c, b) % 256 + 1], c // 256))) % 5 = 0 AS tampered FROM documents, crc_table),
parts AS (SELECT *, concat_ws('', if(doc_id IS NULL, '-', strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id), if(source IS NULL, '-', strlen(source) || ':' || source),
    if(lang IS NULL, '-', strlen(lang) || ':' || lang), if(n_chars IS NULL, '-', strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars)) AS head FROM d),
leaves AS (SELECT r, doc_id, source, sha256(head || if(text IS NULL, '-', strlen(text) || ':' || text)) AS leaf,
    sha256(head || if(text IS NULL, '-', strlen(text) || ':' || if(tampered, low, text))) AS shown FROM parts),
-- every tree's nodes, level by level; a source's tree first, then the tree of the subroots
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM leaves),
nodes AS (SELECT source, 0 AS level, idx, n, leaf AS digest FROM placed UNION ALL
    SELECT source, level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY source, level, idx // 16, n),
subroots AS (SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (SELECT 0 AS level, idx, n, digest FROM subroots UNION ALL
    SELECT level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY level, idx // 16, n),
-- the siblings of each row, by height over both trees
height AS (SELECT source, max(level) AS h FROM nodes GROUP BY source),
steps AS (SELECT p.r, s.level, p.idx // (16 ** s.level)::BIGINT AS own, s.idx, s.digest FROM placed p JOIN nodes s ON s.source IS NOT DISTINCT FROM p.source
        AND s.n > 1 AND s.idx // 16 = p.idx // (16 ** (s.level + 1))::BIGINT
    UNION ALL SELECT p.r, h + s.level, u.idx // (16 ** s.level)::BIGINT, s.idx, s.digest FROM placed p JOIN subroots u ON u.source IS NOT DISTINCT FROM p.source
        JOIN height ON height.source IS NOT DISTINCT FROM p.source JOIN tops s ON s.n > 1 AND s.idx // 16 = u.idx // (16 ** (s.level + 1))::BIGINT),
runs AS (SELECT r, level, coalesce(string_agg(digest, '' ORDER BY idx) FILTER (idx < own), '') AS before, coalesce(string_agg(digest, '' ORDER BY idx) FILTER (idx > own), '') AS after
    FROM steps GROUP BY r, level),
folds AS (SELECT r, 0 AS level, shown AS digest FROM placed UNION ALL
    SELECT f.r, f.level + 1, sha256(before || f.digest || after) FROM folds f JOIN runs ON runs.r = f.r AND runs.level = f.level),
proofs AS (SELECT r, sha256(string_agg(before || after, '' ORDER BY level)) AS proof FROM runs GROUP BY r)
SELECT doc_id, leaf, u.digest AS subroot, top.digest AS root, coalesce(proof, sha256('')) AS proof_sha256, f.digest AS folded_root, f.digest = top.digest AS verified
FROM placed p JOIN subroots u ON u.source IS NOT DISTINCT FROM p.source JOIN tops top ON top.n = 1 LEFT JOIN proofs USING (r)
JOIN (SELECT r, arg_max(digest, level) AS digest FROM folds GROUP BY r) f USING (r)
"""
