"""Chat formatting with cumulative-snapshot collapse.

Logs hold snapshots of growing conversations. Turns are sorted over all tasks by conversation and
turn, so a conversation of any length is spread over as many tasks as its turns fill. A rolling hash gives
one digest for every prefix; the hash composes, so each task hashes its own rows and what precedes
them in the tasks before is put in front afterwards. A conversation whose whole digest is a proper prefix
of another's is dropped, of equal ones the smallest id stays, and only the turns of the rest meet in one row, rendered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import table, written

# the hash of turns t1..tn is the sum of digest(ti) * BASE^(n-i), modulo a prime of 127 bits
PRIME, BASE = 2**127 - 1, 0x5DEECE66D1B54A32D192ED03A1F3C6A7
#: Characters of the text by which turns of one conversation, number and role are dealt out.
DEALT_CHARS = 64

_HASHED = pa.schema([("conv_id", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("part", pa.int32()), ("n", pa.int64()), ("hash", pa.binary())])
_PREFIX = pa.schema([("conv_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())])


def _turn_hash(role: str, text: str) -> int:
    state = hashlib.blake2b(digest_size=16)
    for part in (role.encode(), text.encode()):
        state.update(len(part).to_bytes(8, "little") + part)
    return int.from_bytes(state.digest(), "little")


def _rolling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each turn with its task, its place among the task's turns of the conversation, and their hash up to it."""
    part, at, n, h = TaskContext.get().partitionId(), (), 0, 0
    for batch in batches:
        ids, roles, texts = (batch.column(batch.schema.get_field_index(c)) for c in ("conv_id", "role", "text"))
        ns, hashes = [], []
        for conv_id, role, text in zip(ids.to_pylist(), roles.to_pylist(), texts.to_pylist(), strict=True):
            if conv_id != at:
                at, n, h = conv_id, 0, 0
            n, h = n + 1, (h * BASE + _turn_hash(role, text)) % PRIME
            ns.append(n)
            hashes.append(h.to_bytes(16, "little"))
        columns = [ids, roles, texts, [part] * len(ns), ns, hashes]
        yield pa.RecordBatch.from_arrays([x.cast(t) if isinstance(x, pa.Array) else pa.array(x, t)
                                          for x, t in zip(columns, _HASHED.types, strict=True)], schema=_HASHED)


def hashed_turns(turns: DataFrame) -> DataFrame:
    """The different turns, sorted by conversation and turn over all tasks, hashed within each
    task; a turn logged more than once counts once."""
    t = turns.select(turns["conv_id"].cast("long").alias("conv_id"), turns["turn"].cast("long").alias("turn"),
                     F.coalesce(turns["role"].cast("string"), F.lit("")).alias("role"),
                     F.coalesce(turns["text"].cast("string"), F.lit("")).alias("text")).distinct()
    dealt = t.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, DEALT_CHARS))
    return written(dealt.sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(
        _rolling, "conv_id long, role string, text string, part int, n long, hash binary"), "chat-turns")


def _before(t: DataFrame) -> dict[int, tuple[int | None, int, int]]:
    """For each task that goes on with a conversation: its id, and the number and hash of its turns
    in the tasks before. From one row for each task, with its first and last conversation."""
    first, last = F.struct("conv_id"), F.struct("conv_id", "n", "hash")
    # conversations are sorted inside a task, NULL first
    order = F.struct(F.col("conv_id").isNotNull(), F.col("conv_id"), F.col("n"))
    ends = t.groupBy("part").agg(F.min_by(first, order).alias("first"), F.max_by(last, order).alias("last")).orderBy("part").collect()
    before, at = {}, None
    for r in ends:
        conv_id, n, h = r["last"]["conv_id"], r["last"]["n"], int.from_bytes(r["last"]["hash"], "little")
        if at is not None and at[0] == r["first"]["conv_id"]:
            before[r["part"]] = at
            if conv_id == at[0]:  # the whole task is of that conversation
                n, h = at[1] + n, (at[2] * pow(BASE, n, PRIME) + h) % PRIME
        at = (conv_id, n, h)
    return before


def _joined(before: dict[int, tuple[int | None, int, int]]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv_id, part, n, h in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                start = before.get(part)
                if start is not None and start[0] == conv_id:
                    h = ((start[2] * pow(BASE, n, PRIME) + int.from_bytes(h, "little")) % PRIME).to_bytes(16, "little")
                    n += start[1]
                rows.append((conv_id, n, h))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_PREFIX.types)], schema=_PREFIX)
    return run


def maximal(t: DataFrame) -> DataFrame:
    """conv_id, n_turns and n_equal of the conversations that prefix no longer one.

    A digest that more conversations have as a prefix (itself included) than as a whole prefixes a
    longer one. Both counts are partial aggregates, so a prompt or a conversation that a third of the log repeats is a row a task.
    """
    p = written(t.select("conv_id", "part", "n", "hash").mapInArrow(_joined(_before(t)), "conv_id long, n long, digest binary"), "chat-prefixes")
    whole = p.groupBy("conv_id").agg(F.max_by("digest", "n").alias("digest"), F.max("n").alias("n_turns")).groupBy("digest").agg(
        F.min("conv_id").alias("conv_id"), F.first("n_turns").alias("n_turns"), F.count("*").alias("n_equal"))
    reached = p.groupBy("digest").agg(F.count("*").alias("n_reached"))
    return whole.join(reached, "digest").filter("n_reached = n_equal").drop("digest", "n_reached")


def render(turns) -> Column:
    """Turns as text: a header line with the role, the text, an end mark, for each turn."""
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit("<|im_start|>"), t["role"], F.lit("\n"), t["text"], F.lit("<|im_end|>\n"))), "")


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_equal, rendered for each maximal conversation.

    ``turns``: conv_id, turn, role, text. Turns are ordered by turn (null first), then role and text; a null
    role or text is empty, and equal to an empty one; rows without a conv_id form one conversation,
    which of its equals is the last to be chosen. Turn numbers only order: equal turns under other numbers are equal.
    A maximal conversation is one output value: it must fit into the memory of a task and into 2 GB.
    """
    t = hashed_turns(turns)
    kept = maximal(t).withColumnRenamed("conv_id", "kept_id")
    return (t.join(kept, t["conv_id"].eqNullSafe(kept["kept_id"])).groupBy("conv_id")
            .agg(F.first("n_turns").alias("n_turns"), F.first("n_equal").alias("n_equal"),
                 F.sort_array(F.collect_list(F.struct("part", "n", "role", "text"))).alias("turns"))
            .select("conv_id", "n_turns", "n_equal", render(F.col("turns")).alias("rendered")))


def op6_snapshot_collapse(spark, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


ORACLE = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
p AS (SELECT conv_id, row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id) AS n_turns,
    string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '') OVER w AS prefix
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
whole AS (SELECT min(conv_id) AS conv_id, n_turns, count(*) AS n_equal, prefix AS rendered FROM p WHERE n = n_turns GROUP BY prefix, n_turns)
SELECT * FROM whole WHERE rendered NOT IN (SELECT prefix FROM p WHERE n < n_turns)
"""
